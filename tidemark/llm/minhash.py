"""Near-duplicate documents by min-max hashing, with every link confirmed on full shingle sets.

Each permutation of the shingle hashes gives two values, the smallest and the largest. Either
agrees between two sets with a probability equal to their Jaccard similarity, so half as many
hash evaluations fill the bands, and a band mixes minima and maxima of different permutations.

Sets that are equal are one node, so exact copies never meet in pairs. A bucket (band and value)
first compares each node with the bucket's smallest one only; a node takes its smallest such hub
over all buckets. Components of the confirmed links are then laid over the buckets. For a few
rounds, every node outside its bucket's largest component tries one more member of that component,
another one each round; what is apart after that is compared in full, all nodes outside the
largest component with every node of other components. A pair is skipped only if it is already
connected or if the set sizes alone rule it out, so no link between candidates is lost. The full
comparison runs over blocks of about ``BLOCK`` sets, so large groups of near copies cost a few rows
a node and a row a pair of blocks, never a row a pair.

With the default 80 permutations in 32 bands of 5, a pair at similarity 0.8 is missed with a
probability of 3e-6.

Defined results: null or empty text and text without words has no shingles, is linked with
nothing and is its own component; repeated rows of one doc_id give one row each; columns other
than ``doc_id`` and ``text`` are ignored by :func:`components` and kept by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import set_aside
from tidemark.llm.graph import connect
from tidemark.llm.words import NOT_WHITE, hash_spans, mix, shingles, stream, text_blocks, word_spans
from tidemark.session import materialize

PERMUTATIONS = 80
ROWS_PER_BAND = 5
BANDS = 2 * PERMUTATIONS // ROWS_PER_BAND
SIMILAR_PERCENT = 80

_FACTORS = (stream(101, PERMUTATIONS) | np.uint64(1))[:, None]
_SHIFTS = stream(211, PERMUTATIONS)[:, None]
#: Rounds in which a node tries one more member of the largest component of a bucket.
ROUNDS = 2
#: Sets compared with as many others at a time.
BLOCK = 64
#: Shingles hashed at a time.
_STEP = 1024


def signature(values: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the shingle hashes under each permutation: minima, then maxima."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(values), _STEP):
        moved = _FACTORS * values[None, i : i + _STEP]
        moved += _SHIFTS
        np.minimum(low, moved.min(axis=1), out=low)
        np.maximum(high, moved.max(axis=1), out=high)
    return np.concatenate([low, high])


def bands(signatures: np.ndarray) -> np.ndarray:
    """One hash per band and row of ``signatures``; a band takes neighbouring values."""
    parts = signatures.reshape(-1, BANDS, ROWS_PER_BAND)
    folded = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for column in range(ROWS_PER_BAND):
        folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, column])
    return folded.view(np.int64)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and shingle set of each text of a batch."""
    for first, last, data, bounds in text_blocks(batch.column("text")):
        starts, ends, at = word_spans(data, bounds, NOT_WHITE)
        hashes = hash_spans(data, starts, ends)
        for row in range(last - first):
            yield first + row, shingles(hashes[at[row] : at[row + 1]], k)


def _sign(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        keys = np.zeros((batch.num_rows, 2), np.int64)
        rows = np.zeros((batch.num_rows, 2 * PERMUTATIONS), np.uint64)
        for row, values in _sets(batch, k):
            sizes[row] = len(values)
            if len(values):
                other = mix(values ^ np.uint64(0x5851F42D4C957F2D))
                keys[row] = [int(x) for x in np.array([values.sum(), other.sum()], np.uint64).view(np.int64)]
                rows[row] = signature(values)
        filled = np.where(sizes > 0, BANDS, 0)
        offsets = np.concatenate([[0], np.cumsum(filled)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(sizes),
                pa.array(keys[:, 0]),
                pa.array(keys[:, 1]),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands(rows[sizes > 0]).ravel())),
            ],
            names=["doc_id", "n_shingles", "key_a", "key_b", "bands"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed: list[bytes] = [b""] * batch.num_rows
        for row, values in _sets(batch, k):
            packed[row] = values.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "shingles"]
        )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets are similar enough."""
    for batch in batches:
        left, right = batch.column("set_a"), batch.column("set_b")
        good = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a = np.frombuffer(left[i].as_buffer(), np.uint64)
            b = np.frombuffer(right[i].as_buffer(), np.uint64)
            at = np.searchsorted(a, b)
            common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
            good[i] = 100 * common >= SIMILAR_PERCENT * (len(a) + len(b) - common)
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that hold on full sets, as a table."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return materialize(joined.mapInArrow(_linked, "a long, b long"))


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the sets of two blocks that belong to different components."""
    for batch in batches:
        found: list[tuple[int, int]] = []
        for row in batch.to_pylist():
            right = row["right"]
            nodes, labels, sizes = (np.array([x[c] for x in right]) for c in ("node", "label", "n"))
            values = np.concatenate([np.frombuffer(x["shingles"], np.uint64) for x in right])
            owner = np.repeat(np.arange(len(right)), sizes)
            for one in row["left"]:
                mine = np.frombuffer(one["shingles"], np.uint64)
                at = np.minimum(np.searchsorted(mine, values), len(mine) - 1)
                common = np.bincount(owner[mine[at] == values], minlength=len(right))
                good = (100 * common >= SIMILAR_PERCENT * (sizes + one["n"] - common)) & (labels != one["label"])
                found += [(min(one["node"], b), max(one["node"], b)) for b in nodes[good].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _compare_blocks(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between every node outside a bucket's main component and all nodes of the buckets with
    that main component, as a table."""
    members = materialize(
        apart.select("main", "node", "n", "label", (F.col("label") != F.col("main")).alias("outside")).distinct()
    )
    crowds = members.groupBy("main").agg(F.count("*").alias("all"), F.count_if("outside").alias("strangers"))
    full = members.join(crowds, "main").join(sets.withColumnRenamed("doc_id", "node"), "node")

    def blocks(rows: DataFrame, many: str, name: str) -> DataFrame:
        number = F.pmod(F.xxhash64("node"), F.ceil(F.col(many) / BLOCK)).alias("block")
        return rows.groupBy("main", number).agg(F.collect_list(F.struct("node", "n", "label", "shingles")).alias(name)).select("main", name)

    paired = blocks(full.where("outside"), "strangers", "left").join(blocks(full, "all", "right"), "main")
    return materialize(paired.select("left", "right").mapInArrow(_block_links, "a long, b long").distinct())


def _possible(a: str, b: str) -> F.Column:
    """Sizes that could still reach the threshold."""
    small, large = F.least(a, b), F.greatest(a, b)
    return 100 * small >= SIMILAR_PERCENT * large


def _apart(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their label and the bucket's main
    one, which has the most members; as a table."""
    placed = live.join(labels, live.node == labels.id, "left").select(
        "bucket", "node", "n", F.coalesce("label", "node").alias("label")
    )
    crowds = placed.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    mixed = (
        crowds.groupBy("bucket")
        .agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count("*").alias("crowds"))
        .where("crowds > 1")
        .select("bucket", "main")
    )
    return materialize(placed.join(mixed, "bucket"))


def components(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Texts are lower-cased in A-Z and cut at ASCII white space into words; a set holds the distinct
    runs of ``k`` words, or the whole sequence of a shorter text. Documents are linked at a
    Jaccard similarity of 0.8 or more; component_id is the smallest doc_id reachable.
    """
    texts = docs.select("doc_id", "text")
    signed = materialize(
        texts.mapInArrow(
            partial(_sign, k=k), "doc_id long, n_shingles long, key_a long, key_b long, bands array<long>"
        )
    )
    filled = signed.where("n_shingles > 0")
    nodes = materialize(
        filled.groupBy("key_a", "key_b", "n_shingles").agg(
            F.min("doc_id").alias("node"), F.min_by("bands", "doc_id").alias("bands")
        )
    )
    members = nodes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct("node", "n")).alias("hub"))
    live = materialize(members.join(shared.where("size > 1").select("bucket", "hub"), "bucket"))

    first = materialize(
        live.where(F.col("node") != F.col("hub.node"))
        .where(_possible("n", "hub.n"))
        .groupBy(F.col("node").alias("b"))
        .agg(F.min("hub.node").alias("a"))
        .select("a", "b")
    )
    involved = live.select(F.col("node").alias("doc_id")).distinct()
    sets = materialize(
        texts.join(involved, "doc_id", "left_semi").mapInArrow(partial(_full_sets, k=k), "doc_id long, shingles binary")
    )
    tried, links = first, _confirm(first, sets)
    for number in range(ROUNDS):
        apart = _apart(live, connect(links))
        hubs = (
            apart.where("label = main")
            .groupBy("bucket")
            .agg(F.min_by(F.struct("node", "n"), F.xxhash64("node", F.lit(number))).alias("hub"))
        )
        picked = (
            apart.where("label != main")
            .join(hubs, "bucket")
            .where(_possible("n", "hub.n"))
            .groupBy("node")
            .agg(F.min_by("hub.node", F.xxhash64("bucket", F.lit(number))).alias("other"))
        )
        pairs = materialize(
            picked.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            .distinct()
            .join(tried, ["a", "b"], "left_anti")
        )
        if pairs.isEmpty():
            break
        tried = materialize(tried.unionByName(pairs))
        links = materialize(links.unionByName(_confirm(pairs, sets)))

    links = materialize(links.unionByName(_compare_blocks(_apart(live, connect(links)), sets)))
    labels = connect(links)

    final = nodes.select("key_a", "key_b", "n_shingles", "node").join(labels, F.col("node") == F.col("id"), "left")
    final = final.select("key_a", "key_b", "n_shingles", F.coalesce("label", "node").alias("component"))
    return (
        signed.drop("bands")
        .join(final, ["key_a", "key_b", "n_shingles"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )


def keep_one(docs: DataFrame, k: int = 5) -> DataFrame:
    """The document with the smallest doc_id of each component, with all its columns.

    Different texts under one doc_id are different documents: the one whose text has the smallest
    checksum holds the id, the others count as later than all ids. Rows that repeat id and text
    are one document.
    """
    rows, own = set_aside(docs, ("_content", "_later", "_node"))
    keyed = rows.withColumn("_content", F.xxhash64("text"))
    ids = keyed.groupBy("doc_id").agg(F.min("_content").alias("first"), F.max("_content").alias("last"))
    shared = materialize(ids.where("first < last").select("doc_id", "first"))
    others = keyed.select("doc_id", "_content").join(shared, "doc_id").where(F.col("_content") > F.col("first"))
    largest = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long").alias("largest")).first()["largest"]
    # Numbers of rows differ between runs of a lost task, so they are written before they are used.
    numbered = materialize(others.select("doc_id", "_content").distinct().withColumn("n", F.monotonically_increasing_id()))
    later = numbered.select("doc_id", "_content", (F.col("n") + largest + 1).alias("_later"))
    named = keyed.join(later, ["doc_id", "_content"], "left").withColumn("_node", F.coalesce("_later", "doc_id"))
    gone = components(named.select(F.col("_node").alias("doc_id"), "text"), k).where("NOT kept")
    gone = gone.select(F.col("doc_id").alias("_node")).distinct()
    return named.join(gone, "_node", "left_anti").select(*own)
