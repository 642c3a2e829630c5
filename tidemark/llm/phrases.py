"""Collocations of two to four words, counted on a prefix-free parsing of the corpus.

A text is cut into pieces at punctuation and line breaks, and a piece into chunks at triggers:
runs of ``LONGEST - 1`` words whose hash falls on a fixed residue, so that equal passages are cut
alike wherever they stand. A chunk reaches over the trigger that begins the next one, so no chunk
is a prefix of another and every run of up to ``LONGEST`` words lies whole in a chunk. A run
belongs to the chunk that holds its first word before the overlap, and is counted there alone.

Equal chunks of a language are one dictionary entry with a frequency, so a passage repeated
any number of times is read once from there on. Runs are counted in distinct chunks, weighted by
frequency, in three scans of the dictionary:

* hashes of pairs of words, summed by hash;
* hashes of longer runs all of whose pairs may be frequent, and of the words of such pairs;
* the runs that may be frequent themselves, as strings; these counts are exact.

What may be frequent goes to the scans as bitmaps of 2**BITMAP_BITS bits, two of which a hash
sets. A hash collision lets a run through that is then counted by its string and dropped. If more runs are frequent than
a bitmap holds well, the scan is made in several slices of the hash range, each with its own
bitmap; the result is the same.

A part of a frequent phrase is as frequent, so all counts that a score needs are there. Scores are
decimal integers of 38 digits.

Defined results: null and empty texts have no words; a null lang is ``und``; repeated rows count
again; words are never cut, whatever their length; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.words import FOLD, hash_spans, mix, stream, text_blocks, word_spans
from tidemark.session import materialize

LONGEST = 4
LEAST = 30
TOP = 2_000
#: A candidate goes if a longer one around it has this share (percent) of its uses.
COVERED = 80
SCALE = 2_000_000
#: One trigger in so many runs of words.
SPACING = 16
BITMAP_BITS = 26
#: Where in a hash its two bits of the bitmap are named.
_SHIFTS = (0, 64 - BITMAP_BITS)
#: The bits above this one decide the slice.
_SLICED = 20
#: Entries a bitmap takes; beyond, the hash range is sliced.
BITMAP_ENTRIES = 1 << (BITMAP_BITS - 3)
#: Parts in which each language's first rows are found before they meet.
PARTS = 32
#: Hashes that a task holds before it sums them up.
_HELD = 1 << 22

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_CLASSES = np.where(_BREAK, 0, 1).astype(np.uint8)
_CLASSES[[0x20, 0x09]] = 0
#: The dictionary has one blank between words and nothing else to cut at.
_DICTIONARY = np.ones(256, np.uint8)
_DICTIONARY[0x20] = 0
_F = stream(97, LONGEST + 1) | np.uint64(1)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one blank behind each, and where they now start and end."""
    sizes = ends - starts
    after = np.cumsum(sizes + 1)
    begin = after - sizes - 1
    out = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
    shift = np.repeat(starts - begin, sizes)
    at = np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
    out[at] = FOLD[data[at + shift]]
    return out, begin, after - 1


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Spans of ``data``, which may overlap, as a string array."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.arange(int(offsets[-1])) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the run of ``width`` words that begins at each word but the last few."""
    many = max(len(hashes) - width + 1, 0)
    total = np.zeros(many, np.uint64)
    for place in range(width):
        total += hashes[place : place + many] * _F[place]
    return mix(total + np.uint64(width))


def _summed(table: pa.Table) -> pa.Table:
    keys = [c for c in table.column_names if c != "uses"]
    return table.group_by(keys).aggregate([("uses", "sum")]).rename_columns([*keys, "uses"])


def _parse(batches: Iterator[pa.RecordBatch], spacing: int) -> Iterator[pa.RecordBatch]:
    """Chunks (lang, chunk, uses); a blank at the end says that the last words are the next chunk's."""
    overlap = LONGEST - 1
    for batch in batches:
        langs = batch.column("lang").fill_null("und")
        for first, last, data, bounds in text_blocks(batch.column("text")):
            starts, ends, at = word_spans(data, bounds, _CLASSES)
            if not len(starts):
                continue
            text = np.repeat(np.arange(last - first), np.diff(at))
            breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])[starts]
            opens = np.ones(len(starts), bool)
            opens[1:] = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
            piece = np.cumsum(opens)
            words, begin, end = _joined(data, starts, ends)
            runs = _runs(hash_spans(words, begin, end, fold=False), overlap)
            trigger = np.zeros(len(starts), bool)
            trigger[: len(runs)] = (runs % np.uint64(spacing) == 0) & (piece[: len(runs)] == piece[overlap - 1 :])
            heads = np.flatnonzero(opens | trigger)
            follows = np.append(heads[1:], len(starts))
            within = np.append(~opens[heads[1:]], False)  # the next chunk is of the same piece
            tail = np.where(within, follows + overlap - 1, follows - 1)
            chunks = _strings(words, begin[heads], end[tail] + within)
            lang = langs.slice(first, last - first).take(pa.array(text[heads]))
            table = pa.table({"lang": lang, "chunk": chunks, "uses": pa.array(np.ones(len(heads), np.int64))})
            for some in _summed(table).cast(pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("uses", pa.int64())])).to_batches():
                yield some


def dictionary(docs: DataFrame, spacing: int = SPACING) -> DataFrame:
    """lang, chunk and uses of all distinct chunks of ``docs`` (text, lang)."""
    parsed = docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(
        partial(_parse, spacing=spacing), "lang string, chunk string, uses long"
    )
    return parsed.groupBy("lang", "chunk").agg(F.sum("uses").alias("uses"))


class _Block:
    """Words of a block of dictionary entries: spans, hashes, languages and weights."""

    def __init__(self, batch: pa.RecordBatch, first: int, last: int, data: np.ndarray, bounds: np.ndarray):
        self.data = data
        self.starts, self.ends, at = word_spans(data, bounds, _DICTIONARY)
        self.chunk = np.repeat(np.arange(last - first), np.diff(at))
        # Words of the overlap belong to the next chunk.
        self.shared = data[bounds[1:] - 1] == 0x20
        left = np.repeat(at[1:] - np.where(self.shared, LONGEST - 1, 0), np.diff(at))
        self.own = np.arange(len(self.starts)) < left
        self.uses = batch.column("uses").to_numpy()[first:last][self.chunk]
        langs = batch.column("lang").slice(first, last - first)
        names = langs.dictionary_encode()
        raw = [n.encode() for n in names.dictionary.to_pylist()]
        joined = np.frombuffer(b"".join(raw) or b"\0", np.uint8)
        edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        codes = np.array([hash_spans(joined, edges[i : i + 1], edges[i + 1 : i + 2], fold=False)[0] for i in range(len(raw))], np.uint64)
        self.langs = langs
        self.lang = codes[names.indices.to_numpy()][self.chunk] if len(raw) else codes
        self.hashes = hash_spans(data, self.starts, self.ends, fold=False)

    def singles(self) -> np.ndarray:
        """Hashes of all words with the language, those of the overlap too."""
        return mix(_runs(self.hashes, 1) ^ self.lang)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of ``width`` words begin that the chunk owns, and their hashes with the language."""
        runs = _runs(self.hashes, width)
        many = len(runs)
        at = np.flatnonzero(self.own[:many] & (self.chunk[:many] == self.chunk[width - 1 :]))
        return at, mix(runs[at] ^ self.lang[at])


def _blocks(batch: pa.RecordBatch) -> Iterator[_Block]:
    for first, last, data, bounds in text_blocks(batch.column("chunk")):
        yield _Block(batch, first, last, data, bounds)


class Bitmap:
    """A fixed number of bits; a hash is in if the two bits it names are set. Only hashes whose
    residue is ``slice`` of ``slices`` belong to it."""

    def __init__(self, words: np.ndarray, slice: int, slices: int):
        self.words, self.slice, self.slices = words, slice, slices

    def mine(self, hashes: np.ndarray) -> np.ndarray:
        if self.slices == 1:
            return np.ones(len(hashes), bool)
        return (hashes >> np.uint64(_SLICED)) % np.uint64(self.slices) == np.uint64(self.slice)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for shift in _SHIFTS:
            bit = (hashes >> np.uint64(shift)) & np.uint64((1 << BITMAP_BITS) - 1)
            found &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return found


def _bitmaps(hashes: DataFrame) -> Iterator[Bitmap]:
    """Bitmaps that together hold all of ``hashes`` (hash)."""
    slices = max(1, -(-hashes.count() // BITMAP_ENTRIES))
    for number in range(slices):
        mine = hashes.where(F.pmod(F.shiftrightunsigned("hash", _SLICED), F.lit(slices)) == number)
        bits = F.array(*(F.shiftrightunsigned("hash", shift).bitwiseAND((1 << BITMAP_BITS) - 1) for shift in _SHIFTS))
        words = mine.select(F.explode(bits).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
        # At most 2**(BITMAP_BITS - 6) rows of 16 bytes, whatever the table's size.
        rows = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
        found = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
        found[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        yield Bitmap(found, number, slices)


def _sum_by_hash(hashes: list[np.ndarray], uses: list[np.ndarray]) -> pa.RecordBatch:
    every, many = np.concatenate(hashes), np.concatenate(uses)
    order = np.argsort(every)
    every, many = every[order], many[order]
    begin = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    sums = np.add.reduceat(many, begin) if len(every) else many
    return pa.RecordBatch.from_arrays([pa.array(every[begin].view(np.int64)), pa.array(sums)], ["hash", "uses"])


def _pairs(block: _Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at, hashes = block.runs(2)
    yield hashes, block.uses[at]


def _others(block: _Block, pairs, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of three words and more whose pairs may all be frequent, in the slice of their first
    pair; and the words of frequent pairs, which are as frequent, once a block."""
    bitmap = pairs.value
    at, hashes = block.runs(2)
    mine, has = bitmap.mine(hashes), bitmap.has(hashes)
    first = np.zeros(len(block.starts) + LONGEST, bool)
    first[at] = mine & has
    # A pair of another slice, or in the overlap, is not known to be rare here.
    may = np.ones(len(block.starts) + LONGEST, bool)
    may[at] = ~mine | has
    parts = np.zeros(len(block.starts) + 1, bool)
    parts[:-1] = first[: len(block.starts)]
    parts[1:] |= first[: len(block.starts)]
    words = np.unique(block.singles()[parts[:-1]])
    yield words, np.full(len(words), least, np.int64)
    for width in range(3, LONGEST + 1):
        begins, hashes = block.runs(width)
        kept = first[begins]
        for further in range(1, width - 1):
            kept &= may[begins + further]
        yield hashes[kept], block.uses[begins[kept]]


def _hashes(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:
    """Sums by hash of what ``of`` yields for every block."""
    hashes: list[np.ndarray] = []
    uses: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for block in _blocks(batch):
            for some, many in of(block):
                hashes.append(some)
                uses.append(many)
                held += len(some)
            if held > _HELD:
                yield _sum_by_hash(hashes, uses)
                hashes, uses, held = [], [], 0
    if held:
        yield _sum_by_hash(hashes, uses)


def _frequent(chunks: DataFrame, of, least: int) -> DataFrame:
    # Sums are already made in the tasks, so a hash has few rows however common it is.
    counted = chunks.mapInArrow(partial(_hashes, of=of), "hash long, uses long")
    return counted.groupBy("hash").agg(F.sum("uses").alias("uses")).where(F.col("uses") >= least).select("hash")


def _spelt(batches: Iterator[pa.RecordBatch], frequent) -> Iterator[pa.RecordBatch]:
    """Runs that may be frequent, as strings with their uses."""
    bitmap = frequent.value
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("uses", pa.int64())])
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for block in _blocks(batch):
            for width in range(1, LONGEST + 1):
                at, hashes = block.runs(width)
                kept = at[bitmap.mine(hashes) & bitmap.has(hashes)]
                if not len(kept):
                    continue
                phrases = _strings(block.data, block.starts[kept], block.ends[kept + width - 1])
                lang = block.langs.take(pa.array(block.chunk[kept]))
                size = pa.array(np.full(len(kept), width, np.int32))
                held.append(_summed(pa.table({"lang": lang, "size": size, "phrase": phrases, "uses": pa.array(block.uses[kept])})))
                rows += held[-1].num_rows
            if rows > _HELD >> 2:
                whole = _summed(pa.concat_tables(held)).cast(schema)
                yield from whole.to_batches()
                held, rows = [], 0
    if held:
        yield from _summed(pa.concat_tables(held)).cast(schema).to_batches()


def frequent_runs(chunks: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, size, phrase and uses of all runs of 1 to LONGEST words used ``least`` times or more."""
    spark = chunks.sparkSession
    pairs = materialize(_frequent(chunks, _pairs, least))
    frequent = pairs
    for bitmap in _bitmaps(pairs):
        sent = spark.sparkContext.broadcast(bitmap)
        frequent = frequent.unionByName(materialize(_frequent(chunks, partial(_others, pairs=sent, least=least), least)))
    out = None
    for bitmap in _bitmaps(frequent):
        sent = spark.sparkContext.broadcast(bitmap)
        counted = chunks.mapInArrow(partial(_spelt, frequent=sent), "lang string, size int, phrase string, uses long")
        sums = counted.groupBy("lang", "size", "phrase").agg(F.sum("uses").alias("uses")).where(F.col("uses") >= least)
        out = materialize(sums) if out is None else out.unionByName(materialize(sums))
    return out


def _scored(runs: DataFrame) -> DataFrame:
    """lang, size, phrase, a, l, r and score of all phrases, by their lowest-scoring cut."""
    phrases = runs.where("size > 1").withColumnRenamed("uses", "a")
    parts = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice(parts, 1, k), " ").alias("head"),
            F.array_join(F.slice(parts, k + 1, F.col("size") - k), " ").alias("rest"),
        ),
    )
    cut = phrases.select("lang", "size", "phrase", "a", F.explode(cuts).alias("at")).select("lang", "size", "phrase", "a", "at.*")
    heads = runs.select("lang", F.col("phrase").alias("head"), F.col("uses").alias("l"))
    rests = runs.select("lang", F.col("phrase").alias("rest"), F.col("uses").alias("r"))
    score = F.expr(f"cast(cast(cast({SCALE} as decimal(8,0)) * cast(a as decimal(20,0)) as decimal(38,0)) div cast(cast(l as decimal(20,0)) + cast(r as decimal(20,0)) as decimal(38,0)) as bigint)")
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("at")
    return (
        cut.join(heads, ["lang", "head"])
        .join(rests, ["lang", "rest"])
        .withColumn("score", score)
        .groupBy("lang", "size", "phrase", "a")
        .agg(lowest)
        .select("lang", "size", "phrase", "a", "at.l", "at.r", "at.score")
    )


def _uncovered(phrases: DataFrame, covered: int) -> DataFrame:
    """Phrases without a longer one around them that has ``covered`` percent of their uses."""
    parts = F.split("phrase", " ")

    def inner(width: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.col("size") - width + 1, F.lit(1)))
        return F.when(F.col("size") > width, F.transform(starts, lambda i: F.array_join(F.slice(parts, i, width), " ")))

    inside = F.array_distinct(F.flatten(F.array_compact(F.array(*(inner(width) for width in range(2, LONGEST))))))
    longer = phrases.select("lang", F.col("a").alias("around"), F.explode(inside).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    part = F.expr(f"cast(100 as decimal(20,0)) * around >= cast({covered} as decimal(20,0)) * a")
    return phrases.join(longer, ["lang", "phrase"], "left").where(F.col("around").isNull() | ~part).drop("around")


def _total(chunks: DataFrame) -> DataFrame:
    """lang and n, all uses of words."""
    words = F.length("chunk") - F.length(F.replace("chunk", F.lit(" "))) + 1
    own = words - F.when(F.col("chunk").endswith(" "), LONGEST).otherwise(0)
    return chunks.groupBy("lang").agg(F.sum(own.cast("long") * F.col("uses")).alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, spacing: int = SPACING) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases."""
    chunks = materialize(dictionary(docs, spacing))
    scored = materialize(_scored(frequent_runs(chunks, least)))
    kept = _uncovered(scored, covered).drop("size")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # A language may hold most phrases: each part gives its first rows before they are ranked together.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("rank") <= top).drop("part")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(_total(chunks), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
