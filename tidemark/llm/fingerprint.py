"""Document fingerprints as Merkle trees over sentences, paragraphs and sections.

A paragraph is a line with its line breaks, a sentence ends after a run of ``. ! ? , ; :`` or line
breaks. Every sentence has the SHA-256 of its text, every paragraph that of its sentences' values,
every section that of its paragraphs, the root that of its sections. A section ends after a
paragraph whose last sentence's value (12 digits of it) ends in 0 to 3, so inserting a paragraph
moves no boundary elsewhere. Pieces keep their separators, so equal roots mean equal texts.

The fingerprint is the tree as text: root, then sections, each with its paragraphs and the short
values of their sentences. Two fingerprints are alike by their sentences: twice the common ones
over the sum of both (1 for equal roots).

Defined results: null text is empty; the empty text has one empty sentence; repeated rows of one
doc_id each get a row, their order set by their text; a single row is its own next document;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PARAGRAPHS = r"(?<=\n)(?=[^\n])"
_SENTENCES = r"(?s)(?<=[.!?,;:\n])(?=[^.!?,;:\n])"
#: Hex digits kept of the values of sentences, and of paragraphs and sections.
SHORT, LONG = 12, 32


def values(text: Column) -> Column:
    """Values of the sentences of each paragraph."""
    return F.transform(F.split(text, _PARAGRAPHS), lambda p: F.transform(F.split(p, _SENTENCES), lambda s: F.sha2(s, 256)))


def tree(sentences: Column) -> Column:
    """The fingerprint that belongs to :func:`values`."""
    paragraphs = F.transform(
        sentences,
        lambda found: F.concat(
            F.substring(F.sha2(F.array_join(found, ""), 256), 1, LONG),
            F.lit(":"),
            F.array_join(F.transform(found, lambda v: F.substring(v, 1, SHORT)), ""),
        ),
    )
    sections = F.transform(
        F.split(F.array_join(paragraphs, ","), "(?<=[0-3]),"),
        lambda s: F.concat(F.substring(F.sha2(s, 256), 1, LONG), F.lit("="), s),
    )
    joined = F.array_join(sections, ";")
    return F.concat(F.sha2(joined, 256), F.lit("|"), joined)


def sentences_of(found: Column) -> Column:
    """The distinct short values of :func:`values`."""
    return F.array_distinct(F.transform(F.flatten(found), lambda v: F.substring(v, 1, SHORT)))


def likeness(a: Column, b: Column) -> Column:
    """Of two lists from :func:`sentences_of`."""
    return (2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))).cast("double")


def _buckets(keys: DataFrame, many: int) -> tuple[list[list[int]], list[int]]:
    """Bounds of about ``many`` ranges of doc_id with similar row counts, in a list of lists whose
    length and whose members' length are near the root of ``many``."""
    shares = [i / many for i in range(1, many)]
    found = keys.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * many)).alias("at")).first()["at"] if shares else None
    bounds = sorted(set(found or []))
    width = max(1, math.isqrt(len(bounds)))
    return [bounds[i : i + width] for i in range(0, len(bounds), width)], bounds


def _number(key: Column, bounds: list[list[int]]) -> Column:
    """How many bounds are not above ``key``, found in two short steps."""
    if not bounds:
        return F.lit(0)
    heads = F.array(*[F.lit(b[0]) for b in bounds])
    chunks = F.array(*[F.array(*[F.lit(x) for x in b]) for b in bounds])
    upto = F.array(F.lit(0), *[F.lit(sum(len(c) for c in bounds[:i])) for i in range(len(bounds))])
    head = F.size(F.filter(heads, lambda b: b <= key))
    inside = F.size(F.filter(F.element_at(chunks, F.greatest(head, F.lit(1))), lambda b: b <= key))
    return F.when(key.isNull() | (head <= 0), 0).otherwise(F.element_at(upto, head + 1) + inside)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and sentence values of every row, and those of the next one by doc_id.

    Rows go to ranges of doc_id, and the first row of a range also to the range before it, so one
    shuffle brings neighbours together and no range waits for another. The last row's next is the
    first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    many = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, flat = _buckets(rows.select("doc_id"), many)
    number = _number(F.col("doc_id"), bounds)
    # One row per range.
    firsts = {r["range"]: r["doc_id"] for r in rows.groupBy(number.alias("range")).agg(F.min(F.struct(F.col("doc_id"))).alias("least")).select("range", "least.doc_id").collect()}
    order = sorted(firsts)
    before = {r: order[i - 1] for i, r in enumerate(order)}
    size = len(flat) + 1
    least = F.array(*[F.lit(firsts.get(r)).cast("long") for r in range(size)])
    previous = F.array(*[F.lit(before.get(r, 0)) for r in range(size)])

    placed = rows.withColumn("range", number)
    is_first = F.col("doc_id").eqNullSafe(F.element_at(least, F.col("range") + 1))
    guest = F.struct(
        F.element_at(previous, F.col("range") + 1).alias("range"),
        (F.col("range") == (order[0] if order else 0)).cast("int").alias("lap"),
        F.lit(True).alias("guest"),
    )
    own = F.struct(F.col("range"), F.lit(0).alias("lap"), F.lit(False).alias("guest"))
    dealt = placed.withColumn("place", F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own)))).select("doc_id", "text", "place.*")
    near = dealt.repartition("range").withColumn("found", values(F.col("text")))
    window = Window.partitionBy("range").orderBy("lap", "doc_id", F.xxhash64("text"), "guest")
    return (
        near.withColumn("next", F.lead(F.struct("text", "found")).over(window))
        .where(~F.col("guest"))
        .select("doc_id", "text", "found", F.col("next.text").alias("next_text"), F.col("next.found").alias("next_found"))
    )


def edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts: the last quarter of the code
    points replaced by the beginning of the next document."""
    n, tail = F.char_length("text"), F.floor(F.char_length("text") / 4).cast("int")
    paired = with_next(docs)
    edited = paired.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), n - tail), F.substring(F.col("next_text"), F.lit(1), tail))
    )
    hashed = edited.withColumn("edited_found", values(F.col("edited"))).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "found",
        "edited_found",
        sentences_of(F.col("found")).alias("own"),
        sentences_of(F.col("edited_found")).alias("changed"),
        sentences_of(F.col("next_found")).alias("following"),
    )
    return hashed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        tree(F.col("found")).alias("fingerprint"),
        tree(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
