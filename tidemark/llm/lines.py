"""Near-duplicate lines by an exact set-similarity join; later matches are removed.

A line is the set of its lower-cased words. A line is removed if any earlier line (by doc_id, then
line number) has a Jaccard similarity of 0.8 or more with it; lines without words stay.

Words are ordered by rarity: the class (three an octave) of the number of lines that use a word's
hash bucket, one of ``2**BUCKET_BITS``, so the order is known from a table of fixed size. Lines with
equal sets are one set, placed at their first line. Two similar sets share a word in their prefixes,
the first ``n - ceil(0.8 n) + 1`` words; a pair that shares one is a candidate if the sizes allow the
similarity (length filter), if the words left after the shared ones could still reach the overlap
(positional filter), and if the parity maps of the sets (64 bits, 128 or 256 for large sets) differ
in no more bits than similar sets can. All three lose no similar pair. Candidates are verified on
their whole sets. Sets of up to three words only match equal ones.

Before the join, sets with the same first word under one of two random orders are compared with the
earliest of them. What that removes has found its earlier match and looks for no other; it stays
in the index for later lines. A large group of variants of one line so costs a row a variant, not
a row a pair. The join itself sends the index once and reads it for both sides.

All of it is DataFrame operations. The rarity classes, one byte a bucket, are a literal of the plan.

Defined results: null text has no lines; repeated rows of one doc_id count as one; other columns
are kept by :func:`without_repeats` and ignored by :func:`repeats`; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import set_aside
from tidemark.session import materialize

BUCKET_BITS = 18
#: Sets above these sizes carry a parity map of 128 and of 256 bits.
WIDE, WIDEST = 40, 100
_MAPS = ("map", "map2", "map3", "map4")
_HUB = ("doc", "line", "size", *_MAPS)
_AT = (*_HUB, "place")
_PAIR = ["a_doc", "a_line", "b_doc", "b_line"]
_BUCKETS = (1 << BUCKET_BITS) - 1
#: A character that is no white space.
_WORD = r"[^\x20\x09-\x0D]"


def _texts(docs: DataFrame) -> DataFrame:
    """doc and text, lower-cased, its lines ending at \\n and all other white space made blanks."""
    text = F.lower("text")
    others = [text.contains(c) for c in "\t\r\x0b\x0c"]
    blank = F.when(others[0] | others[1] | others[2] | others[3], F.translate(text, "\t\r\x0b\x0c", "    ")).otherwise(text)
    return docs.select(F.col("doc_id").cast("long").alias("doc"), blank.alias("text"))


def _lines(texts: DataFrame, *carried: str) -> DataFrame:
    """doc, line (from 0) and content of every line that has words."""
    lines = texts.select("doc", *carried, F.posexplode(F.split("text", "\n")).alias("line", "content"))
    return lines.where(F.col("content").rlike("[^ ]"))


def _words(content: str) -> Column:
    """Hashes of the distinct words between blanks."""
    hashes = F.transform(F.split(content, " "), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(hashes), F.xxhash64(F.lit("")))


def _rarity(lines: DataFrame) -> bytes:
    """The rarity class of every bucket, three an octave of the lines that use it."""
    used = lines.select(F.explode(_words("content")).alias("word")).select(F.col("word").bitwiseAND(_BUCKETS).alias("bucket"))
    # One row per bucket at most, whatever the table's size.
    found = used.groupBy("bucket").agg(F.count("*").alias("uses")).toArrow()
    classes = np.zeros(1 << BUCKET_BITS, np.uint8)
    uses = found["uses"].to_numpy()
    classes[found["bucket"].to_numpy()] = np.minimum(3 * np.log2(uses), 127).astype(np.uint8)
    return classes.tobytes()


def _code(word: Column, rarity: Column) -> Column:
    """A number that puts words of rarer buckets first; the hash decides within a class."""
    place = word.bitwiseAND(_BUCKETS).cast("int") + 1
    level = F.ascii(F.substring(rarity, place, F.lit(1)).cast("string")).cast("long")
    return F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(word, 8))


def _parity(bits: Callable[[Column], Column]) -> Column:
    """Every word whose lowest bit of ``bits`` is set turns over one of 64 bits."""
    return F.aggregate(
        "words",
        F.lit(0).cast("long"),
        lambda seen, w: seen.bitwiseXOR(F.call_function("shiftleft", bits(w).bitwiseAND(1), w.bitwiseAND(63).cast("int"))),
    )


def _maps() -> list[Column]:
    """Parity maps: every word turns over one of 256 bits.

    The quarters are kept folded: the first map is all four over each other (64 bits), the second
    opens it to 128 bits, the third and fourth to 256; those that a small set needs not are 0.
    """
    none = F.lit(0).cast("long")
    odd, high = (lambda w: F.shiftrightunsigned(w, 6)), (lambda w: F.shiftrightunsigned(w, 7))
    return [
        _parity(lambda _: F.lit(1).cast("long")).alias("map"),
        F.when(F.col("size") > WIDE, _parity(odd)).otherwise(none).alias("map2"),
        F.when(F.col("size") > WIDEST, _parity(lambda w: high(w).bitwiseAND(F.bitwise_not(odd(w))))).otherwise(none).alias("map3"),
        F.when(F.col("size") > WIDEST, _parity(lambda w: high(w).bitwiseAND(odd(w)))).otherwise(none).alias("map4"),
    ]


def _sets(lines: DataFrame, rarity: bytes) -> DataFrame:
    """The first line of every set, with what the filters and the join need of it."""
    sized = lines.select("doc", "line", F.sort_array(_words("content")).alias("words")).withColumn("size", F.size("words"))
    table = F.lit(rarity)
    codes = F.sort_array(F.transform("words", lambda w: _code(w, table)))
    shared = F.col("size") - F.floor((4 * F.col("size") + 4) / 5).cast("int") + 1
    prefix = F.when(F.col("size") > 3, F.slice(codes, 1, shared)).otherwise(F.expr("cast(array() as array<bigint>)"))
    # The smallest and the largest hash: the first words under two opposite random orders.
    ends = F.array(F.array_min("words"), F.array_max("words").bitwiseXOR(1))
    keyed = sized.select(
        "doc", "line", "size", F.xxhash64("words").alias("key_a"), F.xxhash64(F.lit(1), "words").alias("key_b"), *_maps(), ends.alias("least"), prefix.alias("prefix")
    )
    first = F.min(F.struct("doc", "line", *_MAPS, "least", "prefix")).alias("at")
    return keyed.groupBy("key_a", "key_b", "size").agg(first).select("size", "at.*")


def _may_match(a_place: Column, b_place: Column) -> Column:
    """Line a is earlier, and sizes, places and maps allow the similarity."""
    a, b = F.col("a_size"), F.col("b_size")
    earlier = (F.col("a_doc") < F.col("b_doc")) | ((F.col("a_doc") == F.col("b_doc")) & (F.col("a_line") < F.col("b_line")))
    sizes = 5 * F.least(a, b) >= 4 * F.greatest(a, b)
    left = 1 + F.least(a - a_place, b - b_place)
    m1, m2, m3, m4 = (F.col(f"a_{m}").bitwiseXOR(F.col(f"b_{m}")) for m in _MAPS)
    small = F.least(a, b)
    wide = F.bit_count(m1.bitwiseXOR(m2)) + F.bit_count(m2)
    widest = F.bit_count(m1.bitwiseXOR(m2).bitwiseXOR(m3)) + F.bit_count(m2.bitwiseXOR(m4)) + F.bit_count(m3) + F.bit_count(m4)
    apart = F.when(small > WIDEST, widest).when(small > WIDE, wide).otherwise(F.bit_count(m1))
    # Of both sizes together, similar sets share 4/9 at least and differ in 1/9 at most; the maps
    # differ in no more bits than there are differing words.
    return earlier & sizes & (9 * left >= 4 * (a + b)) & (9 * apart <= a + b)


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The later line of each pair that holds on whole sets."""
    ends = pairs.select(F.col("a_doc").alias("doc"), F.col("a_line").alias("line")).union(pairs.select("b_doc", "b_line"))
    wanted = materialize(ends.distinct().groupBy("doc").agg(F.collect_set("line").alias("wanted")))
    lines = _lines(texts.join(wanted, "doc"), "wanted").where(F.array_contains("wanted", F.col("line")))
    sets = materialize(lines.select("doc", "line", _words("content").alias("words")).dropDuplicates(["doc", "line"]))
    left = sets.select(*(F.col(c).alias(f"a_{c}") for c in ("doc", "line", "words")))
    right = sets.select(*(F.col(c).alias(f"b_{c}") for c in ("doc", "line", "words")))
    common = F.size(F.array_intersect("a_words", "b_words"))
    return (
        pairs.join(left, ["a_doc", "a_line"])
        .join(right, ["b_doc", "b_line"])
        .where(9 * common >= 4 * (F.size("a_words") + F.size("b_words")))
        .select(F.col("b_doc").alias("doc"), F.col("b_line").alias("line"))
        .distinct()
    )


def _meet_earliest(sets: DataFrame) -> DataFrame:
    """Pairs of each set and the earliest one with the same smallest word under a random order."""
    keyed = sets.where("size > 3").select(F.explode("least").alias("key"), *_HUB)
    hubs = keyed.groupBy("key").agg(F.min(F.struct(*_HUB)).alias("a"), F.count("*").alias("n")).where("n > 1")
    hubs = hubs.select("key", *(F.col(f"a.{c}").alias(f"a_{c}") for c in _HUB))
    later = keyed.select("key", *(F.col(c).alias(f"b_{c}") for c in _HUB))
    return later.join(hubs, "key").where(_may_match(F.lit(1), F.lit(1))).select(*_PAIR).distinct()


def _meet_all(sets: DataFrame, gone: DataFrame) -> DataFrame:
    """Pairs of every set outside ``gone`` and all earlier ones that may match it."""
    flagged = sets.where("size > 3").join(gone.withColumn("gone", F.lit(1)), ["doc", "line"], "left")
    posted = flagged.select(*_HUB, F.coalesce("gone", F.lit(0)).alias("gone"), F.posexplode("prefix").alias("place", "code"))
    posted = posted.withColumn("place", F.col("place") + 1)
    # Both sides have the same rows and columns, so that they are shuffled once; what is gone is
    # left out by a condition on both sides, which stays in the join.
    earlier, later = (posted.select("code", *(F.col(c).alias(f"{side}_{c}") for c in (*_AT, "gone"))) for side in "ab")
    looks = F.col("b_gone") * (1 + F.col("a_gone")) == 0
    return earlier.join(later, "code").where(_may_match(F.col("a_place"), F.col("b_place")) & looks).select(*_PAIR).distinct()


def _kept(docs: DataFrame) -> DataFrame:
    """doc and line of every set's first line that resembles no earlier one."""
    texts = _texts(docs)
    lines = _lines(texts)
    sets = materialize(_sets(lines, _rarity(lines)))
    gone = materialize(_verify(materialize(_meet_earliest(sets)), texts))
    rest = materialize(_meet_all(sets, gone))
    gone = gone.unionByName(_verify(rest, texts))
    return sets.select("doc", "line").join(gone, ["doc", "line"], "left_anti")


def _removed(docs: DataFrame) -> DataFrame:
    """doc_id, lines (numbers of those that have words) and kept (of those that stay)."""
    kept = _kept(docs).groupBy(F.col("doc").alias("of")).agg(F.collect_list("line").alias("kept"))
    # The text is split once: a lookup by number would split it again for every line.
    numbers = F.transform(F.split("text", "\n"), lambda line, i: F.when(line.rlike(_WORD), i))
    worded = F.when(F.col("text").isNotNull(), F.array_compact(numbers))
    none = F.expr("cast(array() as array<int>)")
    found = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(worded, none).alias("lines"))
    found = found.groupBy("doc").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("lines"))
    return found.join(kept, F.col("doc").eqNullSafe(F.col("of")), "left").select(
        F.col("doc").alias("doc_id"), "lines", F.coalesce("kept", none).alias("kept")
    )


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, line (from 0) and repeated of every line that has words."""
    lines = _removed(docs).select("doc_id", "kept", F.explode("lines").alias("line"))
    return lines.select("doc_id", "line", (~F.array_contains("kept", F.col("line"))).alias("repeated"))


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (with words), n_removed and the removed line numbers of every document."""
    removed = F.array_except("lines", "kept")
    found = _removed(docs).select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.array_sort(removed).alias("removed"))
    none = F.expr("cast(array() as array<int>)")
    return (
        docs.select("doc_id")
        .join(found, "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
            F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("removed", none).alias("removed"),
        )
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with removed lines cut out of ``text``.

    A document that had words and has none left repeats earlier documents as a whole and goes.
    """
    rows, own = set_aside(docs, ("_doc", "_removed", "_whole"))
    found = (
        _removed(rows)
        .select(
            F.col("doc_id").alias("_doc"),
            F.array_except("lines", "kept").alias("_removed"),
            ((F.size("kept") == 0) & (F.size("lines") > 0)).alias("_whole"),
        )
        .where(F.size("_removed") > 0)
    )
    lines = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("_removed", i))
    cleaned = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))
    return (
        rows.join(found, rows.doc_id == found["_doc"], "left")
        .where(~F.coalesce("_whole", F.lit(False)))
        .select(*(cleaned.alias(c) if c == "text" else column for c, column in zip(docs.columns, own, strict=True)))
    )
