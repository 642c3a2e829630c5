"""Shards of near-equal bytes by minimax contiguous partition of groups of equal texts.

Rows with equal texts are one atomic group. Groups stand in a fixed order: those that alone are
larger than an even share first, each in a shard of its own, then all others by the hash of their
text. Over that order the smallest feasible shard capacity is found by binary search, a capacity
being feasible if filling shard after shard needs no more shards than there are, and the groups
are cut where filling with that capacity cuts them.

The search runs on a summary: ranges of the hash order with their total and largest size. A
summary answers a capacity in two ways, as if a range could be cut anywhere and as if it could
not be cut at all, and the true answer lies between. Ranges that a cut could reach for any
capacity still in question are replaced by finer ones, which is one aggregation over the table
of groups, until both answers agree. Driver memory holds the summary only: ``2**FIRST_BITS`` ranges
at first and ``2**STEP_BITS`` for each range refined, which are those near a cut.

Defined results: null text has size 8 and all null texts are one group; empty text likewise is a
group; repeated rows are rows of their own in the same shard; fewer groups than shards leave
shards empty; an empty table gives an empty result; other columns are ignored. Texts whose 64-bit
hashes agree are kept together even if they differ, which changes no other promise.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

SHARDS = 24
#: Bytes that every row takes beside its text.
ROW_BYTES = 8
#: Bits of the key that tell the ranges of the first summary, and by which a range is refined.
FIRST_BITS, STEP_BITS = 12, 4
_LOW, _HIGH = -(1 << 63), 1 << 63


@dataclass(frozen=True)
class Range:
    """Groups with a key in [first, last): how many, their bytes and the largest."""

    first: int
    last: int
    groups: int
    size: int
    largest: int


def _fill(ranges: list[Range], capacity: int, divisible: bool) -> list[int] | None:
    """Prefix size at the end of each filled shard; None if a group or range fits in no shard."""
    ends, total, begin = [], 0, 0
    for r in ranges:
        if r.largest > capacity:
            return None
        while total + r.size - begin > capacity:
            if divisible and r.groups > 1:
                begin += capacity
            elif total > begin:
                begin = total
            else:
                return None
            ends.append(begin)
        total += r.size
    return [*ends, total] if total > begin or not ends else ends


def _smallest(ranges: list[Range], shards: int, divisible: bool) -> int:
    """Smallest capacity with which the ranges go into ``shards`` shards."""
    total = sum(r.size for r in ranges)
    low, high = max(1, -(-total // shards)), max(1, total)
    while low < high:
        middle = (low + high) // 2
        ends = _fill(ranges, middle, divisible)
        if ends is not None and len(ends) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def _earliest_ends(ranges: list[Range], capacity: int) -> list[int]:
    """Ends of shards filled with whole ranges; where a range does not fit, filling stays there."""
    marks = [0]
    for r in ranges:
        marks.append(marks[-1] + r.size)
    ends, at = [], 0
    while at < len(ranges):
        stop = at
        while stop < len(ranges) and marks[stop + 1] - marks[at] <= capacity:
            stop += 1
        if stop == at:
            break
        ends.append(marks[stop])
        at = stop
    return ends


def _open_runs(ranges: list[Range], low: int, high: int, shards: int) -> list[tuple[int, int]]:
    """Runs [i, j) of ranges in which a cut may fall for a capacity between ``low`` and ``high``;
    runs that hold single groups only are settled and left out."""
    total = sum(r.size for r in ranges)
    early = _earliest_ends(ranges, low) or [0]
    windows = [(early[min(k, len(early) - 1)], min(total, (k + 1) * high)) for k in range(shards)]
    runs: list[tuple[int, int]] = []
    begin = 0
    for i, r in enumerate(ranges):
        end = begin + r.size
        if any(a < end and b > begin for a, b in windows):
            if runs and runs[-1][1] == i:
                runs[-1] = (runs[-1][0], i + 1)
            else:
                runs.append((i, i + 1))
        begin = end
    return [(i, j) for i, j in runs if any(r.groups > 1 for r in ranges[i:j])]


def _summary(groups: DataFrame, spans: list[tuple[int, int, int]]) -> list[Range]:
    """The groups inside the key spans (first, last, width), cut at multiples of each one's width, a
    power of two; empty ranges are left out."""
    out = []
    for width in sorted({width for _, _, width in spans}):
        inside = reduce(or_, (F.col("key").between(a, b - 1) for a, b, w in spans if w == width))
        shift = width.bit_length() - 1
        rows = (
            groups.where(inside)
            .groupBy(F.shiftright("key", shift).alias("part"))
            .agg(F.count("*").alias("groups"), F.sum("size").alias("size"), F.max("size").alias("largest"))
            .collect()
        )
        out += [Range(r["part"] << shift, (r["part"] + 1) << shift, r["groups"], r["size"], r["largest"]) for r in rows]
    return out


def minimax_cuts(groups: DataFrame, shards: int, first_bits: int = FIRST_BITS, step_bits: int = STEP_BITS) -> tuple[int, list[int]]:
    """Smallest capacity for ``groups`` (key, size) in key order, and the first key of every shard
    but the first."""
    ranges = sorted(_summary(groups, [(_LOW, _HIGH, 1 << (64 - first_bits))]), key=lambda r: r.first)
    while True:
        low, high = _smallest(ranges, shards, True), _smallest(ranges, shards, False)
        runs = _open_runs(ranges, low, high, shards)
        if not runs:
            break
        # A run's widest range becomes finer; nothing lies in the keys between its ranges.
        widths = [max(r.last - r.first for r in ranges[i:j] if r.groups > 1) for i, j in runs]
        spans = [(ranges[i].first, ranges[j - 1].last, max(1, w >> step_bits)) for (i, j), w in zip(runs, widths, strict=True)]
        within = {k for i, j in runs for k in range(i, j)}
        ranges = [r for k, r in enumerate(ranges) if k not in within] + _summary(groups, spans)
        ranges.sort(key=lambda r: r.first)
    cuts, total = [], 0
    ends = _fill(ranges, high, False) or []
    for r in ranges:
        if total and total in ends[:-1]:
            cuts.append(r.first)
        total += r.size
    return high, cuts


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard and slot."""
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.xxhash64("text").alias("key"),
        )
    )
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("size")))
    left, alone = shards, []
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()["size"]
    # Fewer than ``shards`` groups can each exceed an even share.
    heavy = groups.where(F.col("size") > total // shards).orderBy(F.desc("size"), "key").limit(shards).collect()
    for group in heavy:
        if left < 2 or group["size"] * left <= total:
            break
        alone.append(group["key"])
        total -= group["size"]
        left -= 1
    _, cuts = minimax_cuts(groups.where(~F.col("key").isin(alone)) if alone else groups, left)

    number = F.lit(len(alone)) + sum((F.col("key") >= cut).cast("int") for cut in cuts) if cuts else F.lit(len(alone))
    for place, key in enumerate(alone):
        number = F.when(F.col("key") == key, place).otherwise(number)
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.select(
        "doc_id", "size", "text_crc32", number.cast("int").alias("shard"),
        F.pmod(F.xxhash64("doc_id", "key"), F.lit(slices)).alias("salt"),
    )
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy("shard", "salt")
        .agg(F.count("*").alias("many"))
        .select("shard", "salt", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("shard", "salt").orderBy("doc_id")
    return (
        placed.withColumn("number", F.row_number().over(within))
        .join(bases, ["shard", "salt"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("number") - 1).alias("slot"))
    )
