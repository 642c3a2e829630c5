"""Exact quantiles with linear interpolation, for groups of any size."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import running_totals
from tidemark.session import materialize


def _interpolated(probability: float, n: Column) -> tuple[Column, Column, Column]:
    position = F.lit(float(probability)) * (n - 1)
    low = F.floor(position)
    return low, F.ceil(position), position - low


def quantiles_by_running_totals(
    df: DataFrame, groups: Sequence[str], value: str, probabilities: Mapping[str, float], few_groups: bool = False
) -> DataFrame:
    """Order statistics read off the running count of (group, value) pairs.

    ``few_groups`` says that the groups are a fixed small set, such as columns; their totals are
    then broadcast, since all rows of a group would meet in one task otherwise.
    """
    pairs = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("_n"))
    counted = running_totals(pairs, [*groups, value], {"_n": F.col("_n")})
    stats = counted.groupBy(*groups).agg(
        F.min("_n_before").alias("_start"), F.sum("_n").alias("_total")
    )
    placed = counted.join(F.broadcast(stats) if few_groups else stats, list(groups))
    first, past = F.col("_n_before") - F.col("_start"), F.col("_n_upto") - F.col("_start")

    picks, covers = [], []
    for name, probability in probabilities.items():
        low, high, fraction = _interpolated(probability, F.col("_total"))
        at_low, at_high = (first <= low) & (low < past), (first <= high) & (high < past)
        covers += [at_low, at_high]
        picks += [
            F.max(F.when(at_low, F.col(value))).alias(f"_lo_{name}"),
            F.max(F.when(at_high, F.col(value))).alias(f"_hi_{name}"),
            F.max(fraction).alias(f"_f_{name}"),
        ]
    kept = placed.where(reduce(lambda a, b: a | b, covers))
    return kept.groupBy(*groups).agg(*picks).select(
        *groups,
        *[
            ((1 - F.col(f"_f_{n}")) * F.col(f"_lo_{n}") + F.col(f"_f_{n}") * F.col(f"_hi_{n}")).alias(n)
            for n in probabilities
        ],
    )


#: Rank error of the brackets is one in so many rows.
ACCURACY = 2_000


def _sketched(rows: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> dict[str, tuple[float, float] | None]:
    """Two sketched values about every quantile, from one sketch a column."""
    spread = 2.0 / ACCURACY
    asked: dict[str, list[float]] = {}
    for column, p in wanted.values():
        asked.setdefault(column, []).extend((max(0.0, p - spread), min(1.0, p + spread)))
    row = rows.agg(*[F.percentile_approx(c, ends, ACCURACY).alias(c) for c, ends in asked.items()]).first()
    out: dict[str, tuple[float, float] | None] = {}
    used = dict.fromkeys(asked, 0)
    for name, (column, _) in wanted.items():
        at, found = used[column], row[column]
        out[name] = None if found is None else (found[at], found[at + 1])
        used[column] = at + 2
    return out


def _placed(name: str, column: str, low: float, high: float) -> list[Column]:
    """How a column's values lie about a bracket, as aggregates."""
    value = F.col(column)
    return [
        F.count(value).alias(f"{name}__n"),
        F.count_if(value < low).alias(f"{name}__below"),
        F.count_if(value == low).alias(f"{name}__low"),
        F.count_if((value > low) & (value < high)).alias(f"{name}__between"),
        F.count_if((value == high) & F.lit(high > low)).alias(f"{name}__high"),
        F.max(F.when(value < low, value)).alias(f"{name}__before"),
        F.min(F.when(value > high, value)).alias(f"{name}__after"),
    ]


def _between(rows: DataFrame, brackets: Mapping[str, tuple[str, float, float]], ranks: Sequence[tuple[str, int]]) -> dict[tuple[str, int], float]:
    """Order statistics among the values strictly inside brackets (name -> column, low, high)."""
    inner = [
        F.when((F.col(c) > low) & (F.col(c) < high), F.struct(F.lit(name).alias("name"), F.col(c).alias("value")))
        for name, (c, low, high) in brackets.items()
    ]
    # A few rows in a thousand leave the scan; only they are put in order.
    pairs = rows.select(F.inline(F.array_compact(F.array(*inner)))).groupBy("name", "value").agg(F.count("*").alias("_n"))
    counted = running_totals(pairs, ["name", "value"], {"_n": F.col("_n")})
    start = counted.groupBy("name").agg(F.min("_n_before").alias("_start"))
    asked = rows.sparkSession.createDataFrame(list(ranks), "name string, rank long")
    # One row a column and one a rank: both sides are as small as the question.
    placed = counted.join(F.broadcast(start), "name").join(F.broadcast(asked), "name")
    first, past = F.col("_n_before") - F.col("_start"), F.col("_n_upto") - F.col("_start")
    found = placed.where((first <= F.col("rank")) & (F.col("rank") < past)).select("name", "rank", "value").collect()
    return {(r["name"], r["rank"]): r["value"] for r in found}


def select_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> dict[str, float | None]:
    """Exact quantiles ``name -> (column, probability)`` of a whole frame, without sorting its rows.

    One aggregate gives every quantile a bracket of two sketched values, a second one counts
    exactly what lies below, on and between them. Ranks on an end are answered by that; only where
    a rank lies inside a bracket are the values in there put in order. A sketch that misses its bounds
    shows as a rank outside, and the plain kernel answers then.
    """
    columns = sorted({column for column, _ in wanted.values()})
    # Read twice or three times below; what produced it should run once.
    rows = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    sketched = _sketched(rows, wanted)
    known = {n: (wanted[n][0], *ends) for n, ends in sketched.items() if ends is not None}
    out: dict[str, float | None] = dict.fromkeys(wanted)
    if not known:
        return out
    row = rows.agg(*[c for n, (column, low, high) in known.items() for c in _placed(n, column, low, high)]).first()
    at: dict[str, dict[int, float]] = {}
    inside: list[tuple[str, int]] = []
    for name, (_, low, high) in known.items():
        n, below = row[f"{name}__n"], row[f"{name}__below"]
        first = below + row[f"{name}__low"]
        last = first + row[f"{name}__between"]
        past = last + row[f"{name}__high"]
        position = wanted[name][1] * (n - 1)
        at[name] = {}
        for rank in {math.floor(position), math.ceil(position)}:
            if first <= rank < last:
                inside.append((name, rank - first))
            elif below - 1 <= rank <= past:
                at[name][rank] = row[f"{name}__before"] if rank < below else low if rank < first else high if rank < past else row[f"{name}__after"]
            else:
                return _sorted_quantiles(rows, wanted)
    if inside:
        names = {name for name, _ in inside}
        for (name, rank), value in _between(rows, {n: known[n] for n in names}, inside).items():
            at[name][rank + row[f"{name}__below"] + row[f"{name}__low"]] = value
    for name in known:
        position = wanted[name][1] * (row[f"{name}__n"] - 1)
        low, fraction = math.floor(position), position - math.floor(position)
        out[name] = (1 - fraction) * at[name][low] + fraction * at[name][math.ceil(position)]
    return out


def _sorted_quantiles(rows: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> dict[str, float | None]:
    """The same by one global order of all values."""
    pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("_name"), F.col(c).alias("_value")) for n, (c, _) in wanted.items()]))
    names = {f"q{i}": p for i, p in enumerate(sorted({p for _, p in wanted.values()}))}
    named = {p: q for q, p in names.items()}
    found = {r["_name"]: r for r in quantiles_by_running_totals(rows.select(pairs), ["_name"], "_value", names, few_groups=True).collect()}
    return {n: found[n][named[p]] if n in found else None for n, (_, p) in wanted.items()}


def grouped_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """Quantiles of ``value`` per group (at least one group column); empty groups are absent."""
    rows = df.select(*groups, F.col(value).cast("double").alias(value))
    return quantiles_by_running_totals(rows, groups, value, probabilities)


def quantile_list(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float | None]:
    """Several quantiles of one column over the whole frame, as driver-side numbers."""
    values = df.select(F.lit(0).alias("all"), F.col(column).cast("double").alias("value"))
    names = {f"q{i}": p for i, p in enumerate(probabilities)}
    row = quantiles_by_running_totals(values, ["all"], "value", names, few_groups=True).first()
    return [row[name] if row else None for name in names]


def column_quantiles(df: DataFrame, wanted: Mapping[str, float]) -> dict[str, float | None]:
    """One quantile per numeric column over the whole frame, as driver-side numbers.

    All columns are read off two aggregates of the rows as they are, without a row per column.
    """
    return select_quantiles(df, {column: (column, p) for column, p in wanted.items()})
