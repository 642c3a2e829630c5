"""Expanding as-of snapshots and the joins that use them.

A snapshot for month M holds, per key, everything whose *outcome* was known strictly before the
first instant of M. It is built from monthly increments: one grouping of the resolved orders,
then a running sum per key over at most one row per month.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timing import add_months, exact_days_sums, mean_days, next_month_start, ntz
from tidemark.session import materialize_parts
from tidemark.settings import ENTITIES, LEVEL_OF_KEY, LEVELS, DateWindow

OUTCOME_AT = "order_delivered_customer_date"

# Metric names of every snapshot level, and those a cold entity may inherit.
METRICS = ("order_count", "late_rate", "avg_delivery_days", "avg_handling_days")
INHERITED = ("late_rate", "avg_delivery_days", "avg_handling_days")

#: Key text of the one group of the global level.
EVERYTHING = "*"


def resolved_history(analytical: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Finished orders with their entity keys. The purchase time is left out on purpose."""
    keys = [key for key in LEVELS.values() if key]
    facts = outcomes.select("order_id", OUTCOME_AT, "is_late", "delivery_days", "handling_days")
    return analytical.select("order_id", *keys).join(facts, "order_id").drop("order_id")


def snapshot_bounds(window: DateWindow) -> tuple[date, date]:
    """First and last snapshot month of a window of purchases."""
    return window.start.replace(day=1), window.end.replace(day=1)


def month_spine(df_or_spark, window: DateWindow) -> DataFrame:
    """One row per calendar month of the window."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    first, last = snapshot_bounds(window)
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("d")).select(
        F.col("d").cast("timestamp_ntz").alias("snapshot_month")
    )


def _level_pairs(levels: Iterable[str]) -> Column:
    """Array of (level, key) for one row; a null key yields no usable pair."""
    pairs = []
    for level in levels:
        key = LEVELS[level]
        text = F.lit(EVERYTHING) if key is None else F.col(key)
        pairs.append(F.struct(F.lit(level).alias("level"), text.alias("key")))
    return F.array(*pairs)


def monthly_increments(
    resolved: DataFrame, window: DateWindow, levels: Iterable[str] = tuple(LEVELS), known_at: str = OUTCOME_AT
) -> DataFrame:
    """Sums per (level, key, first month that may see them), all levels from one scan.

    Each row enters at the month after its outcome; outcomes before the first snapshot month
    enter there. Spreading a row over its levels and summing before the shuffle keeps the
    global level, and any hot key, down to one row per month and task.
    """
    first, last = snapshot_bounds(window)
    enters = F.greatest(next_month_start(F.col(known_at)), ntz(first))
    rows = (
        resolved.withColumn("enters", enters)
        .where(F.col("enters") <= ntz(last))
        .select("enters", "is_late", "delivery_days", "handling_days", F.inline(_level_pairs(levels)))
        .where(F.col("key").isNotNull())
    )
    d_seconds, d_micros, _ = exact_days_sums(F.col("delivery_days"))
    h_seconds, h_micros, h_count = exact_days_sums(F.col("handling_days"))
    return rows.groupBy("level", "key", "enters").agg(
        F.count("*").alias("n"),
        F.sum(F.col("is_late").cast("bigint")).alias("late"),
        d_seconds.alias("d_seconds"),
        d_micros.alias("d_micros"),
        F.count("delivery_days").alias("d_count"),
        h_seconds.alias("h_seconds"),
        h_micros.alias("h_micros"),
        h_count.alias("h_count"),
    )


SUMS = ("n", "late", "d_seconds", "d_micros", "d_count", "h_seconds", "h_micros", "h_count")


def snapshot_ledger(
    resolved: DataFrame, window: DateWindow, levels: Iterable[str] = tuple(LEVELS), known_at: str = OUTCOME_AT
) -> DataFrame:
    """All requested levels in one frame: (level, key, snapshot_month, metrics).

    The running sum touches only months in which a key changed; each such row is then repeated
    up to the key's next change. Months before a key was first seen do not exist.
    """
    _, last = snapshot_bounds(window)
    steps = monthly_increments(resolved, window, tuple(levels), known_at)
    by_key = Window.partitionBy("level", "key").orderBy("enters")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead("enters").over(by_key), add_months(ntz(last), 1))
    totals = steps.select(
        "level",
        "key",
        "enters",
        until.alias("until"),
        *[F.coalesce(F.sum(s).over(so_far), F.lit(0)).alias(s) for s in SUMS],
    )
    months = F.sequence(
        F.col("enters"), F.add_months("until", -1).cast("timestamp_ntz"), F.expr("interval 1 month")
    )
    return totals.withColumn("snapshot_month", F.explode(months)).select(
        "level",
        "key",
        "snapshot_month",
        F.col("n").alias("order_count"),
        (F.col("late") / F.col("n")).alias("late_rate"),
        mean_days(F.col("d_seconds"), F.col("d_micros"), F.col("d_count")).alias("avg_delivery_days"),
        mean_days(F.col("h_seconds"), F.col("h_micros"), F.col("h_count")).alias("avg_handling_days"),
    )


def _keyed(rows: DataFrame, level: str) -> DataFrame:
    key = LEVELS[level]
    keep = [F.col("key").alias(key)] if key else []
    return rows.select(*keep, "snapshot_month", *METRICS)


def level_snapshot(ledger: DataFrame, level: str) -> DataFrame:
    """One level under its own key name; the global level has no key."""
    return _keyed(ledger.where(F.col("level") == level), level)


def levels_of(ledger: DataFrame) -> dict[str, DataFrame]:
    return {level: level_snapshot(ledger, level) for level in LEVELS}


def stored_levels(ledger: DataFrame) -> dict[str, DataFrame]:
    """The levels as tables of their own, for joins.

    Taken from one frame they would all count as large as the largest, and the orders would move
    to states and categories as well as to sellers.
    """
    parts = materialize_parts(ledger, "level", LEVELS)
    return {level: _keyed(rows, level) for level, rows in parts.items()}


def expanding_snapshot(
    resolved: DataFrame, window: DateWindow, level: str, known_at: str = OUTCOME_AT
) -> DataFrame:
    """One level on its own."""
    return level_snapshot(snapshot_ledger(resolved, window, [level], known_at), level)


def recount_snapshot(
    resolved: DataFrame, window: DateWindow, level: str, known_at: str = OUTCOME_AT
) -> DataFrame:
    """The same snapshot by definition: an inequality join to the month spine.

    Emits every order once per later month, so it exists to check :func:`expanding_snapshot`.
    Orders move to their key before they are repeated: the repeats are then counted in place.
    """
    key = LEVELS[level]
    months = month_spine(resolved, window)
    rows = resolved.where(F.col(key).isNotNull()).repartition(key) if key else resolved
    pairs = rows.join(F.broadcast(months), F.col(known_at) < F.col("snapshot_month"))
    return pairs.groupBy(*([key] if key else []), "snapshot_month").agg(
        F.count("*").alias("order_count"),
        F.avg(F.col("is_late").cast("int")).alias("late_rate"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.avg("handling_days").alias("avg_handling_days"),
    )


def duplicate_keys(snapshot: DataFrame) -> DataFrame:
    """(key, month) pairs that occur twice; a join to such a snapshot would fan out."""
    keys = [c for c in snapshot.columns if c not in METRICS]
    return snapshot.groupBy(*keys).count().where(F.col("count") > 1)


def _attach_level(orders: DataFrame, snapshot: DataFrame, key: str | None, tag: str, month: str) -> DataFrame:
    renamed = snapshot.select(
        *([F.col(key).alias(f"{tag}key")] if key else []),
        F.col("snapshot_month").alias(f"{tag}month"),
        *[F.col(m).alias(f"{tag}{m}") for m in METRICS],
    )
    match = F.col(month) == F.col(f"{tag}month")
    if key:
        match = match & (F.col(key) == F.col(f"{tag}key"))
    else:
        renamed = F.broadcast(renamed)  # one row per month
    return orders.join(renamed, match, "left").drop(f"{tag}key", f"{tag}month")


def attach_history(
    orders: DataFrame, snapshots: Mapping[str, DataFrame], month: str = "purchase_month"
) -> DataFrame:
    """Add ``<entity>_<metric>_hist`` and ``<entity>_is_new`` for every entity.

    Each order reads the snapshot of its own purchase month. Where the entity has no value for a
    rate or a mean, the coarser level's is used and then the global one, metric by metric.
    Volume is never inherited, and ``is_new`` says whether the entity itself had any history.
    """
    # Finest first, so that rows which have to move to it do not carry the other levels' values.
    needed = list(dict.fromkeys(
        [LEVEL_OF_KEY[k] for e in ENTITIES for k in (e.key, e.fallback) if k] + ["global"]
    ))
    out = orders
    for level in needed:
        out = _attach_level(out, snapshots[level], LEVELS[level], f"_{level}__", month)

    for entity in ENTITIES:
        chain = [LEVEL_OF_KEY[entity.key]]
        if entity.fallback:
            chain.append(LEVEL_OF_KEY[entity.fallback])
        chain.append("global")
        own_count = F.col(f"_{chain[0]}__order_count")
        added = {f"{entity.name}_order_count_hist": F.coalesce(own_count, F.lit(0).cast("bigint"))}
        for metric in INHERITED:
            added[f"{entity.name}_{metric}_hist"] = F.coalesce(
                *[F.col(f"_{level}__{metric}") for level in chain]
            )
        added[f"{entity.name}_is_new"] = own_count.isNull()
        out = out.withColumns(added)
    return out.drop(*[f"_{level}__{m}" for level in needed for m in METRICS])


def attach_latest(orders: DataFrame, snapshots: Mapping[str, DataFrame], bundled: date) -> DataFrame:
    """Serving path: every order reads the one bundled month, whatever its own."""
    return attach_history(orders.withColumn("purchase_month", ntz(bundled)), snapshots)


def bundled_month(ledger: DataFrame, aggregates_through: date) -> date:
    """Latest snapshot month a model version may ship.

    Month M holds outcomes before M, so it is allowed as long as M is at most the day after
    ``aggregates_through``.
    """
    limit = F.date_add(F.lit(aggregates_through), 1).cast("timestamp_ntz")
    month = ledger.where(F.col("snapshot_month") <= limit).agg(F.max("snapshot_month")).first()[0]
    if month is None:
        raise ValueError(f"no snapshot month is allowed with aggregates through {aggregates_through}")
    return month.date()


def cold_start_rates(attached: DataFrame) -> DataFrame:
    """Share of orders whose entity had no history, per entity."""
    rates = attached.agg(*[F.avg(F.col(f"{e.name}_is_new").cast("int")).alias(e.name) for e in ENTITIES])
    return rates.unpivot([], [e.name for e in ENTITIES], "entity", "cold_start_rate")


def snapshot_sizes(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("level").agg(
        F.count("*").alias("rows"), F.count_distinct("snapshot_month").alias("months")
    )


def inflight_vs_resolved(analytical: DataFrame, outcomes: DataFrame, window: DateWindow) -> DataFrame:
    """Per cutoff month: late rate of orders already delivered and of those still under way.

    An order is under way from the month after its purchase until the month of its delivery, and
    resolved from the month after delivery on. Both are running sums of monthly arrivals, so no
    order is repeated per month.
    """
    first, last = snapshot_bounds(window)
    facts = analytical.select("order_id", "order_purchase_timestamp").join(
        outcomes.select("order_id", OUTCOME_AT, "is_late"), "order_id"
    )
    starts = F.greatest(next_month_start(F.col("order_purchase_timestamp")), ntz(first))
    resolves = F.greatest(next_month_start(F.col(OUTCOME_AT)), ntz(first))
    events = F.array(
        F.struct(starts.alias("month"), F.lit(1).alias("placed"), F.lit(0).alias("resolved")),
        F.struct(resolves.alias("month"), F.lit(0).alias("placed"), F.lit(1).alias("resolved")),
    )
    late = F.col("is_late").cast("int")
    changes = (
        facts.select(late.alias("late"), F.inline(events))
        .where(F.col("month") <= ntz(last))
        .groupBy("month")
        .agg(
            F.sum("placed").alias("placed"),
            F.sum(F.col("placed") * F.col("late")).alias("placed_late"),
            F.sum("resolved").alias("resolved"),
            F.sum(F.col("resolved") * F.col("late")).alias("resolved_late"),
        )
    )
    # One row per month of the window, quiet ones too, from the first with an order before it.
    counted = ("placed", "placed_late", "resolved", "resolved_late")
    months = month_spine(facts, window).withColumnRenamed("snapshot_month", "month").join(changes, "month", "left")
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = months.select(
        F.col("month").alias("cutoff_month"),
        *[F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(c) for c in counted],
    ).where(F.col("placed") > 0)
    inflight = F.col("placed") - F.col("resolved")
    return totals.select(
        "cutoff_month",
        F.col("resolved").alias("resolved_orders"),
        inflight.alias("inflight_orders"),
        (F.col("resolved_late") / F.nullif(F.col("resolved"), F.lit(0))).alias("resolved_late_rate"),
        ((F.col("placed_late") - F.col("resolved_late")) / F.nullif(inflight, F.lit(0))).alias(
            "inflight_late_rate"
        ),
    )


