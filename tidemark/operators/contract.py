"""Table contracts: declared rules, counted in one pass, reported all at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import LAT_MAX, LAT_MIN, LNG_MAX, LNG_MIN
from tidemark.operators.orders import ANALYTICAL_COLUMNS
from tidemark.settings import LATE_RATE_BAND, POST_PURCHASE_COLUMNS


@dataclass(frozen=True)
class Rule:
    """A row rule. A null outcome passes, so nullability is a rule of its own."""

    name: str
    column: str
    holds: Column

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.holds, F.lit(True))


class ContractViolation(ValueError):
    """A table broke its contract; the message lists every rule broken."""


def not_null(column: str) -> Rule:
    return Rule("not_null", column, F.col(column).isNotNull())


def between(column: str, low, high) -> Rule:
    return Rule(f"between_{low}_{high}", column, F.col(column).between(low, high))


def at_least(column: str, low) -> Rule:
    return Rule(f"at_least_{low}", column, F.col(column) >= low)


def above(column: str, low) -> Rule:
    return Rule(f"above_{low}", column, F.col(column) > low)


def one_of(column: str, *values: str) -> Rule:
    return Rule("one_of", column, F.col(column).isin(*values))


def length_is(column: str, size: int) -> Rule:
    return Rule(f"length_{size}", column, F.length(column) == size)


def row_rule(name: str, holds: Column) -> Rule:
    return Rule(name, "*", holds)


@dataclass(frozen=True)
class Contract:
    """Closed columns, a unique key, row rules, and a band for the mean of one boolean."""

    columns: tuple[str, ...]
    key: tuple[str, ...]
    rules: tuple[Rule, ...]
    rate_column: str | None = None
    rate_band: tuple[float, float] = LATE_RATE_BAND
    forbidden: frozenset[str] = POST_PURCHASE_COLUMNS


def column_problems(df: DataFrame, contract: Contract) -> list[tuple[str, str, int]]:
    """Problems the schema alone reveals."""
    have = set(df.columns)
    problems = [("column_missing", c, 1) for c in contract.columns if c not in have]
    problems += [("column_undeclared", c, 1) for c in df.columns if c not in contract.columns]
    problems += [("column_forbidden", c, 1) for c in sorted(contract.forbidden & have)]
    return problems


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, column, n_bad) of every broken rule; empty when the table is clean.

    Row rules and the band share one aggregation; the key is a grouping of its own. Rules about
    missing columns are skipped, since the column's absence is already reported.
    """
    spark = df.sparkSession
    schema = "rule string, column string, n_bad bigint"
    problems = column_problems(df, contract)
    usable = [
        r for r in contract.rules if r.column in df.columns or (r.column == "*" and not problems)
    ]
    out = spark.createDataFrame(problems, schema)
    names = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"), F.col(f"r{i}").alias("n_bad"))
        for i, r in enumerate(usable)
    ]
    aggregates = [F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(usable)]
    if contract.rate_column in df.columns:
        low, high = contract.rate_band
        rate = F.avg(F.col(contract.rate_column).cast("int"))
        outside = ~F.coalesce(rate.between(low, high), F.lit(False))
        aggregates.append(outside.cast("bigint").alias("band"))
        names.append(
            F.struct(
                F.lit("rate_in_band").alias("rule"),
                F.lit(contract.rate_column).alias("column"),
                F.col("band").alias("n_bad"),
            )
        )
    if aggregates:
        counted = df.agg(*aggregates).select(F.inline(F.array(*names)))
        out = out.unionByName(counted.where(F.col("n_bad") > 0))
    if set(contract.key) <= set(df.columns):
        repeats = repeated_keys(df, contract.key).agg(F.sum(F.col("n") - 1).alias("n_bad"))
        out = out.unionByName(
            repeats.where(F.col("n_bad") > 0).select(
                F.lit("unique_key").alias("rule"), F.lit(",".join(contract.key)).alias("column"), "n_bad"
            )
        )
    return out


def enforce(df: DataFrame, contract: Contract, what: str) -> None:
    """Raise with all broken rules, before anything is written."""
    broken = violations(df, contract).orderBy("rule", "column").collect()
    if broken:
        listing = "; ".join(f"{r.rule}({r.column}): {r.n_bad}" for r in broken)
        raise ContractViolation(f"{what} breaks {len(broken)} rules: {listing}")


def failing_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with the names of the rules they break, for routing."""
    reasons = [F.when(r.broken, F.lit(f"{r.column}:{r.name}")) for r in rules]
    return df.withColumn("reasons", F.filter(F.array(*reasons), lambda r: r.isNotNull()))


# The published contract of the analytical table ------------------------------------

NULLABLE_COLUMNS = frozenset(
    {
        "total_weight_g",
        "total_volume_cm3",
        "max_item_weight_g",
        "max_item_volume_cm3",
        "dominant_category",
        "dominant_category_english",
        "customer_lat",
        "customer_lng",
        "seller_lat",
        "seller_lng",
        "customer_seller_distance_km",
    }
)


def value_rules(max_distance_km: float) -> list[Rule]:
    return [
        between("promised_days", 1, 365),
        between("n_items", 1, 50),
        at_least("n_distinct_products", 1),
        at_least("n_distinct_sellers", 1),
        at_least("n_seller_states", 1),
        above("total_price", 0),
        above("max_price", 0),
        at_least("total_freight", 0),
        at_least("total_weight_g", 0),
        at_least("total_volume_cm3", 0),
        at_least("max_item_weight_g", 0),
        above("max_item_volume_cm3", 0),
        at_least("days_to_shipping_limit", 0),
        between("max_installments", 0, 36),
        above("total_payment_value", 0),
        between("n_payment_methods", 1, 10),
        between("customer_lat", LAT_MIN, LAT_MAX),
        between("seller_lat", LAT_MIN, LAT_MAX),
        between("customer_lng", LNG_MIN, LNG_MAX),
        between("seller_lng", LNG_MIN, LNG_MAX),
        one_of("customer_geo_source", "zip", "state", "none"),
        one_of("seller_geo_source", "zip", "state", "none"),
        between("customer_seller_distance_km", 0.0, max_distance_km),
        length_is("customer_zip_code_prefix", 5),
        length_is("seller_zip_code_prefix", 5),
    ]


def two_letter_state_rules() -> list[Rule]:
    """Only where states are two-letter codes."""
    return [length_is("customer_state", 2), length_is("seller_state", 2), length_is("route", 6)]


# ------------------------------------------------------------------------------------------------


def invariants() -> list[Rule]:
    """Rules across columns of one row."""
    col = F.col
    return [
        row_rule("products_within_items", col("n_distinct_products") <= col("n_items")),
        row_rule("sellers_within_items", col("n_distinct_sellers") <= col("n_items")),
        row_rule("states_within_sellers", col("n_seller_states") <= col("n_distinct_sellers")),
        row_rule("max_price_within_total", col("max_price") <= col("total_price")),
        row_rule("max_weight_within_total", col("max_item_weight_g") <= col("total_weight_g")),
        row_rule("deadline_after_purchase", col("max_shipping_limit_date") >= col("order_purchase_timestamp")),
        row_rule("month_of_purchase", col("purchase_month") <= col("order_purchase_timestamp")),
        row_rule(
            "route_matches_states",
            col("route") == F.concat(col("seller_state"), F.lit("->"), col("customer_state")),
        ),
    ]


def analytical_contract(two_letter_states: bool = True, max_distance_km: float = 5000.0) -> Contract:
    """The contract of one country's orders: its state codes and its longest distance."""
    rules = [not_null(c) for c in ANALYTICAL_COLUMNS if c not in NULLABLE_COLUMNS]
    rules += value_rules(max_distance_km) + invariants()
    if two_letter_states:
        rules += two_letter_state_rules()
    return Contract(ANALYTICAL_COLUMNS, ("order_id",), tuple(rules), rate_column="is_late")


def star_contract() -> Contract:
    """The same contract for the star tables, whose points spread wider and whose states are names."""
    return analytical_contract(two_letter_states=False, max_distance_km=6000.0)


OUTCOME_COLUMNS = (
    "order_id",
    "order_delivered_customer_date",
    "order_delivered_carrier_date",
    "is_late",
    "delivery_days",
    "handling_days",
)


def outcome_rules() -> list[Rule]:
    return [
        not_null("order_id"),
        not_null("is_late"),
        at_least("delivery_days", 0),
        at_least("handling_days", 0),
        row_rule("handled_before_delivered", F.col("handling_days") <= F.col("delivery_days")),
    ]


def outcome_contract() -> Contract:
    return Contract(OUTCOME_COLUMNS, ("order_id",), tuple(outcome_rules()), forbidden=frozenset())


def require_conservation(entries: DataFrame) -> None:
    """Raise with every entry of a conservation ledger that does not add up."""
    broken = entries.where("NOT agrees").orderBy("entry").collect()
    if broken:
        listing = "; ".join(f"{r.entry}: {r.actual} instead of {r.expected}" for r in broken)
        raise ContractViolation(f"orders are not conserved: {listing}")


def count_agreement(counts: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several frames side by side, with whether they all agree."""
    parts = [df.agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, df in counts.items()]
    table = reduce(DataFrame.unionByName, parts)
    spread = table.agg(F.max("rows") - F.min("rows")).scalar()
    return table.withColumn("agrees", spread == 0)


def require_agreement(counts: dict[str, DataFrame]) -> None:
    rows = {r["table"]: r["rows"] for r in count_agreement(counts).collect()}
    if len(set(rows.values())) != 1:
        raise ContractViolation(f"row counts differ: {rows}")
