"""Small scalar expressions used by feature construction."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two sentinel levels every categorical carries.
MISSING = "__missing__"
UNKNOWN = "__unknown__"


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null where the denominator is null or zero."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def clip_upper(value: Column, bound: float | None) -> Column:
    """Cap at ``bound``. Null stays null, which ``least`` alone would not do."""
    if bound is None:
        return value
    return F.when(value.isNotNull(), F.least(value, F.lit(float(bound))))


def cap_levels(value: Column, levels: Iterable[str]) -> Column:
    """Map a raw category onto a frozen level set plus the two sentinels."""
    known = [level for level in levels if level not in (MISSING, UNKNOWN)]
    text = value.cast("string")
    return (
        F.when(text.isNull(), F.lit(MISSING))
        .when(text.isin(known) if known else F.lit(False), text)
        .otherwise(F.lit(UNKNOWN))
    )


def lookup(value: Column, mapping: Mapping[str, str]) -> Column:
    """Literal map lookup; null for a key the map lacks."""
    flat = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*flat), value)


def route(seller_state: Column, customer_state: Column) -> Column:
    return F.concat(seller_state, F.lit("->"), customer_state)
