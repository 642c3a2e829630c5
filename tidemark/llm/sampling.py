"""Bounded, repeatable samples for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 32


def _point(key: str) -> Column:
    """A number in [0, 2^32) that depends on the key alone."""
    return F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(_RANGE))


def bounded_sample(df: DataFrame, key: str, rows: int, by: str | None = None) -> DataFrame:
    """About ``rows`` rows of ``df`` (of each value of ``by``), all of them if there are no more.

    A row is taken if the hash of its key falls under a share of the hash range, so the choice is
    the same however rows are dealt out and no order is needed. ``by`` must have few values.
    """
    if by is None:
        share = min(1.0, rows / max(df.count(), 1))
        return df.where(_point(key) < int(share * _RANGE))
    chosen = F.lit(False)
    for value, many in df.groupBy(by).count().collect():
        share = min(1.0, rows / many)
        chosen = chosen | (F.col(by).eqNullSafe(F.lit(value)) & (_point(key) < int(share * _RANGE)))
    return df.where(chosen)
