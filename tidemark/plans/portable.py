"""One result shape for two engines.

A result spec is text such as ``"order_id:s n:i rate:f late:b month:t"``. Integers widen to 64
bits, numbers become doubles rounded to six places, timestamps become text, so that equal
results are equal values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 6


def parse(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in spec.split()]


def _cast(name: str, kind: str) -> Column:
    col = F.col(name)
    if kind == "i":
        return col.cast("bigint")
    if kind == "f":
        return F.round(col.cast("double"), DIGITS) + F.lit(0.0)
    if kind == "b":
        return col.cast("boolean")
    return col.cast("string")


def portable(df: DataFrame, spec: str) -> DataFrame:
    return df.select(*[_cast(name, kind).alias(name) for name, kind in parse(spec)])


_SQL = {
    "i": "CAST({0} AS BIGINT)",
    "f": "round(CAST({0} AS DOUBLE), 6) + 0.0",
    "b": "CAST({0} AS BOOLEAN)",
    "s": "CAST({0} AS VARCHAR)",
    "t": "CAST({0} AS VARCHAR)",
}


def portable_sql(body: str, spec: str) -> str:
    columns = ", ".join(f'{_SQL[kind].format(chr(34) + name + chr(34))} AS "{name}"' for name, kind in parse(spec))
    return f"SELECT {columns} FROM ({body}) AS answer"
