"""Names for columns that an operator adds beside those of its input."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, reserved: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns of ``reserved`` names (in any case) under free ones, and the
    expressions that give all columns their own names again."""
    taken = {c.lower() for c in docs.columns} | {r.lower() for r in reserved}
    clashing = {r.lower() for r in reserved}
    names = []
    for column in docs.columns:
        name = column
        while name.lower() in (clashing if name == column else taken):
            name += "_"
        taken.add(name.lower())
        names.append(name)
    if names == docs.columns:
        return docs, [F.col(_quoted(c)) for c in docs.columns]
    return docs.toDF(*names), [F.col(_quoted(a)).alias(c) for a, c in zip(names, docs.columns, strict=True)]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
