"""Report tables as Markdown. Only for tables whose length does not grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame


def markdown(df: DataFrame, title: str, intro: str = "") -> str:
    rows = df.collect()
    lines = [f"# {title}", ""] + ([intro, ""] if intro else [])
    lines.append("| " + " | ".join(df.columns) + " |")
    lines.append("|" + "---|" * len(df.columns))
    for row in rows:
        lines.append("| " + " | ".join("" if v is None else str(v) for v in row) + " |")
    return "\n".join(lines) + "\n"
