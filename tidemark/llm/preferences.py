"""Preference pairs: one prompt, two completions, and what of them is trained on.

The longest common prefix of turns of a chosen and a rejected conversation is rendered once as
the prompt; what follows in either is its completion. A completion's mask is the list of spans, in
code points of the rendered text, that an assistant wrote, with the mark that ends the turn;
everything else, such as later user turns, is context only.

Defined results: turns are equal if role and text are (null equals null); a null role is rendered
as ``unknown`` and null text as empty; turns are ordered by ``turn``, nulls first, ties by role and
text; repeated turns stay; identical conversations have empty completions; a pair with one side
only has an empty prompt and an empty other side; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
_EMPTY = "cast(array() as array<struct<turn:bigint,role:string,text:string>>)"


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"))


def _body(text: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t["role"]), _body(t["text"]))), "")


def _mask(turns: Column) -> Column:
    """Spans [begin, end) of the trained turns in the rendered ``turns``."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("spans"))

    def add(done: Column, t: Column) -> Column:
        begin = done["at"] + F.char_length(_head(t["role"]))
        end = begin + F.char_length(_body(t["text"]))
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        trained = F.coalesce(t["role"] == TRAINED_ROLE, F.lit(False))
        return F.struct(end.alias("at"), F.when(trained, F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda done: done["spans"])


def pairs(turns: DataFrame) -> DataFrame:
    """One row per pair from turns (pair_id, side ``chosen`` or ``rejected``, turn, role, text).

    A conversation is one record, as long as its turns are; pairs are spread by pair_id.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    sides = [F.sort_array(F.collect_list(F.when(F.col("side") == s, turn))).alias(s) for s in ("chosen", "rejected")]
    whole = turns.groupBy("pair_id").agg(*sides)
    least = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(
        F.slice("chosen", F.lit(1), least),
        F.slice("rejected", F.lit(1), least),
        lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]),
    )
    differs = F.array_position(same, False).cast("int")
    cut = whole.withColumn("n_common", F.when(differs > 0, differs - 1).otherwise(least))
    rest = [F.slice(s, F.col("n_common") + 1, F.size(s)).alias(s) for s in ("chosen", "rejected")]
    parts = cut.select("pair_id", "n_common", F.slice("chosen", F.lit(1), F.col("n_common")).alias("prompt"), *rest)
    return parts.select(
        "pair_id",
        "n_common",
        _render(F.col("prompt")).alias("prompt"),
        _render(F.col("chosen")).alias("chosen"),
        _render(F.col("rejected")).alias("rejected"),
        _mask(F.col("chosen")).alias("chosen_mask"),
        _mask(F.col("rejected")).alias("rejected_mask"),
    )
