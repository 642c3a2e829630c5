"""Running totals, ranks and quantiles against plain Python, under several layouts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.quantiles import column_quantiles, grouped_quantiles, select_quantiles
from tidemark.operators.ranking import dominant, global_rank, running_totals


def hot_rows(n=2000, seed=5):
    """A third of all rows share one leading key."""
    rng = random.Random(seed)
    return [(7 if rng.random() < 0.34 else rng.randrange(200), f"{i:06d}", rng.randrange(10)) for i in range(n)]


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_running_totals_do_not_depend_on_layout(spark, partitions):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k int, id string, v int").repartition(partitions)
    got = running_totals(df, [F.col("k").desc(), "id"], {"v": "v"}).collect()
    total, expected = 0, {}
    for k, ident, v in sorted(rows, key=lambda r: (-r[0], r[1])):
        expected[ident] = (total, total + v)
        total += v
    assert {r["id"]: (r["v_before"], r["v_upto"]) for r in got} == expected


def test_slices_split_one_hot_key(spark):
    rows = [(1, f"{i:06d}") for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, id string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = global_rank(df, ["k", "id"]).collect()
        spread = df.repartitionByRange("k", "id").select(F.spark_partition_id().alias("p")).groupBy("p").count()
        assert spread.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["rank"] for r in sorted(ranked, key=lambda r: r["id"])] == list(range(5000))


def test_ranked_rows_move_once(spark):
    """Into their slices, before they are written down; after that only one row a slice is put in order."""
    rows = hot_rows()
    ranked = global_rank(spark.createDataFrame(rows, "k int, id string, v int"), [F.col("k").desc(), "id"])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1, plan
    assert ranked.columns == ["k", "id", "v", "rank"]
    got = {r["id"]: r["rank"] for r in ranked.collect()}
    assert got == {ident: i for i, (_, ident, _) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}


def test_dominant_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("o", "b", 5), ("o", "a", 3), ("o", "a", 2), ("p", "z", 1), ("p", None, 9)], "g string, m string, w int"
    )
    got = {r["g"]: r["top"] for r in dominant(df, ["g"], "m", F.sum("w"), "top").collect()}
    assert got == {"o": "a", "p": "z"}


def test_grouped_quantiles_of_a_hot_and_many_small_groups(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"g{i % 40}", rng.choice([rng.random(), 0.5])) for i in range(900)]
    rows.append(("none", None))
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: (r["m"], r["hi"]) for r in grouped_quantiles(df, ["g"], "v", {"m": 0.5, "hi": 0.995}).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g] == pytest.approx((np.quantile(values, 0.5), np.quantile(values, 0.995)))


def test_column_quantiles(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=301), rng.integers(0, 9, size=301).astype(float)
    rows = [(float(x), float(y) if i % 7 else None) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double").withColumn("empty", F.lit(None).cast("double"))
    got = column_quantiles(df, {"a": 0.5, "b": 0.5, "empty": 0.5})
    known = [y for i, y in enumerate(b) if i % 7]
    assert got["a"] == pytest.approx(np.median(a)) and got["b"] == pytest.approx(np.median(known))
    assert got["empty"] is None


@pytest.mark.parametrize("accuracy", [2_000, 20, 3])
def test_quantiles_with_ranks_inside_the_brackets(spark, monkeypatch, accuracy):
    """Coarse brackets leave many values inside; ties are among them."""
    from tidemark.operators import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = np.random.default_rng(accuracy)
    rows = [(float(rng.normal()), float(rng.integers(0, 4)), float(rng.exponential()) if i % 3 else None) for i in range(6_000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").withColumn("none", F.lit(None).cast("double")).repartition(7)
    wanted = {f"{c}{p}": (c, p) for c in "abc" for p in (0.0, 0.1, 0.5, 0.503, 0.99, 1.0)} | {"none": ("none", 0.5)}
    got = select_quantiles(df, wanted)
    for name, (column, p) in wanted.items():
        values = [] if column == "none" else [r["abc".index(column)] for r in rows if r["abc".index(column)] is not None]
        assert got[name] == (pytest.approx(np.quantile(values, p), abs=1e-12) if values else None), name
    assert column_quantiles(df.limit(0), {"a": 0.5}) == {"a": None}


def test_a_missed_bracket_is_answered_by_the_plain_kernel(spark, monkeypatch):
    from tidemark.operators import quantiles

    monkeypatch.setattr(quantiles, "_sketched", lambda rows, wanted: {n: (8.0, 8.0) for n in wanted})
    df = spark.createDataFrame([(float(v),) for v in range(9)], "v double")
    assert select_quantiles(df, {"m": ("v", 0.5), "q": ("v", 0.25)}) == {"m": 4.0, "q": 2.0}
