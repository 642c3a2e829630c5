"""Registered queries against their SQL on the small tables. TIDEMARK_ALL=1 runs every one."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
CHOSEN = (
    "funnel order_outcomes order_rollup payment_rollup zip_centroid orders_analytical asof_route attach_history "
    "leaky_vs_correct ts_folds metric_summary threshold_sweep reliability_bins isotonic_calibration gate_checks "
    "feature_matrix csv_roundtrip record_routing order_exits order_conservation"
).split()


def names():
    return sorted(entry.oracle_sql()) if os.environ.get("TIDEMARK_ALL") else CHOSEN


def normal(rows):
    def text(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "~"
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    return sorted(tuple(text(v) for v in row) for row in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", names())
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    columns = sorted(df.columns)
    answer = duck.execute(entry.oracle_sql()[name])
    have = [d[0] for d in answer.description]
    rows = answer.fetchall()
    assert sorted(have) == columns
    order = [have.index(c) for c in columns]
    got = normal([tuple(r[c] for c in columns) for r in df.collect()])
    assert got == normal([tuple(r[i] for i in order) for r in rows])
    assert got
