"""Every raw order leaves by exactly one door, and a lost one stops the job."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import contract, ledger
from tidemark.operators.population import order_funnel
from tidemark.plans import jobs
from tidemark.settings import STAR
from tidemark.sources.star import StarTables

DAY = "2000-01-0{} 10:00:00"


@pytest.fixture(scope="module")
def raw(spark):
    def orders(*rows):
        text = "order_id string, customer_id string, order_status string, bought string, got string"
        return spark.createDataFrame(list(rows), text).select(
            "order_id",
            "customer_id",
            "order_status",
            F.col("bought").cast("timestamp_ntz").alias("order_purchase_timestamp"),
            F.col("got").cast("timestamp_ntz").alias("order_delivered_customer_date"),
        )

    good = ("delivered", DAY.format(1), DAY.format(5))
    return SimpleNamespace(
        orders=orders(
            ("kept", "c", *good),
            ("lost", "c", *good),
            ("canceled", "c", "canceled", *good[1:]),
            ("statusless", "c", None, *good[1:]),
            ("undated", "c", "delivered", DAY.format(1), None),
            ("early", "c", "delivered", "1990-01-01 00:00:00", DAY.format(5)),
            ("timeless", "c", "delivered", None, DAY.format(5)),
            ("empty", "c", *good),
            ("strange", "c", *good),
            ("unpaid", "c", *good),
            ("nobody", "x", *good),
            ("noone", None, *good),
        ),
        items=spark.createDataFrame(
            [(o, "p", "s") for o in ("kept", "kept", "lost", "unpaid", "nobody", "noone", "canceled")]
            + [("strange", "p", "unknown"), ("strange", "unknown", "s"), ("strange", None, "s"), ("kept", "unknown", "s")],
            "order_id string, product_id string, seller_id string",
        ),
        products=spark.createDataFrame([("p",)], "product_id string"),
        sellers=spark.createDataFrame([("s",)], "seller_id string"),
        customers=spark.createDataFrame([("c",)], "customer_id string"),
        payments=spark.createDataFrame([(o,) for o in ("kept", "kept", "lost", "strange", "nobody", "noone")], "order_id string"),
    )


def test_every_order_has_one_exit(spark, raw):
    published = spark.createDataFrame([("kept",)], "order_id string")
    exits = ledger.order_exits(raw, STAR.analysis, published)
    found = {r["order_id"]: r["exit"] for r in exits.collect()}
    assert exits.count() == len(found) == 12
    assert found == {
        "kept": "kept",
        "lost": "lost",
        "canceled": "not delivered",
        "statusless": "not delivered",
        "undated": "no delivery date",
        "early": "outside the window",
        "timeless": "outside the window",
        "empty": "no items",
        "strange": "no known item",
        "unpaid": "no payment",
        "nobody": "unknown customer",
        "noone": "unknown customer",
    }


def test_conservation_names_what_does_not_add_up(spark, raw):
    published = spark.createDataFrame([("kept",), ("unpaid",), ("invented",)], "order_id string")
    exits = ledger.order_exits(raw, STAR.analysis, published)
    entries = ledger.conservation(exits, order_funnel(raw.orders, STAR.analysis), {"table": published})
    broken = {r["entry"]: (r["expected"], r["actual"]) for r in entries.where("NOT agrees").collect()}
    assert broken == {
        "lost without a reason": (0, 1),
        "published in spite of a reason": (0, 1),
        "rows of table": (1, 3),
        "table without a raw order": (0, 1),
    }
    with pytest.raises(contract.ContractViolation, match="lost without a reason: 1 instead of 0"):
        contract.require_conservation(entries)


def test_conservation_of_nothing(spark, raw):
    none = SimpleNamespace(**{name: df.where("false") for name, df in vars(raw).items()})
    published = spark.createDataFrame([], "order_id string")
    entries = ledger.conservation(ledger.order_exits(none, STAR.analysis, published), order_funnel(none.orders, STAR.analysis), {"t": published})
    assert entries.where("agrees AND expected = 0").count() == entries.count() == 8


def test_a_lost_order_stops_the_job(spark, tmp_path, monkeypatch):
    whole = jobs.orders_analytical
    monkeypatch.setattr(jobs, "orders_analytical", lambda *a: whole(*a).where(F.xxhash64("order_id") % 50 != 0))
    with pytest.raises(contract.ContractViolation, match="lost without a reason"):
        jobs.orders_job(spark, StarTables(spark, SF_SMALL), STAR, str(tmp_path), contract.star_contract())


def test_outcome_rules_are_enforced(spark):
    rows = spark.createDataFrame([("a", None, None, True, -1.0, 2.0)], "order_id string, order_delivered_customer_date timestamp_ntz, order_delivered_carrier_date timestamp_ntz, is_late boolean, delivery_days double, handling_days double")
    with pytest.raises(contract.ContractViolation, match="handled_before_delivered"):
        contract.enforce(rows, contract.outcome_contract(), "order_outcomes")
