from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import contract as c
from tidemark.operators.population import funnel, order_outcomes
from tidemark.operators.rollups import order_rollup, payment_rollup
from tidemark.settings import MARKETPLACE

ROW = dict(
    order_id="o", customer_id="c", customer_unique_id="u", promised_days=10, n_items=2, n_distinct_products=2,
    n_distinct_sellers=1, n_seller_states=1, total_price=20.0, max_price=15.0, total_freight=3.0,
    total_weight_g=500.0, total_volume_cm3=900.0, max_item_weight_g=300.0, max_item_volume_cm3=600.0,
    dominant_category="x", dominant_category_english="y", days_to_shipping_limit=4.0,
    dominant_payment_type="voucher", max_installments=0, total_payment_value=23.0, n_payment_methods=1,
    customer_state="RJ", customer_zip_code_prefix="01234", customer_lat=-20.0, customer_lng=-45.0,
    customer_geo_source="zip", seller_id="s", seller_state="SP", seller_zip_code_prefix="04321",
    seller_lat=-23.0, seller_lng=-46.0, seller_geo_source="state", customer_seller_distance_km=300.0,
    route="SP->RJ",
)


def minimal(spark, **changes):
    """100 rows, 7 late; ``changes`` apply to the first row."""
    bought = datetime(2017, 5, 2, 10)
    rows = []
    for i in range(100):
        row = {**ROW, "order_id": f"o{i:03d}", "is_late": i < 7, **(changes if i == 0 else {})}
        row.setdefault("order_purchase_timestamp", bought)
        row["purchase_month"] = datetime(2017, 5, 1)
        row["order_estimated_delivery_date"] = bought + timedelta(days=10)
        row.setdefault("max_shipping_limit_date", bought + timedelta(days=4))
        rows.append(row)
    types = {"promised_days": "int", "n_items": "int", "is_late": "boolean"}
    def kind(name):
        if name in types:
            return types[name]
        sample = rows[1][name]
        return {"str": "string", "int": "int", "float": "double", "datetime": "timestamp_ntz"}[type(sample).__name__]
    schema = ", ".join(f"{n} {kind(n)}" for n in c.ANALYTICAL_COLUMNS)
    return spark.createDataFrame([tuple(r[n] for n in c.ANALYTICAL_COLUMNS) for r in rows], schema)


def broken(df):
    return {(r["rule"], r["column"]): r["n_bad"] for r in c.violations(df, c.analytical_contract()).collect()}


def test_clean_table_passes(spark):
    assert broken(minimal(spark)) == {}
    c.enforce(minimal(spark), c.analytical_contract(), "table")


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"promised_days": 0}, ("between_1_365", "promised_days")),
        ({"n_items": 51}, ("between_1_50", "n_items")),
        ({"customer_state": None}, ("not_null", "customer_state")),
        ({"seller_geo_source": "guess"}, ("one_of", "seller_geo_source")),
        ({"customer_zip_code_prefix": "123"}, ("length_5", "customer_zip_code_prefix")),
        ({"customer_lat": 50.0}, ("between_-34.0_6.0", "customer_lat")),
        ({"order_id": "o001"}, ("unique_key", "order_id")),
        ({"n_distinct_sellers": 3}, ("sellers_within_items", "*")),
        ({"max_price": 25.0}, ("max_price_within_total", "*")),
        ({"route": "RJ->SP"}, ("route_matches_states", "*")),
        ({"max_shipping_limit_date": datetime(2017, 5, 1)}, ("deadline_after_purchase", "*")),
    ],
)
def test_each_rule_is_seen(spark, change, rule):
    assert broken(minimal(spark, **change)).get(rule) == 1


def test_all_failures_are_reported_together(spark):
    df = minimal(spark, n_items=99, total_price=-1.0).withColumn("extra", F.lit(1)).withColumn("order_status", F.lit("delivered"))
    with pytest.raises(c.ContractViolation) as error:
        c.enforce(df, c.analytical_contract(), "table")
    for part in ("between_1_50(n_items)", "above_0(total_price)", "column_undeclared(extra)", "column_forbidden(order_status)"):
        assert part in str(error.value)


def test_rate_band_and_missing_column(spark):
    df = minimal(spark)
    assert broken(df.withColumn("is_late", F.lit(True)))[("rate_in_band", "is_late")] == 1
    assert broken(df.drop("route"))[("column_missing", "route")] == 1


def test_count_agreement(spark):
    a = spark.range(3)
    c.require_agreement({"a": a, "b": spark.range(3)})
    with pytest.raises(c.ContractViolation):
        c.require_agreement({"a": a, "b": spark.range(4)})


ORDERS = (
    "order_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)


def test_outcomes_and_dates(spark):
    bought, due = datetime(2017, 6, 1, 12), datetime(2017, 6, 11)
    rows = [
        ("same_day", "delivered", bought, datetime(2017, 6, 3), datetime(2017, 6, 11, 23), due),
        ("late", "delivered", bought, datetime(2017, 6, 3), datetime(2017, 6, 12), due),
        ("early_handoff", "delivered", bought, datetime(2017, 5, 1), datetime(2017, 6, 5), due),
        ("late_handoff", "delivered", bought, datetime(2017, 6, 6), datetime(2017, 6, 5), due),
        ("canceled", "canceled", bought, None, datetime(2017, 6, 5), due),
        ("undelivered", "delivered", bought, None, None, due),
        ("outside", "delivered", datetime(2018, 9, 1), None, datetime(2018, 9, 5), due),
        ("last_second", "delivered", datetime(2018, 8, 31, 23, 59, 59), None, datetime(2018, 9, 5), datetime(2018, 9, 9)),
    ]
    got = {r["order_id"]: r for r in order_outcomes(spark.createDataFrame(rows, ORDERS), MARKETPLACE.analysis).collect()}
    assert set(got) == {"same_day", "late", "early_handoff", "late_handoff", "last_second"}
    assert not got["same_day"]["is_late"] and got["late"]["is_late"]
    assert got["same_day"]["handling_days"] == pytest.approx(1.5)
    assert all(got[k]["handling_days"] is None for k in ("early_handoff", "late_handoff", "last_second"))


def test_funnel_counts_null_as_failing(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    rows = funnel(df, [("all", F.lit(True)), ("small", F.col("v") < 3), ("none", F.col("v") > 9), ("still none", F.lit(True))]).collect()
    assert [(r["n"], r["dropped"]) for r in rows] == [(3, 0), (1, 2), (0, 1), (0, 0)]
    assert rows[3]["kept_share"] is None


def test_rollup_of_one_giant_order(spark):
    at = datetime(2017, 6, 1)
    items = spark.createDataFrame(
        [("giant", i, f"p{i % 50}", f"s{i % 7}", at + timedelta(days=i % 5), "10.00", "1.25") for i in range(3000)]
        + [("small", 1, "p1", "s1", at, "3.10", "0.00")],
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz, price string, freight_value string",
    ).withColumns({c_: F.col(c_).cast("decimal(10,2)") for c_ in ("price", "freight_value")})
    products = spark.createDataFrame(
        [(f"p{i}", None if i == 1 else f"c{i % 3}", None if i == 1 else 100 + i, 2, 3, 4) for i in range(50)],
        "product_id string, product_category_name string, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int",
    )
    sellers = spark.createDataFrame([(f"s{i}", "AB"[i % 2]) for i in range(7)], "seller_id string, seller_state string")
    got = {r["order_id"]: r for r in order_rollup(items, products, sellers).collect()}
    giant, small = got["giant"], got["small"]
    assert (giant["n_items"], giant["n_distinct_products"], giant["n_distinct_sellers"], giant["n_seller_states"]) == (3000, 50, 7, 2)
    assert str(giant["total_price"]) == "30000.00" and str(giant["total_freight"]) == "3750.00"
    assert giant["seller_id"] == "s0" and giant["dominant_category"] == "c0"
    assert small["dominant_category"] is None and small["total_weight_g"] is None and str(small["max_price"]) == "3.10"


def test_payment_ties_go_to_the_first_name(spark):
    rows = [("o", 1, "voucher", 2, "5.00"), ("o", 2, "boleto", 0, "2.00"), ("o", 3, "boleto", 0, "3.00")]
    df = spark.createDataFrame(rows, "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value string")
    row = payment_rollup(df.withColumn("payment_value", F.col("payment_value").cast("decimal(10,2)"))).first()
    assert row["dominant_payment_type"] == "boleto" and row["n_payment_methods"] == 2 and row["max_installments"] == 2


def test_rollup_moves_no_row_a_facet(spark):
    items = spark.createDataFrame(
        [("o", "p", "s", datetime(2017, 6, 1), "1.00", "2.00")],
        "order_id string, product_id string, seller_id string, shipping_limit_date timestamp_ntz, price string, freight_value string",
    ).withColumns({c_: F.col(c_).cast("decimal(10,2)") for c_ in ("price", "freight_value")})
    products = spark.createDataFrame(
        [("p", "c", 1, 2, 3, 4)],
        "product_id string, product_category_name string, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int",
    )
    sellers = spark.createDataFrame([("s", "A")], "seller_id string, seller_state string")
    plan = order_rollup(items, products, sellers)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("facet" in line for line in moved)


def test_rollup_sorts_by_a_hash_of_the_order(spark):
    """Ids that share their first characters made every comparison of the sort a comparison of strings."""
    items = spark.createDataFrame(
        [("o", "p", "s", datetime(2017, 6, 1), "1.00", "2.00")],
        "order_id string, product_id string, seller_id string, shipping_limit_date timestamp_ntz, price string, freight_value string",
    ).withColumns({c_: F.col(c_).cast("decimal(10,2)") for c_ in ("price", "freight_value")})
    products = spark.createDataFrame(
        [("p", "c", 1, 2, 3, 4)],
        "product_id string, product_category_name string, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int",
    )
    rolled = order_rollup(items, products, spark.createDataFrame([("s", "A")], "seller_id string, seller_state string"))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "place" not in rolled.columns
    assert "Sort [place" in plan and not any("Exchange" in line and "place" in line for line in plan.splitlines())
