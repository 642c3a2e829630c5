"""CSV landing on small generated files, and all-or-nothing publication."""

import pytest

from tidemark.sources.landing import SPECS, LandedTables, LandingError, land, preflight, scan_csv
from tidemark.sources.publish import publish_all, read_published

FILES = {
    "orders": ["o1,c1,delivered,2017-05-02 10:00:00,,2017-05-03 00:00:00,2017-05-09 00:00:00,2017-05-20 00:00:00"],
    "customers": ["c1,u1,01234,sao paulo,SP"],
    "order_items": ["o1,1,p1,s1,2017-05-06 10:00:00,10.50,2.00"],
    "order_payments": ["o1,1,voucher,1,12.50"],
    "order_reviews": ['r1,o1,5,"good ""thing""","two\nlines",2017-05-10 00:00:00,2017-05-11 00:00:00', "r2,o1,4,,,2017-05-10 00:00:00,2017-05-11 00:00:00"],
    "products": ["p1,,,,,500,10,10,10"],
    "sellers": ["s1,04321,rio,RJ"],
    "geolocation": ["01234,-23.5,-46.6,sao paulo,SP"] * 2,
    "product_category_name_translation": ["casa,house"],
}


def write_files(folder, change=None):
    for spec in SPECS:
        header, rows = ",".join(spec.names), FILES[spec.name]
        if change and change[0] == spec.name:
            header, rows = change[1](header), change[2](rows)
        text = header + "\n" + "\n".join(rows)
        if spec.name == "product_category_name_translation":
            text = "﻿" + text  # a byte-order mark and no final newline
        else:
            text += "\n"
        (folder / f"{spec.name}.csv").write_text(text, encoding="utf-8")


def same(x):
    return x


def test_land_reconciles_and_reads_back(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write_files(source)
    assert preflight(spark, str(source)).isEmpty()
    report = {r["table"]: (r["read"], r["inserted"]) for r in land(spark, str(source), root).collect()}
    assert report["order_reviews"] == (2, 2) and report["product_category_name_translation"] == (1, 1)
    tables = LandedTables(spark, root)
    reviews = {r["review_id"]: r for r in tables.reviews.collect()}
    assert reviews["r1"]["review_comment_message"] == "two\nlines" and reviews["r1"]["review_comment_title"] == 'good "thing"'
    assert reviews["r2"]["review_comment_message"] is None
    assert tables.customers.first()["customer_zip_code_prefix"] == "01234"
    assert dict(tables.orders.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    land(spark, str(source), root)  # a second landing replaces, it does not add
    assert LandedTables(spark, root).reviews.count() == 2


@pytest.mark.parametrize(
    ("table", "header", "rows", "words"),
    [
        ("order_items", lambda h: h.replace("price,freight_value", "freight_value,price"), same, "header"),
        ("sellers", same, lambda r: r * 2, "repeated_keys"),
        ("customers", same, lambda r: ["c1,,01234,x,SP"], "required_nulls"),
    ],
)
def test_a_bad_file_lands_nothing(spark, tmp_path, table, header, rows, words):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write_files(source, (table, header, rows))
    with pytest.raises(LandingError, match=words):
        land(spark, str(source), root)
    with pytest.raises(LookupError):
        read_published(spark, root, "orders")


def test_missing_file_and_reordered_scan(spark, tmp_path):
    write_files(tmp_path, ("sellers", lambda h: ",".join(reversed(h.split(","))), same))
    (tmp_path / "orders.csv").unlink()
    problems = {r["table"]: r["problem"] for r in preflight(spark, str(tmp_path)).collect()}
    assert problems["orders"] == "missing" and "header" in problems["sellers"]
    spec = next(s for s in SPECS if s.name == "sellers")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, spec, str(tmp_path / "sellers.csv")).collect()


def test_failed_check_keeps_the_last_good_tables(spark, tmp_path):
    root = str(tmp_path)
    publish_all(spark, root, {"a": spark.range(3), "b": spark.range(3)})

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        publish_all(spark, root, {"a": spark.range(9), "b": spark.range(9)}, check=refuse)
    assert read_published(spark, root, "a").count() == 3
    publish_all(spark, root, {"a": spark.range(5)})
    assert read_published(spark, root, "a").count() == 5 and read_published(spark, root, "b").count() == 3


def test_multisets_are_compared_row_by_row(spark):
    from tidemark.operators.reconcile import multiset_gap

    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "y"), (1, "x"), (3, "z")], "k int, v string")
    assert multiset_gap(a, b, ["k", "v"]).first()[0] == 2
    assert multiset_gap(a, a.repartition(3), ["k", "v"]).first()[0] == 0
    assert multiset_gap(a.where("false"), b.where("false"), ["k", "v"]).first()[0] == 0
