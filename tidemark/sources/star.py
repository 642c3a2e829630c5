"""Adapter: order, item, payment and review tables from a star schema.

The star tables carry no promised or delivered dates, so those are derived with integer
arithmetic on the keys. Every row comes from a row of the given tables; nothing is sampled or
made up beside them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import RawTables

#: Nation names of the star tables to their region names: nation k belongs to region k mod 5.
STAR_REGION_NAMES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
STAR_REGIONS = {f"NATION_{k}": STAR_REGION_NAMES[k % 5] for k in range(25)}

#: Declared columns of the star tables; declaring them spares a schema-inference job per read.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


# Derived facts, as SQL expressions over the star columns.
PURCHASE = (
    "timestampadd(MINUTE, cast(o_custkey % 60 as int), timestampadd(HOUR, cast(o_orderkey % 24 as int), o_orderdate))"
)
DELIVERY = "(3 + (o_orderkey * 31 + o_custkey * 17) % 15 + if(o_custkey % 9 = 0, 14, 0))"


def ident(key: str) -> str:
    return f"lpad(cast({key} as string), 12, '0')"


def zip_text(number: str) -> str:
    return f"lpad(cast({number} * 97 as string), 5, '0')"


class StarTables(RawTables):
    """The nine raw tables, derived from a star-schema directory on first use."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{self.directory}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return (
            self._table("orders")
            .selectExpr("*", f"{PURCHASE} as purchase", f"{DELIVERY} as delivery")
            .selectExpr(
                f"{ident('o_orderkey')} as order_id",
                f"{ident('o_custkey')} as customer_id",
                "if(o_orderstatus = 'P' and o_orderkey % 3 = 0, 'canceled', 'delivered') as order_status",
                "purchase as order_purchase_timestamp",
                "timestampadd(HOUR, 1, purchase) as order_approved_at",
                """case when o_orderkey % 101 = 0 then null
                        when o_orderkey % 89 = 0 then timestampadd(DAY, -2, purchase)
                        else timestampadd(DAY, cast(1 + o_orderkey % 2 as int), purchase)
                   end as order_delivered_carrier_date""",
                """if(o_orderkey % 97 = 0, null,
                      timestampadd(HOUR, cast(o_orderkey % 7 as int),
                                   timestampadd(DAY, cast(delivery as int), purchase))
                   ) as order_delivered_customer_date""",
                """timestampadd(DAY, cast(16 + (o_orderkey * 13 + 7) % 15 as int), o_orderdate)
                   as order_estimated_delivery_date""",
            )
        )

    @cached_property
    def items(self) -> DataFrame:
        lines = self._table("lineitem").selectExpr(
            f"{ident('l_orderkey')} as order_id", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity"
        )
        # Joined on the published key, so that later work per order finds its rows in place.
        heads = self._table("orders").selectExpr(f"{ident('o_orderkey')} as order_id", f"{PURCHASE} as purchase")
        return lines.join(heads, "order_id").selectExpr(
            "order_id",
            "l_linenumber as order_item_id",
            f"{ident('l_partkey')} as product_id",
            f"{ident('l_suppkey')} as seller_id",
            "timestampadd(DAY, 2 + l_linenumber % 6, purchase) as shipping_limit_date",
            "cast(l_extendedprice as decimal(10,2)) as price",
            "cast(l_quantity as decimal(10,2)) as freight_value",
        )

    @cached_property
    def products(self) -> DataFrame:
        """Every fiftieth product is undescribed."""

        def known(value: str, name: str) -> str:
            return f"if(p_partkey % 50 = 0, null, {value}) as {name}"

        return self._table("part").selectExpr(
            f"{ident('p_partkey')} as product_id",
            known("p_brand || '/' || p_type", "product_category_name"),
            known("length(p_name)", "product_name_lenght"),
            known("length(p_name) * 10", "product_description_lenght"),
            known("cast(1 + p_partkey % 4 as int)", "product_photos_qty"),
            known("p_size * 100", "product_weight_g"),
            known("10 + p_size", "product_length_cm"),
            known("cast(5 + p_partkey % 30 as int)", "product_height_cm"),
            known("cast(8 + p_partkey % 17 as int)", "product_width_cm"),
        )

    @cached_property
    def translation(self) -> DataFrame:
        """Most categories have a translation; brands ending in 5 have none."""
        return (
            self._table("part")
            .where("p_brand not like '%5'")
            .selectExpr("p_brand || '/' || p_type as product_category_name")
            .distinct()
            .selectExpr(
                "product_category_name",
                "lower(translate(product_category_name, '#/', '__')) as product_category_name_english",
            )
        )

    def _with_nation(self, table: str, nation_key: str) -> DataFrame:
        nations = self._table("nation").selectExpr(f"n_nationkey as {nation_key}", "n_name")
        return self._table(table).join(nations, nation_key)

    @cached_property
    def customers(self) -> DataFrame:
        return self._with_nation("customer", "c_nationkey").selectExpr(
            f"{ident('c_custkey')} as customer_id",
            f"'u' || {ident('c_custkey')} as customer_unique_id",
            f"{zip_text('c_custkey % 997')} as customer_zip_code_prefix",
            "lower(n_name) as customer_city",
            "n_name as customer_state",
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return self._with_nation("supplier", "s_nationkey").selectExpr(
            f"{ident('s_suppkey')} as seller_id",
            f"{zip_text('s_suppkey % 997')} as seller_zip_code_prefix",
            "lower(n_name) as seller_city",
            "n_name as seller_state",
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One to three payments per order, all from the order's own key and total."""
        spread = self._table("orders").selectExpr(
            "o_orderkey", "o_totalprice", "explode(sequence(1, cast(1 + o_orderkey % 3 as int))) as seq"
        )
        return spread.selectExpr(
            f"{ident('o_orderkey')} as order_id",
            "seq as payment_sequential",
            """element_at(array('boleto', 'credit_card', 'debit_card', 'voucher'),
                          cast((o_orderkey + seq) % 4 + 1 as int)) as payment_type""",
            "cast((o_orderkey + seq) % 25 as int) as payment_installments",
            "cast(if(seq = 1, o_totalprice, seq * 10) as decimal(10,2)) as payment_value",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """One review for most orders, two for every tenth, none for a few."""
        spread = (
            self._table("orders")
            .where("o_orderkey % 40 <> 1")
            .selectExpr(
                "o_orderkey",
                "o_orderdate",
                f"{DELIVERY} as delivery",
                "explode(sequence(0, if(o_orderkey % 10 = 0, 1, 0))) as seq",
            )
        )
        return spread.selectExpr(
            f"{ident('o_orderkey')} || '-' || seq as review_id",
            f"{ident('o_orderkey')} as order_id",
            "cast(1 + (o_orderkey + delivery + seq) % 5 as int) as review_score",
            "cast(null as string) as review_comment_title",
            "cast(null as string) as review_comment_message",
            "timestampadd(DAY, cast(delivery as int), o_orderdate) as review_creation_date",
            "timestampadd(DAY, cast(delivery + 1 as int), o_orderdate) as review_answer_timestamp",
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """Three points per customer; some prefixes have none, some stray out of bounds."""
        points = self._with_nation("customer", "c_nationkey").selectExpr(
            "c_custkey % 997 as z", "n_name", "explode(array(0, 1, 2)) as j"
        )
        return points.where("z % 50 <> 0").selectExpr(
            f"{zip_text('z')} as geolocation_zip_code_prefix",
            "if(z % 61 = 0 and j >= 1, 41d, -30d + z % 35 + 0.25d * j) as geolocation_lat",
            "-70d + z % 40 + 0.25d * j as geolocation_lng",
            "lower(n_name) as geolocation_city",
            "n_name as geolocation_state",
        )
