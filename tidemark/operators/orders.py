"""The analytical table: one row per delivered order, prediction-time facts only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import haversine_km
from tidemark.functions.scalars import route
from tidemark.functions.timing import days_between, month_start, whole_days
from tidemark.operators.geography import locate, state_centroids, zip_centroids
from tidemark.operators.population import delivered_orders, is_late
from tidemark.operators.rollups import order_rollup, payment_rollup
from tidemark.session import materialize
from tidemark.settings import PURCHASED_AT, DateWindow
from tidemark.sources.tables import RawTables

# Column order of the published table.
ANALYTICAL_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_unique_id",
    "order_purchase_timestamp",
    "purchase_month",
    "order_estimated_delivery_date",
    "promised_days",
    "is_late",
    "n_items",
    "n_distinct_products",
    "n_distinct_sellers",
    "n_seller_states",
    "total_price",
    "max_price",
    "total_freight",
    "total_weight_g",
    "total_volume_cm3",
    "max_item_weight_g",
    "max_item_volume_cm3",
    "dominant_category",
    "dominant_category_english",
    "max_shipping_limit_date",
    "days_to_shipping_limit",
    "dominant_payment_type",
    "max_installments",
    "total_payment_value",
    "n_payment_methods",
    "customer_state",
    "customer_zip_code_prefix",
    "customer_lat",
    "customer_lng",
    "customer_geo_source",
    "seller_id",
    "seller_state",
    "seller_zip_code_prefix",
    "seller_lat",
    "seller_lng",
    "seller_geo_source",
    "customer_seller_distance_km",
    "route",
)


def located_customers(raw: RawTables, zips: DataFrame, states: DataFrame) -> DataFrame:
    people = raw.customers.select(
        "customer_id", "customer_unique_id", "customer_state", "customer_zip_code_prefix"
    )
    return locate(people, "customer_zip_code_prefix", "customer_state", zips, states, "customer")


def located_sellers(raw: RawTables, zips: DataFrame, states: DataFrame) -> DataFrame:
    shops = raw.sellers.select("seller_id", "seller_state", "seller_zip_code_prefix")
    return locate(shops, "seller_zip_code_prefix", "seller_state", zips, states, "seller")


def orders_analytical(
    raw: RawTables,
    window: DateWindow,
    zips: DataFrame | None = None,
    states: DataFrame | None = None,
) -> DataFrame:
    """Join the rollups onto the population.

    Items and payments are reduced to one row per order before any join, so the order-keyed
    joins share one partitioning and none of them sees a repeated key. Customers are joined while
    the population is still narrow. Sellers are written down first: their measured size, not that
    of the joins behind them, says whether items and orders have to move to them.
    """
    zips = zip_centroids(raw.geolocation) if zips is None else zips
    states = state_centroids(raw.geolocation) if states is None else states
    population = delivered_orders(raw.orders, window).select(
        "order_id",
        "customer_id",
        PURCHASED_AT,
        "order_estimated_delivery_date",
        is_late().alias("is_late"),
    )
    sellers = materialize(located_sellers(raw, zips, states))
    english = raw.translation.select(
        F.col("product_category_name").alias("dominant_category"), "product_category_name_english"
    )
    purchased = F.col(PURCHASED_AT)
    return (
        population.join(located_customers(raw, zips, states), "customer_id")
        .join(order_rollup(raw.items, raw.products, sellers), "order_id")
        .join(payment_rollup(raw.payments), "order_id")
        .join(sellers, "seller_id")
        .join(english, "dominant_category", "left")
        .withColumns(
            {
                "purchase_month": month_start(purchased),
                "promised_days": whole_days(F.col("order_estimated_delivery_date"), purchased),
                "dominant_category_english": F.coalesce(
                    "product_category_name_english", "dominant_category"
                ),
                "days_to_shipping_limit": days_between(F.col("max_shipping_limit_date"), purchased),
                "customer_seller_distance_km": haversine_km(
                    F.col("seller_lat"), F.col("seller_lng"), F.col("customer_lat"), F.col("customer_lng")
                ),
                "route": route(F.col("seller_state"), F.col("customer_state")),
            }
        )
        .select(*ANALYTICAL_COLUMNS)
    )
