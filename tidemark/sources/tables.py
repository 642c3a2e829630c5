"""The nine raw tables every later step reads."""

from __future__ import annotations

from pyspark.sql import DataFrame


class RawTables:
    """One attribute per raw table; subclasses say where the rows come from."""

    orders: DataFrame
    customers: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    sellers: DataFrame
    geolocation: DataFrame
    translation: DataFrame
