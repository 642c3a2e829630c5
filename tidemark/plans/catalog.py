"""Registered queries: every operator on the star tables, with its equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.geo import haversine_km
from tidemark.functions.timing import whole_days
from tidemark.operators import (
    asof,
    contract,
    decision,
    explain,
    features,
    learning,
    ledger,
    metrics,
    population,
    profile,
    reconcile,
    rollups,
    scoring,
    splits,
    versions,
)
from tidemark.operators.folds import fold_table, majority_folds, usable_rates
from tidemark.operators.geography import bounds_report, state_centroids, zip_centroids
from tidemark.operators.isotonic import fit_isotonic, isotonic_blocks
from tidemark.operators.orders import located_customers, located_sellers, orders_analytical
from tidemark.operators.preprocessing import (
    HistoryPreprocessor,
    PreprocessingModel,
    fit_levels,
    fit_medians,
    fit_winsor,
)
from tidemark.operators.ranking import global_rank
from tidemark.plans.oracle import NUMERIC, sql_for
from tidemark.plans.portable import portable
from tidemark.session import configure, materialize, scratch_folder
from tidemark.settings import CV_FOLDS, ENTITIES, GATE, LEVELS, PURCHASED_AT, STAR
from tidemark.sources.star import STAR_REGIONS, StarTables


class Stage:
    """Lazily built tables of one directory, each built once per query.

    Frames read more than once are materialized, as the jobs do by publishing them.
    """

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = configure(spark)
        self.directory = directory
        self.window = STAR.analysis
        self.fit = STAR.version("v1").fit
        self.calibrate = STAR.version("v1").calibrate

    @cached_property
    def raw(self) -> StarTables:
        return StarTables(self.spark, self.directory)

    @cached_property
    def plan_analytical(self) -> DataFrame:
        return orders_analytical(self.raw, self.window, self.zips, self.states)

    @cached_property
    def zips(self) -> DataFrame:
        return materialize(zip_centroids(self.raw.geolocation))

    @cached_property
    def states(self) -> DataFrame:
        return materialize(state_centroids(self.raw.geolocation))

    @cached_property
    def analytical(self) -> DataFrame:
        return materialize(self.plan_analytical)

    @cached_property
    def outcomes(self) -> DataFrame:
        return population.order_outcomes(self.raw.orders, self.window)

    @cached_property
    def resolved(self) -> DataFrame:
        return asof.resolved_history(self.analytical, self.outcomes)

    @cached_property
    def ledger(self) -> DataFrame:
        return materialize(asof.snapshot_ledger(self.resolved, self.window))

    @cached_property
    def levels(self) -> dict[str, DataFrame]:
        return asof.stored_levels(self.ledger)

    @cached_property
    def attached(self) -> DataFrame:
        return asof.attach_history(self.analytical, self.levels)

    @cached_property
    def fit_rows(self) -> DataFrame:
        return materialize(splits.select_window(self.attached, self.fit).select(*features.REQUIRED_INPUTS))

    @cached_property
    def preprocessor(self) -> PreprocessingModel:
        estimator = HistoryPreprocessor(
            self.ledger, STAR.version("v1").aggregates_through, self.fit.end, STAR_REGIONS
        )
        return estimator.fit(splits.select_window(self.attached, self.fit))

    @cached_property
    def scored(self) -> DataFrame:
        """Labels and three scores computed from what was known at purchase."""
        order, buyer = F.col("order_id").cast("bigint"), F.col("customer_id").cast("bigint")
        promised = whole_days(F.col("order_estimated_delivery_date"), F.col(PURCHASED_AT))
        slow = F.when(buyer % 9 == 0, 3).otherwise(0)
        return population.delivered_orders(self.raw.orders, self.window).select(
            "order_id",
            PURCHASED_AT,
            population.is_late().cast("int").alias("label"),
            (order * 7919 % 10007 / F.lit(10007.0)).alias("s_hash"),
            ((31 - promised) / F.lit(32.0)).alias("s_promise"),
            ((slow + order % 2) / F.lit(4.0)).alias("s_buyer"),
        )

    @cached_property
    def blended(self) -> DataFrame:
        score = decision.blend(["s_hash", "s_promise", "s_buyer"], [0.25, 0.25, 0.5])
        return self.scored.withColumn("score", score)

    @cached_property
    def curve(self) -> DataFrame:
        return metrics.ranking_curve(self.blended)


@dataclass(frozen=True)
class Query:
    name: str
    spec: str
    build: Callable[[Stage], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, directory: str) -> DataFrame:
        return portable(self.build(Stage(spark, directory)), self.spec)


QUERIES: dict[str, Query] = {}


def query(spec: str, sql: str | None = None, name: str | None = None):
    def register(build: Callable[[Stage], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = Query(key, spec, build, sql)
        return build

    return register


# --- raw tables ----------------------------------------------------------------------------------


def _raw_frames(s: Stage) -> dict[str, DataFrame]:
    """The nine raw tables by the name they are landed under."""
    return {
        "orders": s.raw.orders,
        "order_items": s.raw.items,
        "order_payments": s.raw.payments,
        "order_reviews": s.raw.reviews,
        "customers": s.raw.customers,
        "sellers": s.raw.sellers,
        "products": s.raw.products,
        "geolocation": s.raw.geolocation,
        "product_category_name_translation": s.raw.translation,
    }


@query(
    "table:s rows:i required_nulls:i repeated_keys:i",
    """SELECT 'orders' AS "table", count(*) AS rows, 0 AS required_nulls, count(*) - count(DISTINCT order_id) AS repeated_keys FROM t_orders
       UNION ALL SELECT 'order_items', count(*), 0, count(*) - count(DISTINCT (order_id, order_item_id)) FROM t_items
       UNION ALL SELECT 'order_payments', count(*), 0, count(*) - count(DISTINCT (order_id, payment_sequential)) FROM t_payments
       UNION ALL SELECT 'order_reviews', count(*), 0, count(*) - count(DISTINCT (review_id, order_id)) FROM t_reviews
       UNION ALL SELECT 'customers', count(*), 0, count(*) - count(DISTINCT customer_id) FROM t_customers
       UNION ALL SELECT 'sellers', count(*), 0, count(*) - count(DISTINCT seller_id) FROM t_sellers
       UNION ALL SELECT 'products', count(*), 0, count(*) - count(DISTINCT product_id) FROM t_products
       UNION ALL SELECT 'geolocation', count(*), 0, 0 FROM t_geo
       UNION ALL SELECT 'product_category_name_translation', count(*), count(*) FILTER (category IS NULL) + count(*) FILTER (english IS NULL),
                        count(*) - count(DISTINCT category) FROM t_translation""",
)
def raw_key_report(s: Stage) -> DataFrame:
    from functools import reduce

    from tidemark.sources.landing import SPEC_BY_NAME, key_report

    return reduce(DataFrame.unionByName, [key_report(df, SPEC_BY_NAME[n]) for n, df in _raw_frames(s).items()])


# --- population ----------------------------------------------------------------------------------


@query(
    "order_id:s customer_id:s order_purchase_timestamp:t is_late:b",
    "SELECT order_id, customer_id, order_purchase_timestamp, is_late FROM t_delivered",
    name="population",
)
def _population(s: Stage) -> DataFrame:
    return population.delivered_orders(s.raw.orders, s.window).withColumn("is_late", population.is_late())


@query(
    "step:i label:s n:i dropped:i kept_share:f",
    """SELECT step, label, n, coalesce(lag(n) OVER (ORDER BY step) - n, 0) AS dropped,
              coalesce(n::DOUBLE / lag(n) OVER (ORDER BY step), 1.0) AS kept_share FROM (
         SELECT 0 AS step, 'all raw orders' AS label, count(*) AS n FROM t_orders
         UNION ALL SELECT 1, 'status = ''delivered''', count(*) FROM t_orders WHERE order_status = 'delivered'
         UNION ALL SELECT 2, '+ delivery date not null', count(*) FROM t_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
         UNION ALL SELECT 3, '+ purchased inside the analysis window', count(*) FROM t_delivered) AS f""",
)
def funnel(s: Stage) -> DataFrame:
    return population.order_funnel(s.raw.orders, s.window)


@query(
    "orders:i late_rate_by_date:f late_rate_by_timestamp:f",
    """SELECT count(*) AS orders, avg(is_late::INT) AS late_rate_by_date,
              avg((order_delivered_customer_date > order_estimated_delivery_date)::INT) AS late_rate_by_timestamp FROM t_delivered""",
)
def label_rules(s: Stage) -> DataFrame:
    return population.label_rules(s.raw.orders, s.window)


@query(
    "order_id:s order_delivered_customer_date:t order_delivered_carrier_date:t is_late:b delivery_days:f handling_days:f",
    "SELECT * FROM t_outcomes",
)
def order_outcomes(s: Stage) -> DataFrame:
    return s.outcomes


# --- rollups -------------------------------------------------------------------------------------

ROLLUP_SPEC = (
    "order_id:s n_items:i n_distinct_products:i n_distinct_sellers:i n_seller_states:i total_price:f max_price:f "
    "total_freight:f total_weight_g:f total_volume_cm3:f max_item_weight_g:f max_item_volume_cm3:f max_shipping_limit_date:t"
)


@query(ROLLUP_SPEC, "SELECT * FROM t_rollup")
def order_rollup(s: Stage) -> DataFrame:
    return rollups.order_rollup(s.raw.items, s.raw.products, s.raw.sellers)


@query(
    "order_id:s dominant_payment_type:s max_installments:i total_payment_value:f n_payment_methods:i",
    "SELECT * FROM t_payment_rollup JOIN t_top_payment USING (order_id)",
)
def payment_rollup(s: Stage) -> DataFrame:
    return rollups.payment_rollup(s.raw.payments)


@query("order_id:s seller_id:s", "SELECT * FROM t_top_seller")
def dominant_seller(s: Stage) -> DataFrame:
    return rollups.dominant_seller(s.raw.items)


@query("order_id:s dominant_category:s", "SELECT * FROM t_top_category")
def dominant_category(s: Stage) -> DataFrame:
    return rollups.dominant_category(s.raw.items, s.raw.products)


@query("order_id:s dominant_payment_type:s", "SELECT * FROM t_top_payment")
def dominant_payment(s: Stage) -> DataFrame:
    return rollups.dominant_payment(s.raw.payments)


# --- geography -----------------------------------------------------------------------------------


@query(
    "points:i kept:i dropped:i",
    """SELECT count(*) AS points, (SELECT count(*) FROM t_points) AS kept,
              count(*) - (SELECT count(*) FROM t_points) AS dropped FROM t_geo""",
)
def geo_bounds(s: Stage) -> DataFrame:
    return bounds_report(s.raw.geolocation)


@query("zip_code_prefix:s lat:f lng:f state:s n_points:i", "SELECT * FROM t_zips")
def zip_centroid(s: Stage) -> DataFrame:
    return zip_centroids(s.raw.geolocation)


@query("state:s lat:f lng:f n_points:i", "SELECT * FROM t_states")
def state_centroid(s: Stage) -> DataFrame:
    return state_centroids(s.raw.geolocation)


@query(
    "customer_id:s customer_state:s customer_lat:f customer_lng:f customer_geo_source:s",
    "SELECT * FROM t_customer_geo",
)
def customer_location(s: Stage) -> DataFrame:
    return located_customers(s.raw, s.zips, s.states)


@query(
    "seller_id:s seller_state:s seller_lat:f seller_lng:f seller_geo_source:s", "SELECT * FROM t_seller_geo"
)
def seller_location(s: Stage) -> DataFrame:
    return located_sellers(s.raw, s.zips, s.states)


@query(
    "customer_geo_source:s customers:i",
    "SELECT customer_geo_source, count(*) AS customers FROM t_customer_geo GROUP BY 1",
)
def geo_fallback(s: Stage) -> DataFrame:
    return customer_location(s).groupBy("customer_geo_source").agg(F.count("*").alias("customers"))


@query(
    "geolocation_zip_code_prefix:s j:i km:f",
    """SELECT zip_code_prefix AS geolocation_zip_code_prefix, count(*) AS j,
              max(2 * 6371.0088 * asin(sqrt(least(1.0, sin(radians(-15.0 - lat) / 2) ** 2
                  + cos(radians(lat)) * cos(radians(-15.0)) * sin(radians(-50.0 - lng) / 2) ** 2)))) AS km
       FROM t_geo GROUP BY 1""",
)
def haversine(s: Stage) -> DataFrame:
    km = haversine_km(F.col("geolocation_lat"), F.col("geolocation_lng"), F.lit(-15.0), F.lit(-50.0))
    return s.raw.geolocation.groupBy("geolocation_zip_code_prefix").agg(
        F.count("*").alias("j"), F.max(km).alias("km")
    )


# --- the analytical table ------------------------------------------------------------------------

ANALYTICAL_SPEC = (
    "order_id:s customer_id:s customer_unique_id:s order_purchase_timestamp:t purchase_month:t "
    "order_estimated_delivery_date:t promised_days:i is_late:b n_items:i n_distinct_products:i n_distinct_sellers:i "
    "n_seller_states:i total_price:f max_price:f total_freight:f total_weight_g:f total_volume_cm3:f "
    "max_item_weight_g:f max_item_volume_cm3:f dominant_category:s dominant_category_english:s "
    "max_shipping_limit_date:t days_to_shipping_limit:f dominant_payment_type:s max_installments:i "
    "total_payment_value:f n_payment_methods:i customer_state:s customer_zip_code_prefix:s customer_lat:f "
    "customer_lng:f customer_geo_source:s seller_id:s seller_state:s seller_zip_code_prefix:s seller_lat:f "
    "seller_lng:f seller_geo_source:s customer_seller_distance_km:f route:s"
)


@query(ANALYTICAL_SPEC, "SELECT * FROM t_analytical", name="orders_analytical")
def _orders_analytical(s: Stage) -> DataFrame:
    return s.plan_analytical


@query(
    "order_id:s seller_id:s seller_state:s route:s customer_state:s dominant_category:s is_late:b delivery_days:f",
    "SELECT * FROM t_resolved",
)
def resolved_history(s: Stage) -> DataFrame:
    keys = [k for k in LEVELS.values() if k]
    facts = s.outcomes.select("order_id", "is_late", "delivery_days")
    return s.plan_analytical.select("order_id", *keys).join(facts, "order_id")


@query(
    "rule:s column:s n_bad:i",
    """SELECT 'length_5x' AS rule, 'route' AS "column", count(*) AS n_bad FROM t_analytical WHERE length(route) <> 20 HAVING count(*) > 0
       UNION ALL SELECT 'between_0.0_3000.0', 'customer_seller_distance_km', count(*) FROM t_analytical WHERE customer_seller_distance_km > 3000 HAVING count(*) > 0
       UNION ALL SELECT 'not_null', 'dominant_category', count(*) FROM t_analytical WHERE dominant_category IS NULL HAVING count(*) > 0
       UNION ALL SELECT 'at_least_18', 'promised_days', count(*) FROM t_analytical WHERE promised_days < 18 HAVING count(*) > 0""",
)
def contract_violations(s: Stage) -> DataFrame:
    """The published rules, which hold, plus four that some rows must break."""
    declared = contract.star_contract()
    tight = (
        contract.Rule("length_5x", "route", F.length("route") == 20),
        contract.between("customer_seller_distance_km", 0.0, 3000.0),
        contract.not_null("dominant_category"),
        contract.at_least("promised_days", 18),
    )
    strict = contract.Contract(
        declared.columns, declared.key, declared.rules + tight, declared.rate_column, declared.rate_band
    )
    return contract.violations(s.analytical, strict)


@query(
    "table:s rows:i agrees:b",
    """SELECT 'population' AS "table", count(*) AS rows, false AS agrees FROM t_delivered
       UNION ALL SELECT 'outcomes', count(*), false FROM t_outcomes
       UNION ALL SELECT 'analytical', count(*), false FROM t_analytical""",
)
def count_reconciliation(s: Stage) -> DataFrame:
    """Orders without items stay out of the analytical table, so the counts disagree here."""
    return contract.count_agreement(
        {
            "population": population.delivered_orders(s.raw.orders, s.window),
            "outcomes": s.outcomes,
            "analytical": s.plan_analytical,
        }
    )


EXITS_SQL = """
  SELECT o.order_id, CASE
    WHEN o.order_status IS DISTINCT FROM 'delivered' THEN 'not delivered'
    WHEN o.order_delivered_customer_date IS NULL THEN 'no delivery date'
    WHEN NOT EXISTS (SELECT 1 FROM t_delivered d WHERE d.order_id = o.order_id) THEN 'outside the window'
    WHEN NOT EXISTS (SELECT 1 FROM t_items i WHERE i.order_id = o.order_id) THEN 'no items'
    WHEN NOT EXISTS (SELECT 1 FROM t_lines l WHERE l.order_id = o.order_id) THEN 'no known item'
    WHEN NOT EXISTS (SELECT 1 FROM t_payments p WHERE p.order_id = o.order_id) THEN 'no payment'
    WHEN NOT EXISTS (SELECT 1 FROM t_customers c WHERE c.customer_id = o.customer_id) THEN 'unknown customer'
    ELSE 'kept' END AS "exit"
  FROM t_orders o"""


@query("exit:s orders:i", f'SELECT "exit", count(*) AS orders FROM ({EXITS_SQL}) AS e GROUP BY 1')
def order_exits(s: Stage) -> DataFrame:
    return ledger.exit_counts(ledger.order_exits(s.raw, s.window, s.analytical))


@query(
    "entry:s expected:i actual:i agrees:b",
    f"""WITH e AS ({EXITS_SQL}), n AS (
         SELECT count(*) AS a, count(*) FILTER ("exit" <> 'not delivered') AS d,
                count(*) FILTER ("exit" NOT IN ('not delivered', 'no delivery date')) AS t,
                count(*) FILTER ("exit" NOT IN ('not delivered', 'no delivery date', 'outside the window')) AS w,
                count(*) FILTER ("exit" = 'kept') AS k FROM e),
       c AS (
         SELECT 'all raw orders' AS entry, a AS expected, (SELECT count(*) FROM t_orders) AS actual FROM n
         UNION ALL SELECT 'status = ''delivered''', d, (SELECT count(*) FROM t_orders WHERE order_status = 'delivered') FROM n
         UNION ALL SELECT '+ delivery date not null', t, (SELECT count(*) FROM t_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL) FROM n
         UNION ALL SELECT '+ purchased inside the analysis window', w, (SELECT count(*) FROM t_delivered) FROM n
         UNION ALL SELECT 'rows of analytical', k, (SELECT count(*) FROM t_analytical) FROM n
         UNION ALL SELECT 'rows of outcomes', k, (SELECT count(*) FROM t_outcomes) FROM n
         UNION ALL SELECT 'lost without a reason', 0, (SELECT count(*) FROM e WHERE "exit" = 'kept' AND order_id NOT IN (SELECT order_id FROM t_analytical))
         UNION ALL SELECT 'published in spite of a reason', 0, (SELECT count(*) FROM e WHERE "exit" <> 'kept' AND order_id IN (SELECT order_id FROM t_analytical))
         UNION ALL SELECT 'analytical without a raw order', 0, (SELECT count(*) FROM t_analytical WHERE order_id NOT IN (SELECT order_id FROM t_orders))
         UNION ALL SELECT 'outcomes without a raw order', 0, (SELECT count(*) FROM t_outcomes WHERE order_id NOT IN (SELECT order_id FROM t_orders)))
       SELECT *, expected = actual AS agrees FROM c""",
)
def order_conservation(s: Stage) -> DataFrame:
    """Against the outcomes of all delivered orders, whose count differs by the orders not kept."""
    exits = materialize(ledger.order_exits(s.raw, s.window, s.analytical))
    funnel_rows = population.order_funnel(s.raw.orders, s.window)
    return ledger.conservation(exits, funnel_rows, {"analytical": s.analytical, "outcomes": s.outcomes})


# --- as-of history -------------------------------------------------------------------------------

SNAPSHOT_SPEC = "snapshot_month:t order_count:i late_rate:f avg_delivery_days:f avg_handling_days:f"


def _register_snapshot(level: str, key: str | None) -> None:
    spec = (f"{key}:s " if key else "") + SNAPSHOT_SPEC

    def build(s: Stage) -> DataFrame:
        resolved = asof.resolved_history(s.plan_analytical, s.outcomes)
        return asof.expanding_snapshot(resolved, s.window, level)

    query(spec, f"SELECT * FROM t_snap_{level}", name=f"asof_{level}")(build)


for _level, _key in LEVELS.items():
    _register_snapshot(_level, _key)


@query(
    "level:s rows:i months:i",
    " UNION ALL ".join(
        f"SELECT '{level}' AS level, count(*) AS rows, count(DISTINCT snapshot_month) AS months FROM t_snap_{level}"
        for level in LEVELS
    ),
)
def snapshot_sizes(s: Stage) -> DataFrame:
    return asof.snapshot_sizes(asof.snapshot_ledger(s.resolved, s.window))


HISTORY_SPEC = " ".join(
    " ".join(f"{e.name}_{m}_hist:{'i' if m == 'order_count' else 'f'}" for m in asof.METRICS)
    + f" {e.name}_is_new:b"
    for e in ENTITIES
)


@query(f"order_id:s {HISTORY_SPEC}", "SELECT * FROM t_attached")
def attach_history(s: Stage) -> DataFrame:
    return s.attached


@query(f"order_id:s {HISTORY_SPEC}", "SELECT * FROM t_attached_2000")
def attach_latest(s: Stage) -> DataFrame:
    month = asof.bundled_month(s.ledger, STAR.version("v1").aggregates_through)
    bundled = s.ledger.where(F.col("snapshot_month") == F.lit(str(month)).cast("timestamp_ntz"))
    return asof.attach_latest(s.analytical, asof.stored_levels(bundled), month)


@query(
    "bundled_month:t",
    """SELECT max(snapshot_month) AS bundled_month FROM t_snap_global
       WHERE snapshot_month <= TIMESTAMP '1999-12-31' + INTERVAL 1 DAY""",
)
def bundled_month(s: Stage) -> DataFrame:
    ledger = asof.snapshot_ledger(s.resolved, s.window)
    month = asof.bundled_month(ledger, STAR.version("v1").aggregates_through)
    return ledger.where(F.col("snapshot_month") == F.lit(str(month)).cast("timestamp_ntz")).agg(
        F.max("snapshot_month").alias("bundled_month")
    )


@query(
    "entity:s cold_start_rate:f",
    " UNION ALL ".join(
        f"SELECT '{e.name}' AS entity, avg({e.name}_is_new::INT) AS cold_start_rate FROM t_attached"
        for e in ENTITIES
    ),
)
def cold_start_rate(s: Stage) -> DataFrame:
    return asof.cold_start_rates(s.attached)


@query(
    "differing:i only_in_a:i only_in_b:i order_count_differs:i",
    "SELECT 0 AS differing, 0 AS only_in_a, 0 AS only_in_b, 0 AS order_count_differs FROM t_months LIMIT 1",
)
def snapshot_recount(s: Stage) -> DataFrame:
    """Running-sum snapshots against the inequality-join recount: nothing may differ."""
    built = asof.expanding_snapshot(s.resolved, s.window, "seller")
    recount = asof.recount_snapshot(s.resolved, s.window, "seller")
    tolerances = {"order_count": None, "late_rate": 1e-9, "avg_delivery_days": 1e-9, "avg_handling_days": 1e-9}
    return reconcile.reconciliation(built, recount, ["seller_id", "snapshot_month"], tolerances)


@query(
    "differing_rows:i extra_contributions:i",
    """SELECT count(*) FILTER (WHERE a.order_count IS DISTINCT FROM b.order_count) AS differing_rows,
              sum(coalesce(b.order_count, 0) - coalesce(a.order_count, 0)) AS extra_contributions
       FROM t_snap_seller a FULL JOIN (SELECT seller_id, snapshot_month, count(*) AS order_count
            FROM t_resolved JOIN t_months ON order_purchase_timestamp < snapshot_month GROUP BY 1, 2) b
       USING (seller_id, snapshot_month)""",
)
def leaky_vs_correct(s: Stage) -> DataFrame:
    """What filtering on purchase time instead of outcome time would let in."""
    leaky = asof.resolved_history(s.analytical, s.outcomes.join(
        s.analytical.select("order_id", F.col(PURCHASED_AT).alias("bought")), "order_id"
    ).withColumn(asof.OUTCOME_AT, F.col("bought")))
    right = asof.expanding_snapshot(s.resolved, s.window, "seller")
    wrong = asof.expanding_snapshot(leaky, s.window, "seller")
    rows = reconcile.differences(right, wrong, ["seller_id", "snapshot_month"], {"order_count": None})
    return rows.agg(
        F.count("*").alias("differing_rows"),
        F.sum(F.coalesce("b_order_count", F.lit(0)) - F.coalesce("a_order_count", F.lit(0))).alias(
            "extra_contributions"
        ),
    )


@query(
    "cutoff_month:t resolved_orders:i inflight_orders:i resolved_late_rate:f inflight_late_rate:f",
    """SELECT snapshot_month AS cutoff_month, count(*) FILTER (WHERE done) AS resolved_orders,
              count(*) FILTER (WHERE NOT done) AS inflight_orders,
              avg(is_late::INT) FILTER (WHERE done) AS resolved_late_rate,
              avg(is_late::INT) FILTER (WHERE NOT done) AS inflight_late_rate
       FROM (SELECT snapshot_month, is_late, order_delivered_customer_date < snapshot_month AS done
             FROM t_resolved JOIN t_months ON order_purchase_timestamp < snapshot_month) AS e GROUP BY 1""",
)
def inflight_vs_resolved(s: Stage) -> DataFrame:
    return asof.inflight_vs_resolved(s.analytical, s.outcomes, s.window)


@query(
    "correct:f leaky:f inflation:f",
    """SELECT corr(c, y) AS correct, corr(l, y) AS leaky, corr(l, y) / corr(c, y) AS inflation FROM (
         SELECT a.is_late::INT::DOUBLE AS y, c.late_rate AS c, l.late_rate AS l FROM t_analytical a
         LEFT JOIN t_snap_seller c ON c.seller_id = a.seller_id AND c.snapshot_month = purchase_month
         LEFT JOIN (SELECT seller_id, snapshot_month, avg(is_late::INT) AS late_rate FROM t_resolved
                    JOIN t_months ON order_purchase_timestamp < snapshot_month GROUP BY 1, 2) l
           ON l.seller_id = a.seller_id AND l.snapshot_month = purchase_month) AS j
       WHERE c IS NOT NULL AND l IS NOT NULL""",
)
def feature_corr(s: Stage) -> DataFrame:
    """Correlation of a seller's history with the label, under the right and the leaky rule."""
    leaky = s.analytical.select("order_id", "seller_id", F.col(PURCHASED_AT).alias(asof.OUTCOME_AT)).join(
        s.outcomes.select("order_id", "is_late", "delivery_days", "handling_days"), "order_id"
    )
    right = asof.expanding_snapshot(s.resolved, s.window, "seller")
    wrong = asof.expanding_snapshot(leaky, s.window, "seller")

    def rates(snapshot: DataFrame, name: str) -> DataFrame:
        return snapshot.select(
            "seller_id", F.col("snapshot_month").alias("purchase_month"), F.col("late_rate").alias(name)
        )

    keys = ["seller_id", "purchase_month"]
    joined = s.analytical.select(*keys, "is_late").join(rates(right, "c"), keys).join(rates(wrong, "l"), keys)
    label = F.col("is_late").cast("int")
    known = joined.where(F.col("c").isNotNull() & F.col("l").isNotNull())
    pairs = {"correct": (F.col("c"), label), "leaky": (F.col("l"), label)}
    return profile.correlations(known, pairs).withColumn("inflation", F.col("leaky") / F.col("correct"))


@query(
    "feature:s share_changed:f mean_abs_change:f",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, avg((a.{c} IS DISTINCT FROM b.{c})::INT) AS share_changed, avg(abs(a.{c} - b.{c})) AS mean_abs_change
            FROM t_attached_1999 a JOIN t_attached_2000 b USING (order_id)"""
        for c in profile.history_columns()
    ),
)
def history_drift(s: Stage) -> DataFrame:
    from datetime import date

    # Rates differ in the last bit between engines; compare what six places can show.
    rounded = {c: F.round(c, 9) for c in profile.history_columns()}

    def at(orders: DataFrame, month: date) -> DataFrame:
        rows = s.ledger.where(F.col("snapshot_month") == F.lit(str(month)).cast("timestamp_ntz"))
        return asof.attach_latest(orders, asof.stored_levels(rows), month).withColumns(rounded)

    # The second month is attached to what has the first, so that no order is moved to find itself.
    first = at(s.analytical, date(1999, 1, 1)).withColumnsRenamed({c: f"before_{c}" for c in rounded})
    return profile.history_drift(at(first, date(2000, 1, 1)), "before_")


# --- windows and splits --------------------------------------------------------------------------


@query(
    "window:s rows:i late_rate:f",
    " UNION ALL ".join(
        f"""SELECT '{w.name}' AS "window", count(*) AS rows, avg(is_late::INT) AS late_rate FROM t_delivered
            WHERE order_purchase_timestamp >= TIMESTAMP '{w.start}' AND order_purchase_timestamp < TIMESTAMP '{w.stop}'"""
        for w in STAR.named_windows("counts")
    ),
)
def window_counts(s: Stage) -> DataFrame:
    rows = population.delivered_orders(s.raw.orders, s.window).withColumn("is_late", population.is_late())
    return splits.window_counts(rows, STAR)


FIT_SQL = """SELECT order_id, order_purchase_timestamp, is_late, row_number() OVER (ORDER BY order_purchase_timestamp, order_id) - 1 AS rank,
        count(*) OVER () AS n FROM t_delivered
        WHERE order_purchase_timestamp >= TIMESTAMP '1997-01-01' AND order_purchase_timestamp < TIMESTAMP '1999-07-01'"""


def _fit_orders(s: Stage) -> DataFrame:
    rows = splits.select_window(population.delivered_orders(s.raw.orders, s.window), s.fit)
    return rows.select("order_id", PURCHASED_AT, population.is_late().alias("is_late"))


def _calibrate_orders(s: Stage) -> DataFrame:
    rows = splits.select_window(population.delivered_orders(s.raw.orders, s.window), s.calibrate)
    return rows.select("order_id", PURCHASED_AT, population.is_late().alias("is_late"))


@query("order_id:s rank:i", f"SELECT order_id, rank FROM ({FIT_SQL}) AS r")
def window_rank(s: Stage) -> DataFrame:
    return global_rank(_fit_orders(s), splits.TOTAL_ORDER)


@query(
    "fold:i validate_rows:i positive_rate:f train_rows:i",
    f"""SELECT (rank - (n - 4 * (n // 5))) // (n // 5) + 1 AS fold, count(*) AS validate_rows, avg(is_late::INT) AS positive_rate, min(rank) AS train_rows
        FROM ({FIT_SQL}) AS r WHERE rank >= n - 4 * (n // 5) GROUP BY 1""",
)
def ts_folds(s: Stage) -> DataFrame:
    return splits.fold_sizes(splits.time_folds(_fit_orders(s)))


@query("order_id:s first_half:b", f"SELECT order_id, rank % 2 = 0 AS first_half FROM ({FIT_SQL}) AS r")
def interleaved_split(s: Stage) -> DataFrame:
    return splits.halves(_fit_orders(s))


@query("order_id:s first_half:b", f"SELECT order_id, rank < n // 2 AS first_half FROM ({FIT_SQL}) AS r")
def temporal_split(s: Stage) -> DataFrame:
    return splits.halves(_fit_orders(s), "temporal")


@query("order_id:s is_tail:b", f"SELECT order_id, rank >= floor(n * (1.0::DOUBLE - 0.15::DOUBLE)) AS is_tail FROM ({FIT_SQL}) AS r")
def tail_holdout(s: Stage) -> DataFrame:
    return splits.with_tail(_fit_orders(s))


@query("violations:i", f"SELECT 0 AS violations FROM ({FIT_SQL}) AS r LIMIT 1")
def order_check(s: Stage) -> DataFrame:
    return splits.out_of_order(global_rank(_fit_orders(s), splits.TOTAL_ORDER))


@query(
    "fit_rows:i calibrate_rows:i fit_max:t calibrate_min:t calibrate_max:t evaluation_start:t ordered:b",
    """SELECT count(*) FILTER (WHERE f) AS fit_rows, count(*) FILTER (WHERE c) AS calibrate_rows,
              max(t) FILTER (WHERE f) AS fit_max, min(t) FILTER (WHERE c) AS calibrate_min, max(t) FILTER (WHERE c) AS calibrate_max,
              TIMESTAMP '2000-07-01' AS evaluation_start, max(t) FILTER (WHERE f) < min(t) FILTER (WHERE c) AS ordered
       FROM (SELECT order_purchase_timestamp AS t, order_purchase_timestamp >= TIMESTAMP '1997-01-01' AND order_purchase_timestamp < TIMESTAMP '1999-07-01' AS f,
                    order_purchase_timestamp >= TIMESTAMP '1999-07-01' AND order_purchase_timestamp < TIMESTAMP '2000-01-01' AS c FROM t_delivered) AS w""",
)
def temporal_bounds(s: Stage) -> DataFrame:
    return splits.temporal_bounds(population.delivered_orders(s.raw.orders, s.window), STAR, "v1")


@query(
    "fit_ids:i calibrate_ids:i shared_ids:i",
    """SELECT count(*) FILTER (WHERE order_purchase_timestamp >= TIMESTAMP '1997-01-01' AND order_purchase_timestamp < TIMESTAMP '1999-07-01') AS fit_ids,
              count(*) FILTER (WHERE order_purchase_timestamp >= TIMESTAMP '1999-07-01' AND order_purchase_timestamp < TIMESTAMP '2000-01-01') AS calibrate_ids,
              0 AS shared_ids FROM t_delivered""",
)
def disjoint_windows(s: Stage) -> DataFrame:
    fit, calibrate = _fit_orders(s), _calibrate_orders(s)
    return fit.agg(F.count("*").alias("fit_ids")).withColumns(
        {
            "calibrate_ids": calibrate.agg(F.count("*")).scalar(),
            "shared_ids": reconcile.shared_keys(fit, calibrate, "order_id").agg(F.count("*")).scalar(),
        }
    )


# --- fitted preprocessing and features -----------------------------------------------------------


@query(
    "feature:s level:s",
    """SELECT 'customer_state' AS feature, customer_state AS level FROM t_fit GROUP BY 2
       UNION SELECT 'seller_state', seller_state FROM t_fit
       UNION SELECT 'customer_region', region FROM t_regions
       UNION SELECT 'customer_zip_prefix_2', substr(customer_zip_code_prefix, 1, 2) FROM t_fit
       UNION SELECT 'product_category', value FROM t_top30
       UNION SELECT 'payment_type', dominant_payment_type FROM t_fit
       UNION SELECT f, l FROM (SELECT unnest(['customer_state','seller_state','customer_region','customer_zip_prefix_2','product_category','payment_type']) AS f) AS a,
             (SELECT unnest(['__missing__', '__unknown__']) AS l) AS b""",
)
def category_levels(s: Stage) -> DataFrame:
    levels = fit_levels(s.fit_rows, STAR_REGIONS)
    rows = [(feature, level) for feature, values in levels.items() for level in values]
    return s.spark.createDataFrame(rows, "feature string, level string")


@query("dominant_category:s n:i", "SELECT value AS dominant_category, n FROM t_top30")
def top_categories(s: Stage) -> DataFrame:
    return profile.frequent_levels(s.fit_rows, "dominant_category")


@query(
    "kept:i present:i coverage:f",
    """SELECT (SELECT count(*) FROM t_top30) AS kept, count(DISTINCT dominant_category) AS present,
              (SELECT sum(n) FROM t_top30)::DOUBLE / count(dominant_category) AS coverage FROM t_fit""",
)
def category_coverage(s: Stage) -> DataFrame:
    return profile.level_coverage(s.fit_rows, "dominant_category")


@query("bound:f", "SELECT bound FROM t_winsor")
def winsor_bound(s: Stage) -> DataFrame:
    bound = fit_winsor(s.fit_rows)["days_to_shipping_limit"]
    return s.spark.createDataFrame([(bound,)], "bound double")


@query(
    "feature:s median:f",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS median FROM t_medians" for c in NUMERIC),
)
def medians(s: Stage) -> DataFrame:
    levels = fit_levels(s.fit_rows, STAR_REGIONS)
    matrix = features.construct_features(s.fit_rows, levels, fit_winsor(s.fit_rows), regions=STAR_REGIONS)
    return s.spark.createDataFrame(list(fit_medians(matrix).items()), "feature string, median double")


@query(
    "feature:s nulls:i share:f",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls, (count(*) - count({c}))::DOUBLE / count(*) AS share FROM t_raw_matrix"
        for c in features.NUMERIC_FEATURES
    ),
)
def null_report(s: Stage) -> DataFrame:
    model = s.preprocessor
    matrix = features.construct_features(s.attached, model.levels, model.winsor, regions=STAR_REGIONS)
    return profile.null_report(matrix, features.NUMERIC_FEATURES)


def _kind(feature: str) -> str:
    if feature in features.CATEGORICAL_FEATURES:
        return "s"
    return "b" if feature in features.BOOLEAN_FEATURES else "f"


MATRIX_SPEC = "order_id:s " + " ".join(f"{f}:{_kind(f)}" for f in features.FEATURES)


@query(MATRIX_SPEC, "SELECT * FROM t_matrix")
def feature_matrix(s: Stage) -> DataFrame:
    return s.preprocessor.transform_with_snapshots(s.analytical, s.levels, ["order_id"])


@query(MATRIX_SPEC, "SELECT * FROM t_serving")
def serving_matrix(s: Stage) -> DataFrame:
    return s.preprocessor.transform(s.analytical)


@query(
    "feature:s raw_value:s rows:i",
    """SELECT 'product_category' AS feature, dominant_category AS raw_value, count(*) AS rows FROM t_analytical
       WHERE dominant_category IS NOT NULL AND dominant_category NOT IN (SELECT value FROM t_top30) GROUP BY 2
       UNION ALL SELECT 'customer_zip_prefix_2', customer_zip_code_prefix, count(*) FROM t_analytical
       WHERE substr(customer_zip_code_prefix, 1, 2) NOT IN (SELECT substr(customer_zip_code_prefix, 1, 2) FROM t_fit) GROUP BY 2
       UNION ALL SELECT 'seller_state', seller_state, count(*) FROM t_analytical WHERE seller_state NOT IN (SELECT seller_state FROM t_fit) GROUP BY 2
       UNION ALL SELECT 'customer_state', customer_state, count(*) FROM t_analytical WHERE customer_state NOT IN (SELECT customer_state FROM t_fit) GROUP BY 2""",
)
def unseen_categories(s: Stage) -> DataFrame:
    matrix = s.preprocessor.transform_latest(scoring.raw_sources(s.analytical), scoring.RAW_SOURCE_COLUMNS)
    return profile.unseen_categories(matrix)


@query(
    "raw:f winsorised:f",
    """SELECT corr(CAST(days_to_shipping_limit AS DOUBLE), CAST(promised_days AS DOUBLE)) AS raw,
              corr(least(days_to_shipping_limit, (SELECT bound FROM t_winsor)), CAST(promised_days AS DOUBLE)) AS winsorised FROM t_analytical""",
)
def collinearity(s: Stage) -> DataFrame:
    from tidemark.functions.scalars import clip_upper

    bound = fit_winsor(s.fit_rows)["days_to_shipping_limit"]
    limit, promised = F.col("days_to_shipping_limit"), F.col("promised_days")
    return profile.correlations(
        s.analytical, {"raw": (limit, promised), "winsorised": (clip_upper(limit, bound), promised)}
    )


@query(
    "only_first:i only_second:i in_both:i",
    """SELECT count(*) FILTER (WHERE b.route IS NULL) AS only_first, count(*) FILTER (WHERE a.route IS NULL) AS only_second,
              count(*) FILTER (WHERE a.route IS NOT NULL AND b.route IS NOT NULL) AS in_both
       FROM (SELECT DISTINCT route FROM t_analytical WHERE order_purchase_timestamp >= TIMESTAMP '1997-01-01' AND order_purchase_timestamp < TIMESTAMP '1999-07-01') a
       FULL JOIN (SELECT DISTINCT route FROM t_analytical WHERE order_purchase_timestamp >= TIMESTAMP '1999-07-01' AND order_purchase_timestamp < TIMESTAMP '2000-01-01') b
       ON a.route = b.route""",
)
def value_overlap(s: Stage) -> DataFrame:
    fit = splits.select_window(s.analytical, s.fit)
    return reconcile.overlap(fit, splits.select_window(s.analytical, s.calibrate), "route")


# --- reviews -------------------------------------------------------------------------------------

IMPACT_SQL = """SELECT is_late, count(*) AS orders, count(review_score) AS with_review, avg(review_score) AS mean_review_score,
       avg((review_score <= 2)::INT) AS share_one_or_two
       FROM t_outcomes LEFT JOIN (SELECT order_id, avg(review_score) AS review_score FROM t_reviews GROUP BY 1) r USING (order_id) GROUP BY 1"""


@query("is_late:b orders:i with_review:i mean_review_score:f share_one_or_two:f", IMPACT_SQL)
def review_impact(s: Stage) -> DataFrame:
    return profile.review_impact(s.outcomes, rollups.mean_review(s.raw.reviews))


@query(
    "on_time_mean:f late_mean:f gap:f reviews_missing:i",
    f"""SELECT max(mean_review_score) FILTER (WHERE NOT is_late) AS on_time_mean, max(mean_review_score) FILTER (WHERE is_late) AS late_mean,
        max(mean_review_score) FILTER (WHERE NOT is_late) - max(mean_review_score) FILTER (WHERE is_late) AS gap,
        sum(orders - with_review) AS reviews_missing FROM ({IMPACT_SQL}) AS i""",
)
def review_gap(s: Stage) -> DataFrame:
    return profile.review_gap(review_impact(s))


# --- metrics -------------------------------------------------------------------------------------


@query("pr_auc:f", "SELECT sum(pos / p * (tp / (tp + fp))) AS pr_auc FROM t_curve")
def pr_auc(s: Stage) -> DataFrame:
    return metrics.pr_auc(s.blended)


@query("roc_auc:f", "SELECT sum((n - pos) * (tp - pos + pos / 2.0::DOUBLE)) / max(p * (total - p)) AS roc_auc FROM t_curve")
def roc_auc(s: Stage) -> DataFrame:
    return metrics.roc_auc(s.blended)


@query("brier:f", "SELECT avg((score - label) ** 2) AS brier FROM t_blend")
def brier(s: Stage) -> DataFrame:
    return metrics.brier(s.blended)


@query(
    "n:i positives:i bad_labels:i bad_scores:i not_probabilities:i",
    "SELECT count(*) AS n, sum(label) AS positives, 0 AS bad_labels, 0 AS bad_scores, 0 AS not_probabilities FROM t_blend",
)
def score_guards(s: Stage) -> DataFrame:
    return metrics.score_guards(s.blended)


CAPACITY_SQL = """SELECT count(*) AS n, sum((rank <= k)::INT) AS reviewed, sum((rank <= k)::INT * label) AS caught,
    sum((rank <= k)::INT * label)::DOUBLE / sum(label) AS recall_at_capacity,
    sum((rank <= k)::INT * label)::DOUBLE / max(k) AS precision_at_capacity,
    (sum((rank <= k)::INT * label)::DOUBLE / max(k)) / avg(label) AS lift_at_capacity
    FROM (SELECT label, row_number() OVER (ORDER BY s_buyer DESC, order_purchase_timestamp, order_id) AS rank, ceil(count(*) OVER () * 0.1::DOUBLE) AS k FROM t_scored) AS r"""


@query(
    "n:i reviewed:i caught:i recall_at_capacity:f precision_at_capacity:f lift_at_capacity:f", CAPACITY_SQL
)
def capacity_metrics(s: Stage) -> DataFrame:
    """On a score with four distinct values, so the cut falls inside a large tie."""
    rows = metrics.score_frame(s.scored, "label", "s_buyer", *splits.TOTAL_ORDER)
    return metrics.at_capacity(rows, splits.TOTAL_ORDER)


@query("recall_at_capacity:f", f"SELECT recall_at_capacity FROM ({CAPACITY_SQL}) AS c")
def recall_at_capacity(s: Stage) -> DataFrame:
    return capacity_metrics(s)


@query("precision_at_capacity:f", f"SELECT precision_at_capacity FROM ({CAPACITY_SQL}) AS c")
def precision_at_capacity(s: Stage) -> DataFrame:
    return capacity_metrics(s)


@query(
    "pr_auc:f roc_auc:f brier:f recall_at_capacity:f precision_at_capacity:f positive_rate:f capacity:f n:i",
    """SELECT (SELECT sum(pos / p * (tp / (tp + fp))) FROM t_curve) AS pr_auc,
              (SELECT sum((n - pos) * (tp - pos + pos / 2.0::DOUBLE)) / max(p * (total - p)) FROM t_curve) AS roc_auc,
              avg((score - label) ** 2) AS brier, sum((rank <= k)::INT * label)::DOUBLE / sum(label) AS recall_at_capacity,
              sum((rank <= k)::INT * label)::DOUBLE / max(k) AS precision_at_capacity, avg(label) AS positive_rate, 0.1 AS capacity, count(*) AS n
       FROM (SELECT *, row_number() OVER (ORDER BY score DESC, order_purchase_timestamp, order_id) AS rank, ceil(count(*) OVER () * 0.1::DOUBLE) AS k FROM t_blend) AS r""",
)
def metric_summary(s: Stage) -> DataFrame:
    return metrics.summary(s.blended, splits.TOTAL_ORDER)


@query(
    "accuracy:f recall:f precision:f n:i",
    "SELECT avg((label = 0)::INT) AS accuracy, 0.0 AS recall, CAST(NULL AS DOUBLE) AS precision, count(*) AS n FROM t_scored",
)
def trivial_baseline(s: Stage) -> DataFrame:
    return metrics.trivial_baseline(s.scored)


@query("base_rate:f", "SELECT avg(label) AS base_rate FROM t_scored")
def base_rate(s: Stage) -> DataFrame:
    return s.scored.agg(F.avg("label").alias("base_rate"))


@query(
    "threshold:f precision:f recall:f",
    "SELECT score AS threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM t_curve",
)
def pr_points(s: Stage) -> DataFrame:
    return metrics.pr_points(s.curve)


@query(
    "threshold:f fpr:f tpr:f",
    "SELECT score AS threshold, fp / (total - p) AS fpr, tp / p AS tpr FROM t_curve",
)
def roc_points(s: Stage) -> DataFrame:
    return metrics.roc_points(s.curve)


@query(
    "bin:i n:i mean_predicted:f observed_rate:f",
    """SELECT len(list_filter(e, lambda x: x < score)) AS bin, count(*) AS n, avg(score) AS mean_predicted, avg(label) AS observed_rate
       FROM (SELECT score, label, (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FROM t_blend) AS e FROM t_blend) AS b GROUP BY 1""",
)
def reliability_bins(s: Stage) -> DataFrame:
    return metrics.reliability(s.blended)


CONFUSION_SQL = """SELECT *, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / (tp + fn) AS recall, (tp + fp)::DOUBLE / (tp + fp + fn + tn) AS flag_rate
    FROM (SELECT sum((f AND label = 1)::INT) AS tp, sum((f AND label = 0)::INT) AS fp, sum((NOT f AND label = 1)::INT) AS fn, sum((NOT f AND label = 0)::INT) AS tn
          FROM (SELECT score >= 0.6 AS f, label FROM t_blend) AS b) AS c"""


@query("tp:i fp:i fn:i tn:i precision:f recall:f flag_rate:f", CONFUSION_SQL)
def confusion(s: Stage) -> DataFrame:
    return metrics.confusion(s.blended, 0.6)


@query(
    "actual_late:b predicted_late:b n:i share:f",
    """SELECT label = 1 AS actual_late, score >= 0.6 AS predicted_late, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM t_blend) AS share
       FROM t_blend GROUP BY 1, 2""",
)
def confusion_matrix(s: Stage) -> DataFrame:
    return metrics.confusion_shares(s.blended, 0.6)


COST_SQL = """SELECT score AS threshold, (5.0::DOUBLE * (p - tp) + fp) / total AS cost, tp, fp, p - tp AS fn, total - p - fp AS tn FROM t_curve"""


@query("threshold:f cost:f tp:i fp:i fn:i tn:i", COST_SQL)
def threshold_sweep(s: Stage) -> DataFrame:
    return metrics.cost_curve(s.blended)


@query(
    "threshold:f cost:f tp:i fp:i fn:i tn:i",
    """SELECT t AS threshold, (5.0::DOUBLE * fn + fp) / (tp + fp + fn + tn) AS cost, tp, fp, fn, tn FROM (
         SELECT t, count(*) FILTER (WHERE score >= t AND label = 1) AS tp, count(*) FILTER (WHERE score >= t AND label = 0) AS fp,
                count(*) FILTER (WHERE score < t AND label = 1) AS fn, count(*) FILTER (WHERE score < t AND label = 0) AS tn
         FROM t_blend, (SELECT unnest([0.1::DOUBLE, 0.3::DOUBLE, 0.5::DOUBLE, 0.7::DOUBLE]) AS t) AS g GROUP BY 1) AS c""",
)
def threshold_grid(s: Stage) -> DataFrame:
    return metrics.cost_curve(s.blended, thresholds=[0.1, 0.3, 0.5, 0.7])


@query(
    "threshold:f cost:f tp:i fp:i fn:i tn:i",
    f"SELECT * FROM ({COST_SQL}) AS c ORDER BY cost, threshold LIMIT 1",
)
def best_threshold(s: Stage) -> DataFrame:
    return metrics.best_threshold(metrics.cost_curve(s.blended))


# --- decisions -----------------------------------------------------------------------------------


@query(
    "weight_s_hash:f weight_s_promise:f weight_s_buyer:f log_loss:f",
    """SELECT a / 4.0 AS weight_s_hash, b / 4.0 AS weight_s_promise, (4 - a - b) / 4.0 AS weight_s_buyer,
              avg(-CASE WHEN label = 1 THEN ln(q) ELSE ln(1 - q) END) AS log_loss
       FROM (SELECT a, b, label, greatest(1e-7::DOUBLE, least(1 - 1e-7::DOUBLE, a / 4.0::DOUBLE * s_hash + b / 4.0::DOUBLE * s_promise + (4 - a - b) / 4.0::DOUBLE * s_buyer)) AS q
             FROM t_scored, (SELECT unnest(range(5)) AS a) AS x, (SELECT unnest(range(5)) AS b) AS y WHERE a + b <= 4) AS p GROUP BY 1, 2, 3""",
)
def blend_grid(s: Stage) -> DataFrame:
    return decision.blend_losses(s.scored, ["s_hash", "s_promise", "s_buyer"], decision.simplex_grid(3, 4))


@query("name:s score:f cost:f chosen:b")
def model_selection(s: Stage) -> DataFrame:
    """Three scores as three models: those within the band, and the cheapest of them."""
    costs = {"s_hash": 10.0, "s_promise": 85.0, "s_buyer": 269.0}
    rows = [
        (name, metrics.pr_auc_value(s.scored.select("label", F.col(name).alias("score"))), cost)
        for name, cost in costs.items()
    ]
    return decision.contenders(s.spark.createDataFrame(rows, "name string, score double, cost double"))


def _single_sql(column: str) -> str:
    return f"""SELECT sum(pos / p * (tp / (tp + fp))) AS v FROM (
        SELECT pos, sum(pos) OVER w AS tp, sum(n - pos) OVER w AS fp, sum(pos) OVER () AS p
        FROM (SELECT {column} AS score, count(*) AS n, sum(label) AS pos FROM t_scored GROUP BY 1) AS g
        WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) AS c"""


QUERIES["model_selection"] = Query(
    "model_selection",
    "name:s score:f cost:f chosen:b",
    model_selection,
    "WITH m AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS name, ({_single_sql(name)}) AS score, {cost} AS cost"
        for name, cost in (("s_hash", 10.0), ("s_promise", 85.0), ("s_buyer", 269.0))
    )
    + """) SELECT name, score, cost, row_number() OVER (ORDER BY cost, score DESC, name) = 1 AS chosen
         FROM m WHERE (SELECT max(score) FROM m) - score <= 0.005 + 1e-12""",
)


def _holdout_scores(s: Stage, name: str, column: str) -> DataFrame:
    rows = splits.evaluation_rows(s.scored, STAR, "holdout")
    frame = rows.select(*splits.TOTAL_ORDER, "label", F.col(column).alias("score"))
    areas = metrics.areas(metrics.ranking_curve(frame))
    return areas.select(
        F.lit(name).alias("model_version"),
        F.col("rows").alias("n_rows"),
        (F.col("positives") / F.col("rows")).alias("base_rate"),
        "pr_auc",
        (F.col("pr_auc") / (F.col("positives") / F.col("rows"))).alias("lift"),
        "roc_auc",
        metrics.brier(frame).scalar().alias("brier"),
        F.lit(100.0).alias("p95_latency_ms"),
    )


HOLDOUT_SQL = """SELECT '{1}' AS model_version, max(total) AS n_rows, max(p) / max(total) AS base_rate, sum(pos / p * (tp / (tp + fp))) AS pr_auc,
    sum(pos / p * (tp / (tp + fp))) / (max(p) / max(total)) AS lift, max(b) AS brier FROM (
      SELECT pos, sum(pos) OVER w AS tp, sum(n - pos) OVER w AS fp, sum(pos) OVER () AS p, sum(n) OVER () AS total, sum(sq) OVER () / sum(n) OVER () AS b
      FROM (SELECT {0} AS score, count(*) AS n, sum(label) AS pos, sum(({0} - label) ** 2) AS sq FROM t_scored
            WHERE order_purchase_timestamp >= TIMESTAMP '2000-07-01' AND order_purchase_timestamp < TIMESTAMP '2001-07-01' GROUP BY 1) AS g
      WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) AS c"""


@query(
    "model_version:s n_rows:i base_rate:f pr_auc:f lift:f brier:f",
    HOLDOUT_SQL.format("s_buyer", "buyer") + " UNION ALL " + HOLDOUT_SQL.format("s_promise", "promise"),
)
def holdout_comparison(s: Stage) -> DataFrame:
    """Two scores on identical evaluation rows."""
    return _holdout_scores(s, "buyer", "s_buyer").unionByName(_holdout_scores(s, "promise", "s_promise"))


@query(
    "position:i check:s passed:b value:f",
    f"""WITH a AS ({HOLDOUT_SQL.format("s_buyer", "buyer")}), b AS ({HOLDOUT_SQL.format("s_promise", "promise")})
        SELECT 0 AS position, 'pr_auc' AS "check", a.pr_auc - b.pr_auc > 0.005 + 1e-12 AS passed, a.pr_auc - b.pr_auc AS value FROM a, b
        UNION ALL SELECT 1, 'brier', a.brier - b.brier <= 0.01, a.brier - b.brier FROM a, b
        UNION ALL SELECT 2, 'feature_schema', true, 0.0 FROM a UNION ALL SELECT 3, 'p95_latency', true, 100.0 FROM a""",
)
def gate_checks(s: Stage) -> DataFrame:
    return decision.gate_checks(
        _holdout_scores(s, "buyer", "s_buyer"), _holdout_scores(s, "promise", "s_promise"), schema_gaps=0, gate=GATE
    )


# --- samples and attributions --------------------------------------------------------------------


@query(
    "order_id:s score:f",
    "SELECT order_id, score FROM t_blend ORDER BY score DESC, order_id LIMIT 50",
)
def top_scores(s: Stage) -> DataFrame:
    return s.blended.orderBy(F.col("score").desc(), "order_id").limit(50)


@query("order_id:s", "SELECT order_id FROM t_delivered ORDER BY md5('42:' || order_id), order_id LIMIT 200")
def seeded_sample(s: Stage) -> DataFrame:
    return profile.seeded_sample(population.delivered_orders(s.raw.orders, s.window), "order_id", 200)


@query(
    "order_id:s",
    """SELECT order_id FROM t_analytical ORDER BY order_id IN (
         SELECT min(order_id) FROM t_analytical WHERE dominant_category IS NULL
         UNION SELECT min(order_id) FROM t_analytical WHERE total_weight_g IS NULL) DESC, order_id LIMIT 5""",
)
def null_example(s: Stage) -> DataFrame:
    return profile.null_covering_example(s.analytical, ["dominant_category", "total_weight_g", "route"], "order_id")


ATTRIBUTED = {"s_hash": 0.5, "s_promise": 2.0, "s_buyer": -1.25}


def _attributions(s: Stage) -> DataFrame:
    means = s.scored.agg(*[F.avg(c).alias(c) for c in ATTRIBUTED]).first().asDict()
    return explain.linear_attributions(s.scored, ATTRIBUTED, means, ["order_id"])


@query(
    "order_id:s s_hash:f s_promise:f s_buyer:f",
    """SELECT order_id, 0.5 * (s_hash - (SELECT avg(s_hash) FROM t_scored)) AS s_hash,
              2.0 * (s_promise - (SELECT avg(s_promise) FROM t_scored)) AS s_promise,
              -1.25 * (s_buyer - (SELECT avg(s_buyer) FROM t_scored)) AS s_buyer FROM t_scored""",
)
def attributions(s: Stage) -> DataFrame:
    return _attributions(s)


@query(
    "feature:s importance:f",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(abs({w} * ({c} - (SELECT avg({c}) FROM t_scored)))) AS importance FROM t_scored"
        for c, w in ATTRIBUTED.items()
    ),
)
def mean_abs_attribution(s: Stage) -> DataFrame:
    return explain.mean_abs_attribution(_attributions(s), list(ATTRIBUTED))


@query("additivity_gap:f", "SELECT max(abs(s_hash - s_hash)) AS additivity_gap FROM t_scored")
def additivity_gap(s: Stage) -> DataFrame:
    """Attributions plus the base against the linear score itself: no gap."""
    means = s.scored.agg(*[F.avg(c).alias(c) for c in ATTRIBUTED]).first().asDict()
    parts = explain.linear_attributions(s.scored, ATTRIBUTED, means, ["order_id"])
    output = F.lit(0.0)
    for name, weight in ATTRIBUTED.items():
        output = output + F.lit(weight) * F.col(name)
    base = sum(w * means[c] for c, w in ATTRIBUTED.items())
    own = s.scored.select("order_id", output.alias("output"))
    return explain.additivity_gap(parts.join(own, "order_id"), list(ATTRIBUTED), base, "output")


@query(
    "order_id:s s_hash:f s_promise:f s_buyer:f",
    """SELECT order_id, (0.25 * 0.5 + 0.75) * (s_hash - (SELECT avg(s_hash) FROM t_scored)) AS s_hash,
              (0.25 * 2.0 + 0.75) * (s_promise - (SELECT avg(s_promise) FROM t_scored)) AS s_promise,
              (0.25 * -1.25 + 0.75) * (s_buyer - (SELECT avg(s_buyer) FROM t_scored)) AS s_buyer FROM t_scored""",
)
def blended_attributions(s: Stage) -> DataFrame:
    """Two linear models of the same rows, weighted as their blend."""
    means = s.scored.agg(*[F.avg(c).alias(c) for c in ATTRIBUTED]).first().asDict()
    flat = explain.linear_attributions(s.scored, dict.fromkeys(ATTRIBUTED, 1.0), means, ["order_id"])
    return explain.blended_attributions(
        {"steep": _attributions(s), "flat": flat}, {"steep": 0.25, "flat": 0.75}, "order_id", list(ATTRIBUTED)
    )


@query("feature:s alarm:s", "SELECT '*' AS feature, 'no expected feature leads' AS alarm FROM t_scored LIMIT 1")
def leakage_alarms(s: Stage) -> DataFrame:
    return explain.leakage_alarms(mean_abs_attribution(s))


# --- files and routing ---------------------------------------------------------------------------


@query(
    "table:s read:i inserted:i differing:i",
    """SELECT 'orders' AS "table", count(*) AS read, count(*) AS inserted, 0 AS differing FROM t_orders
       UNION ALL SELECT 'order_items', count(*), count(*), 0 FROM t_items
       UNION ALL SELECT 'order_payments', count(*), count(*), 0 FROM t_payments
       UNION ALL SELECT 'order_reviews', count(*), count(*), 0 FROM t_reviews
       UNION ALL SELECT 'customers', count(*), count(*), 0 FROM t_customers
       UNION ALL SELECT 'sellers', count(*), count(*), 0 FROM t_sellers
       UNION ALL SELECT 'products', count(*), count(*), 0 FROM t_products
       UNION ALL SELECT 'geolocation', count(*), count(*), 0 FROM t_geo
       UNION ALL SELECT 'product_category_name_translation', count(*), count(*), 0 FROM t_translation""",
)
def csv_roundtrip(s: Stage) -> DataFrame:
    """All tables written as CSV, scanned under their declared schema, landed, and reconciled.

    Tables are compared as multisets: keys of the source may repeat, and one table has none.
    """
    from functools import reduce

    from tidemark.sources.landing import SPEC_BY_NAME, scan_csv
    from tidemark.sources.publish import publish_all

    folder = scratch_folder(s.spark)
    reports = []
    for name, df in _raw_frames(s).items():
        spec = SPEC_BY_NAME[name]
        df.select(*spec.names).write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{folder}/csv/{name}")
        scan = scan_csv(s.spark, spec, f"{folder}/csv/{name}")
        landed = publish_all(s.spark, f"{folder}/landed", {name: scan})[name]
        rows = reconcile.multiset_gap(df, landed, spec.names)
        reports.append(
            rows.select(
                F.lit(name).alias("table"),
                scan.agg(F.count("*")).scalar().alias("read"),
                landed.agg(F.count("*")).scalar().alias("inserted"),
                "differing",
            )
        )
    return reduce(DataFrame.unionByName, reports)


@query(
    "reasons:s records:i",
    """SELECT concat_ws(',', CASE WHEN length(customer_state) > 8 THEN 'customer_state:length_1_8' END,
                            CASE WHEN length(seller_state) > 8 THEN 'seller_state:length_1_8' END) AS reasons, count(*) AS records
       FROM t_analytical GROUP BY 1""",
)
def record_routing(s: Stage) -> DataFrame:
    """Value rules on every order; states longer than a code are turned away, with the reason."""
    from tidemark.streaming.scoring import conform

    rules = scoring.record_rules() + scoring.code_length_rules()
    accepted, rejected = scoring.route_records(conform(s.analytical), rules)
    reasons = accepted.select(F.lit("").alias("reasons")).unionByName(
        rejected.select(F.array_join("reasons", ",").alias("reasons"))
    )
    return reasons.groupBy("reasons").agg(F.count("*").alias("records"))


# --- learning ------------------------------------------------------------------------------------


@query(
    "order_id:s score:f",
    f"""SELECT order_id, (SELECT avg(is_late::INT) FROM ({FIT_SQL}) AS f) AS score FROM t_delivered
        WHERE order_purchase_timestamp >= TIMESTAMP '1999-07-01' AND order_purchase_timestamp < TIMESTAMP '2000-01-01'""",
)
def majority_baseline(s: Stage) -> DataFrame:
    label = F.col("is_late").cast("int").alias("label")
    baseline = learning.MajorityBaseline.fit(_fit_orders(s).select(label))
    return baseline.score(_calibrate_orders(s))


@query(
    "s_promise:f calibrated:f",
    """WITH g AS (SELECT s_promise AS s, count(*) AS n, sum(label) AS p FROM t_scored GROUP BY 1),
            b AS (SELECT j.s AS lo, k.s AS hi, sum(m.p) / sum(m.n) AS a FROM g j JOIN g k ON j.s <= k.s JOIN g m ON m.s BETWEEN j.s AND k.s GROUP BY 1, 2)
       SELECT s AS s_promise, max(least_above) AS calibrated FROM
         (SELECT g.s, b.lo, min(b.a) AS least_above FROM g JOIN b ON b.lo <= g.s AND b.hi >= g.s GROUP BY 1, 2) AS x GROUP BY 1""",
)
def isotonic_calibration(s: Stage) -> DataFrame:
    """Against the min-max formula of isotonic regression, on the distinct scores."""
    scores = s.scored.select("label", F.col("s_promise").alias("score"))
    model = fit_isotonic(scores)
    distinct = scores.select("score", F.col("score").alias("s_promise")).distinct()
    return learning.calibrate(model, distinct).withColumnRenamed("score", "calibrated")


@query("weight_s_hash:f weight_s_promise:f weight_s_buyer:f blend_pr_auc:f delta:f ship_blend:b")
def blend_verdict(s: Stage) -> DataFrame:
    names = ["s_buyer", "s_hash", "s_promise"]
    scored = materialize(s.scored)
    verdict = decision.evaluate_blend(scored, decision.fit_blend_weights(scored, names))
    row = (*[verdict.weights[f"s_{n}"] for n in ("hash", "promise", "buyer")], verdict.blend_pr_auc, verdict.delta, verdict.ship_blend)
    return s.spark.createDataFrame(
        [row],
        "weight_s_hash double, weight_s_promise double, weight_s_buyer double, blend_pr_auc double, delta double, ship_blend boolean",
    )


def _matrix(s: Stage) -> DataFrame:
    """The outcome of an order is on its analytical row already, so no join has to fetch it."""
    rows = s.preprocessor.transform_with_snapshots(s.analytical, s.levels, ["order_id", PURCHASED_AT, "is_late"])
    return rows.withColumn("label", F.col("is_late").cast("int")).drop("is_late")


def _fit_and_calibrate(s: Stage) -> tuple[DataFrame, DataFrame]:
    used = population.within(s.fit) | population.within(s.calibrate)
    matrix = materialize(_matrix(s).where(used))
    return splits.select_window(matrix, s.fit), splits.select_window(matrix, s.calibrate)


def _family_scores(s: Stage, family: str, params: dict) -> DataFrame:
    fit, calibrate = _fit_and_calibrate(s)
    rows = materialize(splits.with_tail(fit).withColumnRenamed("is_tail", learning.VALIDATION))
    model = learning.fit_model(family, rows, s.preprocessor.levels, params)
    return learning.positive_score(model, calibrate, keep=["order_id"])


@query("order_id:s score:f")
def logistic_scores(s: Stage) -> DataFrame:
    return _family_scores(s, "logistic", {})


@query("order_id:s score:f")
def boosted_tree_scores(s: Stage) -> DataFrame:
    return _family_scores(s, "gbt", {})


@query("model:s fold:i pr_auc:f base_rate:f lift:f")
def cross_validation(s: Stage) -> DataFrame:
    fit, _ = _fit_and_calibrate(s)
    ranked, n = splits.ranked_in_time(fit)
    fitters = {f: learning.family_fitter(f, s.preprocessor.levels) for f in ("logistic", "gbt", "forest")}
    folded = learning.coded(list(fitters.values()), ranked.withColumn("fold", splits.fold_of(F.col("rank"), n, CV_FOLDS)))
    rates = usable_rates(folded, CV_FOLDS)
    scores = {
        name: learning.cross_validate(folded, fitter, CV_FOLDS)
        for name, fitter in {"majority": learning.majority_fitter(), **fitters}.items()
    }
    return learning.comparison_report(scores, rates, folded)


@query("feature:s importance:f")
def permutation_importance(s: Stage) -> DataFrame:
    fit, calibrate = _fit_and_calibrate(s)
    model = learning.fit_model("logistic", fit, s.preprocessor.levels)
    return learning.permutation_importance(model, calibrate, features.FEATURES, "order_id")


def _scoring_model(s: Stage) -> scoring.ScoringModel:
    fit, calibrate = _fit_and_calibrate(s)
    model = learning.fit_model("logistic", fit, s.preprocessor.levels)
    scores = materialize(learning.positive_score(model, calibrate, keep=["label"]))
    return scoring.ScoringModel(
        s.preprocessor.with_threshold(0.1), {"logistic": model}, {"logistic": 1.0}, fit_isotonic(scores)
    )


@query("order_id:s probability:f is_late_predicted:b threshold:f")
def score_records(s: Stage) -> DataFrame:
    from tidemark.streaming.scoring import conform

    return _scoring_model(s).predict(conform(s.analytical), ["order_id"])


@query(
    "output:s records:i",
    """SELECT 'scored' AS output, count(*) AS records FROM t_analytical WHERE length(customer_state) <= 8 AND length(seller_state) <= 8
       UNION ALL SELECT 'rejected', count(*) FROM t_analytical WHERE length(customer_state) > 8 OR length(seller_state) > 8""",
)
def stream_scoring(s: Stage) -> DataFrame:
    """All orders through the stream: every record comes out once, scored or rejected."""
    from tidemark.streaming.scoring import conform, read_records, score_stream

    folder = scratch_folder(s.spark)
    conform(s.analytical).write.parquet(f"{folder}/records")
    rules = scoring.record_rules() + scoring.code_length_rules()
    stream = read_records(s.spark, f"{folder}/records")
    score_stream(stream, _scoring_model(s), f"{folder}/out", rules=rules).awaitTermination()
    outputs = [
        s.spark.read.parquet(f"{folder}/out/{name}").agg(F.lit(name).alias("output"), F.count("*").alias("records"))
        for name in ("scored", "rejected")
    ]
    return outputs[0].unionByName(outputs[1])


FOLDED_SQL = f"""SELECT label, CASE WHEN k < n - {CV_FOLDS} * size THEN 0 ELSE (k - (n - {CV_FOLDS} * size)) // size + 1 END AS fold FROM (
    SELECT is_late::INT AS label, row_number() OVER (ORDER BY order_purchase_timestamp, order_id) - 1 AS k, count(*) OVER () AS n,
           count(*) OVER () // {CV_FOLDS + 1} AS size FROM ({FIT_SQL}) AS f) AS p"""


@query(
    "fold:i train_rows:i held_out_rows:i base_rate:f train_rate:f pr_auc:f",
    f"""WITH f AS ({FOLDED_SQL}), g AS (SELECT fold, count(*) AS n, sum(label) AS p FROM f GROUP BY 1)
        SELECT h.fold AS fold, sum(t.n) AS train_rows, any_value(h.n) AS held_out_rows, any_value(h.p) / any_value(h.n) AS base_rate,
               sum(t.p) / sum(t.n) AS train_rate, any_value(h.p) / any_value(h.n) AS pr_auc
        FROM g h JOIN g t ON t.fold < h.fold WHERE h.fold > 0 GROUP BY 1""",
)
def majority_cross_validation(s: Stage) -> DataFrame:
    """The majority baseline through the expanding window: a constant score is worth the base rate."""
    ranked, n = splits.ranked_in_time(_fit_orders(s).withColumn("label", F.col("is_late").cast("int")))
    folded = materialize(ranked.withColumn("fold", splits.fold_of(F.col("rank"), n, CV_FOLDS)))
    scores = learning.evaluate(folded, learning.majority_fitter(), CV_FOLDS)
    scored = s.spark.createDataFrame(list(scores.items()), "fold int, pr_auc double")
    return majority_folds(folded).join(scored, "fold")


@query(
    "fold:i rows:i positives:i first:i",
    f"""WITH f AS ({FOLDED_SQL}), g AS (SELECT fold, count(*) AS n, sum(label) AS p FROM f GROUP BY 1)
        SELECT h.fold AS fold, any_value(h.n) AS rows, any_value(h.p) AS positives, coalesce(sum(t.n), 0) AS first FROM g h LEFT JOIN g t ON t.fold < h.fold GROUP BY 1""",
)
def fold_sizes(s: Stage) -> DataFrame:
    ranked, n = splits.ranked_in_time(_fit_orders(s).withColumn("label", F.col("is_late").cast("int")))
    return fold_table(ranked.withColumn("fold", splits.fold_of(F.col("rank"), n, CV_FOLDS)))


@query(
    "hi:f n:i pos:i",
    """WITH g AS (SELECT s_promise AS s, count(*) AS n, sum(label) AS p FROM t_scored GROUP BY 1),
            b AS (SELECT j.s AS lo, k.s AS hi, sum(m.p) / sum(m.n) AS a FROM g j JOIN g k ON j.s <= k.s JOIN g m ON m.s BETWEEN j.s AND k.s GROUP BY 1, 2),
            f AS (SELECT s, max(least_above) AS rate FROM (SELECT g.s, b.lo, min(b.a) AS least_above FROM g JOIN b ON b.lo <= g.s AND b.hi >= g.s GROUP BY 1, 2) AS x GROUP BY 1)
       SELECT max(g.s) AS hi, sum(n) AS n, sum(p) AS pos FROM g JOIN f ON f.s = g.s GROUP BY round(f.rate, 12)""",
)
def isotonic_pools(s: Stage) -> DataFrame:
    """The pooled blocks themselves, with their rows and positives."""
    return isotonic_blocks(s.scored.select("label", F.col("s_promise").alias("score"))).select("hi", "n", "pos")


# --- versions ------------------------------------------------------------------------------------


def _event_log(s: Stage) -> DataFrame:
    """The event stream read as a log: users are versions, kinds of event are fields."""
    stream = s.spark.read.parquet(f"{s.directory}/events.parquet")
    return stream.select(
        F.col("user_id").cast("string").alias("version"),
        F.col("event_type").alias("field"),
        F.when(F.col("value") >= 2.0, F.col("props")).alias("value"),
        F.col("event_id").cast("bigint").alias("seq"),
    )


@query(
    "version:s field:s value:s",
    """SELECT version, field, value FROM (
         SELECT CAST(user_id AS VARCHAR) AS version, event_type AS field, CASE WHEN value >= 2.0 THEN props END AS value,
                row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events) AS x WHERE k = 1 AND value IS NOT NULL""",
)
def promotion_events(s: Stage) -> DataFrame:
    """Current value of every field of every version; a withdrawn field (null) has none."""
    return versions.state(_event_log(s))


@query(
    "alias:s version:s",
    """SELECT alias, version FROM (
         SELECT event_type AS alias, CAST(user_id AS VARCHAR) AS version, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS k
         FROM events) AS x WHERE k = 1 AND value >= 2.0""",
)
def alias_moves(s: Stage) -> DataFrame:
    """Who answers to each name after all moves."""
    return versions.holders(_event_log(s).withColumn("field", F.concat(F.lit("alias:"), "field")))


STATUS_OF = {"click": "challenger", "view": "champion", "error": "archived"}


@query(
    "seq:i version:s before:s after:s legal:b",
    """WITH e AS (SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS version,
                         CASE event_type WHEN 'click' THEN 'challenger' WHEN 'view' THEN 'champion' WHEN 'error' THEN 'archived' ELSE 'lost' END AS after FROM events),
            m AS (SELECT *, lag(after) OVER (PARTITION BY version ORDER BY seq) AS before FROM e)
       SELECT seq, version, before, after, coalesce(CASE WHEN before IS NULL THEN after IN ('challenger', 'champion')
              WHEN before = 'challenger' THEN after IN ('champion', 'archived') WHEN before = 'champion' THEN after = 'archived'
              WHEN before = 'archived' THEN after = 'champion' END, false) AS legal FROM m""",
)
def status_moves(s: Stage) -> DataFrame:
    """Which status may follow which, judged over a whole log."""
    kinds = F.create_map(*[F.lit(x) for pair in STATUS_OF.items() for x in pair])
    log = _event_log(s).select("version", F.lit("status").alias("field"), F.coalesce(kinds[F.col("field")], F.lit("lost")).alias("value"), "seq")
    return versions.transitions(log)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: entry.run for name, entry in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql_for(q.sql, q.spec) for name, q in QUERIES.items() if q.sql}
