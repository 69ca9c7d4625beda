"""Every query by name, with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import standin
from checks.standin import tables
from mishap import schemas as S
from mishap.functions.labels import risk_class
from mishap.functions.temporal import duration_minutes
from mishap.operators import aggregates, clustering, encoding, forest, hygiene, metrics, sampling
from mishap.operators.joins import pin
from mishap.operators.numbering import numbered
from mishap.operators.quantiles import exact_medians
from mishap.plans import cleaning, engineering, hotspots, reports, risk
from mishap.sources.tables import read_table, shared_folder, stage, write_small, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as SQL returns them."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: F.col(f"`{n}`").cast("timestamp_ntz") for n in names})


# --- Scalar functions and projections -----------------------------------------------------------


@query(f"SELECT event_id, {standin.CALENDAR_SQL.format(t='ts')} FROM events")
def calendar_features(spark, sf):
    (events,) = tables(spark, sf, "events")
    return engineering.with_calendar(events, "ts", None).select("event_id", *S.CALENDAR)


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + standin.DURATION_SQL.format(s="o_orderdate", e="(l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT)))")
    + " AS minutes FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)
def duration_in_minutes(spark, sf):
    lines, orders = tables(spark, sf, "lineitem", "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    end = F.expr("timestampadd(SECOND, CAST(floor(l_extendedprice) AS BIGINT), l_shipdate)")
    minutes = duration_minutes(F.col("o_orderdate"), end)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", minutes.alias("minutes"))


@query(
    """SELECT l_orderkey AS "Order", l_linenumber AS "Line", l_quantity AS "Quantity",
              l_shipdate, l_returnflag FROM lineitem"""
)
def drop_and_project(spark, sf):
    (lines,) = tables(spark, sf, "lineitem")
    dropped = lines.drop("l_tax", "l_discount", "l_comment")
    wanted = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag", "l_shipmode"]
    titles = {"l_orderkey": "Order", "l_linenumber": "Line", "l_quantity": "Quantity"}
    present = [c for c in wanted if c in dropped.columns]
    return dropped.select(*present).withColumnsRenamed(titles)


@query("SELECT vec_id, label FROM embeddings WHERE label = 3")
def cluster_filter(spark, sf):
    (vectors,) = tables(spark, sf, "embeddings")
    return reports.in_cluster(vectors, 3, "label").select("vec_id", "label")


@query("SELECT vec_id, label FROM embeddings")
def cluster_filter_all(spark, sf):
    (vectors,) = tables(spark, sf, "embeddings")
    return reports.in_cluster(vectors, reports.ALL, "label").select("vec_id", "label")


PRIORITY_RISK_SQL = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High'
 WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' WHEN o_orderpriority = '5-LOW' THEN 'Low' END"""
PRIORITY_RISK = {"1-URGENT": "High", "2-HIGH": "High", "3-MEDIUM": "Medium", "5-LOW": "Low"}
PRICE_RISK_SQL = """CASE WHEN o_totalprice > 300000 THEN 'High' ELSE 'Medium' END"""


def rated_orders(spark, sf) -> DataFrame:
    """Orders with a risk class by priority, and a rule that never says Low as the prediction."""
    (orders,) = tables(spark, sf, "orders")
    predicted = F.when(F.col("o_totalprice") > 300000, "High").otherwise("Medium")
    return orders.withColumns(
        {
            S.RISK: risk_class(F.col("o_orderpriority"), PRIORITY_RISK),
            S.PREDICTED_RISK: predicted,
        }
    )


@query(f'SELECT o_orderkey, {PRIORITY_RISK_SQL} AS "Risk_Category" FROM orders')
def risk_label(spark, sf):
    return rated_orders(spark, sf).select("o_orderkey", S.RISK)


# --- Data hygiene --------------------------------------------------------------------------------


@query(
    """SELECT * EXCLUDE (pick) FROM (SELECT *, row_number() OVER (
         PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                  l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
                  l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS pick
       FROM lineitem) AS r WHERE pick = 1"""
)
def dedup_by_key(spark, sf):
    (lines,) = tables(spark, sf, "lineitem")
    return hygiene.dedup(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def gapped_events(spark, sf) -> DataFrame:
    """Events of which an error carries no value, and a small value no type."""
    (events,) = tables(spark, sf, "events")
    return events.select(
        "event_id",
        F.expr("CASE WHEN value >= 5 THEN event_type END").alias("event_type"),
        F.expr("CASE WHEN event_type <> 'error' THEN value END").alias("value"),
    )


GAPPED_SQL = """gapped AS (SELECT event_id,
  CASE WHEN value >= 5 THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"""


@query(
    f"""WITH {GAPPED_SQL}
        SELECT event_id, coalesce(event_type, 'Unknown') AS event_type, value FROM gapped"""
)
def fill_categorical(spark, sf):
    return hygiene.fill_constant(gapped_events(spark, sf), ["event_type"])


@query(
    f"""WITH {GAPPED_SQL} SELECT event_id, event_type,
        coalesce(value, (SELECT quantile_disc(value, 0.5) FROM gapped)) AS value FROM gapped"""
)
def median_impute(spark, sf):
    events = gapped_events(spark, sf)
    return hygiene.fill_numbers(events, ["value"], exact_medians(events, ["value"]))


@query(
    f"""WITH {GAPPED_SQL} SELECT event_id, value IS NULL AS filled, coalesce(value, 0) AS value,
        true AS within FROM gapped"""
)
def median_impute_by_sketch(spark, sf):
    """The default fill: given values stay, and every gap gets one value near the middle rank."""
    events = gapped_events(spark, sf)
    filled = hygiene.fill_numbers(events, ["value"], hygiene.medians(events, ["value"], 0.01))
    gap = events.select("event_id", F.col("value").isNull().alias("filled"))
    joined = stage(filled.join(gap, "event_id"), "filled")
    best = joined.where("filled").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    middle = best.select(F.struct("low", "high")).scalar()
    ranks = joined.where("not filled").agg(
        F.struct(
            F.count("value").alias("n"),
            F.count_if(F.col("value") < middle["low"]).alias("lower"),
            F.count_if(F.col("value") <= middle["high"]).alias("upto"),
        )
    ).scalar()
    near = (ranks["lower"] <= 0.51 * ranks["n"]) & (ranks["upto"] >= 0.49 * ranks["n"])
    return joined.select(
        "event_id",
        "filled",
        F.when(F.col("filled"), 0.0).otherwise(F.col("value")).alias("value"),
        (near & (middle["low"] == middle["high"])).alias("within"),
    )


@query(
    """SELECT "column", n, true AS within FROM (
         SELECT 'l_quantity' AS "column", count(l_quantity) AS n FROM lineitem UNION ALL
         SELECT 'l_extendedprice', count(l_extendedprice) FROM lineitem UNION ALL
         SELECT 'l_discount', count(l_discount) FROM lineitem) AS counts"""
)
def approx_median_rank(spark, sf):
    """The one-pass approximate median lies within the allowed distance from the middle rank."""
    (lines,) = tables(spark, sf, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    row = pin(hygiene.medians(lines, columns, 0.01)).select(F.struct("*")).scalar()
    ranks = lines.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                F.count_if(F.col(c) < row[c]).alias("lower"),
                F.count_if(F.col(c) <= row[c]).alias("upto"),
            ).alias(c)
            for c in columns
        ]
    ).select(F.inline(F.array(*columns)))
    within = F.expr("lower <= 0.51 * n AND upto >= 0.49 * n")
    return ranks.select("column", "n", within.alias("within"))


@query(
    """SELECT "column", median FROM (
         SELECT 'l_quantity' AS "column", median(l_quantity) AS median FROM lineitem UNION ALL
         SELECT 'l_extendedprice', median(l_extendedprice) FROM lineitem UNION ALL
         SELECT 'l_tax', median(l_tax) FROM lineitem) AS m"""
)
def exact_midpoint_medians(spark, sf):
    (lines,) = tables(spark, sf, "lineitem")
    found = exact_medians(lines, ["l_quantity", "l_extendedprice", "l_tax"], midpoint=True)
    return spark.createDataFrame(list(found.items()), "column string, median double")


@query(
    f"""WITH {GAPPED_SQL}, counts AS (
         SELECT 'event_id' AS "column", count(*) - count(event_id) AS missing FROM gapped UNION ALL
         SELECT 'event_type', count(*) - count(event_type) FROM gapped UNION ALL
         SELECT 'value', count(*) - count(value) FROM gapped)
        SELECT * FROM counts WHERE missing > 0"""
)
def missing_report(spark, sf):
    return hygiene.missing_report(gapped_events(spark, sf))


@query(
    f"""SELECT 'raw' AS stage, count(*) AS rows, {len(S.RAW.names)} AS cols
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey UNION ALL
        SELECT 'cleaned', count(DISTINCT (l_orderkey, l_linenumber)),
               {len(S.RAW.names) - len(S.DROPPED)}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def stage_profile(spark, sf):
    raw = standin.incidents(spark, sf)
    return cleaning.profile(raw, cleaning.clean(raw))


@query(
    """SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS "column",
         CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type
       FROM information_schema.columns WHERE table_name = 'orders'"""
)
def schema_listing(spark, sf):
    return hygiene.schema_listing(*tables(spark, sf, "orders"))


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
              o_orderdate + to_microseconds(o_orderkey * 997 % 1000000) AS o_orderdate,
              CASE WHEN o_orderkey % 5 <> 0
                   THEN ' "' || o_orderstatus || '",' || chr(10) || o_orderpriority || '  ' END AS note
       FROM orders"""
)
def csv_round_trip(spark, sf):
    """Orders with microseconds, padding, quotes and line breaks, as sorted CSV and read back."""
    (orders,) = tables(spark, sf, "orders")
    path = f"{shared_folder(spark)}/mishap/round-trip-{uuid.uuid4().hex}.csv"
    moment = F.expr("timestampadd(MICROSECOND, o_orderkey * 997 % 1000000, o_orderdate)")
    note = F.concat(F.lit(' "'), "o_orderstatus", F.lit('",\n'), "o_orderpriority", F.lit("  "))
    changed = orders.withColumns(
        {
            "o_orderdate": moment.cast("timestamp"),
            "note": F.when(F.col("o_orderkey") % 5 != 0, note),
        }
    )
    write_table(changed, path, order_by="o_orderkey", total_order=True)
    return plain_times(read_table(spark, path, changed.schema))


# --- Aggregations, sorts, samples ----------------------------------------------------------------


@query(
    """SELECT CAST(hour(ts) AS INTEGER) AS "Hour", count(*) AS "Accidents"
       FROM events GROUP BY 1 ORDER BY 1"""
)
def hourly_counts(spark, sf):
    (events,) = tables(spark, sf, "events")
    return reports.incidents_by_hour(engineering.with_calendar(events, "ts", None))


SUMMARY_SQL = """SELECT l_linenumber AS {cluster}, count(*) AS {n},
  round(avg(l_quantity), 4) AS {severity},
  round(avg(l_discount), 4) AS {lat}, round(avg(l_tax), 4) AS {lng},
  round(min(l_discount), 4) AS {lat0}, round(max(l_discount), 4) AS {lat1},
  round(min(l_tax), 4) AS {lng0}, round(max(l_tax), 4) AS {lng1}
FROM lineitem GROUP BY l_linenumber"""
SUMMARY_NAMES = ["cluster", "n", "severity", "lat", "lng", "lat0", "lat1", "lng0", "lng1"]


def line_summary(spark, sf) -> DataFrame:
    (lines,) = tables(spark, sf, "lineitem")
    return aggregates.hotspot_summary(
        lines, "l_linenumber", "l_quantity", "l_discount", "l_tax"
    )


@query(SUMMARY_SQL.format(**dict(zip(SUMMARY_NAMES, S.HOTSPOT_TITLES))))
def hotspot_summary(spark, sf):
    return line_summary(spark, sf)


@query(SUMMARY_SQL.format(**{k: f'"{v}"' for k, v in zip(SUMMARY_NAMES, S.HOTSPOT_TITLES.values())}))
def hotspot_table(spark, sf):
    return reports.hotspot_table(line_summary(spark, sf))


@query("SELECT DISTINCT label FROM embeddings ORDER BY label")
def distinct_clusters(spark, sf):
    return aggregates.distinct_sorted(*tables(spark, sf, "embeddings"), "label")


@query("SELECT count(*) AS rows, count(DISTINCT l_partkey) AS parts FROM lineitem")
def distinct_count(spark, sf):
    (lines,) = tables(spark, sf, "lineitem")
    parts = aggregates.distinct_count(lines, "l_partkey")
    return lines.agg(F.count(F.lit(1)).alias("rows"), parts.alias("parts"))


@query(
    f"""WITH rated AS (SELECT {PRICE_RISK_SQL} AS risk FROM orders),
        listed AS (SELECT * FROM (VALUES ('Low'), ('Medium'), ('High')) AS v(risk))
        SELECT listed.risk AS "Risk", count(rated.risk) AS "Count"
        FROM listed LEFT JOIN rated ON listed.risk = rated.risk GROUP BY listed.risk"""
)
def dense_category_counts(spark, sf):
    return reports.predicted_risk(rated_orders(spark, sf))


@query(
    """SELECT o_orderpriority, count(*) AS "Count",
              concat('Severity ', o_orderpriority) AS "Severity_Label"
       FROM orders GROUP BY o_orderpriority"""
)
def severity_distribution(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    return reports.severity_distribution(orders, "o_orderpriority")


@query(
    """SELECT p_brand, count(*) AS "Count" FROM part WHERE p_brand IS NOT NULL
       GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 10"""
)
def top_values(spark, sf):
    return aggregates.top_values(*tables(spark, sf, "part"), "p_brand")


@query(
    f"""SELECT "Weather_Condition" AS "Weather", count(*) AS "Accidents"
        FROM ({standin.engineered_sql()}) AS e GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
)
def top_weather(spark, sf):
    raw = standin.incidents(spark, sf)
    return reports.top_weather(engineering.engineer(cleaning.clean(raw)))


SHARES_SQL = """shares AS (
  SELECT 'categorical__Priority_' || o_orderpriority AS feature, count(*) AS n FROM orders GROUP BY 1
  UNION ALL SELECT 'binary__Order_Status_' || o_orderstatus, count(*) FROM orders GROUP BY 1
  UNION ALL SELECT 'numerical__Customer_' || o_custkey, count(*) FROM orders GROUP BY 1)"""


@query(
    f"""WITH {SHARES_SQL}, top AS (
         SELECT feature, round(n / (SELECT count(*) FROM orders), 9) AS importance FROM shares
         ORDER BY importance DESC, feature LIMIT 15)
        SELECT feature, importance, replace(replace(replace(replace(feature, 'numerical__', ''),
          'categorical__', ''), 'binary__', ''), '_', ' ') AS display_feature FROM top"""
)
def top_features_display(spark, sf):
    """The feature report over the share of orders that each value holds."""
    (orders,) = tables(spark, sf, "orders")
    renamed = {
        "o_orderpriority": "categorical__Priority",
        "o_orderstatus": "binary__Order_Status",
        "o_custkey": "numerical__Customer",
    }
    counts = encoding.category_counts(orders.withColumnsRenamed(renamed), list(renamed.values()))
    rows = orders.agg(F.count(F.lit(1))).scalar()
    shares = counts.select(
        F.concat_ws("_", "column", "value").alias("feature"),
        F.round(F.col("n") / rows, 9).alias("importance"),
    )
    return reports.top_features(shares)


@query(
    f"""SELECT o_orderkey AS "ID", o_orderdate AS "Start_Time", {PRIORITY_RISK_SQL} AS "Risk_Category",
           {PRICE_RISK_SQL} AS "Predicted_Risk" FROM orders ORDER BY o_orderkey LIMIT 100"""
)
def first_n_rows(spark, sf):
    named = rated_orders(spark, sf).withColumnsRenamed({"o_orderkey": "ID", "o_orderdate": "Start_Time"})
    return reports.first_predictions(named)


SAMPLE_SQL = """SELECT event_id, user_id, value, event_type FROM events {where}
  ORDER BY md5('42:' || CAST(event_id AS VARCHAR)) LIMIT {limit}"""


def event_sample(spark, sf, choice, limit) -> DataFrame:
    (events,) = tables(spark, sf, "events")
    shown = ["event_id", "user_id", "value", "event_type"]
    return reports.map_sample(events, choice, limit, S.SEED, "event_id", shown, "event_type")


@query(SAMPLE_SQL.format(where="WHERE event_type = 'click'", limit=1000))
def map_sample(spark, sf):
    return event_sample(spark, sf, "click", 1000)


@query(SAMPLE_SQL.format(where="", limit=5000))
def map_sample_all(spark, sf):
    return event_sample(spark, sf, reports.ALL, 5000)


@query(
    """WITH ranked AS (SELECT event_id, value, event_type,
         row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || CAST(event_id AS VARCHAR))) AS place,
         row_number() OVER (ORDER BY md5('42:' || CAST(event_id AS VARCHAR))) AS overall FROM events)
       SELECT event_type AS choice, event_id, value FROM ranked WHERE place <= 700 AND event_type IS NOT NULL
       UNION ALL SELECT 'All', event_id, value FROM ranked WHERE overall <= 700"""
)
def map_samples(spark, sf):
    """The samples of all choices in one pass."""
    (events,) = tables(spark, sf, "events")
    return reports.map_samples(events, 700, S.SEED, "event_id", ["event_id", "value"], "event_type")


@query(
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders"""
)
def export_order(spark, sf):
    """Every row's place in the files of a sorted export, in the order of files and rows."""
    (orders,) = tables(spark, sf, "orders")
    path = f"{shared_folder(spark)}/mishap/ordered-{uuid.uuid4().hex}"
    write_table(orders.repartition(7), path, order_by="o_orderkey", total_order=True)
    written = read_table(spark, path).select("o_orderkey", "_metadata.file_name", "_metadata.row_index")
    return numbered(written, ["file_name", "row_index"], "place").select("o_orderkey", "place")


@query(
    f"""SELECT round(avg(user_id), 6) AS center_lat, round(avg(value), 6) AS center_lng
        FROM ({SAMPLE_SQL.format(where="", limit=2500)}) AS s"""
)
def map_center(spark, sf):
    center = reports.map_center(event_sample(spark, sf, reports.ALL, 2500), "user_id", "value")
    return center.select(*[F.round(c, 6).alias(c) for c in center.columns])


# --- Learning: preparation -----------------------------------------------------------------------

QUOTA_SQL = """counts AS (SELECT {label} AS label, count(*) AS n FROM {table} GROUP BY 1),
totals AS (SELECT sum(n) AS total, sum(n) - ceil(sum(n) * 0.2) AS train FROM counts),
parts AS (SELECT label, n, CAST(n AS HUGEINT) * CAST(train AS HUGEINT) // CAST(total AS HUGEINT) AS whole,
                 CAST(n AS HUGEINT) * CAST(train AS HUGEINT) % CAST(total AS HUGEINT) AS remainder, train
          FROM counts, totals),
quotas AS (SELECT label, n - whole - CASE WHEN row_number() OVER (ORDER BY remainder DESC, label)
                  <= train - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM parts)"""


@query(
    f"""WITH {QUOTA_SQL.format(label="o_orderpriority", table="orders")},
        ranked AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
                     ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR))) AS place FROM orders)
        SELECT o_orderkey, o_orderpriority,
               CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split
        FROM ranked JOIN quotas ON o_orderpriority = label"""
)
def stratified_split(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_orderpriority")
    return sampling.stratified_split(rows, "o_orderkey", "o_orderpriority")


@query(
    f"""WITH {QUOTA_SQL.format(label="l_returnflag", table="lineitem")}
        SELECT label AS l_returnflag, CAST(any_value(n) AS BIGINT) AS rows,
               CAST(any_value(quota) AS BIGINT) AS test_rows
        FROM counts JOIN quotas USING (label) GROUP BY 1"""
)
def stratified_split_of_repeated_ids(spark, sf):
    """Ids that repeat or are missing: the test rows of every class are exact all the same."""
    (lines,) = tables(spark, sf, "lineitem")
    key = F.when(F.col("l_linenumber") > 1, F.col("l_orderkey") % 50).alias("key")
    split = sampling.stratified_split(lines.select("*", key), "key", "l_returnflag")
    return split.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("split") == "test").alias("test_rows")
    )


@query(
    """SELECT o_orderpriority, count(*) AS rows,
              round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderpriority)
              FROM orders) * count(*)), 9) AS weight FROM orders GROUP BY o_orderpriority"""
)
def class_weights(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    weights = encoding.class_weights(encoding.category_counts(orders, ["o_orderpriority"]))
    rounded = weights.withColumn("weight", F.round("weight", 9))
    return rounded.withColumnRenamed("value", "o_orderpriority")


@query(
    f"""WITH {GAPPED_SQL}, best AS (SELECT event_type FROM gapped WHERE event_type IS NOT NULL
          GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
        SELECT event_id, coalesce(event_type, (SELECT event_type FROM best)) AS event_type FROM gapped"""
)
def mode_impute(spark, sf):
    events = gapped_events(spark, sf).select("event_id", "event_type")
    counts = encoding.category_counts(events, ["event_type"])
    best = encoding.modes(counts).select("value").scalar()
    return events.withColumn("event_type", F.coalesce("event_type", best))


@query(
    """WITH long AS (SELECT 'p_brand' AS "column", p_brand AS value FROM part UNION ALL
         SELECT 'p_type', p_type FROM part UNION ALL
         SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part)
       SELECT "column", value FROM (SELECT "column", value, row_number() OVER (
         PARTITION BY "column" ORDER BY count(*) DESC, value) AS place
         FROM long GROUP BY "column", value) AS r WHERE place = 1"""
)
def column_modes(spark, sf):
    (parts,) = tables(spark, sf, "part")
    return encoding.modes(encoding.category_counts(parts, ["p_brand", "p_type", "p_size"]))


ONE_HOT_SQL = """SELECT p_partkey, 'categorical__p_type_' || p_type AS feature, 1.0::DOUBLE AS value FROM part
       WHERE p_type <> 'PROMO'
       UNION ALL SELECT p_partkey, 'categorical__p_brand_' || p_brand, 1.0::DOUBLE FROM part"""


@query(ONE_HOT_SQL)
def one_hot(spark, sf):
    """Encoding learned without promo parts, so that their type is an unseen category."""
    return encoded_parts(spark, sf, forest.ForestParams())


@query(ONE_HOT_SQL)
def one_hot_by_dictionary(spark, sf):
    """The same with no category list on the driver: values are looked up in the written dictionary."""
    return encoded_parts(spark, sf, forest.ForestParams(max_listed=0))


def encoded_parts(spark, sf, params: forest.ForestParams) -> DataFrame:
    (parts,) = tables(spark, sf, "part")
    features = forest.FeatureSet(numeric=(), categorical=("p_type", "p_brand"), binary=())
    # Training rows: a promo part counts with its type missing.
    train = parts.withColumn("p_type", F.expr("nullif(p_type, 'PROMO')"))
    profile = forest.training_profile(train, features, params)
    prepare, names = forest.preprocessor(train, features, params, profile)
    vectors = prepare.transform(parts).select(
        "p_partkey", F.posexplode(forest.vector_to_array(forest.FEATURES)).alias("position", "value")
    )
    named = vectors.where("value <> 0").join(names, "position")
    return named.select("p_partkey", "feature", "value")


@query(
    """WITH long AS (SELECT 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS value FROM lineitem UNION ALL
         SELECT 'l_returnflag', l_returnflag FROM lineitem UNION ALL
         SELECT 'l_orderkey', CAST(l_orderkey AS VARCHAR) FROM lineitem)
       SELECT "column", value, count(*) AS n,
              row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS place
       FROM long WHERE value IS NOT NULL GROUP BY "column", value"""
)
def value_dictionary(spark, sf):
    """The numbers of a short and of two long lists of values."""
    (lines,) = tables(spark, sf, "lineitem")
    return encoding.dictionary(encoding.category_counts(lines, ["l_partkey", "l_returnflag", "l_orderkey"]))


SPLIT_ORDERS_SQL = f"""{QUOTA_SQL.format(label="o_orderpriority", table="orders")},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
               ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR))) AS place,
             CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price,
             CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_totalprice > 200000 AS INTEGER) END AS dear FROM orders),
  parted AS (SELECT *, place > quota AS training FROM ranked JOIN quotas ON o_orderpriority = label)"""
PRICED = forest.FeatureSet(numeric=("price",), categorical=(), binary=("dear",))


def priced_orders(spark, sf) -> tuple[DataFrame, DataFrame]:
    """All orders with gaps, and those of the training part of the split."""
    (orders,) = tables(spark, sf, "orders")
    price = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice"))
    dear = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") > 200000)
    gapped = orders.withColumns({"price": price, "dear": dear})
    split = sampling.stratified_split(gapped, "o_orderkey", "o_orderpriority")
    return gapped, split.where("split = 'train'").drop("split")


@query(
    f"""WITH {SPLIT_ORDERS_SQL}
        SELECT o_orderkey, coalesce(price, (SELECT median(price) FROM parted WHERE training)) AS price,
               CAST(coalesce(dear, (SELECT dear FROM parted WHERE training AND dear IS NOT NULL
                 GROUP BY dear ORDER BY count(*) DESC, dear LIMIT 1)) AS DOUBLE) AS dear
        FROM parted"""
)
def imputed_by_training_rows(spark, sf):
    """Gaps of all rows, filled with the exact median and the mode of the training rows."""
    gapped, train = priced_orders(spark, sf)
    params = forest.ForestParams(exact_medians=True)
    profile = forest.training_profile(train, PRICED, params, "o_orderpriority")
    prepare, _ = forest.preprocessor(train, PRICED, params, profile)
    vector = forest.vector_to_array(forest.FEATURES)
    return prepare.transform(gapped).select("o_orderkey", vector[0].alias("price"), vector[1].alias("dear"))


@query(
    f"""WITH {SPLIT_ORDERS_SQL} SELECT count(*) AS rows, count(price) AS values, true AS within
        FROM parted WHERE training"""
)
def training_median_rank(spark, sf):
    """The median merged from the sketches of all classes lies within 0.001 of the middle rank."""
    _, train = priced_orders(spark, sf)
    params = forest.ForestParams()
    profile = forest.training_profile(train, PRICED, params, "o_orderpriority")
    middle = forest.training_medians(train, PRICED, params, profile)["price"]
    ranks = train.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("price").alias("values"),
        F.count_if(F.col("price") < middle).alias("lower"),
        F.count_if(F.col("price") <= middle).alias("upto"),
    )
    within = F.expr("lower <= 0.501 * values + 1 AND upto >= 0.499 * values - 1")
    return ranks.select("rows", "values", within.alias("within"))


@query(
    """WITH ranked AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
         ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR))) AS place FROM orders),
       sizes AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
       SELECT o_orderkey, o_orderpriority, least(n, 150) AS drawn FROM ranked JOIN sizes USING (o_orderpriority)
       WHERE place <= least(n, 150)"""
)
def drawn_training_rows(spark, sf):
    """The bound on training rows, far below the table: equal shares of the classes in hashed order."""
    (orders,) = tables(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_orderpriority")
    sizes = {r["o_orderpriority"]: r["count"] for r in rows.groupBy("o_orderpriority").count().collect()}
    drawn, taken = forest.draw(rows, "o_orderpriority", "o_orderkey", sizes, 150 * len(sizes), S.SEED)
    table = spark.createDataFrame(list(taken.items()), "o_orderpriority string, drawn long")
    return drawn.join(table, "o_orderpriority")


# --- Learning: hotspots --------------------------------------------------------------------------


@query(
    """SELECT p_partkey,
         round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_samp(p_size) FROM part), 6)
           AS p_size,
         round((p_retailprice - (SELECT avg(p_retailprice) FROM part))
               / (SELECT stddev_samp(p_retailprice) FROM part), 6) AS p_retailprice
       FROM part"""
)
def standardise(spark, sf):
    (parts,) = tables(spark, sf, "part")
    features = ["p_size", "p_retailprice"]
    scaled = clustering.standardise(parts.select("p_partkey", *features), features)
    return scaled.select("p_partkey", *[F.round(f, 6).alias(f) for f in features])


@query(
    """WITH centres AS (SELECT l_returnflag AS flag, avg(l_quantity) AS a, avg(l_discount) AS b,
           avg(l_tax) AS c FROM lineitem GROUP BY l_returnflag),
         placed AS (SELECT *, row_number() OVER (ORDER BY flag) - 1 AS i FROM centres)
       SELECT l_orderkey, l_linenumber, l_partkey, CAST(arg_min(i,
           (l_quantity - a) * (l_quantity - a) + (l_discount - b) * (l_discount - b)
           + (l_tax - c) * (l_tax - c)) AS INTEGER) AS cluster_id
       FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem) AS l
       CROSS JOIN placed GROUP BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax"""
)
def assign_centroid(spark, sf):
    (lines,) = tables(spark, sf, "lineitem")
    features = ["l_quantity", "l_discount", "l_tax"]
    means = lines.groupBy("l_returnflag").agg(*[F.avg(f).alias(f) for f in features])
    centres = [row[1:] for row in pin(means).orderBy("l_returnflag").collect()]
    rows = lines.select("l_orderkey", "l_linenumber", "l_partkey", *features).distinct()
    assigned = clustering.assign_clusters(rows, features, centres)
    return assigned.drop(*features)


SILHOUETTE_SQL = """sums AS (SELECT g, c, count(*) AS n, sum(x) AS sx, sum(y) AS sy,
                  sum(x * x + y * y) AS q FROM rows GROUP BY g, c),
distances AS (SELECT r.g, r.id, r.c AS own, s.c, s.n,
       r.x * r.x + r.y * r.y + s.q / s.n - 2 * (r.x * s.sx + r.y * s.sy) / s.n AS d
  FROM rows r JOIN sums s ON r.g = s.g),
sides AS (SELECT g, id, max(CASE WHEN c = own THEN n END) AS n,
       max(CASE WHEN c = own AND n > 1 THEN d * n / (n - 1) END) AS a,
       min(CASE WHEN c <> own THEN d END) AS b FROM distances GROUP BY g, id),
scores AS (SELECT g, avg(CASE WHEN n = 1 OR b IS NULL THEN 0.0 WHEN a < b THEN 1 - a / b
       WHEN a > b THEN b / a - 1 ELSE 0.0 END) AS score FROM sides GROUP BY g)"""


@query(
    f"""WITH rows AS (SELECT 0 AS g, p_partkey AS id, p_type AS c, CAST(p_size AS DOUBLE) AS x,
              p_retailprice / 100 AS y FROM part), {SILHOUETTE_SQL}
        SELECT round(score, 6) AS silhouette_score FROM scores"""
)
def silhouette(spark, sf):
    (parts,) = tables(spark, sf, "part")
    scaled = parts.withColumn("price", F.col("p_retailprice") / 100)
    score = clustering.silhouette(scaled, ["p_size", "price"], "p_type")
    return score.select(F.round("silhouette_score", 6).alias("silhouette_score"))


@query(
    f"""WITH ks AS (SELECT CAST(unnest(range(3, 9)) AS INTEGER) AS k),
        rows AS (SELECT k AS g, p_partkey AS id, (p_size - 1) * k // 50 AS c,
                 CAST(p_size AS DOUBLE) AS x, p_retailprice / 100 AS y FROM part, ks),
        {SILHOUETTE_SQL}
        SELECT g AS k, round(score, 6) AS silhouette_score,
               g = (SELECT g FROM scores ORDER BY round(score, 6) DESC, g LIMIT 1) AS selected
        FROM scores"""
)
def best_k(spark, sf):
    """Parts cut into k equal ranges of size: silhouette of every k, and the k that wins."""
    (parts,) = tables(spark, sf, "part")
    rows = parts.select("p_size", (F.col("p_retailprice") / 100).alias("price"))
    scores = []
    for k in S.CLUSTER_COUNTS:
        cut = rows.withColumn("c", F.expr(f"(p_size - 1) * {k} div 50"))
        score = clustering.silhouette(cut, ["p_size", "price"], "c")
        scores.append(score.select(F.lit(k).alias("k"), "silhouette_score"))
    table = pin(functools.reduce(DataFrame.unionByName, scores))
    rounded = table.withColumn("silhouette_score", F.round("silhouette_score", 6))
    return reports.evaluation_curve(rounded)


@query()
def kmeans_sweep(spark, sf):
    """K-means for every k over points that rarely repeat."""
    (parts,) = tables(spark, sf, "part")
    return hotspots.fit_hotspots(parts, ["p_size", "p_retailprice"]).evaluation


@query(
    """SELECT CAST(k AS INTEGER) AS k, count(*) AS rows, k AS clusters, true AS score_holds
       FROM part, (SELECT unnest(range(3, 9)) AS k) GROUP BY k"""
)
def kmeans_sweep_holds(spark, sf):
    """Every k of the sweep: all rows are placed, no cluster is empty, and the library's own
    evaluator gives the score."""
    (parts,) = tables(spark, sf, "part")
    names = ["p_size", "p_retailprice"]
    found = hotspots.fit_hotspots(parts, names)
    scores = found.evaluation
    results = []
    for k, centres in found.centres.items():
        placed = clustering.assign_clusters(parts, names, centres, found.scaling)
        vectors = VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(
            placed.select(
                *[found.scaling.scaled(n).alias(a) for n, a in zip(names, "xy")],
                F.col(S.CLUSTER).cast("double").alias("c"),
            )
        )
        want = ClusteringEvaluator(featuresCol="v", predictionCol="c").evaluate(vectors)
        score = scores.where(F.col("k") == k).select("silhouette_score").scalar()
        results.append(
            placed.agg(
                F.lit(k).alias("k"),
                F.count(S.CLUSTER).alias("rows"),
                F.count_distinct(S.CLUSTER).alias("clusters"),
            ).withColumn("score_holds", F.abs(score - want) < 1e-9)
        )
    return functools.reduce(DataFrame.unionByName, results)


def staged_incidents(spark, sf) -> DataFrame:
    raw = standin.incidents(spark, sf)
    return stage(engineering.engineer(cleaning.clean(raw)), "engineered")


@query()
def hotspots_of_incidents(spark, sf):
    """From raw incidents to the hotspot summary."""
    engineered = staged_incidents(spark, sf)
    found = hotspots.fit_hotspots(engineered)
    return hotspots.summarise(found.assign(engineered))


@query(
    """SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS rows,
              count(DISTINCT (l_orderkey, l_linenumber)) AS clustered, true AS k_in_range,
              0::BIGINT AS misplaced
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def hotspots_cover(spark, sf):
    """Every incident is in one hotspot, and no centre is nearer than that of its hotspot."""
    engineered = staged_incidents(spark, sf)
    found = hotspots.fit_hotspots(engineered)
    placed = found.assign(engineered)
    centres = found.centres[found.best_k]
    values = [found.scaling.scaled(f) for f in found.features]
    distances = F.array(
        *[sum((v - x) * (v - x) for v, x in zip(values, centre)) for centre in centres]
    )
    nearer = F.get(distances, F.col(S.CLUSTER)) > F.array_min(distances)
    return placed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(S.CLUSTER).alias("clustered"),
        (F.max(S.CLUSTER) < F.lit(found.best_k)).alias("k_in_range"),
        F.count_if(nearer).alias("misplaced"),
    )


# --- Learning: risk ------------------------------------------------------------------------------

CONFUSION_SQL = f"""rated AS (SELECT {PRIORITY_RISK_SQL} AS truth, {PRICE_RISK_SQL} AS predicted
  FROM orders),
listed AS (SELECT * FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS v(i, label)),
cells AS (SELECT a.i AS true_order, b.i AS predicted_order, a.label AS truth, b.label AS predicted,
    (SELECT count(*) FROM rated r WHERE r.truth = a.label AND r.predicted = b.label) AS n
  FROM listed a CROSS JOIN listed b),
scores AS (SELECT c.label AS class, c.h AS hits, c.s AS support,
    CASE WHEN c.p = 0 THEN 0.0 ELSE c.h / c.p END AS precision,
    CASE WHEN c.s = 0 THEN 0.0 ELSE c.h / c.s END AS recall
  FROM (SELECT l.label,
          (SELECT sum(n) FROM cells WHERE truth = l.label AND predicted = l.label)::DOUBLE AS h,
          (SELECT sum(n) FROM cells WHERE truth = l.label)::DOUBLE AS s,
          (SELECT sum(n) FROM cells WHERE predicted = l.label)::DOUBLE AS p FROM listed l) AS c),
full_scores AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
    ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM scores)"""


@query(f"WITH {CONFUSION_SQL} SELECT * FROM cells")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(rated_orders(spark, sf))


@query(
    f"""WITH {CONFUSION_SQL}, wide AS (
          SELECT class, precision, recall, f1, support FROM full_scores UNION ALL
          SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM full_scores UNION ALL
          SELECT 'weighted avg', sum(precision * support) / sum(support),
                 sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
          FROM full_scores)
        SELECT 'precision' AS metric, class, round(precision, 9) AS value FROM wide UNION ALL
        SELECT 'recall', class, round(recall, 9) FROM wide UNION ALL
        SELECT 'f1', class, round(f1, 9) FROM wide UNION ALL
        SELECT 'support', class, support FROM wide UNION ALL
        SELECT 'accuracy', 'all', round(sum(hits) / sum(support), 9) FROM full_scores"""
)
def classification_report(spark, sf):
    matrix = metrics.confusion_matrix(rated_orders(spark, sf))
    report = metrics.classification_report(matrix)
    return report.withColumn("value", F.round("value", 9))


@query(
    f"""WITH {CONFUSION_SQL} SELECT round(avg(recall), 9) AS balanced_accuracy
        FROM full_scores WHERE support > 0"""
)
def balanced_accuracy(spark, sf):
    matrix = metrics.confusion_matrix(rated_orders(spark, sf))
    return metrics.balanced_accuracy(matrix).select(
        F.round("balanced_accuracy", 9).alias("balanced_accuracy")
    )


METRICS_SQL = f"""WITH {CONFUSION_SQL}, wide AS (
          SELECT class, precision, recall, f1, support FROM full_scores UNION ALL
          SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM full_scores UNION ALL
          SELECT 'weighted avg', sum(precision * support) / sum(support),
                 sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
          FROM full_scores),
        metrics AS (SELECT 'precision' AS metric, class, precision AS value FROM wide UNION ALL
        SELECT 'recall', class, recall FROM wide UNION ALL
        SELECT 'f1', class, f1 FROM wide UNION ALL
        SELECT 'support', class, support FROM wide UNION ALL
        SELECT 'accuracy', 'all', sum(hits) / sum(support) FROM full_scores UNION ALL
        SELECT 'balanced_accuracy', 'all', avg(recall) FROM full_scores WHERE support > 0 UNION ALL
        SELECT 'confusion ' || truth, predicted, n FROM cells UNION ALL
        SELECT 'testing_records', 'all', sum(n) FROM cells)"""


def written_metrics(spark, sf) -> DataFrame:
    """All metrics of rated orders, written as one CSV file and read back."""
    path = f"{shared_folder(spark)}/mishap/metrics-{uuid.uuid4().hex}.csv"
    write_small(risk.evaluate(rated_orders(spark, sf)), path)
    return read_table(spark, path, S.METRICS)


@query(f"{METRICS_SQL} SELECT metric, class, round(value, 9) AS value FROM metrics")
def metrics_round_trip(spark, sf):
    return written_metrics(spark, sf).withColumn("value", F.round("value", 9))


@query(
    f"""{METRICS_SQL}, curve AS (SELECT CAST(l_linenumber AS INTEGER) AS k, round(avg(l_tax), 9) AS score
          FROM lineitem GROUP BY 1)
        SELECT count(*) AS analyzed_incidents, count(DISTINCT l_linenumber) AS identified_hotspots,
          (SELECT max(score) FROM curve) AS best_silhouette,
          (SELECT k FROM curve ORDER BY score DESC, k LIMIT 1) AS best_k,
          (SELECT round(value, 9) FROM metrics WHERE metric = 'balanced_accuracy') AS balanced_accuracy,
          (SELECT round(value, 9) FROM metrics WHERE metric = 'accuracy') AS overall_accuracy,
          (SELECT CAST(value AS BIGINT) FROM metrics WHERE metric = 'testing_records') AS testing_records
        FROM lineitem"""
)
def kpis_of_written_tables(spark, sf):
    """The KPI row from assigned rows, a table of scores per k, and metrics read back from their file."""
    (lines,) = tables(spark, sf, "lineitem")
    clustered = lines.withColumn(S.CLUSTER, F.col("l_linenumber").cast("int"))
    score = F.round(F.avg("l_tax"), 9).alias("silhouette_score")
    evaluation = pin(clustered.groupBy(F.col(S.CLUSTER).alias("k")).agg(score))
    row = reports.kpis(clustered, evaluation, pin(written_metrics(spark, sf)))
    return row.withColumns({c: F.round(c, 9) for c in ("balanced_accuracy", "overall_accuracy")})


def incident_risk(spark, sf) -> risk.RiskRun:
    return risk.train_risk(staged_incidents(spark, sf))


@query(
    f"""WITH incidents AS ({standin.engineered_sql()}),
        labelled AS (SELECT *, CASE "Severity" WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' ELSE 'High' END
                     AS "Risk_Category" FROM incidents),
        {QUOTA_SQL.format(label='"Risk_Category"', table="labelled")},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY "Risk_Category"
                     ORDER BY md5('42:' || "ID")) AS place FROM labelled)
        SELECT "ID", "Start_Time", "Start_Lat", "Start_Lng", "Severity", "Risk_Category",
               true AS known_class, 1.0::DOUBLE AS probability_total
        FROM ranked JOIN quotas ON "Risk_Category" = label WHERE place <= quota"""
)
def risk_predictions(spark, sf):
    """The prediction table: the held-out rows in full, each with a class and probabilities."""
    predictions = plain_times(incident_risk(spark, sf).predictions)
    chances = [F.col(f"Probability_{c}") for c in sorted(S.RISK_CLASSES)]
    return predictions.select(
        *S.PREDICTION_CONTEXT,
        F.col(S.PREDICTED_RISK).isin(S.RISK_CLASSES).alias("known_class"),
        F.round(sum(chances[1:], chances[0]), 6).alias("probability_total"),
    )


@query()
def risk_metrics(spark, sf):
    return risk.evaluate(incident_risk(spark, sf).predictions)


@query(
    f"""WITH incidents AS ({standin.engineered_sql()}),
        labelled AS (SELECT CASE "Severity" WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' ELSE 'High' END
                     AS risk FROM incidents),
        {QUOTA_SQL.format(label="risk", table="labelled")}
        SELECT 'support' AS metric, label AS class, CAST(quota AS DOUBLE) AS value FROM quotas
        UNION ALL SELECT 'testing_records', 'all', CAST(sum(quota) AS DOUBLE) FROM quotas
        UNION ALL SELECT 'training_records', 'all', CAST((SELECT sum(n) FROM counts) - sum(quota) AS DOUBLE) FROM quotas"""
)
def risk_support(spark, sf):
    """Those metrics of the fitted model that do not depend on its predictions."""
    run = incident_risk(spark, sf)
    table = risk.evaluate(run.predictions, run.model.training_rows)
    totals = F.col("metric").isin("testing_records", "training_records")
    return table.where(totals | ((F.col("metric") == "support") & F.col("class").isin(S.RISK_CLASSES)))


@query(
    f"""WITH incidents AS ({standin.engineered_sql()}),
        labelled AS (SELECT CASE "Severity" WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' ELSE 'High' END
                     AS risk FROM incidents),
        {QUOTA_SQL.format(label="risk", table="labelled")}
        SELECT CAST(sum(quota) AS BIGINT) AS rows, 0::BIGINT AS not_the_likeliest, true AS learned,
               true AS accuracy_holds, true AS balanced_holds, true AS importances_add_up
        FROM quotas"""
)
def risk_model_holds(spark, sf):
    """The forest of the default size: every class is the likeliest one, the metrics are those of
    the predictions, importances add up to 1, and it beats chance by far."""
    run = risk.train_risk(staged_incidents(spark, sf))
    predictions = stage(run.predictions, "predictions")
    chances = [(c, F.col(f"Probability_{c}")) for c in sorted(S.RISK_CLASSES)]
    best = F.greatest(*[chance for _, chance in chances])
    own = F.coalesce(*[F.when(F.col(S.PREDICTED_RISK) == c, chance) for c, chance in chances])
    hit = (F.col(S.PREDICTED_RISK) == F.col(S.RISK)).cast("double")
    recalls = predictions.groupBy(S.RISK).agg(F.avg(hit).alias("recall"))
    balanced = recalls.agg(F.avg("recall")).scalar()
    table = pin(risk.evaluate(predictions, run.model.training_rows))

    def metric(name: str):
        return table.where((F.col("metric") == name) & (F.col("class") == "all")).select("value").scalar()

    total = run.importance.agg(F.sum("importance")).scalar()
    counts = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(own < best).alias("not_the_likeliest"),
        F.avg(hit).alias("accuracy"),
    )
    return counts.select(
        "rows",
        "not_the_likeliest",
        (balanced > 0.6).alias("learned"),
        (F.abs(metric("accuracy") - F.col("accuracy")) < 1e-9).alias("accuracy_holds"),
        (F.abs(metric("balanced_accuracy") - balanced) < 1e-9).alias("balanced_holds"),
        (F.abs(total - 1) < 1e-9).alias("importances_add_up"),
    )


@query()
def feature_importance(spark, sf):
    return incident_risk(spark, sf).importance


def _feature_list_sql() -> str:
    names = [f"numerical__{c}" for c in S.RISK_NUMERIC] + [f"binary__{c}" for c in S.RISK_BINARY]
    listed = ", ".join(f"('{n}')" for n in names)
    categorical = " ".join(
        f"""UNION ALL SELECT DISTINCT 'categorical__{c}_' || "{c}" FROM incidents
            WHERE "{c}" IS NOT NULL"""
        for c in S.RISK_CATEGORICAL
    )
    return f"""WITH incidents AS ({standin.engineered_sql()})
        SELECT feature, true AS in_range
        FROM (SELECT * FROM (VALUES {listed}) AS v(feature) {categorical}) AS f"""


@query(_feature_list_sql())
def feature_importance_names(spark, sf):
    """The vector's entries by name; each has an importance from 0 to 1."""
    importance = incident_risk(spark, sf).importance
    return importance.select("feature", F.col("importance").between(0, 1).alias("in_range"))


@query()
def kpis(spark, sf):
    engineered = staged_incidents(spark, sf)
    found = hotspots.fit_hotspots(engineered)
    run = risk.train_risk(engineered)
    return reports.kpis(found.assign(engineered), found.evaluation, pin(risk.evaluate(run.predictions)))


# --- Whole stages --------------------------------------------------------------------------------


def exactly_cleaned(spark, sf) -> DataFrame:
    """Cleaned incidents with exact medians of the deduplicated rows."""
    raw = standin.incidents(spark, sf)
    return cleaning.clean(raw, median_values=lambda unique: exact_medians(unique, S.MEASURED))


@query(standin.cleaned_sql())
def cleaned_incidents(spark, sf):
    return plain_times(exactly_cleaned(spark, sf))


@query(standin.engineered_sql())
def engineered_incidents(spark, sf):
    return plain_times(engineering.engineer(exactly_cleaned(spark, sf)))
