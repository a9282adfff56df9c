"""Stand-ins: the driver's tables seen as user-activity data.

The driver's ``events`` have an id, a time, a user, a type, a value and a small JSON
text with one number ``k``. Users are customers, countries are their nations, and ``k``
stands for the page element, feature or video position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import schema
from eventloom.functions.scalar import hashed_id, user_label
from eventloom.session import prepare
from eventloom.sources.files import read_table, spread

DRIVER_TYPES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(prepare(spark), folder, name)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def feature() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles: user_id, user_name, segment, country."""
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
    named = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
    )


def placed(df: DataFrame) -> DataFrame:
    """Events that state a country of their own and carry metadata."""
    return df.withColumns({"country": F.when(feature() < 50, "IN").otherwise("US"), "metadata": F.col("props")})


def known_users(spark: SparkSession, folder: str) -> DataFrame:
    """A user table with gaps: only customers whose balance is not negative."""
    kept = table(spark, folder, "customer").where(F.col("c_acctbal") >= 0)
    return kept.select(F.col("c_custkey").alias("user_id"))


def of_type(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("event_type") == kind)


def clean_events(df: DataFrame) -> DataFrame:
    """Driver events as wide typed rows that pass every rule."""
    kind = (
        F.when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "signup", "login")
        .when(F.col("event_type") == "error", "logout")
        .otherwise(F.col("event_type"))
    )
    numbered = spread(df).withColumn("k", feature()).withColumn("kind", kind)
    is_click, is_purchase = F.col("kind") == "click", F.col("kind") == "purchase"
    known = {
        "event_id": F.col("event_id").cast("string"),
        "user_id": user_label(F.col("user_id")),
        "session_id": hashed_id("sess_", 12, F.col("user_id"), F.to_date("ts")),
        "event_type": F.col("kind"),
        "timestamp": F.col("ts").cast("timestamp"),
        "device": F.lit("web"),
        "country": F.lit("IN"),
        "value": F.col("value"),
        "currency": F.when(is_purchase, "INR").otherwise("USD"),
        "metadata": F.col("props"),
        "product_id": F.when(is_purchase, F.concat(F.lit("prod_"), F.col("k").cast("string"))),
        "quantity": F.when(is_purchase, F.col("k") + 1),
        "element_id": F.when(is_click, F.concat(F.lit("btn_"), F.col("k").cast("string"))),
        "element_type": F.when(is_click, "button"),
    }
    columns = [
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.EVENT_SCHEMA
    ]
    return numbered.select(*columns)


# Type of the message made from an event; also used in the SQL checks.
MESSAGE_TYPE = """CASE
    WHEN event_type = 'view' AND k < 50 THEN 'page_view'
    WHEN event_type = 'view' THEN 'video_watch'
    WHEN event_type = 'signup' AND k < 50 THEN 'login'
    WHEN event_type = 'signup' THEN 'search'
    WHEN event_type = 'error' AND k < 30 THEN 'cart_add'
    WHEN event_type = 'error' AND k < 60 THEN 'logout'
    WHEN event_type = 'error' THEN 'Error'
    ELSE event_type END"""

# JSON text per key, NULL for an absent key. ``k`` decides which rows get which fault.
MESSAGE_FIELDS = {
    "event_id": "concat('\"', event_id, '\"')",
    "user_id": r"""CASE WHEN k <= 6 THEN r'"\t "' WHEN k <= 9 THEN r'" 　"' WHEN k = 13 THEN '123'
        ELSE concat('"user_', lpad(cast(user_id AS string), 5, '0'), '"') END""",
    "session_id": """CASE WHEN k BETWEEN 5 AND 11 THEN '""' WHEN k <> 12 THEN concat('"sess_', event_id, '"') END""",
    "event_type": "concat('\"', kind, '\"')",
    "timestamp": """CASE WHEN k = 85 THEN '"not a time"' ELSE concat('"',
        date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), CASE WHEN k < 50 THEN 'Z"' ELSE '"' END) END""",
    "device": """CASE WHEN k BETWEEN 20 AND 22 THEN '"tv"' WHEN k = 23 THEN 'null' WHEN k BETWEEN 24 AND 30 THEN NULL
        WHEN k < 50 THEN '"mobile"' WHEN k < 70 THEN '"tablet"' ELSE '"desktop"' END""",
    "country": """CASE WHEN k = 86 THEN 'null' WHEN k = 87 THEN '5' WHEN k < 40 THEN NULL ELSE '"US"' END""",
    "ip_address": "concat('\"10.0.0.', CASE WHEN k >= 95 THEN k * 3 ELSE k END, '\"')",
    "page": "concat('\"/p/', k, '\"')",
    "duration_seconds": """CASE WHEN kind = 'video_watch' AND k <> 56 THEN
        cast(CASE WHEN k < 60 THEN 1200 ELSE 36 * k END AS string) END""",
    "value": """CASE WHEN k BETWEEN 8 AND 14 THEN cast(-value AS string) WHEN k = 15 THEN '"12.34"'
        WHEN k = 16 THEN '"abc"' WHEN k = 17 THEN NULL WHEN k = 18 THEN 'null' WHEN k = 19 THEN '"NaN"'
        ELSE cast(value AS string) END""",
    "currency": """CASE WHEN kind = 'purchase' THEN CASE WHEN k = 82 THEN 'null' ELSE '"INR"' END END""",
    "metadata": """CASE WHEN k = 80 THEN 'null' WHEN k = 81 THEN NULL WHEN k = 88 THEN '[1]'
        ELSE concat('{"k": ', k, '}') END""",
    "product_id": """CASE WHEN kind = 'purchase' AND k <> 72 THEN concat('"prod_', k, '"') END""",
    "quantity": """CASE WHEN kind = 'purchase' THEN CASE WHEN k BETWEEN 31 AND 33 THEN '0' WHEN k = 34 THEN '2.5'
        WHEN k = 35 THEN '"2"' WHEN k = 36 THEN '2.0' WHEN k BETWEEN 37 AND 39 THEN '-1'
        WHEN k BETWEEN 40 AND 50 THEN NULL WHEN k >= 90 THEN '60' ELSE cast(k + 1 AS string) END END""",
    "video_id": """CASE WHEN kind = 'video_watch' AND k <> 55 THEN concat('"vid_', k DIV 10, '"') END""",
    "watched_percentage": """CASE WHEN kind = 'video_watch' THEN CASE WHEN k BETWEEN 50 AND 52 THEN '100.01'
        WHEN k = 53 THEN '-0.01' WHEN k = 54 THEN '100' ELSE cast(k AS string) END END""",
    "video_duration": "CASE WHEN kind = 'video_watch' THEN '3600' END",
    "element_id": """CASE WHEN kind = 'click' AND k <> 60 THEN concat('"btn_', k, '"') END""",
    "element_type": """CASE WHEN kind = 'click' THEN CASE WHEN k = 61 THEN 'null' ELSE '"button"' END END""",
    "x_coordinate": """CASE WHEN kind = 'click' THEN CASE WHEN k = 62 THEN '"left"' ELSE cast(k * 25 AS string) END END""",
    "y_coordinate": "CASE WHEN kind = 'click' THEN cast(k * 12 AS string) END",
    "query": """CASE WHEN kind = 'search' AND k <> 70 THEN concat('"topic ', k DIV 10, '"') END""",
    "results_count": """CASE WHEN kind = 'search' THEN CASE WHEN k = 75 THEN '1.5' WHEN k = 76 THEN NULL
        ELSE cast((k - 50) * 3 AS string) END END""",
    "unknown_key": "'true'",
}


def messages(df: DataFrame) -> DataFrame:
    """One JSON message per driver event, many of them faulty: (row_id, ts, value)."""
    typed = spread(df).withColumn("k", feature()).withColumn("kind", F.expr(MESSAGE_TYPE))
    pairs = [F.concat(F.lit(f'"{name}":'), F.expr(text)) for name, text in MESSAGE_FIELDS.items()]
    body = F.concat_ws(",", *pairs)
    value = (
        F.when(F.col("k") == 83, F.concat(F.lit("{"), body))
        .when(F.col("k") == 89, F.lit("[1, 2]"))
        .otherwise(F.concat(F.lit("{"), body, F.lit("}")))
    )
    return typed.select(F.col("event_id").alias("row_id"), "ts", value.alias("value"))


# The same faults derived from ``k`` alone, as the common start of the SQL checks.
MESSAGES_SQL = f"""WITH numbered AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
typed AS (SELECT *, {MESSAGE_TYPE} AS kind FROM numbered),
checked AS (
    SELECT *, CASE WHEN k IN (83, 89) THEN 'malformed_json' ELSE concat_ws(',',
        CASE WHEN k <= 9 THEN 'blank_user_id' WHEN k = 13 THEN 'type_user_id' END,
        CASE WHEN k BETWEEN 5 AND 11 THEN 'blank_session_id' WHEN k = 12 THEN 'missing_session_id' END,
        CASE WHEN kind = 'Error' THEN 'unknown_event_type' END,
        CASE WHEN k = 85 THEN 'type_timestamp' END,
        CASE WHEN k BETWEEN 20 AND 22 THEN 'unknown_device' WHEN k = 23 THEN 'null_device' END,
        CASE WHEN k = 86 THEN 'null_country' WHEN k = 87 THEN 'type_country' END,
        CASE WHEN kind = 'video_watch' AND k = 56 THEN 'missing_duration_seconds' END,
        CASE WHEN k BETWEEN 8 AND 14 THEN 'negative_value' WHEN k = 16 THEN 'type_value'
             WHEN k = 19 THEN 'non_finite_value' WHEN kind <> 'purchase' THEN NULL
             WHEN k = 17 THEN 'missing_value' WHEN k = 18 THEN 'null_value' END,
        CASE WHEN kind = 'purchase' AND k = 82 THEN 'null_currency' END,
        CASE WHEN k = 80 THEN 'null_metadata' WHEN k = 88 THEN 'type_metadata' END,
        CASE WHEN kind = 'purchase' AND k = 72 THEN 'missing_product_id' END,
        CASE WHEN kind <> 'purchase' THEN NULL WHEN k = 34 THEN 'type_quantity'
             WHEN k BETWEEN 31 AND 39 AND k NOT IN (35, 36) THEN 'nonpositive_quantity' END,
        CASE WHEN kind = 'video_watch' AND k = 55 THEN 'missing_video_id' END,
        CASE WHEN kind = 'video_watch' AND k BETWEEN 50 AND 53 THEN 'watched_percentage_out_of_range' END,
        CASE WHEN kind = 'click' AND k = 60 THEN 'missing_element_id' END,
        CASE WHEN kind = 'click' AND k = 61 THEN 'null_element_type' END,
        CASE WHEN kind = 'click' AND k = 62 THEN 'type_x_coordinate' END,
        CASE WHEN kind = 'search' AND k = 70 THEN 'missing_query' END,
        CASE WHEN kind = 'search' AND k = 75 THEN 'type_results_count' END) END AS faults
    FROM typed)
"""
