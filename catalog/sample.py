"""The given tables seen as activity data. Every function reads a whole table.

Lazy views only; the same definitions stand as SQL in `oracle.py`.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from milepost.functions.calendar import epoch_ms
from milepost.functions.values import lower_names
from milepost.plans.points import points_per, scoring
from milepost.schemas import ACTIVITY_EVENT, ACTIVITY_TRANSACTION, CREATE_USER_EVENT

DAY_MS = 86_400_000
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz"
)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(column):
    return F.col(column).cast("string")


def as_events(events: DataFrame) -> DataFrame:
    stamp = epoch_ms(F.col("ts"))
    kind = F.col("event_type")
    columns = {
        "Id": text("event_id"),
        "Phone": text("user_id"),
        "Date": (F.floor(stamp / DAY_MS) * DAY_MS).cast("bigint"),
        "Month": F.month("ts"),
        "Year": F.year("ts"),
        "TimeStamp": stamp,
        "MembershipCode": F.lit("Level1"),
        "Event": kind,
        "ReportCode": kind,
        "EventName": kind,
        "ReportName": kind,
        "Data": F.col("props"),
    }
    return events.select(*[columns[name].alias(name) for name in ACTIVITY_EVENT.names])


def as_transactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items are not unique by (order, line): natural duplicates."""
    stamp = epoch_ms(F.col("l_shipdate"))
    columns = {
        "Id": F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber")),
        "Phone": text("o_custkey"),
        "Date": (F.floor(stamp / DAY_MS) * DAY_MS).cast("bigint"),
        "Month": F.month("l_shipdate"),
        "Year": F.year("l_shipdate"),
        "EventCode": F.col("o_orderstatus"),
        "ReportCode": F.col("l_returnflag"),
        "ActivityId": F.lit(None).cast("string"),
        "CampaignId": F.col("o_orderpriority"),
        "RuleId": text("l_suppkey"),
        "CampaignName": F.concat(F.lit("Campaign "), F.col("o_orderpriority")),
        "RuleName": F.concat(F.lit("Rule "), text("l_suppkey")),
        "EventName": F.concat(F.lit("Order "), F.col("o_orderstatus")),
        "ReportName": F.concat(F.lit("Return "), F.col("l_returnflag")),
        "MembershipCode": F.when(F.col("l_linestatus") == "O", "Level1").otherwise("Level2"),
        "Name": F.when(F.col("l_returnflag") == "R", "AddPoint").otherwise("Notify"),
        "Value": F.col("l_quantity").cast("int"),
        "TimeStamp": stamp,
        "Type": F.col("l_linestatus"),
    }
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*[columns[name].alias(name) for name in ACTIVITY_TRANSACTION.names])


def activity_events(spark, folder):
    return as_events(load(spark, folder, "events"))


def transactions(spark, folder):
    return as_transactions(load(spark, folder, "lineitem"), load(spark, folder, "orders"))


def profiles(spark, folder):
    """Customers with their all-time points; overdrawn ones have none on file."""
    scored = lower_names(scoring(transactions(spark, folder)))
    points = points_per(scored, []).select(
        F.col("phone").alias("Phone"), "points", F.timestamp_millis("timestamp").alias("LastModified")
    )
    customers = load(spark, folder, "customer").select(
        text("c_custkey").alias("Id"),
        text("c_custkey").alias("Phone"),
        F.lit(1).alias("Level"),
        (F.col("c_custkey") + 1).cast("int").alias("Rank"),
        F.lit("Level1").alias("MembershipCode"),
        (F.col("c_acctbal") < 0).alias("overdrawn"),
    )
    total = F.when(~F.col("overdrawn"), F.col("points")).alias("TotalPoints")
    return customers.join(points, "Phone", "left").select(
        "Id", "Phone", "Level", total, "Rank", "LastModified", "MembershipCode"
    )


def driving_reports(spark, folder):
    """Views and clicks come from app devices, other events from another make."""
    events = load(spark, folder, "events")
    app = F.col("event_type").isin("view", "click")
    day = F.floor(epoch_ms(F.col("ts")) / DAY_MS) * (DAY_MS // 1000) - 7 * 3600
    return events.select(
        F.concat(F.when(app, "VML_").otherwise("OBD_"), F.lpad(text("user_id"), 12, "0")).alias("deviceimei"),
        day.cast("bigint").alias("date"),
        F.floor(F.col("value") * 100).cast("int").alias("distance"),
        F.hour("ts").alias("drivingtime"),
        F.month("ts").alias("month"),
        F.year("ts").alias("year"),
    )


def device_users(spark, folder):
    """Fewer suppliers than users, so some devices are unknown."""
    return load(spark, folder, "supplier").select(text("s_suppkey").alias("device_id"), F.col("s_name").alias("Phone"))


def live_reports(spark, folder):
    submitted = F.floor(epoch_ms(F.col("ts")) / 1000).cast("bigint")
    status = (
        F.when(F.col("event_type") == "click", "WaitingVerification")
        .when(F.col("event_type") == "view", "Verified")
        .otherwise("Rejected")
    )
    return load(spark, folder, "events").select(
        text("event_id").alias("id"),
        F.concat(F.lit("cell "), text("user_id")).alias("cell_id"),
        (F.col("event_id") % 180 - 90).cast("double").alias("lat"),
        (F.col("event_id") % 360 - 180).cast("double").alias("lng"),
        F.col("value").alias("user_heading"),
        F.col("event_type").alias("category_id"),
        (submitted + 86400).alias("expired_display_time"),
        text("user_id").alias("road_link_id"),
        F.hour("ts").alias("number_of_view"),
        F.minute("ts").alias("number_of_confirm"),
        F.month("ts").alias("number_of_rejection"),
        F.lit("#FF0000").alias("minimization_hex_color"),
        F.lit("Point").alias("geom_type"),
        F.lit(None).cast("string").alias("lines"),
        status.alias("status"),
        submitted.alias("submit_time"),
        F.lit(None).cast("bigint").alias("last_modified"),
        F.lit(None).cast("string").alias("last_modified_by"),
    )


def file_stream(spark, folder, name, schema):
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def as_messages(rows: DataFrame) -> DataFrame:
    """Rows as queue messages: a JSON array each, as bytes, made where the rows are."""
    return rows.select(F.to_json(F.array(F.struct(*rows.columns))).cast("binary").alias("value"))


def event_messages(spark, folder):
    return as_messages(as_events(file_stream(spark, folder, "events", EVENTS)))


def transaction_messages(spark, folder):
    lineitem = file_stream(spark, folder, "lineitem", LINEITEM)
    return as_messages(as_transactions(lineitem, load(spark, folder, "orders")))


def user_messages(spark, folder):
    """Sign-ups as user-creation messages; other events keep their own kind."""
    events = file_stream(spark, folder, "events", EVENTS)
    kind = F.when(F.col("event_type") == "signup", CREATE_USER_EVENT).otherwise(F.col("event_type"))
    user = F.struct(F.struct(text("user_id").alias("Phone")).alias("User"))
    message = F.to_json(F.struct(kind.alias("Event"), F.to_json(F.array(user)).alias("Datas")))
    return events.select(message.cast("binary").alias("value"))
