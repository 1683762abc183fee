"""Points of members kept up to date from the transaction topic.

Each batch adds its sums to a replay-safe ledger; the member tables are the base
table plus the folded ledger.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from milepost.functions.messages import decode_rows
from milepost.functions.values import lower_names
from milepost.operators import ledger
from milepost.plans.points import increment_members, increment_profiles, points_per, scoring
from milepost.schemas import ACTIVITY_TRANSACTION, DEFAULT_TIER, MEMBERSHIP_MONTHLY, MEMBERSHIP_YEARLY, layout
from milepost.streaming.runner import kept, start

SCORE_FIELDS = ["Phone", "MembershipCode", "Month", "Year", "Name", "Value", "TimeStamp"]
PERIODS = {"month": ["month", "year"], "year": ["year"], "all": []}
TABLES = {"month": MEMBERSHIP_MONTHLY, "year": MEMBERSHIP_YEARLY}


def scored_rows(messages: DataFrame) -> DataFrame:
    """Scoring transactions of a message stream, lower-case columns. Only these fields are parsed."""
    rows = decode_rows(messages, StructType([ACTIVITY_TRANSACTION[name] for name in SCORE_FIELDS]))
    rows = rows.fillna({"Value": 0, "Name": "Unknown", "MembershipCode": DEFAULT_TIER})
    return lower_names(scoring(rows).drop("Name"))


def _delta_schema(period: str) -> StructType:
    periods = "".join(f"{name} int, " for name in PERIODS[period])
    return layout(f"phone string, {periods}points bigint, timestamp bigint, membershipcode string")


def stream_points(messages: DataFrame, root: str, checkpoint: str, period: str = "month", every: str | None = None) -> StreamingQuery:
    """Add up points per member by "month", "year" or over "all" time."""
    columns = _delta_schema(period).names

    def handle(batch: DataFrame, batch_id: int, stream: str) -> None:
        with kept(points_per(batch, PERIODS[period]).select(*columns)) as delta:
            if not delta.isEmpty():
                ledger.record(delta, root, batch_id, PERIODS[period], stream)

    return start(scored_rows(messages), handle, checkpoint, every)


def _fold(period: str):
    return lambda rows: ledger.fold_points(rows, ["phone", *PERIODS[period]])


def streamed_points(spark: SparkSession, root: str, period: str = "month") -> DataFrame:
    rows = ledger.entries(spark, root, _delta_schema(period))
    return _fold(period)(rows).select(*_delta_schema(period).names)


def compact_points(spark: SparkSession, root: str, period: str = "month", keep: int | None = None) -> int:
    return ledger.compact(spark, root, _delta_schema(period), _fold(period), PERIODS[period], keep)


def points_between(spark: SparkSession, root: str, period: str, before: int, version: int) -> DataFrame:
    """What snapshot `version` holds more than snapshot `before` (-1: nothing), per member."""
    keys, columns = ["phone", *PERIODS[period]], _delta_schema(period).names
    new = ledger.snapshot(spark, root, version, _delta_schema(period))
    if before < 0:
        return new.select(*columns)
    old = ledger.snapshot(spark, root, before, _delta_schema(period)).select(*keys, F.col("points").alias("_old"), F.col("last_batch").alias("_upto"))
    grown = new.join(old, keys, "left").where("_upto is null or _upto < last_batch")
    return grown.withColumn("points", F.col("points") - F.coalesce("_old", F.lit(0))).select(*columns)


def current_members(spark: SparkSession, root: str, period: str = "month", base: DataFrame | None = None) -> DataFrame:
    """Monthly or yearly member table: the base (empty by default) plus what was streamed."""
    base = base if base is not None else spark.createDataFrame([], TABLES[period])
    return increment_members(base, streamed_points(spark, root, period), ["phone", *PERIODS[period]])


def current_profiles(spark: SparkSession, root: str, profiles: DataFrame, as_of: Column) -> DataFrame:
    """Profiles plus what was streamed under period "all"; other phones are ignored."""
    return increment_profiles(profiles, streamed_points(spark, root, "all"), as_of)


def running_totals(scored: DataFrame, period: str = "month") -> DataFrame:
    """The same sums as streaming state, for output mode "update"."""
    return scored.groupBy("phone", *PERIODS[period]).agg(
        F.sum("value").alias("points"), F.max("timestamp").alias("timestamp")
    )
