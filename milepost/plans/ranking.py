"""Unique ranks, and the checks that go with them."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from milepost.operators.joins import spread_join
from milepost.operators.keyed import changed
from milepost.operators.ordering import positions
from milepost.schemas import UNRANKED_PROFILE


def member_order() -> list[Column]:
    """Most points first; then who got there earlier; then phone."""
    return [F.desc_nulls_last("totalpoints"), F.asc_nulls_first("timestamp"), F.asc_nulls_first("phone")]


def rank_members(members: DataFrame, periods: list[str]) -> DataFrame:
    """Membership rows with `rank` replaced by 1..N within each period."""
    ranked = positions(members, member_order(), periods, index="_rank")
    return ranked.withColumn("rank", F.col("_rank").cast("int")).drop("_rank")


def rank_monthly(monthly: DataFrame) -> DataFrame:
    return rank_members(monthly, ["year", "month"])


def rank_yearly(yearly: DataFrame) -> DataFrame:
    return rank_members(yearly, ["year"])


def leaders(members: DataFrame, n: int, periods: list[str] = ("year", "month")) -> DataFrame:
    """The n best members of each period with their ranks. Each task passes on n rows per period at most."""
    place = F.row_number().over(Window.partitionBy(*periods).orderBy(*member_order()))
    return members.withColumn("rank", place).filter(F.col("rank") <= n)


def rank_all_time(profiles: DataFrame) -> DataFrame:
    """Profiles whose all-time rank changes: (id, phone, totalpoints, old_rank, new_rank)."""
    prepared = profiles.select(
        F.col("Id").alias("id"),
        F.col("Phone").alias("phone"),
        F.coalesce("TotalPoints", F.lit(0)).cast("bigint").alias("totalpoints"),
        F.coalesce("Rank", F.lit(UNRANKED_PROFILE)).alias("old_rank"),
    )
    # The id settles phones that are missing or not unique.
    order = [F.desc("totalpoints"), F.asc_nulls_first("phone"), F.asc_nulls_first("id")]
    ranked = positions(prepared, order, index="new_rank").withColumn("new_rank", F.col("new_rank").cast("int"))
    return changed(ranked, "old_rank", "new_rank")


def ties_report(ranked: DataFrame, periods: list[str]) -> DataFrame:
    """Members that share their points with others, by points and rank."""
    keys = [*periods, "totalpoints"]
    counts = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    shared = counts.filter("n > 1").withColumnRenamed("n", "users_with_same_points")
    tied = spread_join(ranked, shared, keys, spread_by=["phone"], hot=counts)
    columns = [*periods, "totalpoints", "rank", "phone", "timestamp", "users_with_same_points"]
    return tied.select(*columns).orderBy(*periods, "totalpoints", "rank")


def duplicate_ranks(ranked: DataFrame, periods: list[str]) -> DataFrame:
    """Ranks held by more than one member; empty for a correct ranking."""
    return ranked.groupBy(*periods, "rank").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")


def points_summary(ranked: DataFrame, periods: list[str] = ()) -> DataFrame:
    """Count, least, most and mean points, in one pass."""
    return ranked.groupBy(*periods).agg(
        F.count("totalpoints").alias("members"),
        F.min("totalpoints").alias("min_points"),
        F.max("totalpoints").alias("max_points"),
        (F.sum("totalpoints") / F.count("totalpoints")).alias("mean_points"),
    )


def top_members(members: DataFrame, n: int = 10, points: str = "totalpoints", phone: str = "phone") -> DataFrame:
    """The n members with most points; phone settles ties."""
    return members.orderBy(F.desc_nulls_last(points), F.asc(phone)).limit(n)
