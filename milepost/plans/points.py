"""Points per member by month, by year and over all time, recalculated from rows."""

from pyspark.sql import Column, DataFrame, functions as F

from milepost.functions.calendar import period_start
from milepost.functions.values import hashed_uuid
from milepost.operators.keyed import update_only, upsert
from milepost.schemas import DEFAULT_TIER, SCORING_NAME, TIER_NAMES, UNRANKED_MEMBER, UNRANKED_YEARLY
from milepost.sources.tables import pick

DEFAULT_TIER_NAME = TIER_NAMES[DEFAULT_TIER]


def points_per(transactions: DataFrame, periods: list[str]) -> DataFrame:
    """Points and latest timestamp per member and period, with the code seen last.

    Two steps on purpose. The first (sum and max per member, code and period) runs
    as a hash aggregate that folds rows before the shuffle; only its few rows per
    member reach the second, which picks the code and would need a sort.
    """
    by_code = transactions.groupBy("phone", "membershipcode", *periods).agg(
        F.sum("value").alias("points"), F.max("timestamp").alias("timestamp")
    )
    return by_code.groupBy("phone", *periods).agg(
        F.sum("points").alias("points"),
        F.max("timestamp").alias("timestamp"),
        F.max_by("membershipcode", F.struct("timestamp", "membershipcode")).alias("membershipcode"),
    )


def scoring(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("Name") == SCORING_NAME)


def _new_members(points: DataFrame, periods: list[str], rank: int) -> DataFrame:
    return points.select(
        "phone",
        "membershipcode",
        F.lit(DEFAULT_TIER_NAME).alias("membershipname"),
        *periods,
        F.lit(rank).alias("rank"),
        F.col("points").alias("totalpoints"),
        "timestamp",
    )


def recalc_monthly(
    transactions: DataFrame,
    year: int | None = None,
    month: int | None = None,
    positive_only: bool = False,
    target: DataFrame | None = None,
) -> DataFrame:
    """Monthly totals from transactions: of one month, or of every month.

    With a `target`, its new state: totals and timestamps are overwritten, other
    columns are set on new members only.
    """
    rows = scoring(pick(transactions, Year=year, Month=month))
    if positive_only:
        rows = rows.filter(F.col("Value").isNotNull() & (F.col("Value") > 0))
    rows = rows.select(
        *[F.col(c).alias(c.lower()) for c in ("Phone", "MembershipCode", "Month", "Year", "Value", "TimeStamp")]
    )
    fresh = _new_members(points_per(rows, ["month", "year"]), ["month", "year"], UNRANKED_MEMBER)
    if target is None:
        return fresh
    return upsert(target, fresh, ["phone", "month", "year"], update=["totalpoints", "timestamp"])


def recalc_yearly(monthly: DataFrame, year: int | None = None, target: DataFrame | None = None) -> DataFrame:
    """Yearly totals from the monthly table; tier of the member's last month."""
    newest = F.struct("month", "timestamp", "membershipcode", "membershipname")
    totals = (
        pick(monthly, year=year)
        .groupBy("phone", "year")
        .agg(F.sum("totalpoints").alias("totalpoints"), F.max(newest).alias("last"))
    )
    fresh = totals.select(
        "phone",
        F.col("last.membershipcode").alias("membershipcode"),
        F.col("last.membershipname").alias("membershipname"),
        "year",
        F.lit(UNRANKED_YEARLY).alias("rank"),
        "totalpoints",
        period_start(F.col("year"), F.lit(1)).alias("timestamp"),
    )
    if target is None:
        return fresh
    update = ["membershipcode", "membershipname", "totalpoints", "timestamp"]
    return upsert(target, fresh, ["phone", "year"], update=update)


def recalc_all_time(yearly: DataFrame) -> DataFrame:
    """All-time total per member as new profile rows; code of the latest year that has one."""
    totals = yearly.groupBy("phone").agg(
        F.sum("totalpoints").alias("TotalPoints"),
        F.max(F.when(F.col("membershipcode").isNotNull(), F.struct("year", "membershipcode"))).alias("last"),
    )
    return totals.select(
        hashed_uuid(F.col("phone")).alias("Id"),
        F.col("phone").alias("Phone"),
        F.lit("Standard").alias("Package"),
        F.coalesce("last.membershipcode", F.lit(DEFAULT_TIER)).alias("MembershipCode"),
        "TotalPoints",
    )


def upsert_profiles(profiles: DataFrame, totals: DataFrame, as_of: Column, by: str = "BatchPointsCalculator") -> DataFrame:
    """New profile table: known phones get the new total and audit columns, unknown ones a new row."""
    source = totals.select("*", as_of.alias("LastModified"), F.lit(by).alias("LastModifiedBy"))
    on_insert = {"StartDate": as_of, "CreatedAt": as_of, "CreatedBy": F.lit(by)}
    return upsert(
        profiles, source, ["Phone"], update=["TotalPoints", "LastModified", "LastModifiedBy"], insert=on_insert
    )


def increment_members(target: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """New membership table after streamed points: totals grow, new members start unranked."""
    source = points.withColumnRenamed("points", "totalpoints")
    return upsert(
        target,
        source,
        keys,
        update=["timestamp"],
        add=["totalpoints"],
        insert={"rank": F.lit(UNRANKED_MEMBER), "membershipname": F.lit(DEFAULT_TIER_NAME)},
    )


def increment_profiles(profiles: DataFrame, points: DataFrame, as_of: Column, by: str = "StreamingPointUpdater") -> DataFrame:
    """New profile table after streamed points; phones without a profile are ignored."""
    source = points.select(F.col("phone").alias("Phone"), F.col("points").alias("TotalPoints"))
    return update_only(
        profiles, source, ["Phone"], add=["TotalPoints"], touch={"LastModified": as_of, "LastModifiedBy": F.lit(by)}
    )
