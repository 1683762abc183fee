"""Tiers from points and ranks, and their spread to other tables."""

from pyspark.sql import Column, DataFrame, functions as F

from milepost.functions.values import first_rule, tier_name
from milepost.operators.keyed import keep_first, update_only, upsert
from milepost.operators.ordering import positions
from milepost.plans.ranking import member_order
from milepost.schemas import PERCENTILE_TIERS, RISING_POINTS, RISING_TIER
from milepost.sources.tables import pick


def assign_membership(
    members: DataFrame,
    periods: list[str] = ("year", "month"),
    percentile_rules: bool = False,
    min_points: int = RISING_POINTS,
) -> DataFrame:
    """Rank, percentile and tier of each member within its period.

    The percentile is the rank over the number of members with points. A period
    where nobody has points keeps its ranks and tiers (and gets no percentile).
    """
    scored = F.when(F.col("totalpoints") > 0, 1).otherwise(0)
    ranked = positions(members, member_order(), list(periods), index="_rank", totals={"_scored": scored})
    # 0 as divisor would raise; such periods stay as they are.
    percentile = F.col("_rank") / F.when(F.col("_scored") > 0, F.col("_scored"))
    enough = F.col("totalpoints") >= min_points
    rules = [
        ((F.col("percentile") > low) & (F.col("percentile") <= high) & enough, code)
        for low, high, code in (PERCENTILE_TIERS if percentile_rules else [])
    ]
    tier = first_rule([*rules, (enough, RISING_TIER)])
    active = F.col("_scored") > 0
    tiered = ranked.withColumn("percentile", percentile).withColumn("_tier", tier)
    new = {
        "rank": F.when(active, F.col("_rank").cast("int")).otherwise(F.col("rank")),
        "membershipcode": F.when(active, F.col("_tier")).otherwise(F.col("membershipcode")),
        "membershipname": F.when(active, tier_name(F.col("_tier"))).otherwise(F.col("membershipname")),
    }
    return tiered.select(*[new.get(c, F.col(c)).alias(c) for c in members.columns], "percentile")


def store_membership(target: DataFrame, assigned: DataFrame, keys: list[str]) -> DataFrame:
    """New membership table; a member listed twice counts with its highest points."""
    source = assigned.select(*target.columns)
    rest = [F.col(c).asc_nulls_last() for c in target.columns if c != "totalpoints"]
    best = keep_first(source, keys, [F.desc_nulls_last("totalpoints"), *rest])
    return upsert(target, best, keys, update=[c for c in target.columns if c not in keys])


def membership_distribution(members: DataFrame) -> DataFrame:
    return (
        members.groupBy("membershipcode", "membershipname")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.round(F.avg("totalpoints"), 2).alias("avg_points"),
            F.min("totalpoints").alias("min_points"),
            F.max("totalpoints").alias("max_points"),
        )
        .orderBy("membershipcode")
    )


def sync_membership_to_profiles(
    profiles: DataFrame, monthly: DataFrame, year: int, month: int, as_of: Column | None = None, by: str = "MembershipCodeUpdater"
) -> DataFrame:
    """Profiles with the tier code their member has in the given month; others unchanged."""
    codes = pick(monthly, year=year, month=month).select(
        F.col("phone").alias("Phone"), F.col("membershipcode").alias("MembershipCode")
    )
    touch = {"LastModified": as_of, "LastModifiedBy": F.lit(by)} if as_of is not None else {}
    return update_only(profiles, codes, ["Phone"], update=["MembershipCode"], touch=touch)


def sync_membership_to_yearly(yearly: DataFrame, monthly: DataFrame, year: int, month: int, yearly_of: int | None = None) -> DataFrame:
    """Yearly rows of a year with the tier of the given month; other rows unchanged."""
    tiers = pick(monthly, year=year, month=month).select(
        "phone", F.lit(yearly_of or year).alias("year"), "membershipcode", "membershipname"
    )
    return update_only(yearly, tiers, ["phone", "year"], update=["membershipcode", "membershipname"])
