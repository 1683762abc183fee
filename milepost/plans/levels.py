"""Numeric levels from all-time points."""

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

from milepost.functions.calendar import local_midnight_ms
from milepost.functions.values import hashed_uuid, level_for
from milepost.operators.keyed import changed, update_only
from milepost.schemas import (
    BUSINESS_ZONE,
    LEVEL_CAMPAIGN_NAME,
    LEVEL_EVENT,
    LEVEL_LABEL,
    LEVEL_RULE_ID,
    LEVEL_RULE_NAME,
    RECENT_PROFILE_MINUTES,
)


def modified_from(profiles: DataFrame, since: datetime) -> DataFrame:
    """Profiles modified since a moment, and those never modified."""
    return profiles.filter(F.col("LastModified").isNull() | (F.col("LastModified") >= F.lit(since)))


def recent_window(as_of: datetime, minutes: int = RECENT_PROFILE_MINUTES) -> datetime:
    return as_of - timedelta(minutes=minutes)


def update_levels(profiles: DataFrame, modified_since: datetime | None = None) -> DataFrame:
    """Profiles whose level no longer fits their points, up or down, as (profile columns, new_level).

    With `modified_since` only recent profiles are looked at, and there a missing
    (or zero) level counts as 1. Missing points always count as 0.
    """
    level = F.col("Level")
    if modified_since is not None:
        profiles = modified_from(profiles, modified_since)
        level = F.when(level != 0, level).otherwise(1)
    compared = profiles.withColumn("old_level", level).withColumn("new_level", level_for(F.col("TotalPoints")))
    return changed(compared, "old_level", "new_level").select("Id", "Phone", "MembershipCode", "TotalPoints", "old_level", "new_level")


def apply_levels(profiles: DataFrame, changes: DataFrame, as_of: Column | None = None, by: str = "ProfileLevelUpgrader") -> DataFrame:
    source = changes.select("Id", F.col("new_level").alias("Level"))
    touch = {"LastModified": as_of, "LastModifiedBy": F.lit(by)} if as_of is not None else {}
    return update_only(profiles, source, ["Id"], update=["Level"], touch=touch)


def level_transactions(changes: DataFrame, as_of: datetime, zone: str = BUSINESS_ZONE) -> DataFrame:
    """One transaction per level change, ready to be sent; times are epoch seconds."""
    seconds = int(as_of.timestamp())
    local = as_of.astimezone(ZoneInfo(zone))
    midnight = local_midnight_ms(local.date(), zone) // 1000
    return changes.select(
        hashed_uuid(F.col("Id"), F.col("new_level"), F.lit(seconds)).alias("Id"),
        F.col("Phone"),
        F.lit(midnight).cast("bigint").alias("Date"),
        F.lit(local.month).alias("Month"),
        F.lit(local.year).alias("Year"),
        F.lit("").alias("ReportCode"),
        F.lit(LEVEL_RULE_ID).alias("CampaignId"),
        F.lit(LEVEL_RULE_ID).alias("RuleId"),
        F.lit(LEVEL_CAMPAIGN_NAME).alias("CampaignName"),
        F.lit(LEVEL_RULE_NAME).alias("RuleName"),
        F.lit(LEVEL_EVENT).alias("EventCode"),
        F.lit(LEVEL_LABEL).alias("EventName"),
        F.lit(LEVEL_LABEL).alias("ReportName"),
        F.lit(LEVEL_EVENT).alias("Name"),
        F.col("new_level").alias("Value"),
        F.lit(seconds).cast("bigint").alias("TimeStamp"),
        F.col("MembershipCode"),
        F.lit("System").alias("Type"),
    )
