"""Serving documents, and the start of a new month."""

from pyspark.sql import Column, DataFrame, functions as F

from milepost.functions.calendar import check_period, next_period, period_start_ms
from milepost.functions.values import document_key, epoch_seconds, tier_name, tolerant
from milepost.operators.keyed import upsert
from milepost.schemas import (
    BUSINESS_ZONE,
    DEFAULT_TIER,
    MONTHLY_PREFIX,
    PROFILE_PREFIX,
    UNRANKED_DOCUMENT,
    YEARLY_PREFIX,
)
from milepost.sources.tables import pick


def as_documents(fields: DataFrame, key: Column) -> DataFrame:
    """(doc_id, doc): each row as JSON under its key, nulls written out."""
    doc = F.to_json(F.struct(*fields.columns), {"ignoreNullFields": "false"})
    return fields.select(key.alias("doc_id"), doc.alias("doc"))


def monthly_fields(monthly: DataFrame, year: int | None = None, month: int | None = None, prefix: str = MONTHLY_PREFIX) -> DataFrame:
    return pick(monthly, year=year, month=month).select(
        document_key(prefix, F.col("year"), F.col("month"), F.col("phone")).alias("Id"),
        F.col("phone").alias("Phone"),
        F.col("membershipcode").alias("MembershipCode"),
        F.col("month").alias("Month"),
        F.col("year").alias("Year"),
        F.col("rank").alias("Rank"),
        F.col("membershipname").alias("MembershipName"),
        F.col("totalpoints").alias("TotalPoints"),
    )


def yearly_fields(yearly: DataFrame, year: int | None = None, prefix: str = YEARLY_PREFIX) -> DataFrame:
    return pick(yearly, year=year).select(
        document_key(prefix, F.col("year"), F.col("phone")).alias("Id"),
        F.col("phone").alias("Phone"),
        F.col("membershipcode").alias("MembershipCode"),
        F.col("year").alias("Year"),
        F.col("rank").alias("Rank"),
        F.col("membershipname").alias("MembershipName"),
        F.col("totalpoints").alias("TotalPoints"),
    )


def profile_fields(profiles: DataFrame, as_of: Column) -> DataFrame:
    """Profile documents; missing columns and nulls get defaults, empty phones are left out."""
    modified = F.col("LastModified") if "LastModified" in profiles.columns else F.lit(None).cast("timestamp")
    code = tolerant(profiles, "MembershipCode", DEFAULT_TIER)
    fields = profiles.select(
        tolerant(profiles, "Phone", "unknown"),
        tolerant(profiles, "Level", 1).cast("int").alias("Level"),
        tolerant(profiles, "TotalPoints", 0).cast("bigint").alias("TotalPoints"),
        tolerant(profiles, "Rank", UNRANKED_DOCUMENT if "Rank" in profiles.columns else 0).cast("int").alias("Rank"),
        epoch_seconds(modified, F.unix_timestamp(as_of)).alias("LastUpdated"),
        code,
        tier_name(code).alias("MembershipName"),
    )
    return fields.filter(F.col("Phone") != "")


def publish_monthly(monthly: DataFrame, year=None, month=None, prefix: str = MONTHLY_PREFIX) -> DataFrame:
    return as_documents(monthly_fields(monthly, year, month, prefix), F.col("Id"))


def publish_yearly(yearly: DataFrame, year=None, prefix: str = YEARLY_PREFIX) -> DataFrame:
    return as_documents(yearly_fields(yearly, year, prefix), F.col("Id"))


def publish_profiles(profiles: DataFrame, as_of: Column, prefix: str = PROFILE_PREFIX) -> DataFrame:
    return as_documents(profile_fields(profiles, as_of), document_key(prefix, F.col("Phone")))


def roll_forward(
    monthly: DataFrame,
    source: tuple[int, int],
    target: tuple[int, int] | None = None,
    zone: str = BUSINESS_ZONE,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Members of the source (year, month) as rows of the target month, by default the next.

    Tier and rank are carried over, points start at zero. With `existing`, the new
    state of that table: members already there are reset the same way.
    """
    check_period(*source)
    year, month = target or next_period(*source)
    start = period_start_ms(year, month, zone)
    reset = {
        "year": F.lit(year),
        "month": F.lit(month),
        "timestamp": F.lit(start).cast("bigint"),
        "totalpoints": F.lit(0).cast("bigint"),
    }
    carried = pick(monthly, year=source[0], month=source[1])
    carried = carried.select(*[reset.get(c, F.col(c)).alias(c) for c in monthly.columns])
    if existing is None:
        return carried
    keys = ["phone", "month", "year"]
    return upsert(existing, carried, keys, update=[c for c in existing.columns if c not in keys])
