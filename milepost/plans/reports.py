"""Daily reports on events, campaign rules, driving and live traffic."""

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from milepost.functions import messages
from milepost.functions.calendar import business_day, day_bounds_ms, local_midnight_ms, rows_of_day, touching_periods
from milepost.functions.values import device_id, hashed_uuid, whole_km
from milepost.operators.ordering import positions
from milepost.operators.sinks import audited
from milepost.schemas import (
    APPROVED,
    BUSINESS_ZONE,
    DEFAULT_TIER,
    DEVICE_PREFIX,
    DRIVING,
    DRIVING_EVENT,
    DRIVING_LABEL,
    MIN_DRIVING_METRES,
    RELEASE_BATCH,
    SCORING_NAME,
    SUBMITTED,
    VERIFIED,
    VERIFY_AFTER_SECONDS,
    WAITING,
)
from milepost.session import stage


def event_summary(
    events: DataFrame,
    day: date | None = None,
    zone: str = BUSINESS_ZONE,
    kinds: tuple[str, str, str] = (SUBMITTED, APPROVED, DRIVING),
    prune: bool = True,
) -> DataFrame:
    """Submitted, approved and driving reports per member and date: of one day, or of all."""
    if day is not None:
        events = rows_of_day(events, day, zone, prune)
    names = ("total_submitted_report", "total_approved_report", "total_driving_report")
    return events.groupBy(F.col("Phone").alias("phone"), F.col("Date").alias("date")).agg(
        *[F.count_if(F.col("Event") == kind).alias(name) for kind, name in zip(kinds, names)]
    )


def summary_rows(summary: DataFrame, as_of: Column, by: str = "ActivitySummaryProcessor") -> DataFrame:
    """An event summary as rows of the stored report, with audit columns."""
    names = ["Phone", "Date", "TotalSubmittedReport", "TotalApprovedReport", "TotalDrivingReport"]
    return audited(summary.toDF(*names), as_of, by)


def rule_flow_metrics(
    transactions: DataFrame,
    day: date | None = None,
    as_of: datetime | None = None,
    zone: str = BUSINESS_ZONE,
    prune: bool = True,
    per: str = "day",
) -> DataFrame:
    """How members pass through the rules of each campaign, per day (of one day, or of all) or per month.

    Distinct members are counted from rows folded to one per member first, so no
    task holds the member set of a large rule or campaign.
    """
    if day is not None:
        transactions = rows_of_day(transactions, day, zone, prune)
    per_member = actions_per_member(transactions, day, zone, per)
    rules = rule_sums(per_member).select(
        *FLOW_RULE, "campaignname", "profiles_evaluated", "total_actions", "addpoint_actions", "points_awarded"
    )
    members = per_member.select("date", "CampaignId", "Phone").distinct()
    evaluated = members.groupBy("date", "CampaignId").agg(F.count("Phone").alias("total_profiles_evaluated"))
    return flow_rows(rules, evaluated, as_of)


FLOW_RULE = ["date", "CampaignId", "RuleId", "RuleName"]


def actions_per_member(transactions: DataFrame, day: date | None = None, zone: str = BUSINESS_ZONE, per: str = "day") -> DataFrame:
    """One row per rule, member and day (or month, by its first day): actions, scored ones and their points.

    Staged, as the rules and the campaigns' members both come from it. The least name of text cannot be kept in a hash
    aggregate, so rows are folded by name as well; only if some campaign has several names in a period,
    rows are folded once more.
    """
    local_day = business_day(F.col("TimeStamp"), zone) if day is None else F.lit(day)
    period = F.trunc(local_day, "month") if per == "month" else local_day
    # Rows without a campaign belong to no funnel.
    rows = transactions.filter(F.col("CampaignId").isNotNull()).withColumn("date", period)
    scored = F.col("Name") == SCORING_NAME
    named = rows.groupBy(*FLOW_RULE, "Phone", F.col("CampaignName").alias("campaignname")).agg(
        F.count("Name").alias("actions"),
        F.count_if(scored).alias("scored"),
        F.sum(F.when(scored, F.col("Value"))).alias("points"),
    )
    named = stage(named, "per-member")
    if one_name(named):
        return named
    sums = [F.sum(c).alias(c) for c in ("actions", "scored", "points")]
    return stage(named.groupBy(*FLOW_RULE, "Phone").agg(F.min("campaignname").alias("campaignname"), *sums), "per-member")


def one_name(rows: DataFrame) -> bool:
    """Whether each campaign has one name in each period, a missing one included."""
    names = rows.select("date", "CampaignId", "campaignname").distinct()
    return names.groupBy("date", "CampaignId").count().filter("count > 1").isEmpty()


def rule_sums(per_member: DataFrame) -> DataFrame:
    """Members, actions, scored ones and points per rule, and the least name of its campaign."""
    sums = [
        F.count("Phone").alias("profiles_evaluated"),
        F.sum("actions").alias("total_actions"),
        F.sum("scored").alias("addpoint_actions"),
        F.sum("points").alias("points_awarded"),
    ]
    if one_name(per_member):
        return per_member.groupBy(*FLOW_RULE, "campaignname").agg(*sums)
    return per_member.groupBy(*FLOW_RULE).agg(F.min("campaignname").alias("campaignname"), *sums)


def flow_rows(rules: DataFrame, evaluated: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The stored funnel rows from sums per rule and distinct members per campaign."""
    sequenced = positions(
        rules,
        [F.asc_nulls_first("RuleId"), F.asc_nulls_first("RuleName")],
        ["date", "CampaignId"],
        index="rule_sequence",
        totals={
            "total_successful_actions": F.col("addpoint_actions"),
            "total_points_awarded": F.col("points_awarded"),
        },
        attach=evaluated,
    )
    written = F.lit(int(as_of.timestamp() * 1000) if as_of else None).cast("bigint")
    return sequenced.select(
        F.col("CampaignId").alias("campaignid"),
        "campaignname",
        F.col("RuleId").alias("ruleid"),
        F.col("RuleName").alias("rulename"),
        "date",
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        written.alias("timestamp"),
        F.col("rule_sequence").cast("int").alias("rule_sequence"),
        "total_profiles_evaluated",
        "profiles_evaluated",
        "total_actions",
        "addpoint_actions",
        "points_awarded",
        "total_successful_actions",
        "total_points_awarded",
        (F.col("profiles_evaluated") - F.col("total_actions")).alias("profiles_not_matched"),
    )


def campaign_overview(metrics: DataFrame) -> DataFrame:
    columns = ["campaignname", "total_profiles_evaluated", "total_successful_actions", "total_points_awarded"]
    return metrics.select(*columns).distinct()


def rule_flow_path(metrics: DataFrame) -> DataFrame:
    """The rules of each campaign in sequence, with the members that remain after each."""
    taken = positions(
        metrics,
        [F.asc("rule_sequence")],
        ["date", "campaignid"],
        index="_step",
        running={"_taken": F.col("total_actions")},
    )
    return taken.select(
        "date",
        "campaignid",
        "campaignname",
        "rule_sequence",
        "rulename",
        "profiles_evaluated",
        "total_actions",
        "addpoint_actions",
        "points_awarded",
        "profiles_not_matched",
        (F.col("total_profiles_evaluated") - F.col("_taken")).alias("remaining_profiles"),
    )


def daily_driving_events(
    reports: DataFrame,
    device_users: DataFrame,
    day: date | None = None,
    zone: str = BUSINESS_ZONE,
    min_metres: int = MIN_DRIVING_METRES,
    prefix: str = DEVICE_PREFIX,
    prune: bool = True,
) -> DataFrame:
    """One driving event per long enough daily report of a known device.

    `date` of a report is the epoch second of its local midnight. A device listed for
    several users counts for the first phone. prune: of one day, read only the directories of its
    month. The folded users are staged, so a device with
    very many reports reaches a plain join that runtime planning splits.
    """
    if day is not None:
        # Reports are filed under the month of their local day; that of UTC is read as well.
        start, end = day_bounds_ms(day, zone)
        periods = sorted({(day.year, day.month), *touching_periods(start, end)})
        if prune:
            reports = reports.filter(reduce(Column.__or__, [(F.col("year") == y) & (F.col("month") == m) for y, m in periods]))
        reports = reports.filter(F.col("date") == local_midnight_ms(day, zone) // 1000)
    driven = reports.filter((F.col("distance") >= min_metres) & F.col("deviceimei").startswith(prefix))
    driven = driven.withColumn("device_id", device_id(F.col("deviceimei"), prefix))
    users = device_users.filter(F.col("Phone").isNotNull()).groupBy("device_id").agg(F.min("Phone").alias("phone"))
    known = driven.join(stage(users, "users"), "device_id")
    return known.select(
        hashed_uuid(*[F.col(c) for c in ("deviceimei", "date", "distance", "drivingtime")]).alias("Id"),
        F.col("phone").alias("Phone"),
        F.col("date").alias("Date"),
        F.col("month").alias("Month"),
        F.col("year").alias("Year"),
        F.col("date").alias("TimeStamp"),
        F.lit(DEFAULT_TIER).alias("MembershipCode"),
        F.lit(DRIVING_EVENT).alias("Event"),
        F.lit(DRIVING_EVENT).alias("ReportCode"),
        F.lit(DRIVING_LABEL).alias("EventName"),
        F.lit(DRIVING_LABEL).alias("ReportName"),
        whole_km(F.col("distance")).alias("Data"),
    )


def driving_messages(events: DataFrame) -> DataFrame:
    return messages.event_message(events)


def due_for_verification(as_of: int, after: int = VERIFY_AFTER_SECONDS) -> Column:
    return (F.col("status") == WAITING) & (F.col("submit_time") <= as_of - after)


def verify_live_reports(
    reports: DataFrame, as_of: int, after: int = VERIFY_AFTER_SECONDS, by: str = "LiveReportVerificationJob"
) -> DataFrame:
    """The report table with reports that waited long enough marked as verified."""
    due = due_for_verification(as_of, after)
    new = {"status": F.lit(VERIFIED), "last_modified": F.lit(as_of).cast("bigint"), "last_modified_by": F.lit(by)}
    return reports.select(
        *[F.when(due, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in reports.columns]
    )


def release_batches(reports: DataFrame, as_of: int, batch: int = RELEASE_BATCH) -> DataFrame:
    """Verified reports that are still displayed, with batch number and total count."""
    current = reports.filter((F.col("status") == VERIFIED) & (F.col("expired_display_time") > as_of))
    placed = positions(current, [F.asc("id")], index="_place", totals={"total_records": F.lit(1)})
    return placed.withColumn("batch_no", F.floor((F.col("_place") - 1) / batch).cast("bigint"))


def release_live_reports(reports: DataFrame, as_of: int, batch: int = RELEASE_BATCH) -> DataFrame:
    """GeoJSON messages (value) of up to `batch` reports each; one trans_id per release."""
    trans_id = hashed_uuid(F.lit("release"), F.lit(as_of))
    entry = F.struct(F.col("_place"), messages.feature().alias("feature"))
    grouped = (
        release_batches(reports, as_of, batch)
        .groupBy("batch_no", "total_records")  # at most `batch` rows each
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    return grouped.select(
        "batch_no", messages.feature_collection(trans_id, F.col("entries.feature"), F.col("total_records")).alias("value")
    )
