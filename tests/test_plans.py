"""Small literal cases: edges of each pipeline."""

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from milepost.functions.calendar import day_bounds_ms, local_midnight_ms
from milepost.plans import ddl, levels, maintenance, membership, points, publish, ranking, reports
from milepost.schemas import (
    ACTIVITY_EVENT,
    ACTIVITY_TRANSACTION,
    DAILY_SUMMARY_REPORT,
    DEVICE_USER,
    LIVE_REPORT,
    MEMBERSHIP_MONTHLY,
    MEMBERSHIP_YEARLY,
    PROFILE,
    layout,
)

AS_OF = datetime(2024, 1, 31, 18, tzinfo=timezone.utc)  # already February in the business zone


def table(spark, schema, *given, **defaults):
    """Rows from dicts; missing columns are null."""
    return spark.createDataFrame([[{**defaults, **g}.get(n) for n in schema.names] for g in given], schema)


def rows(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- points ----------------------------------------------------------------------


def transactions(spark, *given):
    return table(spark, ACTIVITY_TRANSACTION, *given, Phone="1", Month=1, Year=2024, Name="AddPoint", MembershipCode="Level1", TimeStamp=1)


def test_two_codes_in_a_month_give_one_full_sum(spark):
    tx = transactions(
        spark,
        {"Value": 5, "TimeStamp": 1, "MembershipCode": "Level2"},
        {"Value": 7, "TimeStamp": 3, "MembershipCode": "Level1"},
        {"Value": 9, "TimeStamp": 9, "Name": "Other"},
        {"Value": 1, "Month": 2},
    )
    got = points.recalc_monthly(tx, 2024, 1)
    assert rows(got) == [("1", "Level1", "Nhập môn", 1, 2024, 9999, 12, 3)]
    assert points.recalc_monthly(tx).count() == 2


def test_positive_only_skips_null_and_negative_values(spark):
    tx = transactions(spark, {"Value": 5}, {"Value": None}, {"Value": -3}, {"Value": 0})
    assert rows(points.recalc_monthly(tx, positive_only=True), "totalpoints") == [(5,)]
    assert rows(points.recalc_monthly(tx), "totalpoints") == [(2,)]


def test_recalculation_overwrites_totals_and_keeps_the_rest(spark):
    target = table(
        spark, MEMBERSHIP_MONTHLY,
        {"phone": "1", "membershipcode": "Level5", "membershipname": "x", "month": 1, "year": 2024, "rank": 3, "totalpoints": 99, "timestamp": 0},
        {"phone": "2", "month": 1, "year": 2024, "rank": 4, "totalpoints": 1, "timestamp": 0},
    )
    tx = transactions(spark, {"Value": 5}, {"Value": 6, "Phone": "3"})
    once = points.recalc_monthly(tx, 2024, 1, target=target)
    assert rows(once) == [
        ("1", "Level5", "x", 1, 2024, 3, 5, 1),
        ("2", None, None, 1, 2024, 4, 1, 0),
        ("3", "Level1", "Nhập môn", 1, 2024, 9999, 6, 1),
    ]
    assert rows(points.recalc_monthly(tx, 2024, 1, target=once)) == rows(once)


def monthly(spark, *given):
    return table(spark, MEMBERSHIP_MONTHLY, *given, phone="1", month=1, year=2024, rank=9999, totalpoints=0, timestamp=0, membershipcode="Level1", membershipname="Nhập môn")


def test_year_is_the_sum_of_its_months_with_the_last_tier(spark):
    months = monthly(
        spark,
        {"totalpoints": 5, "month": 1, "membershipcode": "Level5"},
        {"totalpoints": 7, "month": 11, "membershipcode": "Level2", "membershipname": "B"},
        {"totalpoints": 1, "month": 2, "year": 2023},
    )
    got = points.recalc_yearly(months, 2024)
    assert rows(got) == [("1", "Level2", "B", 2024, 0, 12, local_midnight_ms(date(2024, 1, 1)))]


def test_all_time_falls_back_to_the_first_tier(spark):
    years = table(
        spark, MEMBERSHIP_YEARLY,
        {"phone": "1", "year": 2023, "membershipcode": "Level2", "totalpoints": 5},
        {"phone": "1", "year": 2024, "membershipcode": None, "totalpoints": 6},
        {"phone": "2", "year": 2024, "membershipcode": None, "totalpoints": 1},
    )
    got = points.recalc_all_time(years)
    assert rows(got, "Phone", "Package", "MembershipCode", "TotalPoints") == [
        ("1", "Standard", "Level2", 11), ("2", "Standard", "Level1", 1),
    ]


def test_known_profiles_keep_their_tier_and_id(spark):
    profiles = table(spark, PROFILE, {"Id": "p1", "Phone": "1", "Level": 3, "TotalPoints": 1, "MembershipCode": "Level4"})
    totals = spark.createDataFrame(
        [("n1", "1", "Standard", "Level1", 50), ("n2", "2", "Standard", "Level2", 60)],
        layout("Id string, Phone string, Package string, MembershipCode string, TotalPoints bigint"),
    )
    got = points.upsert_profiles(profiles, totals, F.lit(AS_OF))
    assert rows(got, "Id", "Phone", "Level", "TotalPoints", "MembershipCode") == [
        ("n2", "2", None, 60, "Level2"), ("p1", "1", 3, 50, "Level4"),
    ]


def test_streamed_points_ignore_unknown_profiles(spark):
    profiles = table(spark, PROFILE, {"Id": "a", "Phone": "1", "TotalPoints": 5}, {"Id": "b", "Phone": "2", "TotalPoints": 7})
    delta = spark.createDataFrame([("1", 10), ("9", 10)], layout("phone string, points bigint"))
    got = points.increment_profiles(profiles, delta, F.lit(AS_OF))
    assert [(r.Id, r.TotalPoints, r.LastModified is None) for r in got.orderBy("Id").collect()] == [("a", 15, False), ("b", 7, True)]


# --- ranking and tiers -------------------------------------------------------------


def test_ranks_are_unique_and_ties_go_to_the_earlier_member(spark):
    months = monthly(
        spark,
        *[{"phone": p, "totalpoints": t, "timestamp": s} for p, t, s in [("d", 5, 2), ("c", 5, 1), ("b", 5, 1), ("a", 9, 9)]],
        {"phone": "z", "totalpoints": 1, "month": 2},
    )
    ranked = ranking.rank_monthly(months)
    assert rows(ranked, "month", "rank", "phone") == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (1, 4, "d"), (2, 1, "z")]
    assert ranking.duplicate_ranks(ranked, ["year", "month"]).count() == 0
    ties = ranking.ties_report(ranked, ["year", "month"])
    assert [(r.rank, r.users_with_same_points) for r in ties.collect()] == [(2, 3), (3, 3), (4, 3)]


def test_all_time_changes_with_missing_points_and_ranks(spark):
    profiles = table(
        spark, PROFILE,
        {"Id": "a", "Phone": "1", "TotalPoints": None, "Rank": None},
        {"Id": "b", "Phone": "2", "TotalPoints": 5, "Rank": 1},
        {"Id": "c", "Phone": "0", "TotalPoints": 0, "Rank": 3},
    )
    got = ranking.rank_all_time(profiles)
    assert rows(got, "id", "old_rank", "new_rank") == [("a", 9999999, 3), ("c", 3, 2)]


def test_tiers_by_points(spark):
    months = monthly(spark, *[{"phone": str(i), "totalpoints": p} for i, p in enumerate([199, 200, 0])])
    got = membership.assign_membership(months)
    assert rows(got, "phone", "rank", "membershipcode", "membershipname", "percentile") == [
        ("0", 2, "Level1", "Nhập môn", 1.0),
        ("1", 1, "Level2", "Ngôi sao đang lên", 0.5),
        ("2", 3, "Level1", "Nhập môn", 1.5),
    ]


def test_percentile_tiers_are_an_option(spark):
    months = monthly(spark, *[{"phone": f"{i:03d}", "totalpoints": 1000 - i} for i in range(100)])
    got = membership.assign_membership(months, percentile_rules=True)
    counts = {r.membershipcode: r["count"] for r in got.groupBy("membershipcode").count().collect()}
    assert counts == {"Level5": 1, "Level4": 4, "Level3": 5, "Level2": 90}
    plain = membership.assign_membership(months)
    assert plain.filter("membershipcode = 'Level2'").count() == 100


def test_month_without_points_is_left_alone(spark):
    months = monthly(spark, {"rank": 77, "membershipcode": "Level3", "membershipname": "kept"}, {"phone": "2", "month": 2, "totalpoints": 1})
    got = membership.assign_membership(months)
    assert rows(got, "month", "rank", "membershipcode", "membershipname") == [
        (1, 77, "Level3", "kept"), (2, 1, "Level1", "Nhập môn"),
    ]


def test_member_listed_twice_counts_with_most_points(spark):
    target = monthly(spark, {"phone": "1", "totalpoints": 1})
    listed = monthly(spark, {"phone": "1", "totalpoints": 4}, {"phone": "1", "totalpoints": 9}, {"phone": "2", "totalpoints": 2})
    got = membership.store_membership(target, listed, ["phone", "month", "year"])
    assert rows(got, "phone", "totalpoints") == [("1", 9), ("2", 2)]


def test_distribution(spark):
    months = monthly(spark, {"phone": "1", "totalpoints": 1}, {"phone": "2", "totalpoints": 2}, {"phone": "3", "totalpoints": 2})
    assert rows(membership.membership_distribution(months)) == [("Level1", "Nhập môn", 3, 1.67, 1, 2)]


def test_month_tier_goes_to_profiles_and_the_year(spark):
    months = monthly(
        spark, {"membershipcode": "Level2", "membershipname": "B"}, {"membershipcode": "Level5", "month": 2}, {"phone": "9", "membershipcode": "Level3"}
    )
    profiles = table(spark, PROFILE, {"Id": "a", "Phone": "1", "MembershipCode": "Level1"}, {"Id": "b", "Phone": "2", "MembershipCode": "Level1"})
    got = membership.sync_membership_to_profiles(profiles, months, 2024, 1, F.lit(AS_OF))
    assert [(r.Id, r.MembershipCode, r.LastModified is None) for r in got.orderBy("Id").collect()] == [("a", "Level2", False), ("b", "Level1", True)]
    years = table(spark, MEMBERSHIP_YEARLY, {"phone": "1", "year": 2024, "membershipcode": "Level1"}, {"phone": "1", "year": 2023, "membershipcode": "Level1"})
    got = membership.sync_membership_to_yearly(years, months, 2024, 1)
    assert rows(got, "year", "membershipcode", "membershipname") == [(2023, "Level1", None), (2024, "Level2", "B")]


# --- levels -------------------------------------------------------------------------


def test_levels_change_up_and_down(spark):
    profiles = table(
        spark, PROFILE,
        {"Id": "up", "TotalPoints": 200, "Level": 1}, {"Id": "down", "TotalPoints": 49, "Level": 2},
        {"Id": "same", "TotalPoints": 50, "Level": 2}, {"Id": "none", "TotalPoints": None, "Level": None},
    )
    got = levels.update_levels(profiles)
    assert rows(got, "Id", "new_level") == [("down", 1), ("none", 1), ("up", 3)]
    applied = levels.apply_levels(profiles, got, F.lit(AS_OF))
    assert rows(applied, "Id", "Level") == [("down", 1), ("none", 1), ("same", 2), ("up", 3)]
    assert levels.update_levels(applied).count() == 0


def test_recent_profiles_only(spark):
    since = levels.recent_window(AS_OF)
    assert since == AS_OF - timedelta(minutes=30)
    profiles = table(
        spark, PROFILE,
        {"Id": "edge", "LastModified": since}, {"Id": "old", "LastModified": since - timedelta(seconds=1)},
        {"Id": "never"}, {"Id": "blank", "TotalPoints": 0, "Level": None},
        TotalPoints=60, Level=0,
    )
    assert rows(levels.update_levels(profiles, since), "Id", "old_level", "new_level") == [("edge", 1, 2), ("never", 1, 2)]


def test_level_transactions_use_the_local_calendar(spark):
    profiles = table(spark, PROFILE, {"Id": "a", "Phone": "1", "TotalPoints": 60, "Level": 1, "MembershipCode": "Level2"})
    sent = levels.level_transactions(levels.update_levels(profiles), AS_OF)
    row = sent.first()
    assert len(sent.columns) == 18
    assert (row.Month, row.Year, row.Date) == (2, 2024, local_midnight_ms(date(2024, 2, 1)) // 1000)
    assert (row.Value, row.Name, row.Type, row.TimeStamp) == (2, "UpgradeLevel", "System", int(AS_OF.timestamp()))


# --- publishing ----------------------------------------------------------------------


def test_documents(spark):
    months = monthly(spark, {"phone": "09", "month": 3, "totalpoints": 4, "rank": 2, "membershipname": None})
    doc = publish.publish_monthly(months, 2024, 3, "m:").first()
    assert doc.doc_id == "m:2024:3:09"
    assert json.loads(doc.doc) == {
        "Id": "m:2024:3:09", "Phone": "09", "MembershipCode": "Level1", "Month": 3, "Year": 2024, "Rank": 2,
        "MembershipName": None, "TotalPoints": 4,
    }
    year = points.recalc_yearly(months)
    assert publish.publish_yearly(year, 2024, "y:").first().doc_id == "y:2024:09"


def test_profile_documents_fill_what_is_missing(spark):
    profiles = table(spark, PROFILE, {"Phone": "1", "MembershipCode": "Level4", "LastModified": AS_OF}, {"Phone": None}, {"Phone": ""})
    now = F.lit(AS_OF + timedelta(hours=1))
    seconds = int(AS_OF.timestamp())
    got = publish.profile_fields(profiles, now)
    assert rows(got) == [
        ("1", 1, 0, 999999, seconds, "Level4", "Nổi tiếng"),
        ("unknown", 1, 0, 999999, seconds + 3600, "Level1", "Nhập môn"),
    ]
    bare = publish.publish_profiles(profiles.select("Phone"), now, "p:").filter("doc_id = 'p:1'").first()
    assert json.loads(bare.doc)["Rank"] == 0


def test_roll_forward_from_december(spark):
    months = monthly(spark, {"month": 12, "totalpoints": 50, "rank": 3, "membershipcode": "Level2"}, {"phone": "2", "month": 11})
    got = publish.roll_forward(months, (2024, 12))
    start = local_midnight_ms(date(2025, 1, 1))
    assert rows(got) == [("1", "Level2", "Nhập môn", 1, 2025, 3, 0, start)]
    there = monthly(spark, {"month": 1, "year": 2025, "totalpoints": 8}, {"phone": "7", "month": 1, "year": 2025, "totalpoints": 9})
    state = publish.roll_forward(months, (2024, 12), existing=there)
    assert rows(state, "phone", "rank", "totalpoints") == [("1", 3, 0), ("7", 9999, 9)]
    with pytest.raises(ValueError):
        publish.roll_forward(months, (2024, 13))


# --- reports ---------------------------------------------------------------------------


def test_event_summary_of_a_local_day(spark):
    day = date(2024, 2, 1)
    start, end = day_bounds_ms(day)
    events = table(
        spark, ACTIVITY_EVENT,
        {"TimeStamp": start, "Event": "SubmittedReport", "Month": 1}, {"TimeStamp": end - 1, "Event": "ApprovedReport"},
        {"TimeStamp": end, "Event": "ApprovedReport"}, {"TimeStamp": start - 1, "Event": "DrivingReport", "Month": 1},
        {"TimeStamp": start + 5, "Event": "Other"}, {"TimeStamp": start + 5, "Event": None},
        Phone="1", Date=1, Year=2024, Month=2,
    )
    got = reports.event_summary(events, day)
    assert rows(got) == [("1", 1, 1, 1, 0)]
    stored = reports.summary_rows(got, F.lit(AS_OF)).first()
    assert (stored.TotalSubmittedReport, stored.CreatedBy, stored.CreatedAt) == (1, "ActivitySummaryProcessor", stored.LastModified)


def funnel(spark):
    day = date(2024, 1, 15)
    start, _ = day_bounds_ms(day)
    tx = table(
        spark, ACTIVITY_TRANSACTION,
        {"CampaignId": "c1", "RuleId": "r1", "RuleName": "b", "Phone": "1", "Name": "AddPoint", "Value": 5},
        {"CampaignId": "c1", "RuleId": "r1", "RuleName": "b", "Phone": "1", "Name": "AddPoint", "Value": 5},
        {"CampaignId": "c1", "RuleId": "r1", "RuleName": "a", "Phone": "2", "Name": None},
        {"CampaignId": "c1", "RuleId": "r2", "RuleName": "c", "Phone": "2", "Name": "Notify"},
        {"CampaignId": "c2", "RuleId": "r9", "RuleName": "z", "Phone": "3", "Name": "Notify"},
        {"CampaignId": None, "RuleId": "r9", "RuleName": "z", "Phone": "4", "Name": "AddPoint", "Value": 1},
        TimeStamp=start, Year=2024, Month=1, CampaignName="C",
    )
    return reports.rule_flow_metrics(tx, day, AS_OF)


def test_rule_flow(spark):
    got = rows(
        funnel(spark),
        "campaignid", "rule_sequence", "rulename", "total_profiles_evaluated", "profiles_evaluated", "total_actions",
        "addpoint_actions", "points_awarded", "total_successful_actions", "total_points_awarded", "profiles_not_matched",
    )
    assert got == [
        ("c1", 1, "a", 2, 1, 0, 0, None, 2, 10, 1),
        ("c1", 2, "b", 2, 1, 2, 2, 10, 2, 10, -1),
        ("c1", 3, "c", 2, 1, 1, 0, None, 2, 10, 0),
        ("c2", 1, "z", 1, 1, 1, 0, None, 0, None, 0),
    ]


def test_remaining_members_after_each_rule(spark):
    path = reports.rule_flow_path(funnel(spark))
    assert rows(path, "campaignid", "rule_sequence", "remaining_profiles") == [("c1", 1, 2), ("c1", 2, 0), ("c1", 3, -1), ("c2", 1, 0)]
    assert reports.campaign_overview(funnel(spark)).count() == 2


def test_driving_events(spark):
    day = date(2024, 1, 15)
    second = local_midnight_ms(day) // 1000
    driven = table(
        spark, DAILY_SUMMARY_REPORT,
        {"deviceimei": "VML_0007", "distance": 1999}, {"deviceimei": "VML_0007", "distance": 999},
        {"deviceimei": "VML_0007", "distance": None}, {"deviceimei": "VMLX0007", "distance": 5000},
        {"deviceimei": "VML_0008", "distance": 5000}, {"deviceimei": None, "distance": 5000},
        {"deviceimei": "VML_0007", "distance": 3000, "date": second - 86400},
        date=second, month=1, year=2024,
    )
    users = table(spark, DEVICE_USER, {"device_id": "7", "Phone": "0907"}, {"device_id": "8", "Phone": None})
    got = reports.daily_driving_events(driven, users, day)
    assert rows(got, "Phone", "Date", "TimeStamp", "Event", "Data") == [("0907", second, second, "DrivingDaily", "1")]
    message = json.loads(reports.driving_messages(got).first().value)
    assert isinstance(message, list) and list(message[0]) == ACTIVITY_EVENT.names
    assert rows(got, "Id") == rows(reports.daily_driving_events(driven, users, day), "Id")


def live(spark, n, **values):
    return table(spark, LIVE_REPORT, *[{"id": f"{i:04d}", "lat": 1.5, "lng": 2.5, "cell_id": None if i else "c", "expired_display_time": 1001} for i in range(n)], status="Verified", **values)


def test_verification_waits_five_minutes(spark):
    waiting = table(
        spark, LIVE_REPORT, {"id": "due", "submit_time": 700}, {"id": "early", "submit_time": 701}, {"id": "other", "submit_time": 1, "status": "Rejected"},
        status="WaitingVerification",
    )
    got = reports.verify_live_reports(waiting, 1000)
    assert rows(got, "id", "status", "last_modified") == [
        ("due", "Verified", 1000), ("early", "WaitingVerification", None), ("other", "Rejected", None),
    ]
    assert rows(reports.verify_live_reports(got, 1000)) == rows(got)


@pytest.mark.parametrize("n, sizes", [(0, []), (100, [100]), (101, [100, 1]), (250, [100, 100, 50])])
def test_release_in_batches(spark, n, sizes):
    sent = reports.release_live_reports(live(spark, n), 1000).orderBy("batch_no").collect()
    parsed = [json.loads(r.value) for r in sent]
    assert [len(m["data"]["features"]) for m in parsed] == sizes
    assert all(m["total_records"] == n for m in parsed) and len({m["trans_id"] for m in parsed}) <= 1
    ids = [f["properties"]["id"] for m in parsed for f in m["data"]["features"]]
    assert ids == [f"{i:04d}" for i in range(n)]
    if n:
        first = parsed[0]["data"]["features"][0]
        assert first["geometry"] == {"coordinates": [2.5, 1.5], "type": "Point"}
        assert first["properties"]["cellId"] == "c" and first["properties"]["heading"] is None
        assert parsed[0]["data"]["features"][1]["properties"]["cellId"] == "" if n > 1 else True


def test_expired_reports_are_not_released(spark):
    assert reports.release_live_reports(live(spark, 3), 1001).count() == 0


# --- maintenance --------------------------------------------------------------------------


def copies(spark):
    return table(
        spark, ACTIVITY_TRANSACTION,
        {"Id": "a", "TimeStamp": 1, "Value": 1}, {"Id": "a", "TimeStamp": 2, "Value": 2}, {"Id": "a", "TimeStamp": 2, "Value": 1},
        {"Id": "b", "TimeStamp": 1}, {"Id": "b", "TimeStamp": 1},
        {"Id": "a", "TimeStamp": 9, "Month": 2}, {"Id": "c", "Phone": "2", "TimeStamp": 5}, {"Id": "c", "Phone": "2", "TimeStamp": 6},
        Phone="1", Year=2024, Month=1,
    )


def test_deduplicate_all_or_a_slice(spark):
    assert rows(maintenance.deduplicate(copies(spark)), "Id", "TimeStamp") == [("a", 9), ("b", 1), ("c", 6)]
    month = maintenance.deduplicate(copies(spark), 2024, 1)
    assert rows(month, "Id", "TimeStamp", "Value") == [("a", 2, 2), ("a", 9, None), ("b", 1, None), ("c", 6, None)]
    member = maintenance.deduplicate(copies(spark), 2024, 1, "2")
    assert member.count() == 7
    with pytest.raises(ValueError):
        maintenance.deduplicate(copies(spark), 2024)


def test_duplicate_analysis(spark):
    assert rows(maintenance.duplicate_summary(copies(spark))) == [(8, 3, 5, 3, 4)]
    assert rows(maintenance.duplicate_distribution(copies(spark))) == [(2, 2), (4, 1)]
    assert maintenance.most_duplicated(copies(spark), 1).first().Id == "a"
    assert rows(maintenance.duplicate_summary(copies(spark).limit(0))) == [(0, 0, 0, 0, None)]


def test_sync_missing_copies_only_new_ids(spark):
    target = copies(spark).filter("Id = 'a'").toDF(*[c.lower() for c in ACTIVITY_TRANSACTION.names])
    got = maintenance.sync_missing(copies(spark), target, 2024, 1, F.lit(AS_OF))
    assert rows(got, "id") == [("b",), ("b",), ("c",), ("c",)]
    assert got.columns[-1] == "processed_timestamp" and "phone" in got.columns


def test_delete_and_look_up(spark):
    assert maintenance.without_period(copies(spark), 2024, 1).count() == 1
    assert rows(maintenance.deletion_report(copies(spark), 2024, 1)) == [(7, 7, 0)]
    assert rows(maintenance.deletion_report(copies(spark), 2024, 1, dry_run=True)) == [(7, 0, 7)]
    newest = maintenance.query_transactions(copies(spark), phone="1", n=2).collect()
    assert [(r.Id, r.TimeStamp) for r in newest] == [("a", 9), ("a", 2)]
    assert maintenance.matching_transactions(copies(spark), "2", 2024, 1).count() == 2


def test_tables_are_created(spark, tmp_path):
    try:
        listing = ddl.create_tables(spark, "milepost_test", str(tmp_path), drop=True)
        parts = listing.filter("partition and table = 'activity_transaction'")
        assert {r.column for r in parts.collect()} == {"Year", "Month", "Date"}
        assert listing.select("table").distinct().count() == 7
        assert ddl.create_tables(spark, "milepost_test", str(tmp_path)).count() == listing.count()
    finally:
        spark.sql("DROP DATABASE IF EXISTS milepost_test CASCADE")
