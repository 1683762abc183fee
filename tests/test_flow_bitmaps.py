"""Funnels over longer periods from stored daily bitmaps."""

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from catalog import sample
from milepost.plans import reports
from milepost.plans.flow_bitmaps import FlowBitmaps
from tests.test_plans import rows

FOLDER = "/root/testdata/sf0.001"


def test_days_add_up_to_months_without_transactions(spark, tmp_path):
    given = sample.transactions(spark, FOLDER).filter("Year = 1998 and Month in (5, 6)")
    # Names and phones may be missing; a rule may have actions and no member.
    given = given.withColumn("Phone", F.when(F.col("RuleId") != "3", F.col("Phone"))).withColumn("RuleName", F.when(F.col("RuleId") != "4", F.col("RuleName")))
    store = FlowBitmaps(spark, str(tmp_path / "flow"))
    store.store(given.filter("Month = 5"), zone="UTC")
    store.store(given.filter("Month = 6"), zone="UTC")
    direct = lambda per: reports.rule_flow_metrics(given, zone="UTC", per=per)
    assert rows(store.metrics()) == rows(direct("month"))
    assert rows(store.metrics(per="day")) == rows(direct("day"))
    assert rows(store.metrics(date(1998, 5, 1), date(1998, 5, 31))) == rows(direct("month").filter("month = 5"))
    members = store.members.read()
    n = given.filter("Phone is not null").select("Phone").distinct().count()
    assert members.count() == members.select("number").distinct().count() == n and members.agg(F.max("number")).first()[0] == n
    # A day again, without its transactions: its rows go, all others stay.
    first = rows(store.metrics(per="day"))
    store.store(given.limit(0), date(1998, 6, 9), zone="UTC", prune=False)
    assert rows(store.metrics(per="day")) == [r for r in first if "1998, 6, 9" not in repr(r)]
    assert len(first) > len(rows(store.metrics(per="day")))


def test_campaigns_with_one_name_are_not_sorted(spark):
    given = sample.transactions(spark, FOLDER).filter("Year = 1998 and Month = 5")
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan(reports.rule_sums(reports.actions_per_member(given, zone="UTC")))
    # A campaign with several names, one missing, counts a member once and takes the least name.
    named = given.withColumn("CampaignName", F.when(F.col("Value") % 3 == 0, "Z").when(F.col("Value") % 3 == 1, F.col("CampaignName")))
    got = reports.rule_sums(reports.actions_per_member(given.unionByName(named), zone="UTC"))
    expected = given.unionByName(named).filter("CampaignId is not null").groupBy("CampaignId", "RuleId", "RuleName", F.to_date(F.timestamp_millis("TimeStamp")).alias("date")).agg(
        F.min("CampaignName").alias("campaignname"), F.countDistinct("Phone").alias("profiles_evaluated"), F.count("Name").alias("total_actions")
    )
    columns = ["date", "CampaignId", "RuleId", "RuleName", "campaignname", "profiles_evaluated", "total_actions"]
    assert rows(got.select(*columns)) == rows(expected.select(*columns))


def test_a_member_takes_a_word_not_a_bitmap(spark, tmp_path):
    given = sample.transactions(spark, FOLDER).filter("Year = 1998 and Month = 5")
    given = given.withColumn("Phone", F.when(F.col("RuleId") != "3", F.col("Phone")))
    # Several names of a campaign, in one word of one rule.
    given = given.unionByName(given.withColumn("CampaignName", F.lit("A first name")))
    store = FlowBitmaps(spark, str(tmp_path / "flow"))
    store.store(given, zone="UTC")
    stored = store.days.read()
    assert stored.schema["bits"].dataType == LongType()  # 64 members
    members = given.select(F.col("RuleId"), "CampaignId", "RuleName", F.to_date(F.timestamp_millis("TimeStamp")), "Phone").filter("Phone is not null").distinct()
    assert stored.agg(F.sum(F.bit_count("bits"))).first()[0] == members.count()
    assert rows(store.metrics()) == rows(reports.rule_flow_metrics(given, zone="UTC", per="month"))
    assert rows(store.metrics(per="day")) == rows(reports.rule_flow_metrics(given, zone="UTC"))
