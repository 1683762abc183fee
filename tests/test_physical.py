"""What the plans must look like to hold up on large tables."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from catalog import queries, sample
from milepost.operators import keyed, sinks
from milepost.plans import maintenance, points, ranking, reports
from milepost.schemas import ACTIVITY_TRANSACTION
from milepost.sources.tables import read_path

FOLDER = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tx") / "table")
    sinks.append(sample.transactions(spark, FOLDER), folder, ["Year", "Month"], ["Phone"])
    return read_path(spark, folder, ACTIVITY_TRANSACTION)


def test_one_month_reads_one_directory_and_few_columns(stored):
    text = plan(points.recalc_monthly(stored, 1998, 6))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], ReadSchema: (\S+)", text)
    assert "Year" in filters[1] and "Month" in filters[1]
    assert "EqualTo(Name,AddPoint)" in filters[2]
    assert filters[3] == "struct<Phone:string,MembershipCode:string,Name:string,Value:int,TimeStamp:bigint>"


def test_day_reports_prune_months(stored):
    text = plan(reports.rows_of_day(stored, queries.SHIP_DAY, "UTC"))
    assert re.search(r"PartitionFilters: \[[^\]]*Year[^\]]*Month", text)
    assert "GreaterThanOrEqual(TimeStamp" in text


def test_points_are_folded_before_the_shuffle(stored):
    text = plan(points.recalc_monthly(stored))
    scan_to_shuffle = text.rsplit("Exchange", 1)[1]
    assert "HashAggregate" in scan_to_shuffle and "partial_sum" in scan_to_shuffle


def test_newest_row_is_chosen_before_the_shuffle(stored):
    text = plan(keyed.keep_latest(stored))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "row_number(), 1, Partial" in text


def test_top_list_keeps_a_heap(stored):
    assert "TakeOrderedAndProject" in plan(maintenance.query_transactions(stored))


def test_slice_rewrite_reads_the_slice_only(stored):
    inside = maintenance.slice_condition(1998, 6)
    assert re.search(r"PartitionFilters: \[[^\]]*Year[^\]]*1998", plan(keyed.keep_latest(stored.filter(inside))))


RANKED = ["rank_yearly", "rank_monthly", "rank_all_time", "assign_membership", "release_batches", "rule_flow_path"]


@pytest.mark.parametrize("name", RANKED)
def test_no_single_task_for_the_rows(spark, name):
    text = plan(queries.REGISTERED[name](spark, FOLDER))
    assert "SinglePartition" not in re.sub(r"BroadcastExchange[\s\S]*", "", text)


def test_tied_members_spread_over_tasks(spark):
    """Everyone at zero points: range partitioning still splits them."""
    tied = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("phone"), F.lit(2024).alias("year"), F.lit(0).alias("totalpoints"), F.lit(1).alias("timestamp")
    )
    keys = [F.asc("year"), *ranking.member_order()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        sizes = [r["count"] for r in tied.repartitionByRange(*keys).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) == 8 and max(sizes) < 50_000


def test_driving_reports_of_a_day_read_their_month_only(spark, tmp_path):
    path = str(tmp_path / "reports")
    sample.driving_reports(spark, FOLDER).withColumn("month", F.lit(1)).unionByName(
        sample.driving_reports(spark, FOLDER).withColumn("month", F.lit(3))
    ).write.partitionBy("year", "month").parquet(path)
    stored = spark.read.parquet(path)
    events = reports.daily_driving_events(stored, sample.device_users(spark, FOLDER), date(2024, 1, 15))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(events)).group(1)
    assert "month" in filters and "year" in filters
    whole = reports.daily_driving_events(stored, sample.device_users(spark, FOLDER), date(2024, 1, 15), prune=False).filter("Month = 1")
    assert sorted(map(tuple, events.collect())) == sorted(map(tuple, whole.collect())) != []
