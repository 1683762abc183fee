"""Creating the stored tables."""

from pyspark.sql import DataFrame, SparkSession

from milepost.operators.sinks import create_table
from milepost.schemas import (
    ACTIVITY_EVENT,
    ACTIVITY_SUMMARY_REPORT,
    ACTIVITY_TRANSACTION,
    DAY_PARTITIONS,
    MEMBERSHIP_MONTHLY,
    MEMBERSHIP_YEARLY,
    MONTH_PARTITIONS,
    PROFILE_TABLE,
    RULE_FLOW_METRICS,
    YEAR_PARTITIONS,
)

# name: schema, partition columns, comment
TABLES = {
    "activity_event": (ACTIVITY_EVENT, DAY_PARTITIONS, "Activity Event bronze table"),
    "activity_transaction": (ACTIVITY_TRANSACTION, DAY_PARTITIONS, "Activity Transaction bronze table"),
    "membershiptransactionmonthly": (MEMBERSHIP_MONTHLY, MONTH_PARTITIONS, "Points and tiers by month"),
    "membershiptransactionyearly": (MEMBERSHIP_YEARLY, YEAR_PARTITIONS, "Points and tiers by year"),
    "daily_rule_flow_metrics": (RULE_FLOW_METRICS, ("date",), "Rule funnel per campaign and day"),
    "profile": (PROFILE_TABLE, (), "Members with all-time points, level and rank"),
    "activity_summary_report": (ACTIVITY_SUMMARY_REPORT, (), "Reports per member and day"),
}


def create_tables(spark: SparkSession, database: str, root: str, drop: bool = False, format: str = "parquet") -> DataFrame:
    """Create the database and its tables below `root`; lists them as (table, column, type, partition).

    drop: forget existing definitions first. Their files stay.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    listing = []
    for name, (schema, by, comment) in TABLES.items():
        full = f"{database}.{name}"
        if drop:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
        create_table(spark, full, schema, list(by), f"{root}/{name}", format, comment)
        listing += [(name, c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(full)]
    return spark.createDataFrame(listing, "table string, column string, type string, partition boolean")
