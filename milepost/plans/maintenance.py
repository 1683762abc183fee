"""Duplicates, missing rows, deletion by period and look-ups."""

from pyspark.sql import Column, DataFrame, functions as F

from milepost.functions.values import lower_names
from milepost.operators.joins import rows_without_match
from milepost.operators.keyed import keep_latest
from milepost.sources.tables import pick


def deduplicate(
    table: DataFrame, year: int | None = None, month: int | None = None, phone: str | None = None, key: str = "Id", moment: str = "TimeStamp"
) -> DataFrame:
    """The table with the newest row per Id, overall or within one month (and member).

    Rows outside the given month or member are kept as they are, and so are rows without
    an Id, which are copies of nothing.
    """
    if year is None and month is None and phone is None:
        return _newest(table, key, moment)
    if year is None or month is None:
        raise ValueError("a restricted run needs both year and month")
    inside = slice_condition(year, month, phone)
    others = table.filter(~F.coalesce(inside, F.lit(False)))
    return others.unionByName(_newest(table.filter(inside), key, moment))


def _newest(rows: DataFrame, key: str, moment: str) -> DataFrame:
    without = rows.filter(F.col(key).isNull())
    return keep_latest(rows.filter(F.col(key).isNotNull()), [key], moment).unionByName(without)


def repeated_in(table: DataFrame, by: list[str], key: str = "Id") -> DataFrame:
    """The directories (columns `by`) that hold a row of a repeated Id. Reads these columns only."""
    narrow = table.select(key, *by)
    repeated = copies_per_id(narrow.filter(F.col(key).isNotNull()), key).filter("copies > 1").select(key)
    return narrow.join(repeated, key, "left_semi").select(*by).distinct()


def slice_condition(year: int, month: int, phone: str | None = None) -> Column:
    inside = (F.col("Year") == year) & (F.col("Month") == month)
    return inside & (F.col("Phone") == phone) if phone is not None else inside


def copies_per_id(table: DataFrame, key: str = "Id") -> DataFrame:
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_summary(table: DataFrame, key: str = "Id") -> DataFrame:
    """One row: records, distinct ids, surplus records, ids with copies, most copies of one id."""
    repeated = F.col("copies") > 1
    return copies_per_id(table, key).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.count(key).alias("distinct_ids"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - F.count(key)).alias("potential_duplicates"),
        F.count_if(repeated).alias("duplicate_ids"),
        F.max(F.when(repeated, F.col("copies"))).alias("max_copies"),
    )


def duplicate_distribution(table: DataFrame, key: str = "Id") -> DataFrame:
    """How many ids have how many copies."""
    repeated = copies_per_id(table, key).filter("copies > 1")
    return repeated.groupBy("copies").agg(F.count(F.lit(1)).alias("ids")).orderBy("copies")


def most_duplicated(table: DataFrame, n: int = 5, key: str = "Id") -> DataFrame:
    return copies_per_id(table, key).filter("copies > 1").orderBy(F.desc("copies"), F.asc(key)).limit(n)


def sync_missing(
    source: DataFrame, target: DataFrame, year: int | None = None, month: int | None = None, as_of: Column | None = None
) -> DataFrame:
    """Source rows of a period whose Id the target lacks there, in the target's lower-case form."""
    if month is not None and year is None:
        raise ValueError("a month needs its year")
    wanted = lower_names(pick(source, Year=year, Month=month))
    known = pick(lower_names(target), year=year, month=month)
    missing = rows_without_match(wanted, known, ["id"]).select(*wanted.columns)
    return missing if as_of is None else missing.withColumn("processed_timestamp", as_of)


def without_period(table: DataFrame, year: int, month: int) -> DataFrame:
    """The table after a deletion by period."""
    return table.filter(~F.coalesce(slice_condition(year, month), F.lit(False)))


def deletion_report(table: DataFrame, year: int, month: int, dry_run: bool = False) -> DataFrame:
    """One row (matched, deleted, remaining) for a deletion, without doing it."""
    matched = F.count_if(slice_condition(year, month))
    deleted = F.lit(0).cast("bigint") if dry_run else matched
    return table.agg(matched.alias("matched"), deleted.alias("deleted"), (matched - deleted).alias("remaining"))


LOOKUP_COLUMNS = [
    "Id", "Phone", "Date", "Month", "Year", "EventCode", "ReportCode", "Name", "Value", "TimeStamp",
    "MembershipCode", "Type",
]


def matching_transactions(transactions: DataFrame, phone: str | None = None, year: int | None = None, month: int | None = None) -> DataFrame:
    return pick(transactions, Phone=phone, Year=year, Month=month).select(*LOOKUP_COLUMNS)


def query_transactions(transactions: DataFrame, phone=None, year=None, month=None, n: int = 20) -> DataFrame:
    """The newest matching transactions."""
    found = matching_transactions(transactions, phone, year, month)
    rest = [F.asc_nulls_last(c) for c in LOOKUP_COLUMNS if c != "TimeStamp"]
    return found.orderBy(F.desc_nulls_last("TimeStamp"), *rest).limit(n)
