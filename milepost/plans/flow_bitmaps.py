"""The rule funnel over any stretch of days, from stored daily bitmaps of members.

Distinct members cannot be added up over days, but sets can be joined. Members are numbered once; a
day keeps, per rule, the sums of its actions and the set of its members as a bitmap of their
numbers, in words of 64 that have members: most rules have few members a day, and a word takes a few bytes where a whole
bitmap would take thousands. A longer period is then the union of its days' bitmaps, without reading transactions.
"""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from milepost.functions.calendar import rows_of_day
from milepost.operators.ordering import positions
from milepost.operators.sinks import deal
from milepost.operators.versions import VersionedTable
from milepost.plans.reports import FLOW_RULE, actions_per_member, flow_rows, one_name
from milepost.schemas import BUSINESS_ZONE, layout
from milepost.session import stage

MEMBERS = layout("phone string, number bigint")
DAYS = layout(
    "date date, CampaignId string, RuleId string, RuleName string, campaignname string, actions bigint, scored bigint, "
    "points bigint, word bigint, bits bigint"
)
SUMS = ["actions", "scored", "points"]


class FlowBitmaps:
    """Daily bitmaps below `path`. A row holds a word of a rule's bitmap, the members whose numbers lie in it, and the
    sums of their actions; what has no member has no word."""

    def __init__(self, spark: SparkSession, path: str):
        self.members = VersionedTable(spark, f"{path}/members", MEMBERS, key="phone")
        self.days = VersionedTable(spark, f"{path}/days", DAYS, by=["date"])

    def number(self, phones: DataFrame) -> DataFrame:
        """(phone, number) of the given phones; unknown ones get the next numbers, from 1, in one commit."""
        phones = stage(phones.select("phone").filter("phone is not null").distinct(), "phones")
        known = self.members.read(self.members.slots_of(phones)) if self.members.exists() else self.members.read()
        new = phones.join(known, "phone", "left_anti")
        next_ = self.members.last().notes.get("next", 1)
        numbered = positions(new, [F.asc("phone")], index="_place").select("phone", (F.col("_place") + next_ - 1).alias("number"))
        numbered = stage(numbered, "numbered")
        count = numbered.count()
        if count:
            self.members.append(numbered, {"next": next_ + count})
        return known.unionByName(numbered).join(phones, "phone", "left_semi")

    def store(self, transactions: DataFrame, day: date | None = None, zone: str = BUSINESS_ZONE, prune: bool = True) -> None:
        """Put the bitmaps of one day, or of every day in `transactions`, in place of what is stored for them."""
        if day is not None:
            transactions = rows_of_day(transactions, day, zone, prune)
        rows = actions_per_member(transactions, day, zone).withColumnRenamed("Phone", "phone")  # staged
        sizes = {tuple(r[:-1]): r[-1] for r in rows.groupBy(F.col("date").cast("string")).count().collect()}  # one row per day
        word, bit = F.shiftright("number", 6).alias("word"), F.expr("shiftleft(1L, cast(number & 63 as int))").alias("bit")
        # Staged, so that this shuffle and the next are not on disk together.
        placed = stage(rows.join(self.number(rows), "phone", "left").select(*FLOW_RULE, "campaignname", *SUMS, word, bit), "placed")
        dealt, part = deal(placed, ["date"], ["CampaignId", "RuleId", "RuleName", "word"], sizes)
        words = _united(dealt, [*FLOW_RULE, "campaignname", "word", *part], "bit")
        base = self.days.last()
        new = self.days.write(words.sortWithinPartitions("date", "CampaignId", "RuleId"), laid=True)
        emptied = {f"date={day}": ()} if day is not None else {}
        self.days.publish(base, emptied | {slot: (run,) for slot, run in new.items()})
        self.days.clean()

    def metrics(self, first: date | None = None, last: date | None = None, per: str = "month", as_of: datetime | None = None) -> DataFrame:
        """The funnel per month (or day) over the stored days from `first` to `last`, layout as `rule_flow_metrics`."""
        commit = self.days.last()
        inside = [s for s in commit.slots if (first is None or s >= f"date={first}") and (last is None or s <= f"date={last}")]
        rows = self.days.read(inside, commit)
        if per == "month":
            rows = rows.withColumn("date", F.trunc("date", "month"))
        # One word of one rule per row; least names of text would be sorted for, so only if there are several.
        words = stage(_united(rows, [*FLOW_RULE, "campaignname", "word"]), "words")
        named = one_name(words)
        if not named:
            words = stage(_united(words, [*FLOW_RULE, "word"], least=["campaignname"]), "words")
        members = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint")
        whole = words.groupBy(*FLOW_RULE, *(["campaignname"] if named else [])).agg(
            *([] if named else [F.min("campaignname").alias("campaignname")]), members.alias("profiles_evaluated"),
            F.sum("actions").alias("total_actions"), F.sum("scored").alias("addpoint_actions"), F.sum("points").alias("points_awarded"),
        )
        campaign = ["date", "CampaignId"]
        unions = words.groupBy(*campaign, "word").agg(F.bit_or("bits").alias("bits"))
        evaluated = unions.groupBy(*campaign).agg(members.alias("total_profiles_evaluated"))
        return flow_rows(stage(whole, "rules"), evaluated, as_of)


def _united(words: DataFrame, keys: list[str], bits: str = "bits", least: list[str] = ()) -> DataFrame:
    """Union of the members and sums of their actions, per key."""
    return words.groupBy(*keys).agg(*[F.min(c).alias(c) for c in least], *[F.sum(c).alias(c) for c in SUMS], F.bit_or(bits).alias("bits"))
