"""First membership rows for new users."""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from milepost.functions.messages import decode_object, first_user_phone
from milepost.operators.sinks import append_absent
from milepost.schemas import (
    BUSINESS_ZONE,
    CREATE_USER_EVENT,
    DEFAULT_TIER,
    MEMBERSHIP_MONTHLY,
    MEMBERSHIP_YEARLY,
    MONTH_PARTITIONS,
    TIER_NAMES,
    UNRANKED_MEMBER,
    USER_EVENT,
    YEAR_PARTITIONS,
)
from milepost.streaming.runner import decided, kept, start


def new_phones(messages: DataFrame) -> DataFrame:
    """Phones of newly created users; events without one are skipped."""
    events = decode_object(messages, USER_EVENT).filter(F.col("Event") == CREATE_USER_EVENT)
    return events.select(first_user_phone(F.col("Datas")).alias("phone")).filter(F.col("phone").isNotNull())


def first_rows(phones: DataFrame, as_of: datetime, zone: str = BUSINESS_ZONE) -> DataFrame:
    """A member's row for the current period, before any points."""
    local = as_of.astimezone(ZoneInfo(zone))
    return phones.distinct().select(
        "phone",
        F.lit(DEFAULT_TIER).alias("membershipcode"),
        F.lit(TIER_NAMES[DEFAULT_TIER]).alias("membershipname"),
        F.lit(local.month).alias("month"),
        F.lit(local.year).alias("year"),
        F.lit(UNRANKED_MEMBER).alias("rank"),
        F.lit(0).cast("bigint").alias("totalpoints"),
        F.lit(int(as_of.timestamp() * 1000)).cast("bigint").alias("timestamp"),
    )


def now(zone: str) -> datetime:
    return datetime.now(ZoneInfo(zone))


def register_users(
    messages: DataFrame,
    monthly: str,
    yearly: str,
    checkpoint: str,
    as_of: datetime | None = None,
    zone: str = BUSINESS_ZONE,
    every: str | None = None,
) -> StreamingQuery:
    """Give every new user a monthly and a yearly row of the current period, if they have none.

    monthly, yearly: table folders. as_of: fixed point in time, else the moment at which each batch
    first ran, which is kept with the checkpoint: a batch replayed later, even in another
    month, asks for the same rows again.
    """

    def handle(batch: DataFrame, batch_id: int, stream: str) -> None:
        moment = as_of or datetime.fromisoformat(decided(batch.sparkSession, checkpoint, batch_id, now(zone).isoformat()))
        with kept(first_rows(batch, moment, zone)) as rows:
            if rows.isEmpty():
                return
            # The period is part of the key, so only its directory is searched.
            append_absent(rows, monthly, MEMBERSHIP_MONTHLY, ["phone"], MONTH_PARTITIONS, scope=MONTH_PARTITIONS)
            append_absent(rows, yearly, MEMBERSHIP_YEARLY, ["phone"], YEAR_PARTITIONS, scope=YEAR_PARTITIONS)

    return start(new_phones(messages), handle, checkpoint, every)
