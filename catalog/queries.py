"""One entry per pipeline or operator: (spark, folder of tables) -> DataFrame."""

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from catalog import sample
from milepost.functions.messages import decode_rows
from milepost.functions.values import level_for, lower_names
from milepost.operators import sinks
from milepost.operators.documents import DocumentStore
from milepost.operators.keyed import insert_absent, keep_latest, replace_rows
from milepost.operators.versions import VersionedTable
from milepost.plans import levels, maintenance, membership, points, publish, ranking, reconcile, reports
from milepost.plans.flow_bitmaps import FlowBitmaps
from milepost.plans.standing import Standing
from milepost.schemas import ACTIVITY_EVENT, ACTIVITY_TRANSACTION, LIVE_REPORT, MEMBERSHIP_MONTHLY, MEMBERSHIP_YEARLY
from milepost.schemas import layout
from milepost.session import list_folder, new_folder, remove_folder, stage
from milepost.sources.streams import read_files
from milepost.sources.tables import read_or_empty
from milepost.streaming import ingest, users
from milepost.streaming import points as stream_points

DAY = date(2024, 1, 15)  # of events, which cover January 2024
SHIP_DAY = date(1995, 8, 9)  # of transactions
ROLLED = (1998, 12)
MONTH = (1998, 6)
AS_OF = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)
MODIFIED_SINCE = datetime(2001, 1, 1, tzinfo=timezone.utc)
EVENT_KINDS = ("click", "purchase", "view")
PERCENTILE_MIN_POINTS = 30
BY_MONTH = ["Year", "Month"]


def monthly(spark, folder):
    return points.recalc_monthly(sample.transactions(spark, folder))


def yearly(spark, folder):
    return points.recalc_yearly(monthly(spark, folder))


def of_type(spark, folder, kind):
    return sample.transactions(spark, folder).filter(F.col("Type") == kind)


# --- points ---------------------------------------------------------------


def recalc_monthly_positive(spark, folder):
    return points.recalc_monthly(sample.transactions(spark, folder), positive_only=True)


def recalc_one_month(spark, folder):
    return points.recalc_monthly(sample.transactions(spark, folder), *MONTH)


def recalc_monthly_upsert(spark, folder):
    """Totals of finished lines are on file; the recalculation covers all lines."""
    on_file = points.recalc_monthly(of_type(spark, folder, "F"))
    return points.recalc_monthly(sample.transactions(spark, folder), target=on_file)


def increment_members(spark, folder):
    """Totals of finished lines plus the points of open ones."""
    on_file = points.recalc_monthly(of_type(spark, folder, "F"))
    delta = points.points_per(lower_names(points.scoring(of_type(spark, folder, "O"))), ["month", "year"])
    return points.increment_members(on_file, delta, ["phone", "month", "year"])


def recalc_all_time(spark, folder):
    return points.recalc_all_time(yearly(spark, folder))


def upsert_profiles(spark, folder):
    state = points.upsert_profiles(sample.profiles(spark, folder), recalc_all_time(spark, folder), F.lit(AS_OF))
    return state.select("Id", "Phone", "Level", "TotalPoints", "Rank", "MembershipCode")


# --- ranking and tiers ------------------------------------------------------


def rank_monthly(spark, folder):
    return ranking.rank_monthly(monthly(spark, folder))


def rank_yearly(spark, folder):
    return ranking.rank_yearly(yearly(spark, folder))


def rank_all_time(spark, folder):
    return ranking.rank_all_time(sample.profiles(spark, folder))


def ties_report(spark, folder):
    return ranking.ties_report(rank_yearly(spark, folder), ["year"])


def duplicate_ranks(spark, folder):
    return ranking.duplicate_ranks(rank_yearly(spark, folder), ["year"])


def points_summary(spark, folder):
    return ranking.points_summary(yearly(spark, folder), ["year"])


def top_members(spark, folder):
    totals = recalc_all_time(spark, folder).select("Phone", "TotalPoints", "MembershipCode")
    return ranking.top_members(totals, 10, "TotalPoints", "Phone")


def leaders(spark, folder):
    """Who leads each month: the ten best members of every month."""
    return ranking.leaders(monthly(spark, folder), 10)


def assign_membership(spark, folder):
    return membership.assign_membership(yearly(spark, folder), ["year"])


def assign_membership_percentiles(spark, folder):
    return membership.assign_membership(
        yearly(spark, folder), ["year"], percentile_rules=True, min_points=PERCENTILE_MIN_POINTS
    )


def membership_distribution(spark, folder):
    return membership.membership_distribution(assign_membership_percentiles(spark, folder))


def sync_membership_to_profiles(spark, folder):
    state = membership.sync_membership_to_profiles(sample.profiles(spark, folder), monthly(spark, folder), *MONTH)
    return state.select("Id", "Phone", "MembershipCode")


def sync_membership_to_yearly(spark, folder):
    return membership.sync_membership_to_yearly(yearly(spark, folder), monthly(spark, folder), *MONTH)


# --- levels -----------------------------------------------------------------


def update_levels(spark, folder):
    return levels.update_levels(sample.profiles(spark, folder))


def update_levels_recent(spark, folder):
    return levels.update_levels(sample.profiles(spark, folder), MODIFIED_SINCE)


def level_transactions(spark, folder):
    return levels.level_transactions(update_levels(spark, folder), AS_OF)


def apply_levels(spark, folder):
    state = levels.apply_levels(sample.profiles(spark, folder), update_levels(spark, folder))
    return state.select("Id", "Phone", "Level", "TotalPoints")


def level_distribution(spark, folder):
    """Members per level, by monthly points."""
    level = level_for(F.col("totalpoints")).alias("level")
    return monthly(spark, folder).groupBy(level).agg(F.count(F.lit(1)).alias("members"))


# --- publishing ---------------------------------------------------------------


def publish_monthly(spark, folder):
    return publish.monthly_fields(rank_monthly(spark, folder))


def publish_yearly(spark, folder):
    return publish.yearly_fields(rank_yearly(spark, folder))


def publish_profiles(spark, folder):
    return publish.profile_fields(sample.profiles(spark, folder), F.lit(AS_OF))


def _read_back(documents, fields):
    """Documents taken apart again: their key, and every field by its name."""
    parsed = F.from_json("doc", fields.schema, {"mode": "FAILFAST"}).alias("d")
    return documents.select("doc_id", parsed).select("doc_id", "d.*")


def publish_monthly_documents(spark, folder):
    ranked = rank_monthly(spark, folder)
    return _read_back(publish.publish_monthly(ranked), publish.monthly_fields(ranked))


def publish_yearly_documents(spark, folder):
    ranked = rank_yearly(spark, folder)
    return _read_back(publish.publish_yearly(ranked), publish.yearly_fields(ranked))


def publish_profiles_documents(spark, folder):
    profiles = sample.profiles(spark, folder)
    return _read_back(publish.publish_profiles(profiles, F.lit(AS_OF)), publish.profile_fields(profiles, F.lit(AS_OF)))


def roll_forward(spark, folder):
    return publish.roll_forward(monthly(spark, folder), ROLLED)


# --- reports --------------------------------------------------------------------


def event_summary(spark, folder):
    return reports.event_summary(sample.activity_events(spark, folder), kinds=EVENT_KINDS)


def event_summary_day(spark, folder):
    return reports.event_summary(sample.activity_events(spark, folder), DAY, kinds=EVENT_KINDS)


def flow(spark, folder):
    return reports.rule_flow_metrics(sample.transactions(spark, folder), zone="UTC")


def date_as_text(df):
    return df.withColumn("date", F.col("date").cast("string"))


def rule_flow_metrics(spark, folder):
    return date_as_text(flow(spark, folder))


def rule_flow_metrics_day(spark, folder):
    return date_as_text(reports.rule_flow_metrics(sample.transactions(spark, folder), SHIP_DAY, AS_OF))


def campaign_overview(spark, folder):
    return reports.campaign_overview(flow(spark, folder))


def rule_flow_path(spark, folder):
    return date_as_text(reports.rule_flow_path(flow(spark, folder)))


def daily_driving_events(spark, folder):
    return reports.daily_driving_events(sample.driving_reports(spark, folder), sample.device_users(spark, folder))


def daily_driving_events_day(spark, folder):
    return reports.daily_driving_events(
        sample.driving_reports(spark, folder), sample.device_users(spark, folder), DAY
    )


def driving_messages(spark, folder):
    """The driving events written as messages and read back from them."""
    return decode_rows(reports.driving_messages(daily_driving_events(spark, folder)), ACTIVITY_EVENT)


def verify_live_reports(spark, folder):
    state = reports.verify_live_reports(sample.live_reports(spark, folder), int(AS_OF.timestamp()))
    return state.select("id", "status", "submit_time", "last_modified", "last_modified_by")


def release_batches(spark, folder):
    placed = reports.release_batches(sample.live_reports(spark, folder), int(AS_OF.timestamp()))
    return placed.select("id", "lat", "lng", "expired_display_time", "batch_no", "total_records")


def release_live_reports(spark, folder):
    """What each message holds: features, first and last id, announced total."""
    released = reports.release_live_reports(sample.live_reports(spark, folder), int(AS_OF.timestamp()))
    shape = "struct<total_records: bigint, data: struct<features: array<struct<properties: struct<id: string>>>>>"
    message = released.select("batch_no", F.from_json("value", shape).alias("m"))
    ids = F.col("m.data.features.properties.id")
    return message.select(
        "batch_no",
        F.size(ids).alias("features"),
        F.array_min(ids).alias("first_id"),
        F.array_max(ids).alias("last_id"),
        F.col("m.total_records").alias("total_records"),
    )


RELEASED = (
    "struct<trans_id: string, message_type: string, total_records: bigint, data: struct<type: string, features: array<struct<type: string, "
    "geometry: struct<coordinates: array<double>, type: string>, properties: struct<id: string, heading: double, "
    "expiredDisplayTimeUnix: bigint, cellId: string, numberOfView: int, numberOfConfirm: int, numberOfRejection: int, "
    "minimizationHexColor: string>>>>>"
)


def release_live_reports_messages(spark, folder):
    """Every field of every feature of the released messages, read back from their text."""
    released = reports.release_live_reports(sample.live_reports(spark, folder), int(AS_OF.timestamp()))
    message = released.select("batch_no", F.from_json("value", RELEASED, {"mode": "FAILFAST"}).alias("m"))
    feature = message.select("batch_no", "m.message_type", "m.total_records", F.col("m.data.type").alias("collection"), F.posexplode("m.data.features").alias("place", "f"))
    return feature.select(
        "batch_no", "message_type", "total_records", "collection", "place", F.col("f.type").alias("kind"), F.col("f.geometry.type").alias("shape"),
        F.col("f.geometry.coordinates")[0].alias("lng"), F.col("f.geometry.coordinates")[1].alias("lat"), "f.properties.*",
    )


def rule_flow_month(spark, folder):
    """The funnel per month, with members distinct over the month."""
    return date_as_text(reports.rule_flow_metrics(sample.transactions(spark, folder), zone="UTC", per="month"))


def rule_flow_month_bitmaps(spark, folder):
    """The same from daily bitmaps that were stored before."""
    store = FlowBitmaps(spark, new_folder(spark, "flow"))
    store.store(sample.transactions(spark, folder), zone="UTC")
    return date_as_text(store.metrics())


# --- maintenance ------------------------------------------------------------------


def deduplicate(spark, folder):
    return maintenance.deduplicate(sample.transactions(spark, folder))


def deduplicate_month(spark, folder):
    return maintenance.deduplicate(sample.transactions(spark, folder), *MONTH)


def duplicate_summary(spark, folder):
    return maintenance.duplicate_summary(sample.transactions(spark, folder))


def duplicate_distribution(spark, folder):
    return maintenance.duplicate_distribution(sample.transactions(spark, folder))


def most_duplicated(spark, folder):
    return maintenance.most_duplicated(sample.transactions(spark, folder))


def sync_missing(spark, folder):
    """Finished lines have been synced before."""
    return maintenance.sync_missing(sample.transactions(spark, folder), of_type(spark, folder, "F"))


def sync_missing_month(spark, folder):
    return maintenance.sync_missing(sample.transactions(spark, folder), of_type(spark, folder, "F"), *MONTH)


def delete_period(spark, folder):
    return maintenance.without_period(sample.transactions(spark, folder), *MONTH)


def deletion_report(spark, folder):
    return maintenance.deletion_report(sample.transactions(spark, folder), *MONTH)


def query_transactions(spark, folder):
    return maintenance.query_transactions(sample.transactions(spark, folder))


def matching_transactions(spark, folder):
    return maintenance.matching_transactions(sample.transactions(spark, folder), None, *MONTH)


def insert_absent_by_id(spark, folder):
    stored = keep_latest(of_type(spark, folder, "F"))
    return insert_absent(stored, keep_latest(of_type(spark, folder, "O")), ["Id"])


def replace_rows_by_id(spark, folder):
    stored = keep_latest(of_type(spark, folder, "F"))
    return replace_rows(stored, keep_latest(of_type(spark, folder, "O")), ["Id"])


# --- stored tables: written, changed in place, read back ---------------------------------


def _stored_transactions(spark, folder):
    path = new_folder(spark, "stored")
    sinks.append(sample.transactions(spark, folder), path, BY_MONTH, ["Phone"])
    return path


def verify_live_reports_stored(spark, folder):
    """Reports that are due are verified in a stored table; buckets without one keep their files."""
    given, as_of = sample.live_reports(spark, folder), int(AS_OF.timestamp())
    table = VersionedTable(spark, new_folder(spark, "reports"), LIVE_REPORT, key="id")
    table.replace_all(given)
    due = table.read().filter(reports.due_for_verification(as_of)).select("id")
    table.change(due, lambda rows: reports.verify_live_reports(rows, as_of))
    return table.read().select("id", "status", "submit_time", "last_modified", "last_modified_by")


def delete_period_stored(spark, folder):
    path = _stored_transactions(spark, folder)
    sinks.delete_slice(spark, path, ACTIVITY_TRANSACTION, dict(zip(BY_MONTH, MONTH)))
    return read_or_empty(spark, path, ACTIVITY_TRANSACTION)


def deduplicate_month_stored(spark, folder):
    """The month's directory is replaced by its de-duplicated rows."""
    path = _stored_transactions(spark, folder)
    rows = read_or_empty(spark, path, ACTIVITY_TRANSACTION)
    inside = maintenance.slice_condition(*MONTH)
    sinks.replace_slice(maintenance.deduplicate(rows.filter(inside)), path, BY_MONTH, inside, ["Phone"])
    return read_or_empty(spark, path, ACTIVITY_TRANSACTION)


def sync_missing_by_digest(spark, folder):
    """Finished lines have been copied; only directories whose digests differ are compared."""
    source, target = _stored_transactions(spark, folder), new_folder(spark, "copy")
    copied = lower_names(read_or_empty(spark, source, ACTIVITY_TRANSACTION).filter(F.col("Type") == "F"))
    sinks.append(copied, target, ["year", "month"], ["phone"])
    memory = new_folder(spark, "digests")
    return reconcile.missing_rows(spark, source, ACTIVITY_TRANSACTION, target, copied.schema, BY_MONTH, memory)[0]


def rank_after_changes(spark, folder):
    """Ranks kept up to date: points of overdrawn customers, unknown at first, become known."""
    profiles = sample.profiles(spark, folder).select(F.col("Id").alias("id"), F.col("Phone").alias("phone"), F.col("TotalPoints").alias("totalpoints"))
    standing = Standing(spark, new_folder(spark, "standing"))
    standing.build(profiles, band_members=200)
    totals = recalc_all_time(spark, folder).select(F.col("Phone").alias("phone"), F.col("TotalPoints").alias("new_points"))
    unknown = profiles.filter(F.col("totalpoints").isNull()).join(totals, "phone")
    standing.change(unknown.select("id", "phone", F.lit(0).cast("bigint").alias("old_points"), "new_points"))
    return standing.ranks()


# --- streams: run on what is there, then show the table they leave -------------------


def ingest_events(spark, folder):
    root, checkpoint = new_folder(spark, "events"), new_folder(spark, "checkpoint")
    ingest.ingest_events(sample.event_messages(spark, folder), root, checkpoint).awaitTermination()
    return ingest.stored_rows(spark, root, ACTIVITY_EVENT)


def ingest_events_fill(spark, folder):
    root, checkpoint = new_folder(spark, "events"), new_folder(spark, "checkpoint")
    ingest.ingest_events(sample.event_messages(spark, folder), root, checkpoint, "fill").awaitTermination()
    return ingest.stored_documents(spark, root, ACTIVITY_EVENT)


def ingest_transactions(spark, folder):
    root, checkpoint = new_folder(spark, "transactions"), new_folder(spark, "checkpoint")
    messages = sample.transaction_messages(spark, folder)
    ingest.ingest_transactions(messages, root, checkpoint, by=BY_MONTH).awaitTermination()
    return ingest.stored_rows(spark, root, ACTIVITY_TRANSACTION)


def ingest_transactions_fill(spark, folder):
    """The log keeps every arrival."""
    root, checkpoint = new_folder(spark, "transactions"), new_folder(spark, "checkpoint")
    messages = sample.transaction_messages(spark, folder)
    ingest.ingest_transactions(messages, root, checkpoint, "fill", by=BY_MONTH).awaitTermination()
    return ingest.logged_rows(spark, root, ACTIVITY_TRANSACTION)


def _streamed_points(spark, folder, period):
    root, checkpoint = new_folder(spark, "points"), new_folder(spark, "checkpoint")
    messages = sample.transaction_messages(spark, folder)
    stream_points.stream_points(messages, root, checkpoint, period).awaitTermination()
    return root


def stream_points_month(spark, folder):
    return stream_points.current_members(spark, _streamed_points(spark, folder, "month"), "month")


def stream_points_year(spark, folder):
    return stream_points.current_members(spark, _streamed_points(spark, folder, "year"), "year")


def stream_points_all(spark, folder):
    root = _streamed_points(spark, folder, "all")
    state = stream_points.current_profiles(spark, root, sample.profiles(spark, folder), F.lit(AS_OF))
    return state.select("Id", "Phone", "TotalPoints")


def _in_thirds(spark, folder):
    """The transactions, joined once and staged in one directory for each third by Id."""
    third = F.pmod(F.xxhash64("Id"), F.lit(3)).cast("int")
    return stage(sample.transactions(spark, folder).withColumn("_third", third), "thirds", ["_third"])


def _in_batches(spark, thirds, parts, run):
    """Run a stream over an inbox: thirds of the transactions (`_in_thirds`) arrive in the order given.

    A third is written in parallel and makes one batch; its files go once it is stored, as a queue drops what all
    have read. run: (messages, checkpoint) -> query
    """
    inbox, checkpoint = new_folder(spark, "inbox"), new_folder(spark, "checkpoint")
    for part in parts:
        rows = thirds.filter(F.col("_third") == part).drop("_third")
        sample.as_messages(rows).write.mode("append").option("compression", "zstd").parquet(inbox)
        run(read_files(spark, inbox, layout("value binary")), checkpoint).awaitTermination()
        for name in list_folder(spark, inbox):
            remove_folder(spark, f"{inbox}/{name}")


def ingest_transactions_batches(spark, folder):
    """Batches of which one arrives again, and a restart with a new checkpoint that sends another again."""
    root, thirds = new_folder(spark, "transactions"), _in_thirds(spark, folder)
    for parts in ((0, 1, 0), (2, 1)):
        _in_batches(spark, thirds, parts, lambda messages, checkpoint: ingest.ingest_transactions(messages, root, checkpoint, by=BY_MONTH))
    return ingest.stored_rows(spark, root, ACTIVITY_TRANSACTION)


def ingest_transactions_anywhere(spark, folder):
    """Ids are searched in the whole table, through its Bloom filters, when thirds arrive again."""
    root, thirds = new_folder(spark, "transactions"), _in_thirds(spark, folder)
    for parts in ((0, 1), (1, 2)):
        _in_batches(
            spark, thirds, parts, lambda messages, checkpoint: ingest.ingest_transactions(messages, root, checkpoint, by=BY_MONTH, id_scope=[])
        )
    return ingest.stored_rows(spark, root, ACTIVITY_TRANSACTION)


def ingest_transactions_copy(spark, folder):
    """The keyed copy after three batches, a compaction, and one of them again by another stream."""
    root, thirds = new_folder(spark, "transactions"), _in_thirds(spark, folder)
    for parts in ((0, 1, 2), (1,)):
        _in_batches(spark, thirds, parts, lambda messages, checkpoint: ingest.ingest_transactions(messages, root, checkpoint, by=BY_MONTH))
        ingest.compact_copy(spark, root, ACTIVITY_TRANSACTION)
    return ingest.stored_copy(spark, root, ACTIVITY_TRANSACTION).select("id", "phone", "year", "month", "value", "activityid")


def ingest_transactions_documents(spark, folder):
    """The newest version of each Id and month after several batches of the fill policy."""
    root = new_folder(spark, "transactions")
    _in_batches(
        spark, _in_thirds(spark, folder), (0, 1, 2, 1), lambda messages, checkpoint: ingest.ingest_transactions(messages, root, checkpoint, "fill", by=BY_MONTH)
    )
    return ingest.stored_documents(spark, root, ACTIVITY_TRANSACTION).select("Id", "Year", "Month", "Type")


def documents_replaced(spark, folder):
    """Merged runs of five batches: finished lines, open ones, corrections of all scored lines without
    a value, finished lines once more (they arrive last, so they count), and a repeated batch."""
    rows = stage(sample.transactions(spark, folder), "rows")
    corrected = rows.filter(F.col("Name") == "AddPoint").withColumns(
        {"Value": F.lit(None).cast("int"), "EventName": F.lit("Corrected"), "TimeStamp": F.col("TimeStamp") + 1}
    )
    store = DocumentStore(spark, new_folder(spark, "documents"), ACTIVITY_TRANSACTION, ["Id"], BY_MONTH, fan=2, levels=2)
    finished, opened = (rows.filter(F.col("Type") == kind) for kind in ("F", "O"))
    for number, batch in enumerate((finished, opened, corrected, finished)):
        store.put(batch, number)
    store.put(corrected, 2)
    return store.read().select("Id", "Year", "Month", "Phone", "Value", "EventName", "TimeStamp")


def stream_points_batches(spark, folder):
    """Points of two streams, one of two batches, with a compaction in between."""
    root, thirds = new_folder(spark, "points"), _in_thirds(spark, folder)
    for parts in ((0, 1), (2,)):
        _in_batches(spark, thirds, parts, lambda messages, checkpoint: stream_points.stream_points(messages, root, checkpoint, "month"))
        stream_points.compact_points(spark, root, "month")
    members = stream_points.current_members(spark, root, "month")
    return members.select("phone", "year", "month", "totalpoints")


def _register(spark, folder):
    monthly_path, yearly_path = new_folder(spark, "monthly"), new_folder(spark, "yearly")
    messages = sample.user_messages(spark, folder)
    users.register_users(messages, monthly_path, yearly_path, new_folder(spark, "checkpoint"), AS_OF).awaitTermination()
    return monthly_path, yearly_path


def register_users_monthly(spark, folder):
    return spark.read.schema(MEMBERSHIP_MONTHLY).parquet(_register(spark, folder)[0])


def register_users_yearly(spark, folder):
    return spark.read.schema(MEMBERSHIP_YEARLY).parquet(_register(spark, folder)[1])


def stream_drop_repeats(spark, folder):
    """Ids that pass the stateful filter when thirds arrive again and again, in five batches."""
    root = new_folder(spark, "once")

    def run(messages, checkpoint):
        once = ingest.drop_repeats(ingest.clean_transactions(messages), "4000 days").select("Id")
        return once.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(root, "parquet")

    _in_batches(spark, _in_thirds(spark, folder), (0, 1, 0, 2, 1), run)
    return spark.read.schema("Id string").parquet(root)


def stream_running_totals(spark, folder):
    """Points kept as streaming state; the newest update of each key counts."""
    root, checkpoint = new_folder(spark, "state"), new_folder(spark, "checkpoint")
    totals = stream_points.running_totals(stream_points.scored_rows(sample.transaction_messages(spark, folder)))
    record = stream_points.ledger.record
    query = (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: record(batch, root, batch_id))
        .start()
    )
    query.awaitTermination()
    rows = stream_points.ledger.entries(spark, root, totals.schema)
    return stream_points.ledger.fold_latest(rows, ["phone", "month", "year"]).select(*totals.columns)


REGISTERED = {
    query.__name__: query
    for query in (
        ingest_transactions_batches, ingest_transactions_copy, ingest_transactions_documents, stream_points_batches,
        recalc_monthly_positive, recalc_one_month, recalc_monthly_upsert, increment_members, recalc_all_time,
        upsert_profiles, rank_monthly, rank_yearly, rank_all_time, ties_report, duplicate_ranks, points_summary,
        top_members, leaders, assign_membership, assign_membership_percentiles, membership_distribution,
        sync_membership_to_profiles, sync_membership_to_yearly, update_levels, update_levels_recent,
        level_transactions, apply_levels, level_distribution, publish_monthly, publish_yearly, publish_profiles,
        roll_forward, event_summary, event_summary_day, rule_flow_metrics, rule_flow_metrics_day,
        campaign_overview, rule_flow_path, daily_driving_events, daily_driving_events_day, driving_messages,
        verify_live_reports, release_batches, release_live_reports, deduplicate, deduplicate_month,
        duplicate_summary, duplicate_distribution, most_duplicated, sync_missing, sync_missing_month,
        delete_period, deletion_report, query_transactions, matching_transactions, insert_absent_by_id,
        replace_rows_by_id, ingest_events, ingest_events_fill, ingest_transactions, ingest_transactions_fill,
        stream_points_month, stream_points_year, stream_points_all, register_users_monthly,
        register_users_yearly, stream_drop_repeats, stream_running_totals, ingest_transactions_anywhere,
        documents_replaced, verify_live_reports_stored, delete_period_stored, deduplicate_month_stored,
        sync_missing_by_digest, rank_after_changes, publish_monthly_documents, publish_yearly_documents,
        publish_profiles_documents, release_live_reports_messages, rule_flow_month, rule_flow_month_bitmaps,
    )
} | {"recalc_monthly": monthly, "recalc_yearly": yearly}
