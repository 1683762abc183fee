"""The pipelines as jobs over a folder of tables.

    spark-submit milepost/jobs.py --root /warehouse recalc-monthly --year 2024 --month 5

Every job reads its tables from `<root>/<table>`, computes the new rows with the
functions in `plans`, and replaces just the directories it is about. Periods are
always given; nothing is taken from the clock but the default of --as-of.
"""

import argparse
from datetime import date, datetime, timezone
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F

from milepost.functions import messages
from milepost.operators import id_filters, ledger, sinks
from milepost.operators.keyed import update_only
from milepost.operators.versions import VersionedTable
from milepost.plans import ddl, levels, maintenance, membership, points, publish, ranking, reports
from milepost.session import build_session, clear_staged, folder_exists, list_folder, remove_folder, stage
from milepost.sources.streams import MESSAGE, read_files, read_topic
from milepost.sources.tables import pick, read_or_empty
from milepost.schemas import DAILY_SUMMARY_REPORT, DEVICE_USER, LIVE_REPORT, layout
from milepost.streaming import ingest, users
from milepost.streaming import points as stream_points

MONTHLY, YEARLY = "membershiptransactionmonthly", "membershiptransactionyearly"
EVENTS, TRANSACTIONS = "activity_event", "activity_transaction"
EXTRA_TABLES = {
    "daily_summary_report": DAILY_SUMMARY_REPORT,
    "device_user": DEVICE_USER,
    "live_report": LIVE_REPORT,
}
# Tables that jobs change in part, in hash buckets of a key.
KEYED = {"profile": "Phone", "live_report": "id"}
KEPT_VERSIONS = 3  # for readers that began before the last changes


class Tables:
    """Tables below one folder. Those of KEYED are kept in numbered versions; one that was
    written as plain files is taken over by the first job that changes it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, may_be_new: bool = True) -> DataFrame:
        """A table; one that a job only reads must exist (may_be_new=False)."""
        if not may_be_new and not folder_exists(self.spark, self.path(name)):
            raise FileNotFoundError(f"no table at {self.path(name)}")
        if name in KEYED and (table := self.versioned(name)).exists():
            return table.read()
        return read_or_empty(self.spark, self.path(name), self.schema(name))

    def schema(self, name: str):
        return EXTRA_TABLES[name] if name in EXTRA_TABLES else ddl.TABLES[name][0]

    def versioned(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), self.schema(name), key=KEYED[name], sort=[KEYED[name]])

    def take_over(self, name: str) -> VersionedTable:
        """The versioned table; the rows of plain files become its first version."""
        table = self.versioned(name)
        if not table.exists():
            table.replace_all(self.read(name))
        return table

    def tidy(self, table: VersionedTable) -> None:
        """Old versions go, and the plain files that a first version was made of."""
        for file in list_folder(self.spark, table.path):
            if not file.startswith(("_write=", "_commits")):
                remove_folder(self.spark, f"{table.path}/{file}")
        table.clean(KEPT_VERSIONS)

    def change(self, name: str, keys: DataFrame, make, notes: dict | None = None) -> None:
        """Put make(rows) in place of the rows in the buckets of `keys`; all other files stay."""
        table = self.take_over(name)
        table.change(keys, make, notes)
        self.tidy(table)

    def change_and_tell(self, name: str, keys: DataFrame, make, outgoing: DataFrame, topic: str, job: str, args) -> None:
        """`change`, and messages about it, such that both happen or none.

        The messages are written to the outbox first, in the folder of a run named after the version to be
        made, so a repeated run takes its place. The commit notes the run, and runs that it notes are
        handed to the topic, if --send-to names its servers, now or by the next such job.
        """
        table = self.take_over(name)
        base, pending = table.last(), f"outbox/{topic}"
        run = f"{job}-{base.version + 1}"
        outgoing.select("value").write.mode("overwrite").text(self.path(f"{pending}/run={run}"))
        waiting = base.notes.get(pending, [])
        if args.send_to:
            waiting = [*waiting, run]
        table.change(keys, make, {pending: waiting})
        for number, run in enumerate(waiting, 1):
            rows = self.spark.read.text(self.path(f"{pending}/run={run}"))
            sinks.send(rows, args.send_format, **{"kafka.bootstrap.servers": args.send_to, "topic": topic, "path": self.path(f"sent/{topic}/run={run}")})
            table.note({pending: waiting[number:]})
        self.tidy(table)

    def replace(self, name: str, rows: DataFrame, **period) -> None:
        """Put rows in place of a period's directories, or of an unpartitioned table."""
        schema, by, _ = ddl.TABLES[name]
        rows = rows.select(*schema.names)
        if name in KEYED:
            table = self.take_over(name)
            table.replace_all(rows)
            return self.tidy(table)
        if not by:
            return sinks.overwrite(rows, self.path(name))
        inside = F.lit(True)
        for column, value in period.items():
            inside = inside & (F.col(column) == value)
        sort = [c for c in ("phone", "Phone") if c in schema.names]
        sinks.replace_slice(rows, self.path(name), list(by), inside, sort)

    def send(self, rows: DataFrame, name: str, run: str, args) -> None:
        """Messages of one run: to a topic, if --send-to names its servers, else to the run's own
        outbox folder, one JSON text per line. A repeated run replaces that folder."""
        if args.send_to:
            return sinks.send(rows.select("value"), **{"kafka.bootstrap.servers": args.send_to, "topic": name})
        rows.select("value").write.mode("overwrite").text(self.path(f"outbox/{name}/run={run}"))


def _run(name, args) -> str:
    return f"{name}-{args.as_of.astimezone(timezone.utc):%Y%m%dT%H%M%S}"


def month_of(tables, args):
    return pick(tables.read(MONTHLY), year=args.year, month=args.month)


# --- membership ---------------------------------------------------------------


def recalc_monthly(tables, args):
    state = points.recalc_monthly(
        tables.read(TRANSACTIONS, may_be_new=False), args.year, args.month, args.positive_only, month_of(tables, args)
    )
    tables.replace(MONTHLY, state, year=args.year, month=args.month)


def recalc_yearly(tables, args):
    target = pick(tables.read(YEARLY), year=args.year)
    state = points.recalc_yearly(tables.read(MONTHLY, may_be_new=False), args.year, target)
    tables.replace(YEARLY, state, year=args.year)


def recalc_all_time(tables, args):
    totals = stage(points.recalc_all_time(tables.read(YEARLY, may_be_new=False)), "totals")
    tables.change("profile", totals.select("Phone"), lambda rows: points.upsert_profiles(rows, totals, F.lit(args.as_of)))


def rank_monthly(tables, args):
    tables.replace(MONTHLY, ranking.rank_monthly(month_of(tables, args)), year=args.year, month=args.month)


def rank_yearly(tables, args):
    ranked = ranking.rank_yearly(pick(tables.read(YEARLY), year=args.year))
    tables.replace(YEARLY, ranked, year=args.year)


def rank_all_time(tables, args):
    changes = ranking.rank_all_time(tables.read("profile"))
    changes = stage(changes.select(F.col("id").alias("Id"), F.col("phone").alias("Phone"), F.col("new_rank").alias("Rank")), "ranks")
    touch = {"LastModified": F.lit(args.as_of), "LastModifiedBy": F.lit("ProfileRankUpdater")}
    ranks = changes.drop("Phone")
    tables.change("profile", changes, lambda rows: update_only(rows, ranks, ["Id"], update=["Rank"], touch=touch))


def assign_membership(tables, args):
    assigned = membership.assign_membership(month_of(tables, args), percentile_rules=args.percentiles)
    tables.replace(MONTHLY, assigned, year=args.year, month=args.month)


def sync_profiles(tables, args):
    monthly = tables.read(MONTHLY)
    members = pick(monthly, year=args.year, month=args.month).select(F.col("phone").alias("Phone"))
    sync = membership.sync_membership_to_profiles
    tables.change("profile", members, lambda rows: sync(rows, monthly, args.year, args.month, F.lit(args.as_of)))


def sync_yearly(tables, args):
    year_rows = pick(tables.read(YEARLY), year=args.year)
    state = membership.sync_membership_to_yearly(year_rows, tables.read(MONTHLY), args.year, args.month)
    tables.replace(YEARLY, state, year=args.year)


def update_levels(tables, args):
    since = levels.recent_window(args.as_of, args.minutes) if args.minutes else None
    changes = stage(levels.update_levels(tables.read("profile"), since), "levels")
    outgoing = messages.row_message(levels.level_transactions(changes, args.as_of))
    tables.change_and_tell(
        "profile", changes, lambda rows: levels.apply_levels(rows, changes, F.lit(args.as_of)), outgoing, "activity_transaction", "levels", args
    )


def roll_forward(tables, args):
    monthly = tables.read(MONTHLY)
    year, month = publish.next_period(args.year, args.month)
    state = publish.roll_forward(
        monthly, (args.year, args.month), (year, month), existing=pick(monthly, year=year, month=month)
    )
    tables.replace(MONTHLY, state, year=year, month=month)


def publish_documents(tables, args):
    documents = {
        "monthly": lambda: publish.publish_monthly(tables.read(MONTHLY), args.year, args.month),
        "yearly": lambda: publish.publish_yearly(tables.read(YEARLY), args.year),
        "profiles": lambda: publish.publish_profiles(tables.read("profile"), F.lit(args.as_of)),
    }[args.kind]()
    # One folder per period, so that publishing a month leaves the others.
    period = {"monthly": ("year", "month"), "yearly": ("year",), "profiles": ()}[args.kind]
    if any(getattr(args, p) is None for p in period):
        raise ValueError(f"{args.kind} documents need " + " and ".join(f"--{p}" for p in period))
    folder = sinks.partition_folder(tables.path(f"documents/{args.kind}"), [(p, getattr(args, p)) for p in period])
    documents.write.mode("overwrite").parquet(folder)
    if args.put:
        module, _, function = args.put.partition(":")
        sinks.publish(tables.spark.read.schema(documents.schema).parquet(folder), getattr(import_module(module), function))


# --- reports --------------------------------------------------------------------


def event_summary(tables, args):
    summary = reports.event_summary(tables.read(EVENTS, may_be_new=False), args.day)
    rows = reports.summary_rows(summary, F.lit(args.as_of))
    rows.write.mode("overwrite").parquet(sinks.partition_folder(tables.path("activity_summary_report"), [("day", args.day)]))


def rule_flow(tables, args):
    metrics = reports.rule_flow_metrics(tables.read(TRANSACTIONS, may_be_new=False), args.day, args.as_of)
    tables.replace("daily_rule_flow_metrics", metrics, date=args.day)


def driving_events(tables, args):
    events = reports.daily_driving_events(tables.read("daily_summary_report", may_be_new=False), tables.read("device_user", may_be_new=False), args.day)
    tables.send(reports.driving_messages(events), "activity_event", f"driving-{args.day}", args)


def verify_reports(tables, args):
    as_of = int(args.as_of.timestamp())
    due = tables.read("live_report", may_be_new=False).filter(reports.due_for_verification(as_of)).select("id")
    tables.change("live_report", due, lambda rows: reports.verify_live_reports(rows, as_of))


def release_reports(tables, args):
    released = reports.release_live_reports(tables.read("live_report", may_be_new=False), int(args.as_of.timestamp()))
    tables.send(released, "live_report", _run("release", args), args)


# --- maintenance ------------------------------------------------------------------


def _activity_table(args):
    return {"transaction": TRANSACTIONS, "event": EVENTS}[args.table]


def deduplicate(tables, args):
    """A month is rewritten in place. The whole table goes to a new folder that --to names, or,
    with --in-place, only the directories that hold repeated Ids are rewritten."""
    name = _activity_table(args)
    rows, by = tables.read(name), list(ddl.TABLES[name][1])
    if args.year is None and args.month is None and args.phone is None:
        if args.in_place:
            touched = maintenance.repeated_in(rows, by)
            return sinks.rewrite_directories(rows, tables.path(name), by, touched, maintenance.deduplicate, ["Phone"])
        if not args.to:
            raise ValueError("a whole-table run needs --in-place or --to, the folder of the new version")
        return sinks.write_version(maintenance.deduplicate(rows), args.to, by, ["Phone"])
    month = pick(rows, Year=args.year, Month=args.month)
    kept = maintenance.deduplicate(month, args.year, args.month, args.phone)
    tables.replace(name, kept, Year=args.year, Month=args.month)


def analyze(tables, args):
    rows = pick(tables.read(_activity_table(args)), Year=args.year, Month=args.month)
    for name, report in (
        ("summary", maintenance.duplicate_summary(rows)),
        ("distribution", maintenance.duplicate_distribution(rows)),
        ("most_duplicated", maintenance.most_duplicated(rows)),
    ):
        report.write.mode("overwrite").parquet(tables.path(f"duplicates/{args.table}/{name}"))
        report.show(truncate=False)


def sync_missing(tables, args):
    """Append rows that the copy lacks to it (lower-case columns, by year and month). What the
    stream has put into its keyed copy is not missing."""
    copy = tables.path("activity_transaction_copy")
    schema = layout(
        ", ".join(f"{f.name.lower()} {f.dataType.simpleString()}" for f in ddl.TABLES[TRANSACTIONS][0])
        + ", processed_timestamp timestamp"
    )
    streamed = ingest.stored_copy(tables.spark, tables.path("transactions"), ddl.TABLES[TRANSACTIONS][0])
    target = read_or_empty(tables.spark, copy, schema).unionByName(streamed, allowMissingColumns=True)
    missing = maintenance.sync_missing(tables.read(TRANSACTIONS, may_be_new=False), target, args.year, args.month, F.lit(args.as_of))
    sinks.append(missing, copy, ["year", "month"], ["phone"])


def delete_period(tables, args):
    schema = ddl.TABLES[TRANSACTIONS][0]
    period = {"Year": args.year, "Month": args.month}
    sinks.delete_slice(tables.spark, tables.path(TRANSACTIONS), schema, period, args.dry_run).show()


def query(tables, args):
    """The newest transactions of a member or period. A phone alone is looked up through the filters that
    the job `index` has made, if there are any."""
    if args.phone and args.year is None and args.month is None:
        schema, by, _ = ddl.TABLES[TRANSACTIONS]
        rows = sinks.rows_with(tables.spark, tables.path(TRANSACTIONS), schema, list(by), "Phone", args.phone)
    else:
        rows = tables.read(TRANSACTIONS, may_be_new=False)
    maintenance.query_transactions(rows, args.phone, args.year, args.month).show(truncate=False)


def index(tables, args):
    """Make Bloom filters of a column for a stored table; every later append keeps them."""
    name = _activity_table(args)
    if args.column in id_filters.filtered_columns(tables.spark, tables.path(name)):
        raise ValueError(f"{name} has filters of {args.column}")
    id_filters.add_filters(tables.read(name, may_be_new=False), tables.path(name), args.column, list(ddl.TABLES[name][1]))


def create_tables(tables, args):
    created = ddl.create_tables(tables.spark, args.database, tables.root, args.drop)
    created.show(created.count(), truncate=False)


# --- streams ------------------------------------------------------------------------


def _messages(tables, args):
    if args.servers:
        return read_topic(
            tables.spark, args.servers, args.topic, args.start, args.per_trigger, failOnDataLoss=str(not args.may_lose).lower()
        )
    return read_files(tables.spark, args.files, MESSAGE, args.format)


def _stream(start):
    def job(tables, args):
        start(tables, args, _messages(tables, args)).awaitTermination()

    return job


def _events(tables, args, stream):
    return ingest.ingest_events(
        stream, tables.path("events"), args.checkpoint, args.policy, args.every, id_scope=args.id_scope, table=tables.path(EVENTS)
    )


def _transactions(tables, args, stream):
    return ingest.ingest_transactions(
        stream, tables.path("transactions"), args.checkpoint, args.policy, args.every, id_scope=args.id_scope, table=tables.path(TRANSACTIONS)
    )


def _points(tables, args, stream):
    root = tables.path(f"points_{args.period}")
    return stream_points.stream_points(stream, root, args.checkpoint, args.period, args.every)


APPLIED = layout("version bigint, state string, done bigint")


def _applied(tables, period):
    """The last ledger version that fold-points began to apply, and whether that is done."""
    found = read_or_empty(tables.spark, tables.path(f"points_{period}/applied"), APPLIED)
    last = found.groupBy("version", "state").agg(F.max("done").alias("done")).orderBy(F.desc("version")).first()
    table = tables.versioned("profile")
    noted = table.last().notes.get(f"points_{period}", -1) if period == "all" and table.exists() else -1
    return {"version": noted, "state": None, "done": 1} if noted > (last["version"] if last else -1) else last


def fold_points(tables, args):
    """Add to the member tables what stream-points recorded since the last time.

    The ledger is compacted to a new version; what it holds more than the version applied
    last goes to the tables. Profiles are changed in one commit, which notes the version, and only
    in the buckets of members with new points. For the tables by period the new state is written beside
    them together with a note of the version first, so a run that broke off is finished by the
    next one. Nothing is added twice.
    """
    if args.period == "every":
        raise ValueError("fold-points takes one period")
    spark, root = tables.spark, tables.path(f"points_{args.period}")
    name = {"month": MONTHLY, "year": YEARLY, "all": "profile"}[args.period]
    schema, by, _ = ddl.TABLES[name]

    def put(version, state, done):
        spark.createDataFrame([(version, state, done)], APPLIED).coalesce(1).write.mode("append").parquet(f"{root}/applied")

    def swap(version, state):
        if not by:
            return tables.take_over(name).replace_all(spark.read.schema(schema).parquet(state), {"points_all": version})
        rows = sinks.laid_out(spark.read.schema(schema).parquet(state), list(by), ["phone"])
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(tables.path(name))
        put(version, state, 1)
        ledger.drop_numbered(spark, f"{root}/states", version)

    last = _applied(tables, args.period)
    if last and not last["done"]:
        swap(last["version"], last["state"])
    before = last["version"] if last else -1
    version = stream_points.compact_points(spark, root, args.period, max(before, 0))
    if version <= before:
        return
    added = stream_points.points_between(spark, root, args.period, before, version)
    if args.period == "all":
        added = stage(added, "added")
        phones = added.select(F.col("phone").alias("Phone"))
        note = {"points_all": version}
        return tables.change(name, phones, lambda rows: points.increment_profiles(rows, added, F.lit(args.as_of)), note)
    periods = stream_points.PERIODS[args.period]
    touched = stage(added.select(*periods).distinct(), "touched")
    state = points.increment_members(tables.read(name).join(touched, periods, "left_semi"), added, ["phone", *periods])
    path = f"{root}/states/version={version}"
    state.select(*schema.names).write.mode("overwrite").parquet(path)
    put(version, path, 0)
    swap(version, path)


def compact(tables, args):
    """Fold the ledgers of the streams into snapshots; run it now and then."""
    for period in stream_points.PERIODS:
        if args.period in (period, "every"):
            last = _applied(tables, period)
            stream_points.compact_points(tables.spark, tables.path(f"points_{period}"), period, last["version"] if last else None)
    ingest.compact_copy(tables.spark, tables.path("transactions"), ddl.TABLES[TRANSACTIONS][0])


def _users(tables, args, stream):
    return users.register_users(stream, tables.path(MONTHLY), tables.path(YEARLY), args.checkpoint, every=args.every)


# --- command line ---------------------------------------------------------------------


def _moment(text):
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


OPTIONS = {
    "year": {"type": int},
    "month": {"type": int},
    "day": {"type": date.fromisoformat},
    "phone": {},
    "to": {},
    "in-place": {"action": "store_true"},
    "minutes": {"type": int, "default": 0},
    "positive-only": {"action": "store_true"},
    "percentiles": {"action": "store_true"},
    "dry-run": {"action": "store_true"},
    "drop": {"action": "store_true"},
    "database": {"default": "activity"},
    "table": {"choices": ["transaction", "event"], "default": "transaction"},
    "put": {"default": "", "help": "module:function that writes (doc_id, doc) rows to the serving store, a list at a time"},
    "column": {"choices": ["Id", "Phone"], "default": "Phone"},
    "kind": {"choices": ["monthly", "yearly", "profiles"]},
    "servers": {"default": ""},
    "topic": {"default": ""},
    "start": {"default": "latest"},
    "files": {"default": ""},
    "format": {"default": "parquet"},
    "checkpoint": {},
    "every": {"default": None},
    "policy": {"choices": ["drop", "fill"], "default": "drop"},
    "period": {"choices": [*stream_points.PERIODS, "every"], "default": "month"},
    "id-scope": {"nargs": "*", "default": None},
    "per-trigger": {"type": int, "default": 1_000_000, "help": "messages in a batch at most"},
    "may-lose": {"action": "store_true", "help": "go on when the topic has dropped unread messages"},
    "send-to": {"default": "", "help": "servers of the topics that messages go to"},
    "send-format": {"default": "kafka", "help": "data source that messages are written with"},
}
_PERIOD = ["year!", "month!"]
_SOURCE = ["servers", "topic", "start", "files", "format", "checkpoint!", "every", "per-trigger", "may-lose"]

# job: function and its options; "!" marks required ones.
JOBS = {
    "create-tables": (create_tables, ["database", "drop"]),
    "recalc-monthly": (recalc_monthly, [*_PERIOD, "positive-only"]),
    "recalc-yearly": (recalc_yearly, ["year!"]),
    "recalc-all-time": (recalc_all_time, []),
    "rank-monthly": (rank_monthly, _PERIOD),
    "rank-yearly": (rank_yearly, ["year!"]),
    "rank-all-time": (rank_all_time, []),
    "assign-membership": (assign_membership, [*_PERIOD, "percentiles"]),
    "sync-profiles": (sync_profiles, _PERIOD),
    "sync-yearly": (sync_yearly, _PERIOD),
    "update-levels": (update_levels, ["minutes", "send-to", "send-format"]),
    "roll-forward": (roll_forward, _PERIOD),
    "publish": (publish_documents, ["kind!", "year", "month", "put"]),
    "event-summary": (event_summary, ["day!"]),
    "rule-flow": (rule_flow, ["day!"]),
    "driving-events": (driving_events, ["day!", "send-to"]),
    "verify-reports": (verify_reports, []),
    "release-reports": (release_reports, ["send-to"]),
    "deduplicate": (deduplicate, ["table", "year", "month", "phone", "to", "in-place"]),
    "analyze": (analyze, ["table", "year", "month"]),
    "sync-missing": (sync_missing, ["year", "month"]),
    "delete-period": (delete_period, [*_PERIOD, "dry-run"]),
    "query": (query, ["phone", "year", "month"]),
    "index": (index, ["table", "column"]),
    "store-events": (_stream(_events), [*_SOURCE, "policy", "id-scope"]),
    "store-transactions": (_stream(_transactions), [*_SOURCE, "policy", "id-scope"]),
    "stream-points": (_stream(_points), [*_SOURCE, "period"]),
    "fold-points": (fold_points, ["period"]),
    "compact": (compact, ["period"]),
    "register-users": (_stream(_users), _SOURCE),
}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="milepost")
    root.add_argument("--root", required=True, help="folder of the tables")
    root.add_argument("--as-of", type=_moment, default=datetime.now(timezone.utc), help="point in time of the run")
    jobs = root.add_subparsers(dest="job", required=True)
    for name, (_, options) in JOBS.items():
        job = jobs.add_parser(name)
        for option in options:
            plain = option.rstrip("!")
            extra = {"required": True} if option.endswith("!") else {}
            job.add_argument(f"--{plain}", **OPTIONS[plain], **extra)
    return root


def run(spark: SparkSession, arguments: list[str]) -> None:
    """One job. What it staged in the shared folder is deleted at its end, also after an error."""
    args = parser().parse_args(arguments)
    try:
        JOBS[args.job][0](Tables(spark, args.root), args)
    finally:
        clear_staged(spark)


if __name__ == "__main__":
    import sys

    run(build_session("milepost"), sys.argv[1:])
