"""Streams over several batches, restarts and replays."""

import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import DataFrameWriter, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from catalog import queries, sample
from milepost.operators import documents, id_filters, ledger, sinks
from milepost.operators.keyed import keep_latest
from milepost.plans import points
from milepost.schemas import ACTIVITY_EVENT, ACTIVITY_TRANSACTION, MEMBERSHIP_MONTHLY, MEMBERSHIP_YEARLY, PROFILE, layout
from milepost.session import list_folder
from milepost.sources.streams import read_files
from milepost.streaming import ingest, users
from milepost.streaming import points as stream_points

AS_OF = datetime(2024, 1, 31, 18, tzinfo=timezone.utc)  # 1 February in the business zone


class Topic:
    """Files as message batches: one file, one micro-batch, in the order written."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, path, 0
        path.mkdir()

    def send(self, *messages):
        texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        file = self.path / f"{self.sent:04d}.json"
        file.write_text("\n".join(json.dumps({"value": t}) for t in texts))
        self.sent += 1
        stamp = 1_700_000_000 + self.sent
        import os

        os.utime(file, (stamp, stamp))

    def stream(self):
        return read_files(self.spark, str(self.path), layout("value string"), "json", per_trigger=1)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "root")


@pytest.fixture
def checkpoint(tmp_path):
    return str(tmp_path / "checkpoint")


def rows(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def event(i, **values):
    base = {"Id": i, "Phone": "1", "Date": 1, "Month": 1, "Year": 2024, "TimeStamp": 1, "MembershipCode": "Level1", "Event": "E", "ReportCode": "R"}
    return {**base, **values}


def transaction(i, **values):
    base = {"Id": i, "Phone": "1", "Date": 1, "Month": 1, "Year": 2024, "TimeStamp": 1, "MembershipCode": "Level1", "EventCode": "E", "Name": "AddPoint", "Value": 1}
    return {**base, **values}


def test_events_are_stored_once(spark, topic, root, checkpoint):
    topic.send([event("a", TimeStamp=1), event("a", TimeStamp=2)], event("b"), "junk", "[]")
    topic.send([event("a", TimeStamp=9), event("c", Data="x")], *[event(f"n{c}", **{c: None}) for c in ingest.EVENT_REQUIRED])
    ingest.ingest_events(topic.stream(), root, checkpoint).awaitTermination()
    stored = ingest.stored_rows(spark, root, ACTIVITY_EVENT)
    assert rows(stored, "Id", "TimeStamp", "Data") == [("a", 2, "{}"), ("b", 1, "{}"), ("c", 1, "x")]
    topic.send([event("b"), event("d")])
    ingest.ingest_events(topic.stream(), root, checkpoint).awaitTermination()
    assert rows(ingest.stored_rows(spark, root, ACTIVITY_EVENT), "Id") == [("a",), ("b",), ("c",), ("d",)]


def test_events_with_defaults(spark, topic, root, checkpoint):
    topic.send([event("a"), {"Id": "b", "Year": 2024, "Month": 1, "Date": 1}])
    topic.send([event("a", Event="newer"), event("a", Event="other month", Month=2)])
    ingest.ingest_events(topic.stream(), root, checkpoint, "fill").awaitTermination()
    documents = ingest.stored_documents(spark, root, ACTIVITY_EVENT)
    assert rows(documents, "Id", "Month", "Event", "Phone", "MembershipCode", "ReportCode", "Data") == [
        ("a", 1, "newer", "1", "Level1", "R", "{}"),
        ("a", 2, "other month", "1", "Level1", "R", "{}"),
        ("b", 1, "Other", "unknown", "Unknown", "Unknown", "{}"),
    ]
    assert ingest.logged_rows(spark, root, ACTIVITY_EVENT).count() == 4
    february = documents.filter("Year = 2024 and Month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "Month" in february.split("PartitionFilters: [")[1].split("]")[0]


def test_transactions_have_one_activity_id_in_all_sinks(spark, topic, root, checkpoint):
    topic.send([transaction("a"), transaction("b", ActivityId="given"), transaction("n", EventCode=None)])
    topic.send([transaction("a", Value=7)])
    ingest.ingest_transactions(topic.stream(), root, checkpoint, id_scope=["Year", "Month", "Date"]).awaitTermination()
    stored = rows(ingest.stored_rows(spark, root, ACTIVITY_TRANSACTION), "Id", "ActivityId", "Value")
    copy = rows(ingest.stored_copy(spark, root, ACTIVITY_TRANSACTION), "id", "activityid", "value")
    assert [r[0] for r in stored] == ["a", "b"] and stored[1][1] == "given" and len(stored[0][1]) == 36
    assert copy == [("a", stored[0][1], 7), stored[1]]  # the copy takes the newest version
    assert ingest.compact_copy(spark, root, ACTIVITY_TRANSACTION) == 0
    assert rows(ingest.stored_copy(spark, root, ACTIVITY_TRANSACTION), "id", "activityid", "value") == copy


def test_transactions_with_defaults(spark, topic, root, checkpoint):
    topic.send([transaction("a", MembershipCode=None, EventCode=None, Type="Realtime")])
    ingest.ingest_transactions(topic.stream(), root, checkpoint, "fill").awaitTermination()
    documents = ingest.stored_documents(spark, root, ACTIVITY_TRANSACTION)
    assert rows(documents, "Id", "MembershipCode", "EventCode", "Type") == [("a", "Level1", "Other", "Other")]


def random_transactions(n, seed=3):
    rng = random.Random(seed)
    return [
        transaction(
            str(i), Phone=rng.choice("1112345"), Month=rng.choice([1, 2]), Value=rng.choice([None, 0, 3, 8]),
            Name=rng.choice(["AddPoint", "AddPoint", "Notify", None]), TimeStamp=i, MembershipCode=rng.choice(["Level1", "Level2", None]),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("period", ["month", "year", "all"])
@pytest.mark.parametrize("batches", [1, 4])
def test_streamed_points_equal_the_recalculation(spark, topic, root, checkpoint, period, batches):
    given = random_transactions(60)
    for b in range(batches):
        topic.send(given[b::batches])
    stream_points.stream_points(topic.stream(), root, checkpoint, period).awaitTermination()
    keys = ["phone", *stream_points.PERIODS[period]]
    table = spark.createDataFrame([[g.get(n) for n in ACTIVITY_TRANSACTION.names] for g in given], ACTIVITY_TRANSACTION)
    expected = points.scoring(table).groupBy(*keys).agg(F.sum(F.coalesce("Value", F.lit(0))).alias("points"))
    got = stream_points.streamed_points(spark, root, period)
    assert rows(got, *keys, "points") == rows(expected, *keys, "points")


def test_replaying_a_batch_changes_nothing(spark, root):
    delta = spark.createDataFrame([("1", 1, 2024, 5, 10, "Level1")], layout("phone string, month int, year int, points bigint, timestamp bigint, membershipcode string"))
    ledger.record(delta, root, 0)
    ledger.record(delta, root, 1)
    before = rows(stream_points.streamed_points(spark, root))
    ledger.record(delta, root, 1)
    assert rows(stream_points.streamed_points(spark, root)) == before == [("1", 1, 2024, 10, 10, "Level1")]


def test_compaction_keeps_the_totals(spark, root):
    text = "phone string, month int, year int, points bigint, timestamp bigint, membershipcode string"

    def record(batch, *given):
        ledger.record(spark.createDataFrame(list(given), layout(text)), root, batch)

    assert stream_points.compact_points(spark, root) == -1
    record(0, ("1", 1, 2024, 5, 50, "Level2"))
    record(1, ("1", 1, 2024, 1, 10, "Level1"), ("2", 1, 2024, 9, 9, "Level1"))
    before = rows(stream_points.streamed_points(spark, root))
    assert stream_points.compact_points(spark, root) == 0
    assert rows(stream_points.streamed_points(spark, root)) == before
    # Tier from the first batch, timestamp from the last.
    assert before[0] == ("1", 1, 2024, 6, 10, "Level2")
    record(2, ("1", 1, 2024, 4, 70, "Level5"))
    assert rows(stream_points.streamed_points(spark, root))[0] == ("1", 1, 2024, 10, 70, "Level2")
    assert stream_points.compact_points(spark, root) == 1
    assert stream_points.compact_points(spark, root) == 1
    assert list_folder(spark, f"{root}/batches/stream=one") == ["batch=2"]
    assert sorted(list_folder(spark, f"{root}/snapshots")) == ["version=0", "version=1"]
    assert rows(stream_points.streamed_points(spark, root))[0] == ("1", 1, 2024, 10, 70, "Level2")
    assert rows(stream_points.points_between(spark, root, "month", 0, 1)) == [("1", 1, 2024, 4, 70, "Level2")]


def test_a_new_checkpoint_adds(spark, root):
    """5 points, 7 by another checkpoint, a compaction, 100 by a third; then a replay."""
    text = "phone string, month int, year int, points bigint, timestamp bigint, membershipcode string"

    def total(stream, batch, points):
        ledger.record(spark.createDataFrame([("1", 1, 2024, points, 1, "Level1")], layout(text)), root, batch, stream=stream)
        return stream_points.streamed_points(spark, root).first()["points"]

    assert (total("a", 0, 5), total("b", 0, 7)) == (5, 12)
    stream_points.compact_points(spark, root)
    assert total("c", 0, 100) == 112
    assert total("c", 0, 100) == 112
    stream_points.compact_points(spark, root)
    assert total("a", 1, 1) == 113


def test_member_table_grows_from_its_base(spark, topic, root, checkpoint):
    topic.send([transaction("a", Value=5), transaction("b", Phone="2", Value=3, MembershipCode="Level2")])
    stream_points.stream_points(topic.stream(), root, checkpoint, "month").awaitTermination()
    base = spark.createDataFrame([("1", "Level4", "x", 1, 2024, 12, 100, 0)], MEMBERSHIP_MONTHLY)
    assert rows(stream_points.current_members(spark, root, "month", base)) == [
        ("1", "Level4", "x", 1, 2024, 12, 105, 1), ("2", "Level2", "Nhập môn", 1, 2024, 9999, 3, 1),
    ]
    assert stream_points.current_members(spark, root, "month").count() == 2


def test_profiles_follow_the_stream(spark, topic, root, checkpoint):
    topic.send([transaction("a", Value=5), transaction("b", Phone="unknown", Value=3)])
    stream_points.stream_points(topic.stream(), root, checkpoint, "all").awaitTermination()
    profiles = spark.createDataFrame([("p", "1", 1, 10, 1, None, "Level1")], PROFILE)
    got = stream_points.current_profiles(spark, root, profiles, F.lit(AS_OF))
    assert rows(got, "Id", "TotalPoints") == [("p", 15)]


def test_new_users_get_one_row_per_period(spark, topic, tmp_path, checkpoint):
    def user(phone):
        return {"Event": "CreateUser", "Datas": json.dumps([{"User": {"Phone": phone}}])}

    monthly, yearly = str(tmp_path / "monthly"), str(tmp_path / "yearly")
    topic.send(user("1"), user("1"), user(""), {"Event": "Login", "Datas": "[]"}, "junk", {"Event": "CreateUser", "Datas": "junk"})
    topic.send(user("1"), user("2"))
    for _ in range(2):  # the second run finds nothing new
        users.register_users(topic.stream(), monthly, yearly, checkpoint, AS_OF).awaitTermination()
    got = spark.read.schema(MEMBERSHIP_MONTHLY).parquet(monthly)
    assert rows(got, "phone", "month", "year", "rank", "totalpoints", "membershipcode") == [
        ("1", 2, 2024, 9999, 0, "Level1"), ("2", 2, 2024, 9999, 0, "Level1"),
    ]
    assert spark.read.schema(MEMBERSHIP_YEARLY).parquet(yearly).count() == 2


def test_repeats_are_dropped_by_state(spark, topic, tmp_path, checkpoint):
    topic.send([transaction("a", TimeStamp=1000), transaction("a", TimeStamp=1000)])
    topic.send([transaction("a", TimeStamp=2000), transaction("b", TimeStamp=2000)])
    out = str(tmp_path / "out")
    once = ingest.drop_repeats(ingest.clean_transactions(topic.stream()), "1 hour").select("Id")
    once.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, "parquet").awaitTermination()
    assert rows(spark.read.parquet(out)) == [("a",), ("b",)]


def test_continuous_trigger_and_stop(spark, topic, root, checkpoint):
    topic.send([event("a")])
    query = ingest.ingest_events(topic.stream(), root, checkpoint, every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(ingest.stored_rows(spark, root, ACTIVITY_EVENT), "Id") == [("a",)]


def _plans_of(spark, run):
    """Text of the plans that run while `run` does."""
    seen, plain = [], DataFrameWriter.parquet

    def noted(writer, path, *args, **kwargs):
        seen.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
        return plain(writer, path, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", noted)
        run()
    return seen


def test_messages_are_made_without_a_shuffle(spark):
    given = spark.createDataFrame([[transaction("a").get(n) for n in ACTIVITY_TRANSACTION.names]], ACTIVITY_TRANSACTION)
    assert "Repartition" not in sample.as_messages(given)._jdf.queryExecution().optimizedPlan().toString()


def test_a_batch_of_documents_is_dealt_once(spark, tmp_path):
    given = [transaction("a", TimeStamp=1), transaction("a", TimeStamp=2), transaction("b", Month=2)]
    batch = spark.createDataFrame([[g.get(n) for n in ACTIVITY_TRANSACTION.names] for g in given], ACTIVITY_TRANSACTION)
    store = ingest.documents(spark, str(tmp_path), ACTIVITY_TRANSACTION)
    texts = _plans_of(spark, lambda: store.put(batch, 0))
    assert [t.count("RepartitionByExpression") for t in texts] == [1] and "RebalancePartitions" not in texts[0]
    assert rows(store.read(), "Id", "TimeStamp") == [("a", 2), ("b", 1)]
    assert "Window" not in store.read()._jdf.queryExecution().optimizedPlan().toString()  # one run a month


def test_large_periods_are_dealt_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "PART_ROWS", 10)
    monkeypatch.setattr(documents, "HOT_ROWS", 5)
    given = [transaction(f"i{i % 40}", TimeStamp=i, Month=None if i % 7 == 0 else 1) for i in range(100)] + [transaction("hot", TimeStamp=i) for i in range(50)]
    batch = spark.createDataFrame([[g.get(n) for n in ACTIVITY_TRANSACTION.names] for g in given], ACTIVITY_TRANSACTION)
    store = documents.DocumentStore(spark, str(tmp_path / "d"), ACTIVITY_TRANSACTION, ["Id"], ["Year", "Month"], fan=2, levels=2)
    for number in range(5):
        store.put(batch.filter(F.col("TimeStamp") % 5 <= number), number)
    expected = keep_latest(batch, ["Id", "Year", "Month"])
    assert rows(store.read(), "Id", "Month", "TimeStamp") == rows(expected, "Id", "Month", "TimeStamp")


def test_directories_of_a_large_batch(spark, tmp_path, monkeypatch):
    ids = lambda names, month: spark.createDataFrame([(n, month) for n in names], "Id string, Month int")
    for month in range(1, 6):
        id_filters.add_filters(ids([f"m{month}-{i}" for i in range(30)], month), str(tmp_path), "Id", ["Month"])
    wanted = ids([f"m{m}-{i}" for m in (1, 2, 4) for i in range(30)], 1)
    asked, plain = [], id_filters._meeting

    def noted(filters, keys, sizes, by):
        asked.append((filters.count(), keys.count()))
        return plain(filters, keys, sizes, by)

    monkeypatch.setattr(id_filters, "FIRST_KEYS", 20)
    monkeypatch.setattr(id_filters, "_meeting", noted)
    found = id_filters.directories_with(wanted, str(tmp_path), layout("Id string, Month int"), "Id", ["Month"])
    assert sorted(found) == [(1,), (2,), (4,)] and asked[0][1] < 90 and asked[1][0] < 5


@pytest.fixture
def writes(monkeypatch):
    """Path and plan of everything that is written."""
    found, plain = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        found.append((path, self._df._jdf.queryExecution().executedPlan().toString()))
        return plain(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return found


BY_MONTH = ["Year", "Month"]


def test_new_rows_of_the_table_come_from_the_copy_without_a_shuffle(spark, topic, root, checkpoint, writes):
    topic.send([transaction(None), transaction("a"), transaction("a", TimeStamp=5, Month=2), transaction("b")])
    topic.send([transaction(None, Value=7), transaction("a", TimeStamp=6), transaction("c", Month=3)])
    ingest.ingest_transactions(topic.stream(), root, checkpoint, by=BY_MONTH).awaitTermination()
    plans = [plan for path, plan in writes if path == f"{root}/table"]
    assert len(plans) == 2 and not [p for p in plans if "Exchange hash" in p or "InMemoryTableScan" in p or "REBALANCE" in p]
    assert sum(f"{root}/copy" in path and "REBALANCE" in plan for path, plan in writes) == 2
    stored = ingest.stored_rows(spark, root, ACTIVITY_TRANSACTION)
    # A missing Id is always new. "a" comes again under another month, where it is not looked for.
    assert rows(stored, "Id", "Month", "Value") == rows(spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("c", 3, 1), (None, 1, 1), (None, 1, 7)], "Id string, Month int, Value int"))
    assert not [name for path, _ in writes if "/newest-" in path for name in list_folder(spark, path)]


@pytest.mark.parametrize("most", [0, 1, 1 << 20])
def test_rows_absent_finds_the_same_however_many_are_stored(spark, monkeypatch, most):
    monkeypatch.setattr(sinks, "BROADCAST_BYTES", most)
    given = spark.createDataFrame([("a", 1), ("b", 1), (None, 2)], "Id string, Month int")
    absent = lambda *ids: rows(sinks.rows_absent(given, spark.createDataFrame([(i,) for i in ids], "_Id string"), "Id", ["Month"]))
    assert absent("a", "x") == [("b", 1), (None, 2)]
    assert absent("a", "b") == [(None, 2)]
    assert rows(sinks.rows_absent(given, None, "Id", ["Month"])) == rows(given)


def test_a_copy_is_compacted_some_months_at_a_time(spark, topic, root, checkpoint, monkeypatch, writes):
    months = (1, 2, 3, None)
    topic.send([transaction(f"{m}-{i}", Month=m) for m in months for i in range(4)])
    topic.send([transaction(f"{m}-{i}", Month=m, Value=9, TimeStamp=2) for m in months for i in range(2)])
    ingest.ingest_transactions(topic.stream(), root, checkpoint, by=BY_MONTH).awaitTermination()
    before = rows(ingest.stored_copy(spark, root, ACTIVITY_TRANSACTION))
    assert len(before) == 16 and sum(r[16] == 9 for r in before) == 8
    monkeypatch.setattr(sinks, "PORTION_ROWS", 12)
    assert ingest.compact_copy(spark, root, ACTIVITY_TRANSACTION) == 0
    assert sum("/snapshots/version=0" in path for path, _ in writes) == 2
    copy = ingest.stored_copy(spark, root, ACTIVITY_TRANSACTION)
    assert rows(copy) == before
    assert "Window" not in copy._jdf.queryExecution().executedPlan().toString()  # a snapshot holds each key once
    topic.send([transaction("1-0", Value=11, TimeStamp=3)])
    ingest.ingest_transactions(topic.stream(), root, checkpoint, by=BY_MONTH).awaitTermination()
    assert len(changed := rows(ingest.stored_copy(spark, root, ACTIVITY_TRANSACTION))) == 16 and changed != before


def test_documents_are_merged_some_periods_at_a_time(spark, root, monkeypatch, writes):
    store = documents.DocumentStore(spark, root, layout("Id string, Year int, Month int, TimeStamp bigint"), ["Id"], BY_MONTH, fan=2)
    batch = lambda n: spark.createDataFrame([(str(i), 2024, m, n) for i in range(3) for m in (1, 2, None)], store.schema)
    store.put(batch(1), 0)
    monkeypatch.setattr(sinks, "PORTION_ROWS", 6)
    del writes[:]
    store.put(batch(2), 1)
    assert len(writes) == 4 and max(store.runs().values()) == 1  # the batch, and three periods merged by themselves
    assert rows(store.read()) == rows(batch(2))


def test_the_log_is_read_back_for_the_documents(spark, topic, root, checkpoint, writes):
    topic.send([transaction("a"), transaction("a", TimeStamp=3, Month=2), transaction("b", Month=None)])
    topic.send("junk")
    ingest.ingest_transactions(topic.stream(), root, checkpoint, "fill", by=BY_MONTH).awaitTermination()
    assert writes and not [p for _, p in writes if "InMemoryTableScan" in p]
    assert rows(ingest.logged_rows(spark, root, ACTIVITY_TRANSACTION), "Id", "Month") == [("a", 1), ("a", 2), ("b", None)]
    [stream] = [n for n in list_folder(spark, f"{root}/log/batches") if n.startswith("stream=")]
    assert list_folder(spark, f"{root}/log/batches/{stream}") == ["batch=0"]


def test_ids_stay_where_they_are_while_filters_are_made(spark):
    given = spark.createDataFrame([("a", 1), ("b", 1), ("c", None), (None, 2)], "Id string, Month int")
    plan = id_filters.filter_rows(given, "Id", ["Month"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_messages_that_are_stored_leave_the_inbox(spark, monkeypatch):
    inboxes, make = [], queries.new_folder
    monkeypatch.setattr(queries, "new_folder", lambda spark, label: (inboxes.append(make(spark, label)), inboxes[-1])[1])
    thirds = spark.createDataFrame([(transaction("a"), 0), (transaction("b"), 1)], StructType([StructField("row", ACTIVITY_TRANSACTION), StructField("_third", IntegerType())])).select("row.*", "_third")
    seen = []

    def run(messages, checkpoint):
        def handle(batch, batch_id):
            seen.append(batch.count())

        return messages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()

    queries._in_batches(spark, thirds, (0, 1, 0), run)
    assert seen == [1, 1, 1]
    assert list_folder(spark, next(f for f in inboxes if "/inbox-" in f)) == []
