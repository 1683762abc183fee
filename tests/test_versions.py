"""Tables that change in part, and what is built on them."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from catalog import sample
from milepost import jobs
from milepost.operators import sinks
from milepost.operators.documents import DocumentStore
from milepost.operators.versions import Commit, Conflict, VersionedTable
from milepost.plans import ranking
from milepost.plans.standing import Standing
from milepost.schemas import LIVE_REPORT, PROFILE_TABLE, layout
from tests.test_plans import rows

FOLDER = "/root/testdata/sf0.001"
ROWS = layout("id string, v int")


def frame(spark, values, schema=ROWS):
    return spark.createDataFrame(values, schema)


def files(path):
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_change_leaves_the_files_of_other_buckets(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ROWS, key="id")
    assert not table.exists() and table.read().collect() == []
    table.replace_all(frame(spark, [(str(i), i) for i in range(200)] + [(None, 7), (None, 8)]))
    before = files(tmp_path)
    keys = frame(spark, [("3", 0), ("77", 0), (None, 0)])
    table.change(keys, lambda r: r.withColumn("v", F.when(F.col("id").isin("3", "77") | F.col("id").isNull(), -1).otherwise(F.col("v"))))
    assert rows(table.read()) == rows(frame(spark, [(str(i), -1 if i in (3, 77) else i) for i in range(200)] + [(None, -1)] * 2))
    assert all(files(tmp_path)[f] == t for f, t in before.items())  # old files are never written again
    touched = {str(f).split("/")[-2] for f in files(tmp_path).keys() - before.keys()}
    assert len(touched) == len(table.slots_of(keys)) <= 3
    assert rows(table.read(commit=table.at(0))) == rows(frame(spark, [(str(i), i) for i in range(200)] + [(None, 7), (None, 8)]))
    assert table.change(frame(spark, []), lambda r: r).version == 1  # nothing to do, no version


def test_a_write_that_breaks_off_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), ROWS, key="id")
    table.replace_all(frame(spark, [("a", 1), ("b", 2)]))
    monkeypatch.setattr(VersionedTable, "_put", lambda self, commit: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.change(frame(spark, [("a", 0)]), lambda r: r.withColumn("v", F.lit(9)))
    monkeypatch.undo()
    assert rows(table.read()) == rows(frame(spark, [("a", 1), ("b", 2)]))
    assert table.last().version == 0
    table.clean(keep=1, abandoned_hours=0)  # the write without a commit goes
    assert rows(table.read()) == rows(frame(spark, [("a", 1), ("b", 2)]))
    assert len(list((tmp_path / "t").glob("_write=*"))) == 1


def test_writers_of_the_same_slot_conflict_and_others_do_not(spark, tmp_path):
    schema = layout("year int, v int")
    table = VersionedTable(spark, str(tmp_path / "t"), schema, by=["year"])
    table.replace_all(frame(spark, [(2023, 1), (2024, 2), (None, 3)], schema))
    base = table.last()
    table.replace(frame(spark, [(2023, 10)], schema), ["year=2023"], base)
    table.replace(frame(spark, [(2024, 20)], schema), ["year=2024"], base)  # on top of the other change
    assert rows(table.read()) == rows(frame(spark, [(2023, 10), (2024, 20), (None, 3)], schema))
    with pytest.raises(Conflict):
        table.replace(frame(spark, [(2023, 11)], schema), ["year=2023"], base)
    with pytest.raises(ValueError):
        table.replace(frame(spark, [(2025, 11)], schema), ["year=2023"])
    table.replace(frame(spark, [], schema), ["year=2023"])
    assert rows(table.read()) == rows(frame(spark, [(2024, 20), (None, 3)], schema))
    assert rows(table.read(["year=2024"])) == [(2024, 20)]
    assert not table._put(Commit(0))  # a number is given once
    table.append(frame(spark, [(2024, 21)], schema), {"note": [1]})
    assert len(table.last().slots["year=2024"]) == 2 and table.last().notes == {"note": [1]}
    table.clean(keep=1)
    assert rows(table.read()) == rows(frame(spark, [(2024, 20), (2024, 21), (None, 3)], schema))


def test_documents_stay_within_a_fixed_number_of_runs(spark, tmp_path):
    schema = layout("Id string, Year int, Month int, TimeStamp bigint, v int")
    store = DocumentStore(spark, str(tmp_path / "d"), schema, ["Id"], ["Year", "Month"], fan=2, levels=2)
    want, most = {}, 0
    for batch in range(14):
        given = [(f"k{i % 5}" if i % 4 else None, 2024, 1 + batch % 2, 50 - i, 100 * batch + i) for i in range(batch % 3, 8)]
        assert store.put(frame(spark, given, schema), batch)
        for row in given:
            old = want.get(row[:3])
            if old is None or (batch, row[3], row[4]) > old[0]:
                want[row[:3]] = (batch, row[3], row[4]), row
        most = max(most, *store.runs().values())
    assert most <= store.most_runs == 3
    assert not store.put(frame(spark, [("k0", 2024, 1, 99, -1)], schema), 13)  # handed over again
    assert store.put(frame(spark, [("new", 2024, 1, 99, -1)], schema), 0, stream="another", number=99)
    expected = [row for _, row in want.values()] + [("new", 2024, 1, 99, -1)]
    assert rows(store.read()) == rows(frame(spark, expected, schema))
    one = store.read(Year=2024, Month=2)
    assert rows(one) == rows(frame(spark, [r for r in expected if r[2] == 2], schema))
    assert {"/Month=2/" in f for f in one.inputFiles()} == {True}
    assert store.read(Year=1999, Month=1).collect() == []


def test_verifying_some_reports_leaves_all_other_files(spark, tmp_path):
    given = sample.live_reports(spark, FOLDER)
    early = given.filter("status = 'WaitingVerification'").orderBy("submit_time").limit(10).agg(F.max("submit_time")).first()[0]
    given.write.parquet(str(tmp_path / "live_report"))

    def do(moment):
        as_of = datetime.fromtimestamp(moment, timezone.utc).isoformat()
        jobs.run(spark, ["--root", str(tmp_path), "--as-of", as_of, "verify-reports"])

    do(0)  # nothing is due; the plain files become the first version
    read = jobs.Tables(spark, str(tmp_path)).read
    assert rows(read("live_report")) == rows(given.select(*LIVE_REPORT.names))
    before = files(tmp_path)
    do(early + 300)
    verified = read("live_report").filter("last_modified_by is not null").count()
    assert verified == given.filter(f"status = 'WaitingVerification' and submit_time <= {early}").count() >= 10
    now = files(tmp_path)
    assert all(now.get(f) == t for f, t in before.items())
    assert 0 < len({str(f).split("/")[-2] for f in now.keys() - before.keys()}) <= verified


def test_messages_go_out_once_with_their_change(spark, tmp_path, monkeypatch):
    root, sent = str(tmp_path), []
    profiles = [(str(i), f"p{i}", 1, 10_000 * (i % 3), 1, None, "Level1") for i in range(30)]
    given = frame(spark, [p + (None,) * (len(PROFILE_TABLE) - len(p)) for p in profiles], PROFILE_TABLE)
    given.write.parquet(f"{root}/profile")

    def do(hour, *more):
        jobs.run(spark, ["--root", root, "--as-of", f"2024-05-01T{hour:02}:00:00", "update-levels", *more])

    monkeypatch.setattr(VersionedTable, "change", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        do(1)
    monkeypatch.undo()
    monkeypatch.setattr(sinks, "send", lambda messages, format, **options: sent.append([r[0] for r in messages.collect()]))
    do(2, "--send-to", "servers")
    outbox = [json.loads(r[0]) for r in spark.read.text(f"{root}/outbox/activity_transaction").collect()]
    assert len(outbox) == 20 and len({m["Id"] for m in outbox}) == 20  # the first attempt left nothing
    assert [json.loads(m) for m in sorted(sent[0])] == sorted(outbox, key=lambda m: json.dumps(m)) or len(sent[0]) == 20
    assert len(sent) == 1

    # The table is changed, but sending fails: the next job sends what waits.
    table = jobs.Tables(spark, root).versioned("profile")
    table.change(given.select("Phone"), lambda r: r.withColumn("TotalPoints", F.lit(0).cast("bigint")))

    def fails(*args, **options):
        raise RuntimeError("no servers")

    monkeypatch.setattr(sinks, "send", fails)
    with pytest.raises(RuntimeError):
        do(3, "--send-to", "servers")
    assert jobs.Tables(spark, root).read("profile").filter("Level <> 1").count() == 0
    monkeypatch.setattr(sinks, "send", lambda messages, format, **options: sent.append([r[0] for r in messages.collect()]))
    do(4, "--send-to", "servers")
    assert [len(s) for s in sent] == [20, 20, 0] and table.last().notes["outbox/activity_transaction"] == []


def test_published_documents_reach_the_serving_store(spark, tmp_path, monkeypatch):
    root, given = str(tmp_path), []
    profiles = [(str(i), f"p{i}", 1, 7, 1, None, "Level1") for i in range(5)]
    frame(spark, [p + (None,) * (len(PROFILE_TABLE) - len(p)) for p in profiles], PROFILE_TABLE).write.parquet(f"{root}/profile")
    monkeypatch.setattr(sinks, "publish", lambda documents, put: given.append((documents.collect(), put)))
    jobs.run(spark, ["--root", root, "publish", "--kind", "profiles", "--put", "json:dumps"])
    (documents, put), = given
    assert put is json.dumps and {d.doc_id for d in documents} == {f"profile:p{i}" for i in range(5)}
    assert {json.loads(d.doc)["TotalPoints"] for d in documents} == {7}


def test_standing_follows_changes_and_reads_their_bands_only(spark, tmp_path):
    members = [(str(i), f"p{i:03}", (i * 37) % 50 if i % 3 else 0) for i in range(300)] + [("x", None, None), (None, "q", 5)]
    schema = layout("id string, phone string, totalpoints bigint")
    standing = Standing(spark, str(tmp_path / "s"))
    first = standing.build(frame(spark, members, schema), band_members=20)
    assert len(first.slots) > 5

    def expected(state):
        profiles = frame(spark, [(i, p, t, None) for i, p, t in state], layout("Id string, Phone string, TotalPoints bigint, Rank int"))
        return rows(ranking.rank_all_time(profiles).select("id", "phone", "totalpoints", F.col("new_rank").alias("rank")))

    assert rows(standing.ranks()) == expected(members)
    held = {(i, p): t or 0 for i, p, t in members}
    changes = [(i, p, t, t + 1) for i, p, t in members[1:101] if t and t < 8] + [("new", "n", None, 3), ("x", None, 0, 2), ("0", "p000", 0, None)]
    touched = standing.change(frame(spark, changes, layout("id string, phone string, old_points bigint, new_points bigint")))
    for i, p, _, new in changes:
        held[i, p] = new
    state = [(i, p, t) for (i, p), t in held.items() if t is not None]
    assert rows(standing.ranks()) == expected(state)
    assert 0 < len(touched) < len(first.slots)
    last = standing.table.last()
    assert all(last.slots[s] == runs for s, runs in first.slots.items() if s not in touched)  # other bands keep their files
    moved = {(r.id, r.phone): (r.old_rank, r.new_rank) for r in standing.moved(first).collect()}
    old, new = ({(r.id, r.phone): r["rank"] for r in standing.ranks(c).collect()} for c in (first, last))
    assert moved == {k: (old.get(k), n) for k, n in new.items() if old.get(k) != n}
    empty = Standing(spark, str(tmp_path / "e"))
    empty.build(frame(spark, [], schema))
    assert empty.ranks().collect() == []
    empty.change(frame(spark, [("a", "b", None, 4)], layout("id string, phone string, old_points bigint, new_points bigint")))
    assert rows(empty.ranks()) == [("a", "b", 4, 1)]
