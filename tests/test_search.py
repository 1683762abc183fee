"""Searching Ids through Bloom filters, comparing tables by digests, decisions kept under replay."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from milepost import jobs
from milepost.functions.values import lower_names
from milepost.operators import id_filters, sinks
from milepost.plans import maintenance, reconcile
from milepost.schemas import ACTIVITY_TRANSACTION, MEMBERSHIP_MONTHLY, MEMBERSHIP_YEARLY, USER_EVENT
from milepost.sources.streams import read_files
from milepost.sources.tables import read_or_empty
from milepost.streaming import users
from tests.test_plans import rows

BY = ["Year", "Month"]


def transactions(spark, ids, year=2024, month=1):
    """Rows with these Ids; a month for each hundred."""
    given = [{**dict.fromkeys(ACTIVITY_TRANSACTION.names), "Id": None if i is None else f"id{i}", "Phone": "p", "Year": year, "Month": month + (i or 0) // 100} for i in ids]
    return spark.createDataFrame([[r[n] for n in ACTIVITY_TRANSACTION.names] for r in given], ACTIVITY_TRANSACTION)


def test_new_ids_open_few_directories(spark, tmp_path, monkeypatch):
    path, opened = str(tmp_path / "t"), []
    plain = sinks._read_directories

    def counted(spark, path, schema, by, values):
        opened.append(len(values))
        return plain(spark, path, schema, by, values)

    monkeypatch.setattr(sinks, "_read_directories", counted)
    stored = transactions(spark, range(5000))
    put = lambda df: sinks.append_absent(df, path, ACTIVITY_TRANSACTION, ["Id"], BY, [])
    put(stored)
    put(transactions(spark, range(10_000, 11_000)))  # 1,000 new Ids against 50 directories
    assert opened[0] == 0 and opened[1] <= 5
    put(transactions(spark, [7, 4321, 20_000], year=2030))  # two are there, under other dates
    assert 1 < opened[2] <= 4
    put(transactions(spark, [20_000, None, None]))
    read = read_or_empty(spark, path, ACTIVITY_TRANSACTION)
    assert read.count() == 6003 and read.filter("Id is not null").select("Id").distinct().count() == 6001
    assert rows(read.filter("Year = 2030"), "Id") == [("id20000",)]


def test_filters_know_every_id_and_few_others(spark):
    df = transactions(spark, range(6000)).withColumn("Month", F.lit(3)).unionByName(transactions(spark, range(6000, 6010)))
    made = id_filters.filter_rows(df, "Id", BY).collect()
    assert {r["_blocks"] for r in made if r["Month"] == 3} == {4}  # grows with the directory
    assert id_filters.directories_with(df, "/nowhere", ACTIVITY_TRANSACTION, "Id", BY) == []


def test_filters_without_losses(spark, tmp_path):
    path = str(tmp_path / "t")
    for month in range(1, 13):
        id_filters.add_filters(transactions(spark, range(month * 50, month * 50 + 50)).withColumn("Month", F.lit(month)), path, "Id", BY)
    find = lambda ids: sorted(id_filters.directories_with(transactions(spark, ids), path, ACTIVITY_TRANSACTION, "Id", BY))
    assert find([60]) == [(2024, 1)] and find([60, 649]) == [(2024, 1), (2024, 12)]
    assert len(find(range(50, 650))) == 12
    assert len(find(range(10_000, 10_100))) <= 3


def test_batches_in_scope_keep_filters_complete(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_absent(transactions(spark, range(50)), path, ACTIVITY_TRANSACTION, ["Id"], BY, [])
    sinks.append_absent(transactions(spark, range(200, 250)), path, ACTIVITY_TRANSACTION, ["Id"], BY, BY)
    sinks.append_absent(transactions(spark, [210, 999], year=1999), path, ACTIVITY_TRANSACTION, ["Id"], BY, [])
    assert rows(read_or_empty(spark, path, ACTIVITY_TRANSACTION).filter("Year = 1999"), "Id") == [("id999",)]


def test_a_member_is_found_without_listing_other_directories(spark, tmp_path, capsys):
    root, path = str(tmp_path), str(tmp_path / "activity_transaction")
    days = ["Year", "Month", "Date"]
    given = transactions(spark, range(4000)).withColumn("Phone", F.concat(F.lit("p"), F.expr("cast(substring(Id, 3) as int) div 7").cast("string"))).withColumn("Date", F.lit(1).cast("bigint"))
    sinks.append(given, path, days)
    jobs.run(spark, ["--root", root, "index"])
    found = lambda phone: sinks.rows_with(spark, path, ACTIVITY_TRANSACTION, days, "Phone", phone)
    assert rows(found("p100"), "Id") == [(f"id{i}",) for i in range(700, 707)]
    assert {f.split("Month=")[1].split("/")[0] for f in found("p100").inputFiles()} <= {"8", *map(str, range(1, 41))}
    assert len({f.rsplit("/", 1)[0] for f in found("p100").inputFiles()}) <= 2  # of 40
    sinks.append_absent(given.limit(1).withColumns({"Id": F.lit("later"), "Month": F.lit(12), "Phone": F.lit("p100")}), path, ACTIVITY_TRANSACTION, ["Id"], days, days)
    assert ("later",) in rows(found("p100"), "Id") and found("nobody").count() == 0
    jobs.run(spark, ["--root", root, "query", "--phone", "p100"])
    assert "later" in capsys.readouterr().out
    with pytest.raises(ValueError):
        jobs.run(spark, ["--root", root, "index"])


def test_one_changed_directory_is_found_and_read_alone(spark, tmp_path):
    source, target, memory = (str(tmp_path / n) for n in ("s", "t", "m"))
    given = transactions(spark, range(10_000))  # 100 directories
    sinks.append(given, source, BY, ["Phone"])
    copy = lower_names(given.filter("Id <> 'id5050'"))
    sinks.append(copy, target, ["year", "month"], ["phone"])
    find = lambda: reconcile.missing_rows(spark, source, ACTIVITY_TRANSACTION, target, copy.schema, BY, memory)
    found, folders = find()
    assert rows(found, "id") == [("id5050",)] and folders == ["year=2024/month=51"]
    direct = maintenance.sync_missing(read_or_empty(spark, source, ACTIVITY_TRANSACTION), read_or_empty(spark, target, copy.schema))
    assert rows(found.select(*direct.columns)) == rows(direct)
    sinks.append(lower_names(given.filter("Id = 'id5050'")), target, ["year", "month"])
    sinks.append(transactions(spark, [1, 3, 3]).withColumn("Id", F.concat("Id", F.lit("x"))), source, BY)
    _, read = reconcile.digests(spark, source, ACTIVITY_TRANSACTION, "Id", BY, f"{memory}/source")
    assert read == ["Year=2024/Month=1"]  # only what changed since
    found, folders = find()
    assert rows(found, "id") == [("id1x",), ("id3x",), ("id3x",)] and folders == ["year=2024/month=1"]


def test_digest_trees(spark, tmp_path):
    a = {"y=1/m=1": (2, 5), "y=1/m=2": (1, 1), "y=2/m=1": (3, 3)}
    assert reconcile.differing(a, a) == []
    assert reconcile.differing(a, {**a, "y=2/m=1": (3, 4)}) == ["y=2/m=1"]
    assert reconcile.differing(a, {k: v for k, v in a.items() if k != "y=1/m=2"}) == ["y=1/m=2"]
    assert reconcile.differing(a, {}) == sorted(a)
    nothing = reconcile.missing_rows(spark, str(tmp_path / "a"), ACTIVITY_TRANSACTION, str(tmp_path / "b"), lower_names(transactions(spark, [])).schema, BY, str(tmp_path / "m"))
    assert nothing[0].collect() == [] and nothing[1] == []


def test_a_batch_replayed_after_the_month_writes_no_second_row(spark, tmp_path, monkeypatch):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    message = '{"Event": "CreateUser", "Datas": "[{\\"User\\": {\\"Phone\\": \\"77\\"}}]"}'
    spark.createDataFrame([(bytearray(message.encode()),)], "value binary").write.parquet(inbox)
    paths = str(tmp_path / "monthly"), str(tmp_path / "yearly")
    source = lambda: read_files(spark, inbox, spark.read.parquet(inbox).schema)

    def run(moment):
        monkeypatch.setattr(users, "now", lambda zone: moment)
        users.register_users(source(), *paths, checkpoint).awaitTermination()

    run(datetime(2024, 12, 31, 12, tzinfo=timezone.utc))
    done = tmp_path / "c" / "commits" / "0"
    for file in (done, done.with_name(".0.crc")):
        file.unlink()  # the batch broke off before Spark noted its end
    run(datetime(2025, 1, 2, 12, tzinfo=timezone.utc))
    assert rows(spark.read.schema(MEMBERSHIP_MONTHLY).parquet(paths[0]), "phone", "year", "month") == [("77", 2024, 12)]
    assert rows(spark.read.schema(MEMBERSHIP_YEARLY).parquet(paths[1]), "phone", "year") == [("77", 2024)]
    assert USER_EVENT.names == ["Event", "Datas"]
