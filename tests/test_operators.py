import random

import pytest
from pyspark.sql import functions as F

from milepost.operators import joins, keyed, ordering, sinks
from milepost.schemas import layout
from milepost.sources import tables


def df(spark, text, *rows):
    return spark.createDataFrame(list(rows), layout(text))


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- keyed tables -----------------------------------------------------------------

TARGET = "k string, total bigint, ts bigint, name string"


@pytest.fixture
def target(spark):
    return df(spark, TARGET, ("a", 1, 10, "A"), ("b", None, 20, None))


def test_upsert_set_changes_some_columns_and_inserts(spark, target):
    source = df(spark, TARGET, ("b", 5, 50, "ignored"), ("c", 7, 70, "C"))
    got = keyed.upsert(target, source, ["k"], update=["total", "ts"])
    assert rows(got) == [("a", 1, 10, "A"), ("b", 5, 50, None), ("c", 7, 70, "C")]
    assert rows(keyed.upsert(got, source, ["k"], update=["total", "ts"])) == rows(got)


def test_upsert_set_can_set_null(spark, target):
    source = df(spark, TARGET, ("a", None, 11, "x"))
    assert rows(keyed.upsert(target, source, ["k"], update=["total"]))[0] == ("a", None, 10, "A")


def test_upsert_increment_with_insert_values(spark, target):
    source = df(spark, "k string, total bigint, ts bigint", ("a", 4, 44), ("b", 2, 22), ("c", 3, 33))
    got = keyed.upsert(target, source, ["k"], update=["ts"], add=["total"], insert={"name": F.lit("new")})
    assert rows(got) == [("a", 5, 44, "A"), ("b", 2, 22, None), ("c", 3, 33, "new")]


def test_update_only_inserts_nothing(spark, target):
    source = df(spark, "k string, name string", ("a", "AA"), ("z", "Z"))
    assert rows(keyed.update_only(target, source, ["k"], update=["name"])) == [("a", 1, 10, "AA"), ("b", None, 20, None)]


def test_update_only_increment_and_audit(spark, target):
    source = df(spark, "k string, total bigint", ("a", 9))
    got = keyed.update_only(target, source, ["k"], add=["total"], touch={"ts": F.lit(99)})
    assert rows(got) == [("a", 10, 99, "A"), ("b", None, 20, None)]


def test_insert_absent_and_replace(spark, target):
    source = df(spark, TARGET, ("a", 8, 80, "new"), ("c", 7, 70, "C"))
    assert rows(keyed.insert_absent(target, source, ["k"])) == [
        ("a", 1, 10, "A"), ("b", None, 20, None), ("c", 7, 70, "C"),
    ]
    assert rows(keyed.replace_rows(target, source, ["k"])) == [
        ("a", 8, 80, "new"), ("b", None, 20, None), ("c", 7, 70, "C"),
    ]


def test_keep_latest_is_repeatable_and_idempotent(spark):
    items = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "m"), ("c", 5, "c"), ("c", 5, "c")]
    first = None
    for seed in range(3):
        random.Random(seed).shuffle(items)
        once = keyed.keep_latest(df(spark, "Id string, TimeStamp bigint, v string", *items).repartition(5))
        assert rows(once) == [("a", 2, "z"), ("b", 0, "m"), ("c", 5, "c")]
        first = once
    assert rows(keyed.keep_latest(first)) == rows(first)


def test_changed_counts_null_as_a_value(spark):
    pairs = df(spark, "o int, n int", (1, 1), (1, 2), (None, 1), (None, None))
    assert rows(keyed.changed(pairs, "o", "n")) == [(1, 2), (None, 1)]


# --- positions ------------------------------------------------------------------


def members(spark, n=3000, seed=1):
    """A third of all members are tied at zero points with one timestamp."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        hot = i % 3 == 0
        made.append((rng.choice([1, 1, 1, 2]), 0 if hot else rng.choice([None, 5, rng.randrange(500)]), 7 if hot else rng.randrange(9), f"{i:05d}"))
    rng.shuffle(made)
    return spark.createDataFrame(made, layout("g int, points int, ts int, phone string")).repartition(8)


def order():
    return [F.desc_nulls_last("points"), F.asc("ts"), F.asc("phone")]


@pytest.mark.parametrize("group", [[], ["g"]])
def test_positions_equal_row_number(spark, group):
    frame = members(spark)
    got = ordering.positions(
        frame, order(), group, index="i", running={"run": F.col("points")}, totals={"all": F.col("points"), "n": F.lit(1)}
    )
    by = "partition by g" if group else ""
    by_points = "order by points desc nulls last, ts, phone"
    expected = frame.selectExpr(
        "*",
        f"cast(row_number() over ({by} {by_points}) as bigint) i",
        f"coalesce(sum(points) over ({by} {by_points} rows unbounded preceding), 0) run",
        f"sum(points) over ({by}) all",
        f"count(*) over ({by}) n",
    )
    assert rows(got) == rows(expected)


def test_positions_with_a_null_group_and_with_shuffled_slices(spark, monkeypatch):
    frame = members(spark).withColumn("g", F.when(F.col("g") == 1, 1))
    monkeypatch.setattr(ordering, "BROADCAST_SLICES", 0)
    got = ordering.positions(frame, order(), ["g"], index="i")
    expected = frame.selectExpr(
        "*", "cast(row_number() over (partition by g order by points desc nulls last, ts, phone) as bigint) i"
    )
    assert rows(got) == rows(expected)


def test_positions_attach_group_figures(spark):
    frame = members(spark)
    names = df(spark, "g int, name string", (1, "one"))
    got = ordering.positions(frame, order(), ["g"], index="i", attach=names)
    assert {(r.g, r.name) for r in got.select("g", "name").distinct().collect()} == {(1, "one")}
    assert got.count() == frame.filter("g = 1").count()


def test_positions_of_nothing(spark):
    assert ordering.positions(members(spark).filter("phone = 'x'"), order(), index="i").count() == 0


# --- joins ------------------------------------------------------------------------


def skewed(spark):
    made = [("hot" if i % 3 else f"k{i % 50}", i) for i in range(4000)] + [(None, -1)]
    return spark.createDataFrame(made, layout("k string, n int")).repartition(8)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = df(spark, "k string, v int", ("hot", 1), *[(f"k{i}", i) for i in range(0, 50, 2)], ("unused", 0))
    got = joins.spread_join(left, right, ["k"], ["n"], how, hot_keys=3, hot_rows=2)
    assert rows(got) == rows(left.join(right, "k", how))


def test_spread_join_spreads_the_hot_key(spark):
    left, right = skewed(spark), df(spark, "k string, v int", ("hot", 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = joins.spread_join(left, right, ["k"], ["n"], hot_rows=200).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in got.filter("k = 'hot'").groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 2


def test_six_hundred_hot_keys(spark):
    """Every frequent key is split, however many there are."""
    left = spark.range(0, 60_000, 1, 8).select((F.col("id") % 600).alias("k"), "id")
    right = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = joins.spread_join(left, right, ["k"], ["id"], hot_rows=20)
    assert got.count() == 60_000 and got.filter("v <> 2 * k").count() == 0
    salts = joins.most_frequent(joins.count_keys(left, ["k"]), ["k"], joins.HOT_KEYS, 20)
    assert salts.count() == 600


@pytest.mark.parametrize("known", [["hot"], ["k0", "k3"], []])
def test_rows_without_match_keeps_all_copies(spark, known):
    left = skewed(spark).union(df(spark, "k string, n int", *[("copy", 1)] * 500))
    right = df(spark, "k string", *[(k,) for k in known] * 3)
    got = joins.rows_without_match(left, right, ["k"])
    known_keys = set(known)
    assert rows(got) == sorted((tuple(r) for r in left.collect() if r.k not in known_keys), key=repr)


# --- sources and sinks ------------------------------------------------------------

PERIODIC = "Id string, Phone string, TimeStamp bigint, Year int, Month int, Date bigint"
BY = ["Year", "Month", "Date"]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def stored(spark, folder):
    table = df(
        spark, PERIODIC,
        ("a", "1", 1, 2024, 1, 100), ("a", "1", 2, 2024, 1, 200), ("b", "2", 1, 2024, 1, 100),
        ("c", "1", 1, 2024, 2, 300), ("d", "3", 1, 2023, 1, 50),
    )
    sinks.append(table, folder, BY, ["Phone"])
    return table


def read(spark, folder):
    return rows(tables.read_path(spark, folder, layout(PERIODIC)))


def test_missing_table_is_empty_but_errors_stay(spark, folder):
    assert tables.read_or_empty(spark, folder, layout(PERIODIC)).count() == 0
    with pytest.raises(Exception, match="no-such-format"):
        tables.read_or_empty(spark, folder, layout(PERIODIC), format="no-such-format")


def test_append_absent_twice_adds_once(spark, folder, stored):
    batch = df(spark, PERIODIC, ("a", "1", 9, 2025, 1, 1), ("e", "1", 9, 2025, 1, 1))
    for _ in range(2):
        sinks.append_absent(batch, folder, layout(PERIODIC), ["Id"], BY, scope=[])
    assert [r for r in read(spark, folder) if r[3] == 2025] == [("e", "1", 9, 2025, 1, 1)]


def test_append_absent_within_its_days(spark, folder, stored):
    batch = df(spark, PERIODIC, ("a", "1", 9, 2024, 1, 100), ("e", "1", 9, 2024, 1, 100))
    for _ in range(2):
        sinks.append_absent(batch, folder, layout(PERIODIC), ["Id"], BY, scope=BY)
    assert len(read(spark, folder)) == 6


def test_append_absent_reads_only_its_directories(spark, folder, stored):
    batch = df(spark, PERIODIC, ("a", "1", 9, 2024, 1, 100), ("e", "1", 9, 2025, 7, 7))
    found = sinks._directories_of(batch, folder, layout(PERIODIC), BY, BY)
    assert {"/".join(f.split("/")[-4:-1]) for f in found.inputFiles()} == {"Year=2024/Month=1/Date=100"}
    assert rows(found) == [r for r in rows(stored) if r[3:] == (2024, 1, 100)]
    with pytest.raises(ValueError):
        sinks.append_absent(batch, folder, layout(PERIODIC), ["Id"], BY, scope=["Date"])


def test_append_absent_with_missing_dates(spark, folder, stored):
    batch = df(spark, PERIODIC, ("x", "1", 9, None, 1, None), ("a", "1", 9, 2024, 1, 100))
    for _ in range(2):
        sinks.append_absent(batch, folder, layout(PERIODIC), ["Id"], BY, scope=BY)
    assert [r[0] for r in read(spark, folder)].count("x") == 1 and len(read(spark, folder)) == 6


def test_append_absent_beyond_the_broadcast_limit(spark, folder, stored, monkeypatch):
    monkeypatch.setattr(sinks, "BROADCAST_BYTES", -1)
    batch = df(spark, PERIODIC, ("a", "1", 9, 2024, 1, 100), ("e", "1", 9, 2024, 1, 100))
    sinks.append_absent(batch, folder, layout(PERIODIC), ["Id"], BY, scope=[])
    assert len(read(spark, folder)) == 6


def test_replace_slice_reads_and_writes_one_table(spark, folder, stored):
    table = tables.read_path(spark, folder, layout(PERIODIC))
    inside = (F.col("Year") == 2024) & (F.col("Month") == 1)
    sinks.replace_slice(keyed.keep_latest(table.filter(inside)), folder, BY, inside)
    # The older copy of "a" had another day; "b" keeps that directory.
    assert read(spark, folder) == [
        ("a", "1", 2, 2024, 1, 200), ("b", "2", 1, 2024, 1, 100), ("c", "1", 1, 2024, 2, 300), ("d", "3", 1, 2023, 1, 50),
    ]


def test_replace_slice_empties_directories(spark, folder, stored):
    table = tables.read_path(spark, folder, layout(PERIODIC))
    inside = (F.col("Year") == 2024) & (F.col("Month") == 1)
    sinks.replace_slice(table.filter(inside).filter("Date = 200"), folder, BY, inside)
    assert [r for r in read(spark, folder) if r[3:5] == (2024, 1)] == [("a", "1", 2, 2024, 1, 200)]
    assert len(read(spark, folder)) == 3


def test_replace_slice_with_missing_days(spark, folder):
    given = [("a", "1", 1, 2024, 1, None), ("a", "1", 2, 2024, 1, None), ("b", "1", 1, 2024, 1, 100)]
    sinks.append(df(spark, PERIODIC, *given), folder, BY)
    table = tables.read_path(spark, folder, layout(PERIODIC))
    inside = (F.col("Year") == 2024) & (F.col("Month") == 1)
    sinks.replace_slice(keyed.keep_latest(table.filter(inside)), folder, BY, inside)
    assert read(spark, folder) == [("a", "1", 2, 2024, 1, None), ("b", "1", 1, 2024, 1, 100)]
    table = tables.read_path(spark, folder, layout(PERIODIC))  # its files were swapped
    sinks.replace_slice(table.filter("Id = 'b'"), folder, BY, inside)
    assert read(spark, folder) == [("b", "1", 1, 2024, 1, 100)]


def test_delete_slice_counts_and_dry_run(spark, folder, stored):
    period = {"Year": 2024, "Month": 1}
    schema = layout(PERIODIC)
    assert rows(sinks.delete_slice(spark, folder, schema, period, dry_run=True)) == [(3, 0, 3)]
    assert len(read(spark, folder)) == 5
    assert rows(sinks.delete_slice(spark, folder, schema, period)) == [(3, 3, 0)]
    assert rows(sinks.delete_slice(spark, folder, schema, period)) == [(0, 0, 0)]
    assert len(read(spark, folder)) == 2


def test_rewrite_and_switch_a_named_table(spark, folder, stored, tmp_path):
    sinks.create_table(spark, "switched", layout(PERIODIC), BY, folder)
    try:
        spark.catalog.recoverPartitions("switched")
        table = spark.read.table("switched")
        assert table.count() == 5
        sinks.write_version(keyed.keep_latest(table), str(tmp_path / "v2"), BY, ["Phone"])
        sinks.point_table(spark, "switched", str(tmp_path / "v2"))
        spark.catalog.recoverPartitions("switched")
        assert spark.read.table("switched").count() == 4
        with pytest.raises(Exception):
            sinks.write_version(table, folder, BY)
    finally:
        spark.sql("DROP TABLE switched")


def test_union_by_name_with_missing_columns(spark):
    a, b = df(spark, "x int, y int", (1, 2)), df(spark, "y int, x int, z int", (4, 3, 5))
    assert rows(tables.union_periods([a, b])) == [(1, 2, None), (3, 4, 5)]


def test_pick_treats_values_as_data(spark, stored):
    assert tables.pick(stored, Phone="1' OR '1'='1").count() == 0
    assert tables.pick(stored, Phone=None).count() == 5


def test_send_and_publish(spark, tmp_path):
    docs = df(spark, "doc_id string, doc string", *[(f"d{i}", "{}") for i in range(25)])
    out = str(tmp_path / "messages")
    sinks.send(docs.select(F.col("doc").alias("value")), "text", path=out)
    assert spark.read.text(out).count() == 25
    seen = spark.sparkContext.accumulator(0)

    def put(chunk):
        assert len(chunk) <= 10
        seen.add(len(chunk))

    sinks.publish(docs, put, batch=10)
    assert seen.value == 25


def test_readers_by_name_format_and_literal_rows(spark, folder, stored):
    assert tables.read_store(spark, "parquet", path=folder).count() == 5
    stored.write.saveAsTable("by_name")
    try:
        assert rows(tables.read_table(spark, "by_name")) == rows(stored)
    finally:
        spark.sql("DROP TABLE by_name")
    assert tables.rows_to_df(spark, [("a", 1)], layout("k string, n int")).schema == layout("k string, n int")


def test_relational_tables_need_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        tables.read_jdbc(spark, "jdbc:none://host/db", "profiles", "id", 0, 100, 4)


def test_a_missing_total_stays_missing(spark):
    target = df(spark, "id string, points bigint", ("a", None), ("b", 2), ("c", None))
    source = df(spark, "id string, points bigint", ("a", 5), ("b", 1))
    assert rows(keyed.update_only(target, source, ["id"], add=["points"])) == [("a", None), ("b", 3), ("c", None)]
