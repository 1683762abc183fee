from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from milepost.functions import calendar, messages, values
from milepost.schemas import ACTIVITY_EVENT, ACTIVITY_TRANSACTION, TIER_NAMES, USER_EVENT, layout

UTC = timezone.utc


def ms(*when):
    return int(datetime(*when, tzinfo=UTC).timestamp() * 1000)


def column(spark, kind, items, expression):
    df = spark.createDataFrame([(i,) for i in items], layout(f"x {kind}"))
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


# --- calendar -------------------------------------------------------------------


def test_local_day_is_half_open_and_seven_hours_ahead():
    start, end = calendar.day_bounds_ms(date(2024, 1, 15))
    assert (start, end) == (ms(2024, 1, 14, 17), ms(2024, 1, 15, 17))


def test_last_second_of_the_day_counts(spark):
    start, end = calendar.day_bounds_ms(date(2024, 1, 15))
    inside = column(spark, "bigint", [start, end - 1, end, start - 1], lambda x: calendar.in_range(x, start, end))
    assert inside == [True, True, False, False]


def test_first_of_month_is_true_local_midnight():
    assert calendar.period_start_ms(2024, 3) == ms(2024, 2, 29, 17)


def test_next_period_wraps_the_year():
    assert calendar.next_period(2023, 12) == (2024, 1)
    assert calendar.next_period(2024, 1) == (2024, 2)


@pytest.mark.parametrize("year, month", [(2024, 0), (2024, 13), (0, 1)])
def test_bad_periods(year, month):
    with pytest.raises(ValueError):
        calendar.check_period(year, month)


def test_touching_periods_cover_every_zone():
    assert calendar.touching_periods(ms(2024, 1, 31, 5), ms(2024, 1, 31, 6)) == [(2024, 1), (2024, 2)]
    assert calendar.touching_periods(ms(2024, 1, 15), ms(2024, 1, 16)) == [(2024, 1)]
    assert calendar.touching_periods(ms(2023, 12, 31, 22), ms(2024, 1, 1, 2)) == [(2023, 12), (2024, 1)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Ho_Chi_Minh"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql(
            "select timestamp_ntz'2024-07-01 12:34:56.789012' t, timestamp_ntz'1969-12-31 23:59:59.5' old,"
            " 2024 y, 3 m, 1705251599999 late"
        ).select(
            calendar.epoch_ms(F.col("t")),
            calendar.epoch_ms(F.col("old")),
            calendar.period_start(F.col("y"), F.col("m")),
            calendar.business_day(F.col("late")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row[0] == ms(2024, 7, 1, 12, 34, 56) + 789
    assert row[1] == -500
    assert row[2] == ms(2024, 2, 29, 17)
    assert row[3] == date(2024, 1, 14)


# --- values ---------------------------------------------------------------------


def test_tier_names_default_to_the_lowest(spark):
    got = column(spark, "string", [*TIER_NAMES, "Gold", None], values.tier_name)
    assert got == [*TIER_NAMES.values(), "Nhập môn", "Nhập môn"]


def test_device_ids(spark):
    imeis = ["VML_000123", "VML_000", "VMLX123", "VML_", "OBD_000123", None]
    assert column(spark, "string", imeis, values.device_id) == ["123", "", None, "", None, None]


def test_whole_km(spark):
    assert column(spark, "int", [999, 1000, 1999, None], values.whole_km) == ["0", "1", "1", "0"]


def test_level_thresholds():
    assert [values.level_threshold(n) for n in range(1, 7)] == [0, 50, 200, 500, 950, 1550]
    for n in range(3, 101):
        assert values.level_threshold(n) == values.level_threshold(n - 1) + 150 * (n - 2)


def test_level_at_and_around_every_threshold(spark):
    points = sorted({t + d for n in range(1, 101) for t in [values.level_threshold(n)] for d in (-1, 0, 1)})
    points += [None, -500, 2**40]

    def expected(p):
        return max([1] + [n for n in range(1, 101) if (p or 0) >= values.level_threshold(n)])

    assert column(spark, "bigint", points, values.level_for) == [expected(p) for p in points]


def test_level_table_agrees_with_the_closed_form(spark):
    rows = values.level_table(spark).collect()
    assert [(r.level, r.points_from) for r in rows] == [(n, values.level_threshold(n)) for n in range(1, 101)]
    assert all(a.points_below == b.points_from for a, b in zip(rows, rows[1:])) and rows[-1].points_below is None


def test_hashed_uuid_repeats_and_differs(spark):
    a, b, c = column(spark, "string", ["x", "x", None], values.hashed_uuid)
    assert a == b != c and len(a) == 36 and a.count("-") == 4


def test_epoch_seconds_falls_back(spark):
    moment = datetime(2024, 1, 1, tzinfo=UTC)
    got = column(spark, "timestamp", [moment, None], lambda x: values.epoch_seconds(x, F.lit(7)))
    assert got == [ms(2024, 1, 1) // 1000, 7]


def test_lower_names_and_missing_columns(spark):
    df = spark.createDataFrame([(None, 2)], layout("Phone string, Level int"))
    assert values.lower_names(df).columns == ["phone", "level"]
    picked = df.select(values.tolerant(df, "Phone", "unknown"), values.tolerant(df, "Rank", 0)).first()
    assert tuple(picked) == ("unknown", 0)


# --- messages -------------------------------------------------------------------


def decoded(spark, schema, *texts):
    raw = spark.createDataFrame([(t.encode(),) for t in texts], layout("value binary"))
    return messages.decode_rows(raw, schema)


def test_arrays_bare_objects_and_junk(spark):
    rows = decoded(
        spark, ACTIVITY_EVENT, '[{"Id":"a"},{"Id":"b"}]', '{"Id":"c"}', "[]", "not json", '[{"Id":"d","Month":3}]'
    )
    assert [(r.Id, r.Month) for r in rows.orderBy("Id").collect()] == [("a", None), ("b", None), ("c", None), ("d", 3)]


def test_user_phones(spark):
    datas = [
        '[{"User":{"Phone":"0901"}}]', '[{"User":{"Phone":""}}]', '[{"User":{}}]', "[]", "junk", None,
        '{"User":{"Phone":"0902"}}',
    ]
    assert column(spark, "string", datas, messages.first_user_phone) == ["0901", *[None] * 6]


def test_object_envelopes(spark):
    raw = spark.createDataFrame([('{"Event":"CreateUser","Datas":[{"User":{"Phone":"1"}}]}',)], "value string")
    row = messages.decode_object(raw, USER_EVENT).select("Event", messages.first_user_phone(F.col("Datas"))).first()
    assert tuple(row) == ("CreateUser", "1")


def test_messages_read_back(spark):
    rows = decoded(spark, ACTIVITY_TRANSACTION, '[{"Id":"a","Value":5,"Name":"AddPoint"}]')
    back = messages.decode_rows(messages.row_message(rows), ACTIVITY_TRANSACTION)
    assert back.collect() == rows.collect()
    assert messages.row_message(rows, "Id").columns == ["key", "value"]
