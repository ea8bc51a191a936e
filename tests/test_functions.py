from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tenantflow.functions import dates, messages, text

AS_OF = dt.date(2020, 3, 10)


def kept(df, condition):
    return [r[0] for r in df.filter(condition).orderBy("n").select("n").collect()]


def test_trailing_days_leave_both_ends_out(spark):
    days = [(n, AS_OF + dt.timedelta(days=n)) for n in (-8, -7, -6, -1, 0, 1)]
    df = spark.createDataFrame([*days, (9, None)], "n int, d date")
    assert kept(df, dates.trailing_days_open(F.col("d"), AS_OF)) == [-6, -1]


def test_trailing_instant_is_strict(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, timestamp_ntz'2020-03-03 12:00:00', NULL),
          (2, timestamp_ntz'2020-03-03 12:00:00.000001', NULL),
          (3, timestamp_ntz'2019-01-01 00:00:00', timestamp_ntz'2020-03-09 00:00:00'),
          (4, timestamp_ntz'2019-01-01 00:00:00', NULL),
          (5, timestamp_ntz'2030-01-01 00:00:00', NULL) AS t(n, c, u)""")
    noon = dt.datetime(2020, 3, 10, 12)
    touched = dates.after_instant_days_ago(F.col("c"), noon) | dates.after_instant_days_ago(
        F.col("u"), noon
    )
    assert kept(df, touched) == [2, 3, 5]


def test_whole_days_include_midnight(spark):
    df = spark.sql("""
        SELECT * FROM VALUES (1, timestamp'2020-03-03 00:00:00'), (2, timestamp'2020-03-02 23:59:59'),
          (3, CAST(NULL AS timestamp)) AS t(n, c)""")
    assert kept(df, dates.since_whole_days_ago(F.col("c"), AS_OF, 7)) == [1]


def test_on_day(spark):
    df = spark.sql("""
        SELECT * FROM VALUES (1, timestamp'2020-03-10 00:00:00'), (2, timestamp'2020-03-10 23:59:59'),
          (3, timestamp'2020-03-11 00:00:00'), (4, timestamp'2020-03-09 23:59:59') AS t(n, c)""")
    assert kept(df, dates.on_day(F.col("c"), AS_OF)) == [1, 2]


def values(spark, inputs, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"n int, x {kind}")
    return [r[0] for r in df.orderBy("n").select(expression(F.col("x"))).collect()]


def test_source_timestamps(spark):
    moment = dt.datetime(2018, 10, 14, 1, 2, 3)
    cases = {
        "2018-10-14 01:02:03": moment,
        "18-10-14 01:02:03": moment,
        "18-10-14 1:2:3": moment,
        "18-10-14": dt.datetime(2018, 10, 14),
        "18-13-14 01:02:03": None,
        "18-10-14 25:02:03": None,
        "2018": None,
        "2018-10-14 01:02:03Z": None,
        "soon": None,
        "": None,
        None: None,
    }
    found = values(spark, list(cases), "string", dates.source_timestamp)
    assert found == list(cases.values())


def test_month_of_day_key(spark):
    found = values(spark, ["20181014", "2018", "abcdefgh", None], "string", dates.month_of_day_key)
    assert found == [10, None, None, None]
    assert values(spark, [20180304], "int", dates.month_of_day_key) == [3]


def test_day_key(spark):
    assert values(spark, [AS_OF, None], "date", dates.day_key) == [20200310, None]
    assert values(spark, [AS_OF], "date", dates.day_text) == ["20200310"]


def test_days_ago(spark):
    def moved(x):
        return dates.days_ago(x, 2, hour=23, minute=5, second=6, microsecond=70)

    found = values(spark, [dt.datetime(2020, 3, 1, 15, 30)], "timestamp_ntz", moved)
    assert found == [dt.datetime(2020, 2, 28, 23, 5, 6, 70)]
    found = values(
        spark, [dt.datetime(2020, 3, 1, 15, 30)], "timestamp_ntz", lambda x: dates.days_ago(x, 0)
    )
    assert found == [dt.datetime(2020, 3, 1)]


def test_non_blank(spark):
    found = values(spark, ["7", " 7 ", "", "   ", None], "string", text.non_blank)
    assert found == [True, True, False, False, None]


def test_first_phone(spark):
    df = spark.createDataFrame(
        [
            (1, "13800000001", "02100000001"),
            (2, "1380000000", "02100000002"),
            (3, "1", "2"),
            (4, None, None),
            (5, None, "02100000005"),
        ],
        "n int, a string, b string",
    )
    phone = text.first_phone(F.col("a"), F.col("b"))
    found = [r[0] for r in df.orderBy("n").select(phone).collect()]
    assert found == ["13800000001", "02100000002", None, None, "02100000005"]


def test_fallback_takes_empty_text_for_null(spark):
    found = values(spark, ["g", "", None], "string", lambda x: text.value_or(x, F.lit("k")))
    assert found == ["g", "k", "k"]


def test_card_state(spark):
    assert values(spark, ["1", "2", None], "string", text.card_state) == ["0", "1", "1"]


def test_canonical_hash_ignores_entry_order(spark):
    row = spark.sql("""
        SELECT map('a', '1', 'b', '2') AS x, map('b', '2', 'a', '1') AS y, map('a', '1') AS z
    """).select(*[text.canonical_hash(F.col(c)) for c in "xyz"]).first()
    assert row[0] == row[1] != row[2]


def test_signals(spark, rows):
    lines = [
        '{"org_code":"A","dw_name":"ADW","time":"2020-01-01 00:00:00"}',
        '{"org_code":"A","dw_name":"ADW2","time":"2020-01-01 00:00:01"}',
        '{"dw_name":"BDW","time":"2020-01-01 00:00:00"}',
        "{broken",
        "",
        '{"org_code":"C"}',
    ]
    parsed = messages.parse_signals(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert parsed.count() == 3
    assert rows(messages.latest_signals(parsed)) == [
        ("A", "ADW2", "2020-01-01 00:00:01"),
        ("C", None, None),
    ]


def test_signal_value_reads_back(spark):
    value = messages.signal_value(F.lit("A"), F.lit("ADW"), F.lit(dt.datetime(2020, 1, 2, 3, 4, 5)))
    found = messages.parse_signals(spark.range(1).select(value.alias("value"))).first()
    assert tuple(found) == ("A", "ADW", "2020-01-02 03:04:05")
