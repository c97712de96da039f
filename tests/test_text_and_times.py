import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelwatch.functions import text, times
from parcelwatch.functions.text import clean_tracking_number, key_text, strip
from parcelwatch.functions.times import parse_date


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("1.2345E+11", "123450000000"),
        ("123456789012.0", "123456789012"),
        ("  007 ", "7"),
        ("1,234", "1234"),
        ("nan", ""),
        ("None", ""),
        (None, ""),
        ("-5.7", "-5"),
        ("-1.5e0", "-1"),
        (".5", "0"),
        ("000", "0"),
        ("AB12.0", "AB12"),
        ("123D", "123D"),
        ("1Z999AA10123456784", "1Z999AA10123456784"),
        ("12345678901234567890123", "12345678901234567890123"),
    ],
)
def test_clean_tracking_number(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "c string")
    assert column(df, text.clean_tracking_number(F.col("c"))) == [clean]


def test_as_int_of_texts_and_types(spark):
    df = spark.createDataFrame(
        [("2.7", 1.9, True), ("bad", float("nan"), False), (" 3 ", None, None), ("5d", -2.9, True), ("1e2", 0.0, True)],
        "s string, d double, b boolean",
    )
    assert column(df, text.as_int(df, "s")) == [2, 0, 3, 0, 100]
    assert column(df, text.as_int(df, "d")) == [1, 0, 0, -2, 0]
    assert column(df, text.as_int(df, "b")) == [1, 0, 0, 1, 1]
    assert column(df, text.as_int(df, "absent")) == [0] * 5


def test_strip_covers_unicode_whitespace(spark):
    df = spark.createDataFrame([(" \t x y \n",), ("\x1c\x1f",), (None,)], "c string")
    assert column(df, text.strip(F.col("c"))) == ["x y", "", None]
    assert column(df, text.is_blank(F.col("c"))) == [False, True, True]


def test_carrier_name(spark):
    df = spark.createDataFrame([("fdxg",), ("FEDEX",), ("ups",), ("",), (None,)], "c string")
    assert column(df, text.carrier_name(F.col("c"))) == ["FedEx", "FedEx", "UPS", "Unknown", "Unknown"]


@pytest.mark.parametrize(
    "raw, iso",
    [
        ("2025-10-03T00:15:00-04:00", "2025-10-03T04:15:00Z"),
        ("2025-10-03T00:15:00.120-0400", "2025-10-03T04:15:00.120000Z"),
        ("2025-10-03 00:15:00", "2025-10-03T00:15:00Z"),
        ("2025-10-03", "2025-10-03T00:00:00Z"),
        ("2025-03-09T02:30:00", "2025-03-09T02:30:00Z"),
        ("1969-12-31T23:59:59.999999Z", "1969-12-31T23:59:59.999999Z"),
        ("not-a-date", None),
        ("now", None),
        ("12:30", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamps_are_read_and_written_in_utc(spark, raw, iso):
    df = spark.createDataFrame([(raw,)], "c string")
    assert column(df, times.iso_utc(F.expr(times.epoch_micros_sql("c")))) == [iso]


@pytest.mark.parametrize(
    "raw, day",
    [
        ("2025-01-06", dt.date(2025, 1, 6)),
        ("2025-01-06 13:00:00", dt.date(2025, 1, 6)),
        ("2025-01-06T23:30:00-05:00", dt.date(2025, 1, 6)),
        ("1/6/2025", dt.date(2025, 1, 6)),
        ("Jan 6, 2025", dt.date(2025, 1, 6)),
        ("2025-01-06 or so", None),
        ("N/A", None),
        (None, None),
    ],
)
def test_parse_date(spark, raw, day):
    df = spark.createDataFrame([(raw,)], "c string")
    assert column(df, times.parse_date(F.col("c"))) == [day]


@pytest.mark.parametrize(
    "ref, first, last",
    [
        ("2025-10-22", "2025-10-12", "2025-10-18"),
        ("2025-01-15", "2025-01-05", "2025-01-11"),
        ("2025-10-19", "2025-10-12", "2025-10-18"),
        ("2025-10-18", "2025-10-05", "2025-10-11"),
    ],
)
def test_prior_week(spark, ref, first, last):
    want = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    day = dt.date.fromisoformat(ref)
    assert times.prior_week_range(day) == want
    df = spark.createDataFrame([(day,)], "d date")
    assert tuple(df.select(*times.prior_week_bounds(F.col("d"))).first()) == want


def test_naive_now_is_refused():
    with pytest.raises(ValueError):
        times.aware_now(dt.datetime(2025, 1, 1))


def test_whole_days_round_down(spark):
    now = dt.datetime(2025, 1, 10, 12, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame(
        [("2025-01-05T12:00:00Z",), ("2025-01-05T12:00:00.000001Z",), ("2025-01-10T13:00:00Z",), ("x",)], "c string"
    )
    got = column(df, times.whole_days_before(now, F.expr(times.epoch_micros_sql("c"))))
    assert got == [5, 4, -1, None]


def test_numbers_of_any_size_are_cleaned_exactly(spark):
    cases = {
        "1e29": "1" + "0" * 29, "1.5E+30": "15" + "0" * 29, "-2.25e3": "-2250", "12345E-2": "123", "9.99E-1": "0", "1,5E3": "15000",
        "1E999": "1E999", ".5e1": "5", "007e2": "700", "1" * 60: "1" * 60, "5.": "5", "-0": "0",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", clean_tracking_number(F.col("t"))).collect()} == cases


def test_arguments_are_written_once(spark):
    heavy = F.concat(F.col("t"), F.lit("ARGUMENT"))
    for rule in (clean_tracking_number, key_text, strip, parse_date):
        plan = spark.createDataFrame([("1",)], "t string").select(rule(heavy).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ARGUMENT") == 1, rule.__name__


SPELLED = [
    ("2025-10-07T10:15:00Z", 0), ("10/7/2025 10:15", 0), ("10/07/2025 10:15 AM", 0), ("10/7/2025 10:15am", 0), ("Oct 7, 2025 10:15:00", 0), ("October 7, 2025 at 10:15 AM", 0),
    ("7 Oct 2025 10:15", 0), ("07-Oct-2025 10:15:00", 0), ("Tue, 07 Oct 2025 10:15:00 GMT", 0), ("Tue, 07 Oct 2025 15:45:00 +0530", 0), ("2025/10/07 03:15:00 -07:00", 0),
    ("20251007101500", 0), ("10/7/2025 10:15:00.25", 250_000), ("10/7/2025", -36_900_000_000), ("20251007", -36_900_000_000), ("Tuesday, October 7, 2025", -36_900_000_000),
    ("99/99/2025", None), ("now", None), ("12:30", None), ("", None), ("2025-13-45", None), (None, None), ("x" * 100_000, None), ("Yaw 7, 2025", None),
]


def test_times_in_other_spellings(spark):
    from pyspark.sql import functions as F

    from parcelwatch.functions.times import epoch_micros_sql
    from parcelwatch.operators.metrics import unread_time_shapes

    table = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(SPELLED)], "i int, s string")
    got = [r.m for r in table.orderBy("i").select(F.expr(epoch_micros_sql("s")).alias("m")).collect()]
    base = 1_759_832_100_000_000
    assert got == [None if m is None else base + m for _, m in SPELLED]
    shapes = {r["shape"]: r.n for r in unread_time_shapes(table, "s").collect()}
    assert shapes == {"9/9/Y": 1, "A": 2, "9:9": 1, "Y-9-9": 1, "A 9, Y": 1}


def test_a_time_is_shaped_once(spark):
    """The shape of a spelling is written once into the plan, not once for each shape it is compared with."""
    table = spark.createDataFrame([("",), (None,), ("  ",), ("Mon, 01 Jan 2024 05:00:00 GMT",), ("2024-01-01T05:00:00Z",)], "s string")
    read = table.select(F.expr(times.epoch_micros_sql("s")).alias("m"))
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 20
    assert [r.m for r in read.collect()] == [None, None, None, 1_704_085_200_000_000, 1_704_085_200_000_000]
