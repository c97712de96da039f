import datetime as dt

from pyspark.sql import functions as F

from parcelwatch.operators import filters, shaping
from parcelwatch.operators.metrics import with_idle_days
from parcelwatch.plans.queries import QUERIES
from parcelwatch.schema import CONTRACT_SUFFIX

REF = dt.date(2024, 3, 6)
FIRST = dt.date(2024, 2, 25)


def test_drop_first_column(spark, rows):
    assert shaping.drop_first_column(rows([{"X": "1", "A": "2"}])).columns == ["A"]
    only = shaping.drop_first_column(rows([{"X": "1"}, {"X": "2"}]))
    assert only.columns == [] and only.count() == 2


def test_contract_adds_orders_and_types(rows):
    df = rows([{"Tracking Number": "1", "code": None, "IsRTS": "bad", "B": "x"}])
    out = shaping.column_contract(df)
    originals = ["Tracking Number", "code", "IsRTS", "B"]
    assert out.columns == originals + [c for c in CONTRACT_SUFFIX if c not in originals]
    r = out.first()
    assert r["code"] == "" and r["IsRTS"] == 0 and r["CalculatedReasons"] == ""
    assert dict(out.dtypes)["HasException"] == "bigint"
    assert shaping.column_contract(out).collect() == out.collect()


def test_column_after(rows):
    df = rows([{"Damaged": "1", "b": "2", "UnableToDeliver": "3"}])
    assert shaping.column_after(df, "UnableToDeliver", "Damaged").columns == ["Damaged", "UnableToDeliver", "b"]
    assert shaping.column_after(rows([{"a": "1"}]), "n", "absent").columns == ["a", "n"]


def week_rows(rows):
    """Every day of five weeks around the reference date, each with four states of delivery; ``A`` numbers the rows."""
    days = [REF + dt.timedelta(days=d) for d in range(-21, 14)]
    states = ("on the road", "Delivered", "delivered ", None)
    made = [{"Promised Delivery Date": d.isoformat(), "Delivery Tracking Status": s} for d in days for s in states]
    made.append({"Promised Delivery Date": "soon", "Delivery Tracking Status": "on the road"})
    return rows([{"X": "x", **r, "A": str(i)} for i, r in enumerate(made)])


def test_preprocess_and_counts(rows):
    df = week_rows(rows)
    seen = {}
    out = filters.preprocess(df, REF, observe=seen)
    # The week before the one of REF has seven days, and one state in four is delivered.
    kept = out.collect()
    assert {r["Promised Delivery Date"] for r in kept} == {(FIRST + dt.timedelta(days=d)).isoformat() for d in range(7)}
    assert {r["Delivery Tracking Status"] for r in kept} == {"on the road", "delivered ", None} and len(kept) == 21
    assert [seen[s].get["rows"] for s in filters.STAGES] == [141, 28, 21]
    got = {r["stage"]: (r["before"], r["after"], r["delta"]) for r in filters.stage_counts(df, REF).collect()}
    assert got == {
        "drop_first_column": (141, 141, 0),
        "filter_prior_week": (141, 28, -113),
        "filter_not_delivered": (28, 21, -7),
    }


def test_filters_without_their_columns_or_disabled(rows):
    df = week_rows(rows)
    assert filters.filter_prior_week(df, REF, enabled=False).count() == 141
    assert filters.preprocess(df.select("X", "A"), REF).count() == 141


def test_date_column_filter_reaches_the_scan(spark, rows, tmp_path):
    path = str(tmp_path / "typed")
    week_rows(rows).select(
        "X", F.col("`Promised Delivery Date`").try_cast("date").alias("Promised Delivery Date")
    ).write.parquet(path)
    out = filters.preprocess(spark.read.parquet(path), REF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(`Promised Delivery Date`,2024-02-25)" in plan
    assert out.count() == 28


def test_views(rows):
    df = rows(
        [
            {"n": "1", "IsPreTransit": "1", "IsDelivered": "0", "IsStalled": "0", "Damaged": "0", "IsRTS": "0"},
            {"n": "2", "IsPreTransit": "0", "IsDelivered": "1", "IsStalled": "1", "Damaged": "0", "IsRTS": "1"},
            {"n": "3", "IsPreTransit": "0", "IsDelivered": "0", "IsStalled": "0", "Damaged": "1", "IsRTS": "0"},
        ]
    )

    def ids(view, frame=df):
        return sorted(r["n"] for r in view(frame).collect())

    assert ids(filters.view_pretransit) == ["1"]
    assert ids(filters.view_stalled) == ["2"]
    assert ids(filters.view_damaged_or_returned) == ["2", "3"]
    assert ids(filters.view_all_issues) == ["1", "3"]
    assert ids(filters.view_all_issues, df.drop("IsDelivered")) == ["2"]
    assert ids(filters.view_damaged_or_returned, df.drop("Damaged")) == ["2"]
    assert ids(filters.view_pretransit, df.drop("IsPreTransit")) == []


def test_idle_days(rows):
    now = dt.datetime(2024, 3, 1, 6, 30, tzinfo=dt.timezone.utc)
    want = {"2024-02-28T06:30:00Z": 2, "2024-02-28T06:30:01Z": 1, "2024-03-01T09:00:00+03:00": 0, "2024-03-02": -1, "yesterday": 0, None: 0}
    df = rows([{"LatestEventTimestampUtc": t} for t in want])
    assert [r["DaysSinceLatestEvent"] for r in with_idle_days(df, now).collect()] == list(want.values())
    assert with_idle_days(rows([{"a": "1"}]), now).first()["DaysSinceLatestEvent"] == 0


def test_generated_code_stays_small(spark):
    """Code that grows beyond the limit of a method is an error here, not a silent fall back to slow evaluation."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        for name in ("preprocess", "filter_prior_week", "clean_tracking_number", "blank_key_filter"):
            assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
