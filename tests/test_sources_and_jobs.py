import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import parcelwatch
from parcelwatch.operators import enrich, lookup, shaping
from parcelwatch.plans import fixtures, process
from parcelwatch.plans.process import tn_snapshot
from parcelwatch.sources import bodies as src
from parcelwatch.sources.bodies import BODY_ORDER, read_bodies, sink_bodies, src_bodies
from parcelwatch.sources.scratch import scratch_dir
from parcelwatch.sources.shipments import src_shipments
from parcelwatch.sources.views import sidecar, sink_views

NOW = dt.datetime(2025, 10, 7, tzinfo=dt.timezone.utc)


def docs_of(df):
    ordered = df.orderBy(*src.BODY_ORDER).select(F.to_json("body"))
    return [json.loads(r[0]) for r in ordered.collect()]


DOCS = [{"a": i, "nested": {"b": [1, {"c": "},\n  {"}]}, "text": "x" * (i % 7)} for i in range(200)]


@pytest.mark.parametrize(
    "name, text, layout, want",
    [
        ("array", json.dumps(DOCS), "document", DOCS),
        ("object", json.dumps({"completeTrackResults": [1, 2]}), "document", [{"completeTrackResults": [1, 2]}]),
        ("lines", "\n".join(json.dumps(d) for d in DOCS) + "\n\n", "lines", DOCS),
        ("indented", json.dumps(DOCS, indent=2), "indented", DOCS),
        ("mixed", json.dumps([1, {}, {"a": 1}, [], None, {"b": {"c": 1}}, "x", 5], indent=2), "indented", [1, {}, {"a": 1}, [], None, {"b": {"c": 1}}, "x", 5]),
        ("one", json.dumps([{"a": 1}], indent=2), "indented", [{"a": 1}]),
        ("empty", json.dumps([], indent=2), "indented", []),
        ("line_array", '[{"a": 1}]\n', "lines", [[{"a": 1}]]),
    ],
)
def test_body_layouts(spark, tmp_path, name, text, layout, want):
    path = tmp_path / f"{name}.json"
    path.write_text(text, encoding="utf-8")
    assert docs_of(src.src_bodies(spark, str(path), layout)) == want


def test_indented_dump_is_split_across_tasks(spark, tmp_path):
    path = tmp_path / "big.json"
    path.write_text(json.dumps(DOCS * 20, indent=2), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = src.src_bodies(spark, str(path), "indented")
        assert df.rdd.getNumPartitions() > 4
        assert docs_of(df) == DOCS * 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bad_body_sources(spark, tmp_path):
    with pytest.raises(ValueError):
        src.src_bodies(spark, str(tmp_path / "absent.json"))
    with pytest.raises(ValueError):
        src.src_bodies(spark, str(tmp_path), "rows")
    bad = tmp_path / "bad.json"
    bad.write_text('{"a": 1}\n{broken\n')
    assert docs_of(src.src_bodies(spark, str(bad), "lines", on_corrupt="skip")) == [{"a": 1}]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        src.src_bodies(spark, str(bad), "lines").collect()


def test_appends_keep_order_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "dump")
    assert src.read_bodies(spark, path).collect() == []

    def append(batch, *docs):
        df = spark.createDataFrame([(json.dumps(d),) for d in docs], "body string")
        src.sink_bodies(df, path, batch)

    append(2, {"trackingNumber": "A", "code": "first"})
    append(10, {"trackingNumber": "A", "code": "second"})
    append(10, {"trackingNumber": "A", "code": "again"}, {"n": 1})
    read = src.read_bodies(spark, path)
    assert len(docs_of(read)) == 3
    assert lookup.replay_facts(read, src.BODY_ORDER).first()["code"] == "again"
    src.sink_bodies(read.select("body"), str(tmp_path / "copy"), 0)
    assert len(docs_of(src.read_bodies(spark, str(tmp_path / "copy")))) == 3


def test_shipment_sources(spark, rows, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("X,Tracking Number,A\ndrop,007,1\ndrop,,2\n")
    df = src_shipments(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [("drop", "007", "1"), ("drop", None, "2")]
    empty = src_shipments(spark, str(tmp_path / "absent.parquet"))
    assert empty.columns == [] and empty.count() == 0
    (tmp_path / "junk.parquet").write_text("not parquet")
    assert src_shipments(spark, str(tmp_path / "junk.parquet")).columns == []


def test_scratch_uses_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


BODIES = [
    {"output": {"completeTrackResults": [
        {"trackingNumber": "1", "trackResults": [{
            "latestStatusDetail": {
                "code": "DE", "statusByLocale": "Delivery exception", "description": "Delivery exception",
                "ancillaryDetails": [{"reasonDescription": "Damaged, handling per shipper instructions"}]},
            "scanEvents": [{"date": "2025-10-05T12:00:00-04:00", "eventType": "DE"}]}]},
        {"trackingNumber": "2", "trackResults": [{
            "latestStatusDetail": {"code": "OC", "statusByLocale": "Label created"},
            "scanEvents": [{"date": "2025-10-01T00:00:00Z"}]}]}]}},
    {"trackingNumber": "3", "code": "DL", "statusByLocale": "Delivered"},
]
SHIPMENTS = (
    "X,RowId,Tracking Number,Carrier Code,Promised Delivery Date,Delivery Tracking Status,A\n"
    "d,1,1,FDX,2025-09-29,in transit,a\n"
    "d,2,2,FDX,2025-10-01,,b\n"
    "d,3,3,FDX,2025-10-01,in transit,c\n"
    "d,4,4,,10/4/2025,in transit,d\n"
    "d,5,1,FDX,2025-10-05,in transit,e\n"
    "d,6,2,FDX,2025-10-01,Delivered,f\n"
)


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    (base / "in.csv").write_text(SHIPMENTS)
    (base / "bodies.json").write_text(json.dumps(BODIES, indent=2))
    summary = parcelwatch.process_and_publish(
        spark,
        str(base / "in.csv"),
        str(base / "out"),
        bodies_path=str(base / "bodies.json"),
        bodies_layout="indented",
        sidecar_order="RowId",
        settings=parcelwatch.Settings(
            reference_date=dt.date(2025, 10, 7), reference_now=NOW, stalled_threshold_days=1
        ),
    )
    return base / "out", summary


def test_job_end_to_end(spark, published):
    out, summary = published

    def table(name):
        return {r["RowId"]: r.asDict() for r in spark.read.parquet(f"{out}/{name}").collect()}

    assert len(table("all_shipments")) == 6
    got = table("processed")
    assert set(got) == {"1", "2", "3", "4"} and "X" not in got["1"]
    assert {k: r["CalculatedStatus"] for k, r in got.items()} == {
        "1": "Exception", "2": "PreTransit", "3": "Delivered", "4": "Stalled"}
    assert got["1"]["CalculatedReasons"] == "Exception;Stalled"
    assert (got["1"]["DaysSinceLatestEvent"], got["1"]["Damaged"], got["1"]["ScanEventsCount"]) == (1, 1, 1)
    assert got["2"]["IsStalled"] == 0 and got["3"]["IsStalled"] == 0
    assert set(table("all_issues")) == {"1", "2", "4"}
    assert set(table("pretransit")) == {"2"}
    assert set(table("stalled")) == {"1", "4"}
    assert set(table("damaged_or_returned")) == {"1"}
    marker = spark.read.parquet(f"{out}/marker").first()
    assert (marker["run_marker"], marker["input_rows"], marker["input_cols"]) == ("ok", 6, 7)
    assert (marker["output_rows"], marker["output_cols"]) == summary["output_shape"]
    assert marker["input_name"] == "in.csv"


def test_published_columns(spark, published):
    out, summary = published
    cols = spark.read.parquet(f"{out}/all_issues").columns
    assert cols.index("UnableToDeliver") == cols.index("Damaged") + 1
    assert summary["output_cols"][-1] == "DaysSinceLatestEvent"
    assert summary["output_cols"][:6] == [
        "RowId", "Tracking Number", "Carrier Code", "Promised Delivery Date", "Delivery Tracking Status", "A"]


def test_empty_views_keep_all_columns(spark, published, tmp_path):
    out, _ = published
    none = spark.read.parquet(f"{out}/processed").filter("RowId = 'x'")
    paths = sink_views(none, str(tmp_path))
    for p in paths.values():
        df = spark.read.parquet(p)
        assert df.count() == 0 and set(df.columns) == set(none.columns)


def test_snapshot_and_sidecar(spark, published):
    out, _ = published
    processed = spark.read.parquet(f"{out}/processed")
    numbers = spark.createDataFrame([("1",), ("4",), ("99",)], "tracking_number string")
    got = {r[0]: tuple(r)[1:] for r in tn_snapshot(processed, numbers, "RowId").collect()}
    assert got == {"1": (1.0, "Exception;Stalled", 1), "4": (0.0, "Stalled", 1), "99": (None, None, None)}
    side = {(r[0], r[1]): json.loads(r[2])["code"] for r in sidecar(processed, "RowId").collect()}
    published_side = spark.read.schema("carrier string, tracking_number string").json(f"{out}/sidecar")
    assert {tuple(r) for r in published_side.collect()} == set(side)
    assert side == {("FDX", "1"): "DE", ("FDX", "2"): "OC", ("FDX", "3"): "DL", ("None", "4"): ""}


def test_job_without_bodies_and_without_key_columns(spark, tmp_path):
    (tmp_path / "in.csv").write_text("X,A\nd,1\n")
    summary = parcelwatch.process_and_publish(
        spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), settings=parcelwatch.Settings(reference_now=NOW)
    )
    r = spark.read.parquet(str(tmp_path / "out" / "processed")).first()
    assert (r["A"], r["CalculatedStatus"], r["DaysSinceLatestEvent"], r["IsStalled"]) == ("1", "", 0, 0)
    assert summary["output_shape"][0] == 1


def test_unreadable_input_gives_an_empty_run(spark, tmp_path):
    (tmp_path / "junk.parquet").write_text("not parquet")
    summary = parcelwatch.process_and_publish(spark, str(tmp_path / "junk.parquet"), str(tmp_path / "out"))
    assert summary["output_shape"][0] == 0
    assert spark.read.parquet(str(tmp_path / "out" / "stalled")).count() == 0


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        parcelwatch.process_and_publish(spark, str(tmp_path / "no.csv"), str(tmp_path / "out"))


def test_seeded_flags_survive(spark, rows):
    df = rows([{"X": "d", "IsDelivered": "1"}, {"X": "d", "IsDelivered": "0"}])
    out = parcelwatch.process_shipments(df, settings=parcelwatch.Settings(reference_now=NOW))
    assert sorted(r["CalculatedStatus"] for r in out.collect()) == ["", "Delivered"]


def test_places_and_splits_do_not_change_results(spark, rows, tmp_path):
    """Two scans with different split sizes: the same order, and lookups that join two scans find the same bodies."""
    docs = [{"trackingNumber": str(i % 40), "code": f"C{i}", "description": "x" * 300} for i in range(400)]
    (tmp_path / "dump.json").write_text(json.dumps(docs, indent=2))
    numbers = rows([{"Tracking Number": str(n)} for n in range(45)])
    found = []
    for size in ("2k", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            read = src_bodies(spark, str(tmp_path / "dump.json"), "indented")
            got = lookup.replay_lookup(numbers, read, BODY_ORDER)
            found.append({r[0]: r[1] for r in got.select("Tracking Number", F.to_json("body")).collect()})
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] and len(found[0]) == 45
    assert all(json.loads(found[0][str(n)])["code"] == f"C{360 + n}" for n in range(40)) and found[0]["44"] == "{}"


def test_a_single_body_that_would_be_cut_is_refused(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"a": {"b": 1}, "c": {"d": 2}}, indent=2))
    for on_corrupt in ("skip", "fail"):
        with pytest.raises(Exception, match="a single body is cut"):
            src_bodies(spark, str(tmp_path / "one.json"), "indented", on_corrupt=on_corrupt).collect()
    assert src_bodies(spark, str(tmp_path / "one.json"), "document").count() == 1
    (tmp_path / "short.json").write_text('{"a": {"b": 1}}')
    assert src_bodies(spark, str(tmp_path / "short.json"), "indented").count() == 1


def test_array_beyond_the_size_of_a_variant(spark, tmp_path):
    """Members are read one by one, so an array may be larger than any single body."""
    member = json.dumps({"trackingNumber": "7", "description": "y" * 4_000_000})
    with open(tmp_path / "large.json", "w") as f:
        f.write("[" + ",".join([member] * 36) + "]")
    assert src_bodies(spark, str(tmp_path / "large.json"), "document", on_corrupt="skip").count() == 36


def test_appended_bodies_keep_their_order(spark, tmp_path):
    bodies = spark.createDataFrame([(i, json.dumps({"trackingNumber": "1", "code": f"C{i}"})) for i in range(200)], "seq int, body string")
    sink_bodies(bodies.repartition(5), str(tmp_path / "dump"), 1, order="seq")
    facts = lookup.replay_facts(read_bodies(spark, str(tmp_path / "dump")), BODY_ORDER)
    assert facts.first()["code"] == "C199"


def test_rows_without_facts_keep_their_times(spark, rows):
    table = rows([{"Tracking Number": "nan", "Carrier Code": "", "ScanEventsCount": "2.7"}, {"Tracking Number": "5", "Carrier Code": "", "ScanEventsCount": "2.7"}])
    table = table.withColumn("ScanEventTimestamps", F.array(F.lit("2024-01-01T00:00:00Z")))
    bodies = spark.createDataFrame([(1, '{"trackingNumber": "6"}')], "pos int, text string").select("pos", F.parse_json("text").alias("body"))
    got = {r["Tracking Number"]: r for r in enrich.enrich(table, lookup.replay_facts(bodies, ["pos"])).collect()}
    assert got["nan"]["ScanEventTimestamps"] == ["2024-01-01T00:00:00Z"] and got["nan"]["ScanEventsCount"] == 2
    assert got["5"]["ScanEventTimestamps"] == [] and got["5"]["ScanEventsCount"] == 0
    assert sidecar(shaping.column_contract(enrich.enrich(table, lookup.replay_facts(bodies, ["pos"]))).withColumn("n", F.lit(1)), "n").count() == 1


def test_snapshot_compares_cleaned_numbers(rows, spark):
    table = rows([{"Tracking Number": " 7 ", "DaysSinceLatestEvent": "3", "CalculatedReasons": "r", "IsStalled": "1", "at": "1"}])
    numbers = spark.createDataFrame([("7",), ("07.0",), ("8",)], "tracking_number string")
    got = {r[0]: r[1] for r in tn_snapshot(table, numbers, "at").collect()}
    assert got == {"7": 3.0, "07.0": 3.0, "8": None}


def test_job_from_responses(spark, rows):
    """Requests, their responses and the job: own results, a whole response, no response, and one that is no object."""
    table = rows([{"X": "", "Tracking Number": str(n), "Carrier Code": "FDX", "derivedCode": "OLD"} for n in range(62)]).withColumn("at", F.monotonically_increasing_id())
    result = {"trackingNumber": "3", "trackResults": [{"latestStatusDetail": {"code": "DL", "statusByLocale": "Delivered"}}]}
    bodies = [(0, json.dumps({"output": {"completeTrackResults": [result]}})), (1, '"busy"')]
    responses = spark.createDataFrame(bodies, "batch bigint, text string").select("batch", F.parse_json("text").alias("body"))
    facts = process.response_facts(table, responses, "at")
    out = {r["Tracking Number"]: r for r in parcelwatch.process_shipments(table, facts, parcelwatch.Settings(date_filter=False, reference_now=NOW)).collect()}
    assert len(out) == 62 and out["3"]["IsDelivered"] == 1
    assert out["40"]["derivedCode"] == "OLD" and out["61"]["derivedCode"] == ""


def test_stages_are_counted(published):
    _, summary = published
    assert list(summary["stage_rows"].values()) == [6, 6, 5, 4]


def test_other_failures_than_unreadable_content_are_raised(spark, tmp_path, monkeypatch):
    (tmp_path / "in.csv").write_text("A\n1\n")
    from pyspark.errors import PySparkException
    from pyspark.sql import DataFrameReader

    def refuse(*_):
        raise PySparkException("access denied")

    monkeypatch.setattr(DataFrameReader, "load", refuse)
    with pytest.raises(PySparkException):
        src_shipments(spark, str(tmp_path / "in.csv"))


@pytest.mark.parametrize("name", ["src_bodies", "process_and_publish", "normalizer", "batch_then_single", "scan_event_count", "published_versions"])
def test_bodies_are_built_once_a_query(spark, monkeypatch, name):
    """What a query reads several times comes from one computation of the bodies, or of the facts."""
    from parcelwatch.plans import fixtures as fx
    from parcelwatch.plans import queries

    built, kept, body_texts, stored = [], [], fx.body_texts, queries.stored
    monkeypatch.setattr(fx, "body_texts", lambda *a: built.append(a) or body_texts(*a))
    monkeypatch.setattr(queries, "stored", lambda df, label: kept.append(label) or stored(df, label))
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len(built) == 1 and kept == ["facts" if name == "published_versions" else "texts"]
    assert "signup" not in plan


def test_bodies_are_made_in_as_many_partitions_as_are_set(spark, tmp_path):
    """Few bytes are shuffled for much work after it, so partitions are not merged by their size."""
    kinds = "element_at(array('signup', 'purchase', 'error', 'view', 'click'), cast(id % 5 + 1 AS int)) AS event_type"
    times = "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id AS int)) AS ts"
    spark.range(6000).selectExpr("id AS event_id", times, "id % 200 AS user_id", kinds).write.parquet(str(tmp_path / "events.parquet"))
    texts = fixtures.body_texts(spark, str(tmp_path))
    assert texts.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    # 160 deep users share 7 groups a capture, 40 flat ones have a body each; two captures hold all users.
    assert texts.groupBy("kind").count().orderBy("kind").collect() == [(0, 14), (1, 80)]
