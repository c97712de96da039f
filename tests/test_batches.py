import json
import random

import pytest
from pyspark.sql import functions as F

from parcelwatch.operators import batches


@pytest.mark.parametrize("size", [30, 7])
def test_request_batches_follow_row_order(spark, size):
    rng = random.Random(5)
    ids = rng.sample(range(-(2**40), 2**40), 120) + [0, 1, -1, 65535, 65536, 2**62, -(2**62), 2**48, 2**32]
    data = [(i, f" {i % 50} " if i % 6 else "nan", "FDX" if i % 3 else None) for i in ids]
    df = spark.createDataFrame(data, "id bigint, `Tracking Number` string, `Carrier Code` string")
    kept = [(i, t.strip(), c) for i, t, c in sorted(data) if t != "nan"]
    carrier = {}
    for _, t, c in kept:
        if c:
            carrier[t] = c
    want = {}
    for at, (_, t, _) in enumerate(kept):
        info = {"trackingNumberInfo": {"trackingNumber": t}}
        if t in carrier:
            info["carrierCode"] = carrier[t]
        want.setdefault(at // size, []).append(info)
    got = {
        r["batch"]: json.loads(r["request"])
        for r in batches.request_batches(df, "id", size).collect()
    }
    assert got == {b: {"trackingInfo": w, "includeDetailedScans": True} for b, w in want.items()}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ranks_of_skewed_and_negative_order_values(spark, adaptive):
    rng = random.Random(7)
    ids = [*range(-1500, 1500), *rng.sample(range(-(2**61), 2**61), 40), 2**63 - 1, -(2**63), *range(2**40, 2**40 + 500)]
    rng.shuffle(ids)
    rows = spark.createDataFrame([(i, f"n{i}") for i in ids], "id bigint, name string")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = batches.global_rank(rows, "id").collect()
        assert batches.global_rank(rows.limit(0), "id").collect() == []
        with pytest.raises(Exception, match="must not be NULL"):
            batches.global_rank(spark.createDataFrame([(1,), (None,)], "id bigint"), "id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert [(r["id"], r["name"], r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(i, f"n{i}", k) for k, i in enumerate(sorted(ids))]


def test_ranks_need_no_window_and_requests_few_exchanges(spark):
    plan = batches.global_rank(spark.range(10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1 == plan.count("BroadcastExchange")
    rows = spark.createDataFrame([(1, "a", "FDX")], "id bigint, `Tracking Number` string, `Carrier Code` string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = batches.request_batches(rows, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Window" not in plan and plan.count("Exchange") <= 4


def cr(tn=None, nested=(), mark="m"):
    out = {"mark": mark, "trackResults": [{"trackingNumberInfo": {"trackingNumber": n}} for n in nested]}
    if tn is not None:
        out["trackingNumber"] = tn
    return out


@pytest.fixture(scope="module")
def responses(spark):
    def build(*docs):
        df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "batch int, text string")
        return df.select("batch", F.parse_json("text").alias("body"))

    return build


def split(df):
    out = batches.split_batch_response(df).select("batch", "tracking_number", F.to_json("payload").alias("p"))
    return {(r[0], r[1]): json.loads(r[2]) for r in out.collect()}


def test_split_responses(responses):
    got = split(
        responses(
            {"output": {"completeTrackResults": [cr(" A ", ["Z"]), cr(None, ["B", "C"]), "junk", cr("A", mark="late")]}},
            {"completeTrackResults": [cr("D")], "output": {"completeTrackResults": [cr("no")]}},
            {"output": {"body": {"x": 1, "data": {"completeTrackResults": [cr("E")]}}}},
            {"response": {"completeTrackResults": "none"}},
            [1],
        )
    )
    assert set(got) == {(0, "A"), (0, "B"), (0, "C"), (1, "D"), (2, "E")}
    assert got[0, "A"] == {"completeTrackResults": [cr("A", mark="late")]}
    assert got[0, "B"] == {"completeTrackResults": [cr(None, ["B", "C"])]}


def test_requested_numbers_get_their_result_the_body_or_nothing(spark, responses):
    body = {"output": {"completeTrackResults": [cr("A")]}, "id": 1}
    requested = spark.createDataFrame([(0, "A"), (0, "Q"), (7, "R")], "batch int, tracking_number string")
    got = batches.batch_result_or_body(requested, responses(body))
    assert {r[0]: json.loads(r[1]) for r in got.select("tracking_number", F.to_json("payload")).collect()} == {
        "A": {"completeTrackResults": [cr("A")]},
        "Q": body,
        "R": {},
    }


def test_a_whole_response_meets_only_numbers_without_a_result(spark, responses):
    """Of 300 numbers of one batch, 298 have a result; the other two get the response, and a batch without a key gets nothing."""
    body = {"output": {"completeTrackResults": [cr(f"N{i}") for i in range(298)]}, "id": 5}
    asked = [(0, f"N{i}") for i in range(300)] + [(None, "N1"), (0, "N299")]
    got = batches.batch_result_or_body(spark.createDataFrame(asked, "batch int, tracking_number string"), responses(body))
    read = {(r[0], r[1]): json.loads(r[2]) for r in got.select("batch", "tracking_number", F.to_json("payload")).collect()}
    assert len(read) == 301 and read[None, "N1"] == {}
    assert sorted(n for (b, n), p in read.items() if p == body) == ["N298", "N299"]
    assert all(read[0, f"N{i}"] == {"completeTrackResults": [cr(f"N{i}")]} for i in range(298))


def test_empty_batch_payload_still_beats_the_replay(spark, rows):
    bodies = spark.createDataFrame(
        [(0, '{"trackingNumber":"A","code":"X"}'), (1, '{"trackingNumber":"B","code":"Y"}')], "pos int, t string"
    ).select("pos", F.parse_json("t").alias("body"))
    payloads = spark.createDataFrame(
        [(0, "A", '{"old":1}'), (1, "A", "{}")], "batch int, tracking_number string, t string"
    ).select("batch", "tracking_number", F.parse_json("t").alias("payload"))
    df = rows([{"Tracking Number": n} for n in ("A", "A ", "B", "C", None)])
    got = batches.batch_then_single(df, payloads, bodies, ["pos"])
    assert {r[0]: json.loads(r[1]) for r in got.select("tracking_number", F.to_json("body")).collect()} == {
        "A": {},
        "B": {"trackingNumber": "B", "code": "Y"},
        "C": {},
    }


def test_number_to_unwrapped_body(spark):
    docs = [
        {"output": {"completeTrackResults": [cr("A"), cr(None, ["N"])], "v": 1}},
        {"body": {"completeTrackResults": [cr(" A "), cr("B")], "v": 2}},
        {"completeTrackResults": [], "trackingNumber": "C"},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "pos int, t string")
    mapped = batches.map_number_to_body(df.select("pos", F.parse_json("t").alias("body")), ["pos"])
    got = {r[0]: json.loads(r[1])["v"] for r in mapped.select("tracking_number", F.to_json("body")).collect()}
    assert got == {"A": 2, "B": 2}
