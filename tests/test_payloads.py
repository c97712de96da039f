"""Bodies of every shape, including broken ones, through both ways of reading them."""

import json

import pytest
from pyspark.sql import functions as F

from parcelwatch.functions import payload as P
from parcelwatch.operators import enrich, lookup

STATUS = ("code", "derivedCode", "statusByLocale", "description")


def result(tn=None, nested=(), **track):
    out = {"trackResults": [{"trackingNumberInfo": {"trackingNumber": n}} for n in nested] or [{}]}
    out["trackResults"][0].update(track)
    if tn is not None:
        out["trackingNumber"] = tn
    return out


def wrapped(*results, **top):
    return {"output": {"completeTrackResults": list(results)}, **top}


def bare(*results, **top):
    return {"completeTrackResults": list(results), **top}


def detail(code, status="", description="", **more):
    return {"code": code, "statusByLocale": status, "description": description, **more}


@pytest.fixture(scope="module")
def bodies(spark):
    def build(*docs):
        texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
        df = spark.createDataFrame(list(enumerate(texts)), "pos int, text string")
        return df.select("pos", F.parse_json("text").alias("body"))

    return build


def facts(df, **options):
    got = {r["tracking_number"]: r.asDict() for r in lookup.replay_facts(df, ["pos"], **options).collect()}
    # The pair form must agree with the bulk form for every number.
    index = lookup.replay_index(df, ["pos"])
    pairs = index.join(df, "pos").select("tracking_number", "body")
    other = {r["tracking_number"]: r.asDict() for r in lookup.payload_facts(pairs, **options).collect()}
    unpadded = {k: v for k, v in other.items() if k.strip() == k}
    assert got == unpadded
    return got


def status(fact):
    return tuple(fact[f] for f in STATUS)


def test_status_from_each_place_of_a_body(bodies):
    """The same four values in the flat fields, in a detail and in a scan event; none at all in an error body."""
    words = ("P9", "Q9", "gone to hub", "by night train")
    scan = {"eventType": words[0], "derivedStatusCode": words[1], "derivedStatus": words[2], "eventDescription": words[3]}
    got = facts(
        bodies(
            {"trackingNumber": "flat", "code": words[0], "derivedCode": words[1], "statusByLocale": words[2], "description": words[3]},
            bare(result("deep", latestStatusDetail=detail(words[0], words[2], words[3], derivedCode=words[1]))),
            {"tracking_number": "scan", "scanEvents": [{**scan, "date": "2024-07-01T23:30:00+02:00"}, {"date": "2024-06-30"}]},
            {"trackingNumber": "none", "error": {"code": "GONE"}},
        )
    )
    assert status(got["flat"]) == status(got["deep"]) == words
    assert status(got["scan"])[1:] == words[1:]
    assert got["scan"]["scan_count"] == 2 and got["scan"]["latest_ts"] == "2024-07-01T21:30:00Z"
    assert status(got["none"]) == ("", "", "", "") and got["none"]["readable"]


def test_latest_time_is_the_maximum_over_scans_and_announcements(bodies):
    scans = ["2024-02-29T10:00:00+05:30", "2024-02-29T04:30:00.250Z", "", "2024-02-28"]
    told = [{"type": "EST", "dateTime": "2024-02-29T00:00:00-04:00"}, 3, {"type": "PU"}, {"dateTime": []}]
    body = wrapped(result("T", latestStatusDetail=detail("HB"), scanEvents=[{"date": d} for d in scans], dateAndTimes=told))
    fact = facts(bodies(body))["T"]
    assert fact["latest_ts"] == "2024-02-29T04:30:00.250000Z"
    assert fact["scan_times"] == [d for d in scans if "T" in d] and fact["scan_count"] == 4
    later = {**told[0], "dateTime": "2024-02-29T00:45:00-04:00"}
    body["output"]["completeTrackResults"][0]["trackResults"][0]["dateAndTimes"].append(later)
    assert facts(bodies(body))["T"]["latest_ts"] == "2024-02-29T04:45:00Z"


def test_each_number_reads_its_own_result_of_a_batch(bodies):
    got = facts(
        bodies(
            wrapped(
                result("A", latestStatusDetail=detail("OC"), scanEvents=[{"date": "2025-01-01"}]),
                result(None, ["B"], latestStatusDetail=detail("DL"), scanEvents=[{}, {}]),
                result("C", scanEvents=[{"eventType": "PU", "eventDescription": "Picked up"}]),
                scanEvents=[{"date": "2030-01-01", "eventType": "TOP"}],
                code="FLAT",
            )
        )
    )
    assert status(got["A"])[0] == "OC" and got["A"]["latest_ts"] == "2025-01-01T00:00:00Z"
    assert status(got["B"])[0] == "DL" and got["B"]["scan_count"] == 2
    assert status(got["C"]) == ("PU", "PU", "Picked up", "Picked up")


def test_single_result_body_is_read_whole_for_the_status_only(bodies):
    got = facts(
        bodies(
            wrapped(result("A"), code="DLV", statusByLocale="Delivered"),
            wrapped(
                result("B", scanEvents=[{"eventType": "IN"}]),
                scanEvents=[{"eventType": "TOP", "date": "2030-01-01"}],
            ),
        )
    )
    assert status(got["A"])[0] == "DLV"
    # The top-level scan gives the status, but time and count are those of the result.
    assert status(got["B"])[0] == "TOP"
    assert got["B"]["latest_ts"] == "" and got["B"]["scan_count"] == 1


def test_number_that_no_result_matches_reads_the_whole_body(bodies):
    body = wrapped(
        {"trackResults": [{"trackingNumber": "N", "latestStatusDetail": detail("AA")}]},
        result("M", latestStatusDetail=detail("BB"), scanEvents=[{"date": "2025-05-05"}]),
        dateAndTimes=[{"dateTime": "2025-06-06"}],
    )
    got = facts(bodies(body))
    assert status(got["N"])[0] == "AA" and got["N"]["latest_ts"] == "2025-06-06T00:00:00Z"
    assert got["N"]["scan_count"] == 1
    assert status(got["M"])[0] == "BB" and got["M"]["latest_ts"] == "2025-05-05T00:00:00Z"


def test_whole_body_status_from_a_later_results_scans(bodies):
    body = wrapped(
        {"trackResults": [{"trackingNumber": "N"}]},
        result("M", latestStatusDetail=detail("BB"), scanEvents=[{"eventType": "SC"}]),
    )
    assert status(facts(bodies(body))["N"])[0] == "SC"


def test_last_body_wins_and_first_matching_result_in_it(bodies):
    got = facts(
        bodies(
            wrapped(result("A", latestStatusDetail=detail("OLD")), result("B", latestStatusDetail=detail("KEEP"))),
            wrapped(
                result("X"),
                result("A", latestStatusDetail=detail("NEW")),
                result("A", latestStatusDetail=detail("LATER")),
            ),
        )
    )
    assert status(got["A"])[0] == "NEW" and status(got["B"])[0] == "KEEP"


def test_padded_numbers(bodies):
    df = bodies(
        wrapped(
            result(" P ", latestStatusDetail=detail("PAD"), scanEvents=[{}]),
            result("P", latestStatusDetail=detail("EXACT"), scanEvents=[{}, {}]),
            result(" Q ", latestStatusDetail=detail("ONLY")),
        )
    )
    got = facts(df)
    # Status compares as written, the rest compares stripped and so meets the padded one first.
    assert status(got["P"])[0] == "EXACT" and got["P"]["scan_count"] == 1
    assert "Q" not in got


def test_output_key_hides_a_top_level_list(bodies):
    inner = result("A", latestStatusDetail=detail("IN"))
    got = facts(
        bodies(
            {"output": "text", "completeTrackResults": [inner], "code": "TOP"},
            {"output": None, "completeTrackResults": [result("B", latestStatusDetail=detail("IN"))]},
        )
    )
    assert status(got["A"])[0] == "TOP" and status(got["B"])[0] == ""


def test_values_of_the_wrong_type(bodies):
    got = facts(
        bodies(
            wrapped(result("A", latestStatusDetail="text", scanEvents={"date": "x"}, dateAndTimes=7)),
            wrapped(result("B", latestStatusDetail=detail(0, False, [], derivedCode={}))),
            wrapped(result("C", latestStatusDetail=detail("0", "false"), scanEvents=[7, None, "x"])),
            wrapped({"trackingNumber": "D", "trackResults": "none"}, "junk", None, code="X"),
            wrapped({"trackingNumber": 123, "trackResults": [{"latestStatusDetail": detail("N")}]}),
        )
    )
    assert status(got["A"]) == ("", "", "", "") and got["A"]["detail"] == "{}"
    assert status(got["B"]) == ("", "", "", "")
    assert status(got["C"])[:3] == ("0", "0", "false") and got["C"]["scan_count"] == 3
    assert got["D"]["readable"]
    assert status(got["123"])[0] == "N"


def test_unreadable_bodies(bodies):
    got = facts(
        bodies(
            [{"trackingNumber": "L"}],
            {"completeTrackResults": ["junk"], "trackingNumber": "J"},
            wrapped({"trackingNumber": "K", "trackResults": ["junk"]}),
            "5",
        )
    )
    assert {k: v["readable"] for k, v in got.items()} == {"L": False, "J": False, "K": False}


def test_numbers_are_found_anywhere_when_no_result_has_one(bodies):
    df = bodies(
        {"a": [{"b": {"tracking_number": 'q"\\u00e9\\\\'}}], "note": 'the "trackingNumber":"no" text', "trackingNumber": 5},
        {"output": {"completeTrackResults": []}, "trackingNumber": " "},
    )
    got = [r["tracking_number"] for r in lookup.body_numbers(df, ["pos"]).collect()]
    assert got == ['q"\\u00e9\\\\']


def test_ancillary_text_and_detail(bodies):
    lsd = detail(
        "DE",
        ancillaryDetails=[
            {"action": "A", "reason": "039", "reasonDescription": "Damaged", "actionDescription": "AD"},
            None,
            {"reason": 0},
        ],
    )
    fact = facts(bodies(wrapped(result("A", latestStatusDetail=lsd))))["A"]
    assert fact["ancillary"] == "Damaged AD 039 A"
    assert json.loads(fact["detail"]) == lsd


def test_literal_scan_count(bodies):
    df = bodies(
        wrapped(result("A", scanEvents=[{}, {}])),
        {"trackingNumber": "T", "scanEvents": [{"date": "2025-01-01T00"}]},
        bare({"trackResults": [{"trackingNumber": "U", "scanEvents": [{}]}]}),
    )
    got = {k: v["scan_count"] for k, v in facts(df, reference_scan_count=True).items()}
    assert got == {"A": 0, "T": 1, "U": 1}
    assert {k: v["scan_count"] for k, v in facts(df).items()} == {"A": 2, "T": 1, "U": 1}


# ---- lookup and enrichment -----------------------------------------------------------


def test_lookup_hits_and_misses(bodies, rows):
    a = wrapped(result("K-77"))
    b = {"trackingNumber": "0042", "code": "DL"}
    keys = rows([{"Tracking Number": n} for n in ("K-77", " 0042 ", "absent", "nan")])
    got = lookup.replay_lookup(keys, bodies(a, b), ["pos"]).select(
        "Tracking Number", "found", F.to_json("body").alias("b")
    )
    found = {r[0]: (r[1], r[2] and json.loads(r[2])) for r in got.collect()}
    assert found == {"K-77": (True, a), " 0042 ": (True, b), "absent": (False, {}), "nan": (None, None)}


def test_enrich_without_key_columns_is_a_no_op(bodies, rows):
    df = rows([{"A": "1"}])
    assert enrich.enrich(df, lookup.replay_facts(bodies({}), ["pos"])).columns == ["A"]
    assert enrich.enrich(df, None).columns == ["A"]


def test_enrich_overwrites_with_blanks_but_keeps_unmatched_rows(bodies, rows):
    facts_df = lookup.replay_facts(
        bodies({"trackingNumber": "1", "code": "DLV"}, wrapped({"trackingNumber": "2", "trackResults": ["junk"]})),
        ["pos"],
    )
    df = rows(
        [
            {"Tracking Number": n, "Carrier Code": "FDX", "code": "old", "LatestEventTimestampUtc": "2025-01-01"}
            for n in (" 1", "2", "3", "none")
        ]
    )
    got = {r["Tracking Number"]: r for r in enrich.enrich(df, facts_df).collect()}
    assert {k: r["code"] for k, r in got.items()} == {" 1": "DLV", "2": "old", "3": "", "none": "old"}
    assert all(r["LatestEventTimestampUtc"] == "2025-01-01" for r in got.values())
    assert all(r["ScanEventsCount"] == 0 and r["ScanEventTimestamps"] == [] for r in got.values())
    assert got["3"]["latestStatusDetail"] == "{}" and got["none"]["latestStatusDetail"] is None


def test_enrich_keeps_row_multiplicity_under_repeated_and_blank_keys(bodies, spark):
    facts_df = lookup.replay_facts(bodies({"trackingNumber": "1", "code": "DL"}), ["pos"])
    df = spark.range(3000).select(
        F.expr("CASE id % 3 WHEN 0 THEN '1' WHEN 1 THEN NULL ELSE string(id) END").alias("Tracking Number"),
        F.lit("FDX").alias("Carrier Code"),
        "id",
    )
    out = enrich.enrich(df, facts_df)
    assert out.count() == 3000 and out.filter("code = 'DL'").count() == 1000


def test_custom_normalizer_writes_its_own_columns(bodies, rows):
    pairs = bodies({"trackingNumber": "1", "x": "hello"}).select(F.lit("1").alias("tracking_number"), "body")
    facts_df = lookup.payload_facts(
        pairs, normalizer=lambda df: {"code": F.expr("try_variant_get(raw, '$.x', 'string')"), "extra": F.lit("e")}
    )
    r = enrich.enrich(rows([{"Tracking Number": "1", "Carrier Code": None}]), facts_df).first()
    assert (r["code"], r["extra"]) == ("hello", "e")


def _all_places(df):
    return {**{f"{p}_{f}": F.col(f"{p}_status.{f}") for p in ("detail", "scan", "flat") for f in STATUS}, "more": F.concat("detail", F.lit("|"), "ancillary")}


def test_normalizer_sees_the_same_in_digests_and_in_pairs(bodies):
    scan = {"eventType": "AR", "eventDescription": "at hub", "date": "2024-01-05T08:00:00Z"}
    df = bodies(
        wrapped(result("10", latestStatusDetail=detail("D1", "on its way")), result("11", scanEvents=[scan])),
        wrapped(result("20", scanEvents=[scan]), code="T2", statusByLocale="top"),
        bare(result("30", nested=["31"], latestStatusDetail=detail("", "", "only words"))),
        {"trackingNumber": "40", "code": "F4", "scanEvents": [scan]},
        wrapped(result(" 50 ", latestStatusDetail=detail("D5", ancillaryDetails=[{"reason": "r5"}])), result("50")),
        wrapped(None, result("60"), result("61", latestStatusDetail=detail("D6"))),
        wrapped(result("10", latestStatusDetail=detail("D7")), result("10", scanEvents=[scan])),
    )
    got = facts(df, normalizer=_all_places)
    assert (got["10"]["detail_code"], got["11"]["scan_code"], got["40"]["flat_code"], got["61"]["detail_code"]) == ("D7", "AR", "F4", "D6")
    assert (got["20"]["scan_code"], got["20"]["flat_statusByLocale"], got["11"]["flat_code"]) == ("AR", "top", "")


def test_no_document_travels_for_a_normalizer(bodies):
    df = lookup.replay_facts(bodies({"trackingNumber": "1", "code": "DL"}), ["pos"], normalizer=_all_places)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "MapIn" not in plan
    kinds = {f.dataType.simpleString() for f in df.schema}
    assert "variant" not in kinds and df.first()["flat_code"] == "DL"


def test_normalized_record(bodies):
    pairs = bodies({"code": "DL", "statusByLocale": "Delivered"}).select(F.lit("9").alias("tracking_number"), "body")
    scoped = lookup.scope_to_number(pairs).withColumn("s", lookup.normalize_status())
    rec = scoped.select(enrich.normalized_record(scoped, F.col("s"), F.lit("FDX")).alias("r"))
    r = rec.select("r.*").drop("raw").first().asDict()
    assert len(r) == 18 and r["carrier"] == "FedEx" and r["derivedCode"] == "DL" and r["possession_status"] is False
    cols = enrich.status_columns(F.struct(F.lit("C").alias("code"), F.lit("").alias("derivedCode"), F.lit(None).cast("string").alias("statusByLocale"), F.lit("d").alias("description")))
    assert tuple(pairs.select(*(c.alias(n) for n, c in cols.items())).first()) == ("C", "C", "", "d")


def test_carrier_map(rows):
    df = rows(
        [
            {"o": "1", "Tracking Number": "A", "Carrier Code": "X"},
            {"o": "2", "Tracking Number": " A ", "Carrier Code": " Y "},
            {"o": "3", "Tracking Number": "A", "Carrier Code": "nan"},
            {"o": "4", "Tracking Number": "B", "Carrier Code": None},
            {"o": "5", "Tracking Number": "none", "Carrier Code": "Z"},
        ]
    )
    got = {r[0]: r[1] for r in lookup.carrier_map(df, "o").collect()}
    assert got == {"A": "Y", "B": None}


def test_hot_number_is_split_by_the_adaptive_join(bodies, spark):
    """A number with a third of all rows, and as many blank ones, must not make one big task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts_df = lookup.replay_facts(bodies({"trackingNumber": "1", "code": "DL"}), ["pos"])
        df = spark.range(0, 120000, 1, 8).select(
            F.expr("CASE id % 3 WHEN 0 THEN '1' WHEN 1 THEN NULL ELSE string(id) END").alias("Tracking Number"),
            F.lit("FDX").alias("Carrier Code"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        out = enrich.enrich(df, facts_df)
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert out.filter("code = 'DL'").count() == 40000
        # Without splitting, the hot number alone would fill one partition with 40,000 rows.
        assert max(r["count"] for r in sizes) < 25000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_wrapper_and_status_fields_are_read_once_a_body(bodies):
    """Each mention in the plan is a reading of the VARIANT: the wrapper has two, a detail one for all its texts."""
    told = detail(False, "0", [], derivedCode="", ancillaryDetails=[{"reason": 0, "action": "false"}, "hold", {"reason": None}])
    df = P.with_digests(bodies(wrapped(result("A", latestStatusDetail=told), result("B", latestStatusDetail="lost")), {"output": None}))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("$.output,") == 2
    assert plan.count("$.derivedCode,") == 1
    first, second = sorted(df.collect(), key=lambda r: r["pos"])
    assert tuple(first["digests"][0]["detail_status"]) == ("", "", "0", "") and first["digests"][0]["ancillary"] == "false"
    assert tuple(first["digests"][1]["detail_status"]) == ("", "", "", "") and first["digests"][1]["detail"] == "{}"
    assert first["wrapped"] and second["wrapped"] and second["digests"] == []
