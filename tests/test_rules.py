import itertools
import json

import pytest
from pyspark.sql import functions as F

from parcelwatch.operators import indicators, labels
from parcelwatch.schema import FLAGS


def flags(df, **options):
    return [r.asDict() for r in indicators.apply_indicators(df, **options).collect()]


CODE_FLAGS = {
    "OC": "IsPreTransit",
    "dl": "IsDelivered",
    "De": "HasException",
    "EX": "HasException",
    "rs": "IsRTS",
    "RTS": "IsRTS",
    "LP": None,
    "": None,
}


def test_each_code_sets_its_flag_and_no_other(rows):
    got = flags(rows([{"code": c, "statusByLocale": "on its way", "DaysSinceLatestEvent": "0"} for c in CODE_FLAGS]))
    for row, flag in zip(got, CODE_FLAGS.values(), strict=True):
        assert [f for f in FLAGS if row[f]] == ([flag] if flag else [])


@pytest.mark.parametrize("column", ["statusByLocale", "description"])
@pytest.mark.parametrize("text, hit", [("customs exception, held", 1), ("box was DAMAGED by water", 1), ("Unable To Deliver: no gate code", 1), ("damage", 0), ("unable  to deliver", 0)])
def test_exception_texts(rows, column, text, hit):
    assert flags(rows([{"code": "HL", column: text}]))[0]["HasException"] == hit


def test_stalled_over_all_flags(rows):
    """Idle days around two limits beside every combination of the flags that may hold it back."""
    marks = ("IsDelivered", "HasException", "IsRTS")
    cases = [(d, on) for d in ("1", "2", "6", "7", "8.9", None, "?") for on in itertools.product("01", repeat=3)]
    df = rows([{"DaysSinceLatestEvent": d, **dict(zip(marks, on, strict=True))} for d, on in cases])
    for limit in (2, 7):
        want = [int(d in {2: ("2", "6", "7", "8.9"), 7: ("7", "8.9")}[limit] and on[0] == on[2] == "0") for d, on in cases]
        assert [r["IsStalled"] for r in flags(df, threshold_days=limit)] == want


def test_no_scans_is_stalled_only_where_scans_are_counted(rows):
    df = rows([{"derivedCode": "IT", "ScanEventsCount": "0", "DaysSinceLatestEvent": "0"}])
    assert flags(df)[0]["IsStalled"] == 1
    assert flags(df.drop("ScanEventsCount"))[0]["IsStalled"] == 0
    assert flags(df.withColumn("derivedCode", F.lit("OC")))[0]["IsStalled"] == 0


def test_texts_do_not_make_pretransit_or_delivered(rows):
    df = rows([{"code": "DLV", "statusByLocale": "Delivered; label created"}])
    assert flags(df)[0]["IsPreTransit"] == 0 and flags(df)[0]["IsDelivered"] == 0


def test_blank_derived_code_hides_code(rows):
    df = rows([{"code": "DL", "derivedCode": ""}])
    assert flags(df)[0]["IsDelivered"] == 0
    assert flags(df.drop("derivedCode"))[0]["IsDelivered"] == 1


@pytest.mark.parametrize(
    "text, hit",
    [
        ("Returning package to shipper", 1),
        ("return to sender", 1),
        ("RETURN TO SHIPPER", 1),
        ("Returned to sender", 0),
        ("prereturn to sender", 0),
        ("return to senders", 0),
        ("return  to sender", 0),
    ],
)
def test_return_texts(rows, text, hit):
    assert flags(rows([{"description": text}]))[0]["IsRTS"] == hit


DETAIL = {
    "code": "HL",
    "ancillaryDetails": [
        {"reason": "B7", "reasonDescription": "Crate damaged by forklift", "action": "Send photos", "actionDescription": "Claim opened"},
        7,
        {"reason": 0, "action": None, "reasonDescription": ""},
        {"actionDescription": "Repack"},
    ],
}
TEXT = "crate damaged by forklift claim opened b7 send photos repack"


def test_damage_reads_ancillary_text_only(rows):
    base = {"derivedCode": "EX", "statusByLocale": "held back", "description": "looks damaged"}
    assert flags(rows([base]))[0]["Damaged"] == 0
    assert flags(rows([{**base, "latestStatusDetail": json.dumps(DETAIL)}]))[0]["Damaged"] == 1
    raw = {"output": {"completeTrackResults": [{"trackResults": [{"latestStatusDetail": DETAIL}]}]}}
    assert flags(rows([{**base, "raw": json.dumps(raw)}]))[0]["Damaged"] == 1
    ready = {**base, "latestStatusDetail": json.dumps(DETAIL), "LatestAncillaryText": ""}
    assert flags(rows([ready]))[0]["Damaged"] == 0


def test_ancillary_series_order_and_blanks(rows):
    df = rows([{"latestStatusDetail": json.dumps(DETAIL)}, {"latestStatusDetail": "[]"}, {"latestStatusDetail": None}])
    assert [r[0] for r in df.select(indicators.ancillary_series(df)).collect()] == [TEXT, "", ""]
    parsed = df.select(F.parse_json("latestStatusDetail").alias("latestStatusDetail"))
    assert parsed.select(indicators.ancillary_series(parsed)).first()[0] == TEXT


def test_unable_to_deliver(rows):
    df = rows(
        [
            {"derivedCode": "EX", "statusByLocale": "2nd try: UNABLE TO DELIVER", "LatestAncillaryText": None},
            {"derivedCode": "EX", "statusByLocale": "held", "LatestAncillaryText": "gate shut,\nunable\tto  deliver"},
            {"derivedCode": "HL", "statusByLocale": "held", "LatestAncillaryText": "unable to deliver"},
            {"derivedCode": "EX", "statusByLocale": "held", "LatestAncillaryText": "unable to redeliver"},
        ]
    )
    assert [r["UnableToDeliver"] for r in flags(df)] == [1, 1, 0, 0]


def test_labels_over_all_flags(spark):
    """Every combination of the five flags against the order of precedence."""
    names = {"IsPreTransit": "PreTransit", "IsDelivered": "Delivered", "HasException": "Exception", "IsRTS": "ReturnedToSender", "IsStalled": "Stalled"}
    cases = list(itertools.product((0, 1), repeat=len(names)))
    out = labels.apply_labels(spark.createDataFrame(cases, ", ".join(f"{n} int" for n in names)))
    assert out.count() == 32
    for r in out.collect():
        on = [f for f in names if r[f]]
        if "IsDelivered" in on and "HasException" in on and "IsRTS" not in on:
            want = "DeliveredWithIssue"
        else:
            order = ("IsRTS", "IsDelivered", "HasException", "IsStalled", "IsPreTransit")
            want = next((names[f] for f in order if f in on), "")
        assert (r["CalculatedStatus"], r["CalculatedReasons"]) == (want, ";".join(names[f] for f in on))


def test_label_falls_back_to_existing_and_needs_exact_zero(rows):
    df = rows([{"IsRTS": "0", "CalculatedStatus": "old"}, {"IsRTS": "2", "IsDelivered": "1", "CalculatedStatus": "old"}])
    assert [r["CalculatedStatus"] for r in labels.apply_labels(df).collect()] == ["old", "old"]


CLASSES = (
    ("Delivered", labels.DELIVERED_CODES, labels.DELIVERED_HINTS),
    ("Exception", labels.EXCEPTION_CODES, labels.EXCEPTION_HINTS),
    ("PreTransit", labels.PRETRANSIT_CODES, labels.PRETRANSIT_HINTS),
)


def test_classifier_knows_every_code_and_hint(rows):
    cases = []
    for status, codes, hints in CLASSES:
        cases += [({c: code.lower()}, status) for code in codes for c in ("code", "derivedCode")]
        cases += [({c: f"~{hint.upper()}~"}, status) for hint in hints for c in ("statusByLocale", "description")]
    cases += [({"code": "HL", "description": "nothing known"}, ""), ({"code": "DEL", "CalculatedStatus": "mine"}, "mine")]
    fields = ("code", "derivedCode", "statusByLocale", "description", "CalculatedStatus")
    df = rows([{f: c.get(f) for f in fields} for c, _ in cases])
    assert [r["CalculatedStatus"] for r in labels.classify_status(df).collect()] == [s for _, s in cases]


def test_classifier_prefers_delivered_then_exception(rows):
    signs = {status: hints[-1] for status, _, hints in CLASSES}
    for some in itertools.chain.from_iterable(itertools.combinations(signs, k) for k in (2, 3)):
        text = " / ".join(signs[s] for s in reversed(some))
        assert labels.classify_status(rows([{"description": text}])).first()["CalculatedStatus"] == some[0]
