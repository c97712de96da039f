"""Arrays of bodies cut into members by many tasks, and what damage costs."""

import json
import random

import pytest

from parcelwatch.sources.blocks import salvaged
from parcelwatch.sources.bodies import BODY_ORDER, quarantined_bodies, src_bodies


def docs_of(df):
    from pyspark.sql import functions as F

    return [json.loads(r.b) for r in df.orderBy(*BODY_ORDER).select(F.to_json("body").alias("b")).collect()]


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "10b"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def odd_bodies(n, seed=1):
    rnd = random.Random(seed)
    text = lambda: "".join(rnd.choice(['"', "\\", "},{", "[", "]", "é", "漢", "\n", ",", "a b", "{}"]) for _ in range(rnd.randint(0, 12)))
    return [{"id": i, "t": text(), "l": [{"x": text()}, [], {}, [1, {"y": [text()]}]]} if i % 5 else [text(), i, None][i % 3] for i in range(1, n)]


@pytest.mark.parametrize("style", [{"separators": (",", ":")}, {}, {"indent": 2}, {"indent": 1, "ensure_ascii": False}, {"ensure_ascii": False}])
def test_arrays_of_any_format_are_split(spark, tmp_path, small_blocks, style):
    want = [x for x in odd_bodies(120) if x is not None]
    for head, tail in (("", ""), ("﻿ \n", " \n")):
        (tmp_path / "dump.json").write_text(head + json.dumps(want, **style) + tail)
        df = src_bodies(spark, str(tmp_path / "dump.json"))
        assert docs_of(df) == want
        assert df.select("block").distinct().count() > 8  # read by many tasks
        assert docs_of(src_bodies(spark, str(tmp_path / "dump.json"), on_corrupt="skip")) == want


def test_bodies_larger_than_a_block(spark, tmp_path, small_blocks):
    want = [{"n": i, "text": "x},{" * 700 if i % 7 == 3 else "s"} for i in range(40)]
    (tmp_path / "dump.json").write_text(json.dumps(want))
    assert docs_of(src_bodies(spark, str(tmp_path / "dump.json"))) == want
    (tmp_path / "one.json").write_text(json.dumps(want[3]))
    assert docs_of(src_bodies(spark, str(tmp_path / "one.json"))) == [want[3]]
    assert len(docs_of(src_bodies(spark, str(tmp_path)))) == 41


@pytest.mark.parametrize("text, want", [("[]", []), ("", []), (" \n", []), ("[ ]\n", []), ("{}", [{}]), ("[[]]", [[]]), ("[1,2]", [1, 2]), ('"a"', ["a"]), ("[{},[{}]]", [{}, [{}]])])
def test_short_files(spark, tmp_path, text, want):
    (tmp_path / "f.json").write_text(text)
    assert docs_of(src_bodies(spark, str(tmp_path / "f.json"))) == want
    assert quarantined_bodies(spark, str(tmp_path / "f.json")).count() == 0


DAMAGE = [
    ('[{"a":1},{"a":2},{"a":tru},{"a":4}]', [1, 2, 4], [('{"a":tru}', "not json", 17)]),
    ('[{"a":1},{"a":2},{"a":', [1, 2], [('{"a":', "truncated", 17)]),
    ('[{"a":1},{"a":2}', [1, 2], []),
    ('[{"a":1},{"a":"x},{"a":3},{"a":4}]', [1, 3, 4], [('{"a":"x}', "not json", 9)]),
    ('[{"a":1},{"a":{"b":1},{"a":3}]', [1, 3], [('{"a":{"b":1}', "not json", 9)]),
    ('[{"a":1},{"l":[{"a":5},{"a":tru},{"a":6}]},{"a":3}]', [1, 3], [('{"l":[{"a":5},{"a":tru},{"a":6}]}', "not json", 9)]),
    ('[{"a":1},,{"a":3}]', [1, 3], [("", "not json", 9)]),
    ('{"a":', [], [('{"a":', "not json", 0)]),
]


@pytest.mark.parametrize("text, want, lost", DAMAGE)
def test_damage_costs_what_it_touches(spark, tmp_path, text, want, lost):
    (tmp_path / "f.json").write_text(text)
    assert [d["a"] for d in docs_of(src_bodies(spark, str(tmp_path / "f.json"), on_corrupt="skip"))] == want
    bad = quarantined_bodies(spark, str(tmp_path / "f.json")).orderBy("offset").collect()
    assert [(r.text, r.cause, r.offset) for r in bad] == lost and all(r.length == len(r.text) for r in bad)
    with pytest.raises(Exception):  # noqa: B017
        src_bodies(spark, str(tmp_path / "f.json")).collect()


@pytest.mark.parametrize("harm", ['"', "{", "}", "[", "tru"])
def test_damage_in_a_large_file_stays_local(spark, tmp_path, small_blocks, harm):
    good = [{"n": i, "l": [{"v": "some text " * 3}, {"v": i}]} for i in range(160)]
    parts = [json.dumps(g, separators=(",", ":")) for g in good]
    parts[90] = parts[90].replace('"v":90', f'"v":{harm}90')
    (tmp_path / "f.json").write_text("[" + ",".join(parts) + "]")
    got = [d["n"] for d in docs_of(src_bodies(spark, str(tmp_path / "f.json"), on_corrupt="skip")) if isinstance(d, dict) and "n" in d]
    assert got == [i for i in range(160) if i != 90]
    bad = quarantined_bodies(spark, str(tmp_path / "f.json")).collect()
    assert any(r.text.startswith('{"n":90,') for r in bad) and sum(r.length for r in bad) < 400


def test_salvage_is_linear():
    import time

    def seconds(n):
        text = b'{"a":"x},' + b",".join(b'{"a":%d,"b":[{},{}]}' % i for i in range(n))
        start = time.perf_counter()
        assert sum(ok for _, _, ok in salvaged(text)) == n
        return time.perf_counter() - start

    seconds(100)
    assert seconds(8000) < 40 * max(seconds(1000), 0.005)
