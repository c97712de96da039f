"""Operators 4, 5 and 9 against plain Python."""

import hashlib
import random
import re
import time

import duckdb
import pytest

from parcelwatch.llm import license_scan, secret_links, template_leaks
from parcelwatch.llm.queries import ORACLES

BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text):
            if (kind == "assign" and len(m[2]) >= 8) or (kind == "access" and len(m[0]) >= 16) or (kind == "hex" and len(m[0]) >= 32):
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(out))


def test_base_spans_of_random_texts(spark):
    rnd = random.Random(11)
    bits = ["password", "Token", "api_key", "APIKEY", "=", " = ", ":", '"', "'", "abc", "hunter2hunter2", "AKIA", "AKIA0123456789ABCD", "0123456789abcdef" * 2, "é", "😀", " ", "\n", "x", "secret=token : abcdefgh1", "-_.", "K"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in secret_links.secret_report(docs).collect()}
    for i, text in rows:
        want = base_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), repr(text)
        kinds = [w.split(":")[0] for w in want.split(",")]
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert [s for s in got[i].spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")] == [w for w in want.split(",") if w] or not want


def test_weak_parts_count_only_together(spark):
    ident, value, url = "client_id=webshop", "Zk3" * 14, "https://host.example/x"
    far = " filler" * 60
    rows = [
        (1, ident), (2, value), (3, url), (4, f"{ident} {value}"), (5, f"{ident} {value} {url}"), (6, f"{url} {ident}"),
        (7, f"{ident}{far}{value}"), (8, f"AKIA0123456789ABCD {value}"), (9, f"password=abcdefgh9 {url}"), (10, f"password=abcdefgh9 {url} {ident}"),
        (11, f"[a]\n{ident}\n[b]\n{value}"), (12, f"[a]\n{ident}\n\n;{far}\n\n{value}\n[b]\n{url}"), (13, f"{ident}\n\n{far}\n\n{value}"),
        (14, f"{ident}\n\n{value}"), (15, f"{{\n{ident}{far}\n}}\n{{\n{value}\n}}"), (16, f"{far}\n---\n{ident}\nmore\n{url}\n{value}\n---\n{url}"),
        (17, f'["x"]\n{ident}\n["y"]\n{value}'), (18, f"  [[t.a]]  \r\n[b]\n{ident}\n{value}\n[c]"),
    ]
    got = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in secret_links.secret_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    both = ["ident", "value"]
    assert got == {
        1: [], 2: [], 3: [], 4: both, 5: [*both, "endpoint"], 6: [], 7: both, 8: ["access", "value"], 9: ["assign"], 10: ["assign", "endpoint", "ident"],
        11: [], 12: both, 13: [], 14: both, 15: [], 16: ["ident", "endpoint", "value"], 17: both, 18: both,
    }


def scopes(text, short):
    """The ends of scopes, line by line."""
    lines, at, starts = text.split("\n"), 0, []
    for line in lines:
        starts.append((at, line))
        at += len(line) + 1
    heads = [at for at, line in starts if re.fullmatch(r"[ \t]*\[\[?[A-Za-z_][^\[\]]*\]\]?[ \t\r]*", line)]
    if heads or len(text) <= short:
        return heads
    return [at for at, line in starts if not line.strip(" \t\r") or line.startswith(("---", "}", "]"))]


@pytest.mark.parametrize("short", [0, 80, 10**6])
def test_sweep_equals_scopes_by_line(spark, short):
    rnd = random.Random(2)
    parts = {"ident": "user_id=abc", "value": "Zk3" * 12, "endpoint": "10.1.2.3", "assign": "token=abcdefgh", "access": "AKIA0123456789AB"}
    fill = ["\n", "\n\n", " \n \t\n", "\n---\n", "\n}\n", "\n]\n", "é😀 word", "\r\n\r\n", "[x]"]
    rows = []
    for i in range(150):
        more = [*fill, "\n[head]\n", "\n [t.b] \r\n"] if i % 3 == 0 else fill
        rows.append((i, " ".join(rnd.choice(list(parts.values())) if rnd.random() < 0.3 else rnd.choice(more) for _ in range(rnd.randint(1, 40)))))
        rows.append((1000 + i, "".join(rnd.choice([*parts.values(), *more]) + "\n" for _ in range(rnd.randint(1, 20)))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [(x.kind, x.start, x.end) for x in r.spans] for r in secret_links.secret_spans(docs, short=short).collect()}
    for i, text in rows:
        found = sorted((m.start(), k, m.end()) for k, p in parts.items() for m in re.finditer(re.escape(p), text))
        ends = scopes(text, short)
        scope = {s: sum(e <= s for e in ends) for s, *_ in found}
        there = lambda s, kinds: any(scope[b] == scope[s] and k in kinds for b, k, _ in found)
        want = []
        for s, k, e in found:
            a, b = there(s, ("access", "ident")), there(s, ("assign", "value"))
            if k in ("assign", "access") or (k == "ident" and b) or (k == "value" and a) or (k == "endpoint" and a and b):
                want.append((k, s, e))
        assert sorted(got[i], key=lambda x: x[1]) == want, repr(text)


def test_secrets_of_edge_cases(edge_docs, no_docs):
    got = secret_links.secret_report(edge_docs).collect()
    assert len(got) == edge_docs.count() and {r.spans for r in got} == {""}
    assert {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()}
    assert secret_links.secret_report(no_docs).count() == 0


def test_license_units_and_bounds(spark, edge_docs, no_docs):
    mit = next(t for n, t in license_scan.TEMPLATES if n == "MIT" and len(t) > 200)
    words = mit.split()
    wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    rows = [
        (1, "Prose.\nreleased UNDER the mit license!\nMore prose."),
        (2, f"First part.\n\n{wrapped}\n\nLast part."),
        (3, wrapped),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "This work is licensed under the GNU General Public License, version 2."),
        (6, "The license is a word. All rights are not reserved by anyone at all."),
        (7, f"{wrapped}\n\n" + "all other words here " * 300),
    ]
    got = {r.doc_id: r for r in license_scan.license_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: r.licenses for i, r in got.items()} == {1: "MIT", 2: "MIT", 3: "MIT", 4: "CC-BY-NC-4.0", 5: "GPL-2.0", 6: "", 7: "MIT"}
    assert got[1].matches == "line:1:MIT:1000" and got[2].matches.startswith("paragraph:1:MIT:1000,") and got[6].best is None
    edge = license_scan.license_report(edge_docs).collect()
    assert len(edge) == edge_docs.count() and {r.n_matches for r in edge} == {0}
    assert license_scan.license_report(no_docs).count() == 0
    assert "matches" in license_scan.license_matches(edge_docs).columns


def test_notices_within_longer_texts(spark):
    full = {n: t for n, t in license_scan.TEMPLATES if len(t) > 200}
    mit = full["MIT"].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    gpl = full["GPL-3.0"].replace("version. This", "version.\n\nThis").replace("PURPOSE. See", "PURPOSE. See\n")
    wrap = lambda t: "\n\n".join("\n".join(" # " + " ".join(p.split()[i : i + 9]) for i in range(0, len(p.split()), 9)) for p in t.split("\n\n"))
    code = "".join(f"\n\ndef step{i}(argv{i}):\n    return path.join{i}(argv{i}, {i})\n" for i in range(40))
    rows = [
        (1, "Copyright 2020 A. Body\n\n" + wrap(mit) + code),
        (2, code + wrap(gpl) + code),
        (3, "We wrote it long ago. Released under the MIT License. Please write to us if you like it, we read all letters."),
        (4, "Both are here: Licensed under CC BY-NC 4.0. and also this work is licensed under the GNU General Public License, version 3, as you see."),
        (5, "Released under the MIT License.\nOther lines are here and the GNU General Public License, which is not named by its version."),
        (6, "The license of the software is a matter of the public, without any word of the kind. " * 20),
    ]
    got = {r.doc_id: r for r in license_scan.license_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: r.licenses for i, r in got.items()} == {1: "MIT", 2: "GPL-3.0", 3: "MIT", 4: "CC-BY-NC-4.0,GPL-3.0", 5: "MIT", 6: ""}
    assert got[3].matches == "passage:0:MIT:1000" and got[5].matches == "line:0:MIT:1000" and got[1].best == 1000


def test_licenses_of_texts_with_very_many_lines(spark):
    notice = "Released under the MIT License."
    half = "\n".join(notice if i % 2 else f"line {i} of other words" for i in range(2000))
    one = "\n".join(["some words of a line"] * 8000 + [notice] + ["some words of a line"] * 8000)
    started = time.monotonic()
    got = {r.doc_id: r for r in license_scan.license_report(spark.createDataFrame([(1, half), (2, one)], "doc_id bigint, text string")).collect()}
    assert time.monotonic() - started < 30
    assert got[1].n_matches == 1000 and got[1].matches.startswith("line:1:MIT:1000,line:3:MIT:1000,")
    assert got[2].matches == "line:8000:MIT:1000"


def test_secret_sql_links_by_scope(spark):
    """The tables hold no weak parts, so the SQL is held to the query on texts that do."""
    ident, value, url = "client_id=webshop", "Zk3" * 14, "https://host.example/x"
    far = " filler" * 60
    texts = [
        f"[a]\n{ident}\n[b]\n{value}", f"[a]\n{ident}\n\n;{far}\n\n{value}\n[b]\n{url}", f"{ident}\n\n{far}\n\n{value}", f"{ident}\n\n{value}",
        f"{{\n{ident}{far}\n}}\n{{\n{value}\n}}", f"{far}\n---\n{ident}\nmore\n{url}\n{value}\n---\n{url}", f" [a] \r\n[b]\n{ident}\n{value}", "", None,
    ]
    rows = list(enumerate(texts))
    got = {tuple(r) for r in secret_links.secret_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert got == set(db.execute(ORACLES["op4_secret_links"]).fetchall())


@pytest.mark.parametrize("name,text", license_scan.TEMPLATES)
def test_anchors_cannot_be_missed(name, text):
    words = license_scan._normal(text)
    picked = license_scan.anchors(words, 0.8)
    grams = license_scan._bigrams(words)
    without = [g for g in grams if not picked & set(g.split(" "))]
    # A unit of none of these words shares at most `without`; the best case is a unit of exactly those bigrams.
    assert 2 * len(without) / (len(without) + len(grams)) < 0.8


ITEM = "Alice has 3 apples and buys 4 more apples at the market near Bolton, then she gives 3 apples to Bob for 20 dollars. How many apples are left?"


def leaked(spark, docs, items=((1, ITEM),)):
    rows = template_leaks.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    return {r.doc_id: r for r in rows.collect()}


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_passages_with_other_slots(spark, monkeypatch, limit):
    monkeypatch.setattr(template_leaks, "BROADCAST_WINDOWS", limit)
    other = ITEM.replace("3 apples", "17 apples").replace("Bolton", "Dover").replace("Bob", "Emil").replace("20 dollars", "35 euros")
    docs = [
        (1, f"Before it. {other} After it."),
        (2, ITEM.upper()),
        (3, "and so " + ITEM.replace("\n", " ").lower()),
        (4, ITEM[: len(ITEM) // 3]),
        (5, "Nothing of the kind. " * 30),
        (6, None),
        (7, ""),
        (8, "1 2 3 4 5 6 7 8 9 10 11 12 13"),
    ]
    got = leaked(spark, docs)
    assert set(got) == {1, 2, 3}
    assert got[3].cover == 1.0 and got[1].item_ids == [1]


NUMBERS = "There are 2 red boxes with 3 large stones and 4 blue boxes with 5 small stones, then 6 green boxes with 7 heavy stones and 8 empty boxes with 9 light feathers."


def renumbered(text, seed):
    rnd = random.Random(seed)
    return re.sub("[0-9]+", lambda m: str(rnd.randint(10, 99)), text)


def test_a_second_copy_hides_nothing(spark):
    docs = [(i, f"Before. {renumbered(NUMBERS, i)} Between them. {renumbered(NUMBERS, 100 + i)} After.") for i in range(20)]
    docs += [(100 + i, f"{NUMBERS} {renumbered(NUMBERS, i)}") for i in range(20)]
    docs += [(200, f"{renumbered(NUMBERS, 1)} " * 3), (201, "These are few words. " * 9), (None, NUMBERS), (None, "Nothing of the kind.")]
    got = leaked(spark, docs, [(1, NUMBERS)])
    assert set(got) == {*range(20), *range(100, 120), 200, None}
    assert {r.cover for r in got.values()} == {1.0}


SHORT = ["What is 12 times 7?", "Compute 3 + 5 * 2 - 8 / 4 = x", "Solve 12 x + 7 = 31 for x.", "地球から月までの距離は何キロですか", "12 * 7 = ?", "5 km 3 h 20 min 8 m 2 s"]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_items_without_telling_windows_are_found_verbatim(spark, monkeypatch, limit):
    monkeypatch.setattr(template_leaks, "BROADCAST_WINDOWS", limit)
    docs = [(i, f"Before it: {t} After it.") for i, t in enumerate(SHORT)]
    docs += [(20, "What was 12 times 7? Compute 3 - 5. 12 + 7 = ? 5 km 4 h"), (21, "地球は丸いですか、月まで行けますか"), (22, "a b")]
    got = leaked(spark, docs, [*enumerate(SHORT), (9, "a b")])
    assert {i: r.item_ids for i, r in got.items()} == {i: [i] for i in range(len(SHORT))}


def test_literal_runs_are_reported(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("bcdfgaeiou") for _ in range(6)) for _ in range(60)]
    numbers = " ".join(str(i) for i in range(40))
    docs = [(i, "Before it all. " + " ".join(words[i : i + n]) + " and after.") for i, n in ((1, 25), (2, 13), (3, 12), (47, 13))]
    docs += [(100, " ".join(words[:9] + words[20:29])), (101, numbers[:60]), (102, f"{' '.join(words[:10])} and {' '.join(words[3:13])}")]
    got = leaked(spark, docs, [(1, " ".join(words)), (2, f"{' '.join(words[:3])} {numbers}")])
    assert {i: r.item_ids for i, r in got.items()} == {1: [1], 2: [1], 47: [1]}
    assert got[1].cover == 18 / 53


def test_slots_must_be_read_alike():
    item = ["a", "3", "b", "3"]
    match = lambda at, words: {"item_at": at, "item_words": item, "doc_words": words, "kinds": [0, 1, 0, 1]}
    assert template_leaks.consistent([match(0, ["a", "7", "b", "7"]), match(1, ["a", "7", "b", "8"])]) == {0}
    assert template_leaks.consistent([match(0, ["a", "7", "b", "8"])]) == set()


def test_given_passages_are_found(spark, small):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [plain(r.text) for r in benchmark.collect()]
    want = {r.doc_id for r in small.collect() if any(i in plain(r.text) for i in items)}
    assert {r.doc_id for r in template_leaks.leaks(small, benchmark).collect()} == want
    assert template_leaks.without_leaks(small, benchmark).count() == small.count() - len(want)


def test_leaks_of_edge_cases(spark, edge_docs, no_docs):
    benchmark = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "", "x"), (3, "12 34 56 78 90 12 34 56 78", "x"), (4, "a b", "x")], "item_id bigint, text string, n string")
    assert template_leaks.leaks(edge_docs, benchmark).count() == 0
    assert template_leaks.without_leaks(edge_docs, benchmark).count() == edge_docs.count()
    assert template_leaks.leaks(no_docs, benchmark).count() == 0
    assert template_leaks.leaks(edge_docs, benchmark.limit(0)).count() == 0
    copy = spark.createDataFrame([(9, edge_docs.where("doc_id = 7").first().text)], "item_id bigint, text string")
    assert {r.doc_id for r in template_leaks.leaks(edge_docs, copy).collect()} == {7, 8}


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_rows_without_doc_id_go_one_by_one(spark, monkeypatch, limit):
    monkeypatch.setattr(template_leaks, "BROADCAST_WINDOWS", limit)
    rows = [(None, NUMBERS, "a"), (None, "Clean one.", "b"), (None, None, "c"), (None, "Clean two.", "d"), (None, "Clean two.", "e"), (3, NUMBERS, "f"), (4, "", "g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, gone string")
    benchmark = spark.createDataFrame([(1, NUMBERS)], "item_id bigint, text string")
    assert sorted(r.gone for r in template_leaks.without_leaks(docs, benchmark).collect()) == ["b", "c", "d", "e", "g"]


def test_items_without_or_with_the_same_id_are_judged_by_themselves(spark):
    words = lambda n: " ".join(f"{'abcdefghijkl'[i]}{n}x" for i in range(12)).translate(str.maketrans("0123456789", "klmnopqrst"))
    items = [(None, words(1)), (5, words(2)), (5, words(3)), (6, words(4)[: len(words(4)) // 2]), (6, words(4))]
    got = leaked(spark, [(1, words(1)), (2, words(2)), (3, words(3)), (4, words(5))], items)
    assert {i: (r.item_ids, r.cover) for i, r in got.items()} == {1: ([], 1.0), 2: ([5], 1.0), 3: ([5], 1.0)}


def test_items_of_one_template_are_one_family(spark):
    """Two thousand items of a template against two thousand documents of it: no row for a pair of them."""
    fill = lambda i: f"A train number {i} leaves Dover with {i + 1} people on board and {2 * i + 5000} bags of wool, how many bags does each of them own?"
    items = spark.createDataFrame([(i, fill(i)) for i in range(2000)] + [(9000, NUMBERS)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"Before it. {fill(7 * i)} After it.") for i in range(2000)] + [(9001, "None of these words."), (9002, f"So {NUMBERS}")], "doc_id bigint, text string")
    began = time.monotonic()
    got = {r.doc_id: r.item_ids for r in template_leaks.leaks(docs, items).collect()}
    assert time.monotonic() - began < 60
    assert got == {**{i: [0] for i in range(2000)}, 9002: [9000]}
    families = {r.item_id: r.family_item for r in template_leaks.item_families(items).collect()}
    assert families == {**{i: 0 for i in range(2000)}, 9000: 9000}


def brute_force_slots(item: str, doc: str, cover: float = template_leaks.COVER) -> bool:
    """Windows of number placeholders, placed side by side one alignment at a time; lower-case words and numbers only."""
    a, b = item.split(), doc.split()
    form = lambda w: ["#" if t.isdigit() else t for t in w]
    n = template_leaks.WINDOW
    places = [i for i in range(len(a) - n + 1) if sum(not t.isdigit() for t in a[i : i + n]) >= template_leaks.LITERAL]
    for shift in range(-len(a), len(b)):
        same = [i for i in places if 0 <= i + shift <= len(b) - n and form(a[i : i + n]) == form(b[i + shift : i + shift + n])]
        readings: dict[str, list[str]] = {}
        for i in same:
            for x, y in zip(a[i : i + n], b[i + shift : i + shift + n], strict=True):
                if x.isdigit():
                    readings.setdefault(x, []).append(y)
        read = {x: min(set(ys), key=lambda y, ys=ys: (-ys.count(y), y)) for x, ys in readings.items()}
        good = [
            i
            for i in same
            if a[i : i + n] == b[i + shift : i + shift + n]
            or all(not x.isdigit() or read[x] == y for x, y in zip(a[i : i + n], b[i + shift : i + shift + n], strict=True))
        ]
        if places and len(good) >= cover * len(places):
            return True
    return False


def test_slots_and_windows_against_brute_force(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("bcdfgaeiou") for _ in range(5))
    items, docs = [], []
    for i in range(30):
        values = [str(rnd.randint(10, 99)) for _ in range(3)]
        items.append((i, " ".join(rnd.choice(values) if rnd.random() < 0.25 else word() for _ in range(rnd.randint(9, 20)))))
    for i in range(300):
        tokens = rnd.choice(items)[1].split()
        renamed = {t: str(rnd.randint(100, 999)) for t in sorted(set(tokens)) if t.isdigit()}
        tokens = [renamed[t] if t.isdigit() and rnd.random() < 0.9 else t for t in tokens]
        for _ in range(rnd.choice([0, 0, 1, 2])):
            tokens[rnd.randrange(len(tokens))] = word()
        cut = rnd.choice([0, 0, rnd.randint(0, len(tokens) // 2)])
        docs.append((i, " ".join([word() for _ in range(rnd.randint(0, 9))] + tokens[cut:] + [word() for _ in range(9)])))
    # The run of literal words and the other forms only add documents, never where slots hold other values throughout.
    want = {d for d, text in docs if any(brute_force_slots(t, text) for _, t in items)}
    got = leaked(spark, docs, items)
    more = set(got) - want
    assert want <= set(got) and 50 < len(want) < 290
    plain = {d: t for d, t in docs}
    assert all(any(sum(" ".join(t.split()[i : i + 8]) in plain[d] for i in range(len(t.split()) - 7)) for _, t in items) for d in more)
