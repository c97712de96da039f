"""Operators 11 to 13 against brute force."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from test_copies import brute_components

import numpy as np
from parcelwatch.llm import fill_middle, set_relations, turn_repair

WS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Fill in the middle


def brute_fill(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(tokens), sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(prefix), len(middle), sha(f"<S>{suffix}<P>{prefix}<M>{middle}"), sha(text))
    return (doc_id, n, "psm", len(prefix), len(middle), sha(f"<P>{prefix}<S>{suffix}<M>{middle}"), sha(text))


def test_fill_equals_brute_force(spark, edge_docs, small, no_docs):
    odd = ["<P", "a<S>b", "<<S", "<", ">S<", "$1 \\ $2 {3}", "x\n\r\u0085 y", "𝒜bc𝒟", "a" * 50_000, "1 " * 60_000, "<M", "M>a<P", "é" * 40_000]
    extra = spark.createDataFrame([(100 + i, odd[i % len(odd)]) for i in range(20 * len(odd))], "doc_id bigint, text string")
    for docs in (edge_docs, small, extra, no_docs):
        want = sorted((brute_fill(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
        assert sorted(map(tuple, fill_middle.fill_report(docs).collect()), key=str) == want


def test_fill_is_one_projection(small):
    plan = fill_middle.fill_report(small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan


# Turn repair


def brute_repair(initials, faults, entry=0, close=True, goal=None):
    """The least (cost, audit), by trying partial edits in order of cost and text."""
    n, heap, seen = len(initials), [(0, "", 0, entry)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == n and (state in (0, 3) if close else state == goal):
            return cost, audit
        after, want = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}[state]
        if i < n or close:
            heapq.heappush(heap, (cost + 3, audit + "I", i, after))
        if i < n:
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if faults[i] not in (1, 2):
                more = 3 if faults[i] == 3 else 0
                if initials[i] == want:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, after))
                if initials[i] == "s" and state == 0:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, 1))
                heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, after))
    return None


def test_branch_and_bound_proves_the_best_repair():
    rnd = random.Random(3)
    for _ in range(1500):
        n = rnd.randint(0, 9)
        initials = tuple(rnd.choice("ssuuaat") for _ in range(n))
        faults = tuple(rnd.choice((0, 0, 0, 1, 2, 3)) for _ in range(n))
        assert turn_repair.repair(initials, faults, 0, True) == (brute_repair(initials, faults),)
        for entry in range(4):
            assert turn_repair.repair(initials, faults, entry, False) == tuple(brute_repair(initials, faults, entry, False, g) for g in range(4))


def test_a_full_segment_is_solved_in_time():
    rnd = random.Random(4)
    for roles in ("u", "uua", "sua"):
        initials = tuple(rnd.choice(roles) for _ in range(turn_repair.SEGMENT))
        faults = tuple(rnd.choice((0, 0, 3)) for _ in initials)
        assert turn_repair.repair(initials, faults, 0, True) == (brute_repair(initials, faults),)


def brute_conversations(rows):
    """{conv_id: result} of (conv_id, turn, role, text) after damage; every conversation is there, dropped rows are not."""
    talks = {}
    for conv, turn, role, text in rows:
        talk = talks.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        if fault:
            talk += [(turn, "user" if fault == 4 else role, text)] * (1 + (fault == 3))
    out = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{str(conv is None).lower()}{'' if conv is None else conv}:{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        faults, seen = [], set()
        for _, role, text in talk:
            end = text.rstrip(WS)[-1:]
            faults.append(1 if not end else 2 if (role, text) in seen else 0 if end in ".!?" else 3)
            seen.add((role, text))
        initials = [r[1][:1] for r in talk]
        cost, audit = brute_repair(initials, faults)
        lines, state, row = [], 0, 0
        for edit in audit:
            name, after = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}[state]
            kept = {"I": f"{name}:", "D": None}.get(edit, f"{name if edit == 'R' else talk[row][1]}:{talk[row][2]}" if row < len(talk) else None)
            if edit != "D":
                lines.append(kept)
                state = 1 if edit == "K" and state == 0 and initials[row] == "s" else after
            row += edit != "I"
        turns = [r[0] for r in talk if r[0] is not None]
        bad = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in (1, 2, 3)), bad, cost, audit, sha("\n".join(lines)))
    return out


SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, seg int, fault string, digest string"


def check(spark, rows, partitions=3):
    table = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA).repartition(partitions)
    got = turn_repair.repaired(turn_repair.damaged(table)).collect()
    assert len(got) == len({r.conv_id for r in got})
    assert {r[0]: tuple(r)[1:] for r in got} == brute_conversations(rows)


@pytest.mark.parametrize("segment", [2, 64])
def test_conversations_equal_brute_force(spark, monkeypatch, segment):
    rnd = random.Random(7)
    said = ["Yes.", "No!", "and then", " ", "", None, "Really?", "one ", "q. \n", "same text."]
    rows = []
    for conv in (*range(60), None):
        for turn in range(rnd.randint(1, 9)):
            text = rnd.choice(said) if rnd.random() < 0.6 else f"turn {turn} of {conv}" + rnd.choice([".", "", "! "])
            rows.append((conv, rnd.choice([turn, turn, turn, None, turn + 3]), rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""]), text))
    rows += rows[:20]
    monkeypatch.setattr(turn_repair, "SEGMENT", segment)
    check(spark, rows)


def test_a_hot_conversation_is_split(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(5, t, rnd.choice(["user", "assistant"]), rnd.choice([f"t {t}.", "ok", "ok."])) for t in range(700)]
    rows += [(6, None, "user", "again.")] * 150 + [(c, t, "user" if t % 2 == 0 else "assistant", "Fine.") for c in range(10, 40) for t in range(4)]
    check(spark, rows, 8)


def test_conversations_without_rows(spark):
    assert turn_repair.repaired(turn_repair.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(dropped, 0, "user", "Hi.")])
    long = "word " * 200_000
    check(spark, [(1, 1, "user", long + "."), (1, 2, "assistant", long)])


# Jaccard join


@pytest.fixture(scope="module")
def families(spark):
    """Near copies of one text of various distance, passages in many texts, repeats, short texts."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    base, passage = [word() for _ in range(120)], [word() for _ in range(40)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(rnd.randint(0, 6)):
            text[rnd.randrange(len(text))] = word()
        rows.append((1000 - i, " ".join(text)))
    rows += [(i, " ".join([word() for _ in range(rnd.randint(0, 12))] + passage + [word() for _ in range(rnd.randint(0, 12))])) for i in range(60)]
    rows += [(2000 + i, rows[3][1]) for i in range(30)] + [(3000 + i, t) for i, t in enumerate(["", None, " \n", "a b", "A B", "a b c", "a b a b a b a b"])]
    return rows


@pytest.mark.parametrize("options", [{}, {"common": 2, "block": 4, "late": 30}, {"common": 3, "rounds": 1, "block": 8}])
def test_join_equals_brute_force(spark, families, options):
    docs = spark.createDataFrame(families, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in set_relations.similar_sets(docs, **options).collect()}
    assert got == brute_components(families, 5, 80)


def test_join_of_edge_cases(edge_docs, no_docs, small):
    got = sorted(map(tuple, set_relations.similar_sets(edge_docs).collect()), key=str)
    assert len(got) == edge_docs.count()
    same = [r for r in got if r[1] == 1 and r[0] in (1, 2, None)]
    assert {r[2] for r in same} == {1} and len(same) == 4  # null and repeated doc_id are in the component of their text
    assert [r[2] for r in got if r[0] in (5, 6)] == [5, 5] and [r[2] for r in got if r[0] in (9, 10)] == [9, 9]
    assert all(r[1] == 0 and r[2] == r[0] for r in got if r[0] in (3, 4, 12))
    assert set_relations.similar_sets(no_docs).count() == 0
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in set_relations.similar_sets(small, width=3, percent=60).collect()}
    assert got == brute_components(rows, 3, 60)


def test_overlaps_follow_from_differences():
    rnd = np.random.default_rng(1)
    for _ in range(30):
        lead = np.unique(rnd.integers(0, 400, 120)).astype(np.uint64)
        sets = [np.unique(np.concatenate([lead[rnd.random(len(lead)) < 0.85], rnd.integers(400, 430, rnd.integers(0, 12)).astype(np.uint64)])) for _ in range(14)]
        minus = [np.flatnonzero(~np.isin(lead, s)).astype(np.uint64) for s in sets]
        plus = [s[~np.isin(s, lead)] for s in sets]
        joined = np.arange(len(sets))
        links = set_relations.derived_links(minus, plus, len(lead), joined, 70, columns=16)
        up = {i: i for i in range(len(sets))}

        def top(x):
            return x if up[x] == x else top(up[x])

        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 70 * (len(sets[a]) + len(sets[b]) - both):
                    up[top(a)] = top(b)
        want = {frozenset(i for i in up if top(i) == top(j)) for j in up}
        up = {i: i for i in range(len(sets))}
        for a, b in links:
            assert top(a) != top(b)  # a forest
            up[top(a)] = top(b)
        assert {frozenset(i for i in up if top(i) == top(j)) for j in up} == want
