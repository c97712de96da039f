"""Operators 2 and 6 against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelwatch.llm import exact_dedup, near_dup
from parcelwatch.llm.common import components
from parcelwatch.llm.shingles import Shingler, band_keys, signatures


def test_exact_copies_of_edge_cases(edge_docs):
    got = Counter(tuple(r)[:4] for r in exact_dedup.exact_copies(edge_docs, counters=2).collect())
    assert got[(1, 2, 4, False)] == 1 and got[(None, 2, 4, False)] == 1
    assert got[(2, 2, 4, True)] == 1 and got[(2, 2, 4, False)] == 1  # the repeated row counts, and stays once
    assert got[(3, 4, 3, False)] == 1 and got[(4, 4, 3, True)] == 1 and got[(None, 4, 3, False)] == 1  # null is empty
    assert sum(got.values()) == edge_docs.count()


def test_rows_that_stay(edge_docs, small, no_docs):
    stay = exact_dedup.without_copies(edge_docs, counters=2)
    assert stay.columns == edge_docs.columns
    texts = [r.text or "" for r in stay.collect()]
    assert len(texts) == len(set(texts)) == len({r.text or "" for r in edge_docs.collect()})
    assert exact_dedup.without_copies(small).count() == small.select("text").distinct().count()
    assert exact_dedup.without_copies(no_docs).count() == 0 and exact_dedup.exact_copies(no_docs).count() == 0


def test_summary_keeps_frequent_digests(spark):
    rows = [(b"hot" if i % 3 == 0 else str(i).encode(),) for i in range(3000)]
    named = exact_dedup.frequent_digests(spark.createDataFrame(rows, "digest binary").repartition(7), counters=8)
    assert b"hot" in [bytes(r.digest) for r in named.collect()]
    assert named.count() <= 8


def brute_components(rows, width, percent):
    sets = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    near = {(a, b) for ds in where.values() for a in ds for b in ds if a < b}
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    for a, b in near:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {d: (len(s), top(d)) for d, s in sets.items()}


@pytest.mark.parametrize("width,percent,bands,rows", [(3, 85, 40, 7), (5, 80, 48, 6)])
def test_components_of_given_documents(small, width, percent, bands, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_copies(small, width, percent, bands, rows).collect()}
    assert got == brute_components(small.select("doc_id", "text").collect(), width, percent)


def test_families_in_large_buckets(spark, monkeypatch):
    """Copies of one text with changes here and there: some are linked to the first only over others, some not at all."""
    monkeypatch.setattr(near_dup, "SMALL", 2)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rnd = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(70):
        words = list(base)
        for i in rnd.choice(len(words), int(rnd.integers(0, 8)), replace=False):
            words[i] = f"x{d}_{i}" if rnd.random() < 0.7 else f"y{i}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_copies(docs, 3, 85, 40, 7).collect()}
    want = brute_components(rows, 3, 85)
    assert got == want
    assert 1 < len({c for _, c in want.values()}) < 60


def test_near_copies_of_edge_cases(edge_docs, no_docs):
    got = Counter(tuple(r) for r in near_dup.near_copies(edge_docs).collect())
    assert got[(2, 1, 1, False)] == 2 and got[(1, 1, 1, True)] == 1 and got[(None, 1, 1, False)] == 1
    assert got[(3, 0, 3, True)] == got[(4, 0, 4, True)] == got[(12, 0, 12, True)] == 1 and got[(None, 0, None, True)] == 1
    assert got[(10, 1, 9, False)] == got[(9, 1, 9, True)] == 1  # short texts are one shingle
    by_id = {k[0]: k for k in got}
    assert by_id[6][2:] == (5, False) and by_id[8][2:] == (7, False)
    stay = near_dup.without_near_copies(edge_docs)
    assert stay.columns == edge_docs.columns
    assert {r.doc_id for r in stay.collect()} == {1, 3, 4, 5, 7, 9, 11, 12, 13, None}
    assert near_dup.near_copies(no_docs).count() == 0 and near_dup.without_near_copies(no_docs).count() == 0


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(1)
    pool = rnd.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[500:2500]
    doc = np.repeat([0, 1, 2], [2000, 2000, 1])
    for chunk in (1 << 16, 700):  # cutting a set into chunks changes nothing
        s = signatures(np.concatenate([a, b, pool[:1]]), doc, 3, 256, chunk)
        assert abs((s[0] == s[1]).mean() - 0.6) < 0.12
        assert sorted(s[2].astype(int)) == list(range(256))  # one element comes to every place
        keys = band_keys(s, 40, 6)
        assert len(set(keys[0])) == 40
    assert Shingler(3).hashes("a b").shape == (1,) and Shingler(3).hashes(" \n").shape == (0,)
    assert len(Shingler(2).hashes("A b a B\x0ba")) == 2


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)] + [(200, 201 + i) for i in range(50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 90, 90: 90, 95: 90, **dict.fromkeys(range(200, 251), 200)}
