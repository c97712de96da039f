"""Operators 8 and 10 on documents they have not seen, the pipeline, and what all queries share."""

import re
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
import check_oracles
import corpus_pipeline
from parcelwatch.llm import language, quality
from parcelwatch.llm.queries import ORACLES, QUERIES
from test_copies import brute_components

BIG = "/root/testdata/sf0.01"


def test_language_of_unseen_documents(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    got = language.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [r.lang == r.lang_pred for r in got if r.held_out]
    assert np.mean(unseen) > 0.98


def test_paths_equal_plain_viterbi():
    rnd = np.random.default_rng(4)
    model = language.Languages(["a", "b", "c"], np.ones((language.FEATURES + len(language._NAMES), 3)))
    sizes = np.array([5, 1, 9, 40, 3])
    scores = rnd.normal(0, 9, (sizes.sum(), 3)).astype(np.float32)
    got = model.paths(scores, sizes)
    at = 0
    for n in sizes:
        s = scores[at : at + n].astype(float)
        best, back = s[0], []
        for t in range(1, n):
            move = best[:, None] - language.SWITCH * (1 - np.eye(3))
            back.append(move.argmax(0))
            best = move.max(0) + s[t]
        path = [int(best.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        assert got[at : at + n].tolist() == path[::-1]
        at += n


def test_spans_of_a_mixed_text(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    model = language.learn(docs)
    parts = {k: docs.where(f"lang = '{k}' and n_chars between 900 and 2000").orderBy("doc_id").first().text.replace("\n", " ")[:600] for k in ("en", "de")}
    text = parts["en"] + " " + parts["de"] + " 漢字"
    row = language.label_texts(spark.createDataFrame([(text, "own")], "text string, score string"), model, spans=True).first()
    assert [s.lang for s in row.spans][:2] == ["en", "de"]
    assert abs(row.spans[0].end - 600) < 60 and row.lang_pred in ("en", "de") and 0.4 < row.score < 0.7


def test_scripts_narrow_candidates():
    counts = np.ones((language.FEATURES + len(language._NAMES), 2))
    counts[language.FEATURES :] = 0
    counts[language.FEATURES + language._NAMES.index("latin"), 0] = 10
    counts[language.FEATURES + language._NAMES.index("cyrillic"), 1] = 10
    model = language.Languages(["en", "ru"], counts)
    assert model.word_scores(["word", "слово", "漢字"]).argmax(1).tolist()[:2] == [0, 1]


def test_language_of_edge_cases(edge_docs, no_docs):
    got = {(r.doc_id, r.lang_pred, r.score) for r in language.predicted(edge_docs).collect()}
    assert {r for r in got if r[0] in (3, 4, 11, 12)} == {(i, "und", 0.0) for i in (3, 4, 11, 12)}
    kept = language.with_language(edge_docs)
    assert kept.columns == edge_docs.columns and {3, 4, 11, 12}.isdisjoint({r.doc_id for r in kept.collect()})
    assert language.predicted(no_docs).count() == 0 and language.with_language(no_docs).count() == 0


def test_junk_in_lang_cannot_grow_the_model(spark):
    rows = [(i, f"text number {i} of some words", lang) for i, lang in enumerate(["en"] * 30 + ["de"] * 20 + [f"junk{k:02}" for k in range(40)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert language.learn(docs, max_languages=2).names == ["de", "en"]
    assert {"de", "en"} < set(language.learn(docs).names) and len(language.learn(docs).names) > 20
    assert language.learn(docs.where("lang = 'fr'")).names == []


def test_signs_of_number_are_no_letters(spark, small):
    odd = spark.createDataFrame([(-1, "½ ² ① Ⅷ 12", None), (-2, "½x²y ①", None)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(small.select("doc_id", "text", "lang").union(odd)).where("doc_id < 0").collect()}
    assert got[-1][0] == "und" and got[-2][0] != "und"
    words = language._WORD.findall("a½b x²y Ⅷ 一二 ª٣")
    assert words == ["a", "b", "x", "y", "一二", "ª"] and all(w.isalpha() for w in words)
    for text in ("plain words, 12 of_them", "a½b x²y Ⅷ 一二 ª٣", "", "½", "漢字 слово 𝟘𠀀 x\u0301"):
        assert language.find_words(text) == language._WORD.findall(text) == [m[0] for m in language._word_pattern(text).finditer(text)]


def test_quality_of_unseen_documents(spark):
    got = QUERIES["op10_pairwise_quality"](spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    unseen = [r.predicted == r.quality for r in got if r.held_out]
    assert np.mean(unseen) > 0.93


def test_ranking_learns_the_preferred_direction():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(600, 4))
    good = x[:, 0] - 2 * x[:, 2] > 0.3
    model = quality.rank(x, good, pairs=4000)
    assert ((model.scores(x) >= quality.LINE) == good).mean() > 0.95
    assert (quality.rank(x, np.ones(600, bool)).scores(x) > 0.9).all() and (quality.rank(x, np.zeros(600, bool)).scores(x) < 0.1).all()


def test_quality_of_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0, "a"), (2, 0, None, "a"), (2, 1, 0, "a"), (None, 1, 1, "a"), (5, None, 0, "a"), (7, 1, 0, "a"), (8, 0, 0, "a")], "doc_id bigint, quality int, toxic int, text string")
    model = quality.learn(edge_docs, labels)
    got = quality.quality_scores(edge_docs, model).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = quality.learn(edge_docs, labels.limit(0))
    assert {r.score for r in quality.quality_scores(edge_docs, none).collect()} == {0.3}
    assert quality.quality_scores(no_docs, model).count() == 0 and quality.learn(no_docs, labels) is None


def test_stages_one_by_one(spark, edge_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark_dir = "/root/testdata/sf0.001"
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, benchmark_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = corpus_pipeline.stored(out, name)
        counts.append(out.count())
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > counts[4] == counts[5] > 0
    assert corpus_pipeline.run(spark, benchmark_dir).count() == counts[-1]
    odd = edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        odd = corpus_pipeline.stored(stage(spark, odd, benchmark_dir), name)
    assert odd.columns == edge_docs.columns
    assert sorted(r.doc_id for r in odd.collect() if r.doc_id is not None) == [2, 5, 7, 9, 13]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert check_oracles.compare(spark, check_oracles.duck(sf), sf, name) == ""


def test_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and set(QUERIES) | {"pipeline"} <= names


def test_pipeline_equals_brute_force(spark):
    """All stages in plain Python: copies by text, near copies over all pairs, whole items, the library's ids."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    last = {}
    for d in sorted(texts):
        last[texts[d]] = d
    texts = {d: texts[d] for d in last.values() if any(c.isalpha() for c in texts[d])}
    groups = brute_components(texts.items(), 5, 80)
    texts = {d: t for d, t in texts.items() if groups[d][1] == d}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {d: t for d, t in texts.items() if not any(i in plain(t) for i in items)}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: [sp.bos_id(), *sp.encode(t), sp.eos_id()] for d, t in texts.items()}
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()} == want
