"""Operators 1, 3 and 7 against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from parcelwatch.llm import common
from parcelwatch.llm import length_histogram as lengths
from parcelwatch.llm import piece_chunks, rans
from parcelwatch.llm.word_ids import WordIds

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def library_ids(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(3))
def test_word_ids_equal_library(seed):
    rnd = random.Random(seed)
    alphabet = ["a", "B", "é", "É", "İ", "Σ", "ß", "1", "²", " ", " ", "\n", "\t", "\x1c", "\x85", " ", ".", ",", "'s", "_", "é", "漢", "<|endoftext|>", "<|ENDOFTEXT|>", "ǅ", "K"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    table = WordIds(WORDS, max_words=50)
    assert [np.frombuffer(table.ids(t), "<u2").tolist() for t in texts] == library_ids(texts)


@pytest.mark.parametrize("seed", range(3))
def test_chunks_equal_library(seed):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rnd = random.Random(seed)
    alphabet = ["a", "the", "B", "é", " ", " ", "  ", "\n", "\n\n", "\t", "▁", ".", "漢", "<s>", "\U0001f600", "\x00"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    chunks = piece_chunks.PieceChunks(PIECES, max_chunks=50)
    assert chunks.split
    for t in texts:
        ids = np.frombuffer(chunks.ids(t), "<u4").tolist()
        assert ids == [sp.bos_id(), *sp.encode(t), sp.eos_id()], repr(t)
        assert chunks.decode(chunks.ids(t)) == sp.decode(ids)


@pytest.mark.parametrize("n,kinds", [(1, 1), (127, 3), (128, 1), (5000, 40), (40_000, 49_000), (300_000, 12)])
def test_rans_round_trip(n, kinds):
    ids = (np.random.default_rng(n).zipf(1.3, n) % kinds).astype(np.uint32)
    segment = rans.encode(ids)
    assert (rans.decode(segment) == ids).all()
    parts = [rans.decode(segment, b) for b in range(segment["blocks"])]
    assert (np.concatenate(parts) == ids).all()
    assert sum(np.frombuffer(segment["freqs"], "<u4").tolist()) == 1 << rans.SCALE_BITS


def test_rans_finds_damage():
    segment = rans.encode(np.arange(50_000, dtype=np.uint32) % 700)
    words = bytearray(segment["words"])
    words[len(words) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode(segment | {"words": bytes(words)})


def test_crc_of_joined_strings():
    a, b = b"first part", b"the second, longer part" * 9
    assert rans.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert rans.crc32_joined(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


def test_files_hold_all_documents(edge_docs, monkeypatch):
    monkeypatch.setattr(rans, "SEGMENT", 1 << 13)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens, r.ids_crc32) for r in rans.encoded_index(edge_docs, WORDS).collect())
    rows = edge_docs.select("doc_id", "text").collect()
    ids = library_ids([r.text or "" for r in rows])
    want = sorted((r.doc_id if r.doc_id is not None else -1, len(i) + 1, zlib.crc32(np.array([*i, 1], "<u4"))) for r, i in zip(rows, ids, strict=True))
    assert sorted((g[0], *g[2:]) for g in got) == want
    by_start = sorted(got, key=lambda g: g[1])
    assert [g[0] for g in by_start] == sorted(g[0] for g in got)
    assert [g[1] for g in by_start] == np.cumsum([0] + [g[2] for g in by_start])[:-1].tolist()


def test_texts_are_not_shuffled(edge_docs, monkeypatch, tmp_path):
    fed, mapped = [], rans.mapped
    monkeypatch.setattr(rans, "mapped", lambda df, *rest: fed.append(df) or mapped(df, *rest))
    rans.write_ids(edge_docs, WORDS, str(tmp_path / "ids"))
    dealt = [df.columns for df in fed if "Exchange" in df._jdf.queryExecution().executedPlan().toString()]
    assert dealt == [["doc_id", "ids"]]


def test_ids_leave_in_batches_of_bounded_size(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(rans, "_IDS_BYTES", 64)
    texts = ["", "some words here", "word " * 100, "a", "b"] * 3
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array([*range(14), None], pa.int64()), "tie": pa.array(range(15), pa.int64()), "text": texts})
    out = list(rans._encoder(WORDS, 1)(iter([rows, rows.slice(0, 0)])))
    assert len(out) == 4
    assert [i for b in out for i in b.column("doc_id").to_pylist()] == [*range(14), None]
    assert [i for b in out for i in b.column("tie").to_pylist()] == list(range(15))
    got = [np.frombuffer(i, "<u2").tolist() for b in out for i in b.column("ids").to_pylist()]
    assert got == [[*i, 1] for i in library_ids(texts)]


def test_nothing_in_nothing_out(no_docs):
    assert rans.encoded_index(no_docs, WORDS).count() == 0
    assert piece_chunks.encoded_pieces(no_docs, PIECES).count() == 0
    h = lengths.length_histogram(no_docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert lengths.context_limits(h).count() == 0
    assert [tuple(r) for r in lengths.at_limits(lengths.context_limits(h), [5]).collect()] == [(5, 0, 0)]


def test_pieces_of_edge_cases(edge_docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted(tuple(r) for r in piece_chunks.encoded_pieces(edge_docs.where("doc_id is not null"), PIECES, with_ids=True).collect())
    want = []
    for r in edge_docs.where("doc_id is not null").collect():
        ids = [sp.bos_id(), *sp.encode(r.text or ""), sp.eos_id()]
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4")).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest(), ids))
    assert got == sorted(want)


def test_limits_against_brute_force(spark, small):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encode = lengths._encoding(ranks, pattern).encode_ordinary
    n = np.array([len(encode(r.text)) for r in small.select("text").collect()])
    table = lengths.context_limits(lengths.length_histogram(small, ranks, pattern))
    rows = {r.context_limit: r for r in table.collect()}
    assert set(rows) == set(n.tolist())
    for limit, r in rows.items():
        assert (r.docs, r.docs_fit, r.docs_over) == ((n == limit).sum(), (n <= limit).sum(), (n > limit).sum())
        assert (r.tokens_fit, r.tokens_kept, r.tokens_lost) == (n[n <= limit].sum(), np.minimum(n, limit).sum(), (n - np.minimum(n, limit)).sum())
        assert (r.total_docs, r.total_tokens) == (len(n), n.sum())
    wanted = [0, 1, 100, 128, 1000, 2048, 10**6]
    assert [tuple(r) for r in lengths.at_limits(table, wanted).collect()] == [(w, (n <= w).sum(), np.minimum(n, w).sum()) for w in wanted]
    for r in lengths.length_quantiles(table, [0.01, 0.5, 0.9, 1.0]).collect():
        assert r.n_tokens == np.sort(n)[int(np.ceil(r.share * len(n))) - 1]


def test_a_word_is_segmented_once_whatever_follows_it():
    table = WordIds(WORDS)
    asked = []
    ask = table._model
    table._model = lambda stem: asked.append(stem) or ask(stem)
    text = "Thoraned anblewh. thoraned, anblewh Thoraned. ANBLEWH, (b) thoraned! anblewh?\nthoraned.\tx1a. don't, a.b, é."
    assert np.frombuffer(table.ids(text), "<u2").tolist() == library_ids([text])[0]
    assert sorted(asked) == sorted({*asked}) and {"thoraned", "anblewh"} <= {*asked}


def test_rows_reach_workers_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": pa.array([b.nbytes], pa.int64())})

    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    seen = common.stored(common.mapped(rows, sizes, "size bigint"), "sizes").agg(F.max("size"), F.sum("size")).first()
    assert seen[0] < 2 * common.BATCH_BYTES and seen[1] > 4 * common.BATCH_BYTES
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


def test_a_worker_keeps_one_table():
    first = common.worker_table("a", list)
    assert common.worker_table("a", list) is first
    common.worker_table("b", list)
    assert common.worker_table("a", list) is not first
