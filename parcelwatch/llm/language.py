"""Languages of texts and of spans in mixed texts.

A word's letters have a script, and scripts narrow the languages that can have written it. The others are scored by
its letter n-grams (naive Bayes, learned from labelled documents). A Viterbi path over the words, with a penalty for
every change of language, labels spans; a document's language is the one with most letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mapped

#: Labelled documents that the model learns from, about; chosen by a hash of doc_id.
TRAIN_DOCS = 20_000
#: Languages that are learned: those with most labelled documents, so that junk in lang cannot grow the model.
MAX_LANGUAGES = 200
FEATURES = 1 << 15
GRAMS = (2, 3, 4)
#: Log-likelihood that a change of language costs.
SWITCH = 12.0
#: Words that a path runs over; longer texts are cut into such stretches, each starting anew.
STRETCH = 1024
_FLUSH_WORDS = 200_000
UNKNOWN = "und"
#: First code points of runs of letters by script. Latin stands for all that comes before Greek.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "burmese"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x3040, "kana"),
    (0x3100, "han"), (0xAC00, "hangul"), (0xF900, "han"), (0xFB00, "latin"), (0xFB50, "arabic"), (0xFF00, "latin"), (0x20000, "han"),
)
_STARTS = np.array([a for a, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(n) for _, n in SCRIPTS])
# Signs of number such as ½ ² ① count as word characters in patterns, but are no letters.
_NUMBERS = "".join(c for c in map(chr, range(0x80, 0x20000)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
_WORD = re.compile(rf"[^\W\d_{_NUMBERS}]+")
_PLAIN_WORD = re.compile(r"[^\W\d_]+")
_U = np.uint64


def held_out(docs: DataFrame) -> Column:
    return F.crc32(docs["doc_id"].cast("bigint").cast("string").cast("binary")) % 3 == 1


def _word_pattern(text: str) -> re.Pattern[str]:
    """A pattern that finds the words of ``text``: the long class is slow, and needed only where a sign of number occurs."""
    return _PLAIN_WORD if "".join(_PLAIN_WORD.findall(text)).isalpha() else _WORD


def find_words(text: str) -> list[str]:
    """Runs of letters."""
    words = _PLAIN_WORD.findall(text)
    return words if "".join(words).isalpha() else _WORD.findall(text)


def word_features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, feature) arrays, one pair for each length of n-gram; the ends of a word count as a letter."""
    c = np.frombuffer(("\n" + "\n".join(words) + "\n").lower().encode("utf-32-le"), "<u4").astype(_U)
    end = c == 10
    word = np.cumsum(end) - 1
    for n in GRAMS:
        starts = np.arange(len(c) - n + 1)
        inner = np.zeros(len(starts), bool)
        for k in range(1, n - 1):
            inner |= end[k : k + len(starts)]
        ok = ~inner & ~(end[: len(starts)] & end[n - 1 :]) if n == 2 else ~inner
        starts = starts[ok]
        h = np.full(len(starts), n, _U)
        for k in range(n):
            h = (h ^ c[starts + k]) * _U(0x9E3779B97F4A7C15)
            h ^= h >> _U(29)
        yield word[starts + end[starts]], (h % _U(FEATURES)).astype(np.int64)


def scripts(words: list[str]) -> np.ndarray:
    """The script of each word's first letter."""
    return _SCRIPT[np.searchsorted(_STARTS, [ord(w[0]) for w in words], side="right") - 1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = find_words(text.as_py())
            if not words:
                continue
            own = totals.setdefault(lang, np.zeros(FEATURES + len(_NAMES), np.int64))
            for _, feature in word_features(words):
                own[:FEATURES] += np.bincount(feature, minlength=FEATURES)
            own[FEATURES:] += np.bincount(scripts(words), minlength=len(_NAMES))
    for lang, own in totals.items():
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(used), pa.string()), "feature": pa.array(used, pa.int64()), "n": pa.array(own[used])})


class Languages:
    """A learned model: names, log-likelihoods of features (features x names) and of scripts (scripts x names)."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        grams = counts[:FEATURES] + 0.5
        self.grams = np.log(grams / grams.sum(0)).astype(np.float32) if names else grams
        share = counts[FEATURES:] / np.maximum(counts[FEATURES:].sum(0), 1)
        self.writes = share >= 0.01  # a language of which a hundredth of words has the script is a candidate
        self.writes |= ~self.writes.any(1, keepdims=True)

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.names)), np.float32)
        for word, feature in word_features(words):
            for k in range(len(self.names)):
                out[:, k] += np.bincount(word, self.grams[feature, k], len(words))
        out -= out.max(1, keepdims=True)
        return np.where(self.writes[scripts(words)], np.maximum(out, -4 * SWITCH), np.float32(-4 * SWITCH))

    def paths(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The language of each word: best paths over stretches of ``sizes`` words, all stretches side by side."""
        order = np.argsort(-sizes, kind="stable")
        first = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        label = np.empty(len(scores), np.int64)
        best = scores[first]
        steps = []
        for t in range(1, int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -t, side="left"))  # stretches with a word at t
            head = best[:n]
            top = head.argmax(1)
            jump = head[np.arange(n), top] - np.float32(SWITCH)
            switched = head < jump[:, None]
            best = best.copy() if t == 1 else best
            best[:n] = np.where(switched, jump[:, None], head) + scores[first[:n] + t]
            best[:n] -= best[:n].max(1, keepdims=True)
            steps.append((n, top, switched))
        now = best.argmax(1)
        for t in range(len(steps), 0, -1):
            n, top, switched = steps[t - 1]
            label[first[:n] + t] = now[:n]
            now[:n] = np.where(switched[np.arange(n), now[:n]], top, now[:n])
        if len(sizes):
            label[first] = now
        return label


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS, max_languages: int = MAX_LANGUAGES) -> Languages:
    """A model from text and lang of the labelled rows of ``docs`` that are not held out.

    About ``train_docs`` of them, by a hash of doc_id, in the ``max_languages`` values of lang with most rows (of equal
    ones the first in order); counts come to the driver, at most ``FEATURES`` a language.
    """
    rows = docs.where(docs["text"].isNotNull() & docs["lang"].isNotNull() & ~F.coalesce(held_out(docs), F.lit(False)))
    share = min(1.0, train_docs / max(rows.count(), 1))
    support = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    learned = [r["lang"] for r in support.orderBy(F.desc("n"), "lang").limit(max_languages).collect()]
    rows = rows.where(F.col("lang").isin(learned))
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    counts = mapped(rows.select("lang", "text"), _count, "lang string, feature bigint, n bigint")
    table = counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(table["lang"].unique())
    out = np.zeros((FEATURES + len(_NAMES), len(names)))
    out[table["feature"].to_numpy(np.int64), table["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(np.int64)] = table["n"]
    return Languages(names, out)


class _Labeller:
    def __init__(self, model: Languages, max_words: int = 150_000):
        self.model, self.max_words = model, max_words
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.names)), np.float32)

    def labels(self, texts: list[list[str]]) -> np.ndarray:
        """The language of each word of all texts, after one another."""
        words = [w for t in texts for w in t]
        missing = [w for w in dict.fromkeys(words) if w not in self.known]
        if len(self.known) + len(missing) > self.max_words:
            self.known, self.scores = {}, self.scores[:0]
            missing = list(dict.fromkeys(words))
        if missing:
            self.known.update(zip(missing, range(len(self.known), len(self.known) + len(missing)), strict=True))
            self.scores = np.concatenate([self.scores, self.model.word_scores(missing)])
        known = self.known
        sizes = []
        for t in texts:
            sizes += [STRETCH] * (len(t) // STRETCH) + [len(t) % STRETCH]
        sizes = np.array(sizes, np.int64)
        return self.model.paths(self.scores[[known[w] for w in words]], sizes[sizes > 0])


def _spans(text: str, labels: np.ndarray, names: list[str]) -> list[dict]:
    out: list[dict] = []
    for m, k in zip(_word_pattern(text).finditer(text), labels, strict=True):
        if out and out[-1]["lang"] == names[k]:
            out[-1]["end"] = m.end()
        else:
            out.append({"lang": names[k], "start": m.start(), "end": m.end()})
    return out


def label_texts(docs: DataFrame, model: Languages, spans: bool = False, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but a ``lang_pred``, ``score`` or ``spans`` it may have, and those anew.

    lang_pred is the language with most letters, ``und`` for null or a text without a letter; score is its share of
    the letters (0 for ``und``). ``spans`` adds (lang, start, end) in code points. Nothing but the text is looked at.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "spans")]
    schema = docs.select(*names).schema.add("lang_pred", "string").add("score", "double")
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    if spans:
        schema = schema.add("spans", T.ArrayType(T.StructType().add("lang", "string").add("start", "integer").add("end", "integer")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _Labeller(model)

        def labelled(part: pa.RecordBatch, words: list[list[str]]) -> pa.RecordBatch:
            sizes = np.array([len(w) for w in words], np.int64)
            preds, shares, found = [UNKNOWN] * len(words), [0.0] * len(words), [[] for _ in words]
            if model.names and sizes.sum():
                label = labeller.labels(words)
                k = len(model.names)
                owner = np.repeat(np.arange(len(words)), sizes)
                letters = np.bincount(owner * k + label, [len(w) for t in words for w in t], len(words) * k).reshape(-1, k)
                for i in np.flatnonzero(sizes):
                    best = int(letters[i].argmax())
                    preds[i], shares[i] = model.names[best], float(letters[i][best] / letters[i].sum())
                if spans:
                    ends = np.cumsum(sizes)
                    at = part.column(names.index(text))
                    found = [_spans(at[i].as_py(), label[ends[i] - sizes[i] : ends[i]], model.names) if sizes[i] else [] for i in range(len(words))]
            more = [pa.array(preds, pa.string()), pa.array(shares, pa.float64())] + ([pa.array(found, span_type)] if spans else [])
            return pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "lang_pred", "score", *(["spans"] if spans else [])])

        for batch in batches:
            words, held, start = [], 0, 0
            for i, t in enumerate(batch.column(names.index(text))):
                words.append(find_words(t.as_py() or ""))
                held += len(words[-1])
                if held >= _FLUSH_WORDS:
                    yield labelled(batch.slice(start, i + 1 - start), words)
                    words, held, start = [], 0, i + 1
            if words:
                yield labelled(batch.slice(start), words)

    return mapped(docs.select(*names), run, schema)


def predicted(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, by a model learned from ``docs`` itself."""
    model = learn(docs)
    out = label_texts(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text"), model)
    return out.select("doc_id", F.coalesce(held_out(out), F.lit(False)).alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` of which at least the share ``least`` of letters is in one language, all columns."""
    marked = label_texts(docs.withColumnsRenamed({c: f"_in_{c}" for c in docs.columns}), learn(docs), text="_in_text")
    kept = marked.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*(F.col(f"_in_{c}").alias(c) for c in docs.columns))
