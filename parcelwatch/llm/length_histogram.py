"""Token totals for every context limit from one exact histogram of document lengths.

Documents are counted by encoded length; the histogram is small, and running sums over it answer every question:
for a limit L the documents that fit, the tokens that are left when longer ones are cut at L, quantiles.
The sums run in two levels, over blocks of lengths and inside each block, so no task sees the whole histogram.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, stored, whole_text

BLOCK = 1024

_made: dict[str, object] = {}


def _encoding(path: str, pattern: str):
    if path not in _made:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _made[path] = tiktoken.Encoding("lengths", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _made[path]


def token_lengths(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """docs, n_tokens: how many of each batch of documents have that encoded length. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks, pattern).encode_ordinary
        for batch in batches:
            counts: dict[int, int] = {}
            for text in batch.column(0):
                n = len(encode(text.as_py()))
                counts[n] = counts.get(n, 0) + 1
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(list(counts), pa.int64()), "docs": pa.array(list(counts.values()), pa.int64())})

    return mapped(docs.select(whole_text(docs).alias("text")), run, "n_tokens bigint, docs bigint")


def length_histogram(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """n_tokens, docs: one row per length that occurs. Null text counts as empty; every row counts, repeated ones too; a long text is
    encoded whole, whatever other columns there are. An empty table gives no rows."""
    return token_lengths(docs, ranks, pattern).groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """One row per length L that occurs, taken as a context limit:

    docs (of that length), docs_over (longer ones), docs_fit, tokens_fit (tokens of those that fit),
    tokens_kept (tokens left when longer documents are cut at L), tokens_lost, total_docs, total_tokens,
    share_fit (of documents, the rank of the quantile that L is). An empty histogram gives no rows.

    The histogram is read twice, so it is written first: texts are encoded once.
    """
    histogram = stored(histogram, "histogram")
    h = histogram.select("n_tokens", "docs", F.floor(F.col("n_tokens") / BLOCK).alias("block"), (F.col("n_tokens") * F.col("docs")).alias("tokens"))
    blocks = h.groupBy("block").agg(F.sum("docs").alias("bd"), F.sum("tokens").alias("bt"))
    later = Window.orderBy(F.desc("block"))
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        (F.sum("bd").over(later) - F.col("bd")).alias("docs_later"),
        (F.sum("bt").over(later) - F.col("bt")).alias("tokens_later"),
        F.sum("bd").over(every).alias("total_docs"),
        F.sum("bt").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    out = h.select(
        "*",
        (F.sum("docs").over(inside) - F.col("docs")).alias("docs_after"),
        (F.sum("tokens").over(inside) - F.col("tokens")).alias("tokens_after"),
    ).join(blocks, "block")
    over = F.col("docs_after") + F.col("docs_later")
    fit = F.col("total_tokens") - F.col("tokens_after") - F.col("tokens_later")
    out = out.select("n_tokens", "docs", over.alias("docs_over"), fit.alias("tokens_fit"), "total_docs", "total_tokens")
    return out.select(
        F.col("n_tokens").alias("context_limit"),
        "docs",
        "docs_over",
        (F.col("total_docs") - F.col("docs_over")).alias("docs_fit"),
        "tokens_fit",
        (F.col("tokens_fit") + F.col("n_tokens") * F.col("docs_over")).alias("tokens_kept"),
        (F.col("total_tokens") - F.col("tokens_fit") - F.col("n_tokens") * F.col("docs_over")).alias("tokens_lost"),
        "total_docs",
        "total_tokens",
        (1 - F.col("docs_over") / F.col("total_docs")).alias("share_fit"),
    )


def at_limits(limits: DataFrame, wanted: Sequence[int]) -> DataFrame:
    """context_limit, docs_fit, tokens_kept for limits that need not occur as a length, from ``context_limits``.

    Between two lengths that occur, docs_fit stays and tokens_kept grows by docs_over a token.
    """
    one = limits.groupBy().agg(
        *(
            F.max_by(
                F.struct(F.col("docs_fit"), (F.col("tokens_kept") + F.col("docs_over") * (F.lit(w) - F.col("context_limit"))).alias("tokens_kept")),
                F.when(F.col("context_limit") <= w, F.col("context_limit")),
            ).alias(f"w{w}")
            for w in wanted
        ),
        F.max("total_docs").alias("total_docs"),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(w).cast("bigint").alias("context_limit"),
                F.coalesce(F.col(f"w{w}.docs_fit"), F.lit(0)).alias("docs_fit"),
                F.coalesce(F.col(f"w{w}.tokens_kept"), F.lit(w) * F.coalesce("total_docs", F.lit(0))).alias("tokens_kept"),
            )
            for w in wanted
        )
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def length_quantiles(limits: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share, n_tokens: the smallest length that at least this share of documents does not exceed."""
    one = limits.agg(*(F.min(F.when(F.col("share_fit") >= q, F.col("context_limit"))).alias(f"q{i}") for i, q in enumerate(shares)))
    rows = F.array(*(F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, q in enumerate(shares)))
    return one.select(F.explode(rows).alias("r")).select("r.*")
