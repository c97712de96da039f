"""Exact copies, with the frequent texts split off before the shuffle.

Texts meet as SHA-256 digests. A Misra-Gries summary per task, merged, names the digests that may be
frequent; an exact count verifies them and finds the row that stays. These winners are at most ``counters``
rows, so they are broadcast, and the copies of a frequent text are judged where they are read. Only the rest,
in which no digest has more than 2 n / (counters + 1) of n rows, is shuffled by digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, stored, whole_text, without_ids

#: Digests that a summary keeps; also the greatest number of rows that are broadcast.
COUNTERS = 1024


def _summarise(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for batch in batches:
            for x in pc.value_counts(batch.column(0)):
                key = x["values"].as_py()
                kept[key] = kept.get(key, 0) + x["counts"].as_py()
            if len(kept) > counters:
                cut = sorted(kept.values(), reverse=True)[counters]
                kept = {k: n - cut for k, n in kept.items() if n > cut}
        yield pa.RecordBatch.from_pydict({"digest": pa.array(list(kept), pa.binary()), "n": pa.array(list(kept.values()), pa.int64())})

    return run


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests with their lower bounds; none with over 2 n / (counters + 1) rows is missing."""
    parts = mapped(digests.select("digest"), _summarise(counters), "digest binary, n bigint")
    return parts.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(counters)


def exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ..)``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. Of equal texts the row with the largest doc_id stays; of rows that repeat both
    text and doc_id, one. A null doc_id is smaller than any other. An empty table gives no rows.
    """
    digests = stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.unhex(F.sha2(whole_text(docs), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    last = (F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("last"))
    named = frequent_digests(digests, counters).select("digest")
    winners = digests.join(F.broadcast(named), "digest", "left_semi").groupBy("digest").agg(*last)
    split = digests.join(F.broadcast(winners), "digest", "left")
    rest = split.where("n is null").select("doc_id", "digest", "row")
    rest = rest.join(rest.groupBy("digest").agg(*last), "digest")
    both = split.where("n is not null").select("doc_id", "digest", "row", "n", "last").unionByName(rest)
    return both.select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("last.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. A row that the table holds twice, with the same doc_id, is one
    document and stays once."""
    copies = stored(exact_copies(docs, counters), "copies")
    if copies.groupBy("doc_id").count().where("count > 1").isEmpty():
        return without_ids(docs, stored(copies.where("not kept").select(F.col("doc_id").alias("gone")), "gone"))
    # Some doc_ids repeat: a row is then known by doc_id and text.
    names = docs.columns
    stay = copies.where("kept").select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest"))
    marked = docs.withColumn("_digest_", F.unhex(F.sha2(whole_text(docs), 256)))
    found = marked.join(
        stay, marked["doc_id"].cast("bigint").eqNullSafe(stay["_id"]) & (marked["_digest_"] == stay["_digest"]), "left_semi"
    )
    at = Window.partitionBy(F.col("doc_id").cast("bigint"), "_digest_").orderBy(F.lit(1))
    return found.withColumn("_nth", F.row_number().over(at)).where("_nth = 1").select(*names)
