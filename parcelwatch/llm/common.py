"""What several operators need: input columns, tables between two steps, connected components."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import Any

import parcelwatch
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwatch.sources.scratch import scratch_dir


_shipped: set[str] = set()


def mapped(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the Python workers once per application."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    folder = Path(parcelwatch.__file__).parent
    if app not in _shipped and folder.is_dir():
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for source in sorted(folder.rglob("*.py")):
                z.write(source, source.relative_to(folder.parent))
        path = f"{scratch_dir(spark, 'package')}/parcelwatch.zip"
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
        out.write(packed.getvalue())
        out.close()
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return df.mapInArrow(_released(f), schema)


def _released(f: Callable) -> Callable:
    """``f``; what a task leaves behind goes back to the system, as workers outlive tasks and steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return run


_table: dict[Any, Any] = {}


def worker_table(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept in the Python worker until one with another key is asked for: the table of an earlier
    step would take memory for nothing."""
    if key not in _table:
        _table.clear()
        _table[key] = make()
    return _table[key]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(docs: DataFrame) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(docs["text"], F.lit(""))


#: Bytes of rows that go to a Python worker at once. Each batch is there several times, in the JVM and in the worker, for every core.
BATCH_BYTES = 8 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of ``BATCH_BYTES`` for what runs inside, unless the session sets their size."""
    if spark.conf.get(_BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read from there: what follows survives lost executors
    without running what came before again."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with _small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, label: str = "components", rounds: int = 40) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``: component is the smallest node reachable.

    Two alternating steps shrink the links until they form stars (every node hangs on its smallest
    neighbour; then every group of neighbours hangs on its smallest). Each step groups by a node and
    combines before it shuffles; a node with very many links never gathers them in one place, because only
    the smallest neighbour is kept per group. The links of a round are a written table.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
        label,
    )
    for _ in range(rounds):
        # Large star: every greater neighbour of a node hangs on the smallest around that node.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), label)
        # Small star: every smaller neighbour of a node, and the node, hang on the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        after = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after = stored(after.where("u != v").distinct(), label)
        # Stars: no node hangs on two, and none that others hang on hangs itself.
        uneven = after.groupBy("u").count().where("count > 1").select("u")
        if uneven.union(after.select("u").join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi")).isEmpty():
            edges = after
            break
        edges = after
    else:
        raise RuntimeError(f"links still change after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


#: Most ids that are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def small_or_shuffled(ids: DataFrame) -> DataFrame:
    """``ids``, a stored table of one or two integers a row, marked for broadcast if it is counted to be small."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in the stored table ``ids(gone)``. A null doc_id equals null only."""
    gone = small_or_shuffled(ids)
    return docs.join(gone, docs["doc_id"].cast("bigint").eqNullSafe(gone["gone"]), "left_anti")
