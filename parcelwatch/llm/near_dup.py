"""Near copies: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

1. Each text becomes its set of word shingles. Texts with equal sets are one class from here on, so a text that
   was copied very often weighs as one.
2. Classes that agree in a band of their signatures share a bucket. Buckets with the same members are kept once.
3. A bucket of up to ``SMALL`` members gives its pairs, a larger one a pair of each member with its first.
   The pairs are confirmed on full sets, and union-find joins what is linked.
4. What that leaves open is the rest of large buckets: members outside the group of the first one. They are
   dealt into blocks, and two blocks at a time are compared inside a task, all members against all, by
   products of incidence matrices. Only links leave the task, one fewer than documents at most, so no pairs
   are written out however large a bucket is, and a bucket whose members are one group costs nothing here.

With a similarity s the chance that no band agrees is (1 - s^rows)^bands: for the limits used, at most 1 in a million
for a pair just at the threshold. No link is accepted or dropped by estimate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, mapped, small_or_shuffled, stored, whole_text, without_ids
from .shingles import Shingler, band_keys, signatures

SMALL = 4
#: Members, and shingles in all, of a block.
BLOCK, BLOCK_SHINGLES = 256, 1 << 18
#: Texts that are signed together, by their number of shingles.
_TOGETHER = 1 << 16


def _sign(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)

        def signed(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            sizes = np.array([len(s) for s in sets], np.int64)
            doc = np.repeat(np.arange(len(sets)), sizes)
            keys = band_keys(signatures(np.concatenate(sets), doc, len(sets), bands * rows), bands, rows)
            keys = [k if n else None for k, n in zip(keys, sizes, strict=True)]
            prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n", "print", "keys"],
            )

        for batch in batches:
            ids, sets, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                sets.append(shingler.hashes(text.as_py()))
                held += len(sets[-1])
                if held >= _TOGETHER or len(ids) >= 1024:
                    yield signed(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield signed(ids, sets)

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                sets = [shingler.hashes(t.as_py()).tobytes() for t in batch.column(0).slice(at, 64)]
                prints = [xxhash.xxh3_128_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(sets, pa.binary())], ["print", "shingles"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.sort(np.concatenate([x, y]))
                same = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * same >= percent * (len(both) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def links_among(sets: list[np.ndarray], percent: int, columns: int = 4096) -> list[tuple[int, int]]:
    """Links that join what is similar among ``sets``, as a forest: places in the list, counted exactly."""
    sizes = np.array([len(s) for s in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, doc = values[order], doc[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    number = np.cumsum(first) - 1
    often = np.bincount(number) > 1  # a shingle of one set meets no other
    rank = np.cumsum(often) - 1
    used = often[number]
    doc, column = doc[used], rank[number[used]]
    same = np.zeros((len(sets), len(sets)))
    for at in range(0, int(often.sum()), columns):
        part = slice(*np.searchsorted(column, [at, at + columns]))
        grid = np.zeros((len(sets), columns), np.float32)
        grid[doc[part], column[part] - at] = 1
        same += grid @ grid.T  # sums of at most 4096 ones are exact
    union = sizes[:, None] + sizes[None, :] - same
    found = np.argwhere(np.triu(100 * same >= percent * union, 1))
    up = list(range(len(sets)))
    out = []
    for a, b in found.tolist():
        x, y = a, b
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        while up[y] != y:
            up[y] = up[up[y]]
            y = up[y]
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _compare_blocks(percent: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates("node")
        sets = [np.frombuffer(s, "<u8") for s in block["shingles"]]
        nodes = block["node"].to_numpy()
        links = np.array(links_among(sets, percent), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": nodes[links[:, 0]], "b": nodes[links[:, 1]]})

    return run


def near_copies(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 48, rows: int = 6) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ..)``: doc_id, n_shingles, component_id, kept.

    Texts are linked if 100 * intersection >= percent * union of their shingle sets; component_id is the smallest
    doc_id reachable over links, and the document with it is kept. A text without words, or null, has no shingles
    and is linked with nothing. Rows that repeat a doc_id get the same kept where they share a component. A
    null doc_id is never the smallest beside another. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text(docs).alias("text"))
    signed = stored(mapped(texts, _sign(width, bands, rows), "doc_id bigint, n bigint, print binary, keys array<bigint>"), "signatures")
    classes = (
        signed.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"), F.any_value("keys").alias("keys"))
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    members = classes.select("node", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("lead"), F.bit_xor(F.xxhash64("node")).alias("mark")
    )
    buckets = buckets.where("size > 1").groupBy("size", "lead", "mark").agg(F.min("key").alias("key"))
    hits = members.join(buckets.select("key", "size", "lead"), "key").join(classes.select("node", "n"), "node")
    hits = stored(hits.select("key", "size", "lead", "node", "n"), "buckets")

    needed = stored(hits.select("node").distinct().join(classes.select("node", "doc_id", "print"), "node"), "needed")
    wanted = small_or_shuffled(needed.select(F.col("doc_id").alias("_id")))
    sets = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["_id"]), "left_semi").select("text")
    sets = mapped(sets, _full_sets(width), "print binary, shingles binary")
    sets = sets.join(needed.select("print", "node"), "print").groupBy("node").agg(F.any_value("shingles").alias("shingles"))
    sets = stored(sets, "sets")

    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    few = hits.where(F.col("size") <= SMALL)
    other = few.select("key", F.col("node").alias("other"), F.col("n").alias("m"))
    pairs = few.join(other, "key").where((F.col("node") < F.col("other")) & fits).select(F.col("node").alias("a"), F.col("other").alias("b"))
    many = hits.where(F.col("size") > SMALL)
    to_lead = many.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    pairs = pairs.union(to_lead).distinct()
    pairs = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    pairs = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    links = stored(mapped(pairs, _confirm(percent), "a bigint, b bigint"), "links")

    groups = stored(components(links), "groups")
    # Buckets with the same first member hold much the same members: they are taken as one where that compares less.
    cost = many.groupBy("lead").agg(F.sum("size").alias("apart"), F.countDistinct("node").alias("all"))
    at_once = F.col("all") * F.col("all") <= F.col("apart")
    many = many.join(cost, "lead").select(F.when(at_once, F.lit(0)).otherwise(F.col("key")).alias("key"), "lead", "node", "n").distinct()
    marked = many.join(groups.withColumnRenamed("component", "group"), "node", "left")
    marked = marked.join(groups.select(F.col("node").alias("lead"), F.col("component").alias("core")), "lead", "left")
    marked = stored(marked.select("lead", "key", "node", "n", (F.coalesce("group", "node") != F.coalesce("core", "lead")).alias("rest")), "open")
    tally = marked.groupBy("lead", "key").agg(
        *(
            F.greatest(F.ceil(F.count_if(side) / BLOCK), F.ceil(F.sum(F.when(side, F.col("n")).otherwise(0)) / BLOCK_SHINGLES)).alias(name)
            for name, side in (("core_blocks", ~F.col("rest")), ("rest_blocks", F.col("rest")))
        )
    )
    split = marked.join(tally.where("rest_blocks > 0"), ["lead", "key"])
    # Blocks of the rest are numbered first, then those of the core; core blocks meet blocks of the rest only.
    own = F.when(F.col("rest"), F.pmod(F.xxhash64("node"), F.col("rest_blocks"))).otherwise(
        F.col("rest_blocks") + F.pmod(F.xxhash64("node"), F.col("core_blocks"))
    )
    last = F.when(F.col("rest"), F.col("rest_blocks") + F.col("core_blocks") - 1).otherwise(F.col("rest_blocks") - 1)
    split = split.select("lead", "key", "node", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("with"))
    split = split.select("lead", "key", "node", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"))
    more = split.join(sets, "node").groupBy("lead", "key", "lo", "hi").applyInPandas(_compare_blocks(percent), "a bigint, b bigint")
    # A block is compared with itself whenever it meets another, so equal numbers are needed only where it is alone.
    links = links.union(stored(more.distinct(), "more_links"))

    groups = stored(components(links), "groups")
    least = groups.join(classes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = classes.join(groups, "node", "left").join(least, "component", "left")
    named = named.select(F.col("print").alias("_print"), F.coalesce("component_id", "doc_id").alias("component_id"))
    out = signed.join(named, signed["print"] == named["_print"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. A doc_id of which any row is kept stays with all its rows."""
    found = stored(near_copies(docs, **options), "near_copies")
    gone = found.groupBy(F.col("doc_id").alias("gone")).agg(F.bool_or("kept").alias("kept")).where("not kept").select("gone")
    return without_ids(docs, stored(gone, "gone"))
