"""Exact Jaccard join on word shingles, by block-skipping index lists and answers derived from similar sets.

1. Each text becomes its set of shingles; texts with equal sets are one class from here on.
2. Index: a set of n shingles is listed under its first n - ceil(n * percent / 100) + 1 shingles in a global order; two sets that are linked
   share one of them. The order is that of the hashes, but shingles whose lists turn out long come last (``COMMON``), in up to ``ROUNDS`` rounds: a passage
   that many texts share then hardly occurs in the index. Any order gives the same links.
3. Skipping: a list is kept in blocks by set size, such that linked sets lie in the same block or in neighbouring ones. The place of the
   shingle in a set bounds the overlap that is still possible and so the sizes of partners; an entry is given to the
   next block only where its place lets it reach so far, and a short block gives only pairs whose places and sizes fit.
4. Short blocks give pairs. Of a longer one each member is compared with the first, the lead. Pairs go on to their full sets only where
   bit patterns of the sets (each bit the parity of some shingles, so that the patterns differ in no more bits than the sets in shingles) leave
   it open whether they are linked. Union-find joins what is linked; a block whose members are all joined by then is done.
5. Derived answers: in what is left, members are similar to their lead, so each is known by its difference from it, shingles missing and
   shingles added. The overlap of two members follows from the two differences alone; their full sets are not touched again. Members are
   dealt into blocks of bounded size, only links leave a task, and members that are joined already are not compared.

No link is found or lost by estimate; shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, components, mapped, small_or_shuffled, stored, whole_text
from .shingles import Shingler

#: Longest list that counts as short; a shingle with a longer list comes late in the order.
COMMON = 8
#: Shingles that come late, at most: those with the longest lists. They are sent to the tasks, 16 bytes each.
LATE = 1 << 17
ROUNDS = 2
#: Bits of a set's pattern.
BITS = 2048
#: Pairs of one lead that a task compares; members, and shingles of their sets, of a block of step 5.
PAIRS = 512
BLOCK, BLOCK_SHINGLES = 256, 1 << 18


def _index(width: int, percent: int, late):
    """Texts -> n, print of the set, its index shingles in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        tokens, ranks = late.value if late else (np.empty(0, np.uint64), np.empty(0, np.int64))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                sizes, prints, bits, lists, ends = [], [], [], [], [0]
                for text in piece.column("text").to_pylist():
                    hashes = shingler.hashes(text)
                    n = len(hashes)
                    sizes.append(n)
                    prints.append(xxhash.xxh3_128_digest(hashes.tobytes()) if n else None)
                    parity = np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
                    bits.append(np.packbits(parity.astype(bool)).view(np.int64))
                    if n and len(tokens):
                        place = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
                        last = tokens[place] == hashes
                        hashes = np.concatenate([hashes[~last], hashes[last][np.argsort(ranks[place[last]])]])
                    lists.append(hashes[: n + (-percent * n) // 100 + 1] if n else hashes)
                    ends.append(ends[-1] + len(lists[-1]))
                values = np.concatenate(lists).view(np.int64) if lists else np.empty(0, np.int64)
                index = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
                patterns = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(bits) if bits else np.empty(0, np.int64)), BITS // 64)
                patterns = patterns.cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), patterns, index],
                    ["doc_id", "n", "print", "bits", "tokens"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                sets = [shingler.hashes(t).tobytes() for t in batch.column("text").slice(at, 64).to_pylist()]
                prints = [xxhash.xxh3_128_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(sets, pa.binary())], ["print", "shingles"])

    return run


def _against_lead(percent: int, differences: bool):
    """Rows (a, salt, b, shingles), each a's own set first (b null) -> linked pairs, or the differences of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = np.empty(0, np.uint64)
        for batch in batches:
            out = []
            for a, b, shingles in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("shingles"), strict=True):
                own = np.frombuffer(shingles.as_buffer(), np.uint64)
                if b is None:
                    lead = own.copy()
                    continue
                place = np.minimum(np.searchsorted(lead, own), len(lead) - 1)
                hit = lead[place] == own
                same = int(hit.sum())
                if differences:
                    missing = np.ones(len(lead), bool)
                    missing[place[hit]] = False
                    out.append((a, b, np.flatnonzero(missing).astype(np.uint64).tobytes(), own[~hit].tobytes(), len(lead)))
                elif 100 * same >= percent * (len(lead) + len(own) - same):
                    out.append((a, b))
            types = [pa.int64(), pa.int64()] + ([pa.binary(), pa.binary(), pa.int64()] if differences else [])
            names = ["a", "b", "minus", "plus", "lead_n"][: len(types)]
            columns = zip(*out, strict=True) if out else [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return run


def derived_links(minus: list[np.ndarray], plus: list[np.ndarray], lead_n: int, joined: np.ndarray, percent: int, columns: int = 4096) -> list[tuple[int, int]]:
    """Links that join what is similar among sets given by their differences from one set of ``lead_n`` members: a forest of
    places. Sets with the same number in ``joined`` are joined already.

    |Y and Z| = |X| - |X - Y| - |X - Z| + |(X - Y) and (X - Z)| + |(Y - X) and (Z - X)|
    """
    sets = len(minus)
    less, more = np.array([len(m) for m in minus]), np.array([len(p) for p in plus])
    size = lead_n - less + more
    same = np.float64(lead_n) - less[:, None] - less[None, :]
    for side in (minus, plus):
        doc, values = np.repeat(np.arange(sets), [len(s) for s in side]), np.concatenate(side)
        order = np.argsort(values, kind="stable")
        values, doc = values[order], doc[order]
        if not len(values):
            continue
        number = np.cumsum(np.concatenate([[False], values[1:] != values[:-1]]))
        often = np.bincount(number) > 1  # what is in one set meets nothing, and each set's own size is known
        column = (np.cumsum(often) - 1)[number]
        used = often[number]
        doc, column = doc[used], column[used]
        for at in range(0, int(often.sum()), columns):
            part = slice(*np.searchsorted(column, [at, at + columns]))
            grid = np.zeros((sets, columns), np.float32)
            grid[doc[part], column[part] - at] = 1
            same = same + grid @ grid.T  # sums of at most 4096 ones are exact
    union = size[:, None] + size[None, :] - same
    found = np.argwhere(np.triu((100 * same >= percent * union) & (joined[:, None] != joined[None, :]), 1))
    up = {int(g): int(g) for g in joined}

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for a, b in found.tolist():
        x, y = top(int(joined[a])), top(int(joined[b]))
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _derive(percent: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates("node")
        minus, plus = ([np.frombuffer(x, np.uint64) for x in block[side]] for side in ("minus", "plus"))
        nodes = block["node"].to_numpy()
        links = derived_links(minus, plus, int(block["lead_n"].iloc[0]), block["joined"].to_numpy(), percent)
        links = np.array(links, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": nodes[links[:, 0]], "b": nodes[links[:, 1]]})

    return run


def _compared(pairs: DataFrame, sets: DataFrame, percent: int, differences: bool, label: str) -> DataFrame:
    """``pairs(a, b)`` on their full sets. The set of a goes once to each task that compares it; an a with very many pairs is dealt to
    several tasks."""
    often = stored(pairs.groupBy("a").count().where(F.col("count") > PAIRS).select("a", F.ceil(F.col("count") / PAIRS).alias("salts")), "often")
    often = small_or_shuffled(often)
    salts = F.coalesce("salts", F.lit(1))
    members = pairs.join(often, "a", "left").select("a", F.pmod(F.xxhash64("b"), salts).alias("salt"), "b", F.col("b").alias("node"))
    leads = pairs.select("a").distinct().join(often, "a", "left")
    salt = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("salt")
    leads = leads.select("a", salt, F.lit(None).cast("bigint").alias("b"), F.col("a").alias("node"))
    rows = leads.union(members).join(sets, "node").select("a", "salt", "b", "shingles")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    schema = "a bigint, b bigint" + (", minus binary, plus binary, lead_n bigint" if differences else "")
    return stored(mapped(rows, _against_lead(percent, differences), schema), label)


def _of_nodes(texts: DataFrame, nodes: DataFrame, run, schema: str, select: bool) -> DataFrame:
    """What ``run`` makes of the texts of ``nodes(node, doc_id, print)``, a stored table, beside their node. Where there are too many nodes to
    send to the tasks, texts are selected by a shuffle, or (``select`` false, for small results) afterwards."""
    wanted = nodes.select(F.col("doc_id").alias("_id")).distinct()
    few = nodes.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    if few or select:
        wanted = F.broadcast(wanted) if few else wanted
        texts = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["_id"]), "left_semi")
    rows = mapped(texts, run, schema).dropDuplicates(["print"])
    return rows.join(nodes.select("print", "node"), "print").drop("print")


def _discard(table: DataFrame) -> None:
    """Delete a stored table that all readers are done with."""
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(table.inputFiles()[0]).getParent()
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def similar_sets(
    docs: DataFrame, width: int = 5, percent: int = 80, common: int = COMMON, late: int = LATE, rounds: int = ROUNDS, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ..)``: doc_id, n_shingles, component_id.

    Words are runs of characters other than ASCII white space, A-Z in lower case. Texts are linked if 100 * intersection >= percent * union of
    their sets of ``width``-word shingles; a text with fewer words is one shingle; without words, or null, it has none and is linked with
    nothing. component_id is the smallest doc_id reachable over links; a null doc_id is never the smallest beside another. Rows
    that repeat a doc_id each have their own text's component. Texts of any length are taken whole. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text(docs).alias("text"))
    columns = "doc_id bigint, n bigint, print binary, bits array<bigint>, tokens array<bigint>"
    signed = mapped(texts, _index(width, percent, None), columns)
    signed = stored(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    classes = signed.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("node"))
    classes = stored(classes, "classes")
    index = signed.join(classes.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), "n", "tokens")

    found = np.empty(0, np.int64), np.empty(0, np.int64)
    index = stored(index, "index")
    for left in reversed(range(rounds)):
        counts = stored(index.select(F.explode("tokens").alias("token")).groupBy("token").count().where("count > 1"), "counts")
        if not left or late <= len(found[0]):
            break
        new = counts.where(F.col("count") > common).orderBy(F.desc("count"), "token").limit(late).toPandas()
        new = new[~new["token"].isin(found[0])].head(late - len(found[0]))
        if not len(new):
            break
        found = np.concatenate([found[0], new["token"]]), np.concatenate([found[1], new["count"]])
        order = np.argsort(found[0].view(np.uint64))
        ranks = np.empty(len(order), np.int64)
        ranks[np.lexsort((found[0], found[1]))] = np.arange(len(order))
        sent = spark.sparkContext.broadcast((found[0].view(np.uint64)[order], ranks[order]))
        moved = F.broadcast(counts.where(F.col("count") > common).orderBy(F.desc("count"), "token").limit(late))
        touched = index.select("node", F.explode("tokens").alias("token")).join(moved, "token").select("node").distinct()
        touched = stored(touched.join(classes, "node"), "touched")
        again = _of_nodes(texts, touched, _index(width, percent, sent), columns, select=False)
        kept = index.join(small_or_shuffled(touched.select("node")), "node", "left_anti")
        before, index = index, stored(kept.unionByName(again.select("node", "n", "tokens")), "index")
        _discard(before)

    # Blocks of list entries: sizes from ``low`` on and below ``high``, each bound 100 / percent times the one before it.
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(bounds[-1] * 100 // percent + 1)
    edges = F.array(*(F.lit(b).cast("bigint") for b in bounds))
    entries = index.select("node", "n", F.posexplode("tokens").alias("pos", "token")).join(counts.select("token"), "token")
    entries = entries.withColumn("band", F.size(F.filter(edges, lambda b: b <= F.col("n"))))
    # With its first common shingle at ``pos`` a set has at most n - pos in common with another, which limits the other's size.
    most = F.floor((F.col("n") - F.col("pos")) * (100 + percent) / percent + 1e-9).cast("bigint") - F.col("n")
    reach = most >= F.element_at(edges, F.col("band") + 1)
    blocks = F.when(reach, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    entries = entries.select("token", "node", "n", most.alias("most"), "band", F.explode(blocks).alias("up"))
    hits = stored(entries.select("token", (F.col("band") + F.col("up")).alias("band"), "node", "n", "most", (F.col("up") == 0).alias("own")), "hits")
    lists = hits.groupBy("token", "band").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.when(F.col("own"), F.col("node"))).alias("lead"), F.bit_xor(F.xxhash64("node", "own")).alias("mark")
    )
    lists = stored(lists.where("size > 1 and lead is not null"), "lists")
    _discard(index)

    few = hits.join(lists.where(F.col("size") <= common).select("token", "band"), ["token", "band"])
    few = few.groupBy("token", "band").agg(F.sort_array(F.collect_list(F.struct("node", "n", "most", "own"))).alias("m"))

    def fits(x, y):
        near = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent
        return (x["node"] < y["node"]) & (x["own"] | y["own"]) & near & (x["n"] <= y["most"]) & (y["n"] <= x["most"])

    pairs = F.flatten(F.transform("m", lambda x: F.transform(F.filter("m", lambda y: fits(x, y)), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))
    pairs = few.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    long = lists.where(F.col("size") > common).dropDuplicates(["size", "lead", "mark"]).select("token", "band", "lead", "size")
    long = stored(long, "long")
    many = stored(hits.join(small_or_shuffled(long), ["token", "band"]).select("token", "band", "lead", "size", "node", "n"), "many")
    pairs = stored(pairs.union(many.where("node != lead").select("lead", "node")).distinct(), "pairs")

    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "ends")
    patterns = stored(signed.join(small_or_shuffled(ends), "row").select("row", "n", "bits"), "patterns")
    for end in ("a", "b"):
        pairs = pairs.join(patterns.select(F.col("row").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}")), end)
    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    common_at_most = F.least("n_a", "n_b", F.floor((F.col("n_a") + F.col("n_b") - differ) / 2))
    pairs = pairs.where(100 * common_at_most >= percent * (F.col("n_a") + F.col("n_b") - common_at_most)).select("a", "b")
    pairs = stored(pairs, "candidates")
    links = _compared(pairs, _full_sets(texts, classes, pairs, width), percent, False, "links")
    groups = stored(components(links), "groups")

    marked = many.join(groups, "node", "left").select("token", "band", "lead", "size", "node", "n", F.coalesce("component", "node").alias("joined"))
    marked = stored(marked, "marked")
    opened = marked.groupBy("token", "band", "lead", "size").agg(F.min("joined").alias("x"), F.max("joined").alias("y")).where("x != y")
    opened = stored(opened.select("token", "band", "lead", "size"), "opened")
    if not opened.isEmpty():
        links = links.union(_left_open(marked, opened, groups, texts, classes, width, percent, block))
        groups = stored(components(links), "groups")

    least = groups.join(classes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = classes.join(groups, "node", "left").join(small_or_shuffled(stored(least, "least")), "component", "left")
    named = named.select(F.col("print").alias("_print"), F.coalesce("component_id", "doc_id").alias("component_id"))
    out = signed.join(named, signed["print"] == named["_print"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _full_sets(texts: DataFrame, classes: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of all that ``pairs(a, b)`` name."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = stored(needed.join(classes, "node"), "needed")
    return stored(_of_nodes(texts, needed, _sets(width), "print binary, shingles binary", select=True), "sets")


def _left_open(
    marked: DataFrame, opened: DataFrame, groups: DataFrame, texts: DataFrame, classes: DataFrame, width: int, percent: int, block: int
) -> DataFrame:
    """Links between members of long blocks that the comparison with the lead did not join."""
    members = marked.join(small_or_shuffled(opened.select("token", "band")), ["token", "band"])
    # Lists with the same lead hold much the same sets: they are taken as one where that compares less.
    apart = opened.groupBy("lead").agg(F.sum(F.col("size") * F.col("size")).alias("apart"))
    every = members.select("lead", "node").distinct().groupBy("lead").count()
    once = stored(apart.join(every, "lead").where("count * count <= apart").select("lead", F.lit(True).alias("once")), "once")
    key = F.when(F.col("once"), F.lit(0).cast("bigint")).otherwise(F.xxhash64("token", "band"))
    members = members.join(small_or_shuffled(once), "lead", "left").select("lead", key.alias("key"), "node", "n", "joined").distinct()
    core = groups.select(F.col("node").alias("lead"), F.col("component").alias("core"))
    core = stored(opened.select("lead").distinct().join(core, "lead", "left").select("lead", F.coalesce("core", "lead").alias("core")), "core")
    members = members.join(small_or_shuffled(core), "lead").withColumn("rest", F.col("joined") != F.col("core"))
    members = stored(members.select("lead", "key", "node", "n", "joined", "rest"), "members")
    tally = members.groupBy("lead", "key").agg(
        *(
            F.greatest(F.ceil(F.count_if(side) / block), F.ceil(F.sum(F.when(side, F.col("n")).otherwise(0)) / BLOCK_SHINGLES)).alias(name)
            for name, side in (("core_blocks", ~F.col("rest")), ("rest_blocks", F.col("rest")))
        )
    )
    split = members.join(small_or_shuffled(stored(tally.where("rest_blocks > 0"), "tally")), ["lead", "key"])
    # Blocks of the rest are numbered first, then those of the core, which is joined already: core blocks meet blocks of the rest only.
    own = F.when(F.col("rest"), F.pmod(F.xxhash64("node"), F.col("rest_blocks"))).otherwise(
        F.col("rest_blocks") + F.pmod(F.xxhash64("node"), F.col("core_blocks"))
    )
    last = F.when(F.col("rest"), F.col("rest_blocks") + F.col("core_blocks") - 1).otherwise(F.col("rest_blocks") - 1)
    split = split.select("lead", "key", "node", "joined", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("with"))
    split = split.select("lead", "key", "node", "joined", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"))
    wanted = stored(members.select(F.col("lead").alias("a"), F.col("node").alias("b")).where("a != b").distinct(), "wanted")
    answers = _compared(wanted, _full_sets(texts, classes, wanted, width), percent, True, "answers").withColumnsRenamed({"a": "lead", "b": "node"})
    more = split.join(answers, ["lead", "node"]).groupBy("lead", "key", "lo", "hi").applyInPandas(_derive(percent), "a bigint, b bigint")
    return stored(more.distinct(), "more_links")
