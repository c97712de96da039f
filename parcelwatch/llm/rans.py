"""Token ids in compressed files: static range asymmetric numeral systems.

Documents are turned into ids where they are read, and the ids are dealt into ranges of ascending doc_id: texts are
not shuffled. A task puts the ids of its documents into one stream and cuts it into segments of at most ``SEGMENT`` ids. A segment is one row of a Parquet table and holds:

* one frequency table (symbols, freqs), summing to 2^20, that all its blocks share;
* blocks of equal length, each coded on its own with 128 interleaved coder states. Per block a checkpoint
  (the states at its start and the place of its first word) and a CRC-32 of its words, so that any
  block can be checked and decoded without the others, or all blocks side by side, as ``decode`` does;
* the documents that lie in it, whole or in part: doc_id, number of ids, number of ids before.

States have 64 bits and give off 32 bits at a time. Parquet carries the rows, so a file is either there whole
or not at all when an executor is lost, and any file system that Spark reads will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from parcelwatch.sources.scratch import scratch_dir

from .common import mapped, stored, whole_text
from .word_ids import word_ids

SEGMENT = 1 << 21
BLOCK = 1 << 15
LANES = 128
SCALE_BITS = 20
SEGMENTS_PER_FILE = 16
_IDS_BYTES = 8 << 20
_LOW = np.uint64(1 << 31)
_32, _43 = np.uint64(32), np.uint64(31 - SCALE_BITS + 32)
_SCALE, _BITS = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)

SCHEMA = (
    "part int, segment int, first_id bigint, n_ids int, blocks int, steps int, symbols binary, freqs binary, "
    "words_from array<int>, states binary, words binary, crcs array<bigint>, "
    "doc_ids array<bigint>, doc_rows array<bigint>, doc_from array<int>, doc_n array<int>, doc_before array<bigint>"
)
_ARROW = pa.schema(
    [
        *((n, pa.int32()) for n in ("part", "segment")),
        ("first_id", pa.int64()),
        *((n, pa.int32()) for n in ("n_ids", "blocks", "steps")),
        *((n, pa.binary()) for n in ("symbols", "freqs")),
        ("words_from", pa.list_(pa.int32())),
        *((n, pa.binary()) for n in ("states", "words")),
        *((n, pa.list_(pa.int64())) for n in ("crcs", "doc_ids", "doc_rows")),
        *((n, pa.list_(pa.int32())) for n in ("doc_from", "doc_n")),
        ("doc_before", pa.list_(pa.int64())),
    ]
)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that occur, and their shares of 2^20, at least 1 each."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    if len(symbols) > 1 << (SCALE_BITS - 1):
        raise ValueError("too many different symbols for the scale")
    freqs = np.maximum(counts[symbols] * (1 << SCALE_BITS) // len(ids), 1)
    over = int(freqs.sum()) - (1 << SCALE_BITS)
    for i in np.argsort(-freqs, kind="stable"):  # too much comes off the greatest, what is left over goes to it
        take = min(over, int(freqs[i]) - 1) if over > 0 else over
        freqs[i] -= take
        over -= take
        if not over:
            break
    return symbols.astype(np.uint32), freqs.astype(np.uint32)


def _by_symbol(symbols: np.ndarray, freqs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = int(symbols[-1]) + 1
    freq, start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
    freq[symbols] = freqs
    start[symbols] = np.cumsum(freqs, dtype=np.uint64) - freqs
    return freq, start


def encode(ids: np.ndarray) -> dict:
    """Code a non-empty segment of ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    steps = -(-n // (blocks * LANES))
    symbols, freqs = frequencies(ids)
    freq, start = _by_symbol(symbols, freqs)
    padded = np.full(blocks * steps * LANES, symbols[np.argmax(freqs)], np.uint32)
    padded[:n] = ids
    padded = padded.reshape(blocks, steps, LANES)
    x = np.full(blocks * LANES, _LOW, np.uint64)
    words, owners = [], []
    for s in range(steps - 1, -1, -1):
        sym = padded[:, s, :].ravel()
        f = freq[sym]
        full = np.flatnonzero(x >= (f << _43))
        words.append(x[full].astype(np.uint32))
        owners.append((full // LANES).astype(np.uint16))
        x[full] >>= _32
        q = x // f
        x = (q << _BITS) + (x - q * f) + start[sym]
    words, owners = np.concatenate(words[::-1]), np.concatenate(owners[::-1])  # in the order of decoding
    words = words[np.argsort(owners, kind="stable")].astype("<u4")
    ends = np.cumsum(np.bincount(owners, minlength=blocks))
    begins = np.concatenate([[0], ends[:-1]])
    return {
        "n_ids": n, "blocks": blocks, "steps": steps, "symbols": symbols.astype("<u4").tobytes(), "freqs": freqs.astype("<u4").tobytes(),
        "words_from": begins.tolist(), "states": x.astype("<u8").tobytes(), "words": words.tobytes(),
        "crcs": [zlib.crc32(words[a:b]) for a, b in zip(begins, ends, strict=True)],
    }


def decode(segment: dict, block: int | None = None) -> np.ndarray:
    """The ids of a segment, or of one of its blocks. Raises ValueError if words or states are damaged."""
    blocks, steps = segment["blocks"], segment["steps"]
    symbols, freqs = np.frombuffer(segment["symbols"], "<u4"), np.frombuffer(segment["freqs"], "<u4")
    freq, start = _by_symbol(symbols, freqs)
    slots = np.repeat(symbols, freqs)
    words = np.frombuffer(segment["words"], "<u4").astype(np.uint64)
    begins = np.array(segment["words_from"], np.int64)
    picked = np.arange(blocks) if block is None else np.array([block])
    for b in picked:
        end = begins[b + 1] if b + 1 < blocks else len(words)
        if zlib.crc32(segment["words"][4 * begins[b] : 4 * end]) != segment["crcs"][b]:
            raise ValueError(f"block {b} is damaged")
    x = np.frombuffer(segment["states"], "<u8").reshape(blocks, LANES)[picked].ravel().copy()
    at = begins[picked].copy()
    out = np.empty((len(picked), steps, LANES), np.uint32)
    for s in range(steps):
        slot = x & _SCALE
        sym = slots[slot]
        out[:, s, :] = sym.reshape(-1, LANES)
        x = freq[sym] * (x >> _BITS) + slot - start[sym]
        low = np.flatnonzero(x < _LOW)
        taken = np.bincount(low // LANES, minlength=len(picked))
        before = np.cumsum(taken) - taken
        x[low] = (x[low] << _32) | words[np.arange(len(low)) + np.repeat(at - before, taken)]
        at += taken
    if (x != _LOW).any():
        raise ValueError("states do not return to their start")
    ids = out.ravel()
    if block is None:
        return ids[: segment["n_ids"]]
    return ids[: max(0, min(steps * LANES, segment["n_ids"] - block * steps * LANES))]


def _encoder(path: str, end_id: int):
    """(doc_id, tie, text) -> (doc_id, tie, ids), in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(path), end_id.to_bytes(2, "little")
        for batch in batches:
            first, size, out = 0, 0, []
            for text in batch.column(2):
                out.append(words.ids(text.as_py()) + end)
                size += len(out[-1])
                if size >= _IDS_BYTES or first + len(out) == batch.num_rows:
                    rows = [batch.column(i).slice(first, len(out)) for i in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*rows, pa.array(out, pa.binary())], ["doc_id", "tie", "ids"])
                    first, size, out = first + len(out), 0, []

    return run


def _writer():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        state = {"segment": 0, "first": 0, "size": 0}
        held: list[bytes] = []
        docs: list[tuple] = []  # doc_id, row, from, n, before

        def flush() -> pa.RecordBatch:
            row = encode(np.frombuffer(b"".join(held), "<u2"))
            row |= {"part": part, "segment": state["segment"], "first_id": state["first"]}
            row |= {k: [d[i] for d in docs] for i, k in enumerate(("doc_ids", "doc_rows", "doc_from", "doc_n", "doc_before"))}
            state["segment"] += 1
            state["first"] += state["size"]
            state["size"] = 0
            held.clear()
            docs.clear()
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        n = 0
        for batch in batches:
            for doc_id, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = row.as_py()
                at = 0
                while at < len(ids):
                    piece = ids[at : at + 2 * (SEGMENT - state["size"])]
                    docs.append((doc_id, n, state["size"], len(piece) // 2, at // 2))
                    held.append(piece)
                    state["size"] += len(piece) // 2
                    at += len(piece)
                    if state["size"] == SEGMENT:
                        yield flush()
                n += 1
        if docs:
            yield flush()

    return run


def write_ids(docs: DataFrame, tokenizer: str, to: str, end_id: int = 1) -> None:
    """Write the ids of ``docs(doc_id, text)`` to the folder ``to``, in ascending order of doc_id (null first; rows
    with the same doc_id in order of their texts)."""
    text = whole_text(docs)
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    # Dealing by range reads its input twice, so the ids are kept between the two.
    ids = stored(mapped(read, _encoder(tokenizer, end_id), "doc_id bigint, tie bigint, ids binary"), "word-ids")
    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    mapped(ordered, _writer(), SCHEMA).write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).parquet(to)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def crc32_joined(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings after one another, from theirs and the length of the second."""

    def times(matrix: list[int], vector: int) -> int:
        out = 0
        for row in matrix:
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    # One zero byte more is a linear map of the checksum; its powers of two are put together to ``size`` bytes.
    step = [zlib.crc32(b"\0", 1 << b) ^ zlib.crc32(b"\0", 0) for b in range(32)]
    while size:
        if size & 1:
            first = times(step, first)
        step = [times(step, row) for row in step]
        size >>= 1
    return first ^ second


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = decode(row).astype("<u4")
            a = np.array(row["doc_from"], np.int64)
            n = np.array(row["doc_n"], np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([row["part"]] * len(a), pa.int32()),
                    "doc_row": pa.array(row["doc_rows"], pa.int64()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "place": pa.array(row["first_id"] + a, pa.int64()),
                    "n": pa.array(n, pa.int64()),
                    "crc": pa.array([zlib.crc32(ids[x : x + k]) for x, k in zip(a, n, strict=True)], pa.int64()),
                }
            )


@F.pandas_udf(LongType())
def _joined(pieces: pd.Series) -> pd.Series:
    def one(rows) -> int:
        rows = list(rows)
        out = rows[0]["crc"]
        for r in rows[1:]:
            out = crc32_joined(out, r["crc"], 4 * r["n"])
        return out

    return pieces.map(one)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold, decoded: doc_id, start, n_tokens, ids_crc32, one row per document.

    The ids of a document that lies in several segments are not put together; their checksums are.
    """
    segments = read_segments(spark, path)
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("size"))
    starts = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))
    pieces = mapped(segments, _reader, "part int, doc_row bigint, doc_id bigint, place bigint, n bigint, crc bigint")
    whole = pieces.groupBy("part", "doc_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("place").alias("place"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("place", "n", "crc"))).alias("pieces"),
    )
    return whole.join(starts, "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", _joined("pieces").alias("ids_crc32")
    )


def encoded_index(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to a new folder and read it back; see ``write_ids`` and ``read_index``.

    Null text counts as empty and gives the end id alone. Rows with the same doc_id are documents of their own.
    An empty table gives no rows. Other columns are not read.
    """
    path = scratch_dir(docs.sparkSession, "ids")
    write_ids(docs, tokenizer, path, end_id)
    return read_index(docs.sparkSession, path)
