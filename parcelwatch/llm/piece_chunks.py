"""SentencePiece ids from a table of distinct chunks.

No piece of the vocabulary holds a white-space marker after another character, nor a line feed. So a text can be
cut before every marker and around line feeds, each distinct chunk be segmented once, and the ids be joined
back by position. The table lives in the Python worker, bounded in size: a table over the whole corpus
would have to be joined back through a shuffle of every word. Where two markers meet, a piece may hold
both; such a text, rare in prose, goes to the library whole. The vocabulary is checked when it is loaded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, whole_text, worker_table

MARK = "▁"


class PieceChunks:
    """``ids(text)`` gives begin id, ids and end id as little-endian 32-bit integers."""

    def __init__(self, path: str, max_chunks: int = 150_000):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.first, self.last = (int(i).to_bytes(4, "little") for i in (self.sp.bos_id(), self.sp.eos_id()))
        mark = self.sp.piece_to_id(MARK)
        # Chunks can be joined back if pieces stay inside them, and if white space is kept as it is, with a marker in front.
        self.split = (
            not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
            and self.sp.encode("\n", out_type=int)[0] == mark
            and self.sp.decode(self.sp.encode(" a  b ")) == " a  b "
        )
        self.mark = mark.to_bytes(4, "little")
        self.max_chunks = max_chunks
        self.table: dict[str, bytes] = {"": self.mark}

    def _library(self, text: str) -> bytes:
        return np.array(self.sp.encode(text, num_threads=1), "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        ids = self._library(chunk)
        return ids[4:] if chunk[0] == "\n" else ids  # the library puts a marker in front

    def ids(self, text: str) -> bytes:
        if not text:
            return self.first + self.last
        if not self.split or text[0] == " " or "  " in text or MARK in text:
            return self.first + self._library(text) + self.last
        chunks = text.replace("\n", " \n").split(" ")
        table = self.table
        try:
            return self.first + b"".join([table[c] for c in chunks]) + self.last
        except KeyError:
            pass
        if len(table) > self.max_chunks:
            table.clear()
            table[""] = self.mark
        out = [self.first]
        for c in chunks:
            got = table.get(c)
            if got is None:
                got = self._chunk(c)
                if len(c) <= 64:
                    table[c] = got
            out.append(got)
        out.append(self.last)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return self.sp.decode(np.frombuffer(ids, "<u4").tolist())


def piece_chunks(path: str) -> PieceChunks:
    """One table per Python worker."""
    return worker_table(("pieces", path), lambda: PieceChunks(path))


def encoded_pieces(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row; ``with_ids`` adds the ids.

    Null text counts as empty and gives the begin and end ids alone. Other columns are not read.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def encoded(part: pa.RecordBatch) -> pa.RecordBatch:
        pieces = piece_chunks(model)
        ids = [pieces.ids(t.as_py()) for t in part.column(1)]
        columns = [
            part.column(0),
            pa.array([len(i) // 4 for i in ids], pa.int64()),
            pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
            pa.array([hashlib.sha256(pieces.decode(i).encode()).hexdigest() for i in ids]),
        ]
        if with_ids:
            offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield encoded(batch.slice(at, 256))

    return mapped(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text(docs).alias("text")), run, schema)
