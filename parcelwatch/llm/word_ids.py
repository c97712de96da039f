"""Ids of the word-end BPE tokenizer, segmenting each distinct word once.

The tokenizer drops white space and never joins characters across it, so a text's ids are its words' ids in
order. A table of words seen, bounded in size, saves most of the work; what it misses goes to the library. The table has two
generations: when the younger is full it becomes the older, and words that come again move back, so that a flood of
rare words does not push out the frequent ones.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

from .common import worker_table

_BIG_ENDIAN = sys.byteorder == "big"
# Letters up to U+024F, but for one, keep their number in lower case and are composed already.
_LETTERS = "".join(chr(c) for c in range(0x250) if chr(c).isalpha() and chr(c) != "İ")
_ALPHA = re.compile(rf"([{_LETTERS}]+)([!-/:-@\[-`{{-~]*)")
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
# A full stop or comma between an ASCII letter and white space is a word of its own to the library.
_STOP, _COMMA = (re.compile(rb"%b(?<=[a-z]%b)(?=[ \n]|\Z)" % (c, c)) for c in (rb"\.", b","))


def byte_letters() -> dict[str, str]:
    """Latin-1 character -> the printable letter that byte-level vocabularies use for its byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(b)] = chr(256 + n)
    return out


class WordIds:
    """``ids(text)`` gives the ids of a whole text as little-endian 16-bit integers."""

    def __init__(self, path: str, max_words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.model = self.tokenizer.model
        self.max_words = max_words
        self.table: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {b"": b""}
        self.letters = {ord(a): b for a, b in byte_letters().items()}

    def _library(self, text: str) -> bytes:
        return b"".join(i.to_bytes(2, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _model(self, stem: str) -> bytes:
        ids = array("H", [t.id for t in self.model.tokenize(stem)])
        if _BIG_ENDIAN:
            ids.byteswap()
        return ids.tobytes()

    def _tail(self, tail: bytes) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {b"": b""}
            self.tails[tail] = self._library(tail.decode())
        return self.tails[tail]

    def _word(self, word: bytes) -> bytes:
        stem = word.rstrip(_PUNCTUATION)
        tail = word[len(stem) :]
        # The library's normaliser and splitter leave a word of letters whole, and its model can be asked directly.
        if b"<|" not in tail:
            if stem.isalpha():  # ASCII letters alone
                low = stem.lower()
                got = (self.table.get(low) or self.older.get(low)) if tail else None
                return (got or self._model(low.decode())) + self._tail(tail)
            m = _ALPHA.fullmatch(word.decode())
            if m:
                return self._model(m[1].lower().encode().decode("latin-1").translate(self.letters)) + self._tail(tail)
        return self._library(word.decode())

    def ids(self, text: str) -> bytes:
        raw = text.encode()
        # Special tokens are matched by their exact spelling, so a text that may hold one keeps its case.
        words = (raw if b"<|" in raw else _COMMA.sub(b" ,", _STOP.sub(b" .", raw.lower()))).split()
        if len(self.table) > self.max_words // 2:
            self.older, self.table = self.table, {}
        table, older = self.table, self.older
        out = list(map(table.get, words))
        if None not in out:
            return b"".join(out)
        for i, got in enumerate(out):
            if got is None:
                w = words[i]
                got = table.get(w) or older.get(w)
                if got is None:
                    got = self._word(w)
                if len(w) <= 64:
                    table[w] = got
                out[i] = got
        return b"".join(out)


def word_ids(path: str) -> WordIds:
    """One table per Python worker."""
    return worker_table(("words", path), lambda: WordIds(path))
