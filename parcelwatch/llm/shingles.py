"""Word shingles as 64-bit hashes, and SuperMinHash signatures of sets of them."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
#: Odd multipliers that tell the places in a shingle apart, and those of a 64-bit finaliser.
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


class Shingler:
    """``hashes(text)``: the distinct shingles of ``width`` words, sorted; words are runs of characters other than
    ASCII white space, A-Z in lower case. A text with fewer words is one shingle; one without words has none."""

    def __init__(self, width: int, max_words: int = 150_000):
        self.width, self.max_words = width, max_words
        self.table: dict[bytes, bytes] = {}

    def _words(self, words: list[bytes]) -> bytes:
        table = self.table
        try:
            return b"".join([table[w] for w in words])
        except KeyError:
            pass
        if len(table) > self.max_words:
            table.clear()
        digest = xxhash.xxh64_digest
        for w in words:
            if w not in table:
                table[w] = digest(w)
        return b"".join([table[w] for w in words])

    def hashes(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, _U)
        h = np.frombuffer(self._words(words), "<u8").astype(_U)
        k = min(self.width, len(h))
        out = np.full(len(h) - k + 1, k, _U)
        for i in range(k):
            out = (out ^ h[i : len(h) - k + 1 + i]) * _ODD[i % len(_ODD)]
            out ^= out >> _U(29)
        out = np.sort(mixed(out))
        return out[np.concatenate([[True], out[1:] != out[:-1]])]


def signatures(hashes: np.ndarray, doc: np.ndarray, docs: int, size: int, chunk: int = 1 << 16) -> np.ndarray:
    """SuperMinHash signatures, one row of ``size`` numbers per document, of the sets that ``hashes`` holds; ``doc``
    says whose each one is. Empty sets keep infinity.

    Each element has a random permutation of the places and a random number per rank; place p of the signature is
    the least rank + number with which any element comes to p. Elements go through the ranks side by side, and
    leave when the next rank is above every number of their document's signature: with n elements after about
    1 + size ln(size) / n ranks. A chunk of elements bounds the memory, whatever the length of a text.
    """
    least = np.full(docs * size, np.inf)
    steps = np.arange(1, size + 1, dtype=_U) * _ODD[0]
    perm = np.tile(np.arange(size, dtype=np.uint16), (min(chunk, max(len(hashes), 1)), 1))
    for at in range(0, len(hashes), chunk):
        h, d = hashes[at : at + chunk], doc[at : at + chunk]
        rows = np.arange(len(h))
        first, end = d[0], d[-1] + 1
        touched = []
        for j in range(size):
            top = least[first * size : end * size].reshape(-1, size).max(1)
            alive = top[d[rows] - first] > j
            if not alive.all():
                rows = rows[alive]
            if not len(rows):
                break
            x = mixed(h[rows] + steps[j])
            k = j + (((x & _U(0xFFFFFF)) * _U(size - j)) >> _U(24)).astype(np.int64)
            place = perm[rows, k]
            perm[rows, k] = perm[rows, j]
            touched.append((rows, k))
            value = j + (x >> _U(24)).astype(np.float64) * 2.0**-40
            to = d[rows] * size + place
            better = value < least[to]
            np.minimum.at(least, to[better], value[better])
        for j, (r, k) in enumerate(touched):
            perm[r, k] = k
            perm[r, j] = j
    return least.reshape(docs, size)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band of ``rows`` places."""
    bits = signature[:, : bands * rows].reshape(-1, bands, rows).view(_U)
    out = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=_U)), bits.shape[:2]).copy()
    for i in range(rows):
        out = mixed(out * _ODD[1] + bits[:, :, i])
    return out.view(np.int64)
