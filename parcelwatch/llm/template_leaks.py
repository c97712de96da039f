"""Benchmark passages in documents, also with other numbers, names and units put in.

Texts become words in canonical form: a number, a unit after a number, or a name (a capitalised word that does not
begin a sentence) is a typed placeholder; other words are in lower case. Three forms are kept side by side: with and
without placeholders for names, so that a passage in other case is found as well, and the words as they are (literal).
In scripts without spaces every character is a word. Windows of ``WINDOW`` words are hashed and joined to the windows
of the benchmark. With placeholders, a window with fewer than ``LITERAL`` ordinary words says nothing and is left out;
a literal one may hold numbers and units only. An item shorter than a window is one window. One of fewer than
``LITERAL`` words is found literally, with its signs, if words and signs are that many; a shorter one says nothing.

Items that differ only in numbers, names and units, and repeat them at the same places, are one *family*. Windows are
joined and judged by family, so thousands of items made from one template cost what one of them costs; the literal
windows of each member count for the family. ``item_families`` gives the members.

Windows that match go on to the slot check, occurrence by occurrence: windows whose places in document and item are
equally far apart are one occurrence, also those that differ by up to ``DRIFT`` words (a name of two words), and the
document as a whole is tried as well. Within one, a value in a slot of the item must stand for one value
throughout. Where a value meets two, only windows of the most frequent reading are counted, and those with a member's
own words. A document is reported for a family if the windows left of its best occurrence cover at least
``COVER`` of the family's windows, or if it holds ``RUN`` consecutive words literally, of which ``LITERAL``
are ordinary words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, small_or_shuffled, stored, whole_text, worker_table

WINDOW = 8
LITERAL = 5
COVER = 0.5
RUN = 13
#: Most words by which two alignments of one occurrence differ.
DRIFT = 4
#: Most benchmark windows that are sent to all tasks as they are; of more, marks of this many bits are sent (8 MB).
BROADCAST_WINDOWS = 2_000_000
MARK_BITS = 26
#: Bytes of documents that are read at once.
CHUNK = 1 << 18
_U = np.uint64
#: Units that a number may stand before.
UNITS = frozenset(
    "mm cm m km mg g kg t ml l s sec min h hr hrs hour hours minute minutes second seconds day days week weeks month months year years "
    "inch inches foot feet ft yard yards mile miles pound pounds lb lbs ounce ounces oz gallon gallons liter liters litre litres "
    "meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms ton tons "
    "dollar dollars cent cents euro euros usd eur percent degree degrees kmh mph kw kwh w v hz khz mhz ghz kb mb gb tb".split()
)
#: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"[0-9]+(?:[.,:/][0-9]+)*|[^\W\d_{_UNSPACED}]+|[.!?\n%€$£]|[{_UNSPACED}]")
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
_ASCII_TOKEN = re.compile(r"[0-9]+(?:[.,:/][0-9]+)*|[A-Za-z]+|[.!?\n%$]")
#: Words and signs of items too short for windows.
_SIGN = re.compile(r"[^\W_]+|[^\w\s]|_")
#: Characters on either side of a hit by a short item in which its outer signs are looked for.
MARGIN = 64
_ENDS = frozenset(".!?\n")
_SIGNS = frozenset("%€$£")
NUMBER, UNIT, NAME = 1, 2, 3
#: Forms: placeholders for numbers and units, for names as well, none.
PLAIN, NAMED, EXACT = 0, 1, 2


def _near_token() -> re.Pattern:
    """``_TOKEN`` for texts of the basic plane: with its letters as ranges, which are matched by a table."""
    letter = re.compile(rf"[^\W\d_{_UNSPACED}]")
    ranges, start = [], None
    for i in range(0x10001):
        inside = i < 0x10000 and letter.match(chr(i)) is not None
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            ranges.append(f"\\u{start:04x}-\\u{i - 1:04x}")
            start = None
    return re.compile(rf"[0-9]+(?:[.,:/][0-9]+)*|[{''.join(ranges)}]+|[.!?\n%€$£]|[{_UNSPACED}]")


#: What is known of a token by itself is one number: its kind plus one (0: ends a sentence) in two bits, whether it may
#: be a name, whether it may be a unit, and 60 bits of hash.
_NAME_BIT, _UNIT_BIT, _CODE_BITS = 4, 8, 4


def _facts(token: str) -> bytes:
    low = token.lower()
    digest = xxhash.xxh64_intdigest(low.encode()) >> _CODE_BITS << _CODE_BITS
    if token[0].isalpha():
        code = 1 | (_NAME_BIT if token[0] != low[0] else 0) | (_UNIT_BIT if low in UNITS else 0)
    else:
        code = 1 + (-1 if token in _ENDS else UNIT if token in _SIGNS else NUMBER if token[0].isdecimal() else 0)
    return (digest | code).to_bytes(8, "little")


class Known(dict[str, bytes]):
    """Facts of tokens, in two generations: words that come back move to the younger one, and the older one is dropped."""

    def __init__(self, most: int):
        self.most, self.older = most, {}

    def __missing__(self, token: str) -> bytes:
        got = self.older.get(token) or _facts(token)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        if len(token) <= 64:
            self[token] = got
        return got


class Canonical:
    """``read(texts)``: the tokens of texts one after another, which of them are words, the text each word is of, the
    kind of slot of each word (0: none), and their hashes in the three forms."""

    def __init__(self, max_words: int = 100_000):
        self.known = Known(max_words)
        self.near = _near_token()
        self.slots = np.array([xxhash.xxh64_intdigest(b"\0slot" + bytes([k])) >> _CODE_BITS for k in range(4)], _U)

    def pattern(self, text: str) -> re.Pattern:
        """The quickest of the patterns that cut this text alike."""
        return _ASCII_TOKEN if text.isascii() else _TOKEN if _ASTRAL.search(text) else self.near

    def read(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        tokens: list[str] = []
        counts = []
        for text in texts:
            found = self.pattern(text).findall(text)
            found.append("\n")  # neither units nor names reach over the end of a text
            tokens += found
            counts.append(len(found))
        known = self.known
        facts = np.frombuffer(b"".join([known[t] for t in tokens]), "<u8")
        code = (facts & _U(15)).astype(np.int8)
        kind = (code & 3) - np.int8(1)
        if len(kind):
            number, end = kind[:-1] == NUMBER, kind[:-1] == -1
            unit = np.concatenate([[False], number]) & (code & _UNIT_BIT > 0)  # a unit is only one after a number
            kind[unit] = UNIT
            kind[(code & _NAME_BIT > 0) & (kind == 0) & ~np.concatenate([[True], end])] = NAME
        at = np.flatnonzero(kind >= 0)
        kind, exact = kind[at], facts[at] >> _U(_CODE_BITS)
        owner = np.repeat(np.arange(len(texts)), counts)[at]
        plain = np.where((kind == NUMBER) | (kind == UNIT), self.slots[kind], exact)
        return tokens, at, owner, kind, (plain, np.where(kind == NAME, self.slots[NAME], plain), exact)


def canonical_words() -> Canonical:
    """One table of known words per Python worker."""
    return worker_table("canonical", Canonical)


_P = 0x9E3779B97F4A7C15
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            steps = np.full(2 * n, base, _U)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def running_sums(words: np.ndarray) -> np.ndarray:
    """Sums of word hashes times powers by place, up to each place."""
    return np.concatenate([np.zeros(1, _U), np.cumsum(words * _power_table(len(words))[0])])


def window_hashes(sums: np.ndarray, form: int, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words, as differences of running sums."""
    n = len(sums) - size
    if n < 1 or size < 1:
        return np.zeros(0, _U)
    return (sums[size:] - sums[:-size]) * _power_table(n)[1] + _U((size << 2) + form)


def telling(kind: np.ndarray, form: int, size: int, at: np.ndarray) -> np.ndarray:
    """Of windows that start ``at`` these places, those with enough ordinary words (names count but in form NAMED)."""
    if form == EXACT:
        return at
    slots = np.concatenate([[0], np.cumsum(_slots(kind, form))])
    return at[size - (slots[at + size] - slots[at]) >= LITERAL]


def signs(text: str) -> str:
    """Words and signs in lower case, each between two spaces."""
    return f" {' '.join(_SIGN.findall(text.lower()))} "


def _slots(kind: np.ndarray, form: int) -> np.ndarray:
    """Which words are slots in a form."""
    return (kind > 0) if form == NAMED else (kind == NUMBER) | (kind == UNIT) if form == PLAIN else np.zeros(len(kind), bool)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    canonical = canonical_words()
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            tokens, order, _, kind, forms = canonical.read([text])
            size = min(WINDOW, len(order))
            short = signs(text) if size < LITERAL else None
            if short is not None and len(short.split()) < LITERAL:
                continue
            # A family: the same words beside the slots, and the same slots with equal values.
            first: dict[tuple[int, str], str] = {}
            keys = [first.setdefault((k, tokens[i].lower()), str(len(first))) if k > 0 else "" for k, i in zip(kind.tolist(), order, strict=True)]
            shape = short.encode() if short else forms[NAMED].tobytes() + kind.tobytes() + " ".join(keys).encode()
            family = xxhash.xxh64_intdigest(shape) - (1 << 63)
            for form, h in enumerate(forms):
                hashes = window_hashes(running_sums(h), form, size)
                at = telling(kind, form, size, np.arange(len(hashes)))
                slots = _slots(kind, form)
                places = [a + np.flatnonzero(slots[a : a + size]) for a in at]
                n = len(at)
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": pa.array([item] * n, pa.int64()),
                        "family": pa.array([family] * n, pa.int64()),
                        "form": pa.array([form] * n, pa.int32()),
                        "item_at": pa.array(at, pa.int32()),
                        "total": pa.array([n] * n, pa.int32()),
                        "size": pa.array([size] * n, pa.int32()),
                        "hash": pa.array(hashes[at].view(np.int64)),
                        "item_words": pa.array([[keys[i] for i in p] for p in places], pa.list_(pa.string())),
                        "kinds": pa.array([kind[a : a + size].tolist() if form == EXACT else kind[p].tolist() for a, p in zip(at, places, strict=True)], pa.list_(pa.int32())),
                        "short": pa.array([short] * n, pa.string()),
                    }
                )


_ITEM = "item_id bigint, family bigint, form int, item_at int, total int, size int, hash bigint, item_words array<string>, kinds array<int>, short string"
_HIT = "doc_id bigint, row bigint, doc_at int, hash bigint, doc_words array<string>, around string"


def _around(text: str, size: int, at: np.ndarray) -> list[str]:
    """Words and signs of windows that start ``at`` these words, and of the text beside them."""
    spans = [m.span() for m in _TOKEN.finditer(text) if m[0] not in _ENDS]
    return [signs(text[max(0, spans[a][0] - MARGIN) : spans[a + size - 1][1] + MARGIN]) for a in at]


class Wanted:
    """The hashes of the benchmark's windows: sorted where they are few, beyond that a table of marks, which lets
    some others through, for the join to tell off."""

    def __init__(self, hashes: np.ndarray | None = None, marks: np.ndarray | None = None):
        self.hashes, self.marks, self.bits = hashes, marks, MARK_BITS
        self.low: np.ndarray | None = None

    def places(self, found: np.ndarray) -> np.ndarray:
        if self.hashes is None:
            bit = found & _U((1 << self.bits) - 1)
            return np.flatnonzero(self.marks[bit >> _U(3)] >> (bit & _U(7)).astype(np.uint8) & 1)
        if self.low is None:
            self.low = np.zeros(1 << 22, bool)  # most windows are told off by their last bits
            self.low[self.hashes & _U((1 << 22) - 1)] = True
        at = np.flatnonzero(self.low[found & _U((1 << 22) - 1)])
        return at[self.hashes[np.searchsorted(self.hashes, found[at]).clip(max=len(self.hashes) - 1)] == found[at]]


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches (start, length) of texts of these sizes, of about ``CHUNK`` each; a text stays whole."""
    start = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= CHUNK:
            yield start, i + 1 - start
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes) - start


def _doc_windows(wanted: Wanted, sizes: list[tuple[int, int]]):
    """All windows of documents whose hash is ``wanted``; ``sizes`` are (form, size)."""

    def hits(ids: list, rows: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        tokens, order, owner, kind, forms = canonical_words().read(texts)
        first = np.searchsorted(owner, np.arange(len(texts)))
        for form, h in enumerate(forms):
            sums = running_sums(h)
            slots = _slots(kind, form)
            for size in (n for f, n in sizes if f == form):
                found = window_hashes(sums, form, size)
                at = wanted.places(found)
                at = telling(kind, form, size, at[owner[at] == owner[at + size - 1]])
                if not len(at):
                    continue
                of = owner[at]
                values = [[tokens[order[i]].lower() for i in a + np.flatnonzero(slots[a : a + size])] for a in at]
                beside = [None] * len(at)
                if size < LITERAL:
                    beside = [x for d in np.unique(of) for x in _around(texts[d], size, at[of == d] - first[d])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[d] for d in of], pa.int64()),
                        pa.array([rows[d] for d in of], pa.int64()),
                        pa.array(at - first[of], pa.int32()),
                        pa.array(found[at].view(np.int64)),
                        pa.array(values, pa.list_(pa.string())),
                        pa.array(beside, pa.string()),
                    ],
                    ["doc_id", "row", "doc_at", "hash", "doc_words", "around"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in _runs(pc.binary_length(batch.column(1)).to_pylist()):
                ids, texts, rows = (batch.column(i).slice(start, n).to_pylist() for i in range(3))
                yield from hits(ids, rows, texts)

    return run


def consistent(matches: list[dict]) -> set[int]:
    """Of matched windows (item_at, item_words, doc_words, kinds): the item_at whose slots are read alike.

    Each value in an item's slot has the reading that most windows give it; of equally frequent ones, the smallest.
    Windows with the item's own values (``own``) always count.
    """
    readings: dict[tuple, Counter] = {}
    for m in matches:
        for a, b, k in zip(m["item_words"], m["doc_words"], m["kinds"], strict=True):
            if k > 0:
                readings.setdefault((k, a), Counter())[b] += 1
    chosen = {key: min(c, key=lambda b: (-c[b], b)) for key, c in readings.items()}
    return {
        m["item_at"]
        for m in matches
        if m.get("own")
        or all(a == b if k <= 0 else chosen[(k, a)] == b for a, b, k in zip(m["item_words"], m["doc_words"], m["kinds"], strict=True))
    }


def _folded(matches: list[dict]) -> list[dict]:
    """Over one place of an item the same reading, however often it is repeated, is one match."""
    return list({(m["item_at"], tuple(m["doc_words"])): m for m in matches}.values())


def occurrences(matches: list[dict]) -> Iterator[list[dict]]:
    """Of the matched windows of an item in a document: those of each alignment, of alignments close to one another, and all."""
    aligned: dict[tuple[int, int], list[dict]] = {}
    for m in matches:
        aligned.setdefault((m["row"], m["doc_at"] - m["item_at"]), []).append(m)
    yield from aligned.values()
    if len(aligned) == 1:
        return
    chain: list[tuple[int, int]] = []
    for at in [*sorted(aligned), None]:
        if chain and (at is None or at[0] != chain[-1][0] or at[1] - chain[-1][1] > DRIFT):
            if len(chain) > 1:
                yield _folded([m for c in chain for m in aligned[c]])
            chain = []
        chain.append(at)
    yield _folded(matches)


def literal_run(matches: list[dict], run: int = RUN) -> bool:
    """Whether literal windows of one alignment of ``matches`` hold ``run`` consecutive words of the item with enough ordinary ones."""
    at = {(m["row"], m["doc_at"] - m["item_at"], m["item_at"]): m["kinds"] for m in matches}
    for (row, apart, a), first in at.items():
        more = run - len(first)
        if more >= 0 and all((row, apart, a + k) in at for k in range(more + 1)):
            kinds = first + [at[row, apart, a + k][-1] for k in range(1, more + 1)]
            if sum(k in (0, NAME) for k in kinds) >= LITERAL:
                return True
    return False


def _judge(cover: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                forms: list[list[dict]] = [[], [], []]
                for m in r["matches"]:
                    forms[m["form"]].append(m)
                own = {(m["row"], m["doc_at"], m["item_at"]) for m in forms[EXACT]}
                for form, matches in enumerate(forms):
                    if not matches:
                        continue
                    total = matches[0]["total"]
                    if form == EXACT:
                        good = max(len({m["item_at"] for m in o}) for o in occurrences(matches))
                    else:
                        for m in matches:
                            m["own"] = (m["row"], m["doc_at"], m["item_at"]) in own
                        good = max(len(consistent(o)) for o in occurrences(matches))
                    if good >= cover * total or (form == EXACT and literal_run(matches)):
                        out.append((r["doc_id"], r["nameless"], r["family"], good, total))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["doc_id", "nameless", "family", "windows", "total"]
            )

    return run


def _windows_of(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), whole_text(benchmark).alias("text"))
    return stored(mapped(items, _item_windows, _ITEM), "item_windows")


def item_families(benchmark: DataFrame) -> DataFrame:
    """item_id, family_item: each item, and the smallest item_id of the items that differ from it in slots only.

    Items that are not looked for have no row; repeated rows give one. Rows that share an item_id may be of several families.
    """
    each = _windows_of(benchmark).select("item_id", "family").distinct()
    return each.join(_smallest(each), "family").select("item_id", "family_item").distinct()


def _smallest(items: DataFrame) -> DataFrame:
    return items.groupBy("family").agg(F.min("item_id").alias("family_item"))


def _wanted(windows: DataFrame) -> Wanted:
    """What is sent to the tasks of the hashes in a stored table; its size does not depend on theirs."""
    hashes = windows.select("hash").distinct()
    if hashes.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        return Wanted(hashes=np.sort(hashes.toPandas()["hash"].to_numpy(np.int64).view(_U)))
    bit = F.col("hash").bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    # Pages of 32,768 bits, put together where the windows are.
    pages = hashes.groupBy(F.shiftright(bit, 15).alias("page")).agg(F.bitmap_construct_agg(bit.bitwiseAND(F.lit(32767))).alias("bits"))
    marks = np.zeros(1 << (MARK_BITS - 3), np.uint8)
    for r in pages.collect():
        marks[r["page"] * 4096 : (r["page"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return Wanted(marks=marks)


def _nameless(doc_id: Column, text: Column) -> Column:
    """What stands for the doc_id of rows without one: a hash of their text."""
    return F.when(doc_id.isNull(), F.xxhash64(text))


def _leaks(docs: DataFrame, benchmark: DataFrame, cover: float) -> DataFrame:
    items = _windows_of(benchmark)
    # Members of a family share their windows but for the values.
    windows = items.groupBy("hash", "form", "family", "item_at").agg(*(F.first(c).alias(c) for c in ("total", "size", "item_words", "kinds", "short")))
    windows = stored(windows, "family_windows")
    doc_id, text = F.col("doc_id").cast("bigint"), whole_text(docs)
    texts = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"))
    # Forms, and sizes of items shorter than a window; there are at most WINDOW of them in each form.
    sizes = sorted((r["form"], r["size"]) for r in windows.select("form", "size").distinct().collect())
    hits = stored(mapped(texts, _doc_windows(_wanted(windows), sizes), _HIT), "hits")
    found = hits.join(windows, "hash")
    # Items too short for windows: the signs must be there as well.
    found = found.where(F.col("short").isNull() | F.col("around").contains(F.col("short")))
    # Rows with the same doc_id are one document, those without are one for each text.
    nameless = F.when(F.col("doc_id").isNull(), F.col("row"))
    match = F.struct("form", "total", "row", "doc_at", "item_at", "item_words", "doc_words", "kinds")
    each = found.groupBy("doc_id", nameless.alias("nameless"), "family").agg(F.collect_set(match).alias("matches"))
    judged = mapped(each, _judge(cover), "doc_id bigint, nameless bigint, family bigint, windows int, total int")
    return (
        judged.join(_smallest(items), "family")
        .groupBy("doc_id", "nameless")
        .agg(
            F.sort_array(F.collect_set("family_item")).alias("item_ids"),
            F.max(F.col("windows") / F.col("total")).alias("cover"),
            F.sum("windows").cast("bigint").alias("windows"),
        )
    )


def leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """doc_id, item_ids, cover, windows: one row per document that holds a benchmark item, others have none.

    item_ids has the smallest item_id of each family found (see ``item_families``). cover is the largest share of a
    family's windows found; where a literal run reports a document it may be small. windows
    are those found of all these families, in each form. Null text on either side counts as empty and matches
    nothing, nor does an item of fewer than ``LITERAL`` words and signs. Rows with the same doc_id are one document; rows without
    are one for each text, and give a row with a null doc_id each. Rows of the benchmark that share an item_id are judged by
    themselves; a family none of whose items has an item_id is found as well, but adds nothing to item_ids. An empty table
    on either side gives no rows.
    """
    return _leaks(docs, benchmark, cover).drop("nameless")


def without_leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """The rows of ``docs`` in which no item of the benchmark is found, all columns; rows without doc_id go by their text."""
    gone = stored(_leaks(docs, benchmark, cover).select(F.col("doc_id").alias("gone"), "nameless"), "gone")
    doc_id = docs["doc_id"].cast("bigint")
    same = doc_id.eqNullSafe(gone["gone"]) & _nameless(doc_id, whole_text(docs)).eqNullSafe(gone["nameless"])
    return docs.join(small_or_shuffled(gone), same, "left_anti")
