"""Conversation structure repair: the cheapest edits that give each conversation the shape (s?(ua)+)?.

Rows are dealt by range of (conversation, turn, ..), so that one very long conversation is split like many short ones.
A task walks through its sorted rows and solves each conversation that lies wholly within it and has at most
``SEGMENT`` rows. All others are handed on as segments, each solved for every pair of role state at entry and at exit. What
joins the segments of a conversation are numbers (16 costs, and how the 16 audits rank), and only then is each
segment's own audit looked up. The digest of a repaired conversation is by its nature taken in one pass over its text, which is a
stream of segments through one task in bounded memory.

``repair`` is a depth-first branch and bound with an explicit stack: suffix lower bounds from a
relaxed problem, an incumbent (cost, audit) per goal, and a table of the best prefix per node (row, role state). An audit names its edits
fully: given the rows, state and letter fix the role, so of two prefixes at one node the lesser (cost, audit) stays the
lesser with any suffix, and the other need not be followed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, small_or_shuffled, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Faults of a row: none, blank, duplicate, truncated.
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: Rows, and bytes of text, of a segment.
SEGMENT, SEGMENT_BYTES = 64, 4 << 20
_BLANK = r"[\x20\x09-\x0D]"
#: Role states: nothing yet, after a system row, after a user row, after an assistant row. What a user or assistant row leads to from each.
_STATES = range(4)
_NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
_LAST = {0: "", 1: "II", 2: "I", 3: ""}
_GOALS = {0: (0, 1, 2, 3), 1: (1, 2, 3), 2: (2, 3), 3: (2, 3)}


@lru_cache(maxsize=20_000)
def repair(initials: tuple[str, ...], faults: tuple[int, ...], entry: int, close: bool) -> tuple[tuple[int, str] | None, ...]:
    """(cost, audit) of the best edits of these rows from state ``entry`` on, for each state at the end (None: it cannot be
    reached). With ``close``, the conversation ends here: one entry, closing inserts included.

    Inserts stand before a row; only closing ones stand after the last.
    """
    n = len(initials)
    # Relaxed problem: user and assistant alternate, system rows cost nothing wherever they are. Its states are who is awaited.
    ends = [(0, INSERT)] if close else [(0, 10**9), (10**9, 0)]
    bounds = []
    for end in ends:
        bound = [end]
        for who, fault in zip(reversed(initials), reversed(faults), strict=True):
            user, assistant = bound[-1]
            if fault in (BLANK, DUPLICATE):
                to_user, to_assistant = user + DELETE, assistant + DELETE
            else:
                more = TRUNCATED if fault == CUT else 0
                stay = 0 if who == "s" else DELETE
                change = [0 if who == x else REROLE for x in "ua"]
                to_user = min(user + (more if stay == 0 else stay), assistant + more + change[0])
                to_assistant = min(assistant + (more if stay == 0 else stay), user + more + change[1])
            bound.append((min(to_user, to_assistant + INSERT), min(to_assistant, to_user + INSERT)))
        bounds.append(bound[::-1])
    awaited = (0, 0, 1, 0)

    best: dict[int, tuple[int, str]] = {}  # incumbents by goal
    tables: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]  # best prefix by (row, state)
    tables[0][entry] = (0, "")
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if tables[i].get(state, (cost, audit)) < (cost, audit):
            continue
        if i == n:
            goal, total = (0, cost + INSERT * len(_LAST[state])) if close else (state, cost)
            whole = audit + _LAST[state] if close else audit
            if goal not in best or (total, whole) < best[goal]:
                best[goal] = (total, whole)
            continue
        if close:
            if 0 in best and cost + bounds[0][i][awaited[state]] > best[0][0]:
                continue
        elif all(r in best and cost + bounds[awaited[r]][i][awaited[state]] > best[r][0] for r in _GOALS[state]):
            continue
        who, fault = initials[i], faults[i]
        role, after = _NEXT[state]
        steps = [(i, after, cost + INSERT, audit + "I"), (i + 1, state, cost + DELETE, audit + "D")]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            if who == role:
                steps.append((i + 1, after, cost + KEEP + more, audit + "K"))
            else:
                steps.append((i + 1, after, cost + REROLE + more, audit + "R"))
                if who == "s" and state == 0:
                    steps.append((i + 1, 1, cost + KEEP + more, audit + "K"))
        for step in sorted(steps, key=lambda s: (-s[2], s[0])):  # the cheapest comes off the stack first
            row, to = step[0], step[1]
            if to not in tables[row] or step[2:] < tables[row][to]:
                tables[row][to] = step[2:]
                stack.append(step)
    return (best[0],) if close else tuple(best.get(r) for r in _STATES)


def repaired_lines(roles: list[str], texts: list[str], audit: str, entry: int) -> list[str]:
    """The rows that ``audit`` leaves, as role:text."""
    lines, state, row = [], entry, 0
    for edit in audit:
        role, after = _NEXT[state]
        name = "user" if role == "u" else "assistant"
        if edit == "I":
            lines.append(f"{name}:")
            state = after
        else:
            if edit == "R":
                lines.append(f"{name}:{texts[row]}")
                state = after
            elif edit == "K":
                lines.append(f"{roles[row]}:{texts[row]}")
                state = 1 if state == 0 and roles[row][:1] == "s" else after
            row += 1
    return lines


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live) of ``rows(conv_id, turn, role, text, ..)`` with faults put in by the digest of ``conv_id:turn``:
    0 of 20 dropped (not live), 1 emptied, 2 without ends of sentences, 3 twice, 4 by the user. Nulls count as one space there, and in
    role and text."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    )
    text = F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("fault") != 0).alias("live"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text, live)`` with fault, and id and digest that make their order total. A fault is a row's first of blank, duplicate,
    truncated. Rows that are not live only keep their conversation in the result."""
    name = F.concat(F.col("conv_id").isNull().cast("string"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    digest = F.when(F.col("live"), F.unhex(F.md5(F.concat(name, F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text"))))
    rows = stored(rows.withColumn("digest", digest).withColumn("id", F.monotonically_increasing_id()), "turns")
    same = rows.where("live").groupBy("digest").agg(F.min(F.struct("turn", "id")).alias("first"), F.count(F.lit(1)).alias("n"))
    same = stored(same.where("n > 1").select("digest", F.col("first.id").alias("first_id")), "repeated")
    end = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){_BLANK}*\z", 1)
    fault = (
        F.when(end == "", BLANK).when(F.col("first_id") != F.col("id"), DUPLICATE).when(~end.isin(".", "!", "?"), CUT).otherwise(SOUND)
    )
    return rows.join(small_or_shuffled(same), "digest", "left").select(
        "conv_id", "turn", "role", "text", "live", "digest", "id", fault.cast("int").alias("fault")
    )


_TALLY = "first_turn bigint, last_turn bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string"
_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _tally(rows: list[tuple]) -> tuple:
    """Numbers of some consecutive live rows (turn, role, text, fault); ``_joined`` puts two of them together."""
    turns = [r[0] for r in rows if r[0] is not None]
    distinct = sum(1 for _ in groupby(turns))
    faults = [r[3] for r in rows]
    who = [r[1][:1] for r in rows]
    bad = sum(1 for x, y in zip(who, who[1:]) if x + y not in ("su", "ua", "au"))
    ends = (turns[0], turns[-1]) if turns else (None, None)
    return (*ends, distinct, *(faults.count(f) for f in (BLANK, DUPLICATE, CUT)), bad, who[0] if who else None, who[-1] if who else None)


def _joined(x: tuple, y: tuple) -> tuple:
    first = y[0] if x[0] is None else x[0]
    last = x[1] if y[1] is None else y[1]
    distinct = x[2] + y[2] - (x[1] is not None and x[1] == y[0])
    seam = x[8] is not None and y[7] is not None and x[8] + y[7] not in ("su", "ua", "au")
    return (first, last, distinct, x[3] + y[3], x[4] + y[4], x[5] + y[5], x[6] + y[6] + seam, y[7] if x[7] is None else x[7], x[8] if y[8] is None else y[8])


def _gaps(tally: tuple) -> int:
    return 0 if tally[0] is None else tally[1] - tally[0] + 1 - tally[2]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _rows(batches: Iterator[pa.RecordBatch], step: int = 1024) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, step).columns), strict=True)


_SEGMENT_SCHEMA = (
    f"part int, seg bigint, done boolean, {_TALLY}, cost bigint, audit string, repaired_sha256 string, "
    "costs array<int>, ranks array<int>, audits array<string>, roles array<string>, texts array<string>"
)
_SEGMENT_TYPES = (
    [pa.int32(), pa.int64(), pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.string())] * 3
)


def _cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, turn, role, text, live, fault) -> solved conversations and open segments.

    The first and the last conversation of a partition may go on in the neighbouring ones, so they stay open, as do those of more than
    one segment.
    """
    part, kind = TaskContext.get().partitionId(), []
    names = ["conv_id", *(c.split()[0] for c in _SEGMENT_SCHEMA.split(", "))]

    def solved(rows: list[tuple]) -> tuple:
        ((cost, audit),) = repair(tuple(r[1][:1] for r in rows), tuple(r[3] for r in rows), 0, True)
        lines = repaired_lines([r[1] for r in rows], [r[2] for r in rows], audit, 0)
        return (True, *_tally(rows), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), *[None] * 5)

    def segment(rows: list[tuple]) -> tuple:
        who, faults = tuple(r[1][:1] for r in rows), tuple(r[3] for r in rows)
        costs, ranks, audits = [], [], []
        for entry in _STATES:
            found = repair(who, faults, entry, False)
            order = sorted(f[1] for f in found if f)
            costs += [f[0] if f else None for f in found]
            ranks += [order.index(f[1]) if f else None for f in found]
            audits += [f[1] if f else None for f in found]
        return (False, *_tally(rows), None, None, None, costs, ranks, audits, [r[1] for r in rows], [r[2] for r in rows])

    def pieces() -> Iterator[tuple]:
        rows, conv, size, is_open, any_row = [], None, 0, True, False
        for row in _rows(_noted(batches, kind)):
            if any_row and row[0] != conv:
                yield (conv, *(segment if is_open else solved)(rows))
                rows, size, is_open = [], 0, False
            any_row, conv = True, row[0]
            if not row[4]:
                continue
            if len(rows) >= SEGMENT or size > SEGMENT_BYTES:
                yield (conv, *segment(rows))
                rows, size, is_open = [], 0, True
            rows.append((row[1], row[2], row[3], row[5]))
            size += len(row[3])
        if any_row:
            yield (conv, *segment(rows))

    out, held = [], 0
    for seg, (conv, *piece) in enumerate(pieces()):
        out.append((conv, part, seg, *piece))
        held += sum(map(len, piece[-1] or ()))
        if len(out) >= 1024 or held > SEGMENT_BYTES:
            yield _batch(out, names, [kind[0], *_SEGMENT_TYPES])
            out, held = [], 0
    if out:
        yield _batch(out, names, [kind[0], *_SEGMENT_TYPES])


def _noted(batches: Iterator[pa.RecordBatch], kind: list) -> Iterator[pa.RecordBatch]:
    """The same; ``kind`` then holds the type of the first column."""
    for batch in batches:
        kind[:] = [batch.schema.field(0).type]
        yield batch


def _by_conversation(batches: Iterator[pa.RecordBatch], kind: list) -> Iterator[tuple[object, Iterator[tuple]]]:
    return groupby(_rows(_noted(batches, kind)), key=lambda r: r[0])


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs and ranks of the segments of each conversation, in order -> state at entry and exit of each, and the conversation's totals at
    the last."""
    far = 1 << 40
    kind: list = []
    names = ["part", "seg", "entry", "exit", "closing", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    for _, rows in _by_conversation(batches, kind):
        places, costs, ranks, tally = [], [], [], None
        for r in rows:
            places.append((r[1], r[2]))
            costs.append([far if c is None else c for c in r[3]])
            ranks.append(r[4])
            tally = r[5:] if tally is None else _joined(tally, r[5:])
        ahead = [[INSERT * len(_LAST[q]) for q in _STATES]]
        for table in reversed(costs):
            ahead.append([min(table[4 * q + r] + ahead[-1][r] for r in _STATES) for q in _STATES])
        ahead.reverse()
        out, state = [], 0
        for k, (part, seg) in enumerate(places):
            ends = [r for r in _STATES if costs[k][4 * state + r] + ahead[k + 1][r] == ahead[k][state]]
            after = min(ends, key=lambda r: ranks[k][4 * state + r])
            out.append((part, seg, state, after, None, None, None, None, None, None, None))
            state = after
        out[-1] = (*out[-1][:4], _LAST[state], _gaps(tally), *tally[3:7], ahead[0][0])
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 6]
        for at in range(0, len(out), 10_000):
            yield _batch(out[at : at + 10_000], names, types)


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their states -> audit and repaired lines of each."""
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            piece = batch.slice(at, 16)
            get = lambda name: piece.column(name).to_pylist()
            audits, lines = [], []
            for found, entry, end, closing, roles, texts in zip(*map(get, ("audits", "entry", "exit", "closing", "roles", "texts")), strict=True):
                audit = found[4 * entry + end] + (closing or "")
                audits.append(audit)
                lines.append(repaired_lines(roles, texts, audit, entry))
            keep = ["conv_id", "part", "seg", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(n) for n in keep), pa.array(audits, pa.string()), pa.array([len(x) for x in lines], pa.int64()), pa.array(["\n".join(x) for x in lines], pa.string())],
                [*keep, "audit", "lines", "repaired"],
            )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired segments of each conversation, in order -> its result."""
    kind: list = []
    for conv, rows in _by_conversation(batches, kind):
        digest, audit, any_line = hashlib.sha256(), [], False
        totals: tuple = ()
        for r in rows:
            if r[10]:
                digest.update((("\n" if any_line else "") + r[11]).encode())
                any_line = True
            audit.append(r[9])
            totals = r[3:9]
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        yield _batch([(conv, *totals, "".join(audit), digest.hexdigest())], names, [kind[0], *[pa.int64()] * 6, pa.string(), pa.string()])


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows(conv_id, turn, role, text, live)``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    Rows stand in the order of turn (null first), then of role and a digest; role and text must not be null. A conversation without live
    rows has zeros, an empty audit and the digest of the empty text. A null conv_id is a conversation like any other. Rows repeated in full
    are duplicates. Other columns are ignored. An empty table gives no rows.
    """
    conv = rows.schema["conv_id"].dataType.simpleString()
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc(), F.col("id").asc()]
    dealt = judged(rows).repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "live", "fault")
    cut = stored(mapped(dealt, _cut_up, f"conv_id {conv}, {_SEGMENT_SCHEMA}"), "segments")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).cast("bigint").alias("gaps")
    names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    done = cut.where("done").select("conv_id", gaps, *names)

    parts = cut.where("not done")
    narrow = parts.select("conv_id", "part", "seg", "costs", "ranks", *(c.split()[0] for c in _TALLY.split(", ")))
    narrow = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
    totals = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    chosen = mapped(narrow, _choose, f"part int, seg bigint, entry int, exit int, closing string, {totals}")
    chosen = parts.select("conv_id", "part", "seg", "audits", "roles", "texts").join(chosen, ["part", "seg"])
    built = mapped(chosen, _rebuild, f"conv_id {conv}, part int, seg bigint, {totals}, audit string, lines bigint, repaired string")
    built = built.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
    return done.unionByName(mapped(built, _fold, f"conv_id {conv}, {_RESULT}"))
