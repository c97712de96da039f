"""Reading carrier payloads: one typed view of a JSON body, then plain struct and array work.

A body is parsed once to VARIANT and cast once to ``BODY_SHAPE``. The cast is
tolerant node by node: a value of the wrong type becomes NULL where it stands and
the rest of the body stays readable. Status fields are kept as VARIANT leaves
because blank rules depend on the JSON type (``0`` is blank, ``"0"`` is not).

A *result* is one entry of ``completeTrackResults``. Every result is reduced, where
it is read, to a *digest*: a struct of plain strings and numbers that holds all later
steps need. The top-level fields of a body get a digest of their own, and a whole
body's digest is put together from those two kinds.

The functions compose Spark SQL text. Nested array work reads well in SQL, and one
``F.expr`` per column keeps plan building fast where thousands of Column calls would not.
Names of lambda variables differ between functions so that texts can be nested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwatch.functions.text import strip_sql
from parcelwatch.functions.times import epoch_micros_sql
from parcelwatch.schema import STATUS_FIELDS, col

Sql = str

_LEAVES = "code:variant,derivedCode:variant,statusByLocale:variant,description:variant"
_EVENT = (
    "struct<date:string,dateTime:string,eventDate:string,derivedStatusCode:variant,"
    "eventType:variant,derivedStatus:variant,eventDescription:variant>"
)
_ANNOUNCED = "struct<dateTime:string>"
_HISTORY = f"scanEvents:array<{_EVENT}>,dateAndTimes:array<{_ANNOUNCED}>"
RESULT_SHAPE = (
    "struct<trackingNumber:string,trackResults:array<struct<trackingNumber:string,"
    "trackingNumberInfo:struct<trackingNumber:string>,latestStatusDetail:variant,"
    f"{_HISTORY}>>>"
)
BODY_SHAPE = (
    f"struct<output:struct<completeTrackResults:array<{RESULT_SHAPE}>>,"
    f"completeTrackResults:array<{RESULT_SHAPE}>,{_LEAVES},{_HISTORY}>"
)
STATUS_SHAPE = "struct<code:string,derivedCode:string,statusByLocale:string,description:string>"
DIGEST_SHAPE = (
    f"struct<keys:array<string>,readable:boolean,detail_status:{STATUS_SHAPE},detail:string,"
    f"ancillary:string,scan_status:{STATUS_SHAPE},scan_count:bigint,scan_times:array<string>,"
    "dates:array<string>>"
)


# ---- small helpers -----------------------------------------------------------


def variant_at(v: Sql, path: str, kind: str = "variant") -> Sql:
    return f"try_variant_get({v}, '{path}', '{kind}')"


def is_object(v: Sql) -> Sql:
    """True for a JSON object. Casting to an empty struct reads no field."""
    return f"({variant_at(v, '$', 'struct<>')} IS NOT NULL)"


def bind(name: str, value: Sql, use: Sql) -> Sql:
    """``use`` with the variable ``name`` standing for ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def none(kind: str) -> Sql:
    return f"cast(array() AS array<{kind}>)"


def present(array: Sql) -> Sql:
    return f"filter({array}, it -> it IS NOT NULL)"


def flat(arrays: Sql) -> Sql:
    """Concatenate an array of arrays; NULL members count as empty."""
    return f"flatten({present(arrays)})"


def or_empty(array: Sql, kind: str) -> Sql:
    return f"coalesce({array}, {none(kind)})"


def _unless_blank(text: Sql, leaf: Sql) -> Sql:
    """``text``, that of the VARIANT ``leaf``; NULL when the JSON value is empty, zero or false.

    The text is named several times, so it should be a variable or a field. The leaf is read
    only where the text may be that of a blank value.
    """
    # Texts of the non-string JSON values that count as blank.
    falsy = "('false', '0', '0.0', '-0.0', '[]', '{}')"
    # Missing texts are told first: AND and OR go on to their other side after a NULL.
    return (
        f"CASE WHEN {text} IS NULL OR {text} = '' THEN NULL WHEN NOT {text} IN {falsy} THEN {text} "
        f"WHEN schema_of_variant({leaf}) = 'STRING' THEN {text} END"
    )


def truthy_text(leaf: Sql) -> Sql:
    """Text of a VARIANT leaf; NULL when the JSON value is empty, zero or false."""
    return bind("txt", variant_at(leaf, "$", "string"), _unless_blank("txt", leaf))


def texts_of(v: Sql, fields: Sequence[str]) -> Sql:
    """Struct of the texts of an object's fields, from one reading of the VARIANT."""
    return variant_at(v, "$", f"struct<{','.join(f'{f}:string' for f in fields)}>")


def truthy_fields(v: Sql, texts: Sql, fields: Sequence[str]) -> list[Sql]:
    """``truthy_text`` of an object's fields, given their ``texts_of``."""
    return [_unless_blank(f"{texts}.{f}", variant_at(v, f"$.{f}")) for f in fields]


def _status(code: Sql, derived: Sql, status: Sql, description: Sql) -> Sql:
    """The code is named twice, for bodies without derived code; all four should be cheap."""
    return (
        f"named_struct('code', coalesce({code}, ''), 'derivedCode', coalesce({derived}, {code}, ''), "
        f"'statusByLocale', coalesce({status}, ''), 'description', coalesce({description}, ''))"
    )


BLANK_STATUS = (
    "named_struct('code', '', 'derivedCode', '', 'statusByLocale', '', 'description', '')"
)


# ---- typed view ----------------------------------------------------------------


def typed_body(v: Sql) -> Sql:
    return variant_at(v, "$", BODY_SHAPE)


def has_wrapper(v: Sql) -> Sql:
    """True when the body has an ``output`` key, whatever its value.

    The object test comes first because reading a value as VARIANT copies it.
    """
    path = "$.output"
    return (
        f"({variant_at(v, path, 'struct<>')} IS NOT NULL OR {variant_at(v, path)} IS NOT NULL)"
    )


def results_of(doc: Sql, wrapped: Sql) -> Sql:
    """Results of a typed body; an ``output`` key hides a top-level list."""
    return (
        f"CASE WHEN {wrapped} THEN {doc}.output.completeTrackResults "
        f"ELSE {doc}.completeTrackResults END"
    )


# ---- tracking numbers -------------------------------------------------------------


def result_keys(result: Sql) -> Sql:
    """Numbers one result is matched by: its own, then its nested ones, as written."""
    nested = or_empty(f"{result}.trackResults.trackingNumberInfo.trackingNumber", "string")
    return f"array_distinct({present(f'concat(array({result}.trackingNumber), {nested})')})"


def _index_keys(result: Sql) -> Sql:
    nested = (
        f"transform({present(f'{result}.trackResults')}, trk -> "
        "coalesce(nullif(trk.trackingNumberInfo.trackingNumber, ''), trk.trackingNumber))"
    )
    keys = flat(f"array(array({result}.trackingNumber), {nested})")
    return f"filter({keys}, key -> key <> '')"


def _keys_anywhere(v: Sql) -> Sql:
    """String values of number keys at any depth, found in the canonical JSON text."""
    # It starts with plain text, which the matcher can skip to; the key must not be part
    # of a longer one that ends in an escaped quote.
    pattern = (
        r'"tracking(?<!\\"tracking)(?:Number|_number)":"([^"\\]*(?:\\.[^"\\]*)*)"'
    )
    unescaped = variant_at("""try_parse_json('"' || raw || '"')""", "$", "string")
    found = (
        f"transform(regexp_extract_all(to_json({v}), r'{pattern}', 1), raw -> "
        f"CASE WHEN contains(raw, r'\\') THEN {unescaped} ELSE raw END)"
    )
    return f"filter({found}, key -> {strip_sql('key')} <> '')"


def tracking_numbers(v: Sql, doc: Sql) -> Sql:
    """Distinct numbers a body answers for: the wrapped results', else any in the document."""
    results = present(f"{doc}.output.completeTrackResults")
    wrapped = flat(f"transform({results}, res -> {_index_keys('res')})")
    return "array_distinct(" + bind(
        "num",
        or_empty(wrapped, "string"),
        f"CASE WHEN size(num) > 0 THEN num ELSE {or_empty(_keys_anywhere(v), 'string')} END",
    ) + ")"


# ---- status of one place -----------------------------------------------------------


def detail_of(result: Sql) -> Sql:
    """``latestStatusDetail`` of the first track result, as VARIANT."""
    return f"get({result}.trackResults, 0).latestStatusDetail"


def status_from_detail(detail: Sql, texts: Sql) -> Sql:
    """Status of a detail, given ``texts_of`` its status fields."""
    return _status(*truthy_fields(detail, texts, STATUS_FIELDS))


def status_from_event(event_lists: Sql) -> Sql:
    """Status of the first event of the first non-empty list headed by an object; else NULL."""
    # The event's fields that are read.
    names = ("eventType", "derivedStatusCode", "derivedStatus", "eventDescription")
    kind, code, status, description = (f"evs.{n}" for n in names)
    read = bind(
        "evs",
        "named_struct(" + ", ".join(f"'{n}', {truthy_text(f'evt.{n}')}" for n in names) + ")",
        _status(f"coalesce({code}, {kind})", code, f"coalesce({status}, {description})", description),
    )
    heads = present(f"transform(filter({event_lists}, lst -> size(lst) > 0), lst -> lst[0])")
    return f"get(transform(slice({heads}, 1, 1), evt -> {read}), 0)"


def status_from_flat(doc: Sql) -> Sql:
    texts = ", ".join(f"'{n}', {variant_at(f'{doc}.{n}', '$', 'string')}" for n in STATUS_FIELDS)
    return bind(
        "flt",
        f"named_struct({texts})",
        _status(*(_unless_blank(f"flt.{n}", f"{doc}.{n}") for n in STATUS_FIELDS)),
    )


def first_status(*candidates: Sql) -> Sql:
    """First candidate with a code or a status text; the last one is the fallback.

    A description alone does not make a candidate count.
    """
    first, *rest = candidates
    if not rest:
        return first
    name = f"cand{len(rest)}"
    taken = f"CASE WHEN {name}.code <> '' OR {name}.statusByLocale <> '' THEN {name}"
    return bind(name, first, f"{taken} ELSE {first_status(*rest)} END")


def ancillary_text(detail: Sql) -> Sql:
    """Reason and action texts of every ancillary entry, blank-separated."""
    # Fields read, in this order.
    fields = ("reasonDescription", "actionDescription", "reason", "action")
    entry = bind("ant", texts_of("anc", fields), f"array({', '.join(truthy_fields('anc', 'ant', fields))})")
    entries = variant_at(detail, "$.ancillaryDetails", "array<variant>")
    texts = present(flat(f"transform({entries}, anc -> {entry})"))
    return f"coalesce(array_join({texts}, ' '), '')"


# ---- digests -------------------------------------------------------------------------


def _digest(fields: Sql, event_lists: Sql, time_lists: Sql, need_scans: Sql = "true") -> Sql:
    """A digest of ``fields`` and what the scans say; lists hold one array per place of events.

    The scan status is left NULL where it is not needed. Events are named again instead
    of bound: the results of ``transform`` are copied, field access is not.
    """
    listed = or_empty(flat(event_lists), _EVENT)
    seen = present(listed)
    times = f"flatten(transform({seen}, evt -> array(evt.date, evt.dateTime, evt.eventDate)))"
    announced = or_empty(f"{flat(time_lists)}.dateTime", "string")
    return (
        f"named_struct({fields}, "
        f"'scan_status', CASE WHEN {need_scans} THEN {status_from_event(event_lists)} END, "
        f"'scan_count', cast(size({listed}) AS bigint), "
        f"'scan_times', filter({times}, tim -> contains(tim, 'T')), "
        f"'dates', array_distinct({present(f'concat({seen}.date, {announced})')}))"
    )


def has_no_status(detail: Sql, texts: Sql) -> Sql:
    """True when a detail gives neither a code nor a status text; ``texts`` are those of its status fields."""
    code, status = truthy_fields(detail, texts, ("code", "statusByLocale"))
    return f"({code} IS NULL AND {status} IS NULL)"


def result_digest(result: Sql, texts: Sql, need_scans: Sql | None = None) -> Sql:
    """Digest of one result; NULL when the result is not an object.

    ``texts`` are those of the status fields of its detail. The scan status is read when the
    detail has no status, unless ``need_scans`` says else.
    """
    detail = detail_of(result)
    # The status is read from the first track result, which must then be an object.
    broken = f"size({result}.trackResults) > 0 AND {result}.trackResults[0] IS NULL"
    fields = (
        f"'keys', {result_keys(result)}, 'readable', NOT coalesce({broken}, false), "
        f"'detail_status', {status_from_detail(detail, texts)}, "
        f"'detail', CASE WHEN {is_object(detail)} THEN to_json({detail}) ELSE '{{}}' END, "
        f"'ancillary', {ancillary_text(detail)}"
    )
    digest = _digest(
        fields,
        f"{result}.trackResults.scanEvents",
        f"{result}.trackResults.dateAndTimes",
        need_scans or has_no_status(detail, texts),
    )
    return f"CASE WHEN {result} IS NOT NULL THEN {digest} END"


def result_digests(results: Sql, need_scans: Sql | None = None) -> Sql:
    """Digests of all results. The status fields of a detail are read once, beside the results."""
    texts = f"transform({results}, res -> {texts_of(detail_of('res'), STATUS_FIELDS)})"
    return f"zip_with({results}, {texts}, (res, txs) -> {result_digest('res', 'txs', need_scans)})"


def top_digest(doc: Sql, results: Sql) -> Sql:
    """Digest of the top-level fields of a body.

    ``any_scan`` is the scan status of the results together, read only when the first
    of them has no status of its own: a body read as a whole may fall back to it.
    """
    first = detail_of(f"get({results}, 0)")
    lists = f"{flat(f'{results}.trackResults')}.scanEvents"
    blank = bind("fst", texts_of(first, STATUS_FIELDS), has_no_status(first, "fst"))
    fallback = f"CASE WHEN {blank} THEN {status_from_event(lists)} END"
    return _digest(
        f"'flat_status', {status_from_flat(doc)}, 'any_scan', {fallback}",
        f"array({doc}.scanEvents)",
        f"array({doc}.dateAndTimes)",
    )


def with_digests(bodies: DataFrame, *, all_scans: bool = False) -> DataFrame:
    """Replace ``body`` by ``top``, ``digests``, ``wrapped``, ``numbers`` and ``is_object``.

    One parse and one typed cast per body; the output holds no VARIANT. A result's scan
    status is read only where its detail has no status, unless ``all_scans`` asks for all.
    """
    wrapped = f"coalesce({has_wrapper('body')}, false)"
    # The wrapper is looked for once: results are named often.
    doc = "doc.typed"
    results = f"({results_of(doc, 'doc.wrapped')})"
    digests = result_digests(results, "true" if all_scans else None)
    # The typed body lives only inside this one expression: written to a row, each of its
    # VARIANT leaves would carry a copy of the document's key dictionary.
    reduced = bind(
        "doc",
        f"named_struct('typed', {typed_body('body')}, 'wrapped', {wrapped})",
        f"named_struct('top', {top_digest(doc, results)}, 'digests', {or_empty(digests, DIGEST_SHAPE)}, "
        f"'numbers', {tracking_numbers('body', doc)}, 'wrapped', doc.wrapped)",
    )
    kept = [c for c in bodies.columns if c != "body"]
    return bodies.select(
        *(col(c) for c in kept),
        F.expr(reduced).alias("_doc"),
        F.expr(f"coalesce({is_object('body')}, false)").alias("is_object"),
    ).select(*(col(c) for c in kept), "is_object", "_doc.*")


def whole_digest(top: Sql = "top", digests: Sql = "digests") -> Sql:
    """Digest of a body that is not narrowed: top-level fields first, then every result."""

    def gathered(name: str) -> Sql:
        return f"concat({top}.{name}, flatten(transform(digs, dig -> dig.{name})))"

    # An empty list of results is fine; a first entry that is not an object is not.
    whole = (
        f"named_struct('keys', {none('string')}, "
        f"'readable', CASE WHEN size({digests}) > 0 THEN coalesce(one.readable, false) ELSE true END, "
        f"'detail_status', coalesce(one.detail_status, {BLANK_STATUS}), "
        f"'detail', coalesce(one.detail, '{{}}'), "
        f"'ancillary', coalesce(one.ancillary, ''), "
        f"'scan_status', coalesce({top}.scan_status, {top}.any_scan), "
        f"'scan_count', aggregate(digs, {top}.scan_count, (sum, dig) -> sum + dig.scan_count), "
        f"'scan_times', {gathered('scan_times')}, 'dates', {gathered('dates')})"
    )
    return bind("digs", present(digests), bind("one", f"get({digests}, 0)", whole))


def scope_position(digests: Sql, number: Sql, *, stripped: bool) -> Sql:
    """Zero-based position of the first result that carries ``number``; NULL if none does."""
    key = strip_sql("key") if stripped else "key"
    hits = (
        f"transform({digests}, dig -> coalesce(exists(dig.keys, key -> {key} = {number}), false))"
    )
    return f"cast(nullif(array_position({hits}, true), 0) - 1 AS int)"


def latest_micros(dates: Sql) -> Sql:
    """Latest of the dates that parse, in microseconds; NULL when none does."""
    return f"array_max(transform({dates}, dat -> {epoch_micros_sql('dat')}))"
