"""Matching tracking numbers to carrier bodies, and reducing bodies to facts.

``bodies`` tables have a VARIANT column ``body`` and any number of other columns
whose values, compared in the given order, say which body came later.

Facts are what enrichment needs from a body for one number: a few hundred bytes
instead of the whole document. They are computed where the body is read, before any
shuffle, so documents themselves never travel.

Arrays computed from a body are exploded with the outer forms and filtered after: for
the inner forms the optimizer adds a size test below the explode, which would parse
every body a second time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwatch.functions import payload as P
from parcelwatch.functions.text import key_text, strip, strip_sql
from parcelwatch.functions.times import iso_utc
from parcelwatch.schema import CARRIER_CODE, STATUS_FIELDS, TRACKING_NUMBER, col

EMPTY_BODY = "{}"
WHOLE = 2_147_483_647

# A blank key matches nothing; spreading such rows keeps them off a single reducer.
_BLANK_SPREAD = 4096


def _recency(order: Sequence[str]) -> Column:
    return F.struct(*(col(c) for c in order))


# ---- index and lookup -------------------------------------------------------------


def body_numbers(bodies: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per body and tracking number in it."""
    docs = bodies.select(
        *(col(c) for c in order), "body", F.expr(P.typed_body("body")).alias("_doc")
    )
    numbers = F.expr(P.tracking_numbers("body", "_doc"))
    return docs.select(
        *(col(c) for c in order), F.explode_outer(numbers).alias("tracking_number")
    ).filter(F.col("tracking_number").isNotNull())


def replay_index(bodies: DataFrame, order: Sequence[str]) -> DataFrame:
    """Tracking number -> order values of the last body that carries it.

    The index is a pointer table: the aggregation moves numbers and order values
    only, and is combined before the shuffle, so a number found in very many
    bodies costs one row per task.
    """
    last = body_numbers(bodies, order).groupBy("tracking_number").agg(
        F.max(_recency(order)).alias("last")
    )
    return last.select("tracking_number", *(F.col("last")[c].alias(c) for c in order))


def pointers_and_bodies(
    bodies: DataFrame, order: Sequence[str], numbers: Callable[[DataFrame, list[str]], DataFrame] = body_numbers
) -> tuple[DataFrame, DataFrame]:
    """(tracking_number, order columns, digest) of the last body of each number, and (digest, body) of those bodies.

    Bodies meet by a digest of their content, not by their place, which another scan of the
    same files may tell differently.
    """
    marked = bodies.withColumn("digest", F.sha2(F.to_json("body"), 256))
    keys = [*order, "digest"]
    last = numbers(marked, keys).groupBy("tracking_number").agg(F.max(_recency(keys)).alias("last"))
    last = last.select("tracking_number", *(F.col("last")[c].alias(c) for c in keys))
    found = marked.select("digest", "body").join(last.select("digest").distinct(), "digest", "left_semi")
    return last, found.groupBy("digest").agg(F.any_value("body").alias("body"))


def replay_lookup(
    rows: DataFrame,
    bodies: DataFrame,
    order: Sequence[str],
    key: Column | None = None,
) -> DataFrame:
    """Attach to each row the last body of its tracking number, ``{}`` when there is none.

    Adds ``body`` and the flag ``found``; both are NULL for a blank number. ``order`` must
    identify a body. Rows grow by whole documents here; enrichment uses facts instead.
    """
    probe = key_text(col(TRACKING_NUMBER) if key is None else key)
    # Two joins, the first with pointers only, so that a body is shuffled once and not
    # once for each of its numbers, and only bodies that some number points to.
    pointers, docs = pointers_and_bodies(bodies, order)
    pointers = pointers.select(F.col("tracking_number").alias("_tn"), F.col("digest").alias("_place"))
    docs = docs.withColumnRenamed("digest", "_tn")
    pointed = _left_by_key(rows.withColumn("_key", probe), pointers).drop("_tn")
    looked_up = pointed.withColumnsRenamed({"_key": "_number", "_place": "_key"})
    wanted = F.col("_number").isNotNull()
    return (
        _left_by_key(looked_up, docs)
        .withColumns(
            {
                "found": F.when(wanted, F.col("body").isNotNull()),
                "body": F.when(wanted, F.coalesce("body", F.parse_json(F.lit(EMPTY_BODY)))),
            }
        )
        .drop("_key", "_number", "_tn")
    )


def _left_by_key(keyed: DataFrame, side: DataFrame) -> DataFrame:
    """Left join ``keyed._key`` to the unique ``side._tn``.

    Blank keys are replaced by many never-matching values, spread by a hash of the
    row, because NULL keys of an outer join would all meet in one partition. Repeated
    real keys are left to the adaptive skew join, which splits them on the row side.
    """
    spread = F.concat(
        F.lit(" "), F.pmod(F.xxhash64(*_hashable(keyed)), F.lit(_BLANK_SPREAD)).cast("string")
    )
    left = keyed.withColumn("_probe", F.coalesce(F.col("_key"), spread))
    # No stripped key starts with a blank, so a spread value can only meet an
    # unstripped index key, which is removed here: it could never match anyway.
    right = side.filter(strip(F.col("_tn")) == F.col("_tn"))
    return left.join(right, F.col("_probe") == F.col("_tn"), "left").drop("_probe")


def _hashable(df: DataFrame) -> list[Column]:
    skip = ("variant", "map")
    return [col(f.name) for f in df.schema if not any(s in f.dataType.simpleString() for s in skip)]


def carrier_map(rows: DataFrame, order: str) -> DataFrame:
    """Last non-blank carrier of each non-blank tracking number, by ``order``.

    Numbers whose carriers are all blank stay, with NULL.
    """
    keyed = rows.select(
        key_text(col(TRACKING_NUMBER)).alias("tracking_number"),
        key_text(col(CARRIER_CODE)).alias("carrier_code"),
        col(order).alias("_order"),
    ).filter(F.col("tracking_number").isNotNull())
    # NULL order values are skipped, which is how blank carriers are left out.
    rank = F.when(F.col("carrier_code").isNotNull(), F.col("_order"))
    return keyed.groupBy("tracking_number").agg(
        F.max_by("carrier_code", rank).alias("carrier_code")
    )


# ---- facts -----------------------------------------------------------------------


def _with_latest(df: DataFrame, dates: str) -> DataFrame:
    latest = F.coalesce(iso_utc(F.col("_micros")), F.lit(""))
    return df.withColumn("_micros", F.expr(P.latest_micros(dates))).withColumn("latest_ts", latest)


# The numbers of one result as (tn, exact): as written when unpadded; a padded number
# counts for its stripped form, provided the body answers for that.
_KEYS = (
    f"filter(transform(dig.keys, key -> named_struct('tn', {strip_sql('key')}, 'exact', {strip_sql('key')} = key)), "
    "key -> CASE WHEN key.exact THEN key.tn <> '' ELSE array_contains(numbers, key.tn) END)"
)
_MATCHED = (
    "transform(digests, (dig, pos) -> CASE WHEN dig IS NOT NULL "
    f"THEN named_struct('keys', {_KEYS}, 'at', pos, 'd', dig) END)"
)
# Numbers no result is matched by are read from the body as a whole, ranked last.
_UNMATCHED = (
    f"array_except(numbers, flatten(transform({P.present('digests')}, dig -> dig.keys)))"
)
_REST = P.bind(
    "num",
    _UNMATCHED,
    "CASE WHEN size(num) > 0 THEN named_struct("
    "'keys', transform(num, key -> named_struct('tn', key, 'exact', true)), "
    f"'at', {WHOLE}, 'd', {P.whole_digest()}) END",
)


def number_views(
    bodies: DataFrame, order: Sequence[str], *, all_scans: bool = False
) -> DataFrame:
    """What every body shows each of its numbers: one row per body, number and matching result.

    Each result of a body gives a row for the numbers it is matched by; the body as a
    whole gives one for the numbers no result is matched by. The work is linear in the
    document. Columns: the order columns as struct ``seq``, ``tracking_number``, ``exact``
    (matched as written, not only stripped), ``at`` (position of the result; ``WHOLE``
    for the body), ``d`` (its digest), ``top`` (that of the top-level fields), ``alone``
    (the body has at most one result), ``wrapped`` and ``is_object``.
    """
    docs = P.with_digests(bodies.select(*(col(c) for c in order), "body"), all_scans=all_scans)
    per_item = docs.withColumn(
        "_items", F.expr(P.present(f"concat({_MATCHED}, array({_REST}))"))
    ).select(
        F.struct(*(col(c) for c in order)).alias("seq"),
        (F.size("digests") <= 1).alias("alone"),
        "wrapped",
        "is_object",
        "top",
        F.inline_outer("_items"),
    )
    return (
        per_item.select("seq", "alone", "wrapped", "is_object", "top", "at", "d", F.inline_outer("keys"))
        .filter(F.col("tn").isNotNull())
        .withColumnRenamed("tn", "tracking_number")
    )


# A body with one result is read whole: its top-level scan events come before, its flat fields after what
# the result says. A result of many stands by itself.
_VIEW_PARTS = {
    "detail_status": f"coalesce(d.detail_status, {P.BLANK_STATUS})",
    "scan_status": f"coalesce(CASE WHEN alone THEN top.scan_status END, d.scan_status, {P.BLANK_STATUS})",
    "flat_status": f"CASE WHEN alone OR at = {WHOLE} THEN top.flat_status ELSE {P.BLANK_STATUS} END",
    "detail": "d.detail",
    "ancillary": "d.ancillary",
}
_PAIR_PARTS = {
    "detail_status": f"coalesce(focus.detail_status, {P.BLANK_STATUS})",
    "scan_status": f"coalesce(focus.scan_status, {P.BLANK_STATUS})",
    "flat_status": f"CASE WHEN status_at IS NULL THEN top.flat_status ELSE {P.BLANK_STATUS} END",
    "detail": "focus.detail",
    "ancillary": "focus.ancillary",
}


def _with_parts(df: DataFrame, parts: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in parts.items()})


def view_status() -> Column:
    """Status struct of a number view: detail, then first scan event, then flat fields."""
    scan, flat = _VIEW_PARTS["scan_status"], _VIEW_PARTS["flat_status"]
    return F.expr(P.bind("scn", scan, P.first_status("d.detail_status", "scn", flat)))


#: Replaces the built-in reading of statuses: gets digests, one row per number and place, and returns columns by
#: name, which enrichment then writes. It may read ``tracking_number``; the structs ``detail_status``,
#: ``scan_status`` and ``flat_status`` (code, derivedCode, statusByLocale, description, blanks where there is
#: none; events of a result whose detail has a status are not read); ``detail`` (JSON text) and ``ancillary``.
Normalizer = Callable[[DataFrame], dict[str, Column]]


def replay_facts(
    bodies: DataFrame, order: Sequence[str], *, normalizer: Normalizer | None = None, reference_scan_count: bool = False
) -> DataFrame:
    """Facts of the last body of every tracking number.

    One aggregation over ``number_views``, combined before the shuffle, keeps per number
    the last body and in it the first matching result.

    ``reference_scan_count`` counts only scans outside ``output``, which leaves every
    matched number at zero; the default counts all.

    ``normalizer`` reads the statuses where the bodies are read, before the aggregation, so that no document
    travels for it. Its columns must be such as can be compared (no maps, no VARIANT); every body counts as readable.
    """
    whole = f"(at = {WHOLE})"
    count, times = "d.scan_count", "d.scan_times"
    if reference_scan_count:
        count = f"CASE WHEN NOT {whole} THEN 0L WHEN wrapped THEN top.scan_count ELSE {count} END"
        times = (
            f"CASE WHEN NOT {whole} THEN {P.none('string')} WHEN wrapped THEN top.scan_times "
            f"ELSE {times} END"
        )
    views = _with_latest(number_views(bodies, order), "d.dates")
    if normalizer is None:
        views = views.withColumn("s", view_status())
        fields = {f: F.col(f"s.{f}") for f in STATUS_FIELDS}
        readable = F.expr(f"d.readable AND (is_object OR NOT {whole})")
    else:
        views = _with_parts(views, _VIEW_PARTS)
        fields, readable = normalizer(views), F.lit(True)
    # The status is read where the number is matched as written; time, scans and detail
    # also where it is matched padded, should that result come first.
    facts = views.select(
        "tracking_number",
        "exact",
        F.expr("struct(seq, -at AS at)").alias("rank"),
        F.struct(
            *(c.alias(n) for n, c in fields.items()),
            readable.alias("readable"),
        ).alias("status"),
        F.struct(
            "latest_ts",
            F.expr(count).alias("scan_count"),
            F.expr(times).alias("scan_times"),
            F.col("d.detail").alias("detail"),
            F.col("d.ancillary").alias("ancillary"),
        ).alias("scoped"),
    )
    best = facts.groupBy("tracking_number").agg(
        F.max(F.expr("CASE WHEN exact THEN struct(rank, status, scoped) END")).alias("best"),
        F.max(F.expr("CASE WHEN NOT exact THEN struct(rank, scoped) END")).alias("padded"),
    )
    scoped = F.expr("CASE WHEN padded.rank > best.rank THEN padded.scoped ELSE best.scoped END")
    return best.select("tracking_number", "best.status.*", scoped.alias("scoped")).select(
        "tracking_number", *(col(n) for n in fields), "readable", "scoped.*"
    )


# ---- facts from explicit (number, body) pairs -----------------------------------------


def scope_to_number(pairs: DataFrame, *, all_scans: bool = False) -> DataFrame:
    """Narrow each (``tracking_number``, ``body``) pair to what is read for its number.

    ``scope_at`` is the first result matched by the stripped number, ``status_at`` the
    one the status is read from, which compares numbers as written and narrows only
    when there is more than one result; NULL stands for the whole body. ``scoped`` and
    ``focus`` are the two digests.
    """
    docs = P.with_digests(pairs.withColumn("raw", F.col("body")), all_scans=all_scans)
    anywhere = P.scope_position("digests", "tracking_number", stripped=True)
    as_written = P.scope_position("digests", "tracking_number", stripped=False)
    placed = docs.withColumns(
        {
            "scope_at": F.expr(anywhere),
            "status_at": F.expr(f"CASE WHEN size(digests) > 1 THEN {as_written} END"),
        }
    )
    whole = P.whole_digest()
    return placed.withColumns(
        {
            n: F.expr(f"CASE WHEN {at} IS NULL THEN {whole} ELSE get(digests, {at}) END")
            for n, at in (("scoped", "scope_at"), ("focus", "status_at"))
        }
    )


def normalize_status() -> Column:
    """Status struct of a scoped pair: detail, then first scan event, then flat fields."""
    scan, flat = _PAIR_PARTS["scan_status"], _PAIR_PARTS["flat_status"]
    return F.expr(P.first_status("focus.detail_status", scan, flat))


def payload_facts(
    pairs: DataFrame,
    *,
    normalizer: Normalizer | None = None,
    reference_scan_count: bool = False,
) -> DataFrame:
    """Facts of (``tracking_number``, ``body``) pairs, one row per pair.

    ``normalizer`` replaces the built-in status reading. Here, where each number comes with its body, it gets
    the scoped pairs, and may also look at the body itself (``raw``).
    """
    placed = scope_to_number(pairs)
    if normalizer is None:
        placed = placed.withColumn("_status", normalize_status())
        fields = {f: F.col(f"_status.{f}") for f in STATUS_FIELDS}
        readable = F.col("is_object") & F.col("focus.readable")
    else:
        placed = _with_parts(placed, _PAIR_PARTS)
        fields, readable = normalizer(placed), F.lit(True)
    count, times = "scoped.scan_count", "scoped.scan_times"
    if reference_scan_count:
        hit = "scope_at IS NOT NULL"
        count = f"CASE WHEN {hit} THEN 0L WHEN wrapped THEN top.scan_count ELSE {count} END"
        times = (
            f"CASE WHEN {hit} THEN {P.none('string')} WHEN wrapped THEN top.scan_times "
            f"ELSE {times} END"
        )
    return _with_latest(placed, "scoped.dates").select(
        "tracking_number",
        *(c.alias(n) for n, c in fields.items()),
        readable.alias("readable"),
        "latest_ts",
        F.expr(count).alias("scan_count"),
        F.expr(times).alias("scan_times"),
        F.col("scoped.detail").alias("detail"),
        F.col("scoped.ancillary").alias("ancillary"),
    )


__all__ = [
    "body_numbers",
    "carrier_map",
    "Normalizer",
    "WHOLE",
    "normalize_status",
    "number_views",
    "payload_facts",
    "replay_facts",
    "replay_index",
    "replay_lookup",
    "scope_to_number",
    "view_status",
]
