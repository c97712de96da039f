"""SQL over the given tables for each query, written without any JSON.

Bodies are made from events, so what is read back from them must equal what these
statements compute from the events directly.
"""

from __future__ import annotations

from parcelwatch.plans.fixtures import EVENTS_SQL, RULES_SQL, SHIPMENTS_SQL

_TABLES = {"orders": "orders", "events": "events"}
_SHIP = f"ship AS ({SHIPMENTS_SQL.format(**_TABLES)})"
_EV = f"ev AS ({EVENTS_SQL.format(**_TABLES)})"
_RULE = f"rule AS ({RULES_SQL.format(**_TABLES)})"

_NOW = "TIMESTAMP '2024-02-03 00:00:00'"
_WEEK = "DATE '1997-01-12' AND DATE '1997-01-18'"


def _strip(c: str) -> str:
    return f"TRIM({c})"


def _key(c: str) -> str:
    return f"CASE WHEN LOWER(TRIM({c})) NOT IN ('', 'nan', 'none') THEN TRIM({c}) END"


def _iso(ts: str) -> str:
    whole = f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"
    return (
        f"CASE WHEN microsecond({ts}) % 1000000 = 0 THEN {whole} || 'Z' "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END"
    )


# One row per (user, capture) with what a reader of that capture's body must find.
_CAP = f"""cap AS (
 SELECT user_id, capture, tracking_number, user_id % 5 AS kind,
  CAST(FLOOR(user_id / 30) AS BIGINT) AS part, COUNT(*) AS n, MAX(ts) AS max_ts,
  arg_max(code, ts) AS code, arg_max(status, ts) AS status, arg_max(description, ts) AS description,
  arg_max(ancillary, ts) AS ancillary, arg_max(event_id, ts) AS eid,
  string_agg(date_text, '|' ORDER BY ts DESC) AS times
 FROM ev GROUP BY user_id, capture, tracking_number),
fact AS (
 SELECT user_id, capture, tracking_number, kind, part,
  CASE WHEN kind = 2 THEN 'X' || code ELSE code END AS code,
  code AS derived_code,
  CASE WHEN kind = 3 AND eid % 2 = 1 THEN description ELSE status END AS status_by_locale,
  description,
  CASE WHEN kind = 4 THEN '' WHEN kind = 1 THEN {_iso("max_ts + INTERVAL '12' HOUR")}
       ELSE {_iso("max_ts")} END AS latest_ts,
  CASE WHEN kind = 4 THEN NULL WHEN kind = 1 THEN max_ts + INTERVAL '12' HOUR ELSE max_ts END AS latest,
  CASE WHEN kind = 4 THEN 0 ELSE n END AS scan_count,
  CASE WHEN kind = 4 THEN '' ELSE times END AS scan_times,
  CASE WHEN kind <= 2 THEN ancillary ELSE '' END AS ancillary,
  code AS ev_code, status AS ev_status, eid
 FROM cap)"""
_FACT = f"{_EV}, {_CAP}"
_LAST = "last AS (SELECT * FROM fact QUALIFY capture = MAX(capture) OVER (PARTITION BY user_id))"
# In a dump appended as even captures, then odd ones, the odd ones are the later bodies.
_LAST_APPENDED = (
    "last AS (SELECT * FROM fact QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id "
    "ORDER BY capture % 2 DESC, capture DESC) = 1)"
)

# The codes, texts and patterns of the rules, as SQL.
_RTS = r"\bRETURN(ING)?\s(PACKAGE\sTO\sSHIPPER|TO\s(SHIPPER|SENDER))\b"


def _exc(code: str, status: str, desc: str) -> str:
    texts = " OR ".join(
        f"contains(UPPER({c}), '{p}')"
        for c in (status, desc)
        for p in ("EXCEPTION", "DAMAGED", "UNABLE TO DELIVER")
    )
    return f"({code} IN ('DE', 'SE', 'EX', 'EXC') OR {texts})"


def _rts(code: str, status: str, desc: str) -> str:
    return (
        f"({code} IN ('RS', 'RTS') OR regexp_matches(UPPER({status}), '{_RTS}') "
        f"OR regexp_matches(UPPER({desc}), '{_RTS}'))"
    )


def _flags(code: str, status: str, desc: str, anc: str, days: str, scans: str, seed_d: str, seed_r: str, n: int) -> str:
    """Select list of the seven flags as BIGINT (two levels are needed for the dependent ones)."""
    pre = f"({code} = 'OC')"
    dlv = f"({code} = 'DL' OR {seed_d})"
    exc = _exc(code, status, desc)
    rts = f"({_rts(code, status, desc)} OR {seed_r})"
    stalled = f"(({days} >= {n} OR {scans}) AND NOT {dlv} AND NOT {rts} AND NOT {pre})"
    text = f"LOWER({anc} || ' ' || {status} || ' ' || {desc})"
    unable = rf"({exc} AND regexp_matches({text}, '\bunable\s+to\s+deliver\b'))"
    dam = rf"({exc} AND regexp_matches(LOWER({anc}), '\bdamaged\b'))"
    named = {
        "is_pretransit": pre,
        "is_delivered": dlv,
        "has_exception": exc,
        "is_rts": rts,
        "is_stalled": stalled,
        "damaged": dam,
        "unable_to_deliver": unable,
    }
    return ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in named.items())


_DAYS = (
    "CASE WHEN days = 'bad' THEN 0 ELSE CAST(TRUNC(CAST(days AS DOUBLE)) AS BIGINT) END"
)
_RULE_FLAGS = _flags(
    "derived", "status", "description", "ancillary", _DAYS, "scans = 0", "seed_delivered = '1'", "seed_rts = 1", 4
)
_FLAGGED = f"WITH {_RULE}, flagged AS (SELECT *, {_RULE_FLAGS} FROM rule)"

_REASONS = (
    "concat_ws(';', CASE WHEN is_pretransit = 1 THEN 'PreTransit' END, "
    "CASE WHEN is_delivered = 1 THEN 'Delivered' END, CASE WHEN has_exception = 1 THEN 'Exception' END, "
    "CASE WHEN is_rts = 1 THEN 'ReturnedToSender' END, CASE WHEN is_stalled = 1 THEN 'Stalled' END)"
)


def _label(otherwise: str) -> str:
    return (
        "CASE WHEN is_rts = 1 THEN 'ReturnedToSender' "
        "WHEN is_delivered = 1 AND has_exception = 1 THEN 'DeliveredWithIssue' "
        "WHEN is_delivered = 1 THEN 'Delivered' WHEN has_exception = 1 THEN 'Exception' "
        "WHEN is_stalled = 1 THEN 'Stalled' WHEN is_pretransit = 1 THEN 'PreTransit' "
        f"ELSE '{otherwise}' END"
    )


def _date(c: str) -> str:
    return f"COALESCE(TRY_CAST({c} AS DATE), CAST(TRY_STRPTIME({c}, '%m/%d/%Y') AS DATE))"


_NOT_DELIVERED = "LOWER(COALESCE(delivery_tracking_status, '')) <> 'delivered'"
_IN_WEEK = f"COALESCE({_date('promised_delivery_date')} BETWEEN {_WEEK}, FALSE)"


def _enriched(last: str = _LAST, where: str = "TRUE") -> str:
    """CTEs up to ``enriched``: shipments with the facts of their number."""
    return f"""WITH {_SHIP}, {_FACT}, {last},
keyed AS (SELECT *, {_key("tracking_number")} AS k FROM ship WHERE {where}),
enriched AS (
 SELECT s.row_id, s.tracking_number, s.carrier_code, s.k, COALESCE(f.code, '') AS code,
  COALESCE(f.derived_code, '') AS derived_code, COALESCE(f.status_by_locale, '') AS status_by_locale,
  COALESCE(f.description, '') AS description, COALESCE(f.ancillary, '') AS ancillary,
  COALESCE(f.latest_ts, '') AS latest_ts, f.latest, COALESCE(f.scan_count, 0) AS scan_count,
  COALESCE(f.scan_times, '') AS scan_times
 FROM keyed s LEFT JOIN last f ON s.k = f.tracking_number)"""


def _judged(last: str = _LAST, where: str = _NOT_DELIVERED) -> str:
    days = f"COALESCE(CAST(FLOOR((epoch_us({_NOW}) - epoch_us(latest)) / 86400000000) AS BIGINT), 0)"
    flags = _flags(
        "derived_code", "status_by_locale", "description", "ancillary", "idle_days", "scan_count = 0", "FALSE", "FALSE", 4
    )
    return f"""{_enriched(last, where)},
idle AS (SELECT *, {days} AS idle_days FROM enriched),
flagged AS (SELECT *, {flags} FROM idle),
judged AS (SELECT *, {_label("")} AS calculated_status, {_REASONS} AS calculated_reasons FROM flagged)"""


_RESULT = (
    "row_id, tracking_number, carrier_code, code, derived_code, status_by_locale, description, "
    "is_pretransit, is_delivered, has_exception, is_rts, is_stalled, damaged, unable_to_deliver, "
    "calculated_status, calculated_reasons, latest_ts, scan_count, idle_days"
)

_CLEAN = (
    "CASE WHEN k IS NULL THEN '' ELSE k END"
)


def _hint(columns: str, codes: str, hints: tuple[str, ...]) -> str:
    texts = " OR ".join(f"contains(LOWER({c}), '{h}')" for c in ("status", "description") for h in hints)
    return f"(UPPER(code) IN ({codes}) OR UPPER(derived) IN ({codes}) OR {texts})"


# Codes and hints of the classifier.
_C_PRE = _hint(
    "",
    "'OC', 'LP'",
    (
        "label created",
        "shipment information sent",
        "shipment info sent",
        "order created",
        "pending pickup",
        "awaiting pickup",
        "waiting for carrier pickup",
    ),
)
_C_DLV = _hint("", "'DLV', 'DL', 'DEL'", ("delivered",))
_C_EXC = _hint("", "'EXC'", ("exception", "address correction", "damage"))


def _rule_flag(expr: str, name: str) -> str:
    return f"WITH {_RULE} SELECT event_id, CAST({expr} AS BIGINT) AS {name} FROM rule"


def _flagged(cols: str, where: str = "TRUE") -> str:
    return f"{_FLAGGED} SELECT {cols} FROM flagged WHERE {where}"


def _facts(cols: str, where: str = "TRUE") -> str:
    return f"WITH {_FACT} SELECT {cols} FROM fact WHERE {where}"


# The batch a user is requested in, see the query side.
_BATCH = "capture * 1000000 + part AS batch"

_NUMBERED = f"""WITH {_SHIP},
 keyed AS (SELECT row_id, {_key("tracking_number")} AS k, {_key("carrier_code")} AS c FROM ship),
 carrier AS (SELECT k, arg_max(c, row_id) FILTER (WHERE c IS NOT NULL) AS c FROM keyed WHERE k IS NOT NULL GROUP BY k),
 ranked AS (SELECT k, row_id, ROW_NUMBER() OVER (ORDER BY row_id) - 1 AS r FROM keyed WHERE k IS NOT NULL)"""

_TN_DEEP = "kind < 4"

ORACLES: dict[str, str] = {
    # sources and sinks
    "src_shipments": f"WITH {_SHIP} SELECT * FROM ship",
    "src_bodies": f"""WITH {_FACT}, {_LAST} SELECT layout, tracking_number, code, status_by_locale, scan_count
        FROM last, (VALUES ('document'), ('lines'), ('indented')) AS l(layout)""",
    "quarantined_bodies": f"""WITH {_FACT} SELECT tracking_number,
         CASE WHEN kind = 4 AND user_id % 3 = 0 THEN 'not json' ELSE 'kept' END AS state, COUNT(*) AS bodies FROM fact GROUP BY 1, 2""",
    "sink_bodies": f"""WITH {_FACT}, body AS (SELECT DISTINCT capture, part, 0 AS is_flat FROM fact WHERE kind < 4
        UNION ALL SELECT capture, user_id, 1 FROM fact WHERE kind = 4)
        SELECT capture % 2 AS batch, CAST(is_flat AS BIGINT) AS is_flat, COUNT(*) AS bodies FROM body GROUP BY 1, 2""",
    "read_bodies": f"WITH {_FACT}, {_LAST_APPENDED} SELECT tracking_number, code, status_by_locale FROM last",
    "sink_views": f"""{_judged()}
        SELECT v.view, row_id, {_CLEAN} AS tracking_number FROM judged, (VALUES ('all_issues'), ('pretransit'),
         ('stalled'), ('damaged_or_returned')) AS v(view)
        WHERE CASE v.view WHEN 'all_issues' THEN is_delivered <> 1 WHEN 'pretransit' THEN is_pretransit = 1
         WHEN 'stalled' THEN is_stalled = 1 ELSE damaged = 1 OR is_rts = 1 END""",
    "sink_sidecar": f"""{_enriched()}
        SELECT COALESCE({_key("carrier_code")}, 'None') AS carrier, k AS tracking_number,
         arg_max(code, row_id) AS code, arg_max(derived_code, row_id) AS derived_code,
         arg_max(status_by_locale, row_id) AS status_by_locale, arg_max(description, row_id) AS description
        FROM enriched WHERE k IS NOT NULL GROUP BY 1, 2""",
    "run_marker": f"""{_judged()} SELECT 'ok' AS run_marker, 'shipments.parquet' AS input_name, '/in/week' AS input_dir,
        'week' AS output_name, false AS env_has_creds, CAST(NULL AS VARCHAR) AS api_bodies_path,
        (SELECT COUNT(*) FROM ship) AS input_rows, CAST(6 AS BIGINT) AS input_cols,
        (SELECT COUNT(*) FROM judged) AS output_rows, CAST(24 AS BIGINT) AS output_cols""",
    # projections
    "drop_first_column": f"WITH {_SHIP} SELECT * EXCLUDE (lead) FROM ship",
    "column_contract": f"""WITH {_RULE} SELECT event_id, code, derived AS derived_code, status AS status_by_locale,
        ancillary, scans AS scan_count, CAST(CASE WHEN seed_delivered = '1' THEN 1 ELSE 0 END AS BIGINT) AS is_delivered,
        CAST(seed_rts AS BIGINT) AS is_rts, '' AS description, CAST(0 AS BIGINT) AS is_pretransit,
        CAST(0 AS BIGINT) AS has_exception, CAST(0 AS BIGINT) AS is_stalled, CAST(0 AS BIGINT) AS damaged,
        CAST(0 AS BIGINT) AS unable_to_deliver, '' AS calculated_status, '' AS calculated_reasons FROM rule""",
    "as_int01": f"""WITH {_RULE} SELECT event_id, {_DAYS} AS days,
        CAST(CASE WHEN seed_delivered = '1' THEN 1 ELSE 0 END AS BIGINT) AS seed, CAST(0 AS BIGINT) AS missing FROM rule""",
    "upper_text": f"""WITH {_SHIP} SELECT row_id, UPPER(COALESCE(delivery_tracking_status, '')) AS upper_status,
        '' AS missing FROM ship""",
    "lower_trim_text": f"""WITH {_SHIP} SELECT row_id, LOWER(TRIM(COALESCE(carrier_code, ''))) AS carrier,
        LOWER(TRIM(COALESCE(tracking_number, ''))) AS number FROM ship""",
    "latest_code_select": f"WITH {_RULE} SELECT event_id, derived AS with_derived, code AS without_derived FROM rule",
    "clean_tracking_number": """SELECT o_orderkey AS row_id, CASE o_orderkey % 8
        WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN '1' || CAST(o_custkey AS STRING)
        WHEN 2 THEN CAST(o_custkey * 1000 AS STRING) WHEN 3 THEN 'AB' || CAST(o_custkey AS STRING)
        WHEN 4 THEN '' WHEN 5 THEN '' WHEN 6 THEN '123456789012345678901234' || CAST(o_custkey AS STRING)
        ELSE CAST(o_custkey AS STRING) || 'd' END AS tracking_number FROM orders""",
    "column_after": """SELECT event_id, 'event_id,Damaged,UnableToDeliver,code' AS layout,
        CAST(0 AS BIGINT) AS unable_to_deliver FROM events""",
    "reasons_not_null": f"""WITH {_EV} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN code ELSE '' END AS calculated_reasons
        FROM ev""",
    "enriched_text_blanks": f"""WITH {_SHIP} SELECT row_id, COALESCE(tracking_number, '') AS tracking_number,
        COALESCE(carrier_code, '') AS carrier_code, delivery_tracking_status FROM ship""",
    "carrier_name": f"""WITH {_SHIP} SELECT row_id, CASE WHEN carrier_code IS NULL THEN 'Unknown'
        WHEN TRIM(carrier_code) IN ('FDX', 'FEDEX') THEN 'FedEx' ELSE UPPER(TRIM(carrier_code)) END AS carrier FROM ship""",
    "status_columns": f"""WITH {_RULE} SELECT event_id, code, code AS derived_code, status AS status_by_locale, description
        FROM rule""",
    "normalized_record": _facts(
        "capture, 'FedEx' AS carrier, tracking_number, 'fdxg' AS carrier_code, code, derived_code, "
        "status_by_locale, description, CAST(0 AS BIGINT) AS possession, '' AS blanks, CAST(1 AS BIGINT) AS has_raw"
    ),
    # filters
    "prior_week_range": """SELECT o_orderkey AS row_id,
        CAST(CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) + 7 AS INTEGER) AS DATE) AS week_start,
        CAST(CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS DATE) AS week_end FROM orders""",
    "filter_prior_week": f"WITH {_SHIP} SELECT row_id, promised_delivery_date FROM ship WHERE {_IN_WEEK}",
    "filter_not_delivered": f"WITH {_SHIP} SELECT row_id, delivery_tracking_status FROM ship WHERE {_NOT_DELIVERED}",
    "preprocess": f"WITH {_SHIP} SELECT * EXCLUDE (lead) FROM ship WHERE {_IN_WEEK} AND {_NOT_DELIVERED}",
    "stage_counts": f"""WITH {_SHIP}, n AS (SELECT COUNT(*) AS a, COUNT(*) FILTER (WHERE {_IN_WEEK}) AS w,
        COUNT(*) FILTER (WHERE {_IN_WEEK} AND {_NOT_DELIVERED}) AS d FROM ship)
        SELECT 'drop_first_column' AS stage, a AS before, a AS after, CAST(0 AS BIGINT) AS delta FROM n
        UNION ALL SELECT 'filter_prior_week', a, w, w - a FROM n
        UNION ALL SELECT 'filter_not_delivered', w, d, d - w FROM n""",
    "blank_key_filter": f"""WITH {_SHIP} SELECT row_id, {_key("tracking_number")} AS tracking_number,
        {_key("carrier_code")} AS carrier_code FROM ship WHERE {_key("tracking_number")} IS NOT NULL""",
    "view_pretransit": _flagged("event_id, code", "is_pretransit = 1"),
    "view_stalled": _flagged("event_id, code, is_stalled", "is_stalled = 1"),
    "view_damaged_or_returned": _flagged("event_id, code, damaged, is_rts", "damaged = 1 OR is_rts = 1"),
    "view_all_issues": _flagged("event_id, code", "is_delivered <> 1"),
    "view_all_issues_without_delivered": _flagged(
        "event_id", "has_exception = 1 OR is_stalled = 1 OR is_rts = 1"
    ),
    # lookups
    "extract_tracking_numbers": f"WITH {_EV} SELECT DISTINCT capture, tracking_number FROM ev",
    "replay_index": f"WITH {_EV} SELECT tracking_number, MAX(capture) AS capture FROM ev GROUP BY 1",
    "replay_lookup": f"""WITH {_SHIP}, {_FACT}, {_LAST}, keyed AS (SELECT row_id, {_key("tracking_number")} AS k FROM ship)
        SELECT row_id, CASE WHEN f.kind = 4 THEN f.code END AS flat_code,
         CASE WHEN k IS NOT NULL THEN CAST(f.tracking_number IS NULL AS BIGINT) END AS is_miss
        FROM keyed LEFT JOIN last f ON k = f.tracking_number""",
    "scope_to_tn": _facts(
        "capture, tracking_number, CAST(kind < 4 AS BIGINT) AS matched, scan_count, CAST(kind < 4 AS BIGINT) AS own_result"
    ),
    "normalize_scope": f"""WITH {_FACT}, many AS (SELECT *, COUNT(*) FILTER (WHERE kind < 4) OVER (PARTITION BY capture, part) AS m
        FROM fact) SELECT capture, tracking_number, CAST(kind < 4 AND m > 1 AS BIGINT) AS is_batch,
        CAST(kind < 4 AND m > 1 AS BIGINT) AS narrowed, CASE WHEN kind > 2 THEN '' ELSE code END AS code FROM many""",
    "carrier_map": f"{_NUMBERED} SELECT k AS tracking_number, c AS carrier_code FROM carrier",
    "request_batches": f"""{_NUMBERED} SELECT CAST(FLOOR(r / 30) AS BIGINT) AS batch,
        string_agg(k, '|' ORDER BY row_id) AS numbers, string_agg(COALESCE(c, '-'), '|' ORDER BY row_id) AS carriers,
        CAST(1 AS BIGINT) AS detailed FROM ranked JOIN carrier USING (k) GROUP BY 1""",
    "split_batch_response": _facts(f"{_BATCH}, tracking_number, scan_count", _TN_DEEP),
    "batch_result_or_body": f"""WITH {_FACT}, deep AS (SELECT capture, part, COUNT(*) FILTER (WHERE kind < 4) AS n
        FROM fact GROUP BY 1, 2) SELECT capture * 1000000 + part AS batch, tracking_number,
        CASE WHEN n = 0 THEN 'none' WHEN kind < 4 THEN 'own' ELSE 'whole' END AS source,
        CASE WHEN kind < 4 THEN 1 ELSE n END AS results, CASE WHEN kind <= 2 THEN ev_status ELSE '' END AS own_status
        FROM fact JOIN deep USING (capture, part)
        UNION ALL SELECT DISTINCT CAST(-1 AS BIGINT), tracking_number, 'none', CAST(0 AS BIGINT), '' FROM fact""",
    "batch_then_single": f"""WITH {_SHIP}, {_FACT}, {_LAST},
        keyed AS (SELECT DISTINCT {_key("tracking_number")} AS k FROM ship)
        SELECT k AS tracking_number, COALESCE(derived_code, '') AS derived_code,
         COALESCE(status_by_locale, '') AS status_by_locale, COALESCE(latest_ts, '') AS latest_ts,
         COALESCE(scan_count, 0) AS scan_count
        FROM keyed LEFT JOIN last ON k = tracking_number WHERE k IS NOT NULL""",
    "unwrap_envelope": f"""WITH {_FACT} SELECT capture, 0 AS kind, part, COUNT(*) AS results FROM fact WHERE kind < 4
        GROUP BY capture, part UNION ALL SELECT capture, 1, user_id, CAST(0 AS BIGINT) FROM fact WHERE kind = 4""",
    "map_tn_to_body": f"""WITH {_EV} SELECT tracking_number, MAX(capture) AS capture, CAST(1 AS BIGINT) AS unwrapped
        FROM ev WHERE user_id % 5 NOT IN (2, 4) GROUP BY 1""",
    # payload reading
    "status_from_lsd": _facts(
        ", ".join(
            f"CASE WHEN kind <= 2 THEN {e} ELSE '' END AS {n}"
            for n, e in (
                ("code", "code"),
                ("derived_code", "derived_code"),
                ("status_by_locale", "ev_status"),
                ("description", "description"),
            )
        )
        + ", capture, tracking_number"
    ),
    "status_from_scans": _facts(
        "capture, tracking_number, CASE WHEN kind < 4 THEN ev_code ELSE '' END AS code, "
        "CASE WHEN kind < 4 THEN ev_code ELSE '' END AS derived_code, "
        "CASE WHEN kind = 4 THEN '' WHEN eid % 2 = 1 THEN description ELSE ev_status END AS status_by_locale, "
        "CASE WHEN kind < 4 THEN description ELSE '' END AS description"
    ),
    "status_from_flat": _facts(
        "capture, tracking_number, "
        + ", ".join(
            f"CASE WHEN kind = 4 THEN {e} ELSE '' END AS {n}"
            for n, e in (
                ("code", "ev_code"),
                ("derived_code", "ev_code"),
                ("status_by_locale", "ev_status"),
                ("description", "description"),
            )
        )
    ),
    "normalize_status": _facts("capture, tracking_number, code, derived_code, status_by_locale, description"),
    # Each spelling keeps the day, the minute, the second or all of a time; the one with an offset is behind by it.
    "event_time_spellings": f"""WITH t AS (SELECT event_id, event_id % 12 AS k, CAST(ts AS TIMESTAMP) AS ts FROM events),
        r AS (SELECT event_id, CASE WHEN k IN (0, 6) THEN date_trunc('day', ts) WHEN k IN (1, 7) THEN date_trunc('minute', ts)
         WHEN k IN (2, 3, 5, 8) THEN date_trunc('second', ts) WHEN k = 9 THEN date_trunc('second', ts) - INTERVAL '330' MINUTE WHEN k = 4 THEN ts END AS ts FROM t)
        SELECT event_id, CASE WHEN ts IS NOT NULL THEN {_iso("ts")} END AS read FROM r""",
    "unread_time_shapes": "SELECT CASE event_id % 12 WHEN 10 THEN 'A 9' ELSE '9:9' END AS shape, COUNT(*) AS n FROM events WHERE event_id % 12 >= 10 GROUP BY 1",
    "latest_event_ts": _facts("capture, tracking_number, latest_ts"),
    "latest_status_detail": _facts(
        "capture, tracking_number, CAST(kind > 2 AS BIGINT) AS is_empty, CASE WHEN kind <= 2 THEN code END AS code, "
        "CASE WHEN kind <= 2 AND ev_code = 'DE' THEN '039' END AS reason"
    ),
    "ancillary_text": _facts("capture, tracking_number, ancillary"),
    "ancillary_series": _facts(
        f"{_BATCH}, tracking_number, CASE WHEN kind = 1 THEN 'ready text' ELSE '' END AS from_text, "
        "CASE WHEN kind = 0 THEN LOWER(ancillary) ELSE '' END AS from_detail, LOWER(ancillary) AS from_any",
        _TN_DEEP,
    ),
    "scan_event_count": f"WITH {_FACT} SELECT tracking_number, CAST(SUM(scan_count) AS BIGINT) AS scan_count FROM fact GROUP BY 1",
    "scan_event_count_literal": f"WITH {_EV} SELECT DISTINCT tracking_number, CAST(0 AS BIGINT) AS scan_count FROM ev",
    "scan_event_timestamps": _facts("capture, tracking_number, scan_times"),
    "replay_facts": f"""WITH {_FACT}, {_LAST} SELECT tracking_number, code, derived_code, status_by_locale, description,
        CAST(1 AS BIGINT) AS readable, latest_ts, scan_count, scan_times, ancillary FROM last""",
    "enrich": f"""{_enriched()} SELECT row_id, code, derived_code, status_by_locale, description, ancillary, latest_ts,
        scan_count, scan_times FROM enriched""",
    # metric, flags, labels
    "days_since_latest_event": f"""WITH {_EV} SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 0 ELSE
        CAST(FLOOR((epoch_us(TIMESTAMP '2024-01-20 06:00:00') - epoch_us(ts)) / 86400000000) AS BIGINT) END AS idle_days
        FROM ev""",
    "is_pretransit": _rule_flag("derived = 'OC'", "is_pretransit"),
    "is_delivered": _rule_flag("(derived = 'DL' OR seed_delivered = '1')", "is_delivered"),
    "has_exception": _rule_flag(_exc("derived", "status", "description"), "has_exception"),
    "is_rts": _rule_flag(f"({_rts('derived', 'status', 'description')} OR seed_rts = 1)", "is_rts"),
    "is_terminal": _flagged(
        "event_id, CAST(is_delivered = 1 OR is_rts = 1 AS BIGINT) AS is_terminal"
    ),
    "is_stalled": _flagged("event_id, is_stalled"),
    "is_stalled_without_scans": f"""WITH {_RULE} SELECT event_id, is_stalled FROM (SELECT event_id, {_flags(
        "derived", "status", "description", "ancillary", _DAYS, "FALSE", "seed_delivered = '1'", "seed_rts = 1", 6)} FROM rule) t""",
    "unable_to_deliver": _flagged("event_id, unable_to_deliver"),
    "damaged": _flagged("event_id, damaged"),
    "exception_gate": _flagged(
        "event_id, has_exception AS by_flag, CAST(contains(LOWER(status), 'exception') AS BIGINT) AS by_text"
    ),
    "apply_indicators": _flagged(
        "event_id, is_pretransit, is_delivered, has_exception, is_rts, is_stalled, damaged, unable_to_deliver"
    ),
    "calculated_reasons": _flagged(f"event_id, {_REASONS} AS calculated_reasons"),
    "calculated_status": _flagged(f"event_id, {_label('as before')} AS calculated_status"),
    "classify_pretransit": _rule_flag(_C_PRE, "is_pretransit"),
    "classify_delivered": _rule_flag(_C_DLV, "is_delivered"),
    "classify_exception": _rule_flag(_C_EXC, "is_exception"),
    "classify_status": f"""WITH {_RULE} SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Kept' WHEN {_C_DLV} THEN 'Delivered'
        WHEN {_C_EXC} THEN 'Exception' WHEN {_C_PRE} THEN 'PreTransit' ELSE '' END AS calculated_status FROM rule""",
    # whole jobs
    "process_shipments": f"{_judged()} SELECT {_RESULT} FROM judged",
    "process_shipments_one_week": f"{_judged(where=f'{_IN_WEEK} AND {_NOT_DELIVERED}')} SELECT {_RESULT} FROM judged",
    "status_report": f"""{_judged()} SELECT calculated_status, calculated_reasons, COUNT(*) AS shipments FROM judged
        GROUP BY 1, 2""",
    "process_and_publish": f"""{_judged(_LAST_APPENDED)}
        SELECT 'all_shipments' AS output, row_id, COALESCE({_key("tracking_number")}, '') AS tracking_number, '' AS status FROM ship
        UNION ALL SELECT 'processed', row_id, '', calculated_status FROM judged
        UNION ALL SELECT 'all_issues', row_id, {_CLEAN}, calculated_status FROM judged WHERE is_delivered <> 1
        UNION ALL SELECT 'pretransit', row_id, {_CLEAN}, calculated_status FROM judged WHERE is_pretransit = 1
        UNION ALL SELECT 'stalled', row_id, {_CLEAN}, calculated_status FROM judged WHERE is_stalled = 1
        UNION ALL SELECT 'damaged_or_returned', row_id, {_CLEAN}, calculated_status FROM judged WHERE damaged = 1 OR is_rts = 1
        UNION ALL SELECT 'marker', (SELECT COUNT(*) FROM ship), CAST(COUNT(*) AS STRING), 'ok' FROM judged""",
    "normalizer": f"""{_judged(_LAST_APPENDED)}, places AS (SELECT tracking_number AS tn,
         CASE WHEN kind <= 2 THEN 'detail' WHEN kind = 3 THEN 'scan' ELSE 'flat' END AS place FROM last)
        SELECT row_id, COALESCE(place, '') AS place, COALESCE(place || ':' || code, '') AS code, derived_code, status_by_locale,
         description, ancillary, latest_ts, scan_count, calculated_status FROM judged LEFT JOIN places ON k = tn""",
    "published_versions": f"""
        SELECT CAST(1 AS BIGINT) AS version, * FROM ({_judged(where=f"{_IN_WEEK} AND {_NOT_DELIVERED}")}
         SELECT row_id, calculated_status AS status FROM judged WHERE is_stalled = 1)
        UNION ALL SELECT CAST(2 AS BIGINT), * FROM ({_judged()}
         SELECT row_id, calculated_status FROM judged WHERE is_stalled = 1)""",
    "tn_snapshot": f"""{_judged()}, firsts AS (SELECT k AS tracking_number, arg_min(idle_days, row_id) AS d,
        arg_min(calculated_reasons, row_id) AS r, arg_min(is_stalled, row_id) AS s FROM judged WHERE k IS NOT NULL GROUP BY 1)
        SELECT CAST(c_custkey AS STRING) AS tracking_number, CAST(d AS DOUBLE) AS days, r AS reasons, s AS stalled
        FROM customer LEFT JOIN firsts ON tracking_number = CAST(c_custkey AS STRING)""",
}
