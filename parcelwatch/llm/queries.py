"""One query per operator over the given tables, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, fill_middle, language, length_histogram, license_scan, near_dup, piece_chunks, quality, rans, secret_links, set_relations, template_leaks, turn_repair
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_rans_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.encoded_index(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(documents(spark, sf_dir))


ORACLES["op2_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""


@query
def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return length_histogram.context_limits(length_histogram.length_histogram(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN))


@query
def op4_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.secret_report(documents(spark, sf_dir))


def _secret_sql() -> str:
    letters = "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(secret_links.KINDS):
        if kind == "assign":
            pattern = letters + pattern.removeprefix("(?i)(password|passwd|secret|token|api_?key)")
        quoted = pattern.replace("'", "''")
        counts = f"length(p) >= {least}" + (" AND regexp_matches(h, '[0-9]') AND regexp_matches(h, '[A-Z]') AND regexp_matches(h, '[a-z]')" if kind == "value" else "")
        parts.append(f"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {counts} AS counts, n, h, sum(length(g) + length(h)) OVER (PARTITION BY doc_id ORDER BY n) AS e
FROM (SELECT doc_id, unnest(string_split_regex(t, '{quoted}')) AS g, unnest(regexp_extract_all(t, '{quoted}')) AS h,
             unnest(regexp_extract_all(t, '{quoted}', {group})) AS p, unnest(range(1, 1 + len(regexp_extract_all(t, '{quoted}')))) AS n FROM d
      WHERE regexp_matches(t, '{quoted}')) WHERE h IS NOT NULL""")
    sections, others = ("'" + p.replace("'", "''") + "'" for _, p, *_ in secret_links.ENDS)
    padded = "chr(10) || t || chr(10)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
s AS (SELECT doc_id, rank, kind, CAST(e - length(h) AS BIGINT) AS b, CAST(e AS BIGINT) AS e FROM m WHERE counts),
c AS (SELECT doc_id, {padded} AS x,
             CASE WHEN regexp_matches({padded}, {sections}) THEN {sections} WHEN length(t) > {secret_links.SHORT} THEN {others} ELSE 'a^' END AS pattern
      FROM d WHERE doc_id IN (SELECT doc_id FROM s)),
f AS (SELECT doc_id, b - 1 AS b FROM (
        SELECT doc_id, h, sum(length(g) + length(h)) OVER (PARTITION BY doc_id ORDER BY n) - length(h) AS b
        FROM (SELECT doc_id, unnest(string_split_regex(x, {sections})) AS g, unnest(regexp_extract_all(x, {sections})) AS h, unnest(range(1, 1 + len(regexp_extract_all(x, {sections})))) AS n
              FROM c WHERE pattern = {sections} UNION ALL
              SELECT doc_id, unnest(string_split_regex(x, {others})), unnest(regexp_extract_all(x, {others})), unnest(range(1, 1 + len(regexp_extract_all(x, {others}))))
              FROM c WHERE pattern = {others})) WHERE h IS NOT NULL),
o AS (SELECT s.*, (SELECT count(*) FROM f WHERE f.doc_id = s.doc_id AND f.b < s.b) AS scope FROM s),
j AS (SELECT *, bool_or(kind IN ('access', 'ident')) OVER same AS ident, bool_or(kind IN ('assign', 'hex', 'value')) OVER same AS secret
      FROM o WINDOW same AS (PARTITION BY doc_id, scope)),
k AS (SELECT *, kind || ':' || b || ':' || e AS w FROM j
      WHERE rank < 3 OR kind = 'ident' AND secret OR kind = 'value' AND ident OR kind = 'endpoint' AND ident AND secret)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(w, ',' ORDER BY b, rank) FILTER (rank < 3), '')) AS base_sha256,
       coalesce(string_agg(w, ',' ORDER BY b, rank), '') AS spans
FROM d LEFT JOIN k USING (doc_id) GROUP BY doc_id
"""


ORACLES["op4_secret_links"] = _secret_sql()


@query
def op5_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(documents(spark, sf_dir))


def _license_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quote(n)}, {quote(t)})" for i, (n, t) in enumerate(license_scan.TEMPLATES))
    normal = "regexp_replace(lower(%s), '[^\\p{L}\\p{N}\\n]+', ' ', 'g')"
    grams = "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    words = "list_filter(string_split(replace(%s, chr(10), ' '), ' '), lambda x: x <> '')"
    return f"""
WITH t AS (SELECT i, n, {grams} AS g FROM (SELECT i, n, {words % (normal % 'x')} AS w FROM (VALUES {rows}) v(i, n, x))),
d AS (SELECT doc_id, {normal % "coalesce(text, '')"} AS x FROM documents),
l AS (SELECT doc_id, x, unnest(string_split(x, chr(10))) AS u, unnest(range(len(string_split(x, chr(10))))) AS nth FROM d),
p AS (SELECT doc_id, x, unnest(s) AS u, unnest(range(len(s))) AS nth, len(s) AS k FROM (SELECT *, string_split_regex(x, '\n *\n[ \n]*') AS s FROM d)),
u AS (SELECT doc_id, 0 AS o, 'line' AS unit, nth, u FROM l UNION ALL
      SELECT doc_id, 1, 'paragraph', nth, u FROM p WHERE contains(trim(u), chr(10)) UNION ALL
      SELECT doc_id, 2, 'text', 0, x FROM p WHERE nth = 0 AND k > 1),
w AS (SELECT * EXCLUDE (u), {words % 'u'} AS w FROM u),
b AS (SELECT * EXCLUDE (w), {grams} AS g FROM w WHERE len(w) > 1),
m AS (SELECT doc_id, o, unit, nth, n, i, CAST(2000 * len(list_intersect(b.g, t.g)) // (len(b.g) + len(t.g)) AS INTEGER) AS permille
      FROM b JOIN t ON len(list_intersect(b.g, t.g)) * 2 >= 0.8 * (len(b.g) + len(t.g))),
k AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, o, nth ORDER BY permille DESC, i) = 1)
SELECT doc_id, CAST(count(n) AS INTEGER) AS n_matches, coalesce(string_agg(DISTINCT n, ',' ORDER BY n), '') AS licenses, max(permille) AS best,
       coalesce(string_agg(unit || ':' || nth || ':' || n || ':' || permille, ',' ORDER BY o, nth), '') AS matches
FROM d LEFT JOIN k USING (doc_id) GROUP BY doc_id
"""


ORACLES["op5_license_dice"] = _license_sql()


@query
def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_copies(documents(spark, sf_dir), width=3, percent=85, bands=40, rows=7)


@query
def op7_piece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_chunks.encoded_pieces(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(documents(spark, sf_dir))


@query
def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op10_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.quality_scores(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query
def op11_set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_relations.similar_sets(documents(spark, sf_dir), width=5, percent=80)


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_report(documents(spark, sf_dir))


ORACLES["op12_fill_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           [CAST('0x' || substr(sha256('1:' || doc_id), 8 * i + 1, 8) AS BIGINT) for i in range(4)] AS h FROM documents),
c AS (SELECT doc_id, t, u, len(u) AS n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
      CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[:a], '') AS x, array_to_string(u[a + 1 : b], '') AS y, array_to_string(u[b + 1 :], '') AS z FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repaired(turn_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _repair_sql() -> str:
    """The least (cost, audit) per role state after each row, row by row; inserts are two steps at most."""
    crc = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ord(c)::BIGINT for c in string_split(%s, '')]), lambda a, b: xor(a >> 8, crc.v[xor(a, b) & 255 + 1])))"
    table = "n"
    for _ in range(8):
        table = f"[CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END for x in [{table}]][1]"
    crc = crc.replace("& 255 + 1", "%% 256 + 1")
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    moves = "(VALUES (0, '', 0, '', 0), (1, '', 1, '', 0), (2, '', 2, '', 0), (3, '', 3, '', 0), (0, 'I', 2, 'user:', 1), (1, 'I', 2, 'user:', 1), (2, 'I', 3, 'assistant:', 1), (3, 'I', 2, 'user:', 1), (0, 'II', 3, 'user:' || chr(10) || 'assistant:', 2), (1, 'II', 3, 'user:' || chr(10) || 'assistant:', 2)) i(f, ins, g, said, k)"
    return f"""
WITH RECURSIVE crc AS (SELECT [{table} for n in range(256)] AS v),
f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc % key} % 20 AS fault FROM conversations, crc),
g AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
      CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE fault WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fault <> 0),
h AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS nth,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
      regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS e FROM g),
r AS (SELECT *, substr(role, 1, 1) AS who, CASE WHEN e = '' THEN 1 WHEN again THEN 2 WHEN e NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM h),
w AS (SELECT *, lag(who) OVER (PARTITION BY conv_id ORDER BY nth) || who AS pair FROM r),
s AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
      count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM w GROUP BY conv_id),
b AS (SELECT conv_id, CAST(0 AS BIGINT) AS nth, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS said FROM s
      UNION ALL
      SELECT conv_id, nth, q, m.cost, m.audit, m.said FROM (
        SELECT b.conv_id, r.nth, t.q, min(struct_pack(cost := b.cost + 3 * i.k + t.c, audit := b.audit || i.ins || t.x,
               said := list_concat(b.said, CASE i.k WHEN 0 THEN [] ELSE [i.said] END, t.said))) AS m
        FROM b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.nth = b.nth + 1
        JOIN {moves} ON i.f = b.q,
        LATERAL (SELECT unnest([
          {{'x': 'D', 'q': i.g, 'c': 4, 'said': CAST([] AS VARCHAR[]), 'ok': true}},
          {{'x': 'K', 'q': CASE i.g WHEN 2 THEN 3 ELSE 2 END, 'c': CASE r.fault WHEN 3 THEN 3 ELSE 0 END, 'said': [r.role || ':' || r.text],
            'ok': r.fault IN (0, 3) AND r.who = CASE i.g WHEN 2 THEN 'a' ELSE 'u' END}},
          {{'x': 'K', 'q': 1, 'c': CASE r.fault WHEN 3 THEN 3 ELSE 0 END, 'said': [r.role || ':' || r.text], 'ok': r.fault IN (0, 3) AND r.who = 's' AND i.g = 0}},
          {{'x': 'R', 'q': CASE i.g WHEN 2 THEN 3 ELSE 2 END, 'c': CASE r.fault WHEN 3 THEN 6 ELSE 3 END,
            'said': [CASE i.g WHEN 2 THEN 'assistant:' ELSE 'user:' END || r.text], 'ok': r.fault IN (0, 3)}}], recursive := true)) t
        WHERE t.ok GROUP BY b.conv_id, r.nth, t.q)),
z AS (SELECT b.conv_id, min(struct_pack(cost := b.cost + CASE q WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END, audit := b.audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
      said := list_concat(b.said, CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END))) AS m
      FROM b JOIN s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.n = b.nth GROUP BY b.conv_id),
a AS (SELECT s.* EXCLUDE (n), m.cost AS cost, m.audit AS audit, sha256(array_to_string(m.said, chr(10))) AS repaired_sha256 FROM s JOIN z ON s.conv_id IS NOT DISTINCT FROM z.conv_id)
FROM a UNION ALL
SELECT DISTINCT conv_id, 0, 0, 0, 0, 0, 0, '', sha256('') FROM conversations c WHERE NOT EXISTS (FROM g WHERE g.conv_id IS NOT DISTINCT FROM c.conv_id)
"""


ORACLES["op13_turn_repair"] = _repair_sql()
