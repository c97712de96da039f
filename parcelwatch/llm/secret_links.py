"""Secrets in texts, and parts of credentials that only count together.

Strong findings (base kinds) stand for themselves:

* ``assign``: a word such as ``password`` with an assigned value of 8 or more characters,
* ``access``: an access key identifier, 16 or more characters,
* ``hex``: 32 or more hexadecimal digits.

Weak candidates are common in harmless text: ``ident`` (names of an account or client, temporary key
identifiers), ``value`` (a long run of mixed characters), ``endpoint`` (a service URL or an IPv4 address). They are
reported only where complementary parts lie in the same scope of a document: an ident with a secret (assign, hex,
value), a value with an identifier (access, ident), an endpoint with both.

Scopes are intervals of a text, side by side. In a text with section headers (``[name]`` alone on a line) they are its
sections, and what comes before the first. In any other they are paragraphs and blocks: they end at blank lines, at
lines that begin with ``---``, and at lines that begin with a closing brace or bracket. Such a text of at most ``SHORT`` code
points is one scope. How far parts lie from each other within a scope makes no difference.

The interval join is a sweep over a document's parts and scope ends in order of position: the scope ends passed so far
number the scope of a part, and a scope's parts tell which kinds it has. It is exact, no pairs are made, and ends of scopes are
looked for only in texts that hold complementary parts at all. Everything is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text

#: Code points up to which a text without section headers is one scope.
SHORT = 256
#: Kinds in the order of reports, their patterns and the shortest match or group that counts.
#: kind, pattern, group that is measured, its least length
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("ident", r"""(?:ASIA|AIDA|AROA)[A-Z0-9]{12,}|(?:[cC]lient|[aA]ccount|[uU]ser)[_-]?(?:[iI][dD]|[nN]ame)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", 0, 0),
    ("value", r"[A-Za-z0-9+/]{32,}", 0, 32),
    ("endpoint", r"""(?:https?|s3|ftp|sftp|ldaps?|redis|amqps?|mongodb|postgres(?:ql)?|mysql)://[^\x20\x09-\x0D"'<>]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?""", 0, 0),
)
#: Ends of scopes, as kinds; looked for between two added line feeds, so that every line lies between two.
ENDS = (
    ("section", r"\n[\x20\t]*\[\[?[A-Za-z_][^\[\]\n]*\]\]?[\x20\t\r]*\n", 0, 0),
    ("paragraph", r"\n(?:[\x20\t\r]*\n|---|[}\]])", 0, 0),
)
BASE = ("assign", "access", "hex")
_RANK = {k: i for i, (k, *_) in enumerate(KINDS + ENDS)}
#: A run of mixed characters has a digit, a capital and a small letter.
_MIXED = r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])"


def _found(text: Column, kind: str, pattern: str, group: int, least: int) -> tuple[Column, Column]:
    """The matches of a kind, and from them an array of (rank, nth, gap, size, counts)."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    name = F.col(f"_{kind}")
    gaps = F.split(text, pattern, -1)
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else name
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(name)).alias("gap"), name.alias("hit"), measured.alias("part"))
    parts = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(_RANK[kind]).alias("rank"),
            i.alias("nth"),
            F.length(x["gap"]).alias("gap"),
            F.length(x["hit"]).alias("size"),
            ((F.length(x["part"]) >= least) & (x["hit"].rlike(_MIXED) if kind == "value" else F.lit(True))).alias("counts"),
        ),
    )
    none = F.array().cast("array<struct<rank:int,nth:int,gap:int,size:int,counts:boolean>>")
    return matches, F.when(F.size(name) > 0, parts).otherwise(none)


def secret_spans(docs: DataFrame, short: int = SHORT) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ..)``: doc_id, spans (array of start, rank, end, kind in order).

    Positions are code points, the end exclusive. Null text counts as empty. Rows with the same doc_id, or with none, are
    documents of their own. A table without rows gives none.
    """
    one = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text(docs).alias("_text"), F.monotonically_increasing_id().alias("row"))
    found = {k: _found(F.col("_text"), k, *rest) for k, *rest in KINDS}
    one = one.select("*", *(m.alias(f"_{k}") for k, (m, _) in found.items()))
    any_of = lambda *kinds: F.greatest(*(F.size(f"_{k}") for k in kinds)) > 0
    linkable = any_of("access", "ident") & any_of("assign", "hex", "value") & any_of("ident", "value", "endpoint")
    one = one.select("*", F.when(linkable, F.concat(F.lit("\n"), "_text", F.lit("\n"))).alias("_lines"))
    for k, *rest in ENDS:
        found[k] = _found(F.col("_lines"), k, *rest)
        wanted = F.col("_lines").isNotNull() if k == "section" else (F.size("_section") == 0) & (F.length("_text") > short)
        one = one.select("*", F.when(wanted, found[k][0]).alias(f"_{k}"))
    one = one.select("doc_id", "row", F.concat(*(p for _, p in found.values())).alias("parts"))
    each = one.select("row", "doc_id", F.explode_outer("parts").alias("p")).select("row", "doc_id", "p.*").repartition("row")
    before = Window.partitionBy("row", "rank").orderBy("nth")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before)).withColumn("start", F.col("end") - F.col("size"))
    # A match that does not count only moves what follows. A text without any finding keeps a row, without a rank.
    placed = placed.select("row", "doc_id", F.when(F.col("counts"), F.col("rank")).alias("rank"), "start", "end")

    # An end of a scope begins with a line feed, one place later than in the text; no part begins with one.
    is_end = F.col("rank") >= len(KINDS)
    sweep = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    scoped = placed.withColumn("scope", F.count(F.when(is_end, 1)).over(sweep))
    scope = Window.partitionBy("row", "scope")
    holds = lambda *kinds: F.coalesce(F.max(F.col("rank").isin(*(_RANK[k] for k in kinds))).over(scope), F.lit(False))
    seen = scoped.select("*", holds("access", "ident").alias("ident"), holds("assign", "hex", "value").alias("secret"))
    linked = (
        F.when(F.col("rank") == _RANK["ident"], F.col("secret"))
        .when(F.col("rank") == _RANK["value"], F.col("ident"))
        .when(F.col("rank") == _RANK["endpoint"], F.col("ident") & F.col("secret"))
        .otherwise(F.col("rank") < len(BASE))
    )
    kind = F.element_at(F.array(*(F.lit(k) for k in _RANK)), F.col("rank") + 1)
    span = F.when(linked, F.struct("start", "rank", "end", kind.alias("kind")))
    return seen.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(span)).alias("spans")).select("doc_id", "spans")


def secret_report(docs: DataFrame, short: int = SHORT) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; see ``secret_spans``."""
    found = secret_spans(docs, short)

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind))

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select(
        "doc_id",
        *(of_kind(k).cast("bigint").alias(f"n_{k}") for k in BASE),
        F.sha2(written(F.filter("spans", lambda x: x["rank"] < len(BASE))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
