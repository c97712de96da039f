"""Fill-in-the-middle: every text is cut at two places between tokens, and its parts are written in another order.

``regexp_count`` gives the number n of tokens (runs of letters, or one other character). Two digests of the document's
id choose the cuts a <= b, and a pattern made for the row, with possessive groups that take exactly a and b - a
tokens, captures prefix, middle and suffix in one match, which is rewritten on the spot. A possessive counted
group gives nothing back, so the match takes time and memory in proportion to the text. The parts are found again in the
output by its markers: a text that holds a marker itself is left plain.

All of it is one projection of built-in functions; no row is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

#: Tokens: runs of letters, or any other single character.
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The same in a match that never steps back.
_POSSESSIVE = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _number(hex_digits: Column, nth: int) -> Column:
    return F.conv(F.substring(hex_digits, 8 * nth + 1, 8), 16, 10).cast("bigint")


def filled(docs: DataFrame, plain_percent: int = 10, suffix_first_percent: int = 20, seed: str = "1") -> DataFrame:
    """The rows of ``docs(doc_id, text, ..)``, as doc_id, text, n, form, output.

    n is the number of tokens; form is psm (prefix, suffix, middle), spm (suffix, prefix, middle) or plain (the text as it is:
    empty texts, texts that hold a marker, and ``plain_percent`` of the rest). Null text counts as empty. A null doc_id draws like an
    empty one. Rows that repeat a doc_id draw the same numbers. An empty table gives no rows.
    """
    text = whole_text(docs)
    rows = docs.select(
        "doc_id",
        text.alias("text"),
        F.regexp_count(text, F.lit(UNIT)).cast("bigint").alias("n"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256).alias("h"),
    )
    cuts = [F.pmod(_number(F.col("h"), i), F.col("n") + 1) for i in (0, 1)]
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(marker))
    plain = (F.col("text") == "") | marked | (_number(F.col("h"), 2) % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(_number(F.col("h"), 3) % 100 < suffix_first_percent, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"), form.alias("form"))
    counted = [F.concat(F.lit(f"({_POSSESSIVE}{{"), size.cast("string"), F.lit("}+)")) for size in (F.col("a"), F.col("b") - F.col("a"))]
    pattern = F.concat(F.lit(r"\A"), *counted, F.lit(r"((?s:.*))\z"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return rows.select("doc_id", "text", "n", "form", output.alias("output"))


def parts(form: Column, output: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output that is not plain. Its first markers are the real ones, as none is in the text."""
    spm = form == "spm"
    head, tail = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    first = F.when(spm, F.substring_index(head, PREFIX, 1)).otherwise(F.substring_index(head, SUFFIX, 1))
    second = F.when(spm, F.substring_index(head, PREFIX, -1)).otherwise(F.substring_index(head, SUFFIX, -1))
    first = F.substr(first, F.lit(len(PREFIX) + 1))
    return F.when(spm, second).otherwise(first), tail, F.when(spm, first).otherwise(second)


def fill_report(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars (code points, null if plain), output_sha256, and
    restored_sha256 of the text rebuilt from output and form alone. Nulls, repeated rows, empty tables: see ``filled``."""
    rows = filled(docs, **options)
    prefix, middle, suffix = parts(F.col("form"), F.col("output"))
    plain = F.col("form") == "plain"
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.when(~plain, F.length(prefix).cast("bigint")).alias("prefix_chars"),
        F.when(~plain, F.length(middle).cast("bigint")).alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(F.when(plain, F.col("output")).otherwise(F.concat(prefix, middle, suffix)), 256).alias("restored_sha256"),
    )
