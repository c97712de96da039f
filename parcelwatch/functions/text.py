"""Text and number coercions. Everything here is a built-in expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwatch.schema import col, has

# Every character Python's str.strip() removes, derived from its own rule.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Texts that count as a missing key, compared in lower case.
BLANK_TEXTS = ("", "nan", "none")

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_SCIENTIFIC = r"^[+-]?(\d*)\.?(\d*)[eE]([+-]?\d+)$"
_PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated once and written once into the plan, however often ``use`` names it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace (``F.trim`` alone removes only spaces).

    Trimming a set of characters is slow; a text with printable ASCII at both ends is
    taken as it is.
    """
    one = F.lit(1)

    def trimmed(s: Column) -> Column:
        ends = F.left(s, one).between("!", "~") & F.right(s, one).between("!", "~")
        return F.when(ends, s).otherwise(F.btrim(s, F.lit(WHITESPACE)))

    return let(c, trimmed)


def strip_sql(text: str) -> str:
    """``strip`` as SQL text, for a variable or column name."""
    ends = " AND ".join(f"{end}({text}, 1) BETWEEN '!' AND '~'" for end in ("left", "right"))
    return f"(CASE WHEN {ends} THEN {text} ELSE btrim({text}, '{WHITESPACE}') END)"


def is_blank(c: Column) -> Column:
    """NULL, empty, ``nan`` or ``none`` once stripped, in any case."""
    return F.coalesce(F.lower(strip(c.cast("string"))).isin(*BLANK_TEXTS), F.lit(True))


def key_text(c: Column) -> Column:
    """Stripped key, NULL when blank."""
    return let(strip(c.cast("string")), lambda s: F.when(~F.lower(s).isin(*BLANK_TEXTS), s))


def text_or_blank(df: DataFrame, name: str) -> Column:
    """Text of a column; NULL and a missing column read as empty text."""
    return F.coalesce(col(name).cast("string"), F.lit("")) if has(df, name) else F.lit("")


def upper_text(df: DataFrame, name: str) -> Column:
    """Upper-case text of a column; a missing column reads as empty text."""
    return F.upper(text_or_blank(df, name))


def lower_trim_text(df: DataFrame, name: str) -> Column:
    """Stripped lower-case text of a column; a missing column reads as empty text."""
    return F.lower(strip(text_or_blank(df, name)))


def latest_code(df: DataFrame) -> Column:
    """Upper-case ``derivedCode`` if that column exists, even when blank, else ``code``."""
    return upper_text(df, "derivedCode" if has(df, "derivedCode") else "code")


def as_int(df: DataFrame, name: str) -> Column:
    """Whole number of a column as bigint; missing, NULL, NaN and non-numeric give 0."""
    if not has(df, name):
        return F.lit(0).cast("bigint")
    c, kind = col(name), df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        n = c.cast("bigint")
    elif isinstance(kind, T.NumericType):
        n = c.try_cast("bigint")
    else:
        # The guard keeps out texts such as '5d', which the SQL cast would accept.
        n = let(
            strip(c.cast("string")),
            lambda s: F.coalesce(
                s.try_cast("bigint"),
                F.when(s.rlike(_NUMBER), s.try_cast("double").try_cast("bigint")),
            ),
        )
    return F.coalesce(n, F.lit(0).cast("bigint"))


def clean_tracking_number(c: Column) -> Column:
    """Publishable tracking number: blanks become '', numeric texts become integers.

    Digits are cut and shifted as text, so values of any length stay exact. A number
    beyond the range of a double stays text.
    """

    def whole(n: Column, digits: Column) -> Column:
        sign = F.when(n.startswith("-"), F.lit("-")).otherwise(F.lit(""))
        return let(
            F.ltrim(digits, F.lit("0")),
            lambda d: F.when(d == "", F.lit("0")).otherwise(F.concat(sign, d)),
        )

    def shifted(n: Column) -> Column:
        """The digits before the point of a number in scientific notation."""
        before, after = (F.regexp_extract(n, _SCIENTIFIC, i) for i in (1, 2))
        by = F.regexp_extract(n, _SCIENTIFIC, 3).try_cast("int")
        up = let(by, lambda e: F.concat(before, F.rpad(F.left(after, e), e, F.lit("0"))))
        down = F.left(before, F.greatest(F.length(before) + by, F.lit(0)))
        return F.when(by > 0, up).otherwise(down)

    def cleaned(s: Column) -> Column:
        as_text = F.when(s.endswith(".0"), F.substring(s, F.lit(1), F.length(s) - 2)).otherwise(s)
        finite = let(s, lambda t: F.abs(F.replace(t, F.lit(","), F.lit("")).try_cast("double")) < float("inf"))
        number = let(
            F.replace(s, F.lit(","), F.lit("")),
            lambda n: F.when(n.rlike(_PLAIN_NUMBER), whole(n, F.regexp_extract(n, r"^[+-]?(\d*)", 1))).when(
                n.rlike(_NUMBER) & finite, whole(n, shifted(n))
            ),
        )
        return F.when(F.coalesce(F.lower(s).isin(*BLANK_TEXTS), F.lit(True)), F.lit("")).otherwise(F.coalesce(number, as_text))

    return let(strip(c.cast("string")), cleaned)


def carrier_name(c: Column) -> Column:
    """Display name of a carrier code."""
    u = F.upper(F.coalesce(c.cast("string"), F.lit("")))
    # Code prefixes and the two names.
    return (
        F.when(u.startswith("FDX") | u.startswith("FEDEX"), F.lit("FedEx"))
        .when(u == "", F.lit("Unknown"))
        .otherwise(u)
    )
