"""The seven 0/1 flags of a shipment row.

Each rule takes the table and returns a boolean column; which rule text applies
can depend on which columns exist, and that is settled while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwatch.functions.payload import (
    ancillary_text,
    detail_of,
    has_wrapper,
    results_of,
    typed_body,
)
from parcelwatch.functions.text import as_int, latest_code, lower_trim_text, upper_text
from parcelwatch.schema import ANCILLARY, FLAGS, IDLE_DAYS, LATEST_DETAIL, SCAN_COUNT, col, has

# Codes, texts and patterns of the rules.
PRETRANSIT_CODE = "OC"
DELIVERED_CODE = "DL"
EXCEPTION_CODES = ("DE", "SE", "EX", "EXC")
EXCEPTION_TEXTS = ("EXCEPTION", "DAMAGED", "UNABLE TO DELIVER")
RETURN_CODES = ("RS", "RTS")
RETURN_PATTERN = r"(?U)\bRETURN(ING)?\s(PACKAGE\sTO\sSHIPPER|TO\s(SHIPPER|SENDER))\b"
UNABLE_PATTERN = r"(?U)\bunable\s+to\s+deliver\b"
DAMAGED_PATTERN = r"(?U)\bdamaged\b"
DEFAULT_STALLED_DAYS = 4


def is_pretransit(df: DataFrame) -> Column:
    """By code alone; label texts do not count."""
    return latest_code(df) == PRETRANSIT_CODE


def is_delivered(df: DataFrame) -> Column:
    return (latest_code(df) == DELIVERED_CODE) | (as_int(df, "IsDelivered") == 1)


def has_exception(df: DataFrame) -> Column:
    """By code or text; a value already in the table is not consulted."""
    texts = (upper_text(df, "statusByLocale"), upper_text(df, "description"))
    found = latest_code(df).isin(*EXCEPTION_CODES)
    for t in texts:
        for phrase in EXCEPTION_TEXTS:
            found = found | F.contains(t, F.lit(phrase))
    return found


def is_rts(df: DataFrame) -> Column:
    found = latest_code(df).isin(*RETURN_CODES) | (as_int(df, "IsRTS") == 1)
    for t in (upper_text(df, "statusByLocale"), upper_text(df, "description")):
        # The cheap test spares most rows the pattern.
        found = found | (F.contains(t, F.lit("RETURN")) & t.rlike(RETURN_PATTERN))
    return found


def is_terminal(df: DataFrame) -> Column:
    return (as_int(df, "IsDelivered") == 1) | (as_int(df, "IsRTS") == 1)


def is_stalled(df: DataFrame, threshold_days: int = DEFAULT_STALLED_DAYS) -> Column:
    """Idle too long, or no scan at all where scans were counted; reads the other flags."""
    idle = as_int(df, IDLE_DAYS) >= int(threshold_days)
    if has(df, SCAN_COUNT):
        idle = idle | (as_int(df, SCAN_COUNT) == 0)
    return idle & ~is_terminal(df) & (as_int(df, "IsPreTransit") != 1)


def exception_gate(df: DataFrame) -> Column:
    """The exception flag; without that column, the word in the status text."""
    if has(df, "HasException"):
        return as_int(df, "HasException") == 1
    return F.contains(lower_trim_text(df, "statusByLocale"), F.lit("exception"))


def _as_variant(df: DataFrame, name: str) -> str:
    kind = df.schema[name].dataType
    if isinstance(kind, T.VariantType):
        return name
    return f"try_parse_json({name})" if isinstance(kind, T.StringType) else f"try_parse_json(to_json({name}))"


def ancillary_series(df: DataFrame) -> Column:
    """Lower-case ancillary text: ready-made column, else detail column, else raw body.

    Detail and body columns may be VARIANT, JSON text or structs.
    """
    if has(df, ANCILLARY):
        return F.lower(F.coalesce(col(ANCILLARY).cast("string"), F.lit("")))
    sources = []
    if has(df, LATEST_DETAIL):
        sources.append(ancillary_text(_as_variant(df, LATEST_DETAIL)))
    if has(df, "raw"):
        raw = _as_variant(df, "raw")
        first = f"get({results_of(typed_body(raw), has_wrapper(raw))}, 0)"
        sources.append(ancillary_text(detail_of(first)))
    texts = [F.nullif(F.expr(s), F.lit("")) for s in sources]
    return F.lower(F.coalesce(*texts, F.lit("")))


def unable_to_deliver(df: DataFrame) -> Column:
    text = F.concat_ws(
        " ",
        ancillary_series(df),
        lower_trim_text(df, "statusByLocale"),
        lower_trim_text(df, "description"),
    )
    return exception_gate(df) & F.contains(text, F.lit("unable")) & text.rlike(UNABLE_PATTERN)


def damaged(df: DataFrame) -> Column:
    """Looks at the ancillary text only."""
    text = ancillary_series(df)
    return exception_gate(df) & F.contains(text, F.lit("damaged")) & text.rlike(DAMAGED_PATTERN)


def apply_indicators(df: DataFrame, threshold_days: int = DEFAULT_STALLED_DAYS) -> DataFrame:
    """Compute all flags. Three levels: direct rules, stalled, then what needs the exception flag."""

    def flags(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
        return frame.withColumns({n: c.cast("bigint") for n, c in rules.items()})

    missing = [n for n in FLAGS if n not in df.columns]
    out = df.withColumns({n: F.lit(0).cast("bigint") for n in missing}) if missing else df
    out = flags(
        out,
        {
            "IsPreTransit": is_pretransit(out),
            "IsDelivered": is_delivered(out),
            "HasException": has_exception(out),
            "IsRTS": is_rts(out),
        },
    )
    return flags(
        out,
        {
            "IsStalled": is_stalled(out, threshold_days),
            "UnableToDeliver": unable_to_deliver(out),
            "Damaged": damaged(out),
        },
    )
