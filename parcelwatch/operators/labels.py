"""Status label and reasons of a row, and the text classifier for rows without a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwatch.functions.text import as_int, text_or_blank
from parcelwatch.schema import LABEL, REASONS, STATUS_FIELDS, col, has

# Reason per flag, in output order.
REASON_OF_FLAG = {
    "IsPreTransit": "PreTransit",
    "IsDelivered": "Delivered",
    "HasException": "Exception",
    "IsRTS": "ReturnedToSender",
    "IsStalled": "Stalled",
}

# Codes and lower-case text hints of the classifier.
PRETRANSIT_CODES = ("OC", "LP")
PRETRANSIT_HINTS = (
    "label created",
    "shipment information sent",
    "shipment info sent",
    "order created",
    "pending pickup",
    "awaiting pickup",
    "waiting for carrier pickup",
)
DELIVERED_CODES = ("DLV", "DL", "DEL")
DELIVERED_HINTS = ("delivered",)
EXCEPTION_CODES = ("EXC",)
EXCEPTION_HINTS = ("exception", "address correction", "damage")


def calculated_reasons(df: DataFrame) -> Column:
    """Reasons of all set flags, joined by semicolons."""
    return F.concat_ws(
        ";", *(F.when(as_int(df, f) == 1, F.lit(r)) for f, r in REASON_OF_FLAG.items())
    )


def calculated_status(df: DataFrame) -> Column:
    """One label by precedence. Lower ranks need the higher flags at exactly 0."""
    pre, dlv, exc, rts, stalled = (as_int(df, f) for f in REASON_OF_FLAG)
    current = col(LABEL).cast("string") if has(df, LABEL) else F.lit("")
    open_row = (rts == 0) & (dlv == 0)
    return (
        F.when(rts == 1, "ReturnedToSender")
        .when((rts == 0) & (dlv == 1) & (exc == 1), "DeliveredWithIssue")
        .when((rts == 0) & (dlv == 1) & (exc == 0), "Delivered")
        .when(open_row & (exc == 1), "Exception")
        .when(open_row & (exc == 0) & (stalled == 1), "Stalled")
        .when(open_row & (exc == 0) & (stalled == 0) & (pre == 1), "PreTransit")
        .otherwise(current)
    )


def apply_labels(df: DataFrame) -> DataFrame:
    missing = [f for f in REASON_OF_FLAG if f not in df.columns]
    out = df.withColumns({f: F.lit(0).cast("bigint") for f in missing}) if missing else df
    return out.withColumns({REASONS: calculated_reasons(out), LABEL: calculated_status(out)})


def _matches(df: DataFrame, codes: tuple[str, ...], hints: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for name in ("code", "derivedCode"):
        found = found | F.upper(text_or_blank(df, name)).isin(*codes)
    for name in ("statusByLocale", "description"):
        text = F.lower(text_or_blank(df, name))
        for hint in hints:
            found = found | F.contains(text, F.lit(hint))
    return found


def classify_pretransit(df: DataFrame) -> Column:
    return _matches(df, PRETRANSIT_CODES, PRETRANSIT_HINTS)


def classify_delivered(df: DataFrame) -> Column:
    return _matches(df, DELIVERED_CODES, DELIVERED_HINTS)


def classify_exception(df: DataFrame) -> Column:
    return _matches(df, EXCEPTION_CODES, EXCEPTION_HINTS)


def classify_status(df: DataFrame, status_col: str = LABEL) -> DataFrame:
    """Fill an empty label from codes and texts: delivered, then exception, then pre-transit."""
    need = (*STATUS_FIELDS, status_col)
    missing = [n for n in need if n not in df.columns]
    out = df.withColumns({n: F.lit("") for n in missing}) if missing else df
    now = text_or_blank(out, status_col)
    return out.withColumn(
        status_col,
        F.when(now != "", now)
        .when(classify_delivered(out), "Delivered")
        .when(classify_exception(out), "Exception")
        .when(classify_pretransit(out), "PreTransit")
        .otherwise(""),
    )
