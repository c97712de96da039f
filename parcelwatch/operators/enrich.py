"""Writing carrier facts onto shipment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from parcelwatch.functions.text import as_int, carrier_name, key_text, text_or_blank
from parcelwatch.operators.lookup import _left_by_key
from parcelwatch.schema import (
    ANCILLARY,
    CARRIER_CODE,
    LATEST_DETAIL,
    LATEST_TS,
    SCAN_COUNT,
    SCAN_TIMES,
    STATUS_FIELDS,
    TRACKING_NUMBER,
    col,
    has,
)

# Fact columns that do not become status columns.
_FACTS = ("tracking_number", "readable", "latest_ts", "scan_count", "scan_times", "detail", "ancillary")


def enrich(rows: DataFrame, facts: DataFrame | None) -> DataFrame:
    """Left join facts by stripped tracking number and write them to the table.

    Status columns are overwritten also by blanks; the event time only when one was
    found. Rows with a blank number, or whose body could not be read, keep what they
    have. Without facts, or without the two key columns, the table is returned as is.

    ``facts`` has one row per tracking number (see ``replay_facts``, ``payload_facts``).
    """
    if facts is None or not has(rows, TRACKING_NUMBER, CARRIER_CODE):
        return rows
    status = [c for c in facts.columns if c not in _FACTS]
    side = facts.select(
        F.col("tracking_number").alias("_tn"),
        *(col(c).alias(f"_fact_{c}") for c in facts.columns if c != "tracking_number"),
    )
    joined = _left_by_key(rows.withColumn("_key", key_text(col(TRACKING_NUMBER))), side)

    # A miss counts as an empty body: blanks and zero scans are written.
    written = F.col("_key").isNotNull() & F.coalesce(F.col("_fact_readable"), F.lit(True))

    def fact(name: str) -> Column:
        return col(f"_fact_{name}")

    def kept(name: str) -> Column:
        return text_or_blank(rows, name)

    new: dict[str, Column] = {
        c: F.when(written, F.coalesce(fact(c).cast("string"), F.lit(""))).otherwise(kept(c))
        for c in status
    }
    old_detail = detail_text(rows)
    new[LATEST_DETAIL] = F.when(written, F.coalesce(fact("detail"), F.lit("{}"))).otherwise(old_detail)
    new[ANCILLARY] = F.when(written, F.coalesce(fact("ancillary"), F.lit(""))).otherwise(kept(ANCILLARY))
    new[LATEST_TS] = F.when(written & (fact("latest_ts") != ""), fact("latest_ts")).otherwise(kept(LATEST_TS))
    new[SCAN_COUNT] = F.when(written, F.coalesce(fact("scan_count"), F.lit(0))).otherwise(
        as_int(rows, SCAN_COUNT)
    ).cast("bigint")
    none = F.array().cast("array<string>")
    listed = has(rows, SCAN_TIMES) and isinstance(rows.schema[SCAN_TIMES].dataType, ArrayType)
    old_times = col(SCAN_TIMES).cast("array<string>") if listed else none
    new[SCAN_TIMES] = F.coalesce(F.when(written, fact("scan_times")).otherwise(old_times), none)
    order = [*rows.columns, *(n for n in new if n not in rows.columns)]
    return joined.select(*(new[n].alias(n) if n in new else col(n) for n in order))


def detail_text(rows: DataFrame) -> Column:
    """A detail column already in the table, as JSON text."""
    if not has(rows, LATEST_DETAIL):
        return F.lit(None).cast("string")
    kind = rows.schema[LATEST_DETAIL].dataType.simpleString()
    return col(LATEST_DETAIL) if kind == "string" else F.to_json(col(LATEST_DETAIL))


def normalized_record(scoped: DataFrame, status: Column, carrier_code: Column) -> Column:
    """Full audit record of one number: identity, status, neutral defaults, raw body.

    ``scoped`` comes from ``scope_to_number``, which keeps the body as ``raw``. Fields the carrier data is not read
    for are always blank.
    """
    code = F.coalesce(carrier_code.cast("string"), F.lit(""))
    # The record's always-blank fields.
    blanks = (
        "service_type",
        "service_desc",
        "origin_city",
        "origin_state",
        "dest_city",
        "dest_state",
        "received_by_name",
    )
    return F.struct(
        carrier_name(code).alias("carrier"),
        F.coalesce(F.col("tracking_number"), F.lit("")).alias("tracking_number"),
        code.alias("carrier_code"),
        *(status[f].alias(f) for f in STATUS_FIELDS),
        F.lit("").alias("actual_delivery_dt"),
        F.lit(False).alias("possession_status"),
        *(F.lit("").alias(b) for b in blanks),
        F.col("raw"),
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("timestamp").alias("captured_at"),
    )


def status_columns(record: Column) -> dict[str, Column]:
    """The four table columns of a record; an empty derived code falls back to the code."""
    out = {f: F.coalesce(record[f], F.lit("")) for f in STATUS_FIELDS}
    out["derivedCode"] = F.coalesce(F.nullif(record["derivedCode"], F.lit("")), out["code"])
    return out


def enriched_text_blanks(df: DataFrame, names: list[str]) -> DataFrame:
    """NULL -> '' in the named text columns, leaving detail and time list alone."""
    texts = [n for n in names if n in df.columns and n not in (LATEST_DETAIL, SCAN_TIMES)]
    return df.withColumns({n: text_or_blank(df, n) for n in texts}) if texts else df
