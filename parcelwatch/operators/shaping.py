"""Projections that fix the shape of a shipment table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwatch.functions.text import as_int, clean_tracking_number
from parcelwatch.schema import (
    CONTRACT_SUFFIX,
    FLAGS,
    REASONS,
    TRACKING_NUMBER,
    col,
    has,
)


def drop_first_column(df: DataFrame) -> DataFrame:
    """Drop column 0, also when it is the only one; rows stay."""
    return df.select(*(col(c) for c in df.columns[1:]))


def column_contract(df: DataFrame) -> DataFrame:
    """Add, type and order the fixed columns: originals first, then the missing ones.

    Text columns have no NULLs, flags are bigint. Applying it twice changes nothing.
    """
    fixed = {}
    for name in CONTRACT_SUFFIX:
        if name in FLAGS:
            fixed[name] = as_int(df, name)
        elif has(df, name):
            fixed[name] = F.coalesce(col(name).cast("string"), F.lit(""))
        else:
            fixed[name] = F.lit("")
    order = [*df.columns, *(n for n in CONTRACT_SUFFIX if n not in df.columns)]
    return df.select(*(fixed[n].alias(n) if n in fixed else col(n) for n in order))


def column_after(df: DataFrame, name: str, anchor: str, default: object = 0) -> DataFrame:
    """Move ``name`` right behind ``anchor``, adding it with ``default`` when missing."""
    out = df if has(df, name) else df.withColumn(name, F.lit(default))
    if not has(df, anchor):
        return out
    rest = [c for c in out.columns if c != name]
    at = rest.index(anchor) + 1
    return out.select(*(col(c) for c in [*rest[:at], name, *rest[at:]]))


def reasons_not_null(df: DataFrame) -> DataFrame:
    if not has(df, REASONS):
        return df
    return df.withColumn(REASONS, F.coalesce(col(REASONS).cast("string"), F.lit("")))


def publishable(df: DataFrame) -> DataFrame:
    """Final form of a published table: clean numbers, the two damage flags side by side."""
    out = df
    if has(df, TRACKING_NUMBER):
        out = out.withColumn(TRACKING_NUMBER, clean_tracking_number(col(TRACKING_NUMBER)))
    if has(df, "Damaged"):
        out = column_after(out, "UnableToDeliver", "Damaged")
    return out
