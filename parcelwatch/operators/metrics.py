"""Idle time of a shipment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwatch.functions.times import aware_now, epoch_micros_sql, time_shape_sql, whole_days_before
from parcelwatch.schema import IDLE_DAYS, LATEST_TS, has


def days_since_latest_event(df: DataFrame, now: dt.datetime | None = None) -> Column:
    """Whole days since the latest event, rounded down; 0 when there is no readable time."""
    zero = F.lit(0).cast("bigint")
    if not has(df, LATEST_TS):
        return zero
    micros = F.expr(epoch_micros_sql(LATEST_TS, df.schema[LATEST_TS].dataType))
    return F.coalesce(whole_days_before(aware_now(now), micros), zero)


def with_idle_days(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    return df.withColumn(IDLE_DAYS, days_since_latest_event(df, now))


def unread_time_shapes(rows: DataFrame, column: str) -> DataFrame:
    """(shape, n): spellings in a text column that are read as no time, by shape. Blank and null texts are no spellings."""
    unread = rows.where(F.expr(f"trim(`{column}`) <> '' AND ({epoch_micros_sql(f'`{column}`')}) IS NULL"))
    return unread.groupBy(F.expr(time_shape_sql(f"`{column}`")).alias("shape")).agg(F.count(F.lit(1)).alias("n"))
