"""Row filters: input preparation and the published views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from parcelwatch.functions.text import as_int, let
from parcelwatch.functions.times import DATE_FORMATS, parse_date, prior_week_range
from parcelwatch.operators.shaping import drop_first_column
from parcelwatch.schema import DELIVERY_STATUS, PROMISED_DATE, col, has

STAGES = ("drop_first_column", "filter_prior_week", "filter_not_delivered")


def in_prior_week(
    df: DataFrame, ref: dt.date | None, formats: Sequence[str] = DATE_FORMATS
) -> Column:
    """Promised date inside the week before ``ref``; TRUE when there is no such column."""
    if not has(df, PROMISED_DATE):
        return F.lit(True)
    return F.coalesce(_promised_between(df, *prior_week_range(ref), formats), F.lit(False))


def _promised_between(df: DataFrame, first: dt.date, last: dt.date, formats: Sequence[str]) -> Column:
    kind = df.schema[PROMISED_DATE].dataType
    day = parse_date(col(PROMISED_DATE), kind, formats)
    if isinstance(kind, DateType):  # as it stands, it reaches the file scan
        return day.between(F.lit(first), F.lit(last))
    return let(day, lambda d: d.between(F.lit(first), F.lit(last)))


def not_delivered(df: DataFrame) -> Column:
    """Input status other than ``delivered`` in any case; TRUE when there is no such column."""
    if not has(df, DELIVERY_STATUS):
        return F.lit(True)
    return F.lower(F.coalesce(col(DELIVERY_STATUS).cast("string"), F.lit(""))) != "delivered"


def filter_prior_week(
    df: DataFrame,
    ref: dt.date | None = None,
    *,
    enabled: bool = True,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    if not enabled or not has(df, PROMISED_DATE):
        return df
    return df.filter(_promised_between(df, *prior_week_range(ref), formats))


def filter_not_delivered(df: DataFrame) -> DataFrame:
    return df.filter(not_delivered(df)) if has(df, DELIVERY_STATUS) else df


def preprocess(
    df: DataFrame,
    ref: dt.date | None = None,
    *,
    date_filter: bool = True,
    formats: Sequence[str] = DATE_FORMATS,
    observe: dict[str, Observation] | None = None,
) -> DataFrame:
    """Drop the lead column, keep last week's rows, keep what is not delivered.

    Pass ``observe={}`` to have it filled with one row-count ``Observation`` per
    stage, collected by the first action on the result at no extra pass.
    """

    def seen(frame: DataFrame, stage: str) -> DataFrame:
        if observe is None:
            return frame
        observe[stage] = Observation(stage)
        return frame.observe(observe[stage], F.count(F.lit(1)).alias("rows"))

    out = seen(drop_first_column(df), STAGES[0])
    out = seen(filter_prior_week(out, ref, enabled=date_filter, formats=formats), STAGES[1])
    return seen(filter_not_delivered(out), STAGES[2])


def stage_counts(
    df: DataFrame, ref: dt.date | None = None, *, date_filter: bool = True
) -> DataFrame:
    """Rows before and after each preparation stage, counted in one pass."""
    body = drop_first_column(df)
    week = in_prior_week(body, ref) if date_filter else F.lit(True)
    counts = body.agg(
        F.count(F.lit(1)).alias("a"),
        F.count_if(week).alias("w"),
        F.count_if(week & not_delivered(body)).alias("d"),
    )
    rows = F.array(
        *(
            F.struct(F.lit(s).alias("stage"), b.alias("before"), a.alias("after"))
            for s, b, a in zip(
                STAGES, (F.col("a"), F.col("a"), F.col("w")), (F.col("a"), F.col("w"), F.col("d"))
            )
        )
    )
    return counts.select(F.inline(rows)).withColumn("delta", F.col("after") - F.col("before"))


# ---- views --------------------------------------------------------------------


def _flagged(df: DataFrame, name: str) -> Column:
    return as_int(df, name) == 1


def view_pretransit(df: DataFrame) -> DataFrame:
    return df.filter(_flagged(df, "IsPreTransit"))


def view_stalled(df: DataFrame) -> DataFrame:
    return df.filter(_flagged(df, "IsStalled"))


def view_damaged_or_returned(df: DataFrame) -> DataFrame:
    return df.filter(_flagged(df, "Damaged") | _flagged(df, "IsRTS"))


def view_all_issues(df: DataFrame) -> DataFrame:
    """Everything not delivered; without that flag, rows with any problem flag."""
    if has(df, "IsDelivered"):
        return df.filter(as_int(df, "IsDelivered") != 1)
    return df.filter(
        _flagged(df, "HasException") | _flagged(df, "IsStalled") | _flagged(df, "IsRTS")
    )
