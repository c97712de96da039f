"""Published tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwatch.functions.text import is_blank, key_text
from parcelwatch.operators.filters import (
    view_all_issues,
    view_damaged_or_returned,
    view_pretransit,
    view_stalled,
)
from parcelwatch.operators.shaping import publishable
from parcelwatch.schema import CARRIER_CODE, LATEST_DETAIL, STATUS_FIELDS, TRACKING_NUMBER, col, has

VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "all_issues": view_all_issues,
    "pretransit": view_pretransit,
    "stalled": view_stalled,
    "damaged_or_returned": view_damaged_or_returned,
}


def sink_views(processed: DataFrame, out_dir: str) -> dict[str, str]:
    """Write one Parquet directory per view of a processed table; empty views keep all columns.

    Read ``processed`` back from where it was written before calling this: each
    view is then a scan of that table and the enrichment is not computed again.
    """
    paths = {}
    for name, view in VIEWS.items():
        paths[name] = f"{out_dir.rstrip('/')}/{name}"
        publishable(view(processed)).write.mode("overwrite").parquet(paths[name])
    return paths


def sidecar(enriched: DataFrame, order: str) -> DataFrame:
    """One JSON of the status columns per (carrier, tracking number), the last row winning.

    Rows that were looked up have a detail; a row without one had no facts, or a body that
    could not be read, and gets no entry.
    """
    looked_up = col(LATEST_DETAIL).isNotNull() if has(enriched, LATEST_DETAIL) else F.lit(False)
    keyed = enriched.filter(looked_up & ~is_blank(col(TRACKING_NUMBER))).select(
        F.coalesce(key_text(col(CARRIER_CODE)), F.lit("None")).alias("carrier"),
        key_text(col(TRACKING_NUMBER)).alias("tracking_number"),
        F.to_json(F.struct(*(col(f).alias(f) for f in STATUS_FIELDS))).alias("json"),
        col(order).alias("_order"),
    )
    return keyed.groupBy("carrier", "tracking_number").agg(F.max_by("json", "_order").alias("json"))


def sink_sidecar(enriched: DataFrame, order: str, path: str) -> None:
    """Write the sidecar as one dataset, not as a file per key."""
    sidecar(enriched, order).write.mode("overwrite").json(path)
