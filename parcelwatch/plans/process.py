"""The shipment status job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelwatch.functions.text import clean_tracking_number
from parcelwatch.functions.times import DATE_FORMATS, aware_now
from parcelwatch.operators.batches import batch_result_or_body, last_batch_payload, number_batches
from parcelwatch.operators.enrich import enrich
from parcelwatch.operators.filters import preprocess
from parcelwatch.operators.indicators import DEFAULT_STALLED_DAYS, apply_indicators
from parcelwatch.operators.labels import apply_labels
from parcelwatch.operators.lookup import Normalizer, payload_facts, replay_facts, replay_index, replay_lookup
from parcelwatch.operators.metrics import with_idle_days
from parcelwatch.operators.shaping import column_contract, publishable, reasons_not_null
from parcelwatch.schema import IDLE_DAYS, REASONS, TRACKING_NUMBER, col
from parcelwatch.sources.bodies import BODY_ORDER, src_bodies
from parcelwatch.sources.publication import commit_run, new_run
from parcelwatch.sources.shipments import src_shipments
from parcelwatch.sources.views import sink_sidecar, sink_views


@dataclass(frozen=True)
class Settings:
    """What a run can be told. ``reference_now`` must carry a time zone."""

    reference_date: dt.date | None = None
    date_filter: bool = True
    stalled_threshold_days: int = DEFAULT_STALLED_DAYS
    reference_now: dt.datetime | None = None
    date_formats: Sequence[str] = field(default=DATE_FORMATS)


def process_shipments(
    shipments: DataFrame,
    facts: DataFrame | None = None,
    settings: Settings = Settings(),
    *,
    observe: dict[str, Observation] | None = None,
) -> DataFrame:
    """Prepare, enrich and judge shipments: one lazy plan whose only join is the lookup.

    ``observe`` is filled with one row count per stage of preparation (see ``preprocess``).
    """
    now = aware_now(settings.reference_now)
    return (
        preprocess(
            shipments,
            settings.reference_date,
            date_filter=settings.date_filter,
            formats=settings.date_formats,
            observe=observe,
        )
        .transform(column_contract)
        .transform(enrich, facts)
        .transform(with_idle_days, now)
        .transform(apply_indicators, settings.stalled_threshold_days)
        .transform(apply_labels)
        .transform(reasons_not_null)
    )


def run_marker(
    spark: SparkSession,
    *,
    input_path: str,
    output_path: str,
    bodies_path: str | None,
    has_credentials: bool,
    timestamp: str,
    input_shape: tuple[int, int],
    output_shape: tuple[int, int],
) -> DataFrame:
    """The audit row of a run. ``bodies_path`` is where the run saved bodies, NULL if it saved none."""

    def split(path: str) -> tuple[str, str]:
        parent, _, name = path.rstrip("/").rpartition("/")
        return parent, name

    return spark.range(1).select(
        F.lit("ok").alias("run_marker"),
        F.lit(split(input_path)[1]).alias("input_name"),
        F.lit(split(input_path)[0]).alias("input_dir"),
        F.lit(split(output_path)[1]).alias("output_name"),
        F.lit(timestamp).alias("timestamp_utc"),
        F.lit(has_credentials).alias("env_has_creds"),
        F.lit(bodies_path).cast("string").alias("api_bodies_path"),
        *(
            F.lit(n).cast("bigint").alias(a)
            for n, a in zip(
                (*input_shape, *output_shape),
                ("input_rows", "input_cols", "output_rows", "output_cols"),
            )
        ),
    )


def shape_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row and column counts of both tables as one row."""

    def marks(df: DataFrame, is_input: bool) -> DataFrame:
        return df.select(F.lit(is_input).alias("is_input"))

    is_input = F.col("is_input")
    return (
        marks(before, True)
        .union(marks(after, False))
        .agg(
            F.count_if(is_input).alias("input_rows"),
            F.count_if(~is_input).alias("output_rows"),
        )
        .withColumns(
            {
                "input_cols": F.lit(len(before.columns)).cast("bigint"),
                "output_cols": F.lit(len(after.columns)).cast("bigint"),
            }
        )
    )


def process_and_publish(
    spark: SparkSession,
    input_path: str,
    out_dir: str,
    *,
    bodies_path: str | None = None,
    bodies_layout: str = "document",
    input_format: str | None = None,
    settings: Settings = Settings(),
    has_credentials: bool = False,
    sidecar_order: str | None = None,
    facts: DataFrame | None = None,
    normalizer: Normalizer | None = None,
    versioned: bool = False,
) -> dict[str, Any]:
    """Run the job and publish ``all_shipments``, ``processed``, the views and the ``marker``.

    Facts come from replayed bodies, their statuses read by ``normalizer`` if that is given, or are handed in
    as ``facts``, such as those of ``response_facts``, or of ``replayed_pairs_facts`` for a normalizer that looks at whole bodies. The summary has the rows after each
    stage of preparation. With ``sidecar_order``, the column that orders the input rows, the status of every
    (carrier, tracking number) is also published as ``sidecar``. The input is scanned for the raw copy and once more for the processed table; the
    views are cut from the written processed table. Row counts ride on the writes.

    Without ``versioned`` the tables lie in ``out_dir`` itself and are replaced one after another. With it each run has a
    folder of its own and becomes the version read (``read_published``) when all its tables are there.
    """
    root = out_dir.rstrip("/")
    out_dir = new_run(root) if versioned else root
    shipments = src_shipments(spark, input_path, input_format, must_exist=True)
    if bodies_path is not None:
        bodies = src_bodies(spark, bodies_path, bodies_layout)
        facts = replay_facts(bodies, BODY_ORDER, normalizer=normalizer)
    stamp = dt.datetime.now(dt.timezone.utc).isoformat()

    tables: list[str] = []

    def write(df: DataFrame, name: str) -> int:
        if not df.columns:
            # A table without columns has no file form; only its row count is kept, and no
            # earlier run's table stays in its place.
            old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{name}")
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
            return df.count()
        tables.append(name)
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
            f"{out_dir}/{name}"
        )
        return seen.get["rows"]

    rows_in = write(publishable(shipments), "all_shipments")
    stages: dict[str, Observation] = {}
    processed = process_shipments(shipments, facts, settings, observe=stages)
    rows_out = write(processed, "processed")
    written = spark.read.parquet(f"{out_dir}/processed")
    views = sink_views(written, out_dir)
    if sidecar_order is not None:
        sink_sidecar(written, sidecar_order, f"{out_dir}/sidecar")
    run_marker(
        spark,
        input_path=input_path,
        output_path=out_dir,
        bodies_path=None,  # replayed bodies are not saved again
        has_credentials=has_credentials,
        timestamp=stamp,
        input_shape=(rows_in, len(shipments.columns)),
        output_shape=(rows_out, len(processed.columns)),
    ).write.mode("overwrite").parquet(f"{out_dir}/marker")
    version = None
    if versioned:
        sides = ["sidecar"] if sidecar_order is not None else []
        version = commit_run(spark, root, out_dir, [*tables, *views, *sides, "marker"]).number
    return {
        "output_path": out_dir,
        "version": version,
        "views": views,
        "env_has_creds": has_credentials,
        "timestamp_utc": stamp,
        "output_cols": list(processed.columns),
        "output_shape": (rows_out, len(processed.columns)),
        "stage_rows": {"input": rows_in, **{name: seen.get["rows"] for name, seen in stages.items()}},
    }


def tn_snapshot(processed: DataFrame, numbers: DataFrame, order: str) -> DataFrame:
    """Idle days, reasons and stalled flag of the first row of each listed number.

    ``numbers`` has a column ``tracking_number``; a number without rows gives NULLs.
    """
    wanted = numbers.select("tracking_number", clean_tracking_number(F.col("tracking_number")).alias("_clean")).distinct()
    first = (
        only_listed(processed.withColumn("_clean", clean_tracking_number(col(TRACKING_NUMBER))), wanted)
        .groupBy("_clean")
        .agg(
            F.min_by(
                F.struct(
                    col(IDLE_DAYS).cast("double").alias("days"),
                    col(REASONS).alias("reasons"),
                    col("IsStalled").alias("stalled"),
                ),
                col(order),
            ).alias("s")
        )
    )
    return wanted.join(first, "_clean", "left").select("tracking_number", "s.*")


def only_listed(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose cleaned number ``_clean`` is listed."""
    return rows.join(wanted.select("_clean"), "_clean", "left_semi")


def snapshot_of(
    shipments: DataFrame, facts: DataFrame | None, numbers: DataFrame, order: str, settings: Settings = Settings()
) -> DataFrame:
    """``tn_snapshot`` of the job's result, for which only the listed shipments are enriched and judged."""
    wanted = numbers.select(clean_tracking_number(F.col("tracking_number")).alias("_clean")).distinct()
    listed = only_listed(shipments.withColumn("_clean", clean_tracking_number(col(TRACKING_NUMBER))), wanted)
    listed = listed.select(*(col(c) for c in shipments.columns))
    return tn_snapshot(process_shipments(listed, facts, settings), numbers, order)


def replayed_pairs_facts(bodies: DataFrame, order: Sequence[str], normalizer: Normalizer) -> DataFrame:
    """Facts of the last body of every number, with the status read by ``normalizer`` from whole bodies.

    Each number gets its body for that; ``replay_facts`` moves digests only.
    """
    numbers = replay_index(bodies, order).select(F.col("tracking_number").alias(TRACKING_NUMBER))
    pairs = replay_lookup(numbers, bodies, order).select(F.col(f"`{TRACKING_NUMBER}`").alias("tracking_number"), "body")
    return payload_facts(pairs, normalizer=normalizer)


def response_facts(
    shipments: DataFrame, responses: DataFrame, order: str, *, normalizer: Normalizer | None = None
) -> DataFrame:
    """Facts from the carrier's responses (``batch``, ``body``) to ``request_batches(shipments, order)``.

    A number that was requested in several batches has the facts of the last one.
    """
    requested = number_batches(shipments, order).select("batch", "tracking_number")
    pairs = last_batch_payload(batch_result_or_body(requested, responses))
    return payload_facts(pairs.select("tracking_number", F.col("payload").alias("body")), normalizer=normalizer)
