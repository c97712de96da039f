"""Shipment tables."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# How Spark names content that is not of the expected format.
_UNREADABLE = ("UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "Could not read footer", "is not a Parquet file", "Malformed ORC file")

_log = logging.getLogger(__name__)


def src_shipments(
    spark: SparkSession, path: str, fmt: str | None = None, *, must_exist: bool = False
) -> DataFrame:
    """Read a CSV, JSON, Parquet or ORC table; a path that is not there, or content of another
    format, is an empty table. Any other failure is raised.

    CSV columns are read as text, without inference, so tracking numbers keep
    their digits. The format defaults to the file extension, else Parquet. With
    ``must_exist`` a path that is not there is a ``FileNotFoundError``.
    """
    fmt = fmt or {"csv": "csv", "json": "json", "ndjson": "json", "orc": "orc"}.get(
        path.rstrip("/").rsplit(".", 1)[-1].lower(), "parquet"
    )
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    if fmt == "json":
        reader = reader.option("primitivesAsString", True)
    try:
        return reader.load(path)
    except (PySparkException, Py4JJavaError) as ex:
        condition = ex.getCondition() if isinstance(ex, PySparkException) else ""
        if must_exist and condition == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from ex
        if condition != "PATH_NOT_FOUND" and not any(sign in f"{condition} {ex}" for sign in _UNREADABLE):
            raise  # the storage failed, not the content
        _log.warning("could not read shipment table %s: %s", path, ex)
        return spark.createDataFrame([], T.StructType([]))
