"""Published versions: each run writes a folder of its own, and a manifest that is committed last makes it the version read.

Tables of one version are of one run. A run that fails leaves a folder that no manifest names, so readers keep the
version before it; readers that have a version open are not disturbed by the next one.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

RUNS, MANIFESTS = "runs", "manifests"
_DIGITS = 12


@dataclass(frozen=True)
class Version:
    """A committed run: its number, its folder and the tables in it."""

    number: int
    folder: str
    tables: tuple[str, ...]


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_run(out_dir: str) -> str:
    """The folder of a new run; nothing reads it before it is committed."""
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    return f"{out_dir.rstrip('/')}/{RUNS}/{stamp}-{uuid.uuid4().hex[:12]}"


def version_numbers(spark: SparkSession, out_dir: str) -> list[int]:
    """Numbers of the committed versions, ascending."""
    folder, fs = _at(spark, f"{out_dir.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:_DIGITS]) for n in names if n.endswith(".json") and n[:_DIGITS].isdecimal())


def commit_run(spark: SparkSession, out_dir: str, folder: str, tables: Sequence[str]) -> Version:
    """Make a run the newest version.

    The manifest is written beside its place and renamed into it, so it is there whole or not at all. A number that
    another run took meanwhile is left to it, and the next one is tried.
    """
    out_dir = out_dir.rstrip("/")
    manifests, fs = _at(spark, f"{out_dir}/{MANIFESTS}")
    fs.mkdirs(manifests)
    run = folder.rstrip("/").rpartition("/")[2]
    draft, _ = _at(spark, f"{out_dir}/{MANIFESTS}/_{run}")
    out = fs.create(draft, True)
    out.write(json.dumps({"run": run, "tables": list(tables)}).encode())
    out.close()
    number = max(version_numbers(spark, out_dir), default=0)
    while True:
        number += 1
        final, _ = _at(spark, f"{out_dir}/{MANIFESTS}/{number:0{_DIGITS}}.json")
        if not fs.exists(final) and fs.rename(draft, final):
            return Version(number, folder, tuple(tables))
        if not fs.exists(final):
            raise OSError(f"{final.toString()} could not be committed")


def published_version(spark: SparkSession, out_dir: str, number: int | None = None) -> Version:
    """The newest version, or the one of that number. Without any, FileNotFoundError."""
    out_dir = out_dir.rstrip("/")
    known = version_numbers(spark, out_dir)
    number = number if number is not None else max(known, default=None)
    if number not in known:
        raise FileNotFoundError(f"{out_dir}: no version" if number is None else f"{out_dir}: no version {number}")
    path = f"{out_dir}/{MANIFESTS}/{number:0{_DIGITS}}.json"
    manifest = json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    return Version(number, f"{out_dir}/{RUNS}/{manifest['run']}", tuple(manifest["tables"]))


def read_published(spark: SparkSession, out_dir: str, table: str, number: int | None = None) -> DataFrame:
    """A Parquet table of the newest version, or of the one of that number.

    To read several tables of one run, take its number from ``published_version`` first.
    """
    version = published_version(spark, out_dir, number)
    if table not in version.tables:
        raise FileNotFoundError(f"version {version.number} has no table {table}")
    return spark.read.parquet(f"{version.folder}/{table}")


def drop_versions(spark: SparkSession, out_dir: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` versions, the manifest of each before its folder; returns their numbers."""
    if keep < 1:
        raise ValueError("at least one version must stay")
    gone = version_numbers(spark, out_dir)[:-keep]
    for number in gone:
        folder = published_version(spark, out_dir, number).folder
        for path in (f"{out_dir.rstrip('/')}/{MANIFESTS}/{number:0{_DIGITS}}.json", folder):
            p, fs = _at(spark, path)
            fs.delete(p, True)
    return gone
