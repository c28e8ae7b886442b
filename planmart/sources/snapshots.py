"""Dated Parquet snapshots (bronze, silver, gold) and whole-mart reads.

A table keeps each write in a folder of its own,
``<root>/<table>/version=<id>/snapshot_date=<d>``, and for each date the
commits that name the valid one (``commits.py``), under ``_commits``. A write
replaces its own date, also by an empty result, and leaves every other date
alone; one that fails leaves its date as it was. A reader sees the rows before
or after a write, never a part. A read of one date opens that folder only and
fails when the date was never written, or when files of it are gone; labels
stay strings instead of being inferred as dates.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import with_snapshot
from . import commits as C

SNAPSHOT_COL = "snapshot_date"


class MissingSnapshot(LookupError):
    """Nothing was ever written for that date."""


def snapshot_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def commits_path(root: str, table: str, snapshot_date: str) -> str:
    return f"{snapshot_path(root, table)}/_commits/{SNAPSHOT_COL}={snapshot_date}"


def snapshot_folder(spark: SparkSession, root: str, table: str, snapshot_date: str) -> str:
    """The folder with the valid rows of one date."""
    folder = C.committed_folder(spark, commits_path(root, table, snapshot_date))
    if folder is None:
        raise MissingSnapshot(f"no snapshot {snapshot_date} of {snapshot_path(root, table)}")
    return folder


def snapshot_dates(spark: SparkSession, root: str, table: str) -> list[str]:
    """Dates that have a snapshot, ascending."""
    path = C._path(spark, f"{snapshot_path(root, table)}/_commits")
    fs = C._fs(spark, snapshot_path(root, table))
    found = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    dates = sorted(n.removeprefix(f"{SNAPSHOT_COL}=") for n in found if n.startswith(f"{SNAPSHOT_COL}="))
    return [d for d in dates if C.last_commit(spark, commits_path(root, table, d))]


def write_snapshot(df: DataFrame, root: str, table: str, snapshot_date: str,
                   observation: Observation | None = None) -> C.Commit:
    """Write ``df`` as the ``snapshot_date`` snapshot of ``root/table``.

    The written row count (S10) is gathered in the same pass as the write
    instead of by a second ``count()`` job; it is in the commit, and in
    ``observation`` if one is given.
    """
    folder = f"{snapshot_path(root, table)}/version={uuid.uuid4().hex}/{SNAPSHOT_COL}={snapshot_date}"
    return C.write_committed(df, folder, commits_path(root, table, snapshot_date), observation)


def read_snapshot(spark: SparkSession, root: str, table: str, schema: T.StructType,
                  snapshot_date: str | None = None, keep_label: bool = False) -> DataFrame:
    """Rows of one snapshot (an error when that date was never written), or of all with their labels."""
    if snapshot_date is None:
        folders = [snapshot_folder(spark, root, table, d) for d in snapshot_dates(spark, root, table)]
        if not folders:
            raise MissingSnapshot(f"no snapshot of {snapshot_path(root, table)}")
        rows = spark.read.schema(with_snapshot(schema)).option("basePath", snapshot_path(root, table)).parquet(*folders)
        return rows.select(*with_snapshot(schema).fieldNames())
    df = spark.read.schema(schema).parquet(snapshot_folder(spark, root, table, snapshot_date))
    return df.withColumn(SNAPSHOT_COL, F.lit(snapshot_date)) if keep_label else df


def drop_snapshot(spark: SparkSession, root: str, table: str, snapshot_date: str) -> None:
    """Delete one date; what it held is not found any more."""
    commits = commits_path(root, table, snapshot_date)
    folders = [C._read(spark, commits, n).folder for n in C._numbers(spark, commits)]
    for path in (commits, *folders):
        C.delete(spark, path)


def read_mart(spark: SparkSession, path: str, schema: T.StructType | None = None,
              fmt: str = "parquet", missing_ok: bool = False) -> DataFrame:
    """Whole-mart read; with ``missing_ok`` an empty frame (with ``schema``) when its path does not exist."""
    try:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    except AnalysisException as e:
        if not missing_ok or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema or T.StructType([]))
