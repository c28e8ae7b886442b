"""Expose a dated Parquet dataset as an external catalog table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .snapshots import SNAPSHOT_COL, snapshot_folder, snapshot_path


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_snapshots(spark: SparkSession, database: str, root: str, table: str, schema: T.StructType,
                       dates: Sequence[str], database_location: str | None = None) -> str:
    """Create ``database.table`` over ``root/table`` if needed and add the partitions of ``dates``.

    ``schema`` holds the data columns; the label is a string. Partitions are
    added one by one: no listing of the whole dataset. Each points at the
    folder that is committed for its date, also after a rerun of the date.
    Unlike the source job, a failure here raises instead of being logged and
    ignored.
    """
    where = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}, {SNAPSHOT_COL} string) USING PARQUET "
              f"PARTITIONED BY ({SNAPSHOT_COL}) LOCATION '{snapshot_path(root, table)}'")
    for d in dates:
        folder = snapshot_folder(spark, root, table, d)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({SNAPSHOT_COL} = '{d}') LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({SNAPSHOT_COL} = '{d}') SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)  # a session that has read the table keeps a listing of it
    return f"{database}.{table}"


def read_table(spark: SparkSession, qualified_name: str) -> DataFrame:
    return spark.table(qualified_name)
