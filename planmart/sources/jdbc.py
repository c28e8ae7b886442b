"""Relational sources and sinks over JDBC.

The source job reads each table as one task (no partitioning options). Here
a caller passes ``predicates``: one task per predicate, each a range of the
string key, so the table is read in parallel. ``key_range_predicates`` builds
ranges that together cover every row exactly once, NULL keys included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def key_range_predicates(column: str, boundaries: Sequence[str]) -> list[str]:
    """Non-overlapping WHERE clauses split at sorted ``boundaries``."""
    bounds = sorted(set(boundaries))
    quoted = [b.replace("'", "''") for b in bounds]
    if not quoted:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    preds = [f"{column} < '{quoted[0]}'"]
    preds += [f"{column} >= '{lo}' AND {column} < '{hi}'" for lo, hi in zip(quoted, quoted[1:])]
    preds.append(f"{column} >= '{quoted[-1]}'")
    preds.append(f"{column} IS NULL")
    return preds


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
              predicates: Sequence[str] | None = None, fetchsize: int = 10_000) -> DataFrame:
    """Read a table; with ``predicates`` each one becomes a parallel task."""
    props = {"fetchsize": str(fetchsize), **properties}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "overwrite",
               column_types: str | None = None, num_partitions: int | None = None,
               batchsize: int = 10_000) -> None:
    """Write a mart; ``overwrite`` replaces the table (one snapshot is kept)."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batchsize)
    for k, v in properties.items():
        writer = writer.option(k, v)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    writer.mode(mode).save()
