"""Helpers shared by the operators: input, the shared work folder, partition counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import clear_work, work_folder

__all__ = ["bound_batches", "by_shuffle", "clear_work", "documents", "materialize", "row_key", "same_row", "shared_folder",
           "shuffle_partitions"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application that the driver and all executors share; ``clear_work`` deletes it."""
    return work_folder(spark, "llm")


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send Python workers at most ``rows`` texts at a time: texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def by_shuffle(df: DataFrame) -> DataFrame:
    """A side that grows with the corpus: joined by shuffle and sort at every size, never broadcast."""
    return df.hint("merge")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """(doc_id, text_hash): tells apart rows that share an id; null ids have keys too."""
    return [F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash")]


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])
