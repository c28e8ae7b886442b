"""A join of many rows with a table of unique keys that stays even when one key holds a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_shuffle, shuffle_partitions


def join_even(rows: DataFrame, table: DataFrame, key: str, count_col: str, spread: list[str]) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row per key, not null; ``count_col``: how many ``rows`` have it).

    Keys above a quarter of a mean partition, at most four a partition, are
    joined by broadcast; their rows then pass the shuffle join under a key made
    of ``spread`` that no table row has. ``table`` is read twice: store it.
    """
    n = shuffle_partitions(rows)
    total = table.agg(F.sum(count_col)).first()[0] or 0
    limit = max(64, total // (4 * n))
    values = [c for c in table.columns if c != key]
    packed = table.select(F.col(key).alias("_even_key"), F.struct(*values).alias("_even_values"))
    hot = packed.where(F.col(f"_even_values.{count_col}") > limit)  # not more than 4 * n rows
    cold = packed.where(F.col(f"_even_values.{count_col}") <= limit)
    marked = rows.join(F.broadcast(hot.withColumnRenamed("_even_values", "_even_hot")),
                       F.col(key) == F.col("_even_key"), "left").drop("_even_key")
    own = F.concat(F.lit("\u0000"), F.xxhash64(*spread).cast("string"))
    marked = marked.withColumn("_even_by", F.when(F.col("_even_hot").isNull(), F.col(key).cast("string")).otherwise(own))
    joined = marked.join(by_shuffle(cold.withColumn("_even_key", F.col("_even_key").cast("string"))),
                         F.col("_even_by") == F.col("_even_key"), "left")
    value = F.coalesce("_even_hot", "_even_values")
    return joined.select(*rows.columns, *[value[c].alias(c) for c in values])
