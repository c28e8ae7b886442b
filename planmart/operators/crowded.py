"""Rows of keys that hold very many, set apart from the rest.

What is folded by key either folds map-side first, which sorts or holds a
task's whole share of the input and spills once that outgrows its memory, or
is dealt by key first, which brings all rows of a key into one task. ``split``
tells where each belongs: the few crowded keys fold map-side, all others are
dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096  # of keys by hash
HOT_ROWS = 1_000_000  # more rows of a bucket don't meet in one task unfolded


def split(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows to deal by ``key``, rows of crowded buckets): a bucket is crowded with more than ``hot_rows`` rows and more
    than four times the mean. All rows of a key, null too, are on one side.

    Buckets are counted by a scan of the key; their table is at most ``BUCKETS`` rows, so it is broadcast. Without
    crowded buckets adaptive execution drops the second side.
    """
    marked = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)))
    counts = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    crowded = F.broadcast(
        counts.where((F.col("_n") > hot_rows) & (F.col("_n") > F.col("_all") * 4 / BUCKETS)).select("_bucket"))
    return tuple(marked.join(crowded, "_bucket", how).drop("_bucket") for how in ("left_anti", "left_semi"))
