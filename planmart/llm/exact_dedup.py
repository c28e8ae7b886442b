"""Exact dedup by content sort.

Rows are range-partitioned by sampled splitters over (leading bytes, hash) and
sorted inside each partition by the whole normalised text (Spark's external
sort), which places equal texts next to each other; a window then compares
neighbouring full texts. Splitters are short keys, so sampling stays small
however long the texts are; the leading bytes decide only where a row is
sorted, never whether two texts are equal.

Hot texts: a text with more rows than a quarter of a mean partition (and more
than ``HOT_ROWS``) is salted into runs of about that length; there are at most ``4 * partitions`` such
texts, so their table may be broadcast. Run results of hot texts are merged by
a map-side folding aggregate of digests.

Defined cases: null equals the empty text; of rows with equal text the
smallest (or largest) id stays, null ids last; of repeated rows with that id
one stays; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, shuffle_partitions

LEADING_CHARS = 24
HOT_ROWS = 256  # a text with no more rows than this is never hot, however small the table


def _hot_texts(keyed: DataFrame, partitions: int) -> DataFrame:
    """text_hash, runs: texts that would fill more than a quarter of a mean partition, and have over ``HOT_ROWS`` rows."""
    run = max(HOT_ROWS, keyed.count() // (4 * partitions))
    counts = keyed.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n"))
    # more than total/(4*partitions) rows each, hence not many more than 4*partitions hash values
    return counts.where(F.col("n") > run).select("text_hash", F.ceil(F.col("n") / run).alias("runs"))


def exact_dedup(df: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    n = shuffle_partitions(df)
    text = F.coalesce(normalise(F.col(text_col)) if normalise else F.col(text_col), F.lit(""))
    keyed = df.select(F.col(id_col).alias("doc_id"), text.alias("t"), F.xxhash64(text).alias("text_hash"))
    hot = _hot_texts(keyed, n)

    salted = keyed.join(F.broadcast(hot), "text_hash", "left").select(
        "doc_id", "t", "text_hash", F.substring("t", 1, LEADING_CHARS).alias("lead"),
        F.coalesce(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.col("runs")), F.lit(-1)).alias("salt"))
    ranged = salted.repartitionByRange(n, "lead", "text_hash", "salt")
    # clustered by a superset of the range keys: sorted in place, no further exchange
    run = Window.partitionBy("lead", "text_hash", "salt", "t")
    order = F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()
    best = F.min if keep == "smallest" else F.max
    runs = materialize(ranged.select(
        "doc_id", F.sha2(F.encode("t", "UTF-8"), 256).alias("text_sha256"), (F.col("salt") >= 0).alias("hot"),
        best("doc_id").over(run).alias("run_keep"), F.count(F.lit(1)).over(run).alias("run_size"),
        F.row_number().over(run.orderBy(order)).alias("rank")), "runs")

    merged = runs.where("hot").groupBy("text_sha256").agg(best("run_keep").alias("hot_keep"),
                                                          F.count(F.lit(1)).alias("hot_size"))
    out = runs.join(F.broadcast(merged), "text_sha256", "left")  # at most 4*partitions + 1 rows
    keep_id, size = F.when(F.col("hot"), F.col("hot_keep")).otherwise(F.col("run_keep")), F.coalesce("hot_size", "run_size")
    return out.select("doc_id", keep_id.alias("keep_id"), size.alias("group_size"),
                      ((F.col("rank") == 1) & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"), "text_sha256")
