"""Sharding by fixed virtual slots.

Every record hashes into one of thousands of virtual slots and never leaves
it. Bytes and rows are summed per slot, and a small, versioned table maps
slots to shards. Rebalancing and growing add a version to that table only;
records move as whole slots. Versions lie side by side (``version=<n>``), and
readers take the last one that was written whole.

The slot table has ``n_slots`` rows (a parameter), so it can be broadcast and
folded in one expression whatever the size of the corpus. Only digests
(id, size, checksum, slot) are shuffled, never texts.

Defined cases: a null text has no bytes (size 1, checksum of no bytes); rows
with a null id hash by their checksum; repeated rows share a slot and get
different positions; an empty table gives no rows and an even map; further
columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, shared_folder

N_SLOTS = 4096
MAP_SCHEMA = "virtual_slot int, shard int, bytes long, rows long, moved boolean"


def with_slots(df: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest rows: doc_id, size (UTF-8 bytes + 1), text_crc32, virtual_slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    crc = F.crc32(F.encode(text, "UTF-8"))
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("crc:"), crc.cast("string")))
    return df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int").alias("virtual_slot"),
    )


def slot_totals(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """One row per virtual slot, empty ones too: virtual_slot, bytes, rows."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return (records.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
            .join(sums, "virtual_slot", "left").na.fill(0, ["bytes", "rows"]))


def _fold(slots: Column, n_shards: int, first: int) -> Column:
    """Edit the shard of each slot, largest first, in one pass over the slot array.

    Only shards from ``first`` on take slots. A slot without a shard goes to
    the least loaded of them. A slot that has one moves there if its shard is
    above the mean and stays the larger of the two.
    """
    start = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda k: F.aggregate(slots, F.lit(0).cast("long"),
                              lambda acc, s: acc + F.when(s["shard"] == k, s["bytes"]).otherwise(F.lit(0).cast("long"))))
    mean = F.aggregate(slots, F.lit(0).cast("long"), lambda acc, s: acc + s["bytes"]) / F.lit(n_shards)

    def step(acc, s):
        takers = F.slice(acc["loads"], first + 1, n_shards - first)
        least = (F.array_position(takers, F.array_min(takers)) - 1 + first).cast("int")
        own = F.coalesce(s["shard"], F.lit(-1))
        own_load = F.when(own >= 0, F.get(acc["loads"], own)).otherwise(F.lit(None).cast("long"))
        moves = (own < 0) | ((own_load > mean) & (F.array_min(takers) + s["bytes"] < own_load))
        to = F.when(moves, least).otherwise(own)
        loads = F.transform(acc["loads"], lambda x, i: x + F.when(moves & (i == to), s["bytes"])
                            .when(moves & (i == own), -s["bytes"]).otherwise(F.lit(0).cast("long")))
        return F.struct(loads.alias("loads"), F.concat(acc["shards"], F.array(to)).alias("shards"))

    begin = F.struct(start.alias("loads"), F.array().cast("array<int>").alias("shards"))
    return F.aggregate(slots, begin, step, lambda acc: acc["shards"])


def edit_map(totals: DataFrame, n_shards: int, current: DataFrame | None = None, version: int = 1) -> DataFrame:
    """The next version of the slot map: version, virtual_slot, shard, bytes, rows, moved.

    Without ``current`` every slot is placed anew. With it only as many slots
    move as bring shards above the mean down towards it; where shards are
    added, slots move into these only. Shards at or above ``n_shards`` are
    emptied.
    """
    first = 0
    if current is not None:
        used = current.agg(F.max("shard")).first()[0] + 1
        first = used if n_shards > used else 0
    if current is None:
        known = totals.withColumn("shard", F.lit(None).cast("int"))
    else:
        kept = F.when(F.col("shard") < n_shards, F.col("shard"))
        known = totals.join(current.select("virtual_slot", kept.alias("shard")), "virtual_slot", "left")
    # n_slots rows in one array: bounded by the parameter, not by the corpus.
    packed = known.agg(F.sort_array(F.collect_list(F.struct("bytes", "rows", "virtual_slot", "shard")), asc=False)
                       .alias("slots"))
    zipped = packed.select(F.explode(F.arrays_zip("slots", _fold(F.col("slots"), n_shards, first).alias("to"))).alias("z"))
    return zipped.select(
        F.lit(version).alias("version"), F.col("z.slots.virtual_slot").alias("virtual_slot"),
        F.col("z.to").alias("shard"), F.col("z.slots.bytes").alias("bytes"), F.col("z.slots.rows").alias("rows"),
        (F.col("z.slots.shard").isNull() | (F.col("z.slots.shard") != F.col("z.to"))).alias("moved"))


def assign(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Digest rows with their shard and position in it (``slot``, gapless from 0).

    Rows are numbered inside their virtual slot and offset by the rows of the
    lower slots of the shard, so no task sees a whole shard.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (records.withColumn("n", F.row_number().over(in_slot) - 1)
            .join(F.broadcast(offsets), "virtual_slot")  # n_slots rows
            .withColumn("slot", F.col("offset") + F.col("n")).drop("offset", "n"))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written whole, ascending."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = list(fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")) or [])
    return sorted(int(f.getPath().getParent().getName().removeprefix("version=")) for f in found)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The last version of the slot map stored at ``path``, or the one asked for."""
    versions = _versions(spark, path)
    wanted = versions[-1] if version is None and versions else version
    if wanted not in versions:
        raise LookupError(f"no version {wanted} of the slot map {path}")
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={wanted}").withColumn("version", F.lit(wanted))


def store_map(slot_map: DataFrame, path: str, version: int) -> DataFrame:
    """Store a version of the map beside the earlier ones; one that was written whole is never replaced."""
    spark = slot_map.sparkSession
    if version in _versions(spark, path):
        raise FileExistsError(f"version {version} of the slot map {path} exists")
    slot_map.drop("version").write.mode("overwrite").parquet(f"{path}/version={version}")  # what a failed write left goes
    return load_map(spark, path, version)


def shard(df: DataFrame, n_shards: int, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text",
          map_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with shard and slot, stored slot map of version 1), shards near equal in bytes.

    The map is kept at ``map_path``; without it in a work folder, until ``clear_work``.
    """
    records = materialize(with_slots(df, n_slots, id_col, text_col), "shard-records")
    path = map_path or f"{shared_folder(df.sparkSession)}/slot-map-{uuid.uuid4().hex[:12]}"
    slot_map = store_map(edit_map(slot_totals(records, n_slots), n_shards), path, 1)
    return assign(records, slot_map), slot_map


def rebalance(map_path: str, totals: DataFrame, n_shards: int) -> DataFrame:
    """Store and return the next version of the map at ``map_path`` for new totals or another number of shards."""
    spark = totals.sparkSession
    version = _versions(spark, map_path)[-1]
    return store_map(edit_map(totals, n_shards, load_map(spark, map_path, version), version + 1), map_path, version + 1)
