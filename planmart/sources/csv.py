"""S3: headered, quoted CSV as a landing source, always with an explicit schema.

``read_csv_source`` fails on the first malformed row. ``land_csv`` lands what
is well formed and sets the rest apart: a line is malformed when it has
another number of fields than the schema, or a field that its type can't
take. Good rows become a dated snapshot of the table, malformed lines, whole
and with the file they stand in, one of ``<table>_quarantine``; both are
committed (``snapshots.py``) and counted while they are written.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .snapshots import drop_snapshot, read_snapshot, write_snapshot

# Values keep their spaces (a blank issuer name must stay blank to be rejected).
_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_LINE = "_malformed_line"
QUARANTINE_SCHEMA = T.StructType([T.StructField("line", T.StringType()), T.StructField("file", T.StringType())])


class Landed(NamedTuple):
    rows: int
    quarantined: int


def read_csv_source(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Read CSV files; malformed rows fail the load (``mode``) instead of turning into NULLs."""
    return spark.read.schema(schema).options(**_CSV_OPTIONS).option("mode", mode).csv(path)


def write_csv_source(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)


def quarantine_table(table: str) -> str:
    return f"{table}_quarantine"


def land_csv(spark: SparkSession, path: str, schema: T.StructType, root: str, table: str, snapshot_date: str,
             header: bool = True, max_share: float = 1.0) -> Landed:
    """Land CSV files as the ``snapshot_date`` snapshot of ``root/table``; malformed lines go to its quarantine.

    The files are parsed once, into a staged table that both writes read. With
    more malformed lines than ``max_share`` of all nothing is landed.
    """
    parsed = spark.read.schema(T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())])) \
        .options(**(_CSV_OPTIONS | {"header": str(header).lower()})) \
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE).csv(path)
    parsed = parsed.withColumn("_file", F.when(F.col(_LINE).isNotNull(), F.col("_metadata.file_path")))
    staged = f"{table}_staged"
    write_snapshot(parsed, root, staged, snapshot_date)
    try:
        rows = read_snapshot(spark, root, staged, parsed.schema, snapshot_date)
        bad = rows.where(F.col(_LINE).isNotNull()).select(F.col(_LINE).alias("line"), F.col("_file").alias("file"))
        quarantined = write_snapshot(bad, root, quarantine_table(table), snapshot_date).rows
        total = rows.count()
        if quarantined > max_share * total:
            raise ValueError(f"{quarantined} of {total} lines of {path} are malformed; none was landed")
        good = rows.where(F.col(_LINE).isNull()).select(*schema.fieldNames())
        return Landed(write_snapshot(good, root, table, snapshot_date).rows, quarantined)
    finally:
        drop_snapshot(spark, root, staged, snapshot_date)


def read_quarantine(spark: SparkSession, root: str, table: str, snapshot_date: str) -> DataFrame:
    """line, file of the malformed lines of one landing."""
    return read_snapshot(spark, root, quarantine_table(table), QUARANTINE_SCHEMA, snapshot_date)
