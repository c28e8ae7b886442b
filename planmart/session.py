"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster the session is created by the launcher; library code only reads
its settings. The only setting we ever write is ``spark.checkpoint.dir`` and
only when the session has none (local tests), as lineage is cut by reliable
``checkpoint()`` or by written tables in that shared folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans built here; all are standard Spark knobs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE may turn a shuffle join into a broadcast only after measuring the
    # materialised side, so this threshold is applied to a checked size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "planmart") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is what the session names in ``spark.checkpoint.dir`` or what was set
    by ``sc.setCheckpointDir``. Only a local master may have neither (tests):
    then a temporary folder is chosen.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _LOCAL_ROOTS.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="planmart-ckpt-")
        _LOCAL_ROOTS[sc.applicationId] = root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_folder(spark: SparkSession, name: str = "") -> str:
    """A location under the shared folder, the same for each call of one application."""
    return f"{ensure_checkpoint_dir(spark)}/planmart-work/{spark.sparkContext.applicationId}/{name}".rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder for a written table."""
    return work_folder(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_work(spark: SparkSession) -> None:
    """Delete what this application wrote under the shared folder."""
    delete_path(spark, work_folder(spark))


__all__ = ["DEFAULT_CONF", "local_session", "ensure_checkpoint_dir", "work_folder", "work_path", "clear_work", "delete_path"]
