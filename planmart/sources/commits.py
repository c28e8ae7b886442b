"""Staged writes: rows go to a fresh folder, a small numbered commit file names the valid one.

A table (or one date of it) has a folder of commits, ``00000000.json``,
``00000001.json``, ... Each names its data folder and holds a manifest: rows,
files, bytes, schema and a free ``state``. A write first writes all rows to a
folder of its own and only then adds the next commit, by a rename that never
overwrites; a write that fails midway leaves no commit, so readers keep the
rows before it. Of two writers that race for a number one takes the next. The
data of the commit before stay until the following commit, for readers that
have begun; older ones are deleted. Readers list the commits, open the last
one and compare the manifest with what lies in the folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SUFFIX = ".json"
_LOCK = Lock()  # a local file system's rename may overwrite; threads of one driver take turns


class DamagedTable(RuntimeError):
    """The folder does not hold what its commit says."""


@dataclass(frozen=True)
class Commit:
    number: int
    folder: str
    rows: int
    files: int
    bytes: int
    schema: str
    state: str = ""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def _numbers(spark: SparkSession, commits: str) -> list[int]:
    fs = _fs(spark, commits)
    if not fs.exists(_path(spark, commits)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(_path(spark, commits))]
    return sorted(int(n.removesuffix(_SUFFIX)) for n in names if n.endswith(_SUFFIX) and not n.startswith("."))


def _read(spark: SparkSession, commits: str, number: int) -> Commit:
    stream = _fs(spark, commits).open(_path(spark, f"{commits}/{number:08d}{_SUFFIX}"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Commit(number=number, **json.loads(text))


def last_commit(spark: SparkSession, commits: str) -> Commit | None:
    """The valid commit, None when nothing was ever committed there."""
    numbers = _numbers(spark, commits)
    return _read(spark, commits, numbers[-1]) if numbers else None


def _contents(spark: SparkSession, folder: str) -> tuple[int, int]:
    """(data files, their bytes); (0, 0) without the folder."""
    fs = _fs(spark, folder)
    if not fs.exists(_path(spark, folder)):
        return 0, 0
    found = fs.listFiles(_path(spark, folder), True)
    files = size = 0
    while found.hasNext():
        f = found.next()
        if not f.getPath().getName().startswith(("_", ".")):
            files, size = files + 1, size + f.getLen()
    return files, size


def is_whole(spark: SparkSession, commit: Commit) -> bool:
    return _contents(spark, commit.folder) == (commit.files, commit.bytes)


def _add(spark: SparkSession, commits: str, body: dict) -> int:
    """Write ``body`` as the next commit; the number it got."""
    fs = _fs(spark, commits)
    fs.mkdirs(_path(spark, commits))
    staged = f"{commits}/.{uuid.uuid4().hex}"
    out = fs.create(_path(spark, staged), False)
    out.write(json.dumps(body).encode())
    out.close()
    while True:
        with _LOCK:
            number = (_numbers(spark, commits) or [-1])[-1] + 1
            target = _path(spark, f"{commits}/{number:08d}{_SUFFIX}")
            if not fs.exists(target) and fs.rename(_path(spark, staged), target):
                return number


def write_committed(df: DataFrame, folder: str, commits: str, observation: Observation | None = None,
                    state: str = "") -> Commit:
    """Write ``df`` to the fresh ``folder``, then commit it; an error leaves what was committed before."""
    spark = df.sparkSession
    rows = observation or Observation()
    try:
        df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("error").parquet(folder)
        files, size = _contents(spark, folder)
        body = Commit(0, folder, int(rows.get["rows"]), files, size, df.schema.json(), state)
        number = _add(spark, commits, {k: v for k, v in asdict(body).items() if k != "number"})
    except BaseException:
        delete(spark, folder)
        raise
    for old in _numbers(spark, commits):
        if old < number - 1:
            delete(spark, _read(spark, commits, old).folder)
            delete(spark, f"{commits}/{old:08d}{_SUFFIX}")
    return Commit(**(asdict(body) | {"number": number}))


def committed_folder(spark: SparkSession, commits: str) -> str | None:
    """The folder to read, checked against its manifest; None when nothing was committed."""
    commit = last_commit(spark, commits)
    if commit is None:
        return None
    if not is_whole(spark, commit):
        raise DamagedTable(f"{commit.folder} does not hold the {commit.files} files of {commit.bytes} bytes that were committed")
    return commit.folder
