"""The join, the cells and the marts of one source folder, written once and read back.

Marts, reports, pages and panels all start from the same join of validated
plans and costs. A ``Store`` writes that join, the cells that each mart rolls up
from, and each mart as Parquet when first asked for, into the shared work folder of the running application, and
every reader scans them with its own columns and filters. A store is tied to
the names, sizes and modification times of its source files: changed sources
get a new one.

Each table is committed with a manifest (``sources/commits.py``): the state of
the sources, schema, rows, files and bytes, written last. A reader opens a
table only when its manifest fits the sources, the schema asked for and what
lies in the folder; a table that is missing, partial or of another state is
built again. So ``session.clear_work``, which removes all stores, costs the
next query a rebuild and nothing else.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import marts as M
from ..operators import quality as Q
from ..operators.enrich import enrich, join_plans_costs, with_network_share
from ..schemas import DM1_SCHEMA, DM1_TABLE, DM2_SCHEMA, DM2_TABLE, DM3_SCHEMA, DM3_TABLE
from ..session import work_folder
from ..sources import commits as C
from ..sources.fixtures import fixture_costs, fixture_plans

MART_SCHEMAS = {DM1_TABLE: DM1_SCHEMA, DM2_TABLE: DM2_SCHEMA, DM3_TABLE: DM3_SCHEMA}
SOURCES = ("orders", "lineitem")
_STORES: dict[tuple[str, str], "Store"] = {}
_LOCK = RLock()


def source_state(spark: SparkSession, sf_dir: str) -> str:
    """Digest of path, size and modification time of every source file."""
    seen = []
    for table in SOURCES:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{table}.parquet")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


class Store:
    """The stored tables of one state of one source folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, state: str):
        self.spark, self.sf_dir, self.state = spark, sf_dir, state
        self.root = work_folder(spark, f"store/{state[:16]}")
        self._unique: bool | None = None

    def manifest(self, name: str) -> C.Commit | None:
        """What is stored under ``name`` if it is of this state of the sources and whole."""
        commit = C.last_commit(self.spark, f"{self.root}/{name}/_commits")
        return commit if commit and commit.state == self.state and C.is_whole(self.spark, commit) else None

    def _stored(self, name: str, build: Callable[[], DataFrame], schema: T.StructType | None = None) -> DataFrame:
        with _LOCK:
            found = self.manifest(name)
            if found is None or (schema is not None and _names_and_types(found.schema) != _names_and_types(schema.json())):
                found = C.write_committed(build(), f"{self.root}/{name}/version={uuid.uuid4().hex}",
                                          f"{self.root}/{name}/_commits", state=self.state)
        return self.spark.read.schema(schema or T.StructType.fromJson(json.loads(found.schema))).parquet(found.folder)

    def joined(self) -> DataFrame:
        """Validated plans joined with validated costs."""
        return self._stored("joined", lambda: join_plans_costs(
            Q.clean_plans(fixture_plans(self.spark, self.sf_dir)), Q.clean_costs(fixture_costs(self.spark, self.sf_dir))))

    def silver(self) -> DataFrame:
        return enrich(self.joined())

    def unique_plan_ids(self) -> bool:
        """Checked once per store, on one column of the stored join: the sources are not read again."""
        if self._unique is None:
            self._unique = M.plan_ids_unique(self.joined())
        return self._unique

    def _mart_rows(self, table: str) -> DataFrame:
        """The rows a mart is built from; only mart 2 needs the network share (a scan of two columns)."""
        return with_network_share(self.joined()) if table == DM2_TABLE else self.joined()

    def cells(self, table: str) -> DataFrame:
        """Mergeable parts of one mart, from one scan of its columns of the join."""
        return self._stored(f"cells_{table}", lambda: M.mart_cells(self._mart_rows(table), table))

    def build_mart(self, table: str) -> DataFrame:
        """A mart rolled up from the stored cells; where plan ids repeat, from the columns of the join that it needs."""
        if self.unique_plan_ids():
            return M.roll_up(self.cells(table), table)
        build = {DM1_TABLE: M.dm1_affordability, DM2_TABLE: M.dm2_market, DM3_TABLE: M.dm3_competitiveness}[table]
        return build(self._mart_rows(table))

    def mart(self, table: str) -> DataFrame:
        """The stored mart."""
        return self._stored(table, lambda: self.build_mart(table).coalesce(1), MART_SCHEMAS[table])


def _names_and_types(schema: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromJson(json.loads(schema))]


def store(spark: SparkSession, sf_dir: str) -> Store:
    key = (spark.sparkContext.applicationId, source_state(spark, sf_dir))
    with _LOCK:
        if key not in _STORES:
            _STORES[key] = Store(spark, sf_dir, key[1])
        return _STORES[key]


def forget(spark: SparkSession) -> None:
    """Start afresh: the next query writes its store again (bench, tests)."""
    for key in [k for k in _STORES if k[0] == spark.sparkContext.applicationId]:
        C.delete(spark, _STORES.pop(key).root)
