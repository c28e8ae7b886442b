"""Sources and sinks: dated snapshots, catalog, CSV, JDBC predicates, pipeline."""

import os
import shutil
import uuid
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from planmart.operators import quality as Q
from planmart.plans import pipeline as PL
from planmart.plans.registry import QUERIES
from planmart.plans.store import Store, store
from planmart.schemas import PLANS_SCHEMA
from planmart.session import clear_work, ensure_checkpoint_dir, work_folder, work_path
from planmart.sources.csv import land_csv, read_csv_source, read_quarantine, write_csv_source
from planmart.sources.jdbc import key_range_predicates
from planmart.sources import commits as C
from planmart.sources.catalog import register_snapshots
from planmart.sources.snapshots import (MissingSnapshot, commits_path, drop_snapshot, read_mart, read_snapshot,
                                        snapshot_dates, snapshot_folder, write_snapshot)
from planmart.sources.fixtures import fixture_costs, fixture_plans
from tests.helpers import plan, plans_df


def test_two_dates_both_readable_and_rewrite_keeps_other(spark):
    root = work_path(spark, "t-snap")
    a = plans_df(spark, [plan("A")])
    b = plans_df(spark, [plan("B"), plan("C")])
    write_snapshot(a, root, "plans", "2024-01-01")
    write_snapshot(b, root, "plans", "2024-01-02")
    write_snapshot(b, root, "plans", "2024-01-01")  # rerun of the first date
    d1 = read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01")
    d2 = read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-02", keep_label=True)
    assert d1.count() == 2 and d2.count() == 2
    assert "snapshot_date" not in d1.columns
    assert dict(d2.dtypes)["snapshot_date"] == "string"


def test_empty_rerun_empties_its_date_only(spark):
    root = work_path(spark, "t-snap")
    a, none = plans_df(spark, [plan("A")]), plans_df(spark, [])
    for d in ("2024-01-01", "2024-01-02"):
        write_snapshot(a, root, "plans", d)
    obs = Observation("empty")
    write_snapshot(none, root, "plans", "2024-01-01", observation=obs)
    assert obs.get["rows"] == 0
    assert read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01").count() == 0
    assert [r.snapshot_date for r in read_snapshot(spark, root, "plans", PLANS_SCHEMA).collect()] == ["2024-01-02"]


def test_missing_date_fails(spark):
    root = work_path(spark, "t-snap")
    write_snapshot(plans_df(spark, [plan("A")]), root, "plans", "2024-01-01")
    with pytest.raises(MissingSnapshot):
        read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-02")
    with pytest.raises(MissingSnapshot):
        read_snapshot(spark, root, "costs", PLANS_SCHEMA)
    with pytest.raises(MissingSnapshot):
        PL.build_gold(spark, work_path(spark, "t-lake"), "2024-01-01")


def test_read_mart_hides_no_other_error(spark):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        read_mart(spark, work_path(spark, "x"), PLANS_SCHEMA, fmt="no_such_format")


def test_store_follows_its_sources(spark, sf_small, tmp_path):
    for t in ("orders", "lineitem"):
        shutil.copyfile(f"{sf_small}/{t}.parquet", tmp_path / f"{t}.parquet")
    first = store(spark, str(tmp_path))
    n = first.mart("datamart_affordability").agg({"num_plans": "sum"}).first()[0]
    assert store(spark, str(tmp_path)) is first
    pq.write_table(pq.read_table(f"{sf_small}/orders.parquet").slice(0, 700), tmp_path / "orders.parquet")
    second = store(spark, str(tmp_path))
    assert second is not first
    assert second.mart("datamart_affordability").agg({"num_plans": "sum"}).first()[0] < n


def test_marts_read_the_stored_join_without_more_joins(spark, sf_small):
    s = store(spark, sf_small)
    for table in ("datamart_affordability", "datamart_competitiveness"):
        plan = s.build_mart(table)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "ExistingRDD" not in plan
        assert "FamilyDeductible" in plan or table != "datamart_affordability"
        assert "PlanName" not in plan


def test_shared_folder_must_be_named_on_a_cluster():
    conf, context = SimpleNamespace(get=lambda k, d: d), SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))
    context.getCheckpointDir, context.applicationId = lambda: "hdfs://x/y", "a"
    assert ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context)) == "hdfs://x/y"


def test_csv_keeps_blank_values(spark):
    path = work_path(spark, "t-csv")
    src = plans_df(spark, [plan("A", issuer="  "), plan(None), plan("B", issuer='Quote "Co", Inc')])
    write_csv_source(src, path)
    back = read_csv_source(spark, path, PLANS_SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, src.collect()), key=str)


def test_read_mart_missing_gives_empty_only_where_asked(spark):
    assert read_mart(spark, work_path(spark, "missing"), PLANS_SCHEMA, missing_ok=True).count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_mart(spark, work_path(spark, "missing"), PLANS_SCHEMA)


def test_jdbc_predicates_partition_keys():
    preds = key_range_predicates("PlanID", ["PL00000500", "PL00001000"])
    assert preds == ["PlanID < 'PL00000500'", "PlanID >= 'PL00000500' AND PlanID < 'PL00001000'",
                     "PlanID >= 'PL00001000'", "PlanID IS NULL"]


def test_pipeline_end_to_end(spark, sf_small):
    lake = work_path(spark, "t-lake")
    res = PL.run(spark, fixture_plans(spark, sf_small), fixture_costs(spark, sf_small), lake, "2024-02-01",
                 catalog_db="planmart_test")
    assert res.rows["bronze_plans"] == 1500 and res.rows["bronze_costs"] == 1473
    assert res.rows["silver"] == 1149
    assert (res.rows["datamart_affordability"], res.rows["datamart_market_structure"],
            res.rows["datamart_competitiveness"]) == (224, 473, 897)
    assert {r["rule_no"]: r["rejected"] for r in res.plan_funnel}[7] == 223
    assert spark.table("planmart_test.plans_enriched").where("snapshot_date = '2024-02-01'").count() == 1149
    assert PL.read_gold(spark, lake, "datamart_affordability", "2024-02-01").count() == 224
    again = PL.run(spark, fixture_plans(spark, sf_small), fixture_costs(spark, sf_small).limit(0), lake, "2024-02-01",
                   catalog_db="planmart_test")  # a rerun that finds no costs
    assert again.rows["silver"] == again.rows["datamart_affordability"] == 0
    assert PL.read_gold(spark, lake, "datamart_affordability", "2024-02-01").count() == 0


def test_run_date_is_strict():
    assert PL.parse_run_date("2024-01-05") == "2024-01-05"
    with pytest.raises(ValueError):
        PL.parse_run_date("2024/01/05")


def _ids(df):
    return sorted(r.PlanID for r in df.collect())


def _failing(df):
    return df.withColumn("PlanName", F.raise_error(F.lit("planted failure")))


def test_failed_rerun_keeps_the_rows_before(spark):
    root = work_path(spark, "t-snap")
    write_snapshot(plans_df(spark, [plan("A"), plan("B")]), root, "plans", "2024-01-01")
    before = snapshot_folder(spark, root, "plans", "2024-01-01")
    with pytest.raises(Exception, match="planted failure"):
        write_snapshot(_failing(plans_df(spark, [plan("C")])), root, "plans", "2024-01-01")
    assert snapshot_folder(spark, root, "plans", "2024-01-01") == before
    assert _ids(read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01")) == ["A", "B"]
    with pytest.raises(Exception, match="planted failure"):
        write_snapshot(_failing(plans_df(spark, [plan("C")])), root, "plans", "2024-01-02")
    assert snapshot_dates(spark, root, "plans") == ["2024-01-01"]  # a first run that fails leaves no date


def test_a_reader_that_has_begun_sees_its_rows_after_a_rerun(spark):
    root = work_path(spark, "t-snap")
    write_snapshot(plans_df(spark, [plan("A")]), root, "plans", "2024-01-01")
    begun = read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01")
    commit = write_snapshot(plans_df(spark, [plan("B"), plan("C")]), root, "plans", "2024-01-01")
    assert _ids(begun) == ["A"] and _ids(read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01")) == ["B", "C"]
    assert (commit.number, commit.rows) == (1, 2)
    write_snapshot(plans_df(spark, [plan("D")]), root, "plans", "2024-01-01")
    commits = commits_path(root, "plans", "2024-01-01")
    assert C._numbers(spark, commits) == [1, 2]  # the one before stays, older ones go
    assert C.last_commit(spark, commits).rows == 1


def test_two_writers_take_two_numbers(spark):
    commits = work_path(spark, "t-commits")
    body = {"folder": "x", "rows": 0, "files": 0, "bytes": 0, "schema": "", "state": ""}
    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(lambda _: C._add(spark, commits, body), range(8))) == list(range(8))


def test_a_snapshot_that_lost_a_file_is_an_error(spark):
    root = work_path(spark, "t-snap")
    write_snapshot(plans_df(spark, [plan("A"), plan("B")]).repartition(2), root, "plans", "2024-01-01")
    folder = snapshot_folder(spark, root, "plans", "2024-01-01")
    C.delete(spark, f"{folder}/{next(n for n in os.listdir(folder) if n.startswith('part'))}")
    with pytest.raises(C.DamagedTable):
        read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01")
    drop_snapshot(spark, root, "plans", "2024-01-01")
    with pytest.raises(MissingSnapshot):
        read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01")


def test_catalog_partition_follows_a_rerun(spark):
    root, db = work_path(spark, "t-snap"), f"planmart_{uuid.uuid4().hex[:8]}"
    for ids in (["A"], ["B", "C"]):
        write_snapshot(plans_df(spark, [plan(i) for i in ids]), root, "plans", "2024-01-01")
        name = register_snapshots(spark, db, root, "plans", PLANS_SCHEMA, ["2024-01-01"], database_location=f"{root}/{db}.db")
        assert _ids(spark.table(name).where("snapshot_date = '2024-01-01'")) == ids


def test_store_is_rebuilt_after_clear_work(spark, sf_small):
    report = lambda: sorted(map(tuple, QUERIES["q01_metal_profile"](spark, sf_small).collect()))
    volumes = lambda: sorted(map(tuple, QUERIES["mart_volumes"](spark, sf_small).collect()))
    first = report(), volumes()
    assert len(first[0]) == 5
    clear_work(spark)
    assert not os.path.exists(work_folder(spark).removeprefix("file://"))
    assert (report(), volumes()) == first
    assert QUERIES["silver_enriched"](spark, sf_small).count() == 1149


def test_store_rebuilds_a_partial_or_foreign_table_only(spark, sf_small):
    s = store(spark, sf_small)
    rows = s.mart("datamart_affordability").count()
    whole = s.manifest("datamart_affordability")
    assert (whole.rows, whole.state) == (rows, s.state)
    s.mart("datamart_affordability")
    assert s.manifest("datamart_affordability") == whole  # not built again
    C.delete(spark, f"{whole.folder}/{next(n for n in os.listdir(whole.folder) if n.startswith('part'))}")
    assert s.manifest("datamart_affordability") is None
    assert s.mart("datamart_affordability").count() == rows
    again = s.manifest("datamart_affordability")
    assert again.number == whole.number + 1
    other = Store(spark, sf_small, s.state)
    other.state = "other sources"
    assert other.manifest("datamart_affordability") is None


def test_csv_quarantine_sets_malformed_lines_apart(spark, tmp_path):
    good = "A,I,ISS,N,T,HMO,Gold,CA,C,M,1,2023"
    bad = ["B,too,short", "C,I,ISS,N,T,HMO,Gold,CA,C,M,yes,2023", good + ",more", "D,I,ISS,N,T,HMO,Gold,CA,C,M,1,99999999999"]
    header = ",".join(PLANS_SCHEMA.fieldNames())
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([header, good, bad[0], bad[1]]) + "\n")
    (tmp_path / "in" / "b.csv").write_text("\n".join([header, bad[2], bad[3], '"E, x","  ",,,,,,,,,,']) + "\n")
    root = work_path(spark, "t-landed")
    assert land_csv(spark, str(tmp_path / "in"), PLANS_SCHEMA, root, "plans", "2024-01-01") == (2, 4)
    rows = read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01").collect()
    assert sorted((r.PlanID, r.IssuerName) for r in rows) == [("A", "I"), ("E, x", "  ")]
    apart = read_quarantine(spark, root, "plans", "2024-01-01").collect()
    assert sorted(r.line for r in apart) == sorted(bad)
    assert {r.file.rsplit("/", 1)[1] for r in apart} == {"a.csv", "b.csv"}
    assert land_csv(spark, str(tmp_path / "in" / "a.csv"), PLANS_SCHEMA, root, "plans", "2024-01-02", max_share=0.7) == (1, 2)
    with pytest.raises(ValueError, match="2 of 3 lines"):
        land_csv(spark, str(tmp_path / "in" / "a.csv"), PLANS_SCHEMA, root, "plans", "2024-01-01", max_share=0.5)
    assert read_snapshot(spark, root, "plans", PLANS_SCHEMA, "2024-01-01").count() == 2  # the rows before stay


def test_cost_funnel_is_counted_also_when_no_plan_is_left(spark, sf_small):
    plans, costs = fixture_plans(spark, sf_small), fixture_costs(spark, sf_small)
    want = sorted(map(tuple, Q.cost_funnel(costs).collect()))
    for src in (plans, plans.limit(0)):
        run = PL.run(spark, src, costs, work_path(spark, "t-lake"), "2024-02-01")
        assert [tuple(r.values()) for r in run.cost_funnel] == want
