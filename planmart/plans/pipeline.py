"""The daily batch: bronze (landed sources) -> silver (validated, enriched) ->
gold (three marts), one callable per run date.

Every hand-off is a written, dated Parquet dataset in the lake folder, so each
step restarts from storage and a lost executor only re-runs the current step's
tasks. Inside silver two more are handed on and removed at the end: the
validated plans, whose write also counts the rule funnel, and the join, whose
write counts the cost rule and which enrichment reads three times with
different columns. Row counts come from
``observe`` on the writes themselves, not from extra ``count()`` jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import marts as M
from ..operators import quality as Q
from ..operators.enrich import enrich, join_plans_costs
from ..schemas import COSTS_SCHEMA, DM1_TABLE, DM2_TABLE, DM3_TABLE, PLAN_COLUMNS, PLANS_SCHEMA, SILVER_SCHEMA, without
from ..sources.catalog import register_snapshots
from ..sources.snapshots import drop_snapshot, read_snapshot, write_snapshot
from .store import MART_SCHEMAS

SILVER_TABLE = "plans_enriched"


def parse_run_date(value: str | None = None) -> str:
    """Strict ``YYYY-MM-DD``; today (UTC) when absent."""
    if value is None:
        return datetime.now(timezone.utc).strftime("%Y-%m-%d")
    return datetime.strptime(value, "%Y-%m-%d").strftime("%Y-%m-%d")


@dataclass
class RunResult:
    run_date: str
    rows: dict[str, int] = field(default_factory=dict)
    plan_funnel: list[dict] = field(default_factory=list)
    cost_funnel: list[dict] = field(default_factory=list)


def _rows(obs: Observation) -> int:
    return int(obs.get.get("rows", 0))


def ingest(plans_src: DataFrame, costs_src: DataFrame, lake: str, run_date: str) -> dict[str, int]:
    """Bronze: land both sources as the ``run_date`` snapshot."""
    out = {}
    for name, df, schema in (("plans", plans_src, PLANS_SCHEMA), ("costs", costs_src, COSTS_SCHEMA)):
        obs = Observation(f"bronze_{name}")
        conformed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        write_snapshot(conformed, f"{lake}/bronze", name, run_date, observation=obs)
        out[f"bronze_{name}"] = _rows(obs)
    return out


def process(spark: SparkSession, lake: str, run_date: str, catalog_db: str | None = None,
            result: RunResult | None = None) -> RunResult:
    """Silver: rules, funnel, join, enrichment; write the ``run_date`` leaf."""
    result = result or RunResult(run_date)
    plans = read_snapshot(spark, f"{lake}/bronze", "plans", PLANS_SCHEMA, run_date)
    costs = read_snapshot(spark, f"{lake}/bronze", "costs", COSTS_SCHEMA, run_date)
    work = f"{lake}/work"

    flagged, counted = Q.observed(Q.flag_plans(plans), Q.plan_funnel_counts(), "plan_funnel")
    kept = flagged.where(F.col("PlanID").isNotNull() & F.col("failed_rule").isNull()).select(*PLAN_COLUMNS)
    write_snapshot(kept, work, "clean_plans", run_date)
    result.plan_funnel = Q.funnel_of(counted.get, Q.PLAN_RULES)

    clean = read_snapshot(spark, work, "clean_plans", PLANS_SCHEMA, run_date)
    counted_costs, cost_counts = Q.observed(costs, Q.cost_funnel_counts(), "cost_funnel")
    joined = join_plans_costs(clean, Q.clean_costs(counted_costs))
    written = write_snapshot(joined, work, "joined", run_date)
    # Adaptive execution drops the join, counts included, when either side turns out empty: then the costs are counted on
    # their own.
    counts = cost_counts.get if written.rows else Q.counted(costs, Q.cost_funnel_counts())
    result.cost_funnel = Q.funnel_of(counts, [Q.COST_RULE])
    obs = Observation("silver")
    write_snapshot(enrich(read_snapshot(spark, work, "joined", joined.schema, run_date)), f"{lake}/silver", SILVER_TABLE,
                   run_date, observation=obs)
    result.rows["silver"] = _rows(obs)
    for table in ("clean_plans", "joined"):
        drop_snapshot(spark, work, table, run_date)

    if catalog_db:
        register_snapshots(spark, catalog_db, f"{lake}/silver", SILVER_TABLE, SILVER_SCHEMA, [run_date],
                           database_location=f"{lake}/catalog/{catalog_db}.db")
    return result


def read_silver(spark: SparkSession, lake: str, run_date: str) -> DataFrame:
    return read_snapshot(spark, f"{lake}/silver", SILVER_TABLE, SILVER_SCHEMA, run_date)


def build_gold(spark: SparkSession, lake: str, run_date: str, result: RunResult | None = None) -> RunResult:
    """Gold: three marts from the silver leaf (an error when it is missing), each written in one pass.

    Where no PlanID repeats (a scan of that column tells), each mart rolls up
    from its cells, which are written from its columns of silver and handed on
    like silver's own intermediates. Otherwise each mart counts distinct ids
    over silver itself.
    """
    result = result or RunResult(run_date)
    silver = read_silver(spark, lake, run_date)
    unique, work = M.plan_ids_unique(silver.select("PlanID")), f"{lake}/work"
    if unique:
        marts = {}
        for table in M.MART_KEYS:
            cells = M.mart_cells(silver, table)
            write_snapshot(cells, work, f"mart_cells_{table}", run_date)
            cells = read_snapshot(spark, work, f"mart_cells_{table}", cells.schema, run_date)
            marts[table] = M.roll_up(cells, table, run_date)
    else:
        builders = {DM1_TABLE: M.dm1_affordability, DM2_TABLE: M.dm2_market, DM3_TABLE: M.dm3_competitiveness}
        marts = {table: build(silver, snapshot_date=run_date) for table, build in builders.items()}
    for table, mart in marts.items():
        obs = Observation(table)
        write_snapshot(mart.drop("snapshot_date"), f"{lake}/gold", table, run_date, observation=obs)
        result.rows[table] = _rows(obs)
        if unique:
            drop_snapshot(spark, work, f"mart_cells_{table}", run_date)
    return result


def read_gold(spark: SparkSession, lake: str, table: str, run_date: str) -> DataFrame:
    """A mart of one run, with its ``snapshot_date`` tag as written (contract column order)."""
    schema = MART_SCHEMAS[table]
    df = read_snapshot(spark, f"{lake}/gold", table, without(schema, "snapshot_date"), run_date, keep_label=True)
    return df.select(*schema.fieldNames())


def run(spark: SparkSession, plans_src: DataFrame, costs_src: DataFrame, lake: str,
        run_date: str | None = None, catalog_db: str | None = None) -> RunResult:
    """Bronze -> silver -> gold for one run date."""
    d = parse_run_date(run_date)
    result = RunResult(d)
    result.rows.update(ingest(plans_src, costs_src, lake, d))
    process(spark, lake, d, catalog_db, result)
    build_gold(spark, lake, d, result)
    return result
