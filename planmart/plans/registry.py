"""Named queries over a folder of driver tables: ``QUERIES[name](spark, sf_dir)``.

Every query starts from the driver tables (``orders`` and ``lineitem`` feed
the two sources), so its work grows with them; nothing is sampled, capped or
subset. What reads silver or a mart reads the tables that ``store`` writes
once per application and state of the sources.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lenient_double
from ..operators import marts as M
from ..operators import quality as Q
from ..operators.enrich import join_plans_costs
from ..schemas import DM1_TABLE, DM2_TABLE, DM3_TABLE, PLANS_SCHEMA, SILVER_SCHEMA
from ..session import work_path
from ..sources.catalog import read_table, register_snapshots
from ..sources.csv import land_csv, read_csv_source, read_quarantine, write_csv_source
from ..sources.fixtures import fixture_costs, fixture_plans
from ..sources.snapshots import read_snapshot, write_snapshot
from . import pipeline as PL
from . import panels as P
from . import reports as R
from . import serving as S
from .store import store

QueryFn = Callable[[SparkSession, str], DataFrame]


def plans(spark: SparkSession, sf: str) -> DataFrame:
    return fixture_plans(spark, sf)


def costs(spark: SparkSession, sf: str) -> DataFrame:
    return fixture_costs(spark, sf)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return store(spark, sf).silver()


def dm1(spark, sf):
    return store(spark, sf).mart(DM1_TABLE)


def dm2(spark, sf):
    return store(spark, sf).mart(DM2_TABLE)


def dm3(spark, sf):
    return store(spark, sf).mart(DM3_TABLE)


def _marts(spark, sf):
    return dm1(spark, sf), dm2(spark, sf), dm3(spark, sf)


def _ordered(spark, sf, table):
    """The mart in its presentation order with the position of each row."""
    return M.with_position(store(spark, sf).build_mart(table), table)


def _panel_marts(spark, sf, as_double=False):
    d1, d2, d3 = _marts(spark, sf)
    return (P.panel_frame(d1, P.DM1_NUMERIC, as_double), P.panel_frame(d2, P.DM2_NUMERIC, as_double),
            P.panel_frame(d3, P.DM3_NUMERIC, as_double))


def _filtered(spark, sf, as_double=False, selection=P.Selection()):
    return P.apply_selection(*_panel_marts(spark, sf, as_double), selection)


def _envelope(spark, sf, page_no):
    """The envelope with its items as the keys of the page's rows."""
    out = S.affordability_envelope(dm1(spark, sf), page_no=page_no, page_size=10)
    keys = F.transform("items", lambda r: F.concat_ws("/", r["StateCode"], r["MetalLevel"]))
    return out.withColumn("item_keys", F.array_join(keys, ",")).drop("items")


CHOSEN = P.Selection(states=("CA", "NY", "TX"), metals=("Gold", "Silver"), networks=("HMO",))


RUN_DATE, NEXT_DATE = M.DEFAULT_SNAPSHOT, "2024-01-16"


def io_snapshot_roundtrip(spark, sf):
    """Two dates of different rows, then a smaller rerun of the first; both read back whole."""
    root = work_path(spark, "bronze")
    src = plans(spark, sf)
    write_snapshot(src, root, "plans", RUN_DATE)
    write_snapshot(src.where("PlanYear >= 2022"), root, "plans", NEXT_DATE)
    write_snapshot(src.where("IsActive = 1"), root, "plans", RUN_DATE)
    parts = [read_snapshot(spark, root, "plans", PLANS_SCHEMA, d, keep_label=True) for d in (RUN_DATE, NEXT_DATE)]
    return parts[0].unionByName(parts[1])


def io_snapshot_empty_rerun(spark, sf):
    """A rerun without rows empties its own date only."""
    root = work_path(spark, "bronze")
    src = plans(spark, sf)
    write_snapshot(src, root, "plans", RUN_DATE)
    write_snapshot(src.where("IsActive = 1"), root, "plans", NEXT_DATE)
    write_snapshot(src.where("PlanYear < 0"), root, "plans", RUN_DATE)
    return read_snapshot(spark, root, "plans", PLANS_SCHEMA)


def io_snapshot_failed_rerun(spark, sf):
    """A rerun that fails after it began to write leaves the rows of the run before."""
    root = work_path(spark, "bronze")
    src = plans(spark, sf)
    write_snapshot(src.where("IsActive = 1"), root, "plans", RUN_DATE)
    write_snapshot(src, root, "plans", NEXT_DATE)
    broken = src.withColumn("PlanYear", F.when(F.col("PlanID").isNull(), F.col("PlanYear")).otherwise(
        F.raise_error(F.lit("planted failure")).cast("int")))
    for d in (RUN_DATE, NEXT_DATE):
        try:
            write_snapshot(broken, root, "plans", d)
        except Exception as e:  # the planted one only
            if "planted failure" not in str(e):
                raise
    return read_snapshot(spark, root, "plans", PLANS_SCHEMA)


def _own_database() -> str:
    return f"planmart_{uuid.uuid4().hex[:8]}"  # runs don't share names


def io_catalog_table(spark, sf):
    """Silver written as a dated leaf, read back through the catalog."""
    root = work_path(spark, "silver")
    write_snapshot(silver(spark, sf), root, PL.SILVER_TABLE, RUN_DATE)
    name = register_snapshots(spark, _own_database(), root, PL.SILVER_TABLE, SILVER_SCHEMA, [RUN_DATE],
                              database_location=f"{root}/catalog.db")
    return read_table(spark, name).where("snapshot_date = '%s'" % RUN_DATE)


def io_csv_source(spark, sf):
    """S3: plans landed as headered CSV and read back with the explicit schema."""
    path = work_path(spark, "plans_csv")
    write_csv_source(plans(spark, sf), path)
    return read_csv_source(spark, path, PLANS_SCHEMA)


def io_csv_quarantine(spark, sf):
    """S3: plans as CSV with planted short lines and lines with a word for the year; rows and quarantined lines."""
    lines, root = work_path(spark, "plans_lines"), work_path(spark, "landed")
    number = F.coalesce(F.substring("PlanID", 3, 8).cast("int"), F.lit(0))
    text = F.to_csv(F.struct(*PLANS_SCHEMA.fieldNames()), {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
                                                          "ignoreTrailingWhiteSpace": "false"})
    line = (F.when(number % 50 == 7, F.concat("PlanID", F.lit(",short")))
            .when(number % 50 == 8, F.concat("PlanID", F.lit("," * (len(PLANS_SCHEMA) - 1) + "year"))).otherwise(text))
    plans(spark, sf).select(line.alias("value")).write.text(lines)
    land_csv(spark, lines, PLANS_SCHEMA, root, "plans", RUN_DATE, header=False)
    good = read_snapshot(spark, root, "plans", PLANS_SCHEMA, RUN_DATE)
    bad = read_quarantine(spark, root, "plans", RUN_DATE)
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(bad.select("line"), allowMissingColumns=True)


def _pipeline(spark, sf, catalog_db=None):
    lake = work_path(spark, "lake")
    return lake, PL.run(spark, plans(spark, sf), costs(spark, sf), lake, RUN_DATE, catalog_db=catalog_db)


def _gold(table):
    """E1 end to end: bronze -> silver -> gold; one mart read back."""
    return lambda spark, sf: PL.read_gold(spark, _pipeline(spark, sf)[0], table, RUN_DATE)


def io_pipeline_silver(spark, sf):
    """The silver leaf written by the pipeline, read through the catalog."""
    db = _own_database()
    _pipeline(spark, sf, db)
    return read_table(spark, f"{db}.{PL.SILVER_TABLE}").where("snapshot_date = '%s'" % RUN_DATE).drop("snapshot_date")


def io_row_counts(spark, sf):
    """Rows that each write of a run reported."""
    return spark.createDataFrame(sorted(_pipeline(spark, sf)[1].rows.items()), "dataset string, n_rows long")


def io_pipeline_funnel(spark, sf):
    """the funnels that a run counted while writing."""
    run = _pipeline(spark, sf)[1]
    rows = [(r["rule_no"], r["rule"], r["rejected"], r["remaining"]) for r in [*run.plan_funnel, *run.cost_funnel]]
    return spark.createDataFrame(rows, "rule_no int, rule string, rejected long, remaining long")


# Text forms around a limit; the first five are numbers where the limit is one.
LIMIT_FORMS = (("", ""), (" ", " "), ("-", ".5"), ("", "e3"), ("+0", "."), ("", "d"), ("", ".5F"), ("0x", "p3"), ("", "_0"),
               ("1,", ""), ("", "e"), ("", " 0"))


def lenient_limits(spark, sf):
    """Text that is no number becomes NULL; limits stand in several forms, by the primary-care copay."""
    form = F.pmod(F.col("CopayPrimaryCare").cast("int"), F.lit(len(LIMIT_FORMS)))
    text = F.coalesce(*[F.when(form == k, F.concat(F.lit(a), F.col("QuantitativeLimit"), F.lit(b)))
                        for k, (a, b) in enumerate(LIMIT_FORMS)])
    rows = costs(spark, sf).select("PlanID", text.alias("limit_text"))
    return rows.withColumn("limit_value", lenient_double("limit_text"))


QUERIES: dict[str, QueryFn] = {
    # S13 source checks
    "src_plan_count": lambda s, d: R.src_plan_count(plans(s, d)),
    "src_metal_counts": lambda s, d: R.src_metal_counts(plans(s, d)),
    "src_top_benefits": lambda s, d: R.src_top_benefits(costs(s, d)),
    "src_plan_sample": lambda s, d: R.src_plan_sample(plans(s, d)),
    # F1-F9 validation
    "dq_funnel_plans": lambda s, d: Q.plan_funnel(plans(s, d)),
    "dq_funnel_costs": lambda s, d: Q.cost_funnel(costs(s, d)),
    "clean_plans": lambda s, d: Q.clean_plans(plans(s, d)),
    "clean_costs": lambda s, d: Q.clean_costs(costs(s, d)),
    # J1, W1-W5, P3-P5
    "silver_joined": lambda s, d: join_plans_costs(Q.clean_plans(plans(s, d)), Q.clean_costs(costs(s, d))),
    "silver_enriched": silver,
    # Marts
    "dm1_affordability": lambda s, d: store(s, d).build_mart(DM1_TABLE),
    "dm2_market": lambda s, d: store(s, d).build_mart(DM2_TABLE),
    "dm3_competitiveness": lambda s, d: store(s, d).build_mart(DM3_TABLE),
    "dm1_ordered": lambda s, d: _ordered(s, d, DM1_TABLE),
    "dm2_ordered": lambda s, d: _ordered(s, d, DM2_TABLE),
    "dm3_ordered": lambda s, d: _ordered(s, d, DM3_TABLE),
    "mart_volumes": lambda s, d: M.mart_volumes(*_marts(s, d)),
    # Reports
    "q01_metal_profile": lambda s, d: R.q01_metal_profile(dm1(s, d)),
    "q02_costliest_states": lambda s, d: R.q02_costliest_states(dm1(s, d)),
    "q03_cheapest_states": lambda s, d: R.q03_cheapest_states(dm1(s, d)),
    "q04_deductible_spread": lambda s, d: R.q04_deductible_spread(dm1(s, d)),
    "q05_network_share": lambda s, d: R.q05_network_share(dm2(s, d)),
    "q06_top_issuers": lambda s, d: R.q06_top_issuers(dm2(s, d)),
    "q07_state_competition": lambda s, d: R.q07_state_competition(dm2(s, d)),
    "q08_network_coverage": lambda s, d: R.q08_network_coverage(dm2(s, d)),
    "q09_copays_by_metal": lambda s, d: R.q09_copays_by_metal(dm3(s, d)),
    "q10_exclusion_rate": lambda s, d: R.q10_exclusion_rate(dm3(s, d)),
    "q11_hsa_rate": lambda s, d: R.q11_hsa_rate(dm3(s, d)),
    "q12_hmo_vs_ppo": lambda s, d: R.q12_hmo_vs_ppo(dm3(s, d)),
    # Serving
    "svc_affordability_page": lambda s, d: S.affordability_page(dm1(s, d), page_no=1, page_size=10),
    "svc_affordability_page_ny_silver": lambda s, d: S.affordability_page(dm1(s, d), "NY", "Silver"),
    "svc_affordability_page_past_end": lambda s, d: S.affordability_page(dm1(s, d), page_no=99, page_size=10),
    "svc_affordability_page_envelope": lambda s, d: _envelope(s, d, 2),
    "svc_affordability_page_envelope_past_end": lambda s, d: _envelope(s, d, 99),
    "svc_market_page": lambda s, d: S.market_page(dm2(s, d), page_no=1, page_size=10),
    "svc_market_page_tx_ppo": lambda s, d: S.market_page(dm2(s, d), "TX", "PPO", page_no=2, page_size=5),
    "svc_competitiveness_page": lambda s, d: S.competitiveness_page(dm3(s, d), page_no=1, page_size=10),
    "svc_competitiveness_page_gold_hmo": lambda s, d: S.competitiveness_page(
        dm3(s, d), metal_level="Gold", network_type="HMO", page_no=1, page_size=10),
    "svc_affordability_stats": lambda s, d: S.affordability_stats(dm1(s, d)),
    "svc_network_distribution": lambda s, d: S.network_distribution(dm2(s, d)),
    "svc_copay_summary": lambda s, d: S.copay_summary(dm3(s, d)),
    # Panels
    "panel_load": lambda s, d: _panel_marts(s, d, as_double=True)[0],
    "panel_load_dm2": lambda s, d: _panel_marts(s, d, as_double=True)[1],
    "panel_load_dm3": lambda s, d: _panel_marts(s, d, as_double=True)[2],
    "panel_facets": lambda s, d: P.facets(*_panel_marts(s, d)[:2]),
    "panel_kpis": lambda s, d: P.kpis(*_filtered(s, d)[:2]),
    "panel_state_deductible": lambda s, d: P.state_deductible(_filtered(s, d)[0]),
    "panel_metal_ded_oop": lambda s, d: P.metal_ded_oop(_filtered(s, d)[0]),
    "panel_score_box": lambda s, d: P.score_box(_filtered(s, d)[0]),
    "panel_state_extremes": lambda s, d: P.state_extremes(_filtered(s, d)[0]),
    "panel_network_plans": lambda s, d: P.network_plans(_filtered(s, d)[1]),
    "panel_network_diversity": lambda s, d: P.network_diversity(_filtered(s, d)[1]),
    "panel_top15_issuers": lambda s, d: P.top_issuers(_filtered(s, d)[1]),
    "panel_state_network_matrix": lambda s, d: P.state_network_matrix(_filtered(s, d)[1]),
    "panel_copays": lambda s, d: P.copays(_filtered(s, d)[2]),
    "panel_coinsurance": lambda s, d: P.coinsurance(_filtered(s, d)[2]),
    "panel_hsa_pct": lambda s, d: P.hsa_pct(_filtered(s, d)[2]),
    "panel_exclusion_matrix": lambda s, d: P.exclusion_matrix(_filtered(s, d)[2]),
    "panel_plans_by_metal": lambda s, d: P.plans_by_metal(_panel_marts(s, d)[0]),
    "panel_state_scatter": lambda s, d: P.state_scatter(_panel_marts(s, d)[0]),
    "raw_panel_rows": lambda s, d: _filtered(s, d, as_double=True)[0],
    "raw_panel_rows_dm2": lambda s, d: _filtered(s, d, as_double=True)[1],
    "raw_panel_rows_dm3": lambda s, d: _filtered(s, d, as_double=True)[2],
    "raw_panel_chosen": lambda s, d: _filtered(s, d, as_double=True, selection=CHOSEN)[0],
    "raw_panel_chosen_dm2": lambda s, d: _filtered(s, d, as_double=True, selection=CHOSEN)[1],
    "raw_panel_chosen_dm3": lambda s, d: _filtered(s, d, as_double=True, selection=CHOSEN)[2],
    "raw_panel_none_chosen": lambda s, d: _filtered(s, d, as_double=True, selection=P.Selection(states=()))[0],
    "panel_lenient_limits": lenient_limits,
    # Sources and sinks
    "io_snapshot_roundtrip": io_snapshot_roundtrip,
    "io_snapshot_empty_rerun": io_snapshot_empty_rerun,
    "io_snapshot_failed_rerun": io_snapshot_failed_rerun,
    "io_catalog_table": io_catalog_table,
    "io_csv_source": io_csv_source,
    "io_csv_quarantine": io_csv_quarantine,
    "io_pipeline_dm1": _gold(DM1_TABLE),
    "io_pipeline_dm2": _gold(DM2_TABLE),
    "io_pipeline_dm3": _gold(DM3_TABLE),
    "io_row_counts": io_row_counts,
    "io_pipeline_funnel": io_pipeline_funnel,
    "io_pipeline_silver": io_pipeline_silver,
}
