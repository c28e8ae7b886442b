"""Validation rules R1-R7 and the rejection funnel.

Order of the rules follows the source job: R1 (non-null, then unique key),
R2 state, R4 network, R5 issuer, R6 metal, R7 year on plans; R3 on costs.
De-duplication happens *before* the validity rules, so a bad duplicate can
evict a good one - that is kept on purpose.

Deliberate deviations from the source job:
* the kept duplicate is chosen by a total order (latest PlanYear, then the
  remaining columns ascending, nulls last) instead of an arbitrary row;
* the funnel is one aggregate over one pass instead of nine count jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import passes
from ..schemas import MIN_PLAN_YEAR, PLAN_COLUMNS, VALID_METAL_LEVELS, VALID_NETWORK_TYPES, VALID_STATES
from .crowded import HOT_ROWS, split

# Rule numbers and names as logged by the source job (fixed values).
PLAN_RULES = [
    (1, "PlanID unique/non-null"),
    (2, "StateCode valid"),
    (4, "NetworkType valid"),
    (5, "IssuerName non-empty"),
    (6, "MetalLevel valid"),
    (7, "PlanYear >= 2020"),
]
COST_RULE = (3, "cost validity")

# Preference among rows sharing a PlanID: (column, descending).
DEDUP_ORDER = [
    ("PlanYear", True), ("MetalLevel", False), ("NetworkType", False), ("StateCode", False),
    ("IssuerName", False), ("IsActive", False), ("PlanType", False), ("MarketCoverage", False),
    ("IssuerID", False), ("CountyName", False), ("PlanName", False),
]


def plan_rule_predicates() -> list[tuple[int, Column]]:
    """(rule_no, predicate that must be TRUE) for rules R2..R7, in check order."""
    issuer = F.col("IssuerName")
    return [
        (2, F.col("StateCode").isin(VALID_STATES)),
        (4, F.col("NetworkType").isin(VALID_NETWORK_TYPES)),
        (5, issuer.isNotNull() & (F.trim(issuer) != F.lit(""))),
        (6, F.col("MetalLevel").isin(VALID_METAL_LEVELS)),
        (7, F.col("PlanYear") >= F.lit(MIN_PLAN_YEAR)),
    ]


def cost_rule_predicate() -> Column:
    """0 <= deductible <= out-of-pocket max, and out-of-pocket max > 0."""
    ded, oop = F.col("IndividualDeductible"), F.col("IndividualOutOfPocketMax")
    return (ded >= 0) & (oop > 0) & (ded <= oop)


def _preference() -> Column:
    """All columns but the key as one struct that sorts like the preference.

    Per column a null flag, then the value (negated where larger is better):
    the smallest struct is the row to keep, and holds its values.
    """
    fields = []
    for name, descending in DEDUP_ORDER:
        c = F.col(name)
        fields.append(c.isNull().alias(f"no_{name}"))
        fields.append((-c.cast("bigint") if descending else c).alias(name))
    return F.struct(*fields)


def _fold(rows: DataFrame) -> DataFrame:
    """The preferred row of each PlanID, with the sum of ``_rows``."""
    descending = {name for name, d in DEDUP_ORDER if d}
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    columns = [F.col("PlanID")] + [
        (-F.col(f"_row.{c}") if c in descending else F.col(f"_row.{c}")).cast(kinds[c]).alias(c)
        for c in PLAN_COLUMNS if c != "PlanID"]
    return rows.groupBy("PlanID").agg(F.min(_preference()).alias("_row"), F.sum("_rows").alias("_rows")).select(*columns, "_rows")


def deduplicate_plans(plans: DataFrame, with_counts: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per PlanID (NULL keys form one group of their own).

    The smallest preference struct is both the choice and the row, so each
    column is shuffled once. A smallest struct needs sorted rows, and a sort
    of whole input splits would spill, so rows are dealt by key first and
    sorted after the exchange. Crowded keys are folded map-side before that, so
    a key holding a third of all rows never reaches one task whole.
    ``with_counts`` adds ``_rows`` = input rows of the key.
    """
    even, hot = split(plans.select(*PLAN_COLUMNS, F.lit(1).cast("bigint").alias("_rows")), "PlanID", hot_rows)
    dealt = even.unionByName(_fold(hot)).repartition("PlanID")
    return _fold(dealt).select(*PLAN_COLUMNS, *(["_rows"] if with_counts else []))


def flag_plans(plans: DataFrame) -> DataFrame:
    """Deduplicated plans with ``_rows`` and ``failed_rule`` (NULL = kept)."""
    deduped = deduplicate_plans(plans, with_counts=True)
    failed = F.when(F.col("PlanID").isNull(), F.lit(1))
    for rule_no, pred in plan_rule_predicates():
        failed = failed.when(~passes(pred), F.lit(rule_no))
    return deduped.withColumn("failed_rule", failed.otherwise(F.lit(None).cast("int")))


def clean_plans(plans: DataFrame) -> DataFrame:
    """Plans passing R1..R7 (dedup first, then the validity rules).

    In a filter a NULL predicate drops the row, exactly like ``passes``. The
    rules judge the row that de-duplication keeps, so they stay above that
    aggregate; only the key's own filter is below it.
    """
    preds = [pred for _, pred in plan_rule_predicates()]
    keep = preds[0]
    for pred in preds[1:]:
        keep = keep & pred
    return deduplicate_plans(plans.where(F.col("PlanID").isNotNull())).where(keep)


def clean_costs(costs: DataFrame) -> DataFrame:
    """Cost rows passing R3; the bare predicate reaches the Parquet scan."""
    return costs.where(cost_rule_predicate())


def funnel_rows(counts: DataFrame, rules: list[tuple[int, str]]) -> DataFrame:
    """Turn one row of ``total`` + ``r<k>`` counts into rule_no/rule/rejected/remaining."""
    args = ", ".join(f"{no}, '{name}', r{no}" for no, name in rules)
    long = counts.select(
        "total", F.expr(f"stack({len(rules)}, {args}) AS (rule_no, rule, rejected)")
    )
    upto = Window.orderBy("rule_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return long.select(
        F.col("rule_no").cast("int").alias("rule_no"),
        "rule",
        F.col("rejected").cast("bigint").alias("rejected"),
        (F.col("total") - F.sum("rejected").over(upto)).cast("bigint").alias("remaining"),
    )


def plan_funnel_counts() -> list[Column]:
    """Aggregate expressions of the plan funnel over ``flag_plans`` output."""
    r1 = F.when(F.col("PlanID").isNull(), F.col("_rows")).otherwise(F.col("_rows") - 1)
    exprs = [F.sum("_rows").alias("total"), F.sum(r1).alias("r1")]
    for rule_no, _ in PLAN_RULES[1:]:
        exprs.append(F.count_if(F.col("PlanID").isNotNull() & (F.col("failed_rule") == rule_no)).alias(f"r{rule_no}"))
    return exprs


def plan_funnel_from_flagged(flagged: DataFrame) -> DataFrame:
    """Funnel rows from ``flag_plans`` output (one small aggregate)."""
    return funnel_rows(flagged.agg(*plan_funnel_counts()), PLAN_RULES)


def plan_funnel(plans: DataFrame) -> DataFrame:
    """Rows rejected by each plan rule (first failed rule) and rows remaining."""
    return plan_funnel_from_flagged(flag_plans(plans))


def cost_funnel_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), F.count_if(~passes(cost_rule_predicate())).alias(f"r{COST_RULE[0]}")]


def cost_funnel(costs: DataFrame) -> DataFrame:
    """Rows rejected by R3 and rows remaining (costs are not de-duplicated)."""
    return funnel_rows(costs.agg(*cost_funnel_counts()), [COST_RULE])


def observed(df: DataFrame, counts: list[Column], name: str) -> tuple[DataFrame, Observation]:
    """Attach funnel counts to a pass that runs anyway (e.g. a write)."""
    obs = Observation(name)
    return df.observe(obs, *counts), obs


def counted(df: DataFrame, counts: list[Column]) -> dict:
    """The same counts by a job of their own (one row)."""
    return df.agg(*counts).first().asDict()


def funnel_of(counts: dict, rules: list[tuple[int, str]]) -> list[dict]:
    """Funnel rows from observed counts (nulls of an empty table count as 0)."""
    left, out = counts.get("total") or 0, []
    for no, name in rules:
        rejected = counts.get(f"r{no}") or 0
        left -= rejected
        out.append({"rule_no": no, "rule": name, "rejected": rejected, "remaining": left})
    return out
