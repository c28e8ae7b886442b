from decimal import Decimal

from planmart.schemas import COSTS_SCHEMA, PLANS_SCHEMA


def plan(pid, state="CA", network="HMO", issuer="Issuer_01", metal="Gold", year=2023, active=1,
         county=None, plan_type="Individual"):
    county = county or f"{state}_County_1"
    return (pid, issuer, "ISS00001", f"{issuer} {metal}", plan_type, network, metal, state, county,
            "Individual", active, year)


def cost(pid, ded="1000", oop="3000", copay="20", coins="0.20", hsa=0, category="Benefit_1", covered=1,
         exclusions="None"):
    d = None if ded is None else Decimal(ded)
    o = None if oop is None else Decimal(oop)
    fam = None if d is None else d * 2
    return (pid, d, fam, o, None if o is None else o * 2, Decimal(copay), Decimal(copay) + 10, Decimal("200"),
            Decimal("10"), Decimal(coins), hsa, category, covered, "10", "Visits", exclusions)


def plans_df(spark, rows):
    return spark.createDataFrame(rows, PLANS_SCHEMA)


def costs_df(spark, rows):
    return spark.createDataFrame(rows, COSTS_SCHEMA)
