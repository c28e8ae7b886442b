"""Order-insensitive comparison of a Spark result with DuckDB oracle rows.

Columns are matched by name, rows are compared as a sorted multiset of
normalised values (decimals without trailing zeros, floats to 9 places).
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
                 "benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, strict: bool = False) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if v != v else repr(v if strict else round(v, 9))
    if isinstance(v, Decimal):
        return str(v) if strict else format(v.normalize(), "f")
    return str(v)


def canonical_lines(cols, rows, strict: bool = False) -> list[str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i], strict) for i in order) for r in rows)


def digest(cols, rows) -> str:
    return hashlib.sha256("\n".join(canonical_lines(cols, rows)).encode()).hexdigest()[:16]


def compare(df, con, sql: str, strict: bool = False) -> tuple[bool, str]:
    """(equal, message) for a Spark DataFrame against oracle SQL.

    ``strict`` compares doubles bit for bit and decimals with their scale.
    """
    rows = [tuple(r) for r in df.collect()]
    con.execute(f"CREATE OR REPLACE TEMP VIEW oracle_result AS {sql}")  # as a view, like the driver's check
    res = con.execute("SELECT * FROM oracle_result")
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(df.columns) != sorted(ocols):
        return False, f"columns differ: {df.columns} vs {ocols}"
    if len(rows) != len(orows):
        return False, f"row counts differ: {len(rows)} vs {len(orows)}"
    a, b = canonical_lines(df.columns, rows, strict), canonical_lines(ocols, orows, strict)
    if a != b:
        only_s = sorted(set(a) - set(b))[:2]
        only_o = sorted(set(b) - set(a))[:2]
        return False, f"values differ: spark {only_s} oracle {only_o}"
    return True, f"{len(rows)} rows"
