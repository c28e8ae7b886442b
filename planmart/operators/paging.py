"""Filtered, ordered page reads (the serving API's paginated endpoints).

``page`` returns the rows of one page plus the envelope numbers as columns
(page, page_size, total, total_pages). ``total`` is a scalar subquery over the
filtered rows. A page past the end has no rows to carry it, so ``envelope``
gives one row with the numbers and the items as an array, empty past the end. The order always ends with the full group key, so equal
sort values never make pages overlap or skip rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE


def equality_filter(df: DataFrame, filters: Mapping[str, object | None]) -> DataFrame:
    """AND of ``col = value`` for every filter that is not None.

    Exact and case-sensitive; an empty string is a real filter value.
    """
    cond: Column | None = None
    for col, value in filters.items():
        if value is None:
            continue
        term = F.col(col) == F.lit(value)
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def _check_bounds(page_no: int, page_size: int) -> None:
    if page_no < 1:
        raise ValueError("page must be >= 1")
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be within 1..{MAX_PAGE_SIZE}")


def page(
    df: DataFrame,
    order: Sequence[Column],
    filters: Mapping[str, object | None] | None = None,
    page_no: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """T4: rows ``(page_no-1)*page_size`` .. of the filtered, ordered rows."""
    _check_bounds(page_no, page_size)
    rows = equality_filter(df, filters or {})
    total = rows.select(F.count(F.lit(1))).scalar()
    return (
        rows.orderBy(*order)
        .offset((page_no - 1) * page_size)
        .limit(page_size)
        .withColumns({
            "page": F.lit(page_no),
            "page_size": F.lit(page_size),
            "total": total,
            "total_pages": F.ceil(total / F.lit(page_size)).cast("bigint"),
        })
    )


def envelope(
    df: DataFrame,
    order: Sequence[Column],
    filters: Mapping[str, object | None] | None = None,
    page_no: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """T4: one row (page, page_size, total, total_pages, n_items, items), also past the end."""
    _check_bounds(page_no, page_size)
    rows = equality_filter(df, filters or {})
    wanted = rows.orderBy(*order).offset((page_no - 1) * page_size).limit(page_size)
    # at most page_size rows, in page order
    items = wanted.withColumn("_n", F.monotonically_increasing_id()).agg(
        F.sort_array(F.collect_list(F.struct("_n", F.struct(*df.columns).alias("item")))).alias("sorted"))
    total = rows.select(F.count(F.lit(1))).scalar()
    return items.select(
        F.lit(page_no).alias("page"), F.lit(page_size).alias("page_size"), total.alias("total"),
        F.ceil(total / F.lit(page_size)).cast("bigint").alias("total_pages"),
        F.size("sorted").cast("bigint").alias("n_items"), F.col("sorted.item").alias("items"))
