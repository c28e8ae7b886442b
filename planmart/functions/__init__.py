"""Column expressions shared by the operators (all built-in Spark functions)."""

from .columns import (  # noqa: F401
    affordability_score_exact,
    canonical_position,
    decimal_avg,
    isin_or_false,
    lenient_double,
    passes,
    percent,
    rounded_avg,
)
