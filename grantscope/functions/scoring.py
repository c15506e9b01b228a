"""Risk score and risk band (operators C1, C2, J5).

``score = round(min(base * crit * level, 100), 1)`` with half-even rounding;
unknown keys take the catalogue defaults. Available as SQL text (for
``selectExpr``) and as Columns.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantscope import catalogue as cat
from grantscope.functions.sqltext import case_lookup


def literal_map(mapping: dict) -> Column:
    """A map literal built from a small fixed dict (folded into the plan)."""
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))



def score_sql(severity: str, criticality: str, level: str) -> str:
    base = case_lookup(severity, {k: float(v) for k, v in cat.SEVERITY_BASE.items()}, float(cat.DEFAULT_SEVERITY_BASE))
    crit = case_lookup(criticality, cat.CRITICALITY_MULTIPLIER, cat.DEFAULT_CRITICALITY_MULTIPLIER)
    lvl = case_lookup(level, cat.ACCESS_LEVEL_MULTIPLIER, cat.DEFAULT_ACCESS_LEVEL_MULTIPLIER)
    return f"bround(least({base} * {crit} * {lvl}, 100.0D), 1)"


def band_sql(score: str) -> str:
    whens = " ".join(f"WHEN {score} >= {t} THEN '{b}'" for t, b in cat.BAND_THRESHOLDS)
    return f"(CASE {whens} ELSE 'LOW' END)"


def band_rank_sql(band: str) -> str:
    return case_lookup(band, {b: i for i, b in enumerate(cat.BAND_ORDER)}, len(cat.BAND_ORDER))


def risk_score(severity: str = "severity", criticality: str = "system_criticality",
               level: str = "access_level") -> Column:
    """Column form; arguments are SQL expressions (usually column names)."""
    return F.expr(score_sql(severity, criticality, level))


def risk_band(score: str = "risk_score") -> Column:
    return F.expr(band_sql(score))


def band_rank(band: str) -> Column:
    """Position of a band in CRITICAL, HIGH, MEDIUM, LOW order (unknown last)."""
    return F.expr(band_rank_sql(band))
