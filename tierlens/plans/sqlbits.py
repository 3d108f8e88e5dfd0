"""Small SQL text helpers for the DuckDB oracle strings (plain ANSI SQL)."""

from __future__ import annotations

from collections.abc import Sequence


def z(x: str, stats: str = "s") -> str:
    """z-score with the stats CTE columns ``{x}_mean`` / ``{x}_sd``."""
    m, s = f"{stats}.{x}_mean", f"{stats}.{x}_sd"
    return f"(CASE WHEN {s} IS NULL OR {s} = 0 OR isnan({s}) THEN 0.0::DOUBLE ELSE ({x} - {m}) / {s} END)"


def zexpr(expr: str, key: str, stats: str = "s") -> str:
    m, s = f"{stats}.{key}_mean", f"{stats}.{key}_sd"
    return f"(CASE WHEN {s} IS NULL OR {s} = 0 OR isnan({s}) THEN 0.0::DOUBLE ELSE (({expr}) - {m}) / {s} END)"


def moments(cols: Sequence[str], ddof: int = 1) -> str:
    std = "stddev_samp" if ddof == 1 else "stddev_pop"
    return ", ".join(f"avg({c}) AS {c}_mean, {std}({c}) AS {c}_sd" for c in cols)


def rowmean(terms: Sequence[str]) -> str:
    """Mean skipping NULL terms; NULL when all are NULL."""
    num = " + ".join(f"coalesce({t}, 0.0::DOUBLE)" for t in terms)
    den = " + ".join(f"(CASE WHEN {t} IS NULL THEN 0 ELSE 1 END)" for t in terms)
    return f"(CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) END)"


def safe_div(n: str, d: str, fill: str = "0.0::DOUBLE") -> str:
    return (f"(CASE WHEN {n} IS NULL OR {d} IS NULL OR {d} = 0 OR isinf({n} / {d}) OR isnan({n} / {d}) "
            f"THEN {fill} ELSE {n} / {d} END)")


def r6(x: str) -> str:
    """Round to 6 decimals; ``+ 0.0`` turns -0.0 into 0.0 like Spark's round."""
    return f"(round({x}, 6) + 0.0::DOUBLE)"
