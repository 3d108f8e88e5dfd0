"""Score-derived labels and outlier capping.

Tier cuts and IQR bounds are exact interpolated quantiles of the whole
column, computed by the distributed order statistics in ``stats``, then
applied through a broadcast one-row table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip, dbl, lookup
from ..specs import IndicatorPreset, ZIndex
from ..session import cut_lineage
from .stats import attach, quantile_row, stat_name


def drop_unscored(df: DataFrame, score: str) -> DataFrame:
    """Rows whose score is missing cannot be labelled."""
    return df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score)))


def tier_cuts(df: DataFrame, score: str, n_classes: int = 3, mode: str = "exact") -> DataFrame:
    """Quantile cut points at i/n (i = 1..n-1) as a one-row table ``{score}__t{i}``."""
    probs = [i / n_classes for i in range(1, n_classes)]
    names = [f"t{i}" for i in range(1, n_classes)]
    src = df.select(score)
    src = src.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # literal-only one-row table: it does not depend on the cached input
        return quantile_row(src, [score], probs, names, mode)
    finally:
        src.unpersist()


def tier_labels(df: DataFrame, score: str, label: str, n_classes: int = 3, mode: str = "exact",
                cuts: DataFrame | None = None, materialize: bool = True) -> DataFrame:
    """Equal-frequency tiers, highest tier id for the lowest scores.

    Bins are closed on the right (pandas qcut; the fallback path of the
    reference uses ``<=`` too): s <= t1 -> n-1, t1 < s <= t2 -> n-2, ...,
    s > t_{n-1} -> 0. Tied cut points collapse the way the fallback does.
    Rows without a score are dropped first (P13).
    """
    scored = drop_unscored(df, score)
    if cuts is None:
        if materialize:
            # stage boundary: the quantile passes and the labelling all read
            # one reliable checkpoint instead of recomputing the scores
            scored = cut_lineage(scored)
        cuts = tier_cuts(scored, score, n_classes, mode)
    j = attach(scored, cuts)
    s = F.col(score)
    above = None
    for i in range(1, n_classes):
        term = (s > F.col(stat_name(score, f"t{i}"))).cast("int")
        above = term if above is None else above + term
    lab = (F.lit(n_classes - 1) - above).cast("int") if above is not None else F.lit(0)
    return j.withColumn(label, lab).drop(*cuts.columns)


def class_distribution(df: DataFrame, label: str, names: dict[int, str] | None = None) -> DataFrame:
    """A3 + P15: count and share per class (share rounded half-even to 3)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    out = attach(counts, total).select(
        F.col(label).cast("int").alias("label"),
        F.col("n").cast("long").alias("n"),
        F.round(F.col("n") / F.col("total") * 100.0, 6).alias("pct"),
        F.bround(F.col("n") / F.col("total"), 3).alias("share"),
    )
    if names is not None:
        out = out.withColumn("class_name", lookup("label", names))
    return out


# ---- W2 / A10: IQR capping ----------------------------------------------

def fit_iqr(df: DataFrame, cols: Sequence[str], multiplier: float = 1.5, mode: str = "exact") -> DataFrame:
    """Q1, Q3 and the bounds Q1 - m*IQR, Q3 + m*IQR per column (one row)."""
    src = df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        q = quantile_row(src, cols, [0.25, 0.75], ["q1", "q3"], mode)
    finally:
        src.unpersist()
    m = dbl(multiplier)
    sel = []
    for c in cols:
        q1, q3 = F.col(stat_name(c, "q1")), F.col(stat_name(c, "q3"))
        sel += [q1, q3, (q1 - m * (q3 - q1)).alias(stat_name(c, "lo")), (q3 + m * (q3 - q1)).alias(stat_name(c, "hi"))]
    return q.select(*sel)


def apply_iqr(df: DataFrame, bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cap (never delete) values outside the fitted bounds; NULL stays NULL."""
    j = attach(df, bounds)
    return j.withColumns({c: clip(c, F.col(stat_name(c, "lo")), F.col(stat_name(c, "hi"))) for c in cols}) \
        .drop(*bounds.columns)


def iqr_cap_counts(df: DataFrame, bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: per column the bounds and how many values fall below / above."""
    j = attach(df, bounds)
    aggs = []
    for c in cols:
        aggs += [F.count_if(F.col(c) < F.col(stat_name(c, "lo"))).alias(f"{c}__n_low"),
                 F.count_if(F.col(c) > F.col(stat_name(c, "hi"))).alias(f"{c}__n_high")]
    counts = attach(j.agg(*aggs), bounds)
    stack = ", ".join(
        f"'{c}', `{c}__q1`, `{c}__q3`, `{c}__lo`, `{c}__hi`, `{c}__n_low`, `{c}__n_high`" for c in cols)
    return counts.selectExpr(
        f"stack({len(cols)}, {stack}) AS (column_name, q1, q3, lower_bound, upper_bound, n_low, n_high)")


# ---- P10 / P11 -----------------------------------------------------------

def leaky_columns(preset: IndicatorPreset, strict: bool = False) -> list[str]:
    """P10: columns that built the target.

    Default (parity): the score's raw signal columns as configured, the score
    and the preset's listed derived columns. ``strict`` adds every score
    input found by lineage (e.g. a ratio feature used as a score signal).
    """
    spec: ZIndex | None = preset.score_spec
    out: list[str] = []
    if spec is not None:
        for t in (*spec.positive, *spec.negative):
            if strict:
                out.extend(t.source)
            else:
                out.append(t.source[0])
    out += [preset.score, *preset.leaky_extra]
    if not strict:
        derived = set(preset.extras.get("score_derived_inputs", ()))
        out = [c for c in out if c not in derived]
    return list(dict.fromkeys(out))


def drop_leaky(df: DataFrame, preset: IndicatorPreset, additional: Sequence[str] = (),
               strict: bool = False) -> DataFrame:
    """Drop leaky columns and extras (e.g. the key) if present."""
    drop = [c for c in (*leaky_columns(preset, strict), *additional) if c in df.columns]
    return df.drop(*drop)
