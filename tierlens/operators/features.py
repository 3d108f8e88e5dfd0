"""Feature catalogue operators.

Plan shape: level-1 columns (ratios, logs, gaps; no fitted state) in one
``withColumns``; then ONE aggregate fits mean and sample std for every
z-scored source (raw or level-1) at once; its single row is broadcast and
all level-2 composites are added in one more ``withColumns``. So the whole
catalogue costs one extra pass over the table, however many features.
Features whose inputs are absent are skipped at plan time (P9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (clip, dbl, log1p_clipped, mean_propagating, reverse_scale, row_mean,
                               safe_divide, zscore)
from ..specs import Abs, Feature, Gap, Log1p, Ratio, ZIndex, ZTerm
from .stats import attach, fit_moments

STAT_PREFIX = "zs_"


def level1_exprs(columns: Sequence[str], features: Sequence[Feature]) -> dict[str, Column]:
    """Expressions of the stateless features whose inputs are present."""
    have = set(columns)
    out: dict[str, Column] = {}
    for f in features:
        if isinstance(f, Ratio) and {f.num, f.den} <= have:
            out[f.name] = safe_divide(f.num, f.den, f.fill)
        elif isinstance(f, Log1p) and f.source in have:
            out[f.name] = log1p_clipped(f.source)
        elif isinstance(f, Abs) and f.source in have:
            out[f.name] = F.abs(F.col(f.source))
        elif isinstance(f, Gap) and {f.a, f.b} <= have:
            out[f.name] = clip(F.col(f.a) - F.col(f.b), 0.0)
        else:
            continue
        have.add(f.name)
    return out


def _resolve(term: ZTerm, have: set[str]) -> str | None:
    return next((s for s in term.source if s in have), None)


def _source_key(src: str, term: ZTerm) -> str:
    if term.reverse is None:
        return src
    top, fill = term.reverse
    return f"{src}_rev{int(top)}_{int(fill)}"


def _source_expr(src: str, term: ZTerm) -> Column:
    if term.reverse is None:
        return F.col(src).cast("double")
    return reverse_scale(src, *term.reverse)


def z_sources(columns: Sequence[str], indices: Sequence[ZIndex]) -> dict[str, Column]:
    """Every distinct z-scored source over present columns: key -> expression."""
    have = set(columns)
    out: dict[str, Column] = {}
    for ix in indices:
        for t in (*ix.positive, *ix.negative):
            s = _resolve(t, have)
            if s is not None:
                out.setdefault(_source_key(s, t), _source_expr(s, t))
    return out


def fit_z_stats(df: DataFrame, sources: dict[str, Column]) -> DataFrame:
    """One aggregate: mean and sample std of every z source (A4)."""
    tmp = df.select(*[e.alias(STAT_PREFIX + k) for k, e in sources.items()])
    stats = fit_moments(tmp, [STAT_PREFIX + k for k in sources], ddof=1)
    return stats


def _zname(key: str) -> str:
    return f"__z_{key}"


def z_columns(sources: dict[str, Column]) -> dict[str, Column]:
    """One z-score column per source over the attached stats."""
    out = {}
    for k, e in sources.items():
        s = STAT_PREFIX + k
        out[_zname(k)] = zscore(e, F.col(f"{s}__mean"), F.col(f"{s}__sd"))
    return out


def _z(term: ZTerm, src: str) -> Column:
    z = F.col(_zname(_source_key(src, term)))
    return -z if term.sign < 0 else z


def index_expr(ix: ZIndex, columns: Sequence[str]) -> Column | None:
    """The Column of one composite over attached stats, or None if its
    required inputs are absent."""
    have = set(columns)
    pos = [(t, _resolve(t, have)) for t in ix.positive]
    neg = [(t, _resolve(t, have)) for t in ix.negative]
    pos_ok = [_z(t, s) for t, s in pos if s is not None]
    neg_ok = [_z(t, s) for t, s in neg if s is not None]
    if ix.require == "all" and (len(pos_ok) < len(pos) or len(neg_ok) < len(neg)):
        return None
    if ix.require == "positive" and not pos_ok:
        return None
    if not pos_ok and not neg_ok:
        return F.lit(None).cast("double") if ix.null_if_empty else None
    if ix.combine == "signed":
        pos_m = row_mean(pos_ok) if pos_ok else dbl(0.0)
        neg_m = row_mean(neg_ok) if neg_ok else dbl(0.0)
        return pos_m - neg_m
    terms = pos_ok + [-z for z in neg_ok]
    if ix.combine == "mean":
        return row_mean(terms)
    if ix.combine == "pair":
        return mean_propagating(terms)
    raise ValueError(f"unknown combine {ix.combine!r}")


def engineer(df: DataFrame, features: Sequence[Feature], stats: DataFrame | None = None,
             keep_stats: bool = False) -> tuple[DataFrame, DataFrame]:
    """Add every feature whose inputs exist.

    Returns (featured frame, one-row z-stats). Pass ``stats`` (e.g. the
    training fit, re-read from Parquet) to score new rows with the same
    centring: that removes the reference's train/serve skew (F27).
    """
    l1 = level1_exprs(df.columns, features)
    df1 = df.withColumns(l1) if l1 else df
    indices = [f for f in features if isinstance(f, ZIndex)]
    if not indices:
        return df1, df1.sparkSession.range(1).drop("id")
    sources = z_sources(df1.columns, indices)
    if stats is None:
        stats = fit_z_stats(df1, sources)
    zc = z_columns(sources)
    joined = attach(df1, stats).withColumns(zc)
    l2 = {}
    for ix in indices:
        e = index_expr(ix, df1.columns)
        if e is not None:
            l2[ix.name] = e
    out = (joined.withColumns(l2) if l2 else joined).drop(*zc)
    return (out if keep_stats else out.drop(*stats.columns)), stats


def composite_index(df: DataFrame, name: str, positive: Sequence[str], negative: Sequence[str] = (),
                    stats: DataFrame | None = None) -> DataFrame:
    """X10 as a one-call operator: ``name`` = mean z(positive) - mean z(negative)."""
    ix = ZIndex(name, tuple(ZTerm.of(c) for c in positive), tuple(ZTerm.of(c) for c in negative),
                combine="signed", require="any", null_if_empty=True)
    return engineer(df, [ix], stats)[0]
