"""Fitted statistics (A4, A5, X3): fit once as an aggregate, apply as one
scalar subquery.

A global aggregate always returns exactly one row (a proven size bound
whatever the table size); it runs partial per partition and merges in one
tiny final step. Its row is applied to every row through a single reused
scalar subquery, so applying stats is a plain projection: no join and no
shuffle of the data.

Exact quantiles are computed without funnelling the column through one
task, in two scans. The first takes counts and a mergeable sketch, whose rank
bounds bracket every quantile; the second counts what lies below and at the
ends of each bracket and keeps the few values inside as a table of their own,
by one aggregate that multiplies no row. An iterative histogram then narrows
an order statistic over that small table: each pass is one distributed
aggregate, of which the driver reads one row per target.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import INF, dbl, nan_to_null
from ..session import drop_stage, stage_path

MEAN, SD, MIN, MAX, N = "mean", "sd", "min", "max", "n"


def stat_name(column: str, stat: str) -> str:
    return f"{column}__{stat}"


def fit_moments(df: DataFrame, cols: Sequence[str], ddof: int = 1,
                extra: Sequence[str] = ()) -> DataFrame:
    """A4: one row with mean, std (sample for ddof=1, population for 0),
    and any of min/max/n listed in ``extra`` for each column."""
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs: list[Column] = []
    for c in dict.fromkeys(cols):
        x = nan_to_null(F.col(c).cast("double"))
        aggs += [F.avg(x).alias(stat_name(c, MEAN)), std(x).alias(stat_name(c, SD))]
        if MIN in extra:
            aggs.append(F.min(x).alias(stat_name(c, MIN)))
        if MAX in extra:
            aggs.append(F.max(x).alias(stat_name(c, MAX)))
        if N in extra:
            aggs.append(F.count(x).alias(stat_name(c, N)))
    return df.agg(*aggs)


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Apply fitted state: add the columns of a one-row stats table to every
    row as fields of ONE scalar subquery (``DataFrame.scalar()``).

    The plan stays a projection over ``df`` (no join, no shuffle of ``df``);
    Spark runs the subquery once (``ReusedSubquery`` for every further
    reference) and fails loudly if it ever returned more than one row.
    """
    sv = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("__s")).scalar()
    # One column holds the subquery; fields are read from it in a second
    # projection, so the plan carries a single subquery expression (a
    # subquery is not "cheap", so CollapseProject keeps it un-inlined).
    tmp = "__stats"
    while tmp in df.columns:
        tmp += "_"
    d = df.withColumn(tmp, sv)
    return d.withColumns({c: F.col(tmp)[c] for c in one_row.columns}).drop(tmp)


# --------------------------------------------------------------------------
# Quantiles
# --------------------------------------------------------------------------

def _interp(lo: float, hi: float, frac: float) -> float:
    # lo + frac * (hi - lo): the same operations as SQL quantile_cont.
    if frac == 0.0 or lo == hi:
        return lo
    return lo + frac * (hi - lo)


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    h = (n - 1) * q
    lo = math.floor(h)
    return lo, min(lo + 1, n - 1), h - lo


def order_statistics(df: DataFrame, targets: Sequence[tuple[str, int]], buckets: int = 4096,
                     pre: dict | None = None, passes: list | None = None, weight: str | None = None) -> dict[tuple[str, int], float]:
    """Exact k-th smallest (0-based, NULL and NaN skipped) for each
    (column, k) target, by iterative histogram narrowing.

    Per pass: one aggregate ``groupBy(range, bucket).agg(count, min, max)``
    over the rows inside the candidate ranges; a running total over each
    range's few buckets finds the bucket of each rank, and the driver reads
    one row per target. The first pass buckets by sign and binary exponent,
    so that later ranges span one power of two at most; each later pass
    cuts a range into ``buckets`` equal parts. A power of two holds 2**52
    doubles, so 4096 buckets end within seven passes whatever the values.
    A target ends where its bucket has one value, or where its rank is the
    first or the last of its bucket.

    ``passes``, if given, gets the number of open targets of each pass. A row
    stands for as many rows as its ``weight`` says, if one is named.
    """
    targets = list(dict.fromkeys(targets))
    cols = list(dict.fromkeys(c for c, _ in targets))
    if pre is None:
        pre = _profile(df, cols)
    # open target -> (lo, hi, rank inside [lo, hi]); lo None: all finite values
    state: dict[tuple[str, int], tuple] = {}
    out: dict[tuple[str, int], float] = {}
    for c, k in targets:
        p = pre[c]
        if not 0 <= k < p["n"]:
            raise ValueError(f"rank {k} out of range for {c} (n={p['n']})")
        if k < p["neg_inf"]:
            out[(c, k)] = -INF
        elif k >= p["n"] - p["pos_inf"]:
            out[(c, k)] = INF
        elif p["fmin"] == p["fmax"]:
            out[(c, k)] = p["fmin"]
        elif 0 < p["fmin"] and p["fmax"] <= 2 * p["fmin"] or p["fmax"] < 0 and p["fmin"] >= 2 * p["fmax"]:
            state[(c, k)] = (p["fmin"], p["fmax"], k - p["neg_inf"])  # narrow enough for equal parts
        else:
            state[(c, k)] = (None, None, k - p["neg_inf"])
    while state:
        if passes is not None:
            passes.append(len(state))
        # targets with the same candidate range share one histogram
        ranges: dict[tuple, list] = {}
        for (c, _), (lo, hi, rank) in state.items():
            ranges.setdefault((c, lo, hi), []).append(rank)
        at = {r: i for i, r in enumerate(ranges)}
        entries = [_bucketed(F.col(c).cast("double"), lo, hi, buckets, at[c, lo, hi]) for c, lo, hi in ranges]
        each = F.col(f"`{weight}`") if weight else F.lit(1)
        hist = (df.select(F.explode(F.array(*entries)).alias("e"), each.cast("long").alias("w")).where(F.col("e").isNotNull())
                .groupBy(F.col("e.t").alias("t"), F.col("e.b").alias("b"))
                .agg(F.sum("w").alias("n"), F.min("e.v").alias("mn"), F.max("e.v").alias("mx")))
        ranks = F.get(F.array(*[F.array(*[F.lit(k).cast("long") for k in sorted(set(ks))]) for ks in ranges.values()]), F.col("t"))
        upto = F.sum("n").over(Window.partitionBy("t").orderBy("b"))
        rows = (hist.withColumn("upto", upto).select("*", F.explode(ranks).alias("k"))
                .where((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n"))).collect())
        found = {(r.t, r.k): r for r in rows}
        for t, (lo, hi, rank) in list(state.items()):
            r = found.get((at[t[0], lo, hi], rank))
            if r is None:  # cannot happen unless the data changed between passes
                raise RuntimeError("input changed between quantile passes; persist it first")
            inside = rank - (r.upto - r.n)
            if r.mn == r.mx or inside in (0, r.n - 1):
                out[t] = r.mn if inside == 0 else r.mx
                state.pop(t)
            else:
                state[t] = (r.mn, r.mx, inside)
    return out


def _bucketed(x: Column, lo: float | None, hi: float | None, buckets: int, t: int) -> Column:
    """Struct (range, bucket, value) of a value inside the range, else NULL.
    Buckets never fall as values rise."""
    if lo is None:
        # exponents run from -1074 to 1023
        power = F.floor(F.log2(F.abs(x))).cast("int") + F.lit(1100)
        b = F.when(x == 0.0, F.lit(0)).when(x > 0.0, power).otherwise(-power)
        inside = ~F.isnan(x) & (F.abs(x) != F.lit(INF))
    else:
        # hi - lo is not 0 where lo < hi, and lo, hi are within one power of two
        b = F.floor((x - dbl(lo)) / dbl(hi - lo) * F.lit(float(buckets))).cast("int")
        b = F.when(b >= buckets, F.lit(buckets - 1)).otherwise(b)
        inside = (x >= dbl(lo)) & (x <= dbl(hi))
    return F.when(inside, F.struct(F.lit(t).alias("t"), b.alias("b"), x.alias("v")))


def _profile(df: DataFrame, cols: Sequence[str], shares: Sequence[float] = (), accuracy: int = 10000) -> dict[str, dict]:
    """Counts and bounds of each column and, if ``shares`` are given, its values there by the sketch; one scan."""
    aggs = []
    for i, c in enumerate(cols):
        x = nan_to_null(F.col(c).cast("double"))
        fin = F.when(F.abs(x) != F.lit(INF), x)
        aggs += [F.count(x).alias(f"n{i}"), F.count(fin).alias(f"f{i}"),
                 F.count_if(x == F.lit(-INF)).alias(f"ni{i}"), F.count_if(x == F.lit(INF)).alias(f"pi{i}"),
                 F.min(fin).alias(f"mn{i}"), F.max(fin).alias(f"mx{i}")]
        if shares:
            aggs.append(F.percentile_approx(x, list(shares), accuracy).alias(f"at{i}"))
    r = df.agg(*aggs).first()
    return {c: {"n": r[f"n{i}"], "n_finite": r[f"f{i}"], "neg_inf": r[f"ni{i}"], "pos_inf": r[f"pi{i}"],
                "fmin": r[f"mn{i}"], "fmax": r[f"mx{i}"], "at": r[f"at{i}"] if shares else None} for i, c in enumerate(cols)}


def _bracketed(df: DataFrame, brackets: dict[tuple, list[int]], passes: list | None = None) -> dict[tuple[str, int], float]:
    """The order statistics that lie in their brackets (column, lo, hi) -> ranks, by one scan.

    Rows are grouped by the values that stand strictly inside a bracket; a row inside none falls into one group, so
    tasks send on about as many rows as stand inside (by the sketch's error, under a thousandth of all for each
    bracket, however often a value repeats). What is below a bracket or equals an end is only counted. A rank
    outside its bracket is left out of the result.
    """
    inner, marks, wide = [], [], []
    for i, (c, lo, hi) in enumerate(brackets):
        x = nan_to_null(F.col(c).cast("double"))
        marks += [F.count_if(x < dbl(lo)).alias(f"b{i}"), F.count_if(x == dbl(lo)).alias(f"l{i}"), F.count_if((x == dbl(hi)) & F.lit(lo < hi)).alias(f"h{i}")]
        if lo < hi:
            inner.append(F.when((x > dbl(lo)) & (x < dbl(hi)), x).alias(f"v{i}"))
            wide.append(i)
    spark, path = df.sparkSession, stage_path(df.sparkSession, f"tables/quantiles-{uuid.uuid4().hex}")
    df.groupBy(*inner).agg(F.count(F.lit(1)).alias("n"), *marks).write.parquet(path)
    try:
        small = spark.read.parquet(path)
        sums = [F.sum(f"{m}{i}").alias(f"{m}{i}") for i in range(len(brackets)) for m in "blh"]
        ends = [a for i in wide for a in (F.sum(F.when(F.col(f"v{i}").isNotNull(), F.col("n"))).alias(f"n{i}"), F.min(f"v{i}").alias(f"mn{i}"), F.max(f"v{i}").alias(f"mx{i}"))]
        r = small.agg(*sums, *ends).first()
        out, inside, pre = {}, {}, {}
        for i, ((c, lo, hi), ranks) in enumerate(brackets.items()):
            n = (r[f"n{i}"] or 0) if i in wide else 0
            pre[f"v{i}"] = {"n": n, "neg_inf": 0, "pos_inf": 0, "fmin": r[f"mn{i}"] if n else None, "fmax": r[f"mx{i}"] if n else None}
            for k in ranks:
                at = k - (r[f"b{i}"] or 0)
                if 0 <= at < r[f"l{i}"]:
                    out[c, k] = lo
                elif r[f"l{i}"] <= at < r[f"l{i}"] + n:
                    inside[f"v{i}", at - r[f"l{i}"]] = (c, k)
                elif r[f"l{i}"] + n <= at < r[f"l{i}"] + n + r[f"h{i}"]:
                    out[c, k] = hi
        if inside:
            got = order_statistics(small, list(inside), pre=pre, passes=passes, weight="n")
            out.update({inside[t]: v for t, v in got.items()})
        return out
    finally:
        drop_stage(spark, path)


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    mode: str = "exact", accuracy: int = 10000) -> dict[str, list[float | None]]:
    """A5: interpolated quantiles (pandas/numpy 'linear', SQL quantile_cont).

    ``mode="exact"`` uses two scans and the distributed order statistics
    above; a rank that the sketch's bracket should miss is searched for in
    the whole table, so the result is exact in any case;
    ``mode="approx"`` uses percentile_approx (one lazy aggregate, rank error
    at most n/accuracy). Columns with no values give None.
    """
    cols = list(dict.fromkeys(cols))
    if mode == "approx":
        r = df.agg(*[F.percentile_approx(nan_to_null(F.col(c).cast("double")), list(probs), accuracy).alias(c)
                     for c in cols]).first()
        return {c: (list(r[c]) if r[c] is not None else [None] * len(probs)) for c in cols}
    if mode != "exact":
        raise ValueError(f"unknown quantile mode {mode!r}")
    slack = 2.0 / accuracy  # the sketch's own error is 1 / accuracy
    shares = [min(max(q + e, 0.0), 1.0) for q in probs for e in (-slack, slack)]
    pre = _profile(df, cols, shares, accuracy)
    targets, plan, brackets = [], {}, {}
    for c in cols:
        n = pre[c]["n"]
        for i, q in enumerate(probs):
            if n == 0:
                plan[(c, q)] = None
                continue
            lo, hi, frac = _ranks(n, q)
            plan[(c, q)] = (lo, hi, frac)
            targets += [(c, lo), (c, hi)]
            brackets.setdefault((c, pre[c]["at"][2 * i], pre[c]["at"][2 * i + 1]), []).extend((lo, hi))
    vals = _bracketed(df, brackets) if brackets else {}
    left = [t for t in targets if t not in vals]
    if left:
        vals.update(order_statistics(df, left, pre=pre))
    res: dict[str, list[float | None]] = {}
    for c in cols:
        res[c] = []
        for q in probs:
            p = plan[(c, q)]
            res[c].append(None if p is None else _interp(vals[(c, p[0])], vals[(c, p[1])], p[2]))
    return res


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float], names: Sequence[str],
                 mode: str = "exact", accuracy: int = 10000) -> DataFrame:
    """The quantiles as a one-row DataFrame with columns ``{col}__{name}``
    (ready for :func:`attach`)."""
    vals = quantile_values(df, cols, probs, mode, accuracy)
    spark = df.sparkSession
    sel = []
    for c in dict.fromkeys(cols):
        for name, v in zip(names, vals[c]):
            sel.append((dbl(v) if v is not None else F.lit(None).cast("double")).alias(stat_name(c, name)))
    return spark.range(1).select(*sel)
