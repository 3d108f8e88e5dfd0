"""Scoring, scenarios and rule-based explanations.

All row-wise: native Column expressions, arrays and higher-order functions;
no UDFs, no shuffles. Scenario fan-out uses ``explode`` of a literal array
(linear in rows x scenarios), not a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import band, dbl, lookup
from ..specs import BandSpec, RangeSpec, RuleSpec
from .features import level1_exprs


# ---- M5 / M6 / K7: risk drivers -----------------------------------------

def _rule_cond(r: RuleSpec) -> Column:
    x = F.coalesce(F.col(r.column).cast("double"), dbl(r.absent_as))
    if r.op == ">":
        return x > dbl(r.threshold)
    if r.op == "<":
        return x < dbl(r.threshold)
    raise ValueError(f"unsupported rule op {r.op!r}")


def risk_drivers(df: DataFrame, rules: Sequence[RuleSpec], class_col: str,
                 defaults: Mapping[int, str], max_drivers: int = 4, out: str = "drivers") -> DataFrame:
    """Messages of the rules that fire, in rule order, first ``max_drivers``;
    a class default when none fires. Rules on absent columns are skipped at
    plan time (the value then counts as ``absent_as``)."""
    have = set(df.columns)
    msgs = []
    for r in rules:
        cond = _rule_cond(r) if r.column in have else (
            F.lit(r.absent_as > r.threshold if r.op == ">" else r.absent_as < r.threshold))
        msgs.append(F.when(cond, F.lit(r.message)))
    fired = F.filter(F.array(*msgs), lambda m: m.isNotNull()) if msgs else F.array().cast("array<string>")
    default = F.array(lookup(class_col, dict(defaults), ""))
    chosen = F.when(F.size(fired) == 0, default).otherwise(fired)
    return df.withColumn(out, F.slice(chosen, 1, max_drivers)).withColumn(f"n_{out}_fired", F.size(fired))


# ---- M3 / X11: KPI bands ------------------------------------------------

def kpi_bands(df: DataFrame, bands: Sequence[BandSpec]) -> DataFrame:
    todo = {b.name: band(b.source, b.cuts, b.otherwise, b.descending) for b in bands if b.source in df.columns}
    return df.withColumns(todo) if todo else df


# ---- K8: largest values of a row ----------------------------------------

def top_values(df: DataFrame, cols: Sequence[str], n: int, out: str = "top_features") -> DataFrame:
    """The names of the ``n`` largest non-null values among ``cols`` in each
    row (value desc, name asc), as an array."""
    arr = F.array(*[F.struct(F.col(c).cast("double").alias("v"), F.lit(c).alias("k")) for c in cols])
    arr = F.filter(arr, lambda e: e["v"].isNotNull())

    def cmp(a, b):
        return (F.when(a["v"] > b["v"], -1).when(a["v"] < b["v"], 1)
                .when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
    ranked = F.array_sort(arr, cmp)
    return df.withColumn(out, F.transform(F.slice(ranked, 1, n), lambda e: e["k"]))


# ---- M7: scenarios ------------------------------------------------------

def apply_scenarios(df: DataFrame, scenarios: Sequence[Mapping], columns: Sequence[str],
                    scenario_col: str = "scenario") -> DataFrame:
    """Fan every row out to each scenario and apply its overrides.

    A scenario is {"scenario": name, "changes": [(column, op, amount), ...]}
    with op in set / mul / add. The scenario list is configuration (small,
    bounded); each row becomes len(scenarios) rows via explode.
    """
    names = [s["scenario"] for s in scenarios]
    d = df.withColumn(scenario_col, F.explode(F.array(*[F.lit(n) for n in names])))
    changes: dict[str, Column] = {}
    for c in columns:
        expr = F.col(c)
        touched = False
        for s in scenarios:
            for col_name, op, amount in s.get("changes", ()):
                if col_name != c:
                    continue
                a = dbl(amount)
                new = a if op == "set" else (F.col(c) * a if op == "mul" else F.col(c) + a)
                expr = F.when(F.col(scenario_col) == s["scenario"], new).otherwise(expr)
                touched = True
        if touched:
            changes[c] = expr
    return d.withColumns(changes) if changes else d


# ---- M8: range validation -----------------------------------------------

def validate_ranges(df: DataFrame, ranges: Sequence[RangeSpec], fill_defaults: bool = True,
                    out: str = "violations") -> DataFrame:
    """Per row the names of the inputs outside their range, and missing
    inputs replaced by their defaults."""
    rs = [r for r in ranges if r.column in df.columns]
    viol = F.array(*[F.when((F.col(r.column) < dbl(r.low)) | (F.col(r.column) > dbl(r.high)), F.lit(r.column))
                     for r in rs])
    d = df.withColumn(out, F.filter(viol, lambda v: v.isNotNull()) if rs else F.array().cast("array<string>"))
    if fill_defaults:
        d = d.withColumns({r.column: F.coalesce(F.col(r.column).cast("double"), dbl(r.default)) for r in rs})
    return d


# ---- P14: align to a model's feature list --------------------------------

def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
                   flag_suffix: str = "_is_missing") -> DataFrame:
    """Select the model's features in order; absent features become 0.0
    (missing-flag features become INT 0)."""
    have = set(df.columns)
    sel = [F.col(k) for k in keep]
    for f in features:
        if f in have:
            sel.append(F.col(f))
        elif f.endswith(flag_suffix):
            sel.append(F.lit(0).alias(f))
        else:
            sel.append(dbl(0.0).alias(f))
    return df.select(*sel)


# ---- F27: serving formulas with literal coefficients ---------------------

def serving_linear(df: DataFrame, formulas: Sequence[tuple], defaults: Mapping[str, float] = {}) -> DataFrame:
    """Each formula (name, ((column, coef), ...), divisor) becomes
    sum(coef * x) / divisor; columns listed in ``defaults`` fill their
    missing values (absent columns take the default too)."""
    have = set(df.columns)
    out: dict[str, Column] = {}
    for name, terms, divisor in formulas:
        total = None
        for c, coef in terms:
            if c in have or c in out:
                x = out.get(c, F.col(c))
                if c in defaults:
                    x = F.coalesce(x, dbl(defaults[c]))
            elif c in defaults:
                x = dbl(defaults[c])
            else:
                total = None
                break
            term = x * dbl(coef)
            total = term if total is None else total + term
        if total is not None:
            out[name] = total / dbl(divisor)
    return df.withColumns(out) if out else df


def serving_features(df: DataFrame, level1: Sequence, formulas: Sequence[tuple],
                     defaults: Mapping[str, float] = {}) -> DataFrame:
    """every serving feature of raw indicator rows. Inputs that are
    absent or missing take their default before any feature reads them, so
    ratios and gaps over them are computed too; absent ones are not kept."""
    absent = [c for c in defaults if c not in df.columns]
    filled = df.withColumns({c: dbl(v) if c in absent else F.coalesce(F.col(c).cast("double"), dbl(v))
                             for c, v in defaults.items()}) if defaults else df
    featured = filled.withColumns(level1_exprs(filled.columns, level1))
    return serving_linear(featured, formulas).drop(*absent)


# ---- M1 / M2 / M4: model outputs -----------------------------------------

def class_info(df: DataFrame, class_col: str, names: Mapping[int, str], texts: Mapping[int, str]) -> DataFrame:
    """P15 + M4: display label and description per class, 'Unknown' default."""
    return df.withColumns({"class_name": lookup(class_col, dict(names)),
                           "class_text": lookup(class_col, dict(texts))})


def scenario_rescore(base: DataFrame, scenarios: Sequence[Mapping], columns: Sequence[str],
                     recompute: Mapping[str, Column], score_fn) -> DataFrame:
    """M7 end to end: score each row as it is, fan it out to the scenarios, apply the overrides, recompute the
    derived features, rescore, and compare with the row's own base score. ``score_fn(df, prefix)`` adds the columns
    prediction, probabilities and confidence under a prefix and keeps the others, so base and scenario scores stand
    in one row: a projection, without a window or a shuffle. The first scenario need not be the unchanged one."""
    fan = apply_scenarios(score_fn(base, "__base_"), scenarios, columns)
    scored = score_fn(fan.withColumns(dict(recompute)) if recompute else fan, "")
    return scored.withColumns({"class_change": F.col("prediction") - F.col("__base_prediction"),
                               "confidence_delta": F.col("confidence") - F.col("__base_confidence")}) \
        .drop("__base_prediction", "__base_probabilities", "__base_confidence")
