"""The query catalogue: one function per operator group.

Each entry takes (spark, sf_dir) and returns a DataFrame whose columns are
aliased exactly like the matching oracle SQL in ``oracle.py``. Floating
outputs are rounded to 6 decimals (half-up in both engines).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import labels as lab
from ..functions.exprs import dbl
from ..presets import country
from ..presets import customer as cp
from ..session import cut_lineage, stage_path
from ..sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        CATALOG[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    """Output normalisation to 6 decimals as round(x * 1e6) / 1e6 (half away
    from zero on the scaled double), the arithmetic SQL engines use, so
    exact ties at the 7th decimal round the same way everywhere."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x * F.lit(1e6), 0) / F.lit(1e6)


def customer_table(spark: SparkSession, sf: str) -> DataFrame:
    """Fixture C, materialised once: fitting statistics and applying them
    are two passes, and recomputing the line-item aggregation for each
    would scan line items twice. A reliable checkpoint scans them once."""
    return cut_lineage(fx.customer_indicators(spark, sf))


def customer_scored(spark: SparkSession, sf: str) -> DataFrame:
    return feat.engineer(customer_table(spark, sf), [cp.SCORE])[0]


@query("entity_risk_tier")
def entity_risk_tier(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: composite score (X3, X4, X10) -> exact tertile tiers."""
    scored = customer_scored(spark, sf)
    tiers = lab.tier_labels(scored, "stability_score", "stability_label")
    return tiers.select("entity_key", r6("stability_score").alias("stability_score"), "stability_label")


# ---------------------------------------------------------------------------
# Cleaning (X1, P1-P7, A1, A2, P16, K1) on fixture D / customer+nation
# ---------------------------------------------------------------------------
from ..operators import clean as cl  # noqa: E402
from ..sources.tables import table  # noqa: E402

EXCLUDED_NATIONS = ("NATION_3", "NATION_7", "NATION_11", "NATION_19", "NATION_23")
DIRTY_RENAMES = {"bal_txt": "Balance ($)", "pct_txt": "Max Discount (%)", "cnt_txt": "Items/1000",
                 "name_txt": "Customer-Name\n"}
CURATED_MAP = {"Balance ($)": "balance", "Segment Name": "segment"}


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return fx.dirty_strings(spark, sf).select("entity_key", "name_txt", "bal_txt", "pct_txt", "cnt_txt")


@query("clean_numeric_strings")
def clean_numeric_strings(spark, sf):
    d = cl.clean_numeric(dirty(spark, sf), ["bal_txt", "pct_txt", "cnt_txt"])
    return d.select("entity_key", "name_txt", r6("bal_txt").alias("balance"),
                    r6("pct_txt").alias("max_disc_pct"), r6("cnt_txt").alias("items_k"))


@query("detect_numeric_columns")
def detect_numeric_columns(spark, sf):
    return cl.detect_numeric(dirty(spark, sf), exclude=["entity_key"])


@query("normalize_columns")
def normalize_columns(spark, sf):
    d = dirty(spark, sf)
    d = d.select("entity_key", *[F.col(k).alias(v) for k, v in DIRTY_RENAMES.items()])
    d = cl.clean_names(d, CURATED_MAP)
    d = cl.convert_detected(d, exclude=["entity_key"])
    return d.select("entity_key", r6("balance").alias("balance"), r6("Max_Discount_pct").alias("Max_Discount_pct"),
                    r6("Items_1000").alias("Items_1000"), "Customer_Name")


@query("exclude_entities")
def exclude_entities(spark, sf):
    cust = table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"])
    nat = table(spark, sf, "nation", ["n_nationkey", "n_name"])
    ent = cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left").select(
        F.col("c_custkey").alias("entity_key"),
        F.when(F.col("c_custkey") % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name"))
        .alias("nation_name"),
        "c_name", "n_nationkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    ent = cl.drop_columns(ent, ["c_name", "n_nationkey", "c_phone"])
    return cl.exclude_keys(ent, "nation_name", EXCLUDED_NATIONS)


@query("missing_flags")
def missing_flags(spark, sf):
    c = fx.customer_indicators(spark, sf)
    f = cl.missing_flags(c, ["balance", "avg_discount", "revenue"])
    return f.select("entity_key", "balance_is_missing", "avg_discount_is_missing", "revenue_is_missing")


def dirty_parsed(spark, sf):
    return cl.clean_numeric(dirty(spark, sf), ["bal_txt", "pct_txt", "cnt_txt"])


@query("missing_profile")
def missing_profile(spark, sf):
    return cl.missing_profile(dirty_parsed(spark, sf))


@query("missing_total")
def missing_total(spark, sf):
    return cl.missing_total(dirty_parsed(spark, sf))


@query("missing_over_threshold")
def missing_over_threshold(spark, sf):
    return cl.missing_over(cl.missing_profile(fx.customer_indicators(spark, sf)), 10.0, top=10)


# ---------------------------------------------------------------------------
# Moments, quantiles, IQR capping (A4, A5, W2, A10) on fixture L
# ---------------------------------------------------------------------------
from ..operators import stats as st  # noqa: E402

L_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("column_moments")
def column_moments(spark, sf):
    one = st.fit_moments(fx.lineitem_wide(spark, sf), L_COLS, ddof=1, extra=("min", "max", "n"))
    stack = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__sd`, `{c}__min`, `{c}__max`" for c in L_COLS)
    long = one.selectExpr(f"stack({len(L_COLS)}, {stack}) AS (column_name, n, mean, sd, min_value, max_value)")
    return long.select("column_name", F.col("n").cast("long").alias("n"), r6("mean").alias("mean"),
                       r6("sd").alias("sd"), r6("min_value").alias("min_value"), r6("max_value").alias("max_value"))


@query("column_quantiles")
def column_quantiles(spark, sf):
    one = st.quantile_row(fx.lineitem_wide(spark, sf), L_COLS, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    stack = ", ".join(f"'{c}', `{c}__q25`, `{c}__q50`, `{c}__q75`" for c in L_COLS)
    long = one.selectExpr(f"stack({len(L_COLS)}, {stack}) AS (column_name, q25, q50, q75)")
    return long.select("column_name", r6("q25").alias("q25"), r6("q50").alias("q50"), r6("q75").alias("q75"))


def lineitem_keyed(spark, sf):
    return table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", *L_COLS])


@query("iqr_cap")
def iqr_cap(spark, sf):
    li = lineitem_keyed(spark, sf)
    bounds = lab.fit_iqr(li, L_COLS)
    capped = lab.apply_iqr(li, bounds, L_COLS)
    return capped.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in L_COLS])


@query("iqr_cap_counts")
def iqr_cap_counts(spark, sf):
    li = lineitem_keyed(spark, sf)
    out = lab.iqr_cap_counts(li, lab.fit_iqr(li, L_COLS), L_COLS)
    return out.select("column_name", r6("q1").alias("q1"), r6("q3").alias("q3"),
                      r6("lower_bound").alias("lower_bound"), r6("upper_bound").alias("upper_bound"),
                      F.col("n_low").cast("long").alias("n_low"), F.col("n_high").cast("long").alias("n_high"))


# ---------------------------------------------------------------------------
# Feature patterns (X2, X5-X10; F1-F25 patterns) on fixture C
# ---------------------------------------------------------------------------

def customer_featured(spark, sf, features=None):
    c = customer_table(spark, sf)
    return feat.engineer(c, list(cp.PRESET.features) if features is None else features)[0]


def _sel(df, cols):
    return df.select("entity_key", *[r6(c).alias(c) for c in cols])


@query("safe_ratio_features")
def safe_ratio_features(spark, sf):
    return _sel(customer_featured(spark, sf, cp.RATIOS), [f.name for f in cp.RATIOS])


@query("log_abs_gap_features")
def log_abs_gap_features(spark, sf):
    return _sel(customer_featured(spark, sf, cp.LOG_ABS_GAP), [f.name for f in cp.LOG_ABS_GAP])


def _ix(names):
    return [f for f in cp.INDICES if f.name in names]


@query("stress_index")
def stress_index(spark, sf):
    cols = ["stress_index", "pressure_pair"]
    return _sel(customer_featured(spark, sf, list(cp.RATIOS) + _ix(cols)), cols)


@query("pressure_index")
def pressure_index(spark, sf):
    cols = ["pressure_index", "capital_index"]
    return _sel(customer_featured(spark, sf, _ix(cols)), cols)


@query("signed_mean_index")
def signed_mean_index(spark, sf):
    cols = ["health_index", "env_index"]
    return _sel(customer_featured(spark, sf, list(cp.RATIOS) + _ix(cols)), cols)


@query("access_score")
def access_score(spark, sf):
    return _sel(customer_featured(spark, sf, _ix(["access_score"])), ["access_score"])


def customer_labelled(spark, sf):
    """Fixture C with every feature, the score and the tier label (O3)."""
    c = customer_table(spark, sf)
    f = feat.engineer(c, list(cp.PRESET.features) + [cp.SCORE])[0]
    return lab.tier_labels(f, "stability_score", "stability_label")


@query("drop_leaky")
def drop_leaky(spark, sf):
    d = lab.drop_leaky(customer_labelled(spark, sf), cp.PRESET, additional=["entity_key"])
    return d.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])


@query("class_distribution")
def class_distribution(spark, sf):
    tiers = lab.tier_labels(customer_scored(spark, sf), "stability_score", "stability_label")
    return lab.class_distribution(tiers, "stability_label", dict(cp.PRESET.class_labels))


# ---------------------------------------------------------------------------
# Split, folds, weights
# ---------------------------------------------------------------------------
from ..operators import sampling as sm  # noqa: E402
from ..operators import metrics as mt  # noqa: E402


def customer_by_segment(spark, sf):
    return table(spark, sf, "customer", ["c_custkey", "c_mktsegment"]) \
        .select(F.col("c_custkey").alias("entity_key"), F.col("c_mktsegment").alias("label"))


@query("stratified_split")
def stratified_split(spark, sf):
    return sm.stratified_split(customer_by_segment(spark, sf), "label", "entity_key", 0.2, seed=42)


@query("stratified_split_counts")
def stratified_split_counts(spark, sf):
    s = sm.stratified_split(customer_by_segment(spark, sf), "label", "entity_key", 0.2, seed=42)
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_folds")
def stratified_folds(spark, sf):
    s = sm.stratified_split(customer_by_segment(spark, sf), "label", "entity_key", 0.2, seed=42)
    train = cut_lineage(s.where(F.col("split") == "train").drop("split"), "train")
    return sm.stratified_folds(train, "label", "entity_key", k=5, seed=43)


def orders_by_status(spark, sf):
    return table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"]) \
        .select("o_orderkey", F.col("o_orderstatus").alias("label"))


@query("class_weights")
def class_weights(spark, sf):
    w = sm.class_weights(orders_by_status(spark, sf), "label")
    return w.select("label", "n", r6("weight").alias("weight"))


@query("sample_weights")
def sample_weights(spark, sf):
    w = sm.sample_weights(orders_by_status(spark, sf), "label")
    return w.select("o_orderkey", "label", r6("weight").alias("weight"))


# ---------------------------------------------------------------------------
# Metrics over fixture PR
# ---------------------------------------------------------------------------
PR_MODELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _r6_all(df, skip=()):
    return df.select(*[r6(c).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


def pr_counts(spark, sf, keys=("model",)):
    return mt.confusion_counts(fx.predictions(spark, sf), keys)


def pr_metrics(spark, sf):
    return mt.with_registration(mt.model_metrics(pr_counts(spark, sf)), PR_MODELS)


@query("confusion_matrix")
def confusion_matrix(spark, sf):
    return pr_counts(spark, sf).select("model", F.col("label").cast("int").alias("label"),
                                       F.col("prediction").cast("int").alias("prediction"),
                                       F.col("n").cast("long").alias("n"))


@query("model_metrics")
def model_metrics(spark, sf):
    return _r6_all(mt.model_metrics(pr_counts(spark, sf)))


@query("at_risk_recall")
def at_risk_recall(spark, sf):
    m = mt.model_metrics(pr_counts(spark, sf, ("model", "fold")), ("model", "fold"))
    return m.select("model", "fold", r6("at_risk_recall").alias("at_risk_recall"))


@query("class_report")
def class_report(spark, sf):
    return _r6_all(mt.class_report(pr_counts(spark, sf)))


@query("metrics_long")
def metrics_long(spark, sf):
    return _r6_all(mt.metrics_long(mt.model_metrics(pr_counts(spark, sf))))


def pr_cv_summary(spark, sf):
    folds = mt.model_metrics(pr_counts(spark, sf, ("model", "fold")), ("model", "fold"))
    return mt.with_registration(mt.cv_summary(folds), PR_MODELS)


@query("cv_summary")
def cv_summary(spark, sf):
    return _r6_all(pr_cv_summary(spark, sf).drop("registration"))


@query("rank_models")
def rank_models(spark, sf):
    return _r6_all(mt.rank_models(pr_metrics(spark, sf)).select("model", "macro_f1", "rank"))


@query("best_by_cv")
def best_by_cv(spark, sf):
    return _r6_all(mt.best_by_cv(pr_cv_summary(spark, sf)).drop("registration"))


@query("best_on_test")
def best_on_test(spark, sf):
    return _r6_all(mt.best_on_test(pr_metrics(spark, sf)).drop("registration"))


@query("model_summary")
def model_summary(spark, sf):
    return _r6_all(mt.model_summary(pr_metrics(spark, sf)))


# ---------------------------------------------------------------------------
# Scoring and scenarios
# ---------------------------------------------------------------------------
from ..operators import score as sc  # noqa: E402


@query("risk_drivers")
def risk_drivers(spark, sf):
    d = sc.risk_drivers(customer_labelled(spark, sf), cp.RULES, "stability_label", dict(cp.PRESET.default_drivers))
    d = sc.class_info(d, "stability_label", dict(cp.PRESET.class_labels), dict(cp.PRESET.class_text))
    return d.select("entity_key", F.array_join("drivers", " | ").alias("drivers"),
                    F.col("n_drivers_fired").cast("int").alias("n_fired"), "class_name", "class_text")


@query("kpi_bands")
def kpi_bands(spark, sf):
    d = sc.kpi_bands(customer_featured(spark, sf), cp.BANDS)
    return d.select("entity_key", *[b.name for b in cp.BANDS])


@query("top_values_per_row")
def top_values_per_row(spark, sf):
    d = sc.top_values(customer_featured(spark, sf, cp.RATIOS), cp.TOP_VALUE_FEATURES, 12)
    return d.select("entity_key", F.array_join("top_features", ",").alias("top_features"))


@query("scenario_delta")
def scenario_delta(spark, sf):
    c = customer_table(spark, sf)
    stats = feat.fit_z_stats(c, feat.z_sources(c.columns, [cp.SCORE]))
    base = feat.engineer(c, [cp.SCORE], stats=stats)[0].withColumnRenamed("stability_score", "base_score")
    fan = sc.apply_scenarios(base, cp.SCENARIOS, cp.TOP_VALUE_COLUMNS)
    scored = feat.engineer(fan, [cp.SCORE], stats=stats)[0]
    return scored.select("entity_key", "scenario", r6("stability_score").alias("score"),
                         r6(F.col("stability_score") - F.col("base_score")).alias("delta"))


@query("range_violations")
def range_violations(spark, sf):
    d = sc.validate_ranges(fx.customer_indicators(spark, sf), cp.RANGES)
    return d.select("entity_key", F.array_join("violations", ",").alias("violations"),
                    F.size("violations").cast("int").alias("n_violations"),
                    *[r6(r.column).alias(r.column) for r in cp.RANGES])


@query("serving_linear_features")
def serving_linear_features(spark, sf):
    d = sc.serving_linear(customer_featured(spark, sf, cp.RATIOS), cp.SERVING_LINEAR, cp.SERVING_DEFAULTS)
    return d.select("entity_key", *[r6(n).alias(n) for n, _, _ in cp.SERVING_LINEAR])


def _country_inputs(spark, sf):
    """The 22 scoring inputs for every customer: each input's default, scaled by the customer's balance."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    scale = F.abs(F.col("c_acctbal").cast("double")) / dbl(10000.0) + dbl(0.5)
    return c.select(F.col("c_custkey").alias("entity_key"), *[(scale * dbl(r.default)).alias(r.column) for r in country.RANGES])


@query("serving_features")
def serving_features(spark, sf):
    d = sc.serving_features(_country_inputs(spark, sf), country.LEVEL1, country.SERVING_LINEAR, dict(country.SERVING_DEFAULTS))
    names = [f.name for f in country.LEVEL1] + [n for n, _, _ in country.SERVING_LINEAR]
    return d.select("entity_key", *[r6(n).alias(n) for n in names])


@query("align_features")
def align_features(spark, sf):
    d = sc.align_features(customer_featured(spark, sf, cp.RATIOS + cp.LOG_ABS_GAP), cp.ALIGN_FEATURES,
                          keep=["entity_key"])
    return d.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])


# ---------------------------------------------------------------------------
# Preprocessing fits (T1-T4) and models
# ---------------------------------------------------------------------------
from ..operators import compiled as cm  # noqa: E402
from ..operators import ml  # noqa: E402

IMPUTE_COLS = ("balance", "avg_discount", "revenue", "returned_share")


@query("impute_median_scale")
def impute_median_scale(spark, sf):
    c = customer_table(spark, sf)
    stats = ml.fit_impute_scale(c, IMPUTE_COLS)
    out = ml.apply_impute_scale(c, stats, IMPUTE_COLS)
    return out.select("entity_key", *[r6(x).alias(x) for x in IMPUTE_COLS])


def orders_priority_with_nulls(spark, sf):
    o = table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, F.lit(None).cast("string"))
                    .otherwise(F.col("o_orderpriority")).alias("priority"))


@query("impute_mode_onehot")
def impute_mode_onehot(spark, sf):
    o = orders_priority_with_nulls(spark, sf)
    mode = ml.fit_modes(o, ["priority"]).where(F.col("column_name") == "priority") \
        .select(F.col("mode").alias("priority__mode"))
    imp = st.attach(o, mode).withColumn("priority", F.coalesce("priority", "priority__mode")).drop("priority__mode")
    cats = ml.categories(imp, "priority")
    return imp.withColumns(ml.one_hot_columns("priority", cats))


def model_frame(spark, sf):
    """Labelled customer rows split 80/20 (W3) for model training."""
    lab_df = customer_labelled(spark, sf)
    return sm.stratified_split(lab_df, "stability_label", "entity_key", cp.PRESET.test_fraction, cp.PRESET.seed)


def _models():
    return ml.registry(ml.ModelParams(**cp.MODEL_PARAMS))


def trained(spark, sf):
    split = cut_lineage(model_frame(spark, sf))
    train = ml.prepare(split.where("split = 'train'"), "stability_label")
    test = ml.prepare(split.where("split = 'test'"), "stability_label")
    models = ml.fit_all(train, cp.MODEL_FEATURES, cp.MODEL_CATEGORICAL, _models())
    return models, train, test


def trained_one(spark, sf, name):
    """One model, fitted on the train customers, and all customers."""
    split = cut_lineage(model_frame(spark, sf))
    everyone = ml.prepare(split, "stability_label")
    models = ml.fit_all(everyone.where("split = 'train'"), cp.MODEL_FEATURES, cp.MODEL_CATEGORICAL, {name: _models()[name]})
    return models[name], everyone


def _scored_union(models, test):
    """Every model's scores from its compiled tables, as projections of the same rows."""
    rows = test.select("entity_key", "label", *cp.MODEL_FEATURES, *cp.MODEL_CATEGORICAL)
    out = None
    for name, m in models.items():
        s = cm.score(rows, cm.compile_model(m)).select("entity_key", "label", "prediction", "confidence").withColumn("model", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out


@query("train_and_score")
def train_and_score(spark, sf):
    models, _, test = trained(spark, sf)
    s = _scored_union(models, test)
    return s.select("model", "entity_key", F.col("label").cast("int").alias("label"), "prediction",
                    r6("confidence").alias("confidence"))


@query("test_metrics")
def test_metrics(spark, sf):
    models, _, test = trained(spark, sf)
    s = _scored_union(models, test).select("model", F.col("label").cast("int").alias("label"), "prediction")
    m = mt.with_registration(mt.model_metrics(mt.confusion_counts(s)), cp.MODEL_REGISTRATION)
    return _r6_all(mt.rank_models(m))


@query("cv_metrics")
def cv_metrics(spark, sf):
    split = cut_lineage(model_frame(spark, sf))
    train = ml.prepare(split.where("split = 'train'"), "stability_label")
    preds = ml.cross_validate(train, "entity_key", cp.MODEL_FEATURES, cp.MODEL_CATEGORICAL, _models(),
                              k=cp.PRESET.n_folds)
    return _r6_all(ml.cv_metrics(preds, cp.MODEL_REGISTRATION))


@query("feature_importance")
def feature_importance(spark, sf, top_n: int = 15):
    models, _, _ = trained(spark, sf)
    out = None
    for name, m in models.items():
        top = cm.top_features(spark, cm.compile_model(m), top_n).withColumn("model", F.lit(name))
        out = top if out is None else out.unionByName(top)
    return out.select("model", "feature", r6("importance").alias("importance"), "rank")


@query("class_probabilities")
def class_probabilities(spark, sf):
    model, everyone = trained_one(spark, sf, "LogisticRegression")
    s = cm.score(everyone, cm.compile_model(model))
    return ml.class_probabilities(s, ["entity_key"]).withColumn("probability", r6("probability"))


# ---------------------------------------------------------------------------
# Streaming rescoring (M9)
# ---------------------------------------------------------------------------
from ..streaming import score_stream as ss  # noqa: E402


@query("stream_score")
def stream_score(spark, sf):
    out = ss.score_events(spark, sf)
    return out.select("event_id", "event_type", r6("value").alias("value"), r6("z_value").alias("z_value"), "level")


def customer_versions(spark, sf) -> str:
    """A feed of customer versions in three files: every customer, then changed ones (every third), then a replay of
    first versions (every fifth), as a folder to stream from."""
    c = customer_table(spark, sf)
    hour = lambda n: F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * n))
    first = c.withColumns({"version": F.lit(1).cast("long"), "changed_at": hour(0)})
    second = first.where("entity_key % 3 = 0").withColumns({"balance": F.col("balance") + dbl(1000.0), "revenue": F.col("revenue") * dbl(1.5), "version": F.lit(2).cast("long"), "changed_at": hour(1)})
    at = stage_path(spark, f"versions-{uuid.uuid4().hex}")
    for part in (first, second, first.where("entity_key % 5 = 0")):
        part.coalesce(1).write.mode("append").parquet(at)
    return at


def tier_scorer(spark, sf):
    """Scoring with saved statistics: the z-score statistics and tier cuts fitted on the customers, written and read
    back, give each micro-batch its composite score and risk tier."""
    c = customer_table(spark, sf)
    scored, stats = feat.engineer(c, [cp.SCORE])
    stats = cut_lineage(stats, "saved_stats")
    cuts = cut_lineage(lab.tier_cuts(lab.drop_unscored(scored, "stability_score"), "stability_score"), "saved_cuts")

    def score(batch):
        s = feat.engineer(batch, [cp.SCORE], stats=stats)[0]
        return lab.tier_labels(s, "stability_score", "stability_label", cuts=cuts, materialize=False)
    return score


@query("stream_tiers")
def stream_tiers(spark, sf):
    """M9 with saved statistics and state: the newest version of each customer, scored on the stream."""
    at = customer_versions(spark, sf)
    feed = spark.readStream.schema(spark.read.parquet(at).schema).option("maxFilesPerTrigger", 1).parquet(at)
    out = ss.rescore_stream(feed, tier_scorer(spark, sf), stage_path(spark, f"tiers-{uuid.uuid4().hex}"))
    return out.select("entity_key", F.col("version").cast("int").alias("version"), r6("stability_score").alias("stability_score"), "stability_label")


@query("scenario_rescore")
def scenario_rescore(spark, sf):
    """M7 with the model: what-if scenarios on all customers, rescored
    by the trained logistic regression, against each customer's base."""
    model, everyone = trained_one(spark, sf, "LogisticRegression")
    compiled = cm.compile_model(model)
    recompute = feat.level1_exprs(everyone.columns, list(cp.RATIOS + cp.LOG_ABS_GAP))
    out = sc.scenario_rescore(everyone, cp.MODEL_SCENARIOS, cp.SCENARIO_COLUMNS, recompute, lambda df, prefix: cm.score(df, compiled, prefix))
    return out.select("entity_key", "scenario", "prediction", r6("confidence").alias("confidence"),
                      F.col("class_change").cast("int").alias("class_change"),
                      r6("confidence_delta").alias("confidence_delta"))


# ---------------------------------------------------------------------------
# The flow from a raw file, stage by stage, and the stored evaluation
# ---------------------------------------------------------------------------
from ..sources import tables as tb  # noqa: E402
from . import flow  # noqa: E402
from .store import MetricStore, StageStore  # noqa: E402


def raw_file(spark, sf) -> str:
    """Fixture R written as raw CSV files (S4), every field quoted."""
    path = stage_path(spark, f"raw-{uuid.uuid4().hex}")
    tb.write_raw_csv(fx.raw_customer_text(spark, sf), path)
    return path


def flow_stages(spark, sf) -> dict:
    """The data stages over the raw file, each read back from its committed table."""
    store = StageStore(spark, stage_path(spark, f"flow-{uuid.uuid4().hex}"))
    return flow.data_stages(spark, raw_file(spark, sf), cp.RAW_PRESET, store)


@query("flow_raw")
def flow_raw(spark, sf):
    """The raw file read back as text: missing tokens are null, nothing is parsed yet."""
    raw = tb.read_raw_csv(spark, raw_file(spark, sf))
    return raw.select("entity_key", *[F.col(f"`{c}`").isNull().cast("int").alias(n) for c, n in (("Balance ($)", "no_balance"), ("Avg Discount", "no_discount"), ("Segment Name", "no_segment"))],
                      F.col("`Balance ($)`").alias("balance_text"), F.col("Notes").alias("notes"))


@query("flow_cleaned")
def flow_cleaned(spark, sf):
    """O2, S3: the cleaned stage: totals row and unused column gone, names and numbers clean, flags set."""
    d = flow_stages(spark, sf)["cleaned"]
    return d.select(F.col("entity_key").cast("long").alias("entity_key"), "segment", F.col("nation_key").cast("int").alias("nation_key"),
                    *[r6(c).alias(c) for c in cp.TOP_VALUE_COLUMNS], "balance_is_missing", "avg_discount_is_missing")


@query("flow_model_ready")
def flow_model_ready(spark, sf):
    """O1 before the models: labelled, leaky columns dropped (P11), read from its stage."""
    d = flow_stages(spark, sf)["model_ready"]
    num, _ = flow.model_columns(d, cp.RAW_PRESET)
    return d.select(F.col("entity_key").cast("long").alias("entity_key"), "segment", *[r6(c).alias(c) for c in num], "stability_label")


@query("flow_feature_types")
def flow_feature_types(spark, sf):
    """The model's columns by type, with how many rows have each (S9: the names come as in-memory rows)."""
    d = flow_stages(spark, sf)["model_ready"]
    num, cat = flow.model_columns(d, cp.RAW_PRESET)
    kinds = tb.from_rows(spark, [(c, "numeric") for c in num] + [(c, "categorical") for c in cat], "column_name string, kind string")
    filled = d.agg(*[F.count(c).alias(c) for c in num + cat]).unpivot([], num + cat, "column_name", "n_values")
    return kinds.join(F.broadcast(filled), "column_name")


@query("flow_split")
def flow_split(spark, sf):
    """W3 and P12 on the flow's labels, with the decision whether to stratify."""
    d = flow_stages(spark, sf)["split"]
    return d.select(F.col("entity_key").cast("long").alias("entity_key"), "stability_label", "split")


def stored_evaluation(spark, sf) -> MetricStore:
    """E10 for three runs over the predictions; the first is written twice and keeps its last rows only."""
    store = MetricStore(spark, stage_path(spark, f"evaluation-{uuid.uuid4().hex}"))
    pr = fx.predictions(spark, sf)
    flow.evaluate(pr.where("fold <> 0"), PR_MODELS, store, "all")
    flow.evaluate(pr, PR_MODELS, store, "all")
    flow.evaluate(pr.where("fold = 0"), PR_MODELS, store, "fold 0")
    return store


@query("stored_confusion_grid")
def stored_confusion_grid(spark, sf):
    g = stored_evaluation(spark, sf).table("confusion_grid")
    return g.select("run", "model", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), "n")


@query("stored_metrics")
def stored_metrics(spark, sf):
    return _r6_all(stored_evaluation(spark, sf).table("metrics").drop("registration"))


@query("stored_class_report")
def stored_class_report(spark, sf):
    return _r6_all(stored_evaluation(spark, sf).table("class_report"))


@query("stored_summary")
def stored_summary(spark, sf):
    return _r6_all(stored_evaluation(spark, sf).table("summary"))


@query("report_text")
def report_text(spark, sf):
    """The lines of the text report of all rows, read back from the text."""
    return stored_evaluation(spark, sf).text("report_text", "all").select(F.col("value").alias("line"))


# ---------------------------------------------------------------------------
# Encoding of columns with any number of categories
# ---------------------------------------------------------------------------
from ..operators import encoding as en  # noqa: E402

LOT_COLUMNS = ("lot", "returned")


def lots(spark, sf):
    """Line items with a column of many categories (the lot) and one of few, each with missing values."""
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"])
    lot = F.concat_ws("-", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int"))
    missing = F.col("l_orderkey") % 9 == 0
    return li.select("l_orderkey", "l_linenumber", F.when(~missing, lot).alias("lot"), F.when(~missing, F.col("l_returnflag")).alias("returned"))


@query("category_ordinals")
def category_ordinals(spark, sf):
    return en.fit_dictionary(lots(spark, sf), LOT_COLUMNS)


@query("sparse_one_hot")
def sparse_one_hot(spark, sf):
    """Modes fill missing values; the places of a row's ones over both columns."""
    d = cut_lineage(lots(spark, sf))
    out = en.slots(d, en.fit_dictionary(d, LOT_COLUMNS), LOT_COLUMNS, fill=True)
    return out.select("l_orderkey", "l_linenumber", F.concat_ws(",", F.transform("slots", lambda s: s.cast("string"))).alias("slots"))


# ---------------------------------------------------------------------------
# Boosted trees with a softmax loss at the reference's full size
# ---------------------------------------------------------------------------
from ..operators import boosting as bo  # noqa: E402


@query("boosted_softmax")
def boosted_softmax(spark, sf):
    """300 rounds of depth 4 on the train customers; every customer is scored."""
    everyone = ml.prepare(cut_lineage(model_frame(spark, sf)), "stability_label")
    train = cut_lineage(ml.with_weights(everyone.where("split = 'train'")))
    model = bo.fit_softmax(train, cp.MODEL_FEATURES, cp.MODEL_CATEGORICAL, key="entity_key")
    s = cm.score(everyone, model)
    return s.select("entity_key", "split", F.col("label").cast("int").alias("label"), "prediction", r6("confidence").alias("confidence"))
