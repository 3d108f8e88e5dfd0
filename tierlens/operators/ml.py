"""Preprocessing, models, cross-validation, importances, scoring (T1-T18,
E6, E7, M1, M2, S7, S8) on Spark ML.

Preprocessing statistics are exact DataFrame aggregates (medians by the
distributed order statistics, population std like scikit-learn's scaler)
and are frozen into a ``SQLTransformer`` stage, so the fitted pipeline
persists and reloads as one ``PipelineModel`` and applies the very same
values at serving time.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import dbl
from . import metrics as mt
from .encoding import value_counts
from .sampling import sample_weights, stratified_folds
from .stats import attach, quantile_row, stat_name
from ..session import cut_lineage


# ---- T1 / T2: median imputation + standard scaling -----------------------

def fit_impute_scale(df: DataFrame, cols: Sequence[str], mode: str = "exact") -> DataFrame:
    """One row: exact median per column, then mean and population std of
    the imputed column."""
    cols = list(cols)
    src = df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        med = quantile_row(src, cols, [0.5], ["med"], mode)
    finally:
        src.unpersist()
    imputed = attach(df.select(*cols), med).select(
        *[F.coalesce(F.col(c).cast("double"), F.col(stat_name(c, "med"))).alias(c) for c in cols])
    mom = imputed.agg(*[a for c in cols for a in (F.avg(c).alias(stat_name(c, "mean")),
                                                   F.stddev_pop(c).alias(stat_name(c, "sd")))])
    return attach(mom, med)


def impute_scale_exprs(cols: Sequence[str]) -> dict:
    out = {}
    for c in cols:
        sd = F.col(stat_name(c, "sd"))
        scale = F.when(sd.isNull() | (sd == 0), dbl(1.0)).otherwise(sd)
        out[c] = (F.coalesce(F.col(c).cast("double"), F.col(stat_name(c, "med"))) - F.col(stat_name(c, "mean"))) / scale
    return out


def apply_impute_scale(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    return attach(df, stats).withColumns(impute_scale_exprs(cols)).drop(*stats.columns)


# ---- T3 / T4: mode imputation + one-hot ----------------------------------

def fit_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column (ties: smallest value).

    Each column is counted on its own, then ``min_by(value, (-count, value))`` per column - an aggregate, so no
    row is multiplied and no column's values are ever sorted in one task.
    """
    counts = value_counts(df, cols)
    return counts.groupBy("column_name").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"),
        F.max("n").alias("mode_count"))


MAX_CATEGORIES = 10_000


def categories(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct categories of a column: the one-hot vocabulary, read
    by the driver (as StringIndexer does). At most ``max_categories + 1``
    rows are ever fetched; a larger vocabulary is an error, not a silent cut: it makes
    too many plain columns, and ``encoding`` encodes it as ordinals, slots or sparse vectors."""
    got = [r[0] for r in df.select(F.col(col).cast("string")).where(F.col(col).isNotNull()).distinct()
           .limit(max_categories + 1).collect()]
    if len(got) > max_categories:
        raise ValueError(f"{col}: more than {max_categories} categories; one-hot encoding is not meaningful")
    return sorted(got)


def one_hot_columns(col: str, cats: Sequence[str], prefix: str | None = None) -> dict:
    """T4 as plain columns: one INT column per known category; an unseen or
    missing value is all zeros (handle_unknown='ignore')."""
    p = prefix or col
    return {f"{p}_{v}": (F.col(col).cast("string") == F.lit(v)).cast("int") for v in cats}


# ---- T5 / T6: preprocessing pipeline -------------------------------------

def _lit(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "CAST(NULL AS DOUBLE)"
    return f"CAST({float(v)!r} AS DOUBLE)"


def preprocessing_stages(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                         features_col: str = "features") -> list:
    """Fitted stages: SQLTransformer (exact medians / means / stds and
    modes frozen as literals) -> StringIndexer(keep) -> OneHotEncoder
    (dropLast, so an unseen category is all zeros) -> VectorAssembler."""
    numeric, categorical = list(numeric), list(categorical)
    sel = ["*"]
    if numeric:
        st = fit_impute_scale(train, numeric).first().asDict()  # one row of fitted numbers
        for c in numeric:
            sd = st[stat_name(c, "sd")]
            scale = 1.0 if sd is None or sd == 0 else sd
            sel.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {_lit(st[stat_name(c, 'med')])}) - "
                       f"{_lit(st[stat_name(c, 'mean')])}) / {_lit(scale)} AS `{c}__num`")
    idx_out = []
    if categorical:
        modes = {r["column_name"]: r["mode"] for r in fit_modes(train, categorical).collect()}
        for c in categorical:
            m = modes.get(c)
            fill = "NULL" if m is None else "'" + m.replace("'", "''") + "'"
            sel.append(f"coalesce(CAST(`{c}` AS STRING), {fill}) AS `{c}__cat`")
            idx_out.append(c)
    stages: list = [SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")]
    if idx_out:
        stages.append(StringIndexer(inputCols=[f"{c}__cat" for c in idx_out], outputCols=[f"{c}__idx" for c in idx_out],
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in idx_out], outputCols=[f"{c}__ohe" for c in idx_out],
                                    dropLast=True, handleInvalid="error"))  # the indexer's extra last index is dropped
    stages.append(VectorAssembler(inputCols=[f"{c}__num" for c in numeric] + [f"{c}__ohe" for c in idx_out],
                                  outputCol=features_col, handleInvalid="keep"))
    return stages


# ---- T7-T11: model registry -----------------------------------------------

@dataclass(frozen=True)
class ModelParams:
    lr_c: float = 1.0
    lr_max_iter: int = 1000
    rf_trees: int = 200
    rf_depth: int = 10
    rf_min_leaf: int = 5
    gbt_rounds: int = 300
    gbt_depth: int = 4
    gbt_step: float = 0.05
    gbt_subsample: float = 0.8
    gbt_colsample: str = "0.8"
    gbt_min_child: int = 5
    gbt_min_gain: float = 0.1
    seed: int = 42


def registry(p: ModelParams) -> dict[str, Callable[[int], Estimator]]:
    """Name -> factory(n_train). All models train with weightCol."""
    def lr(n: int) -> Estimator:
        # scikit-learn's L2 objective sum(w*loss) + ||b||^2 / (2C), divided by
        # sum(w) = n under balanced weights, is Spark's regParam = 1 / (C n).
        return LogisticRegression(family="multinomial", elasticNetParam=0.0, regParam=1.0 / (p.lr_c * max(n, 1)),
                                  standardization=False, maxIter=p.lr_max_iter, weightCol="weight")

    def rf(n: int) -> Estimator:
        return RandomForestClassifier(numTrees=p.rf_trees, maxDepth=p.rf_depth, minInstancesPerNode=p.rf_min_leaf,
                                      featureSubsetStrategy="sqrt", seed=p.seed, weightCol="weight")

    def gbt(n: int) -> Estimator:
        base = GBTClassifier(maxIter=p.gbt_rounds, maxDepth=p.gbt_depth, stepSize=p.gbt_step,
                             subsamplingRate=p.gbt_subsample, featureSubsetStrategy=p.gbt_colsample,
                             minInstancesPerNode=p.gbt_min_child, minInfoGain=p.gbt_min_gain, seed=p.seed,
                             weightCol="weight")
        return OneVsRest(classifier=base, weightCol="weight")
    models: dict[str, Callable[[int], Estimator]] = {"LogisticRegression": lr, "RandomForest": rf,
                                                      "BoostedTrees": gbt}
    try:  # T10: an optional distributed XGBoost, used only when installed
        from xgboost.spark import SparkXGBClassifier  # type: ignore
        models["XGBoost"] = lambda n: SparkXGBClassifier(
            n_estimators=p.gbt_rounds, max_depth=p.gbt_depth, learning_rate=p.gbt_step, subsample=p.gbt_subsample,
            colsample_bytree=float(p.gbt_colsample), min_child_weight=p.gbt_min_child, gamma=p.gbt_min_gain,
            reg_alpha=0.1, reg_lambda=1.0, weight_col="weight", features_col="features", label_col="label")
    except ImportError:
        pass
    return models


# ---- T12 / T13: fitting ----------------------------------------------------

def with_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """A8 with balanced weights of this very frame (recomputed per fold)."""
    return sample_weights(df, label)


def prepare(df: DataFrame, label_col: str) -> DataFrame:
    return df.withColumn("label", F.col(label_col).cast("double"))


def fit_prepared(train_w: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 models: Mapping[str, Callable], n_train: int, max_parallel: int = 3):
    """Fit the preprocessing ONCE, cache the assembled (features, label,
    weight) rows, and fit every classifier on them concurrently. Each result
    is a self-contained PipelineModel (preprocessing stages + classifier).
    Returns (models, errors)."""
    prep = Pipeline(stages=preprocessing_stages(train_w, numeric, categorical)).fit(train_w)
    feats = prep.transform(train_w).select("features", "label", "weight").persist(StorageLevel.MEMORY_AND_DISK)
    out, errors = {}, {}

    def run(item):
        name, factory = item
        try:
            return name, PipelineModel(stages=[*prep.stages, factory(n_train).fit(feats)]), None
        except Exception as e:  # noqa: BLE001 - a failing model is skipped, as in the reference
            return name, None, e
    try:
        with ThreadPoolExecutor(max_workers=max_parallel) as ex:
            for name, model, err in ex.map(run, models.items()):
                if err is None:
                    out[name] = model
                else:
                    errors[name] = err
    finally:
        feats.unpersist()
    return out, errors


def fit_one(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], factory,
            n_train: int | None = None) -> PipelineModel:
    """Preprocessing + classifier as one PipelineModel."""
    n = n_train if n_train is not None else train.count()
    models, errors = fit_prepared(train, numeric, categorical, {"m": factory}, n, 1)
    if "m" not in models:
        raise errors["m"]
    return models["m"]


def fit_all(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
            models: Mapping[str, Callable], max_parallel: int = 3) -> dict[str, PipelineModel]:
    """Fit every registered model on one weighted train set; failures
    are reported and skipped; raises when none succeeds."""
    # stage boundary: the weighted train set is written once (shared
    # checkpoint dir) so the estimators' many passes read a plain scan
    tr = cut_lineage(with_weights(train))
    out, errors = fit_prepared(tr, numeric, categorical, models, tr.count(), max_parallel)
    if not out:
        raise RuntimeError(f"no model could be trained: {errors}")
    for name, error in dict(errors).items():
        warnings.warn(f"{name} could not be trained: {error}", stacklevel=2)
    return out


# ---- M1 / M2: scoring --------------------------------------------------------

def probabilities(pred: DataFrame) -> F.Column:
    """Class probabilities as an array. OneVsRest has no probability column:
    each class model's margin m gives 1 / (1 + exp(-2 m)) (the binary GBT
    link), normalised to sum to 1."""
    if "probability" in pred.columns:
        return vector_to_array("probability")
    raw = vector_to_array("rawPrediction")
    p = F.transform(raw, lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m)))
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    return F.transform(p, lambda x: x / total)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """M1: predicted class and confidence = max probability."""
    pred = model.transform(df)
    return pred.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                       probabilities(pred).alias("probabilities")) \
        .withColumn("confidence", F.array_max("probabilities"))


def class_probabilities(scored: DataFrame, keep: Sequence[str]) -> DataFrame:
    """M2: one row per (row, class) with its probability."""
    return scored.select(*keep, F.posexplode("probabilities").alias("class_id", "probability"))


# ---- T14-T17: cross-validation ---------------------------------------------

def cross_validate(train: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str],
                   models: Mapping[str, Callable], k: int = 5, seed: int = 43,
                   label: str = "label", max_parallel: int = 3) -> DataFrame:
    """Stratified k folds (exact quotas, md5 order); for each fold
    and model fit on the other folds (preprocessing and class weights
    refitted per fold, so no statistic leaks from the held-out fold) and
    predict the fold. Returns the union of all predictions
    (model, fold, label, prediction) - metrics are then one query."""
    folds = cut_lineage(stratified_folds(train, label, key, k, seed))

    failed: dict = {}

    def run_fold(i: int) -> list:
        tr = cut_lineage(with_weights(folds.where(F.col("fold") != i)))
        fitted, errors = fit_prepared(tr, numeric, categorical, models, tr.count(), len(models))
        failed.update(errors)
        te = folds.where(F.col("fold") == i)
        return [(name, _materialise(m.transform(te).select(
            F.lit(name).alias("model"), F.lit(i).alias("fold"), F.col(label).cast("int").alias("label"),
            F.col("prediction").cast("int").alias("prediction")))) for name, m in fitted.items()]
    # folds are independent: their Spark jobs run concurrently
    with ThreadPoolExecutor(max_workers=max_parallel) as ex:
        every = [p for ps in ex.map(run_fold, range(k)) for p in ps]
    # a model that failed in one fold has no mean over all folds: it is left out, aloud
    for name, error in failed.items():
        warnings.warn(f"{name} left out of cross-validation: {error}", stacklevel=2)
    preds = [p for name, p in every if name not in failed]
    if not preds:
        raise RuntimeError(f"no model could be cross-validated: {failed}")
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out


def _materialise(df: DataFrame) -> DataFrame:
    """Cache a small prediction frame so the union does not refit anything."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df


def cv_metrics(cv_predictions: DataFrame, registration: Sequence[str]) -> DataFrame:
    """Per model mean / population std of the fold metrics."""
    folds = mt.model_metrics(mt.confusion_counts(cv_predictions, ("model", "fold")), ("model", "fold"))
    return mt.with_registration(mt.cv_summary(folds), registration)


# ---- E6 / E7: feature names and importances --------------------------------

def feature_names(model: PipelineModel, df: DataFrame, features_col: str = "features") -> list[str]:
    """Names of the assembled vector slots, read from the ML attribute
    metadata of the transformed schema (no job runs)."""
    meta = model.transform(df.limit(0)).schema[features_col].metadata.get("ml_attr", {})
    slots = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            slots[a["idx"]] = a.get("name", f"f{a['idx']}")
    n = meta.get("num_attrs", len(slots))
    return [slots.get(i, f"f{i}") for i in range(n)]


def importances(model: PipelineModel, names: Sequence[str]) -> list[tuple[str, float]]:
    """Tree importances (OneVsRest: mean over the class models) or the
    mean absolute coefficient over classes for linear models."""
    clf = model.stages[-1]
    if hasattr(clf, "featureImportances"):
        v = clf.featureImportances.toArray()
    elif hasattr(clf, "coefficientMatrix"):
        m = clf.coefficientMatrix.toArray()
        v = abs(m).mean(axis=0)
    elif hasattr(clf, "models"):
        arrs = [sub.featureImportances.toArray() for sub in clf.models]
        v = sum(arrs) / len(arrs)
    else:
        return []
    return [(names[i] if i < len(names) else f"f{i}", float(x)) for i, x in enumerate(v)]


# ---- S7 / S8: persistence ------------------------------------------------------

def save_models(models: Mapping[str, PipelineModel], base: str, best: str, features: Sequence[str]) -> None:
    """Every model, the best one again under 'best', and the ordered
    feature list as a one-column table with its ordinal."""
    from pyspark.sql import SparkSession
    for name, m in models.items():
        m.write().overwrite().save(f"{base}/models/{name}")
    models[best].write().overwrite().save(f"{base}/best_model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(i, f) for i, f in enumerate(features)], "ordinal int, feature string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{base}/feature_list")


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; a missing path raises."""
    return PipelineModel.load(path)
