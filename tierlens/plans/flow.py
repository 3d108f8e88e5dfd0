"""Pipeline drivers (O1-O4): clean -> features -> tiers -> leak drop ->
split -> train -> cross-validate -> evaluate, as lazy DataFrame stages with
written checkpoints at the stage boundaries (S3).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean as cl
from ..operators import features as feat
from ..operators import labels as lab
from ..operators import metrics as mt
from ..operators import ml
from ..operators import sampling as sm
from ..session import cut_lineage
from ..specs import IndicatorPreset
from ..sources.tables import original_names, parquet_names, read_raw_csv, write_stage
from .store import MetricStore, StageStore


def clean(df: DataFrame, preset: IndicatorPreset, profile: bool = False):
    """O2: P1 drop ids -> P2 exclude entities -> P3/P4 names -> P5 numeric
    groups -> P6 detected numeric text -> P7 missing flags. With
    ``profile`` also returns the missing-value profile (A1)."""
    d = cl.drop_columns(df, preset.drop_columns)
    if preset.exclude_keys and preset.key in d.columns:
        d = cl.exclude_keys(d, preset.key, preset.exclude_keys)
    numeric_raw = [c for _, cols in preset.numeric_groups for c in cols]
    d = cl.clean_numeric(d, [c for c in numeric_raw if c in d.columns])
    d = cl.clean_names(d, preset.rename_map)
    d = cl.convert_detected(d, exclude=[preset.key])
    d = cl.missing_flags(d, preset.missing_flag_columns)
    return (d, cl.missing_profile(d)) if profile else d


def engineer_features(df: DataFrame, preset: IndicatorPreset, create_target: bool = True,
                      drop_leaky: bool = True, stats: DataFrame | None = None):
    """All feature groups, then the score and tier label, then the
    leak drop (which needs both options on, like the reference).
    Returns (frame, fitted z-stats)."""
    specs = list(preset.features) + ([preset.score_spec] if create_target and preset.score_spec else [])
    out, fitted = feat.engineer(df, specs, stats)
    if create_target and preset.score_spec is not None:
        out = lab.tier_labels(out, preset.score, preset.target, preset.n_classes)
        if drop_leaky:
            out = lab.drop_leaky(out, preset)
    return out, fitted


@dataclass
class RunResult:
    labelled: DataFrame
    split: DataFrame
    models: dict
    test_metrics: DataFrame
    cv_summary: DataFrame | None
    best_cv: str | None
    best_test: str
    summary: DataFrame
    artifacts: dict = field(default_factory=dict)


def run(df: DataFrame, preset: IndicatorPreset, numeric: Sequence[str], categorical: Sequence[str],
        params: ml.ModelParams | None = None, registration: Sequence[str] | None = None,
        cross_validate: bool = True, out_dir: str | None = None) -> RunResult:
    """O1: the whole flow over an already loaded entity table ``df``.

    Two winners are kept apart, as in the reference: the CV winner (the model
    that gets saved as 'best') and the test-set winner (the one reported).
    """
    models_reg = ml.registry(params or ml.ModelParams(seed=preset.seed))
    order = list(registration or models_reg)
    featured, _ = engineer_features(df, preset, create_target=True, drop_leaky=False)
    labelled = cut_lineage(featured)
    split = cut_lineage(sm.train_test_split(labelled, preset.target, preset.key, preset.test_fraction,
                                            preset.seed, max_strata=2 * preset.n_classes))
    train = ml.prepare(split.where("split = 'train'"), preset.target)
    test = ml.prepare(split.where("split = 'test'"), preset.target)
    models = ml.fit_all(train, numeric, categorical, models_reg)
    preds = None
    for name, m in models.items():
        p = m.transform(test).select(F.lit(name).alias("model"), F.col("label").cast("int").alias("label"),
                                     F.col("prediction").cast("int").alias("prediction"))
        preds = p if preds is None else preds.unionByName(p)
    test_metrics = mt.with_registration(mt.model_metrics(mt.confusion_counts(preds)), order)
    best_test = mt.best_on_test(test_metrics).first()["model"]
    cv_sum, best_cv = None, None
    if cross_validate:
        cvp = ml.cross_validate(train, preset.key, numeric, categorical, models_reg, preset.n_folds, preset.seed + 1)
        cv_sum = ml.cv_metrics(cvp, order)
        best_cv = mt.best_by_cv(cv_sum).first()["model"]
    summary = mt.model_summary(test_metrics)
    artifacts = {}
    if out_dir:
        artifacts["labelled"] = write_stage(labelled, f"{out_dir}/labelled")
        artifacts["metrics"] = write_stage(test_metrics, f"{out_dir}/test_metrics", fmt="csv")
        ml.save_models(models, out_dir, best_cv or best_test, list(numeric) + list(categorical))
        artifacts["models"] = f"{out_dir}/models"
    return RunResult(labelled, split, models, test_metrics, cv_sum, best_cv, best_test, summary, artifacts)


@dataclass
class TrainingResult:
    """The fitted models, the feature names they see, and the CV table with its winner."""
    models: dict
    numeric: list[str]
    categorical: list[str]
    cv_summary: DataFrame | None
    best_cv: str | None


def model_columns(df: DataFrame, preset: IndicatorPreset) -> tuple[list[str], list[str]]:
    """The feature columns by type; an absent target is an error."""
    if preset.target not in df.columns:
        raise ValueError(f"no target column {preset.target}; create the target before training")
    return cl.feature_types(df, preset.target, [preset.key, preset.score, "split"])


def train(df: DataFrame, preset: IndicatorPreset, params: ml.ModelParams | None = None, cross_validate: bool = True) -> TrainingResult:
    """Fit every registered model on a model-ready table and compare them by cross-validation."""
    numeric, categorical = model_columns(df, preset)
    reg = ml.registry(params or ml.ModelParams(seed=preset.seed))
    rows = ml.prepare(df, preset.target)
    models = ml.fit_all(rows, numeric, categorical, reg)
    cv, best = None, None
    if cross_validate:
        cv = ml.cv_metrics(ml.cross_validate(rows, preset.key, numeric, categorical, reg, preset.n_folds, preset.seed + 1), list(reg))
        best = mt.best_by_cv(cv).first()["model"]
    return TrainingResult(models, numeric, categorical, cv, best)


def evaluate(predictions: DataFrame, registration: Sequence[str], store: MetricStore, run: str) -> None:
    """Every evaluation output of (model, label, prediction) rows, stored under a run: the dense confusion grid,
    the metrics, the class report as a table and as text, and the summary. One pass over the predictions."""
    counts = cut_lineage(mt.confusion_counts(predictions), "confusion")
    metrics = cut_lineage(mt.with_registration(mt.model_metrics(counts), list(registration)), "metrics")
    report = cut_lineage(mt.class_report(counts), "report")
    store.put_table("confusion_grid", run, mt.confusion_grid(counts))
    store.put_table("metrics", run, metrics)
    store.put_table("class_report", run, report)
    store.put_table("summary", run, mt.model_summary(metrics))
    store.put_text("report_text", run, mt.report_lines(report), ["model", "ordinal"])


def data_stages(spark, raw_path: str, preset: IndicatorPreset, store: StageStore) -> dict[str, DataFrame]:
    """O1 and O2 up to the models, restartable: raw text, cleaned, featured and labelled, model-ready, split. Each
    stage's key holds its parameters and its predecessor's key, so a rerun goes on where the last one ended."""
    out: dict[str, DataFrame] = {}
    cleaning = {"drop": preset.drop_columns, "exclude": preset.exclude_keys, "groups": preset.numeric_groups, "rename": preset.rename_map, "flags": preset.missing_flag_columns, "key": preset.key}
    out["raw"] = store.stage("raw", {"path": store.fingerprint(raw_path)}, {}, lambda: parquet_names(read_raw_csv(spark, raw_path)))
    out["cleaned"] = store.stage("cleaned", {"raw": store.keys["raw"]}, cleaning, lambda: clean(original_names(out["raw"]), preset))
    out["featured"] = store.stage("featured", {"cleaned": store.keys["cleaned"]}, {"features": repr(preset.features), "score": repr(preset.score_spec), "classes": preset.n_classes},
                                  lambda: engineer_features(out["cleaned"], preset, create_target=True, drop_leaky=False)[0])
    out["model_ready"] = store.stage("model_ready", {"featured": store.keys["featured"]}, {"leaky": preset.leaky_extra}, lambda: lab.drop_leaky(out["featured"], preset))
    out["split"] = store.stage("split", {"model_ready": store.keys["model_ready"]}, {"fraction": preset.test_fraction, "seed": preset.seed},
                               lambda: sm.train_test_split(out["model_ready"], preset.target, preset.key, preset.test_fraction, preset.seed, max_strata=2 * preset.n_classes))
    return out


def run_raw(spark, raw_path: str, preset: IndicatorPreset, out_dir: str, params: ml.ModelParams | None = None, cross_validate: bool = True, run: str = "run") -> dict:
    """O1: the whole flow from a raw file to stored evaluation outputs. Finished stages, and models fitted on the same
    split with the same parameters, are read instead of computed."""
    store, metrics = StageStore(spark, out_dir), MetricStore(spark, f"{out_dir.rstrip('/')}/metrics")
    data = data_stages(spark, raw_path, preset, store)
    params = params or ml.ModelParams(seed=preset.seed)
    test = ml.prepare(data["split"].where("split = 'test'"), preset.target)
    names = list(ml.registry(params))

    def fitted() -> DataFrame:
        result = train(data["split"].where("split = 'train'").drop("split"), preset, params, cross_validate)
        preds = None
        for name, m in result.models.items():
            p = m.transform(test).select(F.lit(name).alias("model"), F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))
            preds = p if preds is None else preds.unionByName(p)
        metric = mt.with_registration(mt.model_metrics(mt.confusion_counts(preds)), names)
        ml.save_models(result.models, f"{out_dir}/saved", result.best_cv or mt.best_on_test(metric).first()["model"], result.numeric + result.categorical)
        if result.cv_summary is not None:
            metrics.put_table("cv_summary", run, result.cv_summary)
        return preds

    predictions = store.stage("predictions", {"split": store.keys["split"]}, {"models": repr(params), "cv": cross_validate}, fitted)
    evaluate(predictions, names, metrics, run)
    return {**data, "predictions": predictions, "metrics": metrics.table("metrics"), "ran": list(store.ran)}


def run_customer(spark, sf_dir: str, cross_validate: bool = True, out_dir: str | None = None) -> RunResult:
    """O1 on the driver tables: fixture C with the customer preset (the
    end-to-end number reported by the bench)."""
    from ..presets import customer as cp
    from ..sources.fixtures import customer_indicators
    res = run(customer_indicators(spark, sf_dir), cp.PRESET, cp.MODEL_FEATURES, cp.MODEL_CATEGORICAL,
              ml.ModelParams(**cp.MODEL_PARAMS), cp.MODEL_REGISTRATION, cross_validate, out_dir)
    res.test_metrics.write.format("noop").mode("overwrite").save()
    res.summary.write.format("noop").mode("overwrite").save()
    return res
