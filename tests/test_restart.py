"""The flow from a raw file: stages survive a killed run, reruns skip what is finished, metric runs stay apart."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierlens.functions import exprs
from tierlens.operators import metrics as mt
from tierlens.operators import ml
from tierlens.plans import flow
from tierlens.plans.store import MetricStore, StageStore
from tierlens.presets import customer as cp
from tierlens.sources import fixtures as fx
from tierlens.sources import tables as tb

STAGES = ["raw", "cleaned", "featured", "model_ready", "split"]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "customers")
    return tb.write_raw_csv(fx.raw_customer_text(spark, SF_SMALL), path)


def test_raw_file_and_globs(spark, raw):
    a, b = tb.read_raw_csv(spark, raw), tb.read_raw_csv(spark, f"{raw}/*.csv")
    assert "Nation\nKey" in a.columns and a.count() == b.count() == 151
    kept = tb.parquet_names(a)
    assert kept.columns == [f"column_{i}" for i in range(12)] and tb.original_names(kept).columns == a.columns
    with pytest.raises(FileNotFoundError):
        tb.read_raw_csv(spark, f"{raw}/*.nothing")


def test_a_killed_run_continues(spark, raw, tmp_path, monkeypatch):
    """The run dies while features are built; the next one reads the finished stages and goes on."""
    out = str(tmp_path / "flow")
    real = flow.engineer_features
    monkeypatch.setattr(flow, "engineer_features", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    store = StageStore(spark, out)
    with pytest.raises(RuntimeError):
        flow.data_stages(spark, raw, cp.RAW_PRESET, store)
    assert store.ran == STAGES[:2]
    monkeypatch.setattr(flow, "engineer_features", real)
    # what a killed write leaves behind: rows without a manifest file
    spark.range(3).write.parquet(f"{out}/stages/featured/half-written")
    store = StageStore(spark, out)
    data = flow.data_stages(spark, raw, cp.RAW_PRESET, store)
    assert store.ran == STAGES[2:]
    assert "half-written" not in store.names(f"{out}/stages/featured")
    assert {r[0] for r in data["split"].select("split").distinct().collect()} == {"train", "test"}
    again = StageStore(spark, out)
    same = flow.data_stages(spark, raw, cp.RAW_PRESET, again)
    assert again.ran == [] and same["split"].schema == data["split"].schema
    assert sorted(map(str, same["split"].collect())) == sorted(map(str, data["split"].collect()))


def test_a_changed_parameter_reruns_what_follows(spark, raw, tmp_path):
    out = str(tmp_path / "flow")
    flow.data_stages(spark, raw, cp.RAW_PRESET, StageStore(spark, out))
    other = dataclasses.replace(cp.RAW_PRESET, leaky_extra=())
    store = StageStore(spark, out)
    data = flow.data_stages(spark, raw, other, store)
    assert store.ran == ["model_ready", "split"] and "health_index" in data["split"].columns
    assert all(len(store.names(f"{out}/stages/{s}")) == 1 for s in STAGES)  # the earlier tables are gone
    # the same file written again has other times: everything runs again
    tb.write_raw_csv(fx.raw_customer_text(spark, SF_SMALL), f"{out}-raw")
    flow.data_stages(spark, f"{out}-raw", other, moved := StageStore(spark, out))
    assert moved.ran == STAGES


def test_whole_flow_from_the_raw_file(spark, raw, tmp_path):
    out, params = str(tmp_path / "flow"), ml.ModelParams(lr_max_iter=20, rf_trees=3, rf_depth=3, gbt_rounds=2, gbt_depth=2)
    first = flow.run_raw(spark, raw, cp.RAW_PRESET, out, params, cross_validate=False, run="one")
    assert first["ran"] == [*STAGES, "predictions"]
    second = flow.run_raw(spark, raw, cp.RAW_PRESET, out, params, cross_validate=False, run="two")
    assert second["ran"] == []  # nothing is fitted twice
    m = {(r["run"], r["model"]): r["macro_f1"] for r in second["metrics"].collect()}
    assert {k[0] for k in m} == {"one", "two"} and all(m["one", k] == m["two", k] for k in ("LogisticRegression", "RandomForest"))
    assert ml.load_model(f"{out}/saved/best_model") is not None
    lines = [r[0] for r in MetricStore(spark, f"{out}/metrics").text("report_text", "one").collect()]
    assert len(lines) % len(ml.registry(params)) == 0 and any("weighted avg" in x for x in lines)


def test_training_needs_its_target(spark):
    with pytest.raises(ValueError, match="no target column"):
        flow.train(spark.range(5).withColumnRenamed("id", "entity_key"), cp.RAW_PRESET)


def test_model_columns_by_type(spark):
    df = spark.createDataFrame([(1, "x", 2.0, True, 0)], "entity_key long, seg string, a double, flag boolean, stability_label int")
    assert flow.model_columns(df, cp.RAW_PRESET) == (["a"], ["seg", "flag"])


def test_metric_runs_stay_apart(spark, tmp_path):
    store = MetricStore(spark, str(tmp_path))
    row = lambda v: spark.createDataFrame([("m", v)], "model string, score double")
    store.put_table("t", "a", row(1.0))
    store.put_table("t", "b", row(2.0))
    store.put_table("t", "a", row(3.0))
    assert {(r["run"], r["score"]) for r in store.table("t").collect()} == {("a", 3.0), ("b", 2.0)}


def test_confusion_grid_is_dense(spark):
    pred = spark.createDataFrame([("m", 0, 2), ("m", 2, 2), ("n", 1, 1)], "model string, label int, prediction int")
    got = {(r["model"], r["label"], r["prediction"]): r["n"] for r in mt.confusion_grid(mt.confusion_counts(pred)).collect()}
    assert len(got) == 18 and sum(got.values()) == 3 and got["m", 0, 2] == got["m", 2, 2] == got["n", 1, 1] == 1


def test_display_formats(spark):
    df = spark.createDataFrame([(0.8125, 0.734), (None, None), (2.0, 0.02)], "a double, b double")
    got = [(r[0], r[1]) for r in df.select(exprs.fixed_text(F.col("a"), 3), exprs.pct_text(F.col("b"))).collect()]
    assert got == [("0.812", "73%"), (None, None), ("2.000", "2%")]
