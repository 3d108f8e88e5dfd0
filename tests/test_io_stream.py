"""Sinks and sources (S2-S8), saved-stat serving (F27), streaming (M9)."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierlens.operators import features as feat
from tierlens.operators import ml
from tierlens.plans import catalog as cat
from tierlens.presets import customer as cp
from tierlens.sources import tables as tb
from tierlens.streaming import score_stream as ss


def test_stage_roundtrip_and_saved_stats_serving(spark):
    d = tempfile.mkdtemp(prefix="tierlens-io-")
    c = cat.customer_table(spark, SF_SMALL)
    featured, stats = feat.engineer(c, list(cp.PRESET.features))
    tb.write_stage(stats, os.path.join(d, "stats"))
    tb.write_stage(featured, os.path.join(d, "featured"))
    saved = tb.read_stage(spark, os.path.join(d, "stats"))
    again, _ = feat.engineer(c, list(cp.PRESET.features), stats=saved)
    a = sorted(map(tuple, featured.collect()), key=lambda r: r[0])
    b = sorted(map(tuple, again.collect()), key=lambda r: r[0])
    assert a == b
    # scoring a subset with the saved (training) stats gives the same values
    sub, _ = feat.engineer(c.where("entity_key % 2 = 0"), list(cp.PRESET.features), stats=saved)
    full = {r.entity_key: r.stress_index for r in featured.select("entity_key", "stress_index").collect()}
    assert all(full[r.entity_key] == r.stress_index for r in sub.select("entity_key", "stress_index").collect())
    assert tb.read_stage(spark, os.path.join(d, "featured")).count() == c.count()


def test_report_sinks(spark):
    d = tempfile.mkdtemp(prefix="tierlens-rep-")
    m = spark.createDataFrame([("a", 0.5)], "model string, macro_f1 double")
    tb.write_stage(m, os.path.join(d, "metrics"), fmt="csv")
    back = tb.read_stage(spark, os.path.join(d, "metrics"), fmt="csv", schema=m.schema)
    assert back.collect() == m.collect()
    tb.write_text_report(spark.createDataFrame([("best: a",)], "line string"), os.path.join(d, "report"))
    assert spark.read.text(os.path.join(d, "report")).first()[0] == "best: a"


def test_model_save_load_same_predictions(spark):
    d = tempfile.mkdtemp(prefix="tierlens-model-")
    split = cat.model_frame(spark, SF_SMALL)
    train = ml.prepare(split.where("split = 'train'"), "stability_label")
    test = ml.prepare(split.where("split = 'test'"), "stability_label")
    reg = ml.registry(ml.ModelParams(**cp.MODEL_PARAMS))
    models = ml.fit_all(train, cp.MODEL_FEATURES, cp.MODEL_CATEGORICAL, {"LogisticRegression": reg["LogisticRegression"]})
    ml.save_models(models, d, "LogisticRegression", list(cp.MODEL_FEATURES))
    loaded = ml.load_model(os.path.join(d, "best_model"))
    a = ml.score(models["LogisticRegression"], test, ["entity_key"]).orderBy("entity_key").collect()
    b = ml.score(loaded, test, ["entity_key"]).orderBy("entity_key").collect()
    assert [(r.prediction, round(r.confidence, 12)) for r in a] == [(r.prediction, round(r.confidence, 12)) for r in b]
    assert all(abs(sum(r.probabilities) - 1.0) < 1e-9 for r in a)
    feats = spark.read.parquet(os.path.join(d, "feature_list")).orderBy("ordinal").collect()
    assert [r.feature for r in feats] == list(cp.MODEL_FEATURES)
    with pytest.raises(Exception):
        ml.load_model(os.path.join(d, "does_not_exist"))


def test_importances_and_names(spark):
    split = cat.model_frame(spark, SF_SMALL)
    train = ml.prepare(split.where("split = 'train'"), "stability_label")
    reg = ml.registry(ml.ModelParams(**cp.MODEL_PARAMS))
    m = ml.fit_all(train, cp.MODEL_FEATURES, cp.MODEL_CATEGORICAL, {"RandomForest": reg["RandomForest"]})["RandomForest"]
    names = ml.feature_names(m, train)
    assert names[: len(cp.MODEL_FEATURES)] == [f"{c}__num" for c in cp.MODEL_FEATURES]
    imp = ml.importances(m, names)
    assert abs(sum(v for _, v in imp) - 1.0) < 1e-9


def test_stream_matches_batch(spark):
    run_dir = tempfile.mkdtemp(prefix="tierlens-stream-")
    out = ss.score_events(spark, SF_SMALL, run_dir)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    st = ev.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).first()
    want = {r.event_id: (r.value - st.m) / st.s for r in ev.collect()}
    got = {r.event_id: r.z_value for r in out.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    # a second run over the same checkpoint processes nothing new and keeps the sink whole
    again = ss.score_events(spark, SF_SMALL, run_dir)
    assert again.count() == len(want)


VERSIONS = "entity_key long, version long, changed_at timestamp, x double"


def _feed(spark, path, batches):
    """One file for each batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(VERSIONS).option("maxFilesPerTrigger", 1).parquet(path)


def _at(hour):
    from datetime import datetime, timedelta
    return datetime(2024, 1, 1) + timedelta(hours=hour)


def test_stream_keeps_newest_versions(spark, tmp_path):
    """Replays, overtaken and late rows are dropped; a restart goes on with the kept state."""
    path, run = str(tmp_path / "in"), str(tmp_path / "run")
    double = lambda b: b.withColumn("y", F.col("x") * 2)
    feed = _feed(spark, path, [
        [(1, 1, _at(0), 1.0), (2, 1, _at(0), 1.0), (3, 5, _at(0), 5.0), (4, None, _at(0), 9.0)],
        [(1, 1, _at(0), 7.0), (1, 2, _at(1), 2.0), (1, 3, _at(1), 3.0), (3, 4, _at(1), 4.0)],  # replay, two new, overtaken
    ])
    got = {r.entity_key: (r.version, r.y) for r in ss.rescore_stream(feed, double, run).collect()}
    assert got == {1: (3, 6.0), 2: (1, 2.0), 3: (5, 10.0)}
    sunk = spark.read.parquet(f"{run}/sink")
    assert sunk.count() == 4  # no replay and no overtaken version was scored
    feed = _feed(spark, path, [[(1, 3, _at(1), 8.0), (2, 2, _at(30), 4.0)], [(6, 1, _at(31), 1.0)], [(5, 1, _at(1), 1.0)]])
    got = {r.entity_key: (r.version, r.y) for r in ss.rescore_stream(feed, double, run).collect()}
    assert got == {1: (3, 6.0), 2: (2, 8.0), 3: (5, 10.0), 6: (1, 2.0)}  # 5 came after the watermark


def test_stream_state_ends_with_the_watermark(spark, tmp_path):
    """Once the watermark has passed a key's newest row by the delay its state is gone: an equal version is scored
    again, and the newest over the sink still holds."""
    path, run = str(tmp_path / "in"), str(tmp_path / "run")
    same = lambda b: b
    feed = _feed(spark, path, [[(1, 3, _at(0), 1.0)], [(2, 1, _at(50), 1.0)], [(2, 2, _at(60), 1.0)], [(1, 2, _at(61), 9.0)]])
    got = {r.entity_key: (r.version, r.x) for r in ss.rescore_stream(feed, same, run).collect()}
    assert got == {1: (3, 1.0), 2: (2, 1.0)}
    assert spark.read.parquet(f"{run}/sink").where("entity_key = 1").count() == 2


def test_stream_time_out_raises(spark, tmp_path):
    import time
    feed = _feed(spark, str(tmp_path / "in"), [[(1, 1, _at(0), 1.0)]])

    def slow(batch):
        time.sleep(30)
        return batch
    with pytest.raises(TimeoutError):
        ss.run_scoring_stream(feed, slow, str(tmp_path / "sink"), str(tmp_path / "c"), timeout_s=2)


def test_event_scorer_of_no_values(spark):
    stats = spark.createDataFrame([(None, None)], "mean double, sd double")
    ev = spark.createDataFrame([(1, None, 1, "a", None, None)], ss.EVENT_SCHEMA)
    assert ss.event_value_scorer(stats)(ev).count() == 1


def test_empty_source_leaves_an_empty_sink(spark, tmp_path):
    spark.createDataFrame([], VERSIONS).write.parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema(VERSIONS).parquet(str(tmp_path / "in"))
    out = ss.rescore_stream(feed, lambda b: b.withColumn("y", F.col("x")), str(tmp_path / "run"))
    assert out.columns == ["entity_key", "version", "changed_at", "x", "y"] and out.count() == 0


def test_stream_state_calls_do_not_grow_with_the_keys(spark, tmp_path):
    """A call of Python serves a group of keys; keys of one group, null among them, stay apart, and long keys and
    values stay exact beside nulls."""
    big, schema = 2**53 + 1, "k long, version int, changed_at timestamp, n long"
    for rows in ([(big, 1, _at(0), big), (big - 1, 2, _at(0), None), (None, 1, _at(0), big)], [(big, 2, _at(1), None), (big - 1, 1, _at(1), 5), (None, 1, _at(1), 7)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    newest = ss.newest_versions(feed, "k", "version", "changed_at", "2 hours", key_groups=1)
    sink = ss.run_scoring_stream(newest, lambda b: b, str(tmp_path / "sink"), str(tmp_path / "check"))
    got = {tuple(r) for r in spark.read.parquet(sink).select("k", "version", "n").collect()}
    assert got == {(big, 1, big), (big - 1, 2, None), (None, 1, big), (big, 2, None)}
