"""Exact quotas, distributed ranks vs brute force, metric goldens."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierlens.operators import metrics as mt
from tierlens.operators import sampling as sm
from conftest import SF_SMALL


def test_quotas_63_63_63():
    assert sm.test_quotas([(0, 63), (1, 63), (2, 63)], 0.2) == {0: 12, 1: 13, 2: 13}


def test_split_counts_63_63_63(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(189)], "k long, y int")
    s = sm.stratified_split(df, "y", "k", 0.2, 42)
    got = {(r.y, r.split): r.n for r in s.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, "test"): 12, (1, "test"): 13, (2, "test"): 13,
                   (0, "train"): 51, (1, "train"): 50, (2, "train"): 50}


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_bucketed_rank_equals_plain_window(spark, digits):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus")
    fast = sm.stratified_rank(o, "o_orderstatus", "o_orderkey", 42, "r", bucket_digits=digits)
    w = Window.partitionBy("o_orderstatus").orderBy(sm.order_hash("o_orderkey", 42), "o_orderkey")
    brute = o.withColumn("r", F.row_number().over(w))
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, brute.collect()))


def test_folds_balanced(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(100)], "k long, y int")
    f = sm.stratified_folds(df, "y", "k", 5, 43)
    counts = {(r.y, r.fold): r.n for r in f.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()}
    assert set(counts.values()) == {10}


def test_split_and_folds_equal_plain_windows(spark):
    """Skewed, null and tiny classes, few and many buckets: split and folds as ranks give them, row by row."""
    rows = [(i, None if i % 50 == 0 else "one" if i == 7 else "pair" if i in (8, 9) else "big" if i % 3 else "small") for i in range(997)]
    df = spark.createDataFrame(rows, "k long, y string")
    w = Window.partitionBy("y").orderBy(sm.order_hash("k", 42), "k")
    rank = {r["k"]: r["r"] for r in df.withColumn("r", F.row_number().over(w)).collect()}
    sizes = {y: sum(1 for _, v in rows if v == y) for y in {v for _, v in rows}}
    quota = sm.test_quotas(list(sizes.items()), 0.2)
    got_q = {r[0]: r["quota"] for r in sm.quota_table(df, "y", 0.2).collect()}
    assert got_q == quota
    order = sorted(sizes, key=lambda y: (y is None, y or ""))
    dealt = {y: [0] * 5 for y in sizes}
    for i, y in enumerate(y for y in order for _ in range(sizes[y])):
        dealt[y][i % 5] += 1
    for digits in (1, 4):
        got = {r["k"]: r["split"] for r in sm.stratified_split(df, "y", "k", 0.2, 42, bucket_digits=digits).collect()}
        assert got == {k: "test" if rank[k] <= quota[y] else "train" for k, y in rows}
        folds = {r["k"]: r["fold"] for r in sm.stratified_folds(df, "y", "k", 5, 42, bucket_digits=digits).collect()}
        for k, y in rows:
            want, left = 0, rank[k]
            while left > dealt[y][want]:
                left, want = left - dealt[y][want], want + 1
            assert folds[k] == want
    totals = [sum(1 for f in folds.values() if f == i) for i in range(5)]
    assert max(totals) - min(totals) <= 1


def test_split_has_no_exchange_of_the_data_side(spark):
    """In the final adaptive plan, rows of the data meet no exchange outside the subqueries that find the cuts."""
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus")
    for d in (sm.stratified_split(o, "o_orderstatus", "o_orderkey"), sm.stratified_folds(o, "o_orderstatus", "o_orderkey"),
              sm.sample_weights(o, "o_orderstatus")):
        d.collect()
        final = d._jdf.queryExecution().executedPlan().toString()
        body = final.split("== Initial Plan ==")[0].split("Subquery")[0]
        assert "Exchange" not in body and "Window" not in body and "Join" not in body


def test_no_class_cap(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.col("id").alias("y"))
    s = sm.stratified_split(df, "y", "k", 0.2).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in s} == {"test": 600, "train": 2400}


def test_weights_keep_null_labels(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, None)], "k int, y string")
    got = {r["k"]: r["weight"] for r in sm.sample_weights(df, "y").collect()}
    assert got == {1: pytest.approx(4 / 6), 2: pytest.approx(4 / 6), 3: pytest.approx(4 / 6), 4: 2.0}


def _pairs(matrix):
    return [(t, p) for t, row in enumerate(matrix) for p, n in enumerate(row) for _ in range(n)]


@pytest.mark.parametrize("matrix,want", [
    ([[12, 0, 0], [3, 7, 3], [0, 1, 12]], (0.815789, 0.825, 0.820513, 0.804233, 0.802005, 0.923077)),
    ([[11, 1, 0], [3, 7, 3], [0, 1, 12]], (0.789474, 0.787831, 0.792735, 0.779887, 0.778143, 0.923077)),
])
def test_metric_goldens(spark, matrix, want):
    df = spark.createDataFrame([("m", t, p) for t, p in _pairs(matrix)], "model string, label int, prediction int")
    r = mt.model_metrics(mt.confusion_counts(df)).first()
    got = tuple(round(r[c], 6) for c in mt.METRIC_COLS)
    assert got == pytest.approx(want, abs=1e-6)


def test_metrics_absent_class_by_label_value(spark):
    # class 0 never occurs as a label, class 1 never predicted
    df = spark.createDataFrame([("m", 1, 2), ("m", 2, 2), ("m", 2, 0)], "model string, label int, prediction int")
    pc = {r.cls: r for r in mt.per_class(mt.confusion_counts(df)).collect()}
    assert pc[1].precision == 0.0 and pc[0].recall == 0.0
    r = mt.model_metrics(mt.confusion_counts(df)).first()
    assert r.at_risk_recall == 0.5


def test_best_by_cv_tie_breaks(spark):
    df = spark.createDataFrame([("a", 0.8, 0.7, 0.05, 0), ("b", 0.8, 0.7, 0.01, 1), ("c", 0.8, 0.7, 0.01, 2)],
                               "model string, f1_macro_mean double, f1_weighted_mean double, f1_macro_std double, "
                               "registration int")
    assert mt.best_by_cv(df).first().model == "b"


def test_split_falls_back_when_label_is_continuous(spark):
    df = spark.createDataFrame([(i, float(i) / 7.0) for i in range(100)], "k long, y double")
    s = sm.train_test_split(df, "y", "k", 0.2, 42, max_strata=6)
    assert s.where("split = 'test'").count() == 20 and s.count() == 100
    d = spark.createDataFrame([(i, i % 3) for i in range(90)], "k long, y int")
    t = sm.train_test_split(d, "y", "k", 0.2, 42, max_strata=6)
    got = {r.y: r.n for r in t.where("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 6, 1: 6, 2: 6}


def test_rank_with_one_hot_class(spark):
    # one class holds 90% of all rows: the bucketed rank is still exact
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("y"))
    fast = sm.stratified_rank(o, "y", "o_orderkey", 7, "r", bucket_digits=2)
    w = Window.partitionBy("y").orderBy(sm.order_hash("o_orderkey", 7), "o_orderkey")
    brute = o.withColumn("r", F.row_number().over(w))
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, brute.collect()))


def test_metrics_with_one_model_holding_most_rows(spark):
    rows = [("big", i % 3, (i * 7) % 3) for i in range(3000)] + [("small", i % 3, i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "model string, label int, prediction int")
    m = {r.model: r for r in mt.model_metrics(mt.confusion_counts(df)).collect()}
    assert m["small"].accuracy == 1.0 and 0.0 <= m["big"].accuracy <= 1.0
