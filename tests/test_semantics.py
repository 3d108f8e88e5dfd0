"""SURVEY 4.3 semantic rules that are easy to get silently wrong."""
import math

from pyspark.sql import functions as F

from tierlens.functions import exprs as X
from tierlens.operators import clean as cl
from tierlens.operators import labels as lab
from tierlens.operators import stats as S


def test_n1_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    r = S.fit_moments(df, ["x"]).first()
    assert r["x__mean"] == 2.0  # NaN skipped like pandas, not propagated
    prof = cl.missing_profile(df).first()
    assert prof.missing_count == 1


def test_n5_exact_quantile_interpolates(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 7)], "x double")
    assert S.quantile_values(df, ["x"], [0.5])["x"] == [3.5]  # not an element (3.0)
    assert S.quantile_values(df, ["x"], [1 / 3, 2 / 3])["x"] == [8 / 3, 13 / 3]


def test_n6_bins_closed_on_the_right(spark):
    # values equal to a cut point fall in the lower-score (higher id) tier
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 2, 2, 3, 4, 5])], "k int, s double")
    out = {r.k: r.y for r in lab.tier_labels(df, "s", "y").collect()}
    assert out[1] == out[2] == out[3] == 2


def test_n7_half_even_percent(spark):
    # 1 missing of 800 rows = 0.125 % -> 0.12 (pandas round / bround), not 0.13
    df = spark.createDataFrame([(None,)] + [(1.0,)] * 799, "x double")
    assert cl.missing_profile(df).first().missing_pct == 0.12


def test_n15_doubles_stay_doubles(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "k int, y int")
    d = dict(lab.class_distribution(df, "y").dtypes)
    assert d["pct"] == "double" and d["share"] == "double"
    assert dict(df.select(X.safe_divide("k", "y").alias("r")).dtypes)["r"] == "double"


def test_n2_zero_divisor_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(X.safe_divide("a", "b")).first()[0] == 0.0


def test_n3_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.select(X.clip("x", 0.0)).first()[0] is None
    assert df.select(F.greatest(F.col("x"), F.lit(0.0))).first()[0] == 0.0  # why greatest is not used
