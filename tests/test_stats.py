"""Exact distributed quantiles, tiers, IQR capping, imputation."""
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tierlens.operators import labels as lab
from tierlens.operators import ml
from tierlens.operators import stats as S


def _df(spark, xs):
    return spark.createDataFrame([(None if x is None else float(x),) for x in xs], "x double")


@pytest.mark.parametrize("xs", [
    list(range(1, 7)),
    [5.0] * 9,
    [1.0, 1.0, 1.0, 2.0, 100.0, -3.0, 7.5, 7.5, None],
    list(np.random.default_rng(1).normal(size=500)),
    list(np.random.default_rng(2).integers(0, 5, size=300)),
    [float("-inf"), 1.0, 2.0, float("inf"), 3.0],
])
def test_order_statistics_match_numpy(spark, xs):
    df = _df(spark, xs)
    vals = sorted(x for x in xs if x is not None)
    # few buckets force several narrowing passes
    targets = [("x", k) for k in range(len(vals))]
    got = S.order_statistics(df, targets, buckets=3)
    assert [got[t] for t in targets] == vals


_RNG = np.random.default_rng(5)


@pytest.mark.parametrize("xs", [
    10.0 ** _RNG.uniform(-300, 300, size=20_000) * _RNG.choice([-1.0, 1.0], size=20_000),  # log-uniform
    np.nextafter(1.0, 2.0) + np.arange(5_000) * 2.0**-52,  # neighbouring doubles
    np.repeat([0.0, 5e-324, 1e-323, -5e-324], 50),  # subnormal range
    np.concatenate([np.full(30, -np.inf), _RNG.normal(size=500), np.full(30, np.inf)]),
    np.concatenate([np.full(9_000, 7.25), _RNG.normal(size=500) * 1e-9 + 7.25]),  # one hot value
    [-1.7e308, 1.7e308, 1e308, -1e308],
], ids=["log_uniform", "neighbours", "subnormal", "infinite", "hot", "extremes"])
def test_order_statistics_within_seven_passes(spark, xs):
    df, vals, passes = _df(spark, xs).repartition(4).cache(), sorted(float(x) for x in xs), []
    n = len(vals)
    targets = [("x", int(k)) for k in sorted({0, 1, n // 4, n // 3, n // 2, 2 * n // 3, n - 2, n - 1})]
    got = S.order_statistics(df, targets, passes=passes)
    assert [got[t] for t in targets] == [vals[k] for _, k in targets]
    assert len(passes) <= 7


def test_one_value_column_needs_no_pass(spark):
    passes = []
    assert S.order_statistics(_df(spark, [4.0] * 5 + [None]), [("x", 2)], passes=passes) == {("x", 2): 4.0}
    assert passes == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.25, 1 / 3, 0.5, 2 / 3, 0.75, 1.0]))
def test_quantile_matches_numpy_linear(spark, xs, q):
    got = S.quantile_values(_df(spark, xs), ["x"], [q])["x"][0]
    want = float(np.quantile(np.array(xs), q, method="linear"))
    assert got == pytest.approx(want, rel=1e-12, abs=1e-9)


def test_tertiles_edge_rows(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 7)] + [(7, None)], "k int, s double")
    out = {r.k: r.y for r in lab.tier_labels(df, "s", "y").collect()}
    assert out == {1: 2, 2: 2, 3: 1, 4: 1, 5: 0, 6: 0}  # NULL row dropped
    eq = spark.createDataFrame([(i, 4.0) for i in range(5)], "k int, s double")
    assert {r.y for r in lab.tier_labels(eq, "s", "y").collect()} == {2}


def test_tiers_monotone_in_score(spark):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(size=300))], "k int, s double")
    rows = sorted(lab.tier_labels(df, "s", "y").collect(), key=lambda r: r.s)
    ys = [r.y for r in rows]
    assert ys == sorted(ys, reverse=True)
    assert {ys.count(c) for c in (0, 1, 2)} == {100}


def test_iqr_cap(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    b = lab.fit_iqr(df, ["x"]).first()
    assert (b["x__q1"], b["x__q3"], b["x__lo"], b["x__hi"]) == (2.0, 4.0, -1.0, 7.0)
    capped = [r.x for r in lab.apply_iqr(df, lab.fit_iqr(df, ["x"]), ["x"]).collect()]
    assert sorted(capped) == [1.0, 2.0, 3.0, 4.0, 7.0]


def test_median_fill_and_population_scale(spark):
    df = spark.createDataFrame([(float(x) if x else None,) for x in [1, 2, 3, 4, 5, 6, None]], "x double")
    st_ = ml.fit_impute_scale(df, ["x"]).first()
    assert st_["x__med"] == 3.5
    vals = np.array([1, 2, 3, 4, 5, 6, 3.5])
    assert st_["x__sd"] == pytest.approx(vals.std(ddof=0))
    out = [r.x for r in ml.apply_impute_scale(df, ml.fit_impute_scale(df, ["x"]), ["x"]).collect()]
    assert out == pytest.approx(list((vals - vals.mean()) / vals.std(ddof=0)))


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "p string")
    assert ml.fit_modes(df, ["p"]).first()["mode"] == "a"


@pytest.mark.parametrize("xs", [
    10.0 ** _RNG.uniform(-300, 300, size=20_000) * _RNG.choice([-1.0, 1.0], size=20_000),
    _RNG.normal(size=60_000),
    np.concatenate([np.full(9_000, 7.25), _RNG.normal(size=9_000) * 1e-9 + 7.25, np.full(9_000, 7.26)]),
    np.concatenate([np.full(300, -np.inf), _RNG.normal(size=500), np.full(900, np.inf)]),
    _RNG.integers(0, 6, size=5_000).astype(float),
    [3.0], [1.0, 2.0], [-0.0, 0.0, 5e-324],
], ids=["log_uniform", "normal", "hot", "infinite", "integers", "one", "two", "zeros"])
def test_two_scans_give_exact_quantiles(spark, xs, monkeypatch):
    df, vals, probs = _df(spark, xs).repartition(4), sorted(float(x) for x in xs), [0.0, 0.25, 1 / 3, 0.5, 0.9, 1.0]
    searched = []
    whole = S.order_statistics

    def seen(d, targets, **k):
        searched.append("n" in d.columns)
        return whole(d, targets, **k)
    monkeypatch.setattr(S, "order_statistics", seen)
    got = S.quantile_values(df, ["x"], probs)["x"]
    for q, v in zip(probs, got):
        lo, hi, f = S._ranks(len(vals), q)
        assert v == vals[lo] or v == S._interp(vals[lo], vals[hi], f) or (np.isnan(v) and np.isinf([vals[lo], vals[hi]]).any())
    assert all(searched)  # only the small table was searched


def test_ranks_outside_their_brackets_are_still_exact(spark, monkeypatch):
    """A sketch with no accuracy at all: the whole table is searched."""
    vals = sorted(float(v) for v in _RNG.normal(size=3_000))
    df, made = _df(spark, vals), S._profile

    def wrong(d, cols, shares=(), accuracy=10000):
        p = made(d, cols, shares, accuracy)
        for c in p.values():
            c["at"] = [vals[-2]] * len(shares)
        return p
    monkeypatch.setattr(S, "_profile", wrong)
    assert S.quantile_values(df, ["x"], [0.5])["x"] == [S._interp(vals[1499], vals[1500], 0.5)]


def test_brackets_keep_few_rows(spark):
    """Rows inside no bracket make one group a task, also where whole columns repeat few values."""
    df = spark.range(40_000).selectExpr("id % 3 AS a", "id % 5 AS b", "CAST(id * 7919 % 40009 AS DOUBLE) AS c")
    at = S._profile(df, ["a", "b", "c"], [0.4998, 0.5002])
    assert at["a"]["at"] == [1.0, 1.0] and at["c"]["at"][1] - at["c"]["at"][0] < 80
    assert S.quantile_values(df, ["a", "b", "c"], [0.5])["a"] == [1.0]
