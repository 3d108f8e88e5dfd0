"""Rule drivers, bands, scenarios, alignment, serving formulas."""
from pyspark.sql import functions as F

from tierlens.operators import score as sc
from tierlens.presets import country


def _row(spark, **kw):
    cols = [r.column for r in country.RULES]
    vals = tuple(kw.get(c) for c in cols)
    return spark.createDataFrame([vals + (kw.get("cls", 0),)], ", ".join(f"{c} double" for c in cols) + ", cls int")


def _drivers(df):
    out = sc.risk_drivers(df, country.RULES, "cls", dict(country.DEFAULT_DRIVERS)).first()
    return out.drivers, out.n_drivers_fired


def test_no_rule_fires_gives_class_default(spark):
    d, n = _drivers(_row(spark, Labor_Participation_pct=60.0, cls=1))
    assert n == 0 and d == ["Some indicators are near threshold levels"]


def test_five_fire_first_four_in_rule_order(spark):
    d, n = _drivers(_row(spark, Unemployment_Rate_pct=20.0, Birth_Rate=35.0, CPI_Change_pct=15.0,
                         Total_Tax_Rate_pct=70.0, Density_per_km2=900.0, Labor_Participation_pct=60.0))
    assert n == 5 and len(d) == 4 and d[0].startswith("High unemployment") and d[3].startswith("Heavy tax")


def test_missing_labor_fires(spark):
    d, n = _drivers(_row(spark))
    assert n == 1 and d == ["Low labor participation suggests workforce challenges"]


def test_absent_column_counts_as_zero(spark):
    df = spark.createDataFrame([(1,)], "cls int")
    d, n = _drivers(df)
    assert n == 1 and "labor" in d[0]


def test_bands_and_ranges(spark):
    df = spark.createDataFrame([(0.2, None), (-0.5, 95.0)], "Economic_Stress_Index double, Labor_Participation_pct double")
    b = sc.kpi_bands(df, country.BANDS).select("stress_level").collect()
    assert [r[0] for r in b] == ["high", "low"]
    v = sc.validate_ranges(df, country.RANGES).collect()
    assert v[0].violations == [] and v[0].Labor_Participation_pct == 62.0
    assert v[1].violations == ["Labor_Participation_pct"]


def test_scenarios_fan_out(spark):
    df = spark.createDataFrame([(1, 10.0, 2.0)], "k int, a double, b double")
    scen = [{"scenario": "base"}, {"scenario": "dbl", "changes": [("a", "mul", 2.0)]},
            {"scenario": "set", "changes": [("b", "set", 9.0), ("a", "add", 1.0)]}]
    out = {r.scenario: (r.a, r.b) for r in sc.apply_scenarios(df, scen, ["a", "b"]).collect()}
    assert out == {"base": (10.0, 2.0), "dbl": (20.0, 2.0), "set": (11.0, 9.0)}


def test_align_features(spark):
    df = spark.createDataFrame([(1, 2.5)], "k int, a double")
    out = sc.align_features(df, ["a", "missing", "x_is_missing"], keep=["k"])
    assert out.columns == ["k", "a", "missing", "x_is_missing"]
    assert tuple(out.first()) == (1, 2.5, 0.0, 0)
    assert dict(out.dtypes)["x_is_missing"] == "int"


def test_serving_linear_defaults(spark):
    df = spark.createDataFrame([(10.0, 60.0, 20.0)], "Unemployment_Rate_pct double, Labor_Participation_pct double, "
                               "Birth_Rate double")
    out = sc.serving_linear(df, country.SERVING_LINEAR, dict(country.SERVING_DEFAULTS)).first()
    # primary 100 / tertiary 50 defaults
    assert abs(out.Human_Capital_Index - (100 * 0.005 + 50 * 0.005 + 60 * 0.005) / 3) < 1e-12


def test_serving_features_at_defaults(spark):
    df = spark.createDataFrame([tuple(float(r.default) for r in country.RANGES)], ", ".join(f"`{r.column}` double" for r in country.RANGES))
    out = sc.serving_features(df, country.LEVEL1, country.SERVING_LINEAR, dict(country.SERVING_DEFAULTS))
    assert len(out.columns) == len(country.RANGES) + 21
    row = out.first()
    assert (row.Healthcare_Access_Gap, row.Education_Pipeline, row.Education_Gap_Index) == (20.0, 0.5, 50.0)
    # inputs that are there win over the defaults, missing ones take them
    more = df.selectExpr("*", "10.0D as Physicians_per_1000", "cast(null as double) as Tertiary_Education_pct")
    row = sc.serving_features(more, country.LEVEL1, country.SERVING_LINEAR, dict(country.SERVING_DEFAULTS)).first()
    assert (row.Healthcare_Access_Gap, row.Education_Pipeline) == (3.0, 0.5)


def test_top_values(spark):
    df = spark.createDataFrame([(3.0, 3.0, None, 1.0)], "b double, a double, c double, d double")
    assert sc.top_values(df, ["b", "a", "c", "d"], 2).first().top_features == ["a", "b"]


def test_model_queries_score_all_customers(spark):
    from tierlens.plans import catalog
    sf = "/root/testdata/sf0.001"
    n = catalog.model_frame(spark, sf).select("entity_key").distinct().count()
    assert catalog.class_probabilities(spark, sf).select("entity_key").distinct().count() == n
    assert catalog.scenario_rescore(spark, sf).groupBy("scenario").count().where(f"count = {n}").count() == 3
