"""Country preset end to end on hand-written rows in the reference schema."""
import csv
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tierlens.plans import flow as pl
from tierlens.presets import country
from tierlens.sources.tables import read_raw_csv

HEADER = ["Country", "Density\n(P/Km2)", "Abbreviation", "Agricultural Land( %)", "Land Area(Km2)",
          "Armed Forces size", "Birth Rate", "Calling Code", "Capital/Major City", "Co2-Emissions", "CPI",
          "CPI Change (%)", "Currency-Code", "Fertility Rate", "Forested Area (%)", "Gasoline Price", "GDP",
          "Gross primary education enrollment (%)", "Gross tertiary education enrollment (%)", "Infant mortality",
          "Largest city", "Life expectancy", "Maternal mortality ratio", "Minimum wage", "Official language",
          "Out of pocket health expenditure", "Physicians per thousand", "Population",
          "Population: Labor force participation (%)", "Tax revenue (%)", "Total tax rate", "Unemployment rate",
          "Urban_population", "Latitude", "Longitude"]


def _row(i):
    g = 1_000_000_000 * (i + 1) * (3 if i % 2 else 1)
    pop = 1_000_000 * (i + 2)
    return [f"Land{i}", f"{50 + 37 * i:,}", f"L{i}", f"{20 + i * 3.1:.2f}%", f"{100_000 + 7_919 * i:,}",
            "" if i % 4 == 0 else f"{1_000 * (i + 1):,}", f"{15 + i * 1.7:.2f}", str(100 + i), f"Cap{i}",
            f"{5_000 + 311 * i:,}", f"{100 + i * 9.3:,.2f}", f"{1 + (i % 5) * 2.2:.1f}%", "XYZ",
            f"{1.5 + i * 0.2:.2f}", f"{10 + (i * 7) % 60:.1f}%", "" if i % 3 == 0 else f"${0.5 + i * 0.1:.2f} ",
            f"${g:,} ", f"{90 + i:.1f}%", f"{10 + i * 4:.1f}%", f"{5 + (i * 13) % 50:.1f}", f"City{i}",
            f"{60 + (i * 3) % 20:.1f}", str(10 + (i * 37) % 400), "" if i % 5 == 0 else f"${0.2 + i * 0.3:.2f} ",
            "Lang", f"{15 + (i * 11) % 60:.2f}%", f"{0.1 + i * 0.25:.2f}", f"{pop:,}", f"{40 + (i * 5) % 40:.1f}%",
            "" if i % 6 == 0 else f"{8 + i:.1f}%", f"{20 + (i * 9) % 60:.1f}%", f"{3 + (i * 7) % 20:.2f}%",
            f"{pop // 2:,}", f"{-30 + i * 6.5:.4f}", f"{-100 + i * 17.25:.4f}"]


@pytest.fixture(scope="module")
def raw(spark):
    d = tempfile.mkdtemp(prefix="tierlens-country-")
    path = os.path.join(d, "countries.csv")
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
        w.writerow(HEADER)
        for i in range(24):
            w.writerow(_row(i))
        w.writerow(["Vatican City"] + [""] * (len(HEADER) - 1))
    return read_raw_csv(spark, path)


def test_raw_read_keeps_newline_header(raw):
    assert "Density\n(P/Km2)" in raw.columns and raw.count() == 25
    assert len(raw.columns) == 35


def test_missing_path_raises(spark):
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, "/nonexistent/none.csv")


def test_clean_country(raw):
    df, prof = pl.clean(raw, country.PRESET, profile=True)
    assert df.count() == 24  # Vatican City excluded
    t = dict(df.dtypes)
    assert t["GDP"] == "double" and t["Density_per_km2"] == "double" and t["Country"] == "string"
    assert "Abbreviation" not in t and "Minimum_Wage_is_missing" in t
    r = df.where(F.col("Country") == "Land1").first()
    assert r.GDP == 6e9 and r.Agricultural_Land_pct == 23.1 and r.Density_per_km2 == 87.0
    assert prof.where("column_name = 'Armed_Forces'").first().missing_count == 6


def test_engineer_and_labels_country(raw):
    df = pl.clean(raw, country.PRESET)
    out, stats = pl.engineer_features(df, country.PRESET, create_target=True, drop_leaky=False)
    cols = set(out.columns)
    for f in ["GDP_per_Capita", "Economic_Stress_Index", "Physician_Access_Score", "Environmental_Pressure_Index",
              "stability_score", "stability_label"]:
        assert f in cols
    counts = {r.stability_label: r.n for r in out.groupBy("stability_label").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 8, 1: 8, 2: 8}
    lean, _ = pl.engineer_features(df, country.PRESET)
    assert "Life_Expectancy" not in lean.columns and "stability_score" not in lean.columns
    assert "GDP_per_Capita" in lean.columns  # parity: not in the leak list


def test_end_to_end_small(spark):
    from conftest import SF_SMALL
    res = pl.run_customer(spark, SF_SMALL, cross_validate=False)
    m = res.test_metrics.collect()
    assert {r.model for r in m} >= {"LogisticRegression", "RandomForest"}
    assert all(0.0 <= r.accuracy <= 1.0 for r in m)
