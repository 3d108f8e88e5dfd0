"""Preset "country": the indicator table the reference was written for.

Everything below is configuration. Names, lists, thresholds, messages,
coefficients and slider ranges are fixed values that must equal the
reference's for equal results; they are stated plainly and in their
natural order.
"""

from __future__ import annotations

from ..specs import Abs, BandSpec, Gap, IndicatorPreset, Log1p, RangeSpec, Ratio, RuleSpec, ZIndex, ZTerm

Z = ZTerm.of

# ---- Fixed values: cleaning ----------------------------------------------
KEY = "Country"
COLUMNS_TO_DROP = ("Abbreviation", "Calling Code", "Capital/Major City", "Currency-Code",
                   "Largest city", "Official language")
ENTITIES_TO_DROP = ("Palestinian National Authority", "Vatican City", "Nauru", "North Macedonia",
                    "Eswatini")
PERCENT_COLUMNS = ("Agricultural Land( %)", "CPI Change (%)", "Forested Area (%)",
                   "Gross primary education enrollment (%)", "Gross tertiary education enrollment (%)",
                   "Out of pocket health expenditure", "Population: Labor force participation (%)",
                   "Tax revenue (%)", "Total tax rate", "Unemployment rate")
CURRENCY_COLUMNS = ("GDP", "Gasoline Price", "Minimum wage")
COMMA_COLUMNS = ("Density\n(P/Km2)", "Land Area(Km2)", "Armed Forces size", "Co2-Emissions",
                 "Population", "Urban_population")
NUMERIC_COLUMNS = ("Birth Rate", "Fertility Rate", "Infant mortality", "Life expectancy",
                   "Maternal mortality ratio", "Physicians per thousand", "Latitude", "Longitude")
CPI_COLUMNS = ("CPI",)
RENAME_MAP = (
    ("Density\n(P/Km2)", "Density_per_km2"),
    ("Agricultural Land( %)", "Agricultural_Land_pct"),
    ("Land Area(Km2)", "Land_Area_km2"),
    ("Armed Forces size", "Armed_Forces"),
    ("Co2-Emissions", "CO2_Emissions"),
    ("CPI Change (%)", "CPI_Change_pct"),
    ("Fertility Rate", "Fertility_Rate"),
    ("Forested Area (%)", "Forested_Area_pct"),
    ("Gasoline Price", "Gasoline_Price"),
    ("Gross primary education enrollment (%)", "Primary_Education_pct"),
    ("Gross tertiary education enrollment (%)", "Tertiary_Education_pct"),
    ("Infant mortality", "Infant_Mortality"),
    ("Life expectancy", "Life_Expectancy"),
    ("Maternal mortality ratio", "Maternal_Mortality"),
    ("Minimum wage", "Minimum_Wage"),
    ("Out of pocket health expenditure", "OOP_Health_Expenditure_pct"),
    ("Physicians per thousand", "Physicians_per_1000"),
    ("Population: Labor force participation (%)", "Labor_Participation_pct"),
    ("Tax revenue (%)", "Tax_Revenue_pct"),
    ("Total tax rate", "Total_Tax_Rate_pct"),
    ("Unemployment rate", "Unemployment_Rate_pct"),
    ("Urban_population", "Urban_Population"),
    ("Birth Rate", "Birth_Rate"),
    ("GDP", "GDP"),
    ("CPI", "CPI"),
    ("Population", "Population"),
    ("Latitude", "Latitude"),
    ("Longitude", "Longitude"),
)
MISSING_FLAG_COLUMNS = ("Minimum_Wage", "Tax_Revenue_pct", "Armed_Forces", "Gasoline_Price")

# ---- Fixed values: features (F1-F25) -------------------------------------
FEATURES = (
    # economic
    Ratio("GDP_per_Capita", "GDP", "Population"),
    Log1p("Log_GDP", "GDP"),
    Log1p("Log_Population", "Population"),
    Ratio("Tax_Burden_Index", "Total_Tax_Rate_pct", "Tax_Revenue_pct"),
    # healthcare
    Ratio("Healthcare_Access_Gap", "OOP_Health_Expenditure_pct", "Physicians_per_1000"),
    # education / workforce
    Ratio("Education_Pipeline", "Tertiary_Education_pct", "Primary_Education_pct"),
    Gap("Education_Gap_Index", "Primary_Education_pct", "Tertiary_Education_pct"),
    # demographic
    Ratio("Urbanization_Rate", "Urban_Population", "Population"),
    Ratio("Dependency_Ratio_Proxy", "Birth_Rate", "Labor_Participation_pct"),
    Ratio("Military_Burden", "Armed_Forces", "Population"),
    Abs("Abs_Latitude", "Latitude"),
    # environment
    Ratio("CO2_per_Capita", "CO2_Emissions", "Population"),
    Ratio("CO2_per_GDP", "CO2_Emissions", "GDP"),
    Ratio("Resource_Land_Balance", "Forested_Area_pct", "Agricultural_Land_pct"),
    Ratio("Fuel_Cost_Pressure", "Gasoline_Price", "Minimum_Wage"),
    # z-score composites
    ZIndex("Economic_Stress_Index",
           (Z("Unemployment_Rate_pct"), Z("CPI_Change_pct"), Z("Total_Tax_Rate_pct")),
           (Z("GDP_per_Capita"), Z("Labor_Participation_pct")), combine="signed", require="positive"),
    ZIndex("Inflation_Unemployment_Pressure", (Z("CPI_Change_pct"), Z("Unemployment_Rate_pct")),
           combine="pair", require="all"),
    ZIndex("Healthcare_Stability_Score", (Z("Life_Expectancy"), Z("Physicians_per_1000")),
           (Z("Infant_Mortality"), Z("Maternal_Mortality"), Z("OOP_Health_Expenditure_pct")),
           combine="signed", require="any"),
    ZIndex("Mortality_Pressure_Index", (Z("Infant_Mortality"), Z("Maternal_Mortality")), combine="mean"),
    ZIndex("Physician_Access_Score",
           (Z("Physicians_per_1000"), Z("OOP_Health_Expenditure_pct", reverse=(100.0, 50.0))),
           combine="pair", require="all"),
    ZIndex("Human_Capital_Index",
           (Z("Primary_Education_pct"), Z("Tertiary_Education_pct"), Z("Labor_Participation_pct")),
           combine="mean"),
    ZIndex("Workforce_Stability_Score", (Z("Labor_Participation_pct"), Z("Tertiary_Education_pct")),
           (Z("Unemployment_Rate_pct"), Z("Birth_Rate")), combine="signed", require="any"),
    ZIndex("Population_Pressure_Index", (Z("Density_per_km2"), Z("Birth_Rate"), Z("Fertility_Rate")),
           combine="mean"),
    ZIndex("Environmental_Pressure_Index",
           (Z("CO2_per_Capita", "CO2_Emissions"), Z("Forested_Area_pct", sign=-1.0), Z("Agricultural_Land_pct")),
           combine="mean"),
)
# target signals (+ GDP_per_Capita when present) -> stability_score.
SCORE = ZIndex("stability_score",
               (Z("Life_Expectancy"), Z("Physicians_per_1000"), Z("Primary_Education_pct"),
                Z("Tertiary_Education_pct"), Z("GDP_per_Capita")),
               (Z("Infant_Mortality"), Z("Maternal_Mortality")), combine="signed", null_if_empty=True)
LEAKY_DERIVED = ("Healthcare_Stability_Score", "Mortality_Pressure_Index", "Physician_Access_Score")

# ---- Fixed values: labels, drivers, bands, ranges ------------------------
CLASS_LABELS = ((0, "Stable"), (1, "Watch"), (2, "At-Risk"))
CLASS_TEXT = (
    (0, "Low risk — strong institutions and economy"),
    (1, "Moderate risk — mixed signals, monitor closely"),
    (2, "High risk — significant instability indicators"),
)
RULES = (
    RuleSpec("Unemployment_Rate_pct", ">", 12, "High unemployment rate signals economic distress"),
    RuleSpec("Birth_Rate", ">", 30, "High birth rate indicates demographic pressure"),
    RuleSpec("CPI_Change_pct", ">", 10, "Elevated inflation erodes purchasing power"),
    RuleSpec("Total_Tax_Rate_pct", ">", 60, "Heavy tax burden may limit economic growth"),
    RuleSpec("OOP_Health_Expenditure_pct", ">", 50, "High out-of-pocket health costs signal weak public healthcare"),
    RuleSpec("Density_per_km2", ">", 500, "High population density increases resource strain"),
    RuleSpec("Labor_Participation_pct", "<", 45, "Low labor participation suggests workforce challenges"),
)
DEFAULT_DRIVERS = (
    (0, "Indicators are within healthy ranges across dimensions"),
    (1, "Some indicators are near threshold levels"),
    (2, "Multiple indicators signal elevated risk"),
)
BANDS = (
    BandSpec("confidence_level", "confidence", ((0.7, "high"), (0.5, "medium")), "low"),
    BandSpec("stress_level", "Economic_Stress_Index", ((0.1, "high"), (-0.1, "medium")), "low"),
    BandSpec("gap_level", "Healthcare_Access_Gap", ((30, "high"), (15, "medium")), "low"),
    BandSpec("capital_level", "Human_Capital_Index", ((0.3, "high"), (0.15, "medium")), "low"),
)
RANGES = (
    RangeSpec("GDP", 1_000_000, 5_000_000_000_000, 50_000_000_000),
    RangeSpec("CPI", 80.0, 500.0, 125.0),
    RangeSpec("CPI_Change_pct", -5.0, 50.0, 2.5),
    RangeSpec("Unemployment_Rate_pct", 0.0, 30.0, 5.5),
    RangeSpec("Tax_Revenue_pct", 0.0, 40.0, 16.0),
    RangeSpec("Total_Tax_Rate_pct", 5.0, 100.0, 37.0),
    RangeSpec("Minimum_Wage", 0.01, 15.0, 1.5),
    RangeSpec("Gasoline_Price", 0.0, 2.5, 1.0),
    RangeSpec("Population", 10_000, 1_400_000_000, 10_000_000),
    RangeSpec("Urban_Population", 5_000, 900_000_000, 5_000_000),
    RangeSpec("Density_per_km2", 1.0, 1000.0, 87.0),
    RangeSpec("Birth_Rate", 5.0, 50.0, 18.0),
    RangeSpec("Fertility_Rate", 0.9, 7.0, 2.3),
    RangeSpec("Labor_Participation_pct", 35.0, 90.0, 62.0),
    RangeSpec("Land_Area_km2", 100, 17_000_000, 500_000),
    RangeSpec("Agricultural_Land_pct", 0.0, 85.0, 40.0),
    RangeSpec("Forested_Area_pct", 0.0, 99.0, 32.0),
    RangeSpec("CO2_Emissions", 10.0, 1_000_000.0, 12_000.0),
    RangeSpec("Armed_Forces", 0, 3_000_000, 30_000),
    RangeSpec("OOP_Health_Expenditure_pct", 0.0, 85.0, 30.0),
    RangeSpec("Latitude", -45.0, 65.0, 17.0),
    RangeSpec("Longitude", -175.0, 180.0, 20.0),
)

# ---- Fixed values: serving formulas with literal coefficients (F27) ------
# name -> ((column, coefficient), ...), divisor; columns absent at serving
# time take SERVING_DEFAULTS, also in the ratios and gaps of LEVEL1.
SERVING_DEFAULTS = (("Physicians_per_1000", 1.5), ("Primary_Education_pct", 100.0),
                    ("Tertiary_Education_pct", 50.0))
LEVEL1 = tuple(f for f in FEATURES if not isinstance(f, ZIndex))
SERVING_LINEAR = (
    ("Economic_Stress_Index", (("Unemployment_Rate_pct", 0.02), ("CPI_Change_pct", 0.01),
                               ("Total_Tax_Rate_pct", 0.005), ("GDP_per_Capita", -1e-6),
                               ("Labor_Participation_pct", -0.005)), 1.0),
    ("Inflation_Unemployment_Pressure", (("CPI_Change_pct", 0.01), ("Unemployment_Rate_pct", 0.02)), 2.0),
    ("Human_Capital_Index", (("Primary_Education_pct", 0.005), ("Tertiary_Education_pct", 0.005),
                             ("Labor_Participation_pct", 0.005)), 3.0),
    ("Workforce_Stability_Score", (("Labor_Participation_pct", 0.005), ("Tertiary_Education_pct", 0.005),
                                   ("Unemployment_Rate_pct", -0.01), ("Birth_Rate", -0.005)), 4.0),
    ("Population_Pressure_Index", (("Density_per_km2", 0.0001), ("Birth_Rate", 0.01),
                                   ("Fertility_Rate", 0.05)), 3.0),
    ("Environmental_Pressure_Index", (("CO2_per_Capita", 0.01), ("Forested_Area_pct", -0.005),
                                      ("Agricultural_Land_pct", 0.003)), 3.0),
)

PRESET = IndicatorPreset(
    key=KEY,
    drop_columns=COLUMNS_TO_DROP,
    exclude_keys=ENTITIES_TO_DROP,
    rename_map=RENAME_MAP,
    numeric_groups=(("percent", PERCENT_COLUMNS), ("currency", CURRENCY_COLUMNS),
                    ("comma", COMMA_COLUMNS), ("cpi", CPI_COLUMNS), ("numeric", NUMERIC_COLUMNS)),
    missing_flag_columns=MISSING_FLAG_COLUMNS,
    features=FEATURES,
    score_spec=SCORE,
    leaky_extra=LEAKY_DERIVED,
    class_labels=CLASS_LABELS,
    class_text=CLASS_TEXT,
    rules=RULES,
    default_drivers=DEFAULT_DRIVERS,
    bands=BANDS,
    ranges=RANGES,
    extras={"score_derived_inputs": ("GDP_per_Capita",), "serving_linear": SERVING_LINEAR,
            "serving_defaults": SERVING_DEFAULTS},
)
