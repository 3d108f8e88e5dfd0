"""Preset over fixture C (customer indicators from the driver tables).

Role mapping of the country formulas onto customer columns:
GDP -> revenue, Population -> n_orders, stress inputs -> (avg_discount,
returned_share, avg_tax), buffer inputs -> (revenue_per_order, balance),
score positives -> (balance, revenue, avg_order), negatives ->
(returned_share, avg_discount).
"""

from __future__ import annotations

from dataclasses import replace

from ..specs import Abs, BandSpec, Gap, IndicatorPreset, Log1p, RangeSpec, Ratio, RuleSpec, ZIndex, ZTerm

Z = ZTerm.of

RATIOS = (
    Ratio("revenue_per_order", "revenue", "n_orders"),        # F1 pattern
    Ratio("tax_to_discount", "avg_tax", "avg_discount"),      # F6 pattern (NULL divisors)
    Ratio("balance_per_revenue", "balance", "revenue"),       # F10 pattern (NULL num, zero den)
    Ratio("items_per_order", "n_items", "n_orders"),          # F15 pattern
    Ratio("discount_per_item", "avg_discount", "n_items"),    # F17 pattern
)
LOG_ABS_GAP = (
    Log1p("log_revenue", "revenue"),                          # F2
    Log1p("log_orders", "n_orders"),                          # F3
    Log1p("log_balance", "balance"),                          # negative and NULL inputs
    Abs("abs_balance", "balance"),                            # F19
    Gap("order_gap", "avg_order", "balance"),                 # F14
)
INDICES = (
    ZIndex("stress_index", (Z("avg_discount"), Z("returned_share"), Z("avg_tax")),
           (Z("revenue_per_order"), Z("balance")), combine="signed", require="positive"),   # F4
    ZIndex("pressure_pair", (Z("avg_discount"), Z("returned_share")), combine="pair", require="all"),  # F5
    ZIndex("health_index", (Z("balance"), Z("avg_order")),
           (Z("returned_share"), Z("avg_discount"), Z("avg_tax")), combine="signed"),          # F7
    ZIndex("pressure_index", (Z("returned_share"), Z("avg_discount")), combine="mean"),       # F8
    ZIndex("access_score", (Z("avg_order"), Z("avg_discount", reverse=(100.0, 50.0))),
           combine="pair", require="all"),                                                      # F9
    ZIndex("capital_index", (Z("balance"), Z("avg_order"), Z("n_items")), combine="mean"),    # F11
    ZIndex("env_index", (Z("revenue_per_order", "revenue"), Z("balance", sign=-1.0), Z("avg_tax")),
           combine="mean"),                                                                     # F22
)
SCORE = ZIndex("stability_score", (Z("balance"), Z("revenue"), Z("avg_order")),
               (Z("returned_share"), Z("avg_discount")), combine="signed", null_if_empty=True)  # F25

RULES = (
    RuleSpec("returned_share", ">", 0.36, "High share of returned items"),
    RuleSpec("avg_discount", ">", 0.06, "Deep average discount erodes margin"),
    RuleSpec("avg_tax", ">", 0.05, "High average tax on orders"),
    RuleSpec("n_orders", ">", 20, "Many open order relationships"),
    RuleSpec("revenue_per_order", ">", 250000, "Revenue concentrated in large orders"),
    RuleSpec("items_per_order", ">", 5, "Large baskets per order"),
    RuleSpec("balance", "<", 0, "Negative account balance"),
)
BANDS = (
    BandSpec("stress_level", "stress_index", ((0.1, "high"), (-0.1, "medium")), "low"),
    BandSpec("pressure_level", "pressure_index", ((0.5, "high"), (0.0, "medium")), "low"),
    BandSpec("capital_level", "capital_index", ((0.3, "high"), (0.15, "medium")), "low"),
)
RANGES = (
    RangeSpec("balance", -1000.0, 10000.0, 4500.0),
    RangeSpec("avg_discount", 0.0, 0.1, 0.05),
    RangeSpec("returned_share", 0.0, 1.0, 0.33),
    RangeSpec("n_orders", 1.0, 40.0, 10.0),
    RangeSpec("avg_order", 900.0, 105000.0, 38000.0),
)

PRESET = IndicatorPreset(
    key="entity_key",
    features=RATIOS + LOG_ABS_GAP + INDICES,
    score_spec=SCORE,
    leaky_extra=("health_index", "pressure_index", "access_score"),
    class_text=((0, "Low risk: strong balance and revenue"),
                (1, "Moderate risk: mixed signals, monitor"),
                (2, "High risk: weak balance, high returns")),
    rules=RULES,
    default_drivers=((0, "Indicators are within healthy ranges"),
                     (1, "Some indicators are near threshold levels"),
                     (2, "Multiple indicators signal elevated risk")),
    bands=BANDS,
    ranges=RANGES,
    extras={"score_derived_inputs": ()},
)

# The raw form of the same indicators (fixture R).
RAW_PRESET = replace(
    PRESET,
    drop_columns=("Notes", "Phone"),
    exclude_keys=("TOTAL",),
    numeric_groups=(("currency", ("Balance ($)", "Revenue, total ($)")), ("comma", ("Orders", "Items"))),
    rename_map=(("Segment Name", "segment"), ("Nation\nKey", "nation_key"), ("Balance ($)", "balance"), ("Orders", "n_orders"),
                ("Items", "n_items"), ("Revenue, total ($)", "revenue"), ("Avg-Order", "avg_order"), ("Avg.Tax", "avg_tax"),
                ("Avg Discount", "avg_discount"), ("Returned Share", "returned_share")),
    missing_flag_columns=("balance", "avg_discount"),
)

# Columns the models see (no key, no leaky columns, no label).
MODEL_FEATURES = ("n_orders", "n_items", "avg_tax", "revenue_per_order", "items_per_order", "log_orders")
MODEL_CATEGORICAL = ("segment",)

# Serving formulas with literal coefficients (F27 pattern) and their defaults.
SERVING_LINEAR = (
    ("stress_linear", (("avg_discount", 2.0), ("returned_share", 1.0), ("avg_tax", 0.5),
                       ("revenue_per_order", -1e-6), ("balance", -1e-4)), 1.0),
    ("capital_linear", (("balance", 1e-4), ("avg_order", 1e-5), ("n_items", 0.01)), 3.0),
)
SERVING_DEFAULTS = {"avg_discount": 0.05}

SCENARIOS = (
    {"scenario": "base", "changes": ()},
    {"scenario": "shock", "changes": (("avg_discount", "mul", 1.5),)},
    {"scenario": "relief", "changes": (("balance", "add", 1000.0),)},
)
TOP_VALUE_COLUMNS = ("balance", "n_orders", "n_items", "revenue", "avg_order", "avg_tax", "avg_discount",
                     "returned_share")
TOP_VALUE_FEATURES = TOP_VALUE_COLUMNS + tuple(f.name for f in RATIOS)
ALIGN_FEATURES = MODEL_FEATURES + ("n_returns", "balance_is_missing")

# Model settings for the driver-table runs: the reference's estimators with
# fewer trees/rounds, so a full 5-fold run stays in seconds at sf0.01. The
# country preset keeps the reference values (ml.ModelParams defaults).
MODEL_PARAMS = dict(lr_max_iter=100, rf_trees=30, rf_depth=6, gbt_rounds=10, gbt_depth=3)
MODEL_REGISTRATION = ("LogisticRegression", "RandomForest", "BoostedTrees", "XGBoost")

# What-if scenarios on model inputs (M7 with model rescoring).
MODEL_SCENARIOS = (
    {"scenario": "base", "changes": ()},
    {"scenario": "growth", "changes": (("n_orders", "mul", 1.5), ("revenue", "mul", 1.5))},
    {"scenario": "tax_up", "changes": (("avg_tax", "add", 0.01),)},
)
SCENARIO_COLUMNS = ("n_orders", "revenue", "avg_tax", "n_items")
