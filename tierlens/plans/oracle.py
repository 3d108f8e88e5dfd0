"""DuckDB oracle SQL for every catalogue query (same column names).

The SQL is written independently of the Spark code: it recomputes each
result from the base tables with plain aggregates, window functions and
CASE expressions.
"""

from __future__ import annotations

from ..sources.fixtures import CUSTOMER_INDICATORS_SQL, DIRTY_SOURCE_SQL, PREDICTIONS_SQL
from .sqlbits import moments, r6, rowmean, safe_div, z

ORACLE: dict[str, str] = {}

C = f"c AS ({CUSTOMER_INDICATORS_SQL})"

_SCORE_COLS = ["balance", "revenue", "avg_order", "returned_share", "avg_discount"]

SCORED = f"""{C},
s AS (SELECT {moments(_SCORE_COLS)} FROM c),
sc AS (SELECT c.*, {rowmean([z('balance'), z('revenue'), z('avg_order')])}
                 - {rowmean([z('returned_share'), z('avg_discount')])} AS score
       FROM c CROSS JOIN s)"""

ORACLE["entity_risk_tier"] = f"""
WITH {SCORED},
t AS (SELECT quantile_cont(score, 1/3) AS t1, quantile_cont(score, 2/3) AS t2 FROM sc WHERE score IS NOT NULL)
SELECT entity_key, {r6('score')} AS stability_score,
       CAST(CASE WHEN score <= t1 THEN 2 WHEN score <= t2 THEN 1 ELSE 0 END AS INTEGER) AS stability_label
FROM sc CROSS JOIN t WHERE score IS NOT NULL
"""

# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------
D = f"d AS ({DIRTY_SOURCE_SQL})"
_BAL = "(CASE WHEN entity_key % 10 IN (0, 1, 2) THEN NULL ELSE src_balance END)"
_PCT = "round(src_max_disc * 100, 2)"
_CNT = "CAST(src_n_items * 1000 AS DOUBLE)"

ORACLE["clean_numeric_strings"] = f"""
WITH {D}
SELECT entity_key, name_txt, {r6(_BAL)} AS balance, {r6(_PCT)} AS max_disc_pct, {r6(_CNT)} AS items_k FROM d
"""

_NUM_RE = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
ORACLE["detect_numeric_columns"] = f"""
WITH {D},
x AS (
  SELECT 'name_txt' AS column_name, count(name_txt) AS n_values,
         count(*) FILTER (WHERE regexp_full_match(trim(replace(replace(replace(name_txt, '$', ''), '%', ''), ',', '')),
                                                  '{_NUM_RE}')) AS n_numeric FROM d
  UNION ALL SELECT 'bal_txt', count(*) FILTER (WHERE entity_key % 10 <> 2), count(*) FILTER (WHERE entity_key % 10 <> 2) FROM d
  UNION ALL SELECT 'pct_txt', count(src_max_disc), count(src_max_disc) FROM d
  UNION ALL SELECT 'cnt_txt', count(src_n_items), count(src_n_items) FROM d)
SELECT column_name, CAST(n_values AS BIGINT) AS n_values, CAST(n_numeric AS BIGINT) AS n_numeric,
       {r6("coalesce(CAST(n_numeric AS DOUBLE) / nullif(CAST(n_values AS DOUBLE), 0), 0.0::DOUBLE)")} AS numeric_share,
       coalesce(CAST(n_numeric AS DOUBLE) / nullif(CAST(n_values AS DOUBLE), 0), 0.0::DOUBLE) > 0.7 AS is_numeric
FROM x
"""

ORACLE["normalize_columns"] = f"""
WITH {D}
SELECT entity_key, {r6(_BAL)} AS balance, {r6(_PCT)} AS Max_Discount_pct, {r6(_CNT)} AS Items_1000,
       name_txt AS Customer_Name FROM d
"""

ORACLE["exclude_entities"] = """
WITH e AS (
  SELECT c_custkey AS entity_key, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS nation_name,
         c_mktsegment AS segment, c_acctbal AS balance
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT * FROM e
WHERE nation_name IS NULL OR nation_name NOT IN ('NATION_3', 'NATION_7', 'NATION_11', 'NATION_19', 'NATION_23')
"""

ORACLE["missing_flags"] = f"""
WITH {C}
SELECT entity_key, CAST(balance IS NULL AS INTEGER) AS balance_is_missing,
       CAST(avg_discount IS NULL AS INTEGER) AS avg_discount_is_missing,
       CAST(revenue IS NULL AS INTEGER) AS revenue_is_missing FROM c
"""

_PROFILE_D = f"""
WITH {D},
p AS (SELECT entity_key, name_txt, {_BAL} AS bal_txt, {_PCT} AS pct_txt, {_CNT} AS cnt_txt FROM d),
m AS (
  SELECT 0 AS ordinal, 'entity_key' AS column_name, 'bigint' AS dtype, count(*) FILTER (WHERE entity_key IS NULL) AS missing_count, count(*) AS n FROM p
  UNION ALL SELECT 1, 'name_txt', 'string', count(*) FILTER (WHERE name_txt IS NULL), count(*) FROM p
  UNION ALL SELECT 2, 'bal_txt', 'double', count(*) FILTER (WHERE bal_txt IS NULL OR isnan(bal_txt)), count(*) FROM p
  UNION ALL SELECT 3, 'pct_txt', 'double', count(*) FILTER (WHERE pct_txt IS NULL OR isnan(pct_txt)), count(*) FROM p
  UNION ALL SELECT 4, 'cnt_txt', 'double', count(*) FILTER (WHERE cnt_txt IS NULL OR isnan(cnt_txt)), count(*) FROM p)"""

ORACLE["missing_profile"] = f"""{_PROFILE_D}
SELECT CAST(ordinal AS INTEGER) AS ordinal, column_name, dtype, CAST(missing_count AS BIGINT) AS missing_count,
       round_even(missing_count * 100.0 / CAST(n AS DOUBLE), 2) AS missing_pct FROM m
"""

ORACLE["missing_total"] = f"""{_PROFILE_D}
SELECT CAST(sum(missing_count) AS BIGINT) AS missing_cells, CAST(max(n) * 5 AS BIGINT) AS total_cells,
       {r6("sum(missing_count) * 100.0 / CAST(max(n) * 5 AS DOUBLE)")} AS missing_pct FROM m
"""

_C_COLS = [("entity_key", "bigint"), ("segment", "string"), ("nation_key", "int"), ("balance", "double"),
           ("n_orders", "double"), ("n_items", "double"), ("revenue", "double"), ("avg_order", "double"),
           ("avg_tax", "double"), ("avg_discount", "double"), ("returned_share", "double")]
_C_MISS = "\n  UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS dtype, count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if t == "double" else "") + ") AS missing_count, count(*) AS n FROM c"
    for i, (c, t) in enumerate(_C_COLS))
ORACLE["missing_over_threshold"] = f"""
WITH {C}, m AS ({_C_MISS}),
p AS (SELECT CAST(ordinal AS INTEGER) AS ordinal, column_name, dtype, CAST(missing_count AS BIGINT) AS missing_count,
             round_even(missing_count * 100.0 / CAST(n AS DOUBLE), 2) AS missing_pct FROM m)
SELECT * FROM p WHERE missing_pct > 10 ORDER BY missing_pct DESC, ordinal LIMIT 10
"""

# ---------------------------------------------------------------------------
# Moments, quantiles, IQR
# ---------------------------------------------------------------------------
_L = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

ORACLE["column_moments"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, {r6(f'avg({c})')} AS mean, "
    f"{r6(f'stddev_samp({c})')} AS sd, {r6(f'min({c})')} AS min_value, {r6(f'max({c})')} AS max_value FROM lineitem"
    for c in _L)

ORACLE["column_quantiles"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {r6(f'quantile_cont({c}, 0.25)')} AS q25, {r6(f'quantile_cont({c}, 0.5)')} AS q50, "
    f"{r6(f'quantile_cont({c}, 0.75)')} AS q75 FROM lineitem" for c in _L)

_IQR = ("b AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in _L) + " FROM lineitem),\n"
    "bb AS (SELECT *, " + ", ".join(
        f"{c}_q1 - 1.5 * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) AS {c}_hi" for c in _L)
    + " FROM b)")

ORACLE["iqr_cap"] = f"""
WITH {_IQR}
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    r6(f"CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END") + f" AS {c}" for c in _L) + """
FROM lineitem CROSS JOIN bb
"""

ORACLE["iqr_cap_counts"] = f"WITH {_IQR}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {r6(f'max({c}_q1)')} AS q1, {r6(f'max({c}_q3)')} AS q3, {r6(f'max({c}_lo)')} AS lower_bound, "
    f"{r6(f'max({c}_hi)')} AS upper_bound, CAST(count(*) FILTER (WHERE {c} < {c}_lo) AS BIGINT) AS n_low, "
    f"CAST(count(*) FILTER (WHERE {c} > {c}_hi) AS BIGINT) AS n_high FROM lineitem CROSS JOIN bb" for c in _L)

# ---------------------------------------------------------------------------
# Features over fixture C
# ---------------------------------------------------------------------------
_RATIOS = {
    "revenue_per_order": safe_div("revenue", "n_orders"),
    "tax_to_discount": safe_div("avg_tax", "avg_discount"),
    "balance_per_revenue": safe_div("balance", "revenue"),
    "items_per_order": safe_div("n_items", "n_orders"),
    "discount_per_item": safe_div("avg_discount", "n_items"),
}


def _log1p0(x: str) -> str:
    return f"ln(1 + CASE WHEN {x} < 0 THEN 0.0::DOUBLE ELSE {x} END)"


_LOGS = {
    "log_revenue": _log1p0("revenue"),
    "log_orders": _log1p0("n_orders"),
    "log_balance": _log1p0("balance"),
    "abs_balance": "abs(balance)",
    "order_gap": "CASE WHEN avg_order - balance < 0 THEN 0.0::DOUBLE ELSE avg_order - balance END",
}
_ZCOLS = ["avg_discount", "returned_share", "avg_tax", "revenue_per_order", "balance", "avg_order", "n_items",
          "revenue"]
_REV = "(100.0::DOUBLE - coalesce(avg_discount, 50.0::DOUBLE))"
_INDEX = {
    "stress_index": f"{rowmean([z('avg_discount'), z('returned_share'), z('avg_tax')])} - "
                    f"{rowmean([z('revenue_per_order'), z('balance')])}",
    "pressure_pair": f"({z('avg_discount')} + {z('returned_share')}) / 2.0::DOUBLE",
    "health_index": f"{rowmean([z('balance'), z('avg_order')])} - "
                    f"{rowmean([z('returned_share'), z('avg_discount'), z('avg_tax')])}",
    "pressure_index": rowmean([z('returned_share'), z('avg_discount')]),
    "access_score": f"({z('avg_order')} + (CASE WHEN s.drev_sd IS NULL OR s.drev_sd = 0 THEN 0.0::DOUBLE "
                    f"ELSE ({_REV} - s.drev_mean) / s.drev_sd END)) / 2.0::DOUBLE",
    "capital_index": rowmean([z('balance'), z('avg_order'), z('n_items')]),
    "env_index": rowmean([z('revenue_per_order'), f"(-{z('balance')})", z('avg_tax')]),
    "stability_score": f"{rowmean([z('balance'), z('revenue'), z('avg_order')])} - "
                       f"{rowmean([z('returned_share'), z('avg_discount')])}",
}

FEAT = f"""{C},
l1 AS (SELECT c.*, {", ".join(f"{v} AS {k}" for k, v in {**_RATIOS, **_LOGS}.items())} FROM c),
s AS (SELECT {moments(_ZCOLS)}, avg({_REV}) AS drev_mean, stddev_samp({_REV}) AS drev_sd FROM l1),
f AS (SELECT l1.*, {", ".join(f"{v} AS {k}" for k, v in _INDEX.items())} FROM l1 CROSS JOIN s),
t AS (SELECT quantile_cont(stability_score, 1/3) AS t1, quantile_cont(stability_score, 2/3) AS t2
      FROM f WHERE stability_score IS NOT NULL),
fl AS (SELECT f.*, CAST(CASE WHEN stability_score <= t1 THEN 2 WHEN stability_score <= t2 THEN 1 ELSE 0 END
                        AS INTEGER) AS stability_label
       FROM f CROSS JOIN t WHERE stability_score IS NOT NULL)"""


def _feat_select(cols: list[str]) -> str:
    return f"WITH {FEAT}\nSELECT entity_key, " + ", ".join(f"{r6(c)} AS {c}" for c in cols) + " FROM f"


ORACLE["safe_ratio_features"] = _feat_select(list(_RATIOS))
ORACLE["log_abs_gap_features"] = _feat_select(list(_LOGS))
ORACLE["stress_index"] = _feat_select(["stress_index", "pressure_pair"])
ORACLE["pressure_index"] = _feat_select(["pressure_index", "capital_index"])
ORACLE["signed_mean_index"] = _feat_select(["health_index", "env_index"])
ORACLE["access_score"] = _feat_select(["access_score"])

_KEPT_DOUBLE = ["n_orders", "n_items", "avg_tax", "revenue_per_order", "tax_to_discount", "balance_per_revenue",
                "items_per_order", "discount_per_item", "log_revenue", "log_orders", "log_balance", "abs_balance",
                "order_gap", "stress_index", "pressure_pair", "capital_index", "env_index"]
ORACLE["drop_leaky"] = (f"WITH {FEAT}\nSELECT segment, nation_key, "
                        + ", ".join(f"{r6(c)} AS {c}" for c in _KEPT_DOUBLE) + ", stability_label FROM fl")

ORACLE["class_distribution"] = f"""
WITH {FEAT},
cnt AS (SELECT stability_label AS label, count(*) AS n FROM fl GROUP BY stability_label),
tot AS (SELECT count(*) AS total FROM fl)
SELECT label, CAST(n AS BIGINT) AS n, {r6("n / total * 100.0")} AS pct, round_even(n / total, 3) AS share,
       CASE label WHEN 0 THEN 'Stable' WHEN 1 THEN 'Watch' WHEN 2 THEN 'At-Risk' ELSE 'Unknown' END AS class_name
FROM cnt CROSS JOIN tot
"""

# ---------------------------------------------------------------------------
# Split, folds, weights
# ---------------------------------------------------------------------------
_SPLIT = """e AS (SELECT c_custkey AS entity_key, c_mktsegment AS label FROM customer),
cc AS (SELECT label, count(*) AS n FROM e GROUP BY label),
tt AS (SELECT sum(n) AS total, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS t FROM cc),
q0 AS (SELECT label, n, t * n / total AS cont, floor(t * n / total) AS fl, t FROM cc CROSS JOIN tt),
q1 AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, label DESC) AS rr, t - sum(fl) OVER () AS extra FROM q0),
q AS (SELECT label, CAST(fl + CASE WHEN rr <= extra THEN 1 ELSE 0 END AS BIGINT) AS quota FROM q1),
r AS (SELECT e.*, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(entity_key AS VARCHAR)), entity_key) AS rk
      FROM e),
sp AS (SELECT r.entity_key, r.label, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split
       FROM r JOIN q USING (label))"""

ORACLE["stratified_split"] = f"WITH {_SPLIT}\nSELECT * FROM sp"
ORACLE["stratified_split_counts"] = f"WITH {_SPLIT}\nSELECT label, split, count(*) AS n FROM sp GROUP BY label, split"
ORACLE["stratified_folds"] = f"""WITH {_SPLIT},
tr AS (SELECT entity_key, label, row_number() OVER (PARTITION BY label
         ORDER BY md5('43:' || CAST(entity_key AS VARCHAR)), entity_key) AS rk FROM sp WHERE split = 'train'),
-- rows in label order dealt to the folds in turn: how many of each class a fold gets
deal AS (SELECT label, (row_number() OVER (ORDER BY label) - 1) % 5 AS fold FROM tr),
per AS (SELECT c.label, f.fold, count(deal.fold) AS n FROM (SELECT DISTINCT label FROM tr) c CROSS JOIN (SELECT unnest(range(5)) AS fold) f
        LEFT JOIN deal ON deal.label = c.label AND deal.fold = f.fold GROUP BY c.label, f.fold),
cut AS (SELECT label, fold, sum(n) OVER (PARTITION BY label ORDER BY fold) AS upto FROM per)
SELECT entity_key, tr.label, CAST(min(fold) AS INTEGER) AS fold FROM tr JOIN cut ON cut.label = tr.label AND rk <= upto GROUP BY entity_key, tr.label
"""

_CW = """cw AS (SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY o_orderstatus),
ct AS (SELECT sum(n) AS total, count(*) AS k FROM cw),
w AS (SELECT label, n, total / (k * n) AS weight FROM cw CROSS JOIN ct)"""
ORACLE["class_weights"] = f"WITH {_CW}\nSELECT label, CAST(n AS BIGINT) AS n, {r6('weight')} AS weight FROM w"
ORACLE["sample_weights"] = (f"WITH {_CW}\nSELECT o_orderkey, o_orderstatus AS label, {r6('weight')} AS weight "
                            "FROM orders LEFT JOIN w ON o_orderstatus = w.label")

# ---------------------------------------------------------------------------
# Metrics over the PR fixture
# ---------------------------------------------------------------------------


def _metrics_cte(keys: str) -> str:
    k = keys
    return f"""pr AS ({PREDICTIONS_SQL}),
cnt AS (SELECT {k}, label, prediction, count(*) AS n FROM pr GROUP BY {k}, label, prediction),
cls AS (SELECT DISTINCT {k}, label AS cls FROM cnt UNION SELECT DISTINCT {k}, prediction AS cls FROM cnt),
sup AS (SELECT {k}, label AS cls, sum(n) AS support FROM cnt GROUP BY {k}, label),
pn AS (SELECT {k}, prediction AS cls, sum(n) AS predicted FROM cnt GROUP BY {k}, prediction),
tp AS (SELECT {k}, label AS cls, sum(n) AS tp FROM cnt WHERE label = prediction GROUP BY {k}, label),
pc0 AS (SELECT cls.*, CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(support, 0) AS BIGINT) AS support,
               CAST(coalesce(predicted, 0) AS BIGINT) AS predicted
        FROM cls LEFT JOIN sup USING ({k}, cls) LEFT JOIN pn USING ({k}, cls) LEFT JOIN tp USING ({k}, cls)),
pc AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0::DOUBLE ELSE tp / predicted END AS precision,
              CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE tp / support END AS recall,
              CASE WHEN support + predicted = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * tp / (support + predicted) END AS f1
       FROM pc0),
mm AS (SELECT {k}, sum(tp) / sum(support) AS accuracy, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
              avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1,
              coalesce(max(CASE WHEN cls = 2 THEN recall END), 0.0::DOUBLE) AS at_risk_recall
       FROM pc GROUP BY {k})"""


_MCOLS = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1", "at_risk_recall"]
_REG = ("CASE model WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 "
        "WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 ELSE 5 END")

ORACLE["confusion_matrix"] = (f"WITH {_metrics_cte('model')}\nSELECT model, CAST(label AS INTEGER) AS label, "
                              "CAST(prediction AS INTEGER) AS prediction, CAST(n AS BIGINT) AS n FROM cnt")
ORACLE["model_metrics"] = f"WITH {_metrics_cte('model')}\nSELECT model, " + ", ".join(
    f"{r6(c)} AS {c}" for c in _MCOLS) + " FROM mm"
ORACLE["at_risk_recall"] = (f"WITH {_metrics_cte('model, fold')}\nSELECT model, fold, "
                            f"{r6('at_risk_recall')} AS at_risk_recall FROM mm")
ORACLE["class_report"] = f"""WITH {_metrics_cte('model')}
SELECT model, CAST(cls AS VARCHAR) AS row_label, {r6('precision')} AS precision, {r6('recall')} AS recall,
       {r6('f1')} AS f1, support FROM pc
UNION ALL SELECT model, 'accuracy', NULL, NULL, {r6('sum(tp) / sum(support)')}, CAST(sum(support) AS BIGINT)
  FROM pc GROUP BY model
UNION ALL SELECT model, 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')},
  CAST(sum(support) AS BIGINT) FROM pc GROUP BY model
UNION ALL SELECT model, 'weighted avg', {r6('sum(precision * support) / sum(support)')},
  {r6('sum(recall * support) / sum(support)')}, {r6('sum(f1 * support) / sum(support)')},
  CAST(sum(support) AS BIGINT) FROM pc GROUP BY model
"""
ORACLE["metrics_long"] = f"WITH {_metrics_cte('model')}\n" + "\nUNION ALL\n".join(
    f"SELECT model, '{c}' AS metric, {r6(c)} AS score FROM mm" for c in _MCOLS)

_CVSUM = (f"{_metrics_cte('model, fold')},\ncv AS (SELECT model, "
          "avg(accuracy) AS accuracy_mean, stddev_pop(accuracy) AS accuracy_std, "
          "avg(macro_f1) AS f1_macro_mean, stddev_pop(macro_f1) AS f1_macro_std, "
          "avg(weighted_f1) AS f1_weighted_mean, stddev_pop(weighted_f1) AS f1_weighted_std, "
          "avg(macro_recall) AS recall_macro_mean, stddev_pop(macro_recall) AS recall_macro_std "
          f"FROM mm GROUP BY model),\ncvr AS (SELECT *, {_REG} AS registration FROM cv)")
_CVCOLS = ["accuracy_mean", "accuracy_std", "f1_macro_mean", "f1_macro_std", "f1_weighted_mean", "f1_weighted_std",
           "recall_macro_mean", "recall_macro_std"]
ORACLE["cv_summary"] = f"WITH {_CVSUM}\nSELECT model, " + ", ".join(f"{r6(c)} AS {c}" for c in _CVCOLS) + " FROM cv"
ORACLE["best_by_cv"] = (f"WITH {_CVSUM}\nSELECT model, " + ", ".join(f"{r6(c)} AS {c}" for c in _CVCOLS)
                        + " FROM cvr ORDER BY f1_macro_mean DESC, f1_weighted_mean DESC, f1_macro_std ASC, "
                          "registration, model LIMIT 1")
_MMR = f"{_metrics_cte('model')},\nmr AS (SELECT *, {_REG} AS registration FROM mm)"
ORACLE["rank_models"] = (f"WITH {_MMR}\nSELECT model, {r6('macro_f1')} AS macro_f1, CAST(row_number() OVER "
                         "(ORDER BY macro_f1 DESC, registration, model) AS INTEGER) AS rank FROM mr")
ORACLE["best_on_test"] = (f"WITH {_MMR}\nSELECT model, " + ", ".join(f"{r6(c)} AS {c}" for c in _MCOLS)
                          + " FROM mr ORDER BY macro_f1 DESC, at_risk_recall DESC, weighted_f1 DESC, accuracy DESC, "
                            "registration, model LIMIT 1")
ORACLE["model_summary"] = f"""WITH {_MMR},
b AS (SELECT * FROM mr ORDER BY macro_f1 DESC, registration ASC LIMIT 1),
w AS (SELECT * FROM mr ORDER BY macro_f1 ASC, registration DESC LIMIT 1)
SELECT b.model AS best_model, w.model AS worst_model, {r6('b.macro_f1')} AS best_macro_f1,
       {r6('w.macro_f1')} AS worst_macro_f1, {r6('b.macro_f1 - w.macro_f1')} AS gap,
       {r6('b.accuracy')} AS best_accuracy, {r6('b.at_risk_recall')} AS best_at_risk_recall,
       (SELECT CAST(count(*) AS BIGINT) FROM mr) AS n_models
FROM b CROSS JOIN w
"""

# ---------------------------------------------------------------------------
# Scoring
# ---------------------------------------------------------------------------
from ..presets import customer as _cp  # noqa: E402
from ..presets import country as _country  # noqa: E402


def _f(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _rule(r) -> str:
    return f"CASE WHEN coalesce({r.column}, {_f(r.absent_as)}) {r.op} {_f(r.threshold)} THEN '{r.message}' END"


_DEFAULTS = "CASE stability_label " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _cp.PRESET.default_drivers) \
    + " ELSE '' END"
ORACLE["risk_drivers"] = f"""WITH {FEAT},
rd AS (SELECT *, list_filter([{", ".join(_rule(r) for r in _cp.RULES)}], lambda x: x IS NOT NULL) AS fired FROM fl)
SELECT entity_key,
       array_to_string(list_slice(CASE WHEN len(fired) = 0 THEN [{_DEFAULTS}] ELSE fired END, 1, 4), ' | ') AS drivers,
       CAST(len(fired) AS INTEGER) AS n_fired,
       CASE stability_label WHEN 0 THEN 'Stable' WHEN 1 THEN 'Watch' WHEN 2 THEN 'At-Risk' ELSE 'Unknown' END AS class_name,
       CASE stability_label {" ".join(f"WHEN {k} THEN '{v}'" for k, v in _cp.PRESET.class_text)} ELSE 'Unknown' END
         AS class_text
FROM rd
"""


def _band(b) -> str:
    cond = " ".join(f"WHEN {b.source} {'>' if b.descending else '<'} {_f(t)} THEN '{lvl}'" for t, lvl in b.cuts)
    return f"CASE {cond} ELSE '{b.otherwise}' END AS {b.name}"


ORACLE["kpi_bands"] = f"WITH {FEAT}\nSELECT entity_key, {', '.join(_band(b) for b in _cp.BANDS)} FROM f"

ORACLE["top_values_per_row"] = f"""WITH {FEAT},
u AS ({" UNION ALL ".join(f"SELECT entity_key, '{k}' AS k, CAST({k} AS DOUBLE) AS v FROM f"
                          for k in _cp.TOP_VALUE_FEATURES)}),
r AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY v DESC, k ASC) AS rn FROM u WHERE v IS NOT NULL)
SELECT f.entity_key, coalesce(string_agg(k, ',' ORDER BY rn), '') AS top_features
FROM f LEFT JOIN r ON f.entity_key = r.entity_key AND rn <= 12 GROUP BY f.entity_key
"""

_SC_SCORE = (f"{rowmean([z('balance'), z('revenue'), z('avg_order')])} - "
             f"{rowmean([z('returned_share'), z('avg_discount')])}")
ORACLE["scenario_delta"] = f"""WITH {SCORED},
v(scenario) AS (VALUES ('base'), ('shock'), ('relief')),
x AS (SELECT sc.entity_key, sc.score AS base_score, v.scenario, sc.revenue, sc.avg_order, sc.returned_share,
             CASE WHEN v.scenario = 'shock' THEN sc.avg_discount * 1.5::DOUBLE ELSE sc.avg_discount END AS avg_discount,
             CASE WHEN v.scenario = 'relief' THEN sc.balance + 1000.0::DOUBLE ELSE sc.balance END AS balance
      FROM sc CROSS JOIN v),
y AS (SELECT x.*, {_SC_SCORE} AS score FROM x CROSS JOIN s)
SELECT entity_key, scenario, {r6('score')} AS score, {r6('score - base_score')} AS delta FROM y
"""

ORACLE["range_violations"] = f"""WITH {C}
SELECT entity_key,
       concat_ws(',', {", ".join(f"CASE WHEN {r.column} < {_f(r.low)} OR {r.column} > {_f(r.high)} THEN '{r.column}' END"
                                 for r in _cp.RANGES)}) AS violations,
       CAST({" + ".join(f"(CASE WHEN {r.column} < {_f(r.low)} OR {r.column} > {_f(r.high)} THEN 1 ELSE 0 END)"
                        for r in _cp.RANGES)} AS INTEGER) AS n_violations,
       {", ".join(f"{r6(f'coalesce({r.column}, {_f(r.default)})')} AS {r.column}" for r in _cp.RANGES)}
FROM c
"""


def _lin(terms, div) -> str:
    parts = []
    for col, coef in terms:
        x = f"coalesce({col}, {_f(_cp.SERVING_DEFAULTS[col])})" if col in _cp.SERVING_DEFAULTS else col
        parts.append(f"{x} * {_f(coef)}")
    return f"({' + '.join(parts)}) / {_f(div)}"


ORACLE["serving_linear_features"] = (f"WITH {FEAT}\nSELECT entity_key, "
                                     + ", ".join(f"{r6(_lin(t, d))} AS {n}" for n, t, d in _cp.SERVING_LINEAR)
                                     + " FROM f")

_DIV = [("GDP_per_Capita", "GDP", "Population"), ("Tax_Burden_Index", "Total_Tax_Rate_pct", "Tax_Revenue_pct"),
        ("Healthcare_Access_Gap", "OOP_Health_Expenditure_pct", "1.5"), ("Urbanization_Rate", "Urban_Population", "Population"),
        ("Dependency_Ratio_Proxy", "Birth_Rate", "Labor_Participation_pct"), ("Military_Burden", "Armed_Forces", "Population"),
        ("CO2_per_Capita", "CO2_Emissions", "Population"), ("CO2_per_GDP", "CO2_Emissions", "GDP"),
        ("Resource_Land_Balance", "Forested_Area_pct", "Agricultural_Land_pct"), ("Fuel_Cost_Pressure", "Gasoline_Price", "Minimum_Wage")]
_SERVED = [(n, f"{a} / CAST({b} AS DOUBLE)") for n, a, b in _DIV] + [
    ("Log_GDP", "ln(1 + greatest(GDP, 0))"), ("Log_Population", "ln(1 + greatest(Population, 0))"),
    ("Education_Pipeline", "0.5::DOUBLE"), ("Education_Gap_Index", "50.0::DOUBLE"), ("Abs_Latitude", "abs(Latitude)"),
    ("Economic_Stress_Index", "Unemployment_Rate_pct * 0.02::DOUBLE + CPI_Change_pct * 0.01::DOUBLE + Total_Tax_Rate_pct * 0.005::DOUBLE"
     " - GDP / Population * 1e-6::DOUBLE - Labor_Participation_pct * 0.005::DOUBLE"),
    ("Inflation_Unemployment_Pressure", "(CPI_Change_pct * 0.01::DOUBLE + Unemployment_Rate_pct * 0.02::DOUBLE) / 2"),
    ("Human_Capital_Index", "(0.75::DOUBLE + Labor_Participation_pct * 0.005::DOUBLE) / 3"),
    ("Workforce_Stability_Score", "(Labor_Participation_pct * 0.005::DOUBLE + 0.25::DOUBLE - Unemployment_Rate_pct * 0.01::DOUBLE - Birth_Rate * 0.005::DOUBLE) / 4"),
    ("Population_Pressure_Index", "(Density_per_km2 * 0.0001::DOUBLE + Birth_Rate * 0.01::DOUBLE + Fertility_Rate * 0.05::DOUBLE) / 3"),
    ("Environmental_Pressure_Index", "(CO2_Emissions / Population * 0.01::DOUBLE - Forested_Area_pct * 0.005::DOUBLE + Agricultural_Land_pct * 0.003::DOUBLE) / 3")]
ORACLE["serving_features"] = f"""WITH i AS (SELECT c_custkey AS entity_key,
  {", ".join(f"(abs(CAST(c_acctbal AS DOUBLE)) / 10000.0::DOUBLE + 0.5::DOUBLE) * {_f(r.default)} AS {r.column}" for r in _country.RANGES)} FROM customer)
SELECT entity_key, {", ".join(f"{r6(x)} AS {n}" for n, x in _SERVED)} FROM i"""

ORACLE["align_features"] = (f"WITH {FEAT}\nSELECT entity_key, "
                            + ", ".join(f"{r6(c)} AS {c}" for c in _cp.MODEL_FEATURES)
                            + ", 0.0::DOUBLE AS n_returns, CAST(0 AS INTEGER) AS balance_is_missing FROM f")

# ---------------------------------------------------------------------------
# Preprocessing fits
# ---------------------------------------------------------------------------
_IMP = ("balance", "avg_discount", "revenue", "returned_share")
ORACLE["impute_median_scale"] = f"""WITH {C},
m AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS {c}_med" for c in _IMP)} FROM c),
i AS (SELECT entity_key, {", ".join(f"coalesce({c}, {c}_med) AS {c}" for c in _IMP)} FROM c CROSS JOIN m),
s AS (SELECT {moments(_IMP, ddof=0)} FROM i)
SELECT entity_key, {", ".join(r6(f"({c} - {c}_mean) / CASE WHEN {c}_sd IS NULL OR {c}_sd = 0 THEN 1.0::DOUBLE ELSE {c}_sd END")
                              + f" AS {c}" for c in _IMP)}
FROM i CROSS JOIN s
"""

_PRIOS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
ORACLE["impute_mode_onehot"] = """WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders),
md AS (SELECT priority AS mode FROM o WHERE priority IS NOT NULL GROUP BY priority
       ORDER BY count(*) DESC, priority ASC LIMIT 1),
i AS (SELECT o_orderkey, coalesce(priority, mode) AS priority FROM o CROSS JOIN md)
SELECT o_orderkey, priority, """ + ", ".join(
    f"CAST(priority = '{p}' AS INTEGER) AS \"priority_{p}\"" for p in _PRIOS) + " FROM i"

ORACLE["stream_score"] = f"""WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events),
z AS (SELECT event_id, event_type, value,
             CASE WHEN sd IS NULL OR sd = 0 THEN 0.0::DOUBLE ELSE (value - m) / sd END AS z_value FROM events CROSS JOIN s)
SELECT event_id, event_type, {r6('value')} AS value, {r6('z_value')} AS z_value,
       CASE WHEN z_value > 1.0::DOUBLE THEN 'high' WHEN z_value > -1.0::DOUBLE THEN 'normal' ELSE 'low' END AS level
FROM z
"""

# ---------------------------------------------------------------------------
# The flow from a raw file and the stored evaluation
# ---------------------------------------------------------------------------
ORACLE["flow_raw"] = f"""WITH {C}
SELECT CAST(entity_key AS VARCHAR) AS entity_key, CAST(balance IS NULL AS INTEGER) AS no_balance,
       CAST(avg_discount IS NULL AS INTEGER) AS no_discount, CAST(segment IS NULL AS INTEGER) AS no_segment,
       CASE WHEN balance < 0 THEN '$-' ELSE '$' END || format('{{:,.2f}}', abs(balance)) || ' ' AS balance_text, 'none, so far' AS notes FROM c
UNION ALL SELECT 'TOTAL', 1, 1, 1, NULL, NULL
"""
ORACLE["flow_cleaned"] = (f"WITH {C}\nSELECT entity_key, segment, nation_key, " + ", ".join(f"{r6(c)} AS {c}" for c in _cp.TOP_VALUE_COLUMNS)
                          + ", CAST(balance IS NULL AS INTEGER) AS balance_is_missing, CAST(avg_discount IS NULL AS INTEGER) AS avg_discount_is_missing FROM c")
_READY = ["nation_key", "balance_is_missing", "avg_discount_is_missing"]
_FLAGGED = f"""{FEAT},
ready AS (SELECT *, CAST(balance IS NULL AS INTEGER) AS balance_is_missing, CAST(avg_discount IS NULL AS INTEGER) AS avg_discount_is_missing FROM fl)"""
ORACLE["flow_model_ready"] = (f"WITH {_FLAGGED}\nSELECT entity_key, segment, " + ", ".join(f"{r6(f'CAST({c} AS DOUBLE)')} AS {c}" for c in _READY + _KEPT_DOUBLE) + ", stability_label FROM ready")
ORACLE["flow_feature_types"] = f"WITH {_FLAGGED}\n" + " UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, 'numeric' AS kind, count({c}) AS n_values FROM ready" for c in _READY + _KEPT_DOUBLE]
    + ["SELECT 'segment', 'categorical', count(segment) FROM ready"])
ORACLE["flow_split"] = f"""WITH {FEAT},
per_class AS (SELECT stability_label AS label, count(*) AS n, sum(count(*)) OVER () AS total FROM fl GROUP BY stability_label),
wanted AS (SELECT *, CAST(ceil(total / 5) AS BIGINT) AS want FROM per_class),
whole AS (SELECT *, (want * n) // total AS base, (want * n) % total AS rest FROM wanted),
quotas AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label DESC) <= want - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM whole),
ranked AS (SELECT entity_key, stability_label, row_number() OVER (PARTITION BY stability_label ORDER BY md5('42:' || CAST(entity_key AS VARCHAR)), CAST(entity_key AS VARCHAR)) AS rk FROM fl)
SELECT entity_key, stability_label, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quotas ON label = stability_label
"""


def _runs(of: str) -> str:
    """The rows of a metric query for the stored runs: over all predictions, and over those of fold 0."""
    every = of
    first = of.replace(f"pr AS ({PREDICTIONS_SQL})", f"pr AS (SELECT * FROM ({PREDICTIONS_SQL}) WHERE fold = 0)")
    assert first != every
    return f"SELECT 'all' AS run, * FROM ({every}) UNION ALL SELECT 'fold 0', * FROM ({first})"


ORACLE["stored_metrics"] = _runs(ORACLE["model_metrics"])
ORACLE["stored_class_report"] = _runs(ORACLE["class_report"])
ORACLE["stored_summary"] = _runs(ORACLE["model_summary"])
ORACLE["stored_confusion_grid"] = _runs(f"""WITH {_metrics_cte('model')},
k AS (SELECT label AS c FROM cnt UNION SELECT prediction FROM cnt)
SELECT m.model, CAST(a.c AS INTEGER) AS label, CAST(b.c AS INTEGER) AS prediction, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT model FROM cnt) m CROSS JOIN k a CROSS JOIN k b
LEFT JOIN cnt ON cnt.model = m.model AND cnt.label = a.c AND cnt.prediction = b.c""")
_CELL = lambda c: f"lpad(coalesce(printf('%.3f', round_even({c}, 3)), ''), 10, ' ')"
# unrounded: the report rounds once, to what it shows
ORACLE["report_text"] = f"""WITH r AS ({ORACLE['class_report'].replace(', 6) + 0.0::DOUBLE)', ', 15) + 0.0::DOUBLE)')})
SELECT lpad(row_label, 13, ' ') || {_CELL('precision')} || {_CELL('recall')} || {_CELL('f1')} || lpad(CAST(support AS VARCHAR), 9, ' ') AS line FROM r
"""

ORACLE["stream_tiers"] = f"""WITH {SCORED},
t AS (SELECT quantile_cont(score, 1/3) AS t1, quantile_cont(score, 2/3) AS t2 FROM sc WHERE score IS NOT NULL),
newest AS (SELECT entity_key, CASE WHEN entity_key % 3 = 0 THEN 2 ELSE 1 END AS version,
             CASE WHEN entity_key % 3 = 0 THEN balance + 1000 ELSE balance END AS balance,
             CASE WHEN entity_key % 3 = 0 THEN revenue * 1.5 ELSE revenue END AS revenue, avg_order, returned_share, avg_discount FROM c),
n AS (SELECT entity_key, version, {rowmean([z('balance'), z('revenue'), z('avg_order')])} - {rowmean([z('returned_share'), z('avg_discount')])} AS score
      FROM newest CROSS JOIN s)
SELECT entity_key, CAST(version AS INTEGER) AS version, {r6('score')} AS stability_score,
       CAST(CASE WHEN score <= t1 THEN 2 WHEN score <= t2 THEN 1 ELSE 0 END AS INTEGER) AS stability_label
FROM n CROSS JOIN t WHERE score IS NOT NULL
"""

_LOTS = """v AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 9 <> 0 THEN
    concat_ws('-', l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER)) END AS lot,
  CASE WHEN l_orderkey % 9 <> 0 THEN l_returnflag END AS returned FROM lineitem),
g AS (SELECT 'lot' AS column_name, lot AS category, count(*) AS n FROM v WHERE lot IS NOT NULL GROUP BY lot
  UNION ALL SELECT 'returned', returned, count(*) FROM v WHERE returned IS NOT NULL GROUP BY returned),
d AS (SELECT column_name, category, row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS ordinal, n FROM g)"""

ORACLE["category_ordinals"] = f"WITH {_LOTS} SELECT column_name, category, ordinal, n FROM d"

ORACLE["sparse_one_hot"] = f"""WITH {_LOTS},
m AS (SELECT column_name, arg_min(category, (-n, category)) AS mode, count(*) AS size FROM d GROUP BY column_name),
f AS (SELECT l_orderkey, l_linenumber, coalesce(lot, (SELECT mode FROM m WHERE column_name = 'lot')) AS lot,
      coalesce(returned, (SELECT mode FROM m WHERE column_name = 'returned')) AS returned FROM v)
SELECT l_orderkey, l_linenumber, a.ordinal || ',' || (b.ordinal + (SELECT size FROM m WHERE column_name = 'lot')) AS slots
FROM f JOIN d a ON a.column_name = 'lot' AND a.category = lot JOIN d b ON b.column_name = 'returned' AND b.category = returned"""
