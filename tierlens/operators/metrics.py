"""Classification metrics as DataFrame queries.

One aggregate ``groupBy(keys, label, prediction).count()`` over the
predictions is the only pass over row data; every metric after it is
computed from that table, whose size is (models x folds x classes^2).

Definitions follow scikit-learn with ``zero_division=0``: the classes of a
group are the union of its labels and predictions; per class
precision = tp / predicted, recall = tp / support,
f1 = 2 tp / (support + predicted), each 0 when its divisor is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import dbl, fixed_text
from .stats import attach


def confusion_counts(pred: DataFrame, keys: Sequence[str] = ("model",), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Cell counts (non-empty cells) per group."""
    return pred.groupBy(*keys, F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def confusion_grid(counts: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """E1 as the dense matrix: a cell for each pair of the classes that any group has as label or prediction, 0
    where no row falls. The classes come as one scalar subquery; groups x classes^2 rows."""
    k = list(keys)
    seen = counts.select(F.explode(F.array("label", "prediction")).alias("c")).agg(F.array_sort(F.collect_set("c")).alias("classes"))
    groups = attach(counts.select(*k).distinct(), seen)
    cells = groups.select(*k, F.explode("classes").alias("label"), "classes").select(*k, "label", F.explode("classes").alias("prediction"))
    zero = cells.withColumn("n", F.lit(0).cast("long"))
    return zero.unionByName(counts.select(*k, "label", "prediction", F.col("n").cast("long").alias("n"))) \
        .groupBy(*k, "label", "prediction").agg(F.sum("n").alias("n"))


def report_lines(report: DataFrame, model: str = "model") -> DataFrame:
    """The class report as text lines (model, ordinal, line): classes by id, then the summary rows."""
    place = F.when(F.col("row_label") == "accuracy", 1).when(F.col("row_label") == "macro avg", 2) \
        .when(F.col("row_label") == "weighted avg", 3).otherwise(0)
    cell = lambda c: F.lpad(F.coalesce(fixed_text(c, 3), F.lit("")), 10, " ")
    line = F.concat(F.lpad("row_label", 13, " "), cell("precision"), cell("recall"), cell("f1"), F.lpad(F.col("support").cast("string"), 9, " "))
    at = place * 1_000_000 + F.coalesce(F.expr("try_cast(row_label AS INT)"), F.lit(0))
    return report.select(model, at.cast("int").alias("ordinal"), line.alias("line"))


def per_class(counts: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Per group and class: tp, support, predicted, precision, recall, f1.

    One aggregate, no joins: every confusion cell contributes to its label's
    class (support, and tp on the diagonal) and to its prediction's class
    (predicted). The classes are therefore exactly the union of labels and
    predictions seen in the group.
    """
    k = list(keys)
    n = F.col("n")
    contrib = F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.when(F.col("label") == F.col("prediction"), n)
                 .otherwise(F.lit(0)).cast("long").alias("tp"), n.cast("long").alias("sup"),
                 F.lit(0).cast("long").alias("prd")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("sup"), n.cast("long").alias("prd"))))
    sums = counts.select(*k, contrib.alias("c")).groupBy(*k, F.col("c.cls").alias("cls")).agg(
        F.sum("c.tp").alias("tp"), F.sum("c.sup").alias("support"), F.sum("c.prd").alias("predicted"))
    tpc, supc, prc = F.col("tp"), F.col("support"), F.col("predicted")
    return sums.select(
        *k, F.col("cls").cast("int").alias("cls"), tpc, supc, prc,
        F.when(prc == 0, dbl(0.0)).otherwise(tpc / prc).alias("precision"),
        F.when(supc == 0, dbl(0.0)).otherwise(tpc / supc).alias("recall"),
        F.when(supc + prc == 0, dbl(0.0)).otherwise(dbl(2.0) * tpc / (supc + prc)).alias("f1"))


def model_metrics(counts: DataFrame, keys: Sequence[str] = ("model",), at_risk_class: int = 2) -> DataFrame:
    """E2 + E3: accuracy, macro P/R/F1, weighted F1, at-risk recall
    (recall of the class whose label value is ``at_risk_class``; 0 if absent)."""
    pc = per_class(counts, keys)
    return pc.groupBy(*keys).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.coalesce(F.max(F.when(F.col("cls") == at_risk_class, F.col("recall"))), dbl(0.0)).alias("at_risk_recall"))


def class_report(counts: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """E5: per-class precision/recall/f1/support plus 'accuracy',
    'macro avg' and 'weighted avg' rows (the text report as a table). The
    three summary rows come from ONE aggregate per group, unpivoted."""
    k = list(keys)
    pc = per_class(counts, keys)
    rows = pc.select(*k, F.col("cls").cast("string").alias("row_label"), "precision", "recall", "f1",
                     F.col("support").cast("long").alias("support"))
    tot = F.sum("support")
    summ = pc.groupBy(*k).agg(
        tot.cast("long").alias("support"), (F.sum("tp") / tot).alias("acc"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("wf"))
    key_sql = ", ".join(f"`{c}`" for c in k)
    long = summ.selectExpr(
        *([key_sql] if k else []), "support",
        "stack(3, 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, "
        "'macro avg', mp, mr, mf, 'weighted avg', wp, wr, wf) AS (row_label, precision, recall, f1)")
    return rows.unionByName(long.select(*k, "row_label", "precision", "recall", "f1", "support"))


METRIC_COLS = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1", "at_risk_recall")


def metrics_long(metrics: DataFrame, id_cols: Sequence[str] = ("model",),
                 value_cols: Sequence[str] = METRIC_COLS) -> DataFrame:
    """K9: wide -> long (model, metric, score)."""
    return metrics.unpivot(list(id_cols), list(value_cols), "metric", "score")


CV_METRICS = (("accuracy", "accuracy"), ("f1_macro", "macro_f1"), ("f1_weighted", "weighted_f1"),
              ("recall_macro", "macro_recall"))


def cv_summary(fold_metrics: DataFrame, model: str = "model") -> DataFrame:
    """Per model the mean and population std of each CV metric."""
    aggs = []
    for name, src in CV_METRICS:
        aggs += [F.avg(src).alias(f"{name}_mean"), F.stddev_pop(src).alias(f"{name}_std")]
    return fold_metrics.groupBy(model).agg(*aggs)


def with_registration(df: DataFrame, order: Sequence[str], model: str = "model") -> DataFrame:
    """Attach the registration ordinal of each model (a literal map)."""
    m = F.create_map(*[x for i, name in enumerate(order) for x in (F.lit(name), F.lit(i))])
    return df.withColumn("registration", F.coalesce(m[F.col(model)], F.lit(len(order))))


def rank_models(metrics: DataFrame, by: str = "macro_f1", model: str = "model") -> DataFrame:
    """K2: models ordered by ``by`` desc (registration order breaks ties).
    The window runs over the one-row-per-model table only."""
    w = Window.orderBy(F.desc(by), F.asc("registration"), F.asc(model))
    return metrics.withColumn("rank", F.row_number().over(w).cast("int"))


def best_by_cv(summary: DataFrame, model: str = "model") -> DataFrame:
    """Max mean macro F1, then max mean weighted F1, then min std
    of macro F1; earliest registration wins remaining ties."""
    return summary.orderBy(F.desc("f1_macro_mean"), F.desc("f1_weighted_mean"), F.asc("f1_macro_std"),
                           F.asc("registration"), F.asc(model)).limit(1)


def best_on_test(metrics: DataFrame, model: str = "model") -> DataFrame:
    """Macro F1, at-risk recall, weighted F1, accuracy (all desc)."""
    return metrics.orderBy(F.desc("macro_f1"), F.desc("at_risk_recall"), F.desc("weighted_f1"),
                           F.desc("accuracy"), F.asc("registration"), F.asc(model)).limit(1)


def model_summary(metrics: DataFrame, model: str = "model") -> DataFrame:
    """Best and worst model by macro F1, the gap, and the best
    model's accuracy and at-risk recall (the numbers behind the narrative)."""
    key = F.struct(F.col("macro_f1"), (-F.col("registration")).alias("r"))
    best = F.max_by(F.struct(model, "macro_f1", "accuracy", "at_risk_recall"), key)
    worst = F.min_by(F.struct(model, "macro_f1"), key)
    one = metrics.agg(best.alias("b"), worst.alias("w"), F.count(F.lit(1)).alias("n_models"))
    return one.select(
        F.col("b")[model].alias("best_model"), F.col("w")[model].alias("worst_model"),
        F.col("b.macro_f1").alias("best_macro_f1"), F.col("w.macro_f1").alias("worst_macro_f1"),
        (F.col("b.macro_f1") - F.col("w.macro_f1")).alias("gap"),
        F.col("b.accuracy").alias("best_accuracy"), F.col("b.at_risk_recall").alias("best_at_risk_recall"),
        F.col("n_models").cast("long").alias("n_models"))
