"""Stratified split and folds with exact per-class quotas.

Order within a class is ``md5('<seed>:<key>')`` then key: deterministic,
independent of partitioning, and reproducible in any SQL engine.

Scale shape. A split needs no rank of every row, only the (md5, key) at
which a class's quota is full; folds need k - 1 such cuts. Each class is
dealt into hash buckets (the first ``bucket_digits`` hex digits of the md5,
16^digits buckets, uniform by construction), and then

1. one aggregate counts rows per (class, bucket): the only full pass with
   an exchange, of one row per class, bucket and task;
2. a running total over that small table finds the bucket of each cut;
3. rows of the cut buckets alone (one in 65,536 of a class) are ranked;
4. every row is compared with its class's cuts, which come as one map
   through a scalar subquery: a projection.

So the data side is never shuffled or sorted, whatever the classes' sizes.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import attach


def order_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def class_key(label: str) -> Column:
    """A label as text without nulls, so that a null label is a class of its own and a key of a map."""
    return F.coalesce(F.concat(F.lit("v"), F.col(label).cast("string")), F.lit(""))


def class_map(table: DataFrame, label: str, value: Column) -> DataFrame:
    """One row with a map from class key to ``value``: per-class state in the form ``attach`` applies. It has one
    entry per class."""
    pairs = table.select(F.struct(class_key(label).alias("k"), value.alias("v")).alias("e"))
    return pairs.agg(F.map_from_entries(F.collect_list("e")).alias("__map"))


def with_class_value(df: DataFrame, label: str, one_row: DataFrame, out: str) -> DataFrame:
    """Add each row's entry of a ``class_map``: a projection, so a hot class costs nothing extra."""
    d = attach(df, one_row)
    return d.withColumn(out, F.try_element_at("__map", class_key(label))).drop("__map")


def stratified_rank(df: DataFrame, label: str, key: str, seed: int, rank_col: str = "rank",
                    bucket_digits: int = 4) -> DataFrame:
    """Add the exact 1-based rank of each row within its class: the running total of earlier buckets plus the
    row number inside the row's (class, bucket). For callers that need every rank; split and folds do not."""
    h, b = "__h", "__b"
    d = df.withColumn(h, order_hash(key, seed)).withColumn(b, F.substring(F.col(h), 1, bucket_digits))
    counts = d.groupBy(label, b).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(label).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label, b, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    within = Window.partitionBy(label, b).orderBy(h, key)
    ranked = d.withColumn("__rn", F.row_number().over(within))
    # null-safe join: a NULL label is a class of its own
    j = ranked.join(offsets, ranked[label].eqNullSafe(offsets[label]) & (ranked[b] == offsets[b]))
    return j.select(*[ranked[c] for c in df.columns],
                    (offsets["__off"] + ranked["__rn"]).cast("long").alias(rank_col))


def rank_cuts(df: DataFrame, label: str, key: str, seed: int, wanted: DataFrame, bucket_digits: int = 4) -> DataFrame:
    """One row with a map from class key to the (h, k) pairs that stand at the ranks ``wanted`` (label, ranks) in
    the class's order; rank 0 is a pair below all rows."""
    d = df.select(class_key(label).alias("c"), order_hash(key, seed).alias("h"), F.col(key).alias("k"))
    d = d.withColumn("b", F.substring("h", 1, bucket_digits))
    counts = d.groupBy("c", "b").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("c").orderBy("b"))
    counts = counts.withColumn("upto", upto)
    asked = wanted.select(class_key(label).alias("c"), F.explode(F.array_distinct("ranks")).alias("rank"))
    at = counts.join(asked, "c").filter((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
    at = at.select("c", "b", (F.col("rank") - F.col("upto") + F.col("n")).alias("r"))
    found = d.join(at.groupBy("c", "b").agg(F.collect_list("r").alias("rs")), ["c", "b"])
    found = found.withColumn("rn", F.row_number().over(Window.partitionBy("c", "b").orderBy("h", "k")))
    cuts = found.filter(F.array_contains("rs", F.col("rn").cast("long"))).select("c", F.struct("h", "k").alias("cut"))
    low = asked.filter("rank = 0").select("c", F.struct(F.lit("").alias("h"), F.lit(None).cast(df.schema[key].dataType).alias("k")).alias("cut"))
    per = cuts.unionByName(low).groupBy("c").agg(F.collect_list("cut").alias("cuts"))
    return per.agg(F.map_from_entries(F.collect_list(F.struct("c", "cuts"))).alias("__map"))


def above(df: DataFrame, label: str, key: str, seed: int, cuts: DataFrame, out: str) -> DataFrame:
    """Add how many of its class's cuts a row stands above. Rows that share a key stay together."""
    d = with_class_value(df, label, cuts, "__cuts")
    h, k = order_hash(key, seed), F.col(key)
    over = F.filter("__cuts", lambda c: (h > c["h"]) | ((h == c["h"]) & F.coalesce(k > c["k"], F.lit(False))))
    return d.withColumn(out, F.size(F.coalesce(over, F.array()))).drop("__cuts")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """A3 counts per class (one row per class)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def test_quotas(counts: list[tuple], fraction: float) -> dict:
    """Exact per-class test quotas: total ceil(fraction * n) (exact decimal
    arithmetic), split by largest remainder of total * n_c / n, remainder
    ties to the higher class id (reproduces 12/13/13 of 63/63/63)."""
    n = sum(c for _, c in counts)
    if n == 0:
        return {}
    total = math.ceil(Fraction(str(fraction)) * n)
    cont = {k: total * c / n for k, c in counts}
    base = {k: math.floor(v) for k, v in cont.items()}
    left = total - sum(base.values())
    order = sorted(counts, key=lambda kc: (cont[kc[0]] - base[kc[0]], _sortable(kc[0])), reverse=True)
    for k, _ in order[:left]:
        base[k] += 1
    return base


def _sortable(k):
    return (k is not None, k)


def quota_table(df: DataFrame, label: str, fraction: float) -> DataFrame:
    """(label, n, quota): one row per class. ``test_quotas``'s rule as exact integer arithmetic over the class
    counts; the window runs over that table."""
    f = Fraction(str(fraction))
    big = lambda c: c.cast("decimal(38,0)")
    counts = class_counts(df, label)
    whole = attach(counts, counts.agg(F.sum("n").alias("__n")))
    total = F.expr(f"(__n * {f.numerator} + {f.denominator - 1}) div {f.denominator}")  # rounded up
    whole = whole.withColumn("__t", total.cast("long")).withColumn("__p", big(F.col("__t")) * big(F.col("n")))
    whole = whole.withColumn("__base", F.expr("cast(__p div __n as bigint)")).withColumn("__rest", F.expr("__p % __n"))
    left = F.col("__t") - F.sum("__base").over(Window.partitionBy(F.lit(1)))
    turn = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("__rest"), F.col(label).desc_nulls_last()))
    return whole.select(label, "n", (F.col("__base") + F.when(turn <= left, 1).otherwise(0)).alias("quota"))


def stratified_split(df: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42,
                     split_col: str = "split", bucket_digits: int = 4) -> DataFrame:
    """Mark each row 'test' or 'train' with exact per-class quotas."""
    wanted = quota_table(df, label, fraction).select(label, F.array("quota").alias("ranks"))
    cuts = rank_cuts(df, label, key, seed, wanted, bucket_digits)
    d = above(df, label, key, seed, cuts, "__above")
    return d.withColumn(split_col, F.when(F.col("__above") == 0, F.lit("test")).otherwise(F.lit("train"))).drop("__above")


def fold_sizes(df: DataFrame, label: str, k: int) -> DataFrame:
    """(label, n, upto): rows of each class in folds 0..i together. Rows in label order are dealt to the folds in
    turn, so the folds' totals, and each class's share of them, differ by one row at most."""
    counts = class_counts(df, label)
    start = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy(F.col(label).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = counts.withColumn("__s", start)
    # places of fold i among __s .. __s + n - 1
    size = lambda i: F.expr(f"(__s + n + {k - 1 - i}) div {k} - (__s + {k - 1 - i}) div {k}")
    upto, total = [], None
    for i in range(k):
        total = size(i) if total is None else total + size(i)
        upto.append(total.cast("long"))
    return dealt.select(label, "n", F.array(*upto).alias("upto"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 43,
                     fold_col: str = "fold", bucket_digits: int = 4) -> DataFrame:
    """Fold i takes the next rows of each class in md5 order, as many as ``fold_sizes`` deals it. Empty folds of
    a class have equal cuts and are stepped over."""
    sizes = fold_sizes(df, label, k)
    cuts = rank_cuts(df, label, key, seed, sizes.select(label, F.slice("upto", 1, k - 1).alias("ranks")), bucket_digits)
    first = with_class_value(above(df, label, key, seed, cuts, "__above"), label, class_map(sizes, label, F.col("upto")), "__upto")
    # the cuts a row stands above are the distinct values of upto; its fold is the first whose upto lies beyond them
    distinct = F.array_distinct(F.slice("__upto", 1, k - 1))
    floor = F.when(F.col("__above") == 0, F.lit(0)).otherwise(F.get(distinct, F.col("__above") - 1))
    fold = F.size(F.filter("__upto", lambda u: u <= floor))
    return first.withColumn(fold_col, fold.cast("int")).drop("__above", "__upto")


def n_classes(df: DataFrame, label: str) -> int:
    """Number of distinct non-null labels."""
    return df.agg(F.count_distinct(label)).first()[0]


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    counts = class_counts(df, label)
    tot = counts.agg(F.sum("n").alias("__total"), F.count(F.lit(1)).alias("__k"))
    return attach(counts, tot).select(
        label, F.col("n").cast("long").alias("n"),
        (F.col("__total") / (F.col("__k") * F.col("n"))).alias("weight"))


def sample_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Per-row weight from the class weights, applied as one map: a label that a third of all rows share costs
    no shuffle, and a null label has the weight of its class."""
    return with_class_value(df, label, class_map(class_weights(df, label), label, F.col("weight")), weight_col)


def train_test_split(df: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42,
                     max_strata: int = 6, split_col: str = "split") -> DataFrame:
    """W3 with the A6 decision: stratify only when the label has at most
    ``max_strata`` distinct values (2 x the number of tiers in the
    reference); otherwise one md5-ordered split of all rows. The distinct
    count is one aggregate, taken before any per-class table is built."""
    if n_classes(df, label) <= max_strata:
        return stratified_split(df, label, key, fraction, seed, split_col)
    tmp = df.withColumn("__all", F.lit(0))
    return stratified_split(tmp, "__all", key, fraction, seed, split_col).drop("__all")
