"""Entity tables derived from the driver's TPC-H-like tables (FIXTURES.md).

Fixture C ("customer indicators") is built the scale way: line items are
pre-aggregated per order (map-side partial aggregation, hash-partitioned on
the order key), joined to orders on that same key, re-aggregated per
customer (again partial first, so a customer owning a third of all orders
is only a handful of partial rows per task) and left-joined to customer.

Money sums are exact: every price, tax and discount has two decimals, so
they are summed as BIGINT cents (round(x * 100)), a primitive, codegen'd
aggregate (DECIMAL(18,2) sums widen to 28 digits and fall back to
BigDecimal, 2x slower). An exact sum does not depend on partitioning or
summation order, and cents / 100.0 is the same IEEE division an engine
uses to turn an exact decimal into a double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import dbl
from .tables import table



def cents(c: str):
    """Exact integer cents of a two-decimal money column."""
    return F.round(F.col(c) * 100.0).cast("long")


def money(c) -> F.Column:
    """An exact cents sum as DOUBLE."""
    return (F.col(c) if isinstance(c, str) else c) / 100.0


def order_line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: line count, exact money sums and returned-line count."""
    li = table(spark, sf_dir, "lineitem",
               ["l_orderkey", "l_extendedprice", "l_tax", "l_discount", "l_returnflag"])
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(cents("l_extendedprice")).alias("s_price"),
        F.sum(cents("l_tax")).alias("s_tax"),
        F.sum(cents("l_discount")).alias("s_disc"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
    )


def customer_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture C: one row per customer with indicator columns.

    Null/zero rules (deterministic, so every engine agrees): balance NULL
    when c_custkey % 7 = 0; revenue 0 when % 13 = 0; avg_discount NULL when
    % 11 = 0. No row is dropped.
    """
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    per_order = order_line_totals(spark, sf_dir)
    per_cust = (orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
                .groupBy("o_custkey").agg(
                    F.count(F.lit(1)).alias("k_orders"),
                    F.sum("n_lines").alias("k_items"),
                    F.sum("s_price").alias("k_price"),
                    F.sum("s_tax").alias("k_tax"),
                    F.sum("s_disc").alias("k_disc"),
                    F.sum("n_ret").alias("k_ret")))
    cust = table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"])
    j = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
    key = F.col("c_custkey")
    items = F.col("k_items").cast("double")
    return j.select(
        key.alias("entity_key"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
        F.when(key % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("balance"),
        F.coalesce(F.col("k_orders").cast("double"), dbl(0.0)).alias("n_orders"),
        F.coalesce(items, dbl(0.0)).alias("n_items"),
        F.when(key % 13 == 0, dbl(0.0)).otherwise(F.coalesce(money("k_price"), dbl(0.0)))
        .alias("revenue"),
        (money("k_price") / items).alias("avg_order"),
        (money("k_tax") / items).alias("avg_tax"),
        F.when(key % 11 == 0, F.lit(None).cast("double"))
        .otherwise(money("k_disc") / items).alias("avg_discount"),
        (F.col("k_ret").cast("double") / items).alias("returned_share"),
    )


CUSTOMER_INDICATORS_SQL = """
WITH per_order AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s_price,
         sum(CAST(l_tax AS DECIMAL(18,2))) AS s_tax,
         sum(CAST(l_discount AS DECIMAL(18,2))) AS s_disc,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret
  FROM lineitem GROUP BY l_orderkey),
per_cust AS (
  SELECT o_custkey, count(*) AS k_orders, sum(n_lines) AS k_items, sum(s_price) AS k_price,
         sum(s_tax) AS k_tax, sum(s_disc) AS k_disc, sum(n_ret) AS k_ret
  FROM orders JOIN per_order ON o_orderkey = l_orderkey GROUP BY o_custkey)
SELECT c_custkey AS entity_key, c_mktsegment AS segment, c_nationkey AS nation_key,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance,
       coalesce(CAST(k_orders AS DOUBLE), 0.0::DOUBLE) AS n_orders,
       coalesce(CAST(k_items AS DOUBLE), 0.0::DOUBLE) AS n_items,
       CASE WHEN c_custkey % 13 = 0 THEN 0.0::DOUBLE ELSE coalesce(CAST(k_price AS DOUBLE), 0.0::DOUBLE) END AS revenue,
       CAST(k_price AS DOUBLE) / CAST(k_items AS DOUBLE) AS avg_order,
       CAST(k_tax AS DOUBLE) / CAST(k_items AS DOUBLE) AS avg_tax,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(k_disc AS DOUBLE) / CAST(k_items AS DOUBLE) END AS avg_discount,
       CAST(k_ret AS DOUBLE) / CAST(k_items AS DOUBLE) AS returned_share
FROM customer LEFT JOIN per_cust ON c_custkey = o_custkey
"""


def raw_customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture R: fixture C as the text of a raw indicator file, with a header that holds a line break, currency and
    comma numbers, blanks and NA tokens for missing values, a column without use and a row of totals. Every number
    in the text reads back as the very double of fixture C."""
    c = customer_indicators(spark, sf_dir)
    money2 = lambda x: F.concat(F.lit("$"), F.format_number(F.col(x), 2), F.lit(" "))
    plain = lambda x: F.col(x).cast("string")
    rows = c.select(
        plain("entity_key").alias("entity_key"), F.col("segment").alias("Segment Name"), plain("nation_key").alias("Nation\nKey"),
        F.coalesce(money2("balance"), F.lit("")).alias("Balance ($)"), F.format_number("n_orders", 0).alias("Orders"),
        F.format_number("n_items", 0).alias("Items"), money2("revenue").alias("Revenue, total ($)"), plain("avg_order").alias("Avg-Order"),
        plain("avg_tax").alias("Avg.Tax"), F.coalesce(plain("avg_discount"), F.lit("N/A")).alias("Avg Discount"),
        plain("returned_share").alias("Returned Share"), F.lit("none, so far").alias("Notes"))
    total = spark.range(1).select(F.lit("TOTAL").alias("entity_key"), *[F.lit(None).cast("string").alias(x) for x in rows.columns[1:]])
    return rows.unionByName(total)


def dirty_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture D: customer indicators rendered as messy text.

    bal_txt by c_custkey % 10: 0 -> '', 1 -> '-', 2 -> NULL, else
    '$1,234.56 ' (negative: '$-994.28 '); pct_txt = the customer's largest
    line discount as '7.00%'; cnt_txt = n_items * 1000 as '12,000';
    name_txt = c_name (must stay text). Every number shown is exact in the
    text, so an oracle can compare against the numeric source columns.
    """
    cust = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal"])
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_discount"])
    per_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_discount").alias("d"))
    per_cust = (orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
                .groupBy("o_custkey").agg(F.sum("n").alias("n_items"), F.max("d").alias("max_disc")))
    j = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
    k = F.col("c_custkey") % 10
    bal = (F.when(k == 0, F.lit("")).when(k == 1, F.lit("-")).when(k == 2, F.lit(None).cast("string"))
           .otherwise(F.format_string("$%,.2f ", F.col("c_acctbal"))))
    return j.select(
        F.col("c_custkey").alias("entity_key"),
        F.col("c_name").alias("name_txt"),
        bal.alias("bal_txt"),
        F.when(F.col("max_disc").isNotNull(), F.format_string("%.2f%%", F.col("max_disc") * 100.0))
        .alias("pct_txt"),
        F.when(F.col("n_items").isNotNull(), F.format_number(F.col("n_items") * 1000, 0)).alias("cnt_txt"),
        F.col("c_acctbal").alias("src_balance"),
        F.col("max_disc").alias("src_max_disc"),
        F.col("n_items").alias("src_n_items"),
    )


DIRTY_SOURCE_SQL = """
WITH per_order AS (SELECT l_orderkey, count(*) AS n, max(l_discount) AS d FROM lineitem GROUP BY l_orderkey),
per_cust AS (SELECT o_custkey, sum(n) AS n_items, max(d) AS max_disc
             FROM orders JOIN per_order ON o_orderkey = l_orderkey GROUP BY o_custkey)
SELECT c_custkey AS entity_key, c_name AS name_txt, c_acctbal AS src_balance,
       max_disc AS src_max_disc, n_items AS src_n_items
FROM customer LEFT JOIN per_cust ON c_custkey = o_custkey
"""


def lineitem_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture L: four numeric line-item columns."""
    return table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture PR: (model, fold, label, prediction) from orders.

    model = o_orderpriority; fold = o_orderkey % 5; label = 2 if
    o_totalprice < 80000, 1 if < 180000, else 0; prediction = label unless
    o_orderkey % 4 = 0, then o_custkey % 3.
    """
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"])
    label = (F.when(F.col("o_totalprice") < 80000, 2).when(F.col("o_totalprice") < 180000, 1)
             .otherwise(0)).cast("int")
    return o.select(
        F.col("o_orderpriority").alias("model"),
        (F.col("o_orderkey") % 5).cast("int").alias("fold"),
        label.alias("label"),
        F.when(F.col("o_orderkey") % 4 == 0, (F.col("o_custkey") % 3).cast("int")).otherwise(label)
        .alias("prediction"),
    )


PREDICTIONS_SQL = """
SELECT o_orderpriority AS model, CAST(o_orderkey % 5 AS INTEGER) AS fold,
       CAST(CASE WHEN o_totalprice < 80000 THEN 2 WHEN o_totalprice < 180000 THEN 1 ELSE 0 END AS INTEGER) AS label,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 3
                 ELSE CASE WHEN o_totalprice < 80000 THEN 2 WHEN o_totalprice < 180000 THEN 1 ELSE 0 END END
            AS INTEGER) AS prediction
FROM orders
"""
