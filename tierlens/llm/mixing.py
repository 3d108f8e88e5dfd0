"""Operator 3, mixing sources to target weights: weighted fair queueing over shuffled documents.

Inside a source, documents stand in the order of md5(doc_id) and may be served up to ``max_repeats``
times over. A copy's virtual finish time is the source's words served up to its end, divided by the
source's weight. Serving copies in global finish order until the budget is spent gives every source
weight * V words, or all its repeats if those end before the virtual end time V. V follows exactly from
one row per source (filling by weight); the copies still in service at V are cut there, which truncates
the global order at the budget to the word. The result is range-sorted by virtual finish time: the order
in which the mix reads the documents.

The running sum inside a source is hierarchical (two radix levels of the md5, then the rows of one
radix cell), so a source with a third of all rows is spread over a million cells, not one window.

Defined results: null text has size 0; the null source comes last; documents of size 0 take nothing;
an empty table gives an empty result; repeated rows are documents of their own; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, space_word_count

MAX_REPEATS = 3


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, s0, weight, source_size, target): one row per source. The windows run over that small table."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("weight", F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(3)) + 1)
    per = per.withColumn("cap", max_repeats * F.col("source_size")).withColumn("until", F.col("cap") / F.col("weight"))
    order = Window.orderBy("until", F.col("source").asc_nulls_last())
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    spent = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    per = per.withColumn("v", (whole - spent) / F.sum("weight").over(rest))
    end = F.min(F.when(F.col("v") <= F.col("until"), F.struct("until", "v"))).over(Window.partitionBy(F.lit(1)))["v"]
    per = per.withColumn("end", end)
    target = F.when(F.col("cap") <= F.col("end") * F.col("weight"), F.col("cap").cast("double")).otherwise(F.col("end") * F.col("weight"))
    return per.select("source", "weight", "source_size", target.alias("target"))


def mix(docs: DataFrame, max_repeats: int = MAX_REPEATS, carry: Sequence[Column] = ()) -> DataFrame:
    """Per document: size, source_size, target, taken (words the mix takes) and finish (virtual finish time), and
    the ``carry`` columns as carry_0, carry_1, ..., which also break ties of id and size."""
    carried = [f"carry_{i}" for i in range(len(carry))]
    sizes = docs.select(*[c.alias(n) for c, n in zip(carry, carried, strict=True)], "doc_id", F.col("source").cast("string").alias("source"), space_word_count(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h"))
    sizes = cut(sizes, "sizes").withColumns({"c1": F.substring("h", 1, 2), "c2": F.substring("h", 3, 3)})
    cell = sizes.groupBy("source", "c1", "c2").agg(F.sum("size").alias("cell_size"))
    before = lambda *by: F.coalesce(F.sum("cell_size").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = cell.groupBy("source", "c1").agg(F.sum("cell_size").alias("cell_size")).withColumn("b1", before("source", "c1")).drop("cell_size")
    cell = cell.withColumn("b2", before("source", "c1", "c2"))
    on = lambda a, b, *by: " and ".join(f"{a}.{x} <=> {b}.{x}" for x in by)
    cell = cell.alias("c").join(top.alias("t"), F.expr(on("c", "t", "source", "c1"))).select("c.source", "c.c1", "c.c2", (F.col("b1") + F.col("b2")).alias("base"))
    within = F.coalesce(F.sum("size").over(Window.partitionBy("source", "c1", "c2").orderBy("h", "doc_id", "size", *carried).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = sizes.withColumn("within", within).alias("s").join(cell.alias("c"), F.expr(on("s", "c", "source", "c1", "c2")))
    out = out.select(*[f"s.{c}" for c in carried], "s.doc_id", "s.source", "s.size", (F.col("base") + F.col("within")).alias("start"))
    out = out.alias("s").join(source_targets(sizes, max_repeats).alias("t"), F.expr("s.source <=> t.source"))
    words = F.floor(F.col("target"))
    served = [F.greatest(F.lit(0), F.least(F.col("size"), words - (e * F.col("source_size") + F.col("start")))) for e in range(max_repeats)]
    out = out.withColumn("taken", sum(served[1:], served[0]).cast("long")).withColumn("finish", (F.col("start") + F.col("size")) / F.col("weight"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "finish", "s.source", *carried).orderBy("finish", "s.source", "doc_id")


def take(docs: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The documents of which the mix takes something, with their columns and source_size, target, taken and finish
    (columns of these names give way). A hash of the whole row goes through the mix, so rows that share an id, a
    source and a size keep their own words; of rows alike in every column each gets its own share. Texts are
    exchanged once, when the narrow rows of the mix meet them."""
    added = ["source_size", "target", "taken", "finish"]
    cols = [F.col(f"`{c}`") for c in docs.columns]
    won = mix(docs, max_repeats, [F.xxhash64(*cols)]).filter("taken > 0").select("doc_id", "carry_0", *added)
    rows = docs.select("doc_id", F.xxhash64(*cols).alias("carry_0"), F.struct(*cols).alias("kept")).dropDuplicates(["doc_id", "carry_0"])
    out = rows.alias("r").join(won.alias("w"), F.expr("r.doc_id <=> w.doc_id and r.carry_0 = w.carry_0"))
    return out.select(*[F.col("r.kept").getField(c).alias(c) for c in docs.columns if c not in added], *[f"w.{c}" for c in added])


SQL = r"""
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s GROUP BY source),
q AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS until FROM p),
v AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY until, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / sum(weight) OVER (ORDER BY until, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM q),
e AS (SELECT *, (SELECT v FROM v WHERE v <= until ORDER BY until LIMIT 1) AS fin FROM v),
t AS (SELECT source, weight, source_size, CASE WHEN cap <= fin * weight THEN CAST(cap AS DOUBLE) ELSE fin * weight END AS target FROM e),
c AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a FROM s)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - a)) + greatest(0, least(size, floor(target) - source_size - a)) + greatest(0, least(size, floor(target) - 2 * source_size - a)) AS BIGINT) AS taken,
       CAST(a + size AS DOUBLE) / weight AS finish, c.source
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
"""
