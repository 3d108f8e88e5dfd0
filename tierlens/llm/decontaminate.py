"""Operator 2, benchmark decontamination: a broadcast hash set of normalised test n-grams, probed with
every window of every document's words, hits verified word by word.

Windows: 13 consecutive words of an item; an item with 1 to 12 words is one window of its own length.
All windows of a document are hashed and exploded inside one code-generated span; only verified hits
leave it, so the documents are never shuffled. The set is broadcast in blocks of at most ``block_rows``
windows (a few dozen bytes each), one scan per block: the same path at any benchmark size.

Defined results: null or empty text has no words and no hits; an empty benchmark hits nothing; a
repeated row repeats its result; rows with one doc_id but other texts are told apart; a null doc_id is
an id like any other; a window in several items counts for each of them; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, apart, cut, row_key

WINDOW = 13
#: At most so many windows in one broadcast: 500,000 x about 150 bytes.
BLOCK_ROWS = 500_000


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, n, words, h): each distinct window of each item."""
    w = benchmark.select("item_id", alnum_words(F.col("text")).alias("ws")).withColumn("n", F.least(F.size("ws"), F.lit(window)))
    w = w.filter("n > 0").select("item_id", "n", "ws", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("n") + 1)).alias("i"))
    w = w.select("item_id", "n", F.array_join(F.slice("ws", F.col("i"), F.col("n")), " ").alias("words"))
    return w.distinct()


def _window_hashes(hashed, n: int):
    """Hash of each run of n word hashes."""
    many = F.size(hashed) - n + 1
    return F.when(many > 0, F.transform(F.sequence(F.lit(1), many), lambda i: F.xxhash64(F.slice(hashed, i, n)))).otherwise(F.array().cast("array<bigint>"))


def find_hits(docs: DataFrame, windows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, k, start, n, win): every place where a window occurs; start counts words from 0, k is the
    row key, win identifies the window's words."""
    wins = windows.select("n", "words").distinct().withColumn("win", F.xxhash64("n", "words"))
    parts = F.split("words", " ")
    wins = wins.withColumn("h", F.xxhash64(F.transform(parts, lambda w: F.xxhash64(w))))
    sizes = {r["n"]: r["c"] for r in wins.groupBy("n").agg(F.count("*").alias("c")).collect()}  # 13 rows at most
    base = docs.select("doc_id", row_key(F.col("text")).alias("k"), alnum_words(F.col("text")).alias("ws"))
    base = base.withColumn("hs", F.transform("ws", lambda w: F.xxhash64(w)))
    found = []
    for n, count in sorted(sizes.items()):
        blocks = -(-count // block_rows)
        for b in range(blocks):
            part = wins.filter((F.col("n") == n) & (F.pmod(F.col("h"), F.lit(blocks)) == b)).select("h", "words", "win")
            at = base.select("doc_id", "k", "ws", F.posexplode(_window_hashes(F.col("hs"), n)).alias("start", "h"))
            same = F.array_join(F.slice("ws", F.col("start") + 1, n), " ") == F.col("words")
            found.append(at.join(F.broadcast(part), "h").filter(same).select("doc_id", "k", "start", F.lit(n).alias("n"), "win"))
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, k long, start int, n int, win long")
    return reduce(DataFrame.unionByName, found)


def covered(starts) -> F.Column:
    """Words inside the union of the runs (start, n) of a sorted array."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, x):
        end = (x["start"] + x["n"]).cast("long")
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], x["start"].cast("long")))).alias("n"))

    return F.aggregate(starts, zero, add, lambda acc: acc["n"])


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated and the hit runs (start, n)."""
    windows = cut(item_windows(benchmark, window), "windows")
    hits = cut(find_hits(docs, windows, block_rows), "hits")
    runs = hits.groupBy("doc_id", "k").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("spans"))
    of = windows.select(F.xxhash64("n", "words").alias("win"), "item_id").distinct()
    items = hits.select("doc_id", "k", "win").distinct().join(of, "win").groupBy("doc_id", "k").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    found = runs.withColumnsRenamed({"doc_id": "d1", "k": "k1"}).join(items.withColumnsRenamed({"doc_id": "d2", "k": "k2"}), F.expr("d1 <=> d2 and k1 = k2"), "left")
    found = found.select("d1", "k1", "spans", "items")
    base = docs.select("doc_id", row_key(F.col("text")).alias("k"), F.size(alnum_words(F.col("text"))).cast("long").alias("n_words"))
    out = base.join(found, F.expr("doc_id <=> d1 and k = k1"), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    out = out.withColumn("n_hit", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")))
    return out.select(
        "doc_id", "k", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(items), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans",
    )


@apart("doc_id", "text")
def remove_documents(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    bad = scan(docs, benchmark, **kw).filter("contaminated").select(F.col("doc_id").alias("_d"), F.col("k").alias("_k")).distinct()
    return docs.withColumn("_rk", row_key(F.col("text"))).join(bad, F.expr("doc_id <=> _d and _rk = _k"), "left_anti").drop("_rk")


@apart("doc_id", "text")
def remove_spans(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Every document, its hit words and what follows each of them cut from the text."""
    hit = scan(docs, benchmark, **kw).filter("n_hit > 0").select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"), F.col("spans").alias("_spans")).distinct()
    out = docs.withColumn("_rk", row_key(F.col("text"))).join(hit, F.expr("doc_id <=> _d and _rk = _k"), "left")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lead = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    pieces = F.regexp_extract_all("text", F.lit(f"{word}[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*"), F.lit(0))
    kept = F.filter(F.transform(pieces, lambda p, i: F.when(~F.exists("_spans", lambda s: (s["start"] <= i) & (i < s["start"] + s["n"])), p)), lambda p: p.isNotNull())
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.concat(lead, F.array_join(kept, "")))
    return out.withColumn("text", text).select(*docs.columns)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
       FROM (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hits AS (SELECT r, n, i, item_id FROM dw JOIN bw USING (n, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
