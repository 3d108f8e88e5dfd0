"""Operator 7, token counts as delta-maintained rollups: signed inserts, deletes and revised counts update
additive totals by source, language and tokenizer version; batches commit idempotently.

A rollup is a folder of committed batches. A batch is pre-aggregated (map-side, so a hot source costs one
row per task) to one signed row per source, lang and tokenizer, written to a folder of its own attempt and
committed by a marker file that names that attempt. Committing an id again is a no-op, a failed attempt
leaves no marker, and totals are sums over committed batches, so replays and lost executors change nothing.

Defined results: null source and lang are groups of their own; null text has 0 tokens and is a document;
an empty batch commits and changes nothing; repeated rows count each time; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlens.session import stage_path

from .common import cut, space_word_count

KEYS = ["source", "lang", "tokenizer"]


def words_v1(text: Column) -> Column:
    """White-space words."""
    return space_word_count(text)


def bytes4_v1(text: Column) -> Column:
    """The usual estimate of a token per four UTF-8 bytes, rounded up."""
    return F.floor((F.octet_length(F.coalesce(text, F.lit(""))) + 3) / 4).cast("long")


def bpe(path: str) -> Callable[[Column], Column]:
    """A counter by the byte-pair vocabulary file at ``path`` (tiktoken format), which every executor can read."""
    import pandas as pd

    def count(texts: pd.Series) -> pd.Series:
        import tiktoken
        from tiktoken.load import load_tiktoken_bpe

        enc = tiktoken.Encoding("rollup", pat_str=r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+", mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
        return texts.map(lambda t: len(enc.encode_ordinary(t)) if t else 0)

    return F.pandas_udf(count, "long")


#: Tokenizer versions of the query; each is an expression over the text.
TOKENIZERS: dict[str, Callable[[Column], Column]] = {"words-v1": words_v1, "bytes4-v1": bytes4_v1}


def signed(docs: DataFrame, sign: int, tokenizers: dict[str, Callable[[Column], Column]] | None = None, text: str = "text", count_docs: bool = True) -> DataFrame:
    """Signed rows (source, lang, tokenizer, docs, tokens) of inserted (1) or deleted (-1) documents."""
    counters = TOKENIZERS if tokenizers is None else tokenizers
    each = F.array(*[F.struct(F.lit(k).alias("tokenizer"), f(F.col(text)).cast("long").alias("tokens")) for k, f in counters.items()])
    rows = docs.select("source", "lang", F.inline(each))
    return rows.select(*KEYS, F.lit(sign if count_docs else 0).cast("long").alias("docs"), (sign * F.col("tokens")).alias("tokens"))


def revised(docs: DataFrame, old: str, new: str, tokenizers=None) -> DataFrame:
    """Signed rows of documents whose text changed from column ``old`` to ``new``: their count stays, their tokens move."""
    return signed(docs, -1, tokenizers, old, count_docs=False).unionByName(signed(docs, 1, tokenizers, new, count_docs=False))


class Rollup:
    """Additive totals kept as committed batches in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _committed(self) -> dict[str, str]:
        fs, p = self._fs(f"{self.path}/commits")
        if not fs.exists(p):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return dict(n.split("~", 1) for n in names if "~" in n and not n.startswith((".", "_")))

    def commit(self, batch: str, delta: DataFrame) -> bool:
        """Add a batch of signed rows; False if that id was committed before."""
        if "~" in batch or "/" in batch:
            raise ValueError("a batch id holds neither ~ nor /")
        if batch in self._committed():
            return False
        attempt = uuid.uuid4().hex
        out = delta.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        out.write.parquet(f"{self.path}/batches/{attempt}")
        fs, p = self._fs(f"{self.path}/commits/{batch}~{attempt}")
        fs.create(p, False).close()
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over all committed batches."""
        paths = [f"{self.path}/batches/{a}" for _, a in sorted(self._committed().items())]
        if not paths:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, docs long, tokens long")
        rows = self.spark.read.schema("source string, lang string, tokenizer string, docs long, tokens long").parquet(*paths)
        return rows.groupBy(*KEYS).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))


def maintain(docs: DataFrame) -> DataFrame:
    """The query: insert all documents, delete all copies of a text but the one of the least id, revise the
    rest to their text without line breaks; the last batch is sent twice. Totals after the three batches.

    Copies are deleted as all rows less the one of each text that stays, which a map-side minimum picks: a text
    that a third of the rows repeat reaches its task as one row of each input task."""
    spark = docs.sparkSession
    rollup = Rollup(spark, stage_path(spark, f"tables/rollup-{uuid.uuid4().hex}"))
    rollup.commit("0-insert", signed(docs, 1))
    h = F.sha2(F.coalesce("text", F.lit("")), 256)
    joined = F.regexp_replace("text", "\n", "")
    counts = [F.struct(F.lit(k).alias("tokenizer"), f(F.col("text")).alias("old"), f(joined).alias("new")) for k, f in TOKENIZERS.items()]
    first = docs.groupBy(h.alias("h")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "source", "lang", F.array(*counts).alias("counts"))).alias("r"))
    kept = cut(first.select("r.source", "r.lang", F.inline("r.counts")), "kept")
    back = kept.select(*KEYS, F.lit(1).cast("long").alias("docs"), F.col("old").alias("tokens"))
    rollup.commit("1-delete", signed(docs, -1).unionByName(back))
    for _ in range(2):
        rollup.commit("2-revise", kept.select(*KEYS, F.lit(0).cast("long").alias("docs"), (F.col("new") - F.col("old")).alias("tokens")))
    return rollup.totals()


SQL = r"""
WITH d AS (SELECT *, coalesce(text, '') AS t, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id NULLS LAST) AS r FROM documents),
k AS (SELECT source, lang, r, replace(t, chr(10), '') AS t FROM d)
SELECT source, lang, tokenizer, CAST(count(*) FILTER (r = 1) AS BIGINT) AS docs, CAST(coalesce(sum(tokens) FILTER (r = 1), 0) AS BIGINT) AS tokens
FROM (SELECT source, lang, r, 'words-v1' AS tokenizer, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS tokens FROM k
      UNION ALL SELECT source, lang, r, 'bytes4-v1', (strlen(t) + 3) // 4 FROM k)
GROUP BY source, lang, tokenizer
"""
