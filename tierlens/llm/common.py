"""Helpers shared by the corpus operators: table reads, word splitting, blocks, stage tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlens.session import cut_lineage

#: ASCII runs that part words of letters, digits and non-ASCII characters (after lower-casing).
ALNUM_SEP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: ASCII white space.
SPACE_SEP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. ``lower`` has a fast path and the same result on pure ASCII texts."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def alnum_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), ALNUM_SEP), "")


def space_word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_SEP), "")).cast("long")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4: fold 2 is held out of every fit on labels."""
    return F.crc32(doc_id.cast("string")) % 4


def row_key(text: Column) -> Column:
    """Second part of a row's key beside doc_id, so that rows sharing an id but not a text stay apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


#: Stage tables that ``cut`` wrote and nobody dropped yet.
MADE: list[DataFrame] = []


def cut(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared checkpoint folder and read back."""
    made = cut_lineage(df, name)
    MADE.append(made)
    return made


def drop_made() -> None:
    """Delete all stage tables that ``cut`` wrote: for callers whose earlier results are written elsewhere."""
    drop_tables(*MADE)
    MADE.clear()


def apart(*needed: str):
    """For functions from documents to documents with the same columns: the function sees the ``needed`` columns and
    one struct of all others, so that no extra column can clash with its helper columns."""

    def wrap(f):
        @wraps(f)
        def with_rest(docs: DataFrame, *args, **kw) -> DataFrame:
            here = [c for c in needed if c in docs.columns]
            rest = [c for c in docs.columns if c not in here]
            if not rest:
                return f(docs, *args, **kw)
            out = f(docs.select(*here, F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest_of_row")), *args, **kw)
            return out.select(*[F.col(c) if c in here else F.col("rest_of_row").getField(c).alias(c) for c in docs.columns])

        return with_rest

    return wrap


def drop_tables(*frames: DataFrame) -> None:
    """Delete stage tables that no later step reads."""
    for df in frames:
        for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
            if "/tables/" in f:
                path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f)
                path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


_UPPER_TO_LOWER = str.maketrans(UPPER, LOWER)
_SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def py_ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_UPPER_TO_LOWER)


def py_space_words(text: str | None) -> list[str]:
    return _SPACE_WORD.findall(py_ascii_lower(text)) if text else []


def groups(batches: Iterable, key: str) -> Iterator:
    """Pandas frames, one per run of equal keys, from batches sorted by that key (a run may span batches)."""
    import pandas as pd

    held: list = []
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[key].to_numpy()
        edges = [0, *(i + 1 for i in (k[1:] != k[:-1]).nonzero()[0]), len(k)]
        for a, b in zip(edges, edges[1:], strict=False):
            part = pdf.iloc[a:b]
            if held and held[0][key].iat[0] != k[a]:
                yield held[0] if len(held) == 1 else pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held)
