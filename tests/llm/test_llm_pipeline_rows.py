"""Pipeline stages on null and repeated ids, repeated rows, equal sizes, empty tables and clashing extra columns."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tierlens.llm import decontaminate, mixing, near_dedup, secret_scan

CLASH = ["_d", "_k", "_rk", "_n", "_r", "_s", "_spans", "target", "finish", "taken", "k", "id", "carry_0", "kept", "rest"]
DOC = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), *[f"x{c}" for c in CLASH]) for d, t, s in rows], DOC)


ROWS = [(None, "w1 w2 w3 w4", "a"), (None, "v1 v2 v3 v4", "a"), (1, "one two three four", "a"), (1, "six words are in this text", "b"), (2, None, "a"), (3, "", None), (4, "same row here", "b"), (4, "same row here", "b"), (None, None, None), (5, "a b c d e f g h i j", None)]


@pytest.mark.parametrize("stage", [lambda d, b: decontaminate.remove_documents(d, b), lambda d, b: decontaminate.remove_spans(d, b), lambda d, b: near_dedup.keep_one(d), lambda d, b: secret_scan.redact(d)])
def test_stages_keep_clashing_columns(spark, stage):
    bench = spark.createDataFrame([(1, "not in any of them")], "item_id long, text string")
    docs = frame(spark, ROWS)
    out = stage(docs, bench)
    assert out.columns == docs.columns
    got = out.collect()
    assert all(r[c] == f"x{c}" for r in got for c in CLASH)
    assert {(r["doc_id"], r["text"]) for r in got} == {(d, t) for d, t, _ in ROWS}
    assert stage(docs.limit(0), bench).collect() == []


def test_mix_stage_takes_the_operators_words(spark):
    docs = frame(spark, ROWS)
    out = corpus_pipeline.mix_sources(spark, docs, "")
    got = out.collect()
    assert set(CLASH) - set(out.columns) == set() and out.columns[-4:] == ["source_size", "target", "taken", "finish"]
    want = Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in mixing.mix(docs, carry=[F.xxhash64(*docs.columns)]).collect() if r["taken"] > 0)
    assert Counter((r["doc_id"], r["source"], len((r["text"] or "").split()), r["taken"]) for r in got) == want
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), "").collect() == []


def test_rows_of_one_null_id_do_not_share_their_words(spark):
    """Two null ids, equal sizes, a source that the budget cuts: each row reports its own words."""
    rows = [(None, f"t{i} t t t", "big") for i in range(6)] + [(9, "x " * 40, "c"), (8, "y " * 40, "d")]
    docs = frame(spark, rows)
    got = corpus_pipeline.mix_sources(spark, docs, "").collect()
    total = sum(r["taken"] for r in mixing.mix(docs).collect())
    assert sum(r["taken"] for r in got) == total and all(r["taken"] <= 3 * len(r["text"].split()) for r in got)
