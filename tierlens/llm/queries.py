"""The query of each operator: (spark, sf_dir) to its digest columns, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, fingerprints, html_text, license_scan, manifest, mixing, near_dedup, piece_bpe, quality, secret_scan, token_counts, toxicity
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.maintain(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratings = table(spark, sf_dir, "labels").filter("quality is not null").select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return quality.score(docs, quality.fit(docs, ratings))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> bytes:
    """A public vocabulary file, read once in the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digest(piece_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json").decode(), vocabulary("piece_bpe_32k.model"))[0]


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity, op2_decontaminate, op3_mix_sources, op4_html_text, op5_fingerprints, op6_near_dedup, op7_token_counts, op8_license_scan, op9_quality, op10_secret_scan, op11_sentencepiece, op12_alignment, op13_manifest)
}
ORACLE = {"op2_decontaminate": decontaminate.SQL, "op3_mix_sources": mixing.SQL, "op6_near_dedup": near_dedup.SQL, "op7_token_counts": token_counts.SQL, "op13_manifest": manifest.SQL}
