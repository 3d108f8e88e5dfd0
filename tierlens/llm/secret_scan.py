"""Operator 10, secret scans: candidate strings found by shape, then a random forest that removes false
positives from candidate length, character transitions, dictionary coverage, path and neighbouring words.

Candidates are taken from the whole text, wherever they stand in a word: a JWT with its dots; the value that
follows a credential word and an assignment, of four characters or more and any letters; and every run of 12 or
more key characters that holds a digit or a capital after a small letter. The dictionary is the ``DICTIONARY``
most frequent words of the whole corpus.
The forest (Spark ML, trained and applied on the JVM) learns from labelled findings (rows of features and a
label): those given, or, in the query, findings that context labels by itself. A credential word right
before an assignment, or a vendor's key form, marks a secret; numbers, words and long plain words of the
corpus mark none; all other candidates are left to the forest. At most about ``FINDINGS`` findings of each
label are used, picked by hash: the documented bound of the classifier.

Defined results: null and empty texts have no candidates; where findings have one label only, candidates
keep that label, and without findings none is a secret; repeated rows repeat their result; a null doc_id is
an id like any other; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, cut, row_key, SPACE_SEP

DICTIONARY, FINDINGS, TREES, DEPTH, SEED = 5_000, 20_000, 24, 6, 7
MASK = "[SECRET]"
_KEYED = r"[0-9]|[a-z][A-Z]"
# Credential words and public key forms.
_CREDENTIAL = r"(?i)(passw(or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth)"
_VENDOR = r"^(A(KI|SI)A[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|xox[abpr]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}.*|sk-[A-Za-z0-9-]{20,})$"
# A credential word as the last part of a name ("author" is none), and the assignment after it; bounded, for a lookbehind.
_NAME = r"(?:(?i:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth)(?:s|[0-9]{1,3}|[_-][A-Za-z0-9_-]{0,16}|[A-Z][A-Za-z0-9]{0,16})?)"
_ASSIGN = r"[\"']?\s{0,2}[=:]\s{0,2}[\"']?"
_JWT = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]+){1,4}"
# two cheap lookbehinds spare most places the third
_VALUE = rf"(?<=[=:\s\"'])(?<=[=:]\s{{0,2}}[\"']?)(?<={_NAME}{_ASSIGN})[^\s\"'`,;&<>()\[\]{{}}|]{{3,}}[^\s\"'`,;&<>()\[\]{{}}|.!?:]"
_RUN = r"[A-Za-z0-9+/_\-]{12,}(?:={1,2}(?![^\s\"'`,;&<>()\[\]{}|]))?"
_CORE = f"{_JWT}|{_VALUE}|{_RUN}"
_NAMED = f"{_NAME}{_ASSIGN}$"
#: Characters of context on either side of a candidate.
AROUND = 96
FEATURES = ["length", "digits", "uppers", "transitions", "distinct", "hexed", "covered", "slashes", "path", "assigned", "credential", "quoted"]


def _parts(text: Column, core: str) -> tuple[Column, Column]:
    """All matches of the text, and what stands before, between and after them (one piece more)."""
    return F.regexp_extract_all(text, F.lit(core), F.lit(0)), F.split(text, core, -1)


def _words(docs: DataFrame, core: str, keyed: str | None) -> DataFrame:
    """Rows (doc_id, rk, core, word, before) of every match: its white-space word, and the two words and the part of a
    list, record or query string that lead to it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found, pieces = _parts(text, core)
    base = docs.select("doc_id", row_key(text).alias("rk"), found.alias("cs"), pieces.alias("ps")).filter(F.size("cs") > 0)
    rows = base.select("doc_id", "rk", "cs", "ps", F.posexplode("cs").alias("i", "core"))
    i = F.col("i")
    left = F.concat(F.coalesce(F.get("cs", i - 1), F.lit("")), F.get("ps", i))
    rows = rows.select("doc_id", "rk", "core", F.right(left, F.lit(AROUND)).alias("l"), F.left(F.get("ps", i + 1), F.lit(AROUND)).alias("r"))
    if keyed:
        rows = rows.filter(F.col("core").rlike(keyed) | F.col("l").rlike(_NAMED))
    word = F.concat(F.regexp_extract("l", r"(\S*)$", 1), "core", F.regexp_extract("r", r"^(\S*)", 1))
    before = F.regexp_extract("l", r"((?:[^\s,;&{}?]*\s+){0,2}[^\s,;&{}?]*)$", 1)
    return rows.select("doc_id", "rk", "core", word.alias("word"), before.alias("before"))


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent small-letter words of 3 to 12 letters, counted over all documents."""
    words = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+")).alias("w")
    n = docs.select(words).filter(F.length("w").between(3, 12)).groupBy("w").agg(F.count("*").alias("n"))
    return [r["w"] for r in n.orderBy(F.col("n").desc(), "w").limit(size).collect()]


def with_features(rows: DataFrame, known: list[str]) -> DataFrame:
    core, n = F.col("core"), F.length("core")
    count = lambda pattern: F.size(F.regexp_extract_all(core, F.lit(pattern), F.lit(0)))
    runs = F.regexp_extract_all(F.lower(core), F.lit("[a-z]{3,}"), F.lit(0))
    known_runs = F.filter(runs, lambda w: w.isin(known)) if known else F.array().cast("array<string>")
    covered = F.aggregate(known_runs, F.lit(0), lambda a, w: a + F.length(w))
    got = {
        "length": n, "digits": count("[0-9]") / n, "uppers": count("[A-Z]") / n,
        "transitions": count("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]") / n,
        "distinct": F.size(F.array_distinct(F.split(core, ""))) / n, "hexed": core.rlike("^[0-9a-fA-F]+$"), "covered": covered / n,
        "slashes": count("/"), "path": F.col("word").rlike(r"://|^\.{0,2}/|\.[a-z]{2,4}$"),
        "assigned": F.col("before").rlike("[=:]\\s*[\"']?$"), "credential": F.col("before").rlike(_CREDENTIAL), "quoted": F.col("word").rlike("[\"']"),
    }
    return rows.withColumns({k: v.cast("double") for k, v in got.items()})


def context_label() -> Column:
    """1 secret, 0 none, null undecided."""
    secret = ((F.col("credential") == 1) & (F.col("assigned") == 1) & (F.col("covered") < 0.5)) | F.col("core").rlike(_VENDOR)
    plain = F.col("core").rlike("^[0-9+/_=-]+$") | (F.col("covered") >= 0.5) | ((F.col("path") == 1) & (F.col("assigned") == 0))
    return F.when(secret, 1).when(plain, 0).cast("int")


def candidates(docs: DataFrame, known: list[str]) -> DataFrame:
    return cut(with_features(_words(docs, _CORE, _KEYED), known), "candidates")


def findings(docs: DataFrame, found: DataFrame, known: list[str], rows: int = FINDINGS) -> DataFrame:
    """Labelled findings of the corpus itself: (features, label), about ``rows`` of each label at most."""
    own = found.withColumn("label", context_label()).filter("label is not null").select("rk", "core", "label", *FEATURES)
    part = F.pmod(F.xxhash64("rk", "core"), F.lit(1 << 31))
    n_docs = docs.count()
    few = F.lit(int(min(1.0, rows / 10 / max(n_docs, 1)) * (1 << 31)))
    some = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("plain")), F.lit(1 << 31)) < few)
    words = _words(some, "[A-Za-z]{12,}", None).filter(~F.col("before").rlike(_NAMED))  # a word given to a password is none
    plain = with_features(words, known).withColumn("label", F.lit(0)).select("rk", "core", "label", *FEATURES)
    every = cut(own.unionByName(plain), "findings")
    counts = {r["label"]: r["n"] for r in every.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(int(min(1.0, rows / n) * (1 << 31)))).otherwise(share)
    return every.filter(part < share).select("label", *FEATURES)


def classify(found: DataFrame, labelled: DataFrame) -> DataFrame:
    """The candidates with ``score``, the forest's probability of a secret."""
    kinds = {r["label"] for r in labelled.select("label").distinct().collect()}
    if len(kinds) < 2:
        return found.withColumn("score", F.lit(1.0 if 1 in kinds else 0.0))
    gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8, featureSubsetStrategy="sqrt")
    model = forest.fit(gather.transform(labelled.withColumn("label", F.col("label").cast("double"))).select("label", "features"))
    return model.transform(gather.transform(found)).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def find(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, rk, core, score) of every candidate; a score of 0.5 or more is a secret."""
    known = dictionary(docs)
    found = candidates(docs, known)
    labelled = findings(docs, found, known) if labelled is None else labelled
    return cut(classify(found, labelled).select("doc_id", "rk", "core", "score"), "scored")


def report(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per document: candidates, secrets, the highest score, and the secrets' hashes."""
    found = find(docs, labelled)
    is_secret = F.col("score") >= 0.5
    per = found.groupBy(F.col("doc_id").alias("_d"), F.col("rk").alias("_k"), "core").agg(F.count("*").alias("c"), F.max("score").alias("score"))
    per = per.groupBy("_d", "_k").agg(F.sum("c").alias("n_candidates"), F.sum(F.when(is_secret, F.col("c")).otherwise(0)).alias("n_secrets"), F.max("score").alias("max_score"), F.array_join(F.sort_array(F.collect_list(F.when(is_secret, F.sha2("core", 256)))), ",").alias("secrets_sha256"))
    out = docs.select("doc_id", row_key(F.col("text")).alias("rk")).join(per, F.expr("doc_id <=> _d and rk = _k"), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", F.coalesce("n_candidates", zero).alias("n_candidates"), F.coalesce("n_secrets", zero).alias("n_secrets"), F.coalesce("max_score", F.lit(0.0)).alias("max_score"), F.coalesce("secrets_sha256", F.lit("")).alias("secrets_sha256"))


@apart("doc_id", "text", "n_chars")
def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every document, its secrets replaced by ``MASK``; n_chars, where it is a column, follows the text."""
    secrets = find(docs, labelled).filter("score >= 0.5").groupBy(F.col("doc_id").alias("_d"), F.col("rk").alias("_k")).agg(F.sort_array(F.collect_set(F.struct(F.length("core").alias("n"), "core")), asc=False).alias("_s"))
    out = docs.withColumn("_rk", row_key(F.col("text"))).join(secrets, F.expr("doc_id <=> _d and _rk = _k"), "left")
    cores = F.transform("_s", lambda s: s["core"])
    found, pieces = _parts(F.col("text"), _CORE)
    hidden = F.transform(found, lambda c: F.when(F.array_contains(cores, c), F.lit(MASK)).otherwise(c))
    rebuilt = F.array_join(F.flatten(F.zip_with(pieces, hidden, lambda p, c: F.array(p, F.coalesce(c, F.lit(""))))), "")
    # a long secret also goes from inside other runs; a short one may be a plain word elsewhere
    long = F.filter("_s", lambda s: s["n"] >= 12)
    masked = F.aggregate(long, rebuilt, lambda t, s: F.replace(t, s["core"], F.lit(MASK)))
    out = out.withColumn("text", F.when(F.col("_s").isNotNull(), masked).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_s").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
