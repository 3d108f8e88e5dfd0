"""Operator 1, toxicity by maximum-scoring segments of token log-odds, calibrated by extreme values.

Fit, on all labelled documents outside fold 2, near copies at a lower weight (else every word of a text with
many of them would look significant): the weight of the documents of either label that hold each token (all
labelled rows, map-side counters), log-odds under an informative Dirichlet prior (``PRIOR`` of the pooled counts), each
shrunk towards 0 by ``Z`` of its standard errors. A word scores as the strongest of itself and its first
letters (``STEMS``), so that unseen forms of a toxic stem still score. The model keeps the ``VOCAB`` strongest entries: a documented bound.

Score: a linear scan over the tokens (Ruzzo and Tompa) finds every maximal scoring segment, where a token
without evidence costs ``DRIFT``. Segments above ``FLOOR`` in clean training documents give the rate K and
the tail lambda of chance segments (peaks over a threshold); a segment of score s in n tokens then has
evidence lambda (s - FLOOR) - ln(K n), and a document the sum over its significant segments. A logistic
map of that evidence, fitted on a histogram of training documents, gives the score.

Defined results: null and empty texts have no tokens and score as documents without evidence; without
labels, or with labels of one kind only, every score is the share of label 1 (0 without labels); repeated
rows repeat their score; extra columns are ignored; a document labelled more than once counts each time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_SEP, cut, fold

VOCAB, PRIOR, Z, DRIFT, FLOOR = 200_000, 0.05, 3.5, 0.02, 1.0
#: Lengths of the first letters that a word backs off to.
STEMS = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
#: Counter entries a task holds before it hands them on.
HELD = 300_000
#: A document's full weight; weights are whole numbers, so that sums do not depend on their order.
UNIT = 1 << 20
_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def stems(word: str) -> list[str]:
    return [word[:n] + "*" for n in STEMS if len(word) >= n]


@dataclass
class Model:
    """Bounded by VOCAB entries; tasks get it with their function (Spark broadcasts a large one)."""

    odds: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    rate: float = 1e-6
    slope: float = 0.0
    bias: float = -50.0
    #: Scores of words met so far, bounded by HELD.
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def token_scores(self, words: list[str]) -> np.ndarray:
        known, odds = self.known, self.odds
        if len(known) > HELD:
            known.clear()
        for w in set(words).difference(known):
            known[w] = max([odds.get(w, 0.0), *[odds.get(x, 0.0) for x in stems(w)]])
        return np.fromiter(map(known.__getitem__, words), float, len(words)) - DRIFT

    def segments(self, scores: np.ndarray) -> list[tuple[int, int, float]]:
        """All maximal scoring segments (first, end, score). Only tokens of positive score open one, and
        those between are summed at once, so the Python loop runs over the evidence, not the text."""
        up = np.flatnonzero(scores > 0)
        if not len(up):
            return []
        total = np.concatenate(([0.0], np.cumsum(scores)))
        held: list[tuple[int, int, float, float]] = []  # first, end, sum before it, sum at its end
        for i in up:
            first, end, low, high = int(i), int(i) + 1, total[i], total[i + 1]
            while True:
                j = len(held) - 1
                while j >= 0 and held[j][2] >= low:
                    j -= 1
                if j < 0 or held[j][3] >= high:
                    held.append((first, end, low, high))
                    break
                first, low = held[j][0], held[j][2]
                del held[j:]
        return [(a, b, float(h - low)) for a, b, low, h in held]

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        noise = math.log(max(self.rate * max(n, 1), 1e-12))
        return sum(max(0.0, self.lam * (s - FLOOR) - noise) for _, _, s in found if s > FLOOR)

    def score(self, text: str | None) -> tuple[float, int, float]:
        words = tokens(text)
        found = self.segments(self.token_scores(words))
        e = self.evidence(found, len(words))
        z = self.bias + self.slope * e
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z)))), sum(s > FLOOR for _, _, s in found), e


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: tuple[Counter, Counter] = (Counter(), Counter())  # documents of full weight
    less: tuple[Counter, Counter] = (Counter(), Counter())  # weights of the others

    def flush() -> pd.DataFrame:
        for whole, counter in zip(held, less, strict=True):
            for w, c in whole.items():
                counter[w] += c * UNIT
            for w, c in list(counter.items()):
                for x in stems(w):
                    counter[x] += c
        rows = [(w, less[1][w], less[0][w]) for w in less[0].keys() | less[1].keys()]
        for counter in (*held, *less):
            counter.clear()
        return pd.DataFrame(rows, columns=["w", "pos", "neg"])

    for pdf in batches:
        for text, toxic, weight in zip(pdf["text"], pdf["toxic"], pdf["weight"], strict=True):
            if weight == UNIT:
                held[int(toxic)].update(set(tokens(text)))
            else:
                counter, weight = less[int(toxic)], int(weight)
                for w in set(tokens(text)):
                    counter[w] += weight
            if sum(map(len, (*held, *less))) > HELD:
                yield flush()
    yield flush()


def log_odds(counts: DataFrame, vocab: int = VOCAB) -> dict[str, float]:
    """The strongest entries. Words, and stems of each length, are vocabularies of their own. Counts are in UNITs."""
    counts = counts.withColumn("stem", F.when(F.col("w").endswith("*"), F.length("w")).otherwise(0))
    n = {r["stem"]: ((r["p"] or 0) / UNIT, (r["n"] or 0) / UNIT) for r in counts.groupBy("stem").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).collect()}
    counts = counts.withColumns({x: F.col(x) / UNIT for x in ("pos", "neg")})
    odds = F.lit(0.0)
    for stem, (p, q) in n.items():
        if not p or not q:
            continue
        c = F.col("pos") + F.col("neg")
        a1, a0 = c * (PRIOR * p / (p + q)), c * (PRIOR * q / (p + q))
        t1, t0 = p * (1 + PRIOR), q * (1 + PRIOR)
        delta = F.ln((F.col("pos") + a1) / (t1 - F.col("pos") - a1)) - F.ln((F.col("neg") + a0) / (t0 - F.col("neg") - a0))
        err = F.sqrt(1 / (F.col("pos") + a1) + 1 / (F.col("neg") + a0))
        odds = F.when(F.col("stem") == stem, delta - Z * err).otherwise(odds)
    top = counts.select("w", odds.alias("odds")).filter("odds > 0").orderBy(F.col("odds").desc(), "w").limit(vocab)
    return {r["w"]: r["odds"] for r in top.collect()}


def weighted(texts: DataFrame) -> DataFrame:
    """(text, toxic, weight) for every row. Four minwise values of the runs of four words group the rows of a label;
    a row weighs the mean of 1 / group size. Near copies mostly share all four values and weigh about one document
    together; texts that share a passage share a value now and then, and keep the weight of the others."""
    hs = F.transform(F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE_SEP), ""), lambda w: F.xxhash64(w))
    texts = texts.select("text", "toxic", hs.alias("hs"))  # a column of its own, for the lambda below reads it often
    last = F.size("hs") - 3
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("hs", i, 4)))
    runs = texts.select("text", "toxic", F.when(last > 0, runs).otherwise(F.array(F.xxhash64("hs"))).alias("x"))
    runs = runs.select("text", "toxic", "x", F.transform("x", lambda x: F.xxhash64(x, F.lit(1))).alias("y"))
    values = F.array(F.array_min("x"), F.array_max("x"), F.array_min("y"), F.array_max("y"))
    rows = cut(runs.select(F.monotonically_increasing_id().alias("row"), "text", "toxic", values.alias("values")), "train")
    each = rows.select("row", "toxic", F.posexplode("values").alias("k", "value"))
    groups = each.groupBy("toxic", "k", "value").agg(F.count("*").alias("m")).filter("m > 1")
    less = each.join(groups, ["toxic", "k", "value"]).groupBy("row").agg(F.sum(F.floor(F.lit(UNIT // 4) * (F.col("m") - 1) / F.col("m"))).alias("less"))
    # a merge join at any size, for both sides grow with the documents
    return rows.join(less.hint("merge"), "row", "left").select("text", "toxic", (F.lit(UNIT) - F.coalesce("less", F.lit(0))).cast("long").alias("weight"))


def fit(docs: DataFrame, labels: DataFrame, vocab: int = VOCAB) -> Model:
    """The model, from labelled documents outside fold 2."""
    spark = docs.sparkSession
    y = labels.filter("toxic is not null").select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(fold(F.col("doc_id")) != 2)
    # a merge join at any size, for both sides grow with the documents
    train = cut(weighted(docs.select("doc_id", "text").join(y.hint("merge"), "doc_id")), "train")
    kinds = {r["toxic"]: r["n"] / UNIT for r in train.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    pos, neg = kinds.get(1, 0), kinds.get(0, 0)
    if not pos or not neg:
        share = pos / (pos + neg) if pos + neg else 0.0
        return Model(bias=math.log(share / (1 - share)) if 0 < share < 1 else (50.0 if share else -50.0))
    counts = cut(train.mapInPandas(_count, "w string, pos long, neg long").groupBy("w").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "counts")
    model = Model(log_odds(counts, vocab))
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, toxic, weight in zip(pdf["text"], pdf["toxic"], pdf["weight"], strict=True):
                words = tokens(text)
                rows.append((toxic, weight, len(words), [s for _, _, s in model.segments(model.token_scores(words)) if s > FLOOR]))
            yield pd.DataFrame(rows, columns=["toxic", "weight", "n", "s"])

    seen = cut(train.mapInPandas(scan, "toxic int, weight long, n long, s array<double>"), "segments")
    share = F.col("weight") / UNIT
    clean = seen.filter("toxic = 0").agg(F.sum(share * F.col("n")).alias("n"), F.sum(share * F.size("s")).alias("k"), F.sum(share * F.aggregate("s", F.lit(0.0), lambda a, x: a + x - FLOOR)).alias("over")).first()
    n, k, over = clean["n"] or 1, clean["k"] or 0, clean["over"] or 0.0
    # one pseudo peak of mean excess 1 keeps both finite where chance never scores
    model.rate, model.lam = (k + 0.5) / n, (k + 1.0) / (over + 1.0)
    part = F.aggregate("s", F.lit(0.0), lambda a, x: a + F.greatest(F.lit(0.0), model.lam * (x - FLOOR) - F.ln(F.greatest(F.lit(1e-12), model.rate * F.greatest(F.col("n"), F.lit(1))))))
    hist = seen.groupBy("toxic", F.least(F.lit(200), F.floor(part * 4)).alias("bin")).agg((F.sum("weight") / UNIT).alias("n")).collect()  # 402 rows at most
    x = np.array([r["bin"] / 4 for r in hist], float)
    t = np.array([r["toxic"] for r in hist], float)
    w = np.array([r["n"] for r in hist], float)
    beta = np.zeros(2)
    for _ in range(50):  # Newton with a small ridge on the slope
        z = np.clip(beta[0] + beta[1] * x, -30, 30)
        p = 1 / (1 + np.exp(-z))
        g = np.array([(w * (t - p)).sum(), (w * (t - p) * x).sum() - 0.5 * beta[1]])
        v = w * p * (1 - p) + 1e-9
        h = np.array([[v.sum(), (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 0.5]])
        step = np.linalg.solve(h, g)
        beta += np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    model.bias, model.slope = float(beta[0]), max(0.0, float(beta[1]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, and the number of toxic passages and their evidence."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [model.score(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": [g[0] for g in got], "n_segments": [g[1] for g in got], "evidence": [g[2] for g in got]})

    out = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double, n_segments int, evidence double")
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_segments", "evidence")


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, first, end, score): every segment above the floor, in words from 0."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                rows += [(i, a, b, s) for a, b, s in model.segments(model.token_scores(tokens(text))) if s > FLOOR]
            yield pd.DataFrame(rows, columns=["doc_id", "first", "end", "score"])

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, first int, end int, score double")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents scored below the threshold, with their columns and rows as they are."""
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: model.score(t)[0] < THRESHOLD).astype(bool)

    return docs.filter(clean(F.col("text")))
