"""Operator 9, quality by ordinal cumulative-link regression on graded ratings: hashed-text weights shared by
all grades and ordered thresholds, P(grade <= k) = sigmoid(threshold_k - weights . features).

Features of a whole text: its words (and pairs of neighbouring character shapes) hashed to ``BUCKETS``, with
weight log(1 + count) scaled to unit length, and a few shares (marks, capitals, digits, repeats). The fit is
full-batch on at most ``TRAIN_ROWS`` labelled documents outside fold 2, picked by hash: the documented bound
of the classifier, so its features may be gathered. Scores: the expected grade, and the tail probability of
the top grades for selection.

Grades of the query: 0 low quality; 1 good quality but toxic; 2 good quality.

Defined results: null and empty texts have only the bias and get its score; without labels the tail is 1 and
nothing is rejected; a grade without examples gets a narrow band; repeated rows repeat their score; a
document labelled more than once counts each time; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold

BUCKETS, TRAIN_ROWS, STEPS, RIDGE, GRADES = 1 << 14, 8_000, 200, 1e-4, 3
SHARES = 6
_WORD = re.compile(r"\w+|[^\w\s]+")


class Featurizer:
    """(indices, values) of a text; keeps a bounded cache of word buckets."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        words = _WORD.findall(text)
        if len(self.known) > 500_000:
            self.known.clear()
        counts = Counter(words)
        at: Counter = Counter()
        for w, c in counts.items():
            b = self.known.get(w)
            if b is None:
                b = self.known[w] = zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % BUCKETS
            at[b] += c
        idx = np.fromiter(at.keys(), np.int32, len(at))
        val = np.log1p(np.fromiter(at.values(), np.float64, len(at)))
        if len(val):
            val /= np.sqrt((val * val).sum())
        n, k = max(len(text), 1), max(len(words), 1)
        lines = text.split("\n")
        shares = [
            sum(c * len(w) for w, c in counts.items() if not w[0].isalnum()) / n,
            sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / k,
            sum(c for w, c in counts.items() if w[0].isdigit()) / k,
            1 - len(counts) / k,
            1 - len(set(lines)) / len(lines),
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / k,
        ]
        return np.concatenate([idx, np.arange(BUCKETS, BUCKETS + SHARES, dtype=np.int32)]), np.concatenate([val, np.array(shares) * 4])


@dataclass
class Model:
    weights: np.ndarray  # BUCKETS + SHARES
    cuts: np.ndarray  # GRADES - 1 ordered thresholds

    def below(self, eta: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each k but the last."""
        return 1 / (1 + np.exp(-np.clip(self.cuts[None, :] - eta[:, None], -40, 40)))


def grade(quality: Column, toxic: Column) -> Column:
    return F.when(quality == 0, 0).when(toxic == 1, 1).otherwise(2)


def fit(docs: DataFrame, ratings: DataFrame, rows: int = TRAIN_ROWS, grades: int = GRADES) -> Model | None:
    """The model from ratings (doc_id, grade); None without any."""
    ratings = ratings.filter("grade is not null").filter(fold(F.col("doc_id")) != 2)
    n = ratings.count()
    if not n:
        return None
    share = F.lit(int(min(1.0, 0.95 * rows / n) * (1 << 31)))
    some = ratings.filter(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 31)) < share)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Featurizer()
        for pdf in batches:
            got = [features(t) for t in pdf["text"]]
            yield pd.DataFrame({"y": pdf["y"], "idx": [g[0].tobytes() for g in got], "val": [g[1].astype(np.float32).tobytes() for g in got]})

    train = docs.select("doc_id", "text").join(some, "doc_id").select("text", F.col("grade").cast("int").alias("y"))
    got = train.mapInPandas(run, "y int, idx binary, val binary").limit(rows).collect()
    if not got:
        return None
    y = np.array([r["y"] for r in got])
    idx = [np.frombuffer(r["idx"], np.int32) for r in got]
    row, col = np.repeat(np.arange(len(got)), [len(i) for i in idx]), np.concatenate(idx)
    val = np.concatenate([np.frombuffer(r["val"], np.float32) for r in got]).astype(np.float64)
    del got, idx
    size = BUCKETS + SHARES
    counts = np.bincount(y, minlength=grades) + 0.5
    cum = np.cumsum(counts)[:-1] / counts.sum()
    start = np.log(cum / (1 - cum))
    # parameters: weights, first threshold, logs of the gaps, so that thresholds stay ordered
    p = np.concatenate([np.zeros(size), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, STEPS + 1):
        w, gaps = p[:size], np.exp(p[size + 1 :])
        cuts = p[size] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(row, weights=val * w[col], minlength=len(y))
        s = np.concatenate([np.zeros((len(y), 1)), 1 / (1 + np.exp(-np.clip(cuts[None, :] - eta[:, None], -40, 40))), np.ones((len(y), 1))], axis=1)
        hi, lo = s[np.arange(len(y)), y + 1], s[np.arange(len(y)), y]
        prob = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / prob, lo * (1 - lo) / prob
        d_eta = dhi - dlo  # derivative of -log prob
        g = np.zeros_like(p)
        g[:size] = np.bincount(col, weights=val * d_eta[row], minlength=size) / len(y) + RIDGE * w
        d_cut = np.array([(-dhi[y == k].sum() + dlo[y == k + 1].sum()) for k in range(grades - 1)]) / len(y)
        g[size] = d_cut.sum()
        g[size + 1 :] = gaps * np.cumsum(d_cut[::-1])[::-1][1:]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p = p - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Model(p[:size].copy(), p[size] + np.concatenate([[0.0], np.cumsum(np.exp(p[size + 1 :]))]))


def score(docs: DataFrame, model: Model | None, keep_from: int = 1) -> DataFrame:
    """doc_id, held_out, expected_grade, tail (probability of a grade of keep_from or more), kept."""
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    if model is None:
        return docs.select("doc_id", held_out, F.lit(float(GRADES - 1)).alias("expected_grade"), F.lit(1.0).alias("tail"), F.lit(True).alias("kept"))
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Featurizer()
        for pdf in batches:
            got = [features(t) for t in pdf["text"]]
            below = model.below(np.array([model.weights[i] @ x for i, x in got], float).reshape(-1))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "expected_grade": (1 - below).sum(axis=1), "tail": 1 - below[:, keep_from - 1]})

    out = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, expected_grade double, tail double")
    return out.select("doc_id", held_out, "expected_grade", "tail", (F.col("tail") >= 0.5).alias("kept"))
