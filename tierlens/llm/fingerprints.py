"""Operator 5, document fingerprints by consistent weighted sampling (gamma-based samples per weighted term).

A document's terms are its white-space words, weighted by how often they occur. For each of ``SAMPLES``
samples and each term, a hash of (term, sample) gives r, c ~ Gamma(2, 1) and beta ~ U(0, 1); with weight w,
t = floor(ln w / r + beta) and ln a = ln c - r (t - beta + 1). The sample is the (term, t) with the least a;
two documents agree on a sample with probability sum(min(w)) / sum(max(w)), the generalised Jaccard
similarity. Least a and 32 bits of (term, t) are packed into one long, so that each sample is a plain
``min`` in a hash aggregate with map-side combining.

Of a text of n words the least a is exponential with rate n. From the same hash a bound below a follows without
logarithms: with p, y the products of uniforms in r = -ln p and c = -ln y >= g = 2 (1 - y) / (1 + y), a >= g p / w,
and for w = 1, where t = 0, a >= g p / (1 - beta (1 - p)). ``with_edits`` draws only candidates whose bound is at most
``CAP`` / n and then checks that every least a is below that; texts where one is not (one sample in e**CAP) are drawn
again in full, so that the results are those of all candidates.

Defined results: null text is empty text; a text without words has the fingerprint of all ones, equal to
that of any other such text; equal texts have equal fingerprints. ``next_ids`` orders distinct ids; rows
sharing an id share its next document, of which the smallest needed prefix counts; a null id is nobody's
next and has none (its edited text is its first half). Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_SEP, cut, row_key

#: Cost is in proportion: 64 samples took 6.4 s over 2.8 million weighted terms on 8 threads, 32 took 3.3 s. The
#: standard error of a likeness of 0.5 is 0.0625 with 64 samples.
SAMPLES = 64
#: One sample in e**24 is drawn again: a document in some hundred millions.
CAP = 24.0
_BITS = 8


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, nxt) for a frame of distinct non-null longs ``id``: the next lower id, and the highest after the lowest.

    A radix tree of windows over 2**8 ids each; an upper level sees one row per non-empty cell of the lower."""
    lo, hi = ids.agg(F.min("id"), F.max("id")).first()
    if lo is None:
        return ids.withColumn("nxt", F.col("id"))

    def level(frame: DataFrame, low: int, high: int) -> DataFrame:
        last = high - low < 1 << _BITS  # also ends the tree where ids of both signs meet
        frame = frame.withColumn("g", F.lit(0).cast("long") if last else F.shiftright("id", _BITS))
        inside = frame.select("id", F.lead("id").over(Window.partitionBy("g").orderBy(F.col("id").desc())).alias("nxt"))
        if last:
            return inside
        cells = frame.groupBy("g").agg(F.min("id").alias("id"), F.max("id").alias("top"))
        up = level(cells.select(F.col("g").alias("id")), low >> _BITS, high >> _BITS)
        up = up.select(F.col("id").alias("g"), F.col("nxt").alias("g2"))
        links = cells.select("g", "id").join(up, "g").join(cells.select(F.col("g").alias("g2"), "top"), "g2", "left").select("id", F.col("top").alias("nxt"))
        return inside.filter("nxt is not null").unionByName(links)

    return level(ids, lo, hi).select("id", F.coalesce("nxt", F.lit(hi)).alias("nxt"))


def word_hashes(text: Column) -> Column:
    """Sorted hashes of all words, so that equal words stand together."""
    return F.sort_array(F.transform(F.array_remove(F.split(text, SPACE_SEP), ""), lambda w: F.xxhash64(w)))


def run_starts(hs: Column) -> Column:
    """Where each run of equal hashes begins."""
    n = F.size(hs)
    return F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(hs, i) != F.get(hs, i - 1)))).otherwise(F.array().cast("array<int>"))


def weighted_terms(hs: Column, at: Column, which: int) -> Column:
    """array<struct<e, h, w>>: which text, distinct word hash, count; a null term first, so that empty texts keep a row."""
    none = F.array(F.struct(F.lit(which).alias("e"), F.lit(None).cast("long").alias("h"), F.lit(1).alias("w")))
    return F.concat(none, F.transform(at, lambda i, j: F.struct(F.lit(which).alias("e"), F.get(hs, i).alias("h"), (F.coalesce(F.get(at, j + 1), F.size(hs)) - i).alias("w"))))


def _rank(lna: Column) -> Column:
    """ln a as a whole number that keeps its order."""
    return F.floor((lna + F.lit(128.0)) * F.lit(2.0**23))


def _sample(h: Column, lnw: Column, k: int, most: tuple[Column, Column] | None = None) -> Column:
    """The packed candidate of one term for sample k: null for a null term, and for one whose a is above ``most`` by
    its bound. ``most`` is that limit times w, and the limit itself where w = 1 and else 0. Without it nothing is
    conditional, so that generated code computes each shared part once."""
    x = F.xxhash64(h, F.lit(k))
    unit = lambda s: F.shiftrightunsigned(x, s).bitwiseAND(F.lit(0xFFFF)) + F.lit(0.5)
    p, y = unit(48) * unit(32) * F.lit(2.0**-32), unit(16) * unit(0) * F.lit(2.0**-32)
    beta = F.hash(x).bitwiseAND(F.lit(0xFFFFFF)) * F.lit(2.0**-24)
    r, c = -F.ln(p), -F.ln(y)
    t = F.floor(lnw / r + beta)
    lna = F.ln(c) - r * (t - beta + F.lit(1.0))
    full = F.shiftleft(_rank(lna), 32).bitwiseOR(h.bitwiseXOR(t).bitwiseAND(F.lit(0xFFFFFFFF)))
    return full if most is None else F.when(p * (F.lit(4.0) / (y + F.lit(1.0)) - F.lit(2.0) - most[1] * beta) <= most[0] - most[1] * beta, full)


def shared_terms(hs: Column, at: Column, he: Column, ate: Column) -> Column:
    """The terms of two texts as in ``weighted_terms``; a word that both hold equally often stands once, as e = 2.
    Equal terms have equal candidates, so those of e = 2 need to be drawn but once."""
    flat = lambda x, a, e: F.transform(a, lambda i, j: F.struct(F.get(x, i).alias("h"), (F.coalesce(F.get(a, j + 1), F.size(x)) - i).alias("w"), F.lit(e).alias("e")))
    return F.sort_array(F.concat(flat(hs, at, 0), flat(he, ate, 1)))


def term_rows(terms: Column) -> Column:
    """array<struct<e, h, w>> of sorted ``shared_terms``, a null term of either text first."""
    n = F.size(terms)
    like = lambda x, y: (x["h"] == y["h"]) & (x["w"] == y["w"])
    fresh = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | ~like(F.get(terms, i), F.get(terms, i - 1)))
    at = F.when(n > 0, fresh).otherwise(F.array().cast("array<int>"))
    none = [F.struct(F.lit(e).alias("e"), F.lit(None).cast("long").alias("h"), F.lit(1).alias("w")) for e in (0, 1)]
    both = lambda i: F.coalesce(like(F.get(terms, i), F.get(terms, i + 1)), F.lit(False))
    return F.concat(F.array(*none), F.transform(at, lambda i: F.struct(F.when(both(i), F.lit(2)).otherwise(F.get(terms, i)["e"]).alias("e"), F.get(terms, i)["h"].alias("h"), F.get(terms, i)["w"].alias("w"))))


def least_samples(rows: DataFrame, keys: list[str], samples: int = SAMPLES, most: str | None = None) -> DataFrame:
    """From rows (keys, h, w) the least candidates: keys, ``ms`` (array of ``samples`` longs) and ``copies``, the
    number of null terms. With a column ``most``, candidates above it may be left out."""
    rows = rows.withColumn("lnw", F.ln(F.col("w").cast("double")))
    if most:
        rows = rows.withColumns({"mw": F.col(most) * F.col("w"), "m1": F.when(F.col("w") == 1, F.col(most)).otherwise(0.0)})
    limits = (F.col("mw"), F.col("m1")) if most else None
    least = [F.min(_sample(F.col("h"), F.col("lnw"), k, limits)).alias(f"m{k}") for k in range(samples)]
    out = rows.groupBy(*keys).agg(*least, F.sum(F.col("h").isNull().cast("long")).alias("copies"))
    return out.select(*keys, F.array(*[F.col(f"m{k}") for k in range(samples)]).alias("ms"), "copies")


def signature(ms: Column) -> Column:
    """An array of longs below 2**32 from the least candidates; all ones where there was no term."""
    low = F.lit(0xFFFFFFFF)
    return F.transform(ms, lambda m: F.coalesce(m.bitwiseAND(low), low))


def sample_terms(rows: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """From rows (keys, h, w) the signatures: keys and ``fp``, an array of ``samples`` longs below 2**32."""
    return least_samples(rows, keys, samples).select(*keys, signature(F.col("ms")).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a)


def to_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def fingerprints(texts: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """The general operator: rows (doc_id, text) to one (doc_id, rk, fp) per distinct row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = texts.select("doc_id", row_key(text).alias("rk"), word_hashes(text).alias("hs")).withColumn("at", run_starts(F.col("hs")))
    rows = rows.select("doc_id", "rk", F.inline(weighted_terms(F.col("hs"), F.col("at"), 0)))
    return sample_terms(rows, ["doc_id", "rk"], samples)


def packed(fp: Column) -> Column:
    """A signature in ints, half as wide, for tables and shuffles."""
    return F.transform(fp, lambda v: (v - F.lit(1 << 31)).cast("int"))


def unpacked(fp: Column) -> Column:
    return F.transform(fp, lambda v: v.cast("long") + F.lit(1 << 31))


def _signed(both: DataFrame, samples: int, cap: float | None) -> DataFrame:
    """From rows (doc_id, text, tail) one row per distinct row: its keys, ``copies``, packed signatures ``fp``, ``fe``
    of text and edited text, and ``sure``: whether all candidates left out by ``cap`` were above the least ones."""
    n = F.length("text")
    halved = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - halved), F.coalesce(F.substr("tail", F.lit(1), halved), F.lit("")))
    both = both.select("doc_id", row_key(F.col("text")).alias("rk"), n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    keys = ["doc_id", "rk", "n_chars", "edited_sha256", "n0", "n1", "most"]
    both = both.select("doc_id", "rk", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), word_hashes(F.col("text")).alias("hs"), word_hashes(F.col("edited")).alias("he"))
    both = both.withColumns({"at": run_starts(F.col("hs")), "ate": run_starts(F.col("he")), "n0": F.size("hs"), "n1": F.size("he")})
    both = both.withColumn("most", F.lit(cap or 0.0) / F.greatest(F.lit(1), F.least("n0", "n1")))
    both = both.select(*keys, shared_terms(F.col("hs"), F.col("at"), F.col("he"), F.col("ate")).alias("terms"))
    got = least_samples(both.select(*keys, F.inline(term_rows(F.col("terms")))), [*keys, "e"], samples, "most" if cap else None)
    got = got.groupBy(*keys).agg(*[F.max(F.when(F.col("e") == e, F.col("ms"))).alias(f"m{e}") for e in range(3)], F.max(F.when(F.col("e") == 0, F.col("copies"))).alias("copies"))
    whole = lambda e: F.coalesce(F.zip_with(e, "m2", lambda x, y: F.least(x, y)), F.col(e)).alias(e)
    got = got.select(*keys, "copies", whole("m0"), whole("m1"))
    # two steps of the rank are far more than the rounding of a bound
    below = lambda m: F.coalesce(F.shiftright(m, 32) + F.lit(2) <= _rank(F.ln("most")), F.lit(False))
    sure = (F.col("n0") == 0) | F.forall("m0", below), (F.col("n1") == 0) | F.forall("m1", below)
    return got.select(*keys[:4], "copies", packed(signature(F.col("m0"))).alias("fp"), packed(signature(F.col("m1"))).alias("fe"), (sure[0] & sure[1] if cap else F.lit(True)).alias("sure"))


def with_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and both likenesses (the contract of the query).

    The texts are shuffled once, by id, for both joins; only the tails move on to the ids that need them."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    nxt = cut(next_ids(docs.select(F.col("doc_id").alias("id")).filter("id is not null").distinct()), "next")
    named = docs.filter("doc_id is not null")
    half = named.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 2)).alias("half"))
    need = nxt.join(half, nxt["id"] == half["doc_id"]).select("id", "nxt", "half")
    tails = named.join(need.hint("merge"), F.col("doc_id") == F.col("nxt")).select("id", F.expr("left(text, int(half))").alias("tail"))
    tails = tails.groupBy("id").agg(F.min("tail").alias("tail"))
    both = named.join(tails.hint("merge"), F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "tail")
    nameless = docs.filter("doc_id is null").select("doc_id", "text", F.lit(None).cast("string").alias("tail"))
    got = cut(_signed(both, samples, CAP).unionByName(_signed(nameless, samples, CAP)), "signatures")
    unsure = got.filter(~F.col("sure")).select(F.col("doc_id").alias("_d")).distinct()
    if not unsure.isEmpty():
        unsure = cut(unsure, "unsure")
        these = lambda rows, how: rows.join(unsure, rows["doc_id"].eqNullSafe(unsure["_d"]), how)
        again = [_signed(these(rows, "left_semi"), samples, None) for rows in (both, nameless)]
        got = cut(these(got, "left_anti").unionByName(again[0]).unionByName(again[1]), "signatures")
    first = got.groupBy("doc_id").agg(F.min(F.struct("rk", "fp"))["fp"].alias("fn")).join(nxt, F.col("doc_id") == F.col("nxt")).select("id", "fn")
    out = got.join(first, F.col("doc_id") == F.col("id"), "left")
    out = out.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("doc_id", "n_chars", "edited_sha256", to_text(unpacked(F.col("fp"))).alias("fingerprint"), to_text(unpacked(F.col("fe"))).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("fe")).alias("near_edited"), F.coalesce(likeness(F.col("fp"), F.col("fn")), F.lit(0.0)).alias("near_next"))
