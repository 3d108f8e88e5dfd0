"""Operator 12, cross-tokenizer alignment by inverted pair bitmaps.

A text is encoded by a byte-level BPE (A) and by a merge-type SentencePiece model (B). Where an A token and a B
token share bytes they are linked: between two neighbouring ends of tokens, of either kind, lies exactly one link.
Byte offsets where both end cut the tokens into groups.

Scores need corpus-wide counts: in how many documents an id pair is linked. They come from an inverted index. Each
task deals its documents into blocks of at most 65,536 and keeps, for each pair and block, the set of documents as
a compressed bitmap: two bytes a document, or one bit for each place of the block where that is shorter. Sets of
further batches are OR-merged into it while the block is open. How often a pair is linked inside a document stands
in multiplicity planes beside it, bitmaps of the binary digits of the count less one. Spark sums the bits of a
pair's bitmaps (documents) and of its planes (links), finds the best counts of each A id, joins the counts to the
bitmaps, and sends them back by block, where each posting adds its pair's count to its documents.

No row is made for a link and none for a pair and document. A pair that stands in every document has one row for
each block; the largest group anywhere is the rows of a block. Counts are joined, not broadcast.

Defined results: a null or empty text, and one whose token bytes are not the text's, has no tokens: zeros and an
empty digest; very long texts are encoded whole; repeated rows are documents of their own; ties of the best count
are all best; an empty table gives an empty result; only doc_id and text are read, so extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut
from .piece_bpe import MARK, PieceBPE, slices

#: Documents of a block: places fit 16 bits.
BLOCK_DOCS = 65_536
#: (pair, document) entries of an open block before it is closed: a bound on a task's memory.
BLOCK_ENTRIES = 4_000_000
#: Parts of texts whose tokens a task keeps from one slice to the next: a bound on memory.
KEPT = 300_000
PLACE_BITS = 16
#: Fixed value: how a byte-level pre-tokenizer cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters stand for
    themselves, the other bytes, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Pair:
    """Both tokenizers. Texts are cut into parts before white space where neither can reach across (checked when
    the vocabularies are read; else a text is one part); tokens, groups and links of a part are computed once."""

    def __init__(self, a_json: str, b_model: bytes):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        spec = json.loads(a_json)
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("A must be a byte-level vocabulary without a normalizer")
        self.b = PieceBPE(b_model)
        if not self.b.plain or not self.b.bytes:
            raise ValueError("B must normalise nothing but spaces and fall back to bytes")
        char = byte_of_char()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(char[c] for c in token) if all(c in char for c in token) else token.encode()
        one = {i: bytes([v]) for v, i in self.b.bytes.items()}
        self.b_bytes = [one.get(i, p.replace(MARK, " ").encode()) for i, p in enumerate(self.b.pieces)]
        self.a_bits, self.b_bits = (len(x).bit_length() for x in (self.a_bytes, self.b_bytes))
        if self.a_bits + self.b_bits + PLACE_BITS > 63:
            raise ValueError("the vocabularies are too large for a 64-bit key")
        across = re.compile(rf"[^{MARK}\s][{MARK}\n]")
        free = pre.get("use_regex", True) and not pre.get("add_prefix_space", True) and not any(across.search(p) for p in self.b.ids)
        # a part begins with white space that follows none and whose first character is a blank or a line break
        self.parts = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+" if free else r".+", re.DOTALL)
        self.free = free
        self.words = [f"{i}{c}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for c in ",|,;"]
        self.encode_a = self._by_ranks(spec) if free else None
        self.encode_a = self.encode_a or (lambda t: self.a.encode(t, add_special_tokens=False).ids)
        self.reset()

    def _by_ranks(self, spec: dict):
        """A's merges as ranks, which tiktoken applies several times as fast, if the order of its merges is that of
        its ids; else None."""
        char, vocab = byte_of_char(), spec["model"]["vocab"]
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in spec["model"]["merges"]]
        if made != sorted(made) or len(set(made)) != len(made) or not all(c in vocab for c in char):
            return None
        import tiktoken

        ranks = {bytes(char[c] for c in t): i for t, i in vocab.items() if all(c in char for c in t)}
        if len(ranks) != len(made) + len(char):
            return None
        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def reset(self) -> None:
        import numpy as np

        self.index: dict[str, int] = {}
        self.groups: list[str | None] = []  # each group ends in a semicolon; None: the tokens do not give the part's bytes
        self.nothing = np.zeros((1, 4), np.int64)
        self.sizes = [self.nothing[:0]]  # tokens of A, of B, groups, links of each part
        self.codes = [np.zeros(0, np.int64)]  # the linked pairs of all parts, one part after the other

    def learn(self, parts: set[str]) -> None:
        """Have tokens, groups and links of these parts known."""
        new = [p for p in parts if p not in self.index]
        if len(self.index) + len(new) > KEPT:
            self.reset()
            new = list(parts)
        if new:
            self._add(new)

    def _add(self, new: list[str]) -> None:
        """Tokens, groups and links of new parts. Parts that end in no white space stand one after the other as in a
        text, so they are encoded together; the others, and those that hold B's mark, one by one."""
        alone = [p for p in new if not self.free or p[-1].isspace() or MARK in p]
        if alone:
            odd = set(alone)
            new = [p for p in new if p not in odd]
        if new and not self._add_together(new):
            alone += new
        for p in alone:
            if not self._add_together([p]):
                self.index[p] = len(self.groups)
                self.groups.append(None)
                self.sizes.append(self.nothing)

    def _add_together(self, new: list[str]) -> bool:
        """False if the tokens do not give the parts' bytes, or if one reaches across parts."""
        import numpy as np

        text = "".join(new)
        flat_a = self.encode_a(text)
        pieces = self.b.parts.findall(text.replace(" ", MARK))
        self.b.learn(set(pieces))
        flat_b = np.frombuffer(b"".join(map(self.b.table.__getitem__, pieces)), np.int32)
        a_parts, b_parts, raw = [self.a_bytes[i] for i in flat_a], [self.b_bytes[i] for i in flat_b.tolist()], text.encode()
        if not b"".join(a_parts) == b"".join(b_parts) == raw:
            return False
        flat_a = np.array(flat_a, np.int64)
        a_ends, b_ends = np.cumsum([len(x) for x in a_parts]), np.cumsum([len(x) for x in b_parts])
        ends = np.union1d(a_ends, b_ends)  # a link stands before each end
        codes = flat_a[np.searchsorted(a_ends, ends)] << self.b_bits | flat_b[np.searchsorted(b_ends, ends)]
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)  # a group stands before each cut
        at = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) if len(raw) == len(text) else [len(p.encode()) for p in new])
        if not np.array_equal(cuts[np.minimum(np.searchsorted(cuts, at), len(cuts) - 1)], at):
            return False
        counted = lambda x: np.diff(np.searchsorted(x, at, "right"), prepend=0)
        sizes = np.c_[counted(a_ends), counted(b_ends), counted(cuts), counted(ends)]
        last = np.cumsum(sizes[:, :2], 0)
        # the digest's words: ids in the order of groups, those of A before those of B, each with what follows it
        group = np.r_[np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)]
        order = np.lexsort((np.arange(len(group)) >= len(a_ends), group))
        ends_group = np.r_[np.isin(a_ends, cuts, assume_unique=True), np.isin(b_ends, cuts, assume_unique=True)]
        kind = np.r_[np.zeros(len(a_ends), np.int64), np.full(len(b_ends), 2)] + ends_group
        words = [self.words[i] for i in (np.r_[flat_a, flat_b][order] * 4 + kind[order]).tolist()]
        stops = last.sum(1).tolist()
        self.index.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
        self.groups += ["".join(words[x:y]) for x, y in zip([0, *stops], stops, strict=False)]
        self.sizes.append(sizes)
        self.codes.append(codes)
        return True

    def align(self, texts: Sequence[str | None]):
        """Per text: sizes (a row of tokens of A, of B, groups and links), groups text, and the linked pairs as
        arrays (pair, text, count), each pair of a text at least once."""
        import numpy as np

        split = [self.parts.findall(" " + t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(split)))
        sizes, out = np.zeros((len(texts), 4), np.int64), []
        self.sizes, self.codes = [np.concatenate(self.sizes)], [np.concatenate(self.codes)]
        known, groups = self.sizes[0], self.groups
        uses: list = []
        for row, parts in enumerate(split):
            at = list(map(self.index.__getitem__, parts))
            said = [groups[i] for i in at]
            if None in said:
                said = []
            out.append("".join(said)[:-1])
            if said:
                u, c = np.unique(at, return_counts=True)
                sizes[row] = (known[u] * c[:, None]).sum(0)
                uses.append((u, np.full(len(u), row), c))
        if not uses:
            return sizes, out, *(np.empty(0, np.int64) for _ in range(3))
        u, row, c = (np.concatenate(x) for x in zip(*uses, strict=True))
        many = known[:, 3]
        first = np.concatenate([[0], np.cumsum(many)])[u]
        n = many[u]
        place = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return sizes, out, self.codes[0][place], np.repeat(row, n), np.repeat(c, n)


def summed(keys, counts):
    """Sorted distinct keys and their summed counts: sets of two batches OR-merged, planes added."""
    import numpy as np

    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def bitmaps(codes, places, size: int):
    """(code, dense, set) columns of sorted (code, place) entries: a set is an array of 16-bit places or, where that
    is shorter, a bitmap over the block's places."""
    import numpy as np
    import pyarrow as pa

    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    ends = np.r_[starts[1:], len(codes)]
    width = -(-size // 8)
    dense = 2 * (ends - starts) > width
    packed = places.astype("<u2").tobytes()
    sets = [packed[2 * a : 2 * b] if not d else np.packbits(np.bincount(places[a:b], minlength=size).astype(bool), bitorder="little").tobytes() for a, b, d in zip(starts.tolist(), ends.tolist(), dense.tolist(), strict=True)]
    return codes[starts], dense, pa.array(sets, pa.binary())


#: One table holds the documents (``a`` null) and the postings of a task, so both come from one attempt.
INDEX = "block long, place int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a int, b int, plane int, dense boolean, docs binary"


def index(docs: DataFrame, a_json: str, b_model: bytes) -> DataFrame:
    """The inverted index with its documents (``INDEX``). plane 0: the documents in which the pair is linked;
    plane j: those in which bit j - 1 of the number of its links, less one, is set."""
    rows = docs.select("doc_id", "text")
    schema = T._parse_datatype_string(INDEX.format(kind=rows.schema["doc_id"].dataType.simpleString()))

    def run(batches: Iterable) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        pair, part, blocks = Pair(a_json, b_model), TaskContext.get().partitionId(), 0
        places, keys, counts, held = 0, [], [], 0

        def rows_of(n: int, **given):
            kinds = {"block": pa.int64(), "place": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "a": pa.int32(), "b": pa.int32(), "plane": pa.int32(), "dense": pa.bool_(), "docs": pa.binary()}
            names = [f.name for f in schema.fields]
            return pa.RecordBatch.from_arrays([given[c] if isinstance(given.get(c), pa.Array) else pa.array(given[c], kinds[c]) if c in given else pa.nulls(n, kinds[c] if c in kinds else doc_kind) for c in names], names=names)

        def close():
            nonlocal places, keys, counts, held, blocks
            if keys:
                k, m = summed(np.concatenate(keys), np.concatenate(counts))
                for plane in range(1 + int(m.max() - 1).bit_length() if len(k) else 0):
                    on = k if plane == 0 else k[((m - 1) >> (plane - 1)) & 1 == 1]
                    if not len(on):
                        continue
                    code, dense, sets = bitmaps(on >> PLACE_BITS, on & (BLOCK_DOCS - 1), places)
                    for x in range(0, len(code), 50_000):
                        y = min(len(code), x + 50_000)
                        yield rows_of(y - x, block=np.full(y - x, part << 24 | blocks), a=(code[x:y] >> pair.b_bits).astype(np.int32), b=(code[x:y] & ((1 << pair.b_bits) - 1)).astype(np.int32), plane=np.full(y - x, plane, np.int32), dense=dense[x:y], docs=sets.slice(x, y - x))
            blocks, places, keys, counts, held = blocks + 1, 0, [], [], 0

        doc_kind = None
        for batch in batches:
            doc_kind = batch.column("doc_id").type
            texts = batch.column("text").to_pylist()
            for x, y in slices([t or "" for t in texts]):
                for a in range(x, y, BLOCK_DOCS):
                    b = min(y, a + BLOCK_DOCS)
                    if places + b - a > BLOCK_DOCS:
                        yield from close()
                    sizes, groups, code, row, count = pair.align(texts[a:b])
                    sha = [hashlib.sha256(g.encode()).hexdigest() if n else "" for g, n in zip(groups, sizes[:, 0].tolist(), strict=True)]
                    n = b - a
                    yield rows_of(n, block=np.full(n, part << 24 | blocks), place=np.arange(places, places + n, dtype=np.int32), doc_id=batch.column("doc_id").slice(a, n), n_a=sizes[:, 0], n_b=sizes[:, 1], n_groups=sizes[:, 2], n_links=sizes[:, 3], groups_sha256=sha)
                    k, m = summed(code << PLACE_BITS | (places + row), count)
                    keys.append(k)
                    counts.append(m)
                    places, held = places + n, held + len(k)
                    if held > BLOCK_ENTRIES:
                        yield from close()
        if places:
            yield from close()

    return rows.mapInArrow(run, schema)


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, docs, links, best): in how many documents each pair is linked, how often, and whether no pair of its A
    id is linked in more documents. The window holds the pairs of one A id: no more than B has pieces."""
    bits = F.when(F.col("dense"), F.bitmap_count("docs")).otherwise(F.octet_length("docs") / 2).cast("long")
    worth = F.when(F.col("plane") < 2, F.lit(1).cast("long")).otherwise(F.pow(F.lit(2.0), F.col("plane") - 1).cast("long"))
    out = postings.groupBy("a", "b").agg(F.sum(F.when(F.col("plane") == 0, bits)).alias("docs"), F.sum(bits * worth).alias("links"))
    return out.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def posting_scores(postings: DataFrame, pairs: DataFrame) -> DataFrame:
    """(block, place, n_best, count_sum): every posting returns its pair's count to its documents, as often as the
    planes say."""
    worth = F.when(F.col("plane") < 2, F.lit(1).cast("long")).otherwise(F.pow(F.lit(2.0), F.col("plane") - 1).cast("long"))
    counts = pairs.select("a", "b", F.col("docs").alias("in_docs"), "best")
    sent = postings.join(counts, ["a", "b"]).select("block", (worth * F.col("in_docs")).alias("score"), F.when(F.col("best"), worth).otherwise(0).alias("best"), "dense", "docs")

    def run(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        now, score, best = None, None, None

        def full():
            at = np.flatnonzero(score)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), now)), pa.array(at, pa.int32()), pa.array(best[at]), pa.array(score[at])], names=["block", "place", "n_best", "count_sum"])

        for batch in batches:
            block = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for x, y in zip(edges, edges[1:], strict=False):
                if x == y:
                    continue
                if block[x] != now:
                    if now is not None:
                        yield full()
                    now, score, best = block[x], np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
                rows = batch.slice(x, y - x)
                dense = rows.column("dense").to_numpy(zero_copy_only=False)
                s, t, sets = rows.column("score").to_numpy(), rows.column("best").to_numpy(), rows.column("docs").to_pylist()
                thin = np.flatnonzero(~dense)
                places = np.frombuffer(b"".join([sets[i] for i in thin]), "<u2")
                many = np.array([len(sets[i]) // 2 for i in thin], np.int64)
                np.add.at(score, places, np.repeat(s[thin], many))
                np.add.at(best, places, np.repeat(t[thin], many))
                for i in np.flatnonzero(dense):
                    on = np.unpackbits(np.frombuffer(sets[i], np.uint8), bitorder="little").astype(np.int64)
                    score[: len(on)] += s[i] * on
                    best[: len(on)] += t[i] * on
        if now is not None:
            yield full()

    return sent.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block long, place int, n_best long, count_sum long")


def align(docs: DataFrame, a_json: str, b_model: bytes) -> tuple[DataFrame, DataFrame]:
    """The documents with their digest and scores, and the pairs with their counts."""
    both = cut(index(docs, a_json, b_model), "alignment")
    postings = both.filter("a is not null").select("block", "a", "b", "plane", "dense", "docs")
    pairs = cut(pair_counts(postings), "pairs")
    scores = posting_scores(postings, pairs)
    rows = both.filter("a is null").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    out = rows.join(scores, ["block", "place"], "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"), pairs
