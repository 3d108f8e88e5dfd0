"""Operator 11, SentencePiece encoding and decoding of merge-type vocabularies by a score-ordered agenda.

A text is normalised as its model says and cut where no piece can reach across (before white space, proved from
the vocabulary when the model is read). In each part the agenda holds the adjacent symbol pairs that join to a
piece, best score first, leftmost first among equals: the best pair is joined, pairs that lost a side go, and the
new neighbours' pairs enter. Short parts run their agendas side by side as rows of an array, long ones on a heap.
Symbols that are no piece fall back to their bytes. Parts repeat, so their ids are kept in a table of bounded
size, which changes no result.

Rows stream through Arrow batches, one slice of texts at a time; the sentencepiece library decodes the ids and, in
``check``, encodes the same slice again for an exact comparison. The model travels to the tasks as bytes (a
vocabulary file, some hundred kB), read once in the driver.

Defined results: a null text is the empty text and has no ids; very long texts are encoded whole; repeated rows
each give a row; ties of score go to the left; an empty table gives an empty result; only the key columns and the
text are read, so extra columns of any name are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: Parts whose ids a task keeps from one slice of texts to the next, and the longest part that the side-by-side
#: agendas take (longer ones have a heap of their own). Bounds on memory, not on texts.
KEPT, KEPT_CHARS = 600_000, 64
#: Characters of text that are encoded at a time.
SLICE_CHARS = 2_000_000


def proto_fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message: varints as int, the rest as bytes."""
    i, end = 0, len(buf)

    def varint(i: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            b = buf[i]
            out |= (b & 127) << shift
            i, shift = i + 1, shift + 7
            if b < 128:
                return out, i

    while i < end:
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        else:
            n, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = buf[i : i + n], i + n
        yield tag >> 3, value


class PieceBPE:
    """The agenda encoder of one model, beside the library's processor of the same model."""

    def __init__(self, model: bytes):
        import sentencepiece

        top = list(proto_fields(model))
        trainer = dict(proto_fields(next((v for k, v in top if k == 2), b"")))
        if trainer.get(3, 1) != 2:
            raise ValueError("not a merge-type (BPE) vocabulary")
        norm = dict(proto_fields(next((v for k, v in top if k == 3), b"")))
        #: Normalising only puts the mark before the text and in the place of each space.
        self.plain = not norm.get(2) and bool(norm.get(3, 1)) and not norm.get(4, 1) and bool(norm.get(5, 1))
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces, self.kinds = sp.id_to_piece(list(range(n))), [4 if sp.is_unused(i) else 6 if sp.is_byte(i) else 3 if sp.is_control(i) or sp.is_unknown(i) else 1 for i in range(n)]
        kinds = [dict(proto_fields(v)).get(3, 1) for k, v in top if k == 1]
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in (1, 4)}
        self.cost = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.unused = {p for p, i in self.ids.items() if self.kinds[i] == 4}
        self.bytes = {int(self.pieces[i][3:-1], 16): i for i in range(n) if self.kinds[i] == 6}
        self.unknown = sp.unk_id()
        own = sorted((self.pieces[i] for i, k in enumerate(kinds) if k == 4), key=len, reverse=True)  # user-defined symbols are never split
        self.symbol = re.compile("|".join([*map(re.escape, own), "."]), re.DOTALL) if own else None
        across = re.compile(rf"[^{MARK}][{MARK}\n]|\n.", re.DOTALL)
        free = not any(across.search(p) for p in [*self.ids, *own])
        self.free = free
        self.parts = re.compile(rf"{MARK}*[^{MARK}\n]+|\n|{MARK}+" if free else r".+", re.DOTALL)
        self.table: dict[str, bytes] = {}
        self._rules()

    def merge(self, part: str) -> list[int]:
        """Ids of one part by the agenda."""
        cost, sym = self.cost, self.symbol.findall(part) if self.symbol else list(part)
        n, split = len(sym), {}
        frozen = {i for i, s in enumerate(sym) if len(s) > 1} if self.symbol else ()
        agenda = [(cost[s], i, i + 1, s) for i in range(n - 1) if (s := sym[i] + sym[i + 1]) in cost and i not in frozen and i + 1 not in frozen]
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while agenda:
            _, i, j, s = heappop(agenda)
            a, b = sym[i], sym[j]
            if not a or not b or len(a) + len(b) != len(s):
                continue
            if s in self.unused:
                split[s] = a, b
            sym[i], sym[j] = s, ""
            k = after[i] = after[j]
            before[k] = i
            h = before[i]
            if k < n and (t := s + sym[k]) in cost and k not in frozen:
                heappush(agenda, (cost[t], i, k, t))
            if h >= 0 and (t := sym[h] + s) in cost and h not in frozen:
                heappush(agenda, (cost[t], h, i, t))
        out: list[int] = []
        todo = [s for s in reversed(sym) if s]
        while todo:
            s = todo.pop()
            if s in split:
                todo += split[s][::-1]
            elif s in self.ids:
                out.append(self.ids[s])
            elif self.bytes:
                out += [self.bytes[b] for b in s.encode()]
            else:
                out.append(self.unknown)
        return out

    def _rules(self) -> None:
        """Join rules as sorted arrays: key left * n + right, the joined piece and its cost. Characters that are no
        piece get numbers after the pieces and join with nothing."""
        import numpy as np

        n, ids = len(self.pieces), self.ids
        found = [(ids[a] * n + ids[b], i, self.cost[p]) for p, i in ids.items() for c in range(1, len(p)) if (a := p[:c]) in ids and (b := p[c:]) in ids]
        key, joined, cost = (np.array(x, t) for x, t in zip(zip(*found, strict=True), (np.int64, np.int32, np.float32), strict=True))
        at = np.argsort(key)
        self.key, self.joined, self.joined_cost = key[at], joined[at], cost[at]
        #: The number of each character: its piece, or -1.
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i

    def _pairs(self, left, right):
        """(joined piece, cost) of pairs of symbols, cost infinite where they do not join."""
        import numpy as np

        n = len(self.pieces)
        key = np.where((left < n) & (right < n) & (left >= 0) & (right >= 0), left.astype(np.int64) * n + right, -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return self.joined[at], np.where(hit, self.joined_cost[at], np.float32(np.inf))

    def merge_many(self, parts: Sequence[str]) -> list[bytes]:
        """Packed ids of many short parts: their agendas run side by side, a row of pair costs each. Every round
        takes the best pair of each row (leftmost among equals), joins it and renews its two neighbours. A symbol
        keeps the place of its first character, so a round touches three places of a row, not the whole row."""
        import numpy as np

        n, chars = len(self.pieces), {}
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        every = np.flatnonzero(np.bincount(codes))
        ids = self.char[every]
        other = np.flatnonzero(ids < 0)
        ids[other] = n + np.arange(len(other))
        chars = dict(zip(map(chr, every[other].tolist()), ids[other].tolist(), strict=True))
        place = np.zeros(int(every[-1]) + 1, np.int32)
        place[every] = np.arange(len(every))
        width = np.fromiter(map(len, parts), np.int64, len(parts))
        size = int(width.max()) + 1  # the last place of each row stays empty
        inside = np.arange(size) < width[:, None]
        at = np.full(inside.shape, len(every), np.int32)
        at[inside] = place[codes]
        ids = np.append(ids, np.int32(-1))
        grid = ids[at]
        if len(ids) ** 2 < grid.size:  # few characters: each pair of them is looked up once
            found = (x[at[:, :-1], at[:, 1:]] for x in self._pairs(*np.broadcast_arrays(ids[:, None], ids)))
        else:
            found = self._pairs(grid[:, :-1], grid[:, 1:])
        to, cost = (np.empty(grid.shape, t) for t in (np.int32, np.float32))
        to[:, :-1], cost[:, :-1] = found
        cost[:, -1] = np.inf
        costs, sym, to, cost = cost, grid.ravel(), to.ravel(), cost.ravel()
        after, before = np.arange(1, len(sym) + 1), np.arange(-1, len(sym) - 1)
        before[::size] += size  # nothing stands before the first place: the empty one
        live = np.arange(len(parts))
        while len(live):
            best = live * size + costs[live].argmin(1)
            more = cost[best] < np.inf
            live, best = live[more], best[more]
            right = after[best]
            new, far, near = to[best], after[right], before[best]
            sym[best], sym[right], cost[right] = new, -1, np.inf
            after[best], before[far] = far, best
            both = np.concatenate([near, best])
            to[both], cost[both] = self._pairs(np.concatenate([sym[near], new]), np.concatenate([new, sym[far]]))
        # characters that are no piece leave as bytes
        names = {v: np.array([self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown], np.int32).tobytes() for c, v in chars.items()}
        stay = grid != -1
        ends = np.cumsum(stay.sum(1)) * 4
        buf, ends = grid[stay].tobytes(), ends.tolist()
        packed = [buf[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.flatnonzero((grid >= n).any(1)).tolist():
            packed[i] = b"".join(names.get(x) or np.int32(x).tobytes() for x in grid[i][stay[i]].tolist())
        return packed

    def learn(self, parts: set[str]) -> None:
        """Put parts that the table lacks into it."""
        import numpy as np

        self.table[""] = b""
        new = parts.difference(self.table)
        if len(self.table) + len(new) > KEPT:
            self.table = {"": b""}
            new = parts.difference(self.table)
        long, short = list(new), []
        if not (self.symbol or self.unused):
            long, some = [p for p in new if len(p) > KEPT_CHARS], [p for p in new if len(p) <= KEPT_CHARS]
            width = np.fromiter(map(len, some), np.uint16, len(some))
            short = [some[i] for i in np.argsort(width, kind="stable").tolist()]
        for a in range(0, len(short), 4096):
            some = short[a : a + 4096]
            self.table.update(zip(some, self.merge_many(some), strict=True))
        for p in long:
            self.table[p] = np.array(self.merge(p), np.int32).tobytes()

    def split(self, text: str) -> list[str]:
        """The parts of a whole text, normalised. Without marks in a row every mark begins a part and every line break is
        one, so that a plain split finds them; it may give empty parts, which have no ids."""
        if self.plain and self.free and text and text[0] != " " and "  " not in text and MARK not in text:
            return (MARK + text.replace(" ", " " + MARK).replace("\n", " \n ")).split(" ")
        norm = (MARK + text.replace(" ", MARK) if text else "") if self.plain else self.sp.normalize(text)
        return self.parts.findall(norm)

    def encode(self, texts: Sequence[str]) -> list:
        """Ids of whole texts, a numpy array each."""
        import numpy as np

        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        get = self.table.__getitem__
        out = [np.frombuffer(b"".join(map(get, parts)), np.int32) for parts in split]
        if self.bytes:
            return out
        return [x[~((x == self.unknown) & (np.r_[-1, x[:-1]] == self.unknown))] if len(x) else x for x in out]  # unknown symbols in a row are one


@lru_cache(maxsize=1)
def encoder(model: bytes) -> PieceBPE:
    """The encoder of a model, made once in a Python worker: its tasks share it and its table of parts."""
    return PieceBPE(model)


def slices(texts: Sequence[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` characters; a longer text is a run of its own."""
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def round_trip(docs: DataFrame, model: bytes, text: str = "text", keep: Sequence[str] = ("doc_id",), check: bool = True) -> DataFrame:
    """The ``keep`` columns, ids (array of int, no begin or end ids), decoded (the library's decode of them) and
    agrees: whether the library encodes the text to the same ids (null without ``check``)."""
    keep = list(keep)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()), T.StructField("agrees", T.BooleanType())])

    def run(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bpe = encoder(model)
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            for a, b in slices(texts):
                ids = bpe.encode(texts[a:b])
                flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                agrees = [x.tobytes() == y.tobytes() for x, y in zip(ids, bpe.sp.encode(texts[a:b], num_threads=1, return_type="numpy"), strict=True)] if check else [None] * (b - a)
                out = [pa.ListArray.from_arrays(pa.array(ends), flat), pa.array([bpe.sp.decode(x) for x in ids], pa.string()), pa.array(agrees, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keep), *out], names=[*keep, "ids", "decoded", "agrees"])

    return rows.mapInArrow(run, schema)


def digest(trips: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agrees) of ``round_trip``'s rows."""
    return trips.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


def token_ids(model: bytes, texts: Iterable[str]) -> list[list[int]]:
    """Ids of a few texts, outside Spark."""
    return [x.tolist() for x in PieceBPE(model).encode(list(texts))]
