"""Operators 11, 12 and 13 against the libraries and brute force, with nulls, empty and long texts, ties, repeated
rows, empty tables and clashing columns."""

import hashlib
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierlens.llm import alignment, manifest, piece_bpe

# every helper column of the operators stands here as an extra column
DOC = "doc_id long, text string, lang string, source string, n_chars long, ids string, decoded string, agrees string, block string, place string, a string, b string, g string, p string, h string, v string, __id string, __text string"
PIECE, BYTE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def frame(spark, rows):
    """Rows (doc_id, text, source) with clashing extra columns."""
    return spark.createDataFrame([(d, t, "en" if i % 5 else None, s, len(t or ""), *["clash"] * 13) for i, (d, t, s) in enumerate(rows)], DOC)


def texts():
    rng = random.Random(7)
    chars = list("ab \n\t\r\x00\x1c\xa0▁é中😀<s>|,;0x</> the") + ["\r\n", "  ", "<0x0A>", "<|endoftext|>", " the", "’s", "'s"]
    out = ["".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(150)]
    words = ["the", "of", "Straße", "naïve,", "x=1;", "word", "don't", "日本語", "\n", "\n\n  pad", "end.\t"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(60)]
    return [None, "", " ", "   ", "\n", "▁", "a ▁ b", "a" * 20_000, "wordy " * 30_000, *out, out[3], out[3]]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_sentencepiece_ids_equal_the_librarys(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    every = texts()
    rows = [(None if i == 11 else i // 2, t, "s") for i, t in enumerate(every)]  # null and repeated ids
    with open(PIECE, "rb") as f:
        trips = piece_bpe.round_trip(frame(spark, rows), f.read())
    got = trips.collect()
    assert trips.columns == ["doc_id", "ids", "decoded", "agrees"] and all(r["agrees"] for r in got)
    want = Counter((d, tuple(sp.encode(t or "")), sp.decode(sp.encode(t or ""))) for d, t, _ in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got) == want
    d = piece_bpe.digest(trips).filter("doc_id = 0").collect()
    assert {(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in d} == {(0, sha(""), sha(""))}


def test_sentencepiece_heap_and_rows_agree(monkeypatch):
    with open(PIECE, "rb") as f:
        bpe = piece_bpe.PieceBPE(f.read())
    every = [t for t in texts() if t]
    for chars, kept in ((64, 600_000), (3, 50)):  # most parts on the heap, and a table that is emptied often
        monkeypatch.setattr(piece_bpe, "KEPT_CHARS", chars)
        monkeypatch.setattr(piece_bpe, "KEPT", kept)
        bpe.table = {}
        assert [x.tolist() for x in bpe.encode(every)] == bpe.sp.encode(every)


def test_sentencepiece_finds_parts_without_the_pattern(monkeypatch):
    """Texts without spaces in a row are split plainly, and ids stay the library's."""
    with open(PIECE, "rb") as f:
        bpe = piece_bpe.PieceBPE(f.read())
    every = [t for t in texts() if t]
    plain = [t for t in every if "  " not in t and piece_bpe.MARK not in t and t[0] != " "]
    want = [bpe.parts.findall(piece_bpe.MARK + t.replace(" ", piece_bpe.MARK)) for t in plain]
    monkeypatch.setattr(bpe, "parts", None)
    assert len(plain) > 20 and [[p for p in bpe.split(t) if p] for t in plain] == want
    assert [x.tolist() for x in bpe.encode(plain)] == bpe.sp.encode(plain)


def test_sentencepiece_tasks_share_an_encoder_whose_rows_agree_with_the_heap(spark):
    """A worker reads a model once; rows of all lengths, with ties and characters that are no piece, join as on a heap;
    the library's ids are compared whole."""
    with open(PIECE, "rb") as f:
        model = f.read()
    bpe = piece_bpe.encoder(model)
    assert piece_bpe.encoder(bytes(bytearray(model))) is bpe
    rng = random.Random(11)
    for chars, most in (("▁thearion", 64), ("a", 64), ("▁aé中😀\x00\x1c9x", 9), ("▁theariondsb" + "".join(map(chr, range(0x4E00, 0x4F00))), 5)):
        parts = ["".join(rng.choice(chars) for _ in range(rng.randrange(1, most + 1))) for _ in range(300)]
        assert [np.frombuffer(x, np.int32).tolist() for x in bpe.merge_many(parts)] == [bpe.merge(p) for p in parts]
    rows = spark.createDataFrame([(1, "the text"), (2, "the text\n"), (3, None)], "doc_id long, text string")
    assert Counter((r["doc_id"], r["agrees"]) for r in piece_bpe.round_trip(rows, model).collect()) == {(1, True): 1, (2, True): 1, (3, True): 1}
    assert [r["agrees"] for r in piece_bpe.round_trip(rows, model, check=False).collect()] == [None] * 3


def test_sentencepiece_refuses_other_models_and_takes_empty_tables(spark):
    with pytest.raises(ValueError):
        piece_bpe.PieceBPE(b"\x12\x02\x18\x01")  # a trainer spec of type 1, unigram
    with open(PIECE, "rb") as f:
        assert piece_bpe.digest(piece_bpe.round_trip(frame(spark, []), f.read())).collect() == []


def brute_alignment(rows):
    tk = Tokenizer.from_file(BYTE)
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    char = alignment.byte_of_char()
    of_a = {i: bytes(char[c] for c in t) for t, i in tk.get_vocab(False).items()}

    def of_b(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    links, heads = [], []
    for _, t, _ in rows:
        raw = (" " + (t or "")).encode()
        a = tk.encode(raw.decode(), add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        own_a, own_b = [], []  # the token over each byte
        for n, i in enumerate(a):
            own_a += [n] * len(of_a[i])
        for n, i in enumerate(b):
            own_b += [n] * len(of_b(i))
        if not t or b"".join(of_a[i] for i in a) != raw or b"".join(map(of_b, b)) != raw:
            links.append([])
            heads.append((0, 0, 0, ""))
            continue
        pairs = list(dict.fromkeys(zip(own_a, own_b, strict=True)))
        links.append([(a[x], b[y]) for x, y in pairs])
        cuts = [k + 1 for k in range(len(raw)) if k + 1 == len(raw) or own_a[k] != own_a[k + 1] and own_b[k] != own_b[k + 1]]
        said, last = [], 0
        for c in cuts:
            said.append(",".join(str(a[n]) for n in dict.fromkeys(own_a[last:c])) + "|" + ",".join(str(b[n]) for n in dict.fromkeys(own_b[last:c])))
            last = c
        heads.append((len(a), len(b), len(said), sha(";".join(said))))
    docs, total = Counter(p for x in links for p in set(x)), Counter(p for x in links for p in x)
    best = defaultdict(int)
    for (a, _), c in docs.items():
        best[a] = max(best[a], c)
    out = Counter((d, *h[:3], len(x), sum(docs[p] == best[p[0]] for p in x), sum(docs[p] for p in x), h[3]) for (d, _, _), h, x in zip(rows, heads, links, strict=True))
    return out, {(a, b, c, total[a, b], c == best[a]) for (a, b), c in docs.items()}


@pytest.mark.parametrize("entries,kept,slice_chars", [(4_000_000, 400_000, 2_000_000), (300, 40, 500)])
def test_alignment_matches_brute_force(spark, monkeypatch, entries, kept, slice_chars):
    """Also with blocks, part tables and slices so small that all of them are closed and emptied many times."""
    monkeypatch.setattr(alignment, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(alignment, "KEPT", kept)
    monkeypatch.setattr(piece_bpe, "SLICE_CHARS", slice_chars)
    every = [t[:4000] if t else t for t in texts()]
    rows = [(None if i == 11 else i // 2, t, "s") for i, t in enumerate(every)]
    with open(BYTE) as f, open(PIECE, "rb") as g:
        scored, pairs = alignment.align(frame(spark, rows).repartition(3), f.read(), g.read())
    docs, want = brute_alignment(rows)
    assert Counter(tuple(r) for r in scored.collect()) == docs
    assert {(r["a"], r["b"], r["docs"], r["links"], r["best"]) for r in pairs.collect()} == want


def test_alignment_of_an_empty_table(spark):
    with open(BYTE) as f, open(PIECE, "rb") as g:
        scored, pairs = alignment.align(frame(spark, []), f.read(), g.read())
    assert scored.collect() == [] and pairs.collect() == []


def test_bitmaps_hold_their_sets():
    import numpy as np

    codes, places = np.array([5] * 90 + [9, 9]), np.r_[np.arange(90), 3, 99]
    code, dense, sets = alignment.bitmaps(codes, places, 100)
    assert code.tolist() == [5, 9] and dense.tolist() == [True, False]
    assert np.flatnonzero(np.unpackbits(np.frombuffer(sets[0].as_py(), np.uint8), bitorder="little")).tolist() == list(range(90))
    assert np.frombuffer(sets[1].as_py(), "<u2").tolist() == [3, 99]


def brute_manifest(rows):
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def up(nodes):
        return [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append(up(levels[-1]))
        return levels

    def walk(levels, i, h):
        proof = ""
        for low in levels[:-1]:
            a = i - i % 3
            run = low[a : a + 3]
            proof += "".join(x for k, x in enumerate(run) if k != i - a)
            h, i = sha("".join(h if k == i - a else x for k, x in enumerate(run))), i // 3
        return proof, h

    by = defaultdict(list)
    for d, t, s, lang, n in rows:
        leaf = sha("".join(map(one, (d, s, lang, n, t))))
        hit = d is not None and crc32(str(d).encode()) % 2 == 0
        changed = sha("".join(map(one, (d, s, lang, n, t.replace("\n", "") if hit and t is not None else t))))
        by[s].append((d is not None, d or 0, leaf, changed, d))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = Counter()
    for k, s in enumerate(order):
        for i, (_, _, leaf, changed, d) in enumerate(sorted(by[s])):
            low, h = walk(trees[s], i, changed)
            high, folded = walk(top, k, h)
            root = top[-1][0]
            out[d, leaf, trees[s][-1][0], root, sha(low + high), folded, folded == root] += 1
    return out


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_manifest_matches_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    rng = random.Random(levels)
    sources = [None, "", "a", "ab", "é", "z", "hot"]
    rows = [(None if i % 29 == 0 else rng.randrange(-40, 150), rng.choice([None, "", "x", "a\nb\n", "línea\n"]), "hot" if i % 3 else rng.choice(sources)) for i in range(260)]
    rows += [rows[5], rows[5], (1, "long\n" * 20_000, "single")]
    docs = frame(spark, rows)
    full = [(r["doc_id"], r["text"], r["source"], r["lang"], r["n_chars"]) for r in docs.collect()]
    assert Counter(tuple(r) for r in manifest.verify(docs).collect()) == brute_manifest(full)


def test_manifest_of_no_row_and_of_one(spark):
    assert manifest.verify(frame(spark, [])).collect() == []
    docs = frame(spark, [(3, "only", None)])
    assert Counter(tuple(r) for r in manifest.verify(docs).collect()) == brute_manifest([(3, "only", None, None, 4)])


def test_versions_copy_ancestors_only(spark):
    """A version's copies are as many as the tree has levels above the leaf; its last copy is its root."""
    docs = frame(spark, [(i, f"t{i}", "s") for i in range(30)]).withColumn("new", F.sha2(F.concat(F.lit("n"), "text"), 256))
    tree = manifest.build(docs, F.col("source"), [F.col("doc_id")], F.sha2("text", 256), F.when(F.col("doc_id") == 4, F.col("new")), ["doc_id"])
    got = {r["doc_id"]: r for r in manifest.versions(tree).collect()}
    assert all(len(r["copies"]) == 4 for r in got.values())
    assert all((r["copies"][-1] == r["root"]) == (d != 4) for d, r in got.items())
    assert tree.root.first()["root"] == got[0]["root"]
