"""Corpus operators in free style: brute force, held-out accuracy, replayed batches, and the pipeline."""

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierlens.llm import html_text, near_dedup, quality, token_counts, toxicity
from tierlens.session import stage_path

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long, comp string, sig string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash", "clash") for i, t in enumerate(texts)], DOC)


def near_texts(seed=1, groups=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    passage = [rng.choice(vocab) for _ in range(40)]
    out = [None, "", " \n", "one two", "ONE two", "one"]
    for g in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.randrange(20, 120))]
        for _ in range(rng.randrange(1, 9)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(" ".join(w + passage if g % 3 == 0 else w))
    return out


def brute_components(texts):
    sets = []
    for t in texts:
        w = near_dedup.py_space_words(t)
        n = min(4, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    return [len(s) for s in sets], comp


def test_near_dedup_makes_sets_of_promising_documents_alone(spark, monkeypatch):
    """Documents that meet by a shared passage but are not alike by their sketches get no full set."""
    made, cut = {}, near_dedup.cut
    monkeypatch.setattr(near_dedup, "cut", lambda df, name: made.update({name: cut(df, name)}) or made[name])
    monkeypatch.setattr(near_dedup, "drop_tables", lambda *frames: None)
    passage = [f"p{j}" for j in range(60)]
    texts = [" ".join(passage + [f"d{i}w{j}" for j in range(60)]) for i in range(30)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.link(frame(spark, [*texts, texts[7] + " end"])).collect()}
    assert got == {i: 7 if i == 30 else i for i in range(31)}
    assert made["live"].select("id").distinct().count() > 20 and {r["id"] for r in made["sets"].collect()} == {7, 30}


@pytest.mark.parametrize("small", [1024, 4])
def test_near_dedup_matches_brute_force(spark, monkeypatch, small):
    """With nodes of four the tree branches, and blocks and leaders are used."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "DEPTH", 24 if small > 4 else 2)
    texts = near_texts(groups=12 if small > 4 else 5)
    docs = frame(spark, texts)
    n, comp = brute_components(texts)
    got = {r["doc_id"]: r for r in near_dedup.link(docs).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == n
    assert [got[i]["component_id"] for i in range(len(texts))] == comp
    assert all(got[i]["kept"] == (comp[i] == i) for i in got)
    if small > 4:
        kept = near_dedup.keep_one(docs)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(comp))
        assert near_dedup.link(docs.limit(0)).count() == 0


def test_toxicity_weights_join_alike_at_any_size(spark):
    """Few rows take the plan of many, so that shuffles grow in proportion to the documents."""
    rows = spark.createDataFrame([(f"a b c d e{i % 3}", i % 2) for i in range(20)], "text string, toxic int")
    plan = toxicity.weighted(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "merge" in plan.split("Join LeftOuter", 1)[1].splitlines()[0]


def test_alike_but_unlinked_texts_give_no_row_a_pair(spark, monkeypatch):
    """A group whose pairs all pass the estimate and none of which is linked: no table grows with its square."""
    made, m, cut = [], 150, near_dedup.cut
    monkeypatch.setattr(near_dedup, "cut", lambda df, name: made.append(cut(df, name)) or made[-1])
    monkeypatch.setattr(near_dedup, "drop_tables", lambda *frames: None)
    texts = [" ".join([*(f"w{i}" for i in range(203)), *(f"x{d}y{i}" for i in range(35))]) for d in range(m)]
    got = near_dedup.link(frame(spark, [*texts, texts[0] + " end"])).collect()
    assert sorted(r["component_id"] for r in got) == [0, *range(m)]
    assert max(t.count() for t in made) <= near_dedup.TREES * (m + 1)


def test_keep_one_with_null_and_repeated_ids(spark):
    """One row of every component stays, whatever its ids; the least id first, null ids last."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b), (None, b + " end"), (7, c), (7, d), (7, d), (None, c), (9, c + " end"), (None, None), (None, ""), (5, " "), (5, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows], DOC)
    kept = sorted(((r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs).collect()), key=str)
    worded = [r for r in kept if (r[1] or "").strip()]
    assert sum(t == a for _, t in worded) == 1 and sum(t in (b, b + " end") for _, t in worded) == 1
    assert (7, c) in worded and (7, d) in worded and len(worded) == 4
    assert sorted((r for r in kept if r not in worded), key=str) == sorted([(None, None), (None, ""), (5, " "), (5, " ")], key=str)


def test_components_of_a_long_path(spark):
    n = 60
    got = near_dedup.components(spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 400)], "a long, b long")).collect()
    assert {r["id"]: r["comp"] for r in got} == {**dict.fromkeys(range(n + 1), 0), 500: 400, 400: 400}


def test_segments_are_all_maximal_ones():
    rng = random.Random(3)
    m = toxicity.Model()
    for _ in range(50):
        s = [rng.choice([-2.0, -1.0, -0.5, 1.0, 2.0, 3.0]) for _ in range(30)]

        def split(lo, hi, s=s):  # the definition: the best segment, then both sides of it
            best = max(((sum(s[i:j]), i - j, -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=(0,))
            if best[0] <= 0:
                return []
            return [*split(lo, best[3]), (best[3], best[4]), *split(best[4], hi)]

        import numpy as np

        got = m.segments(np.array(s))
        assert sum(x for *_, x in got) == pytest.approx(sum(sum(s[a:b]) for a, b in split(0, 30)))
        assert max((x for *_, x in got), default=0) == pytest.approx(max((sum(s[a:b]) for a, b in split(0, 30)), default=0))


def test_toxicity_held_out_and_edge_rows(spark):
    rng = random.Random(5)
    vocab = [f"{a}{b}" for a in "bcdfg" for b in "aeiouxyz"]
    texts, labels = [], []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(rng.randrange(20, 80))]
        toxic = i % 5 == 0
        for _ in range(4 if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(["vilest", "rotten", "filthy"])
        texts.append(" ".join(w))
        labels.append((i, 1, int(toxic)))
    texts += [None, "", "1 2 3"]
    docs, y = frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, y)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got.values())
    held = [i for i, r in got.items() if r["held_out"] and i < 400]
    assert held and all(got[i]["predicted"] == int(i % 5 == 0) for i in held)
    assert [got[i]["predicted"] for i in (400, 401, 402)] == [0, 0, 0]
    assert toxicity.passages(docs, model).filter("doc_id % 5 = 0").count() > 0
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in got if not got[i]["predicted"]}
    none = toxicity.fit(docs, y.limit(0))
    assert toxicity.score(docs, none).filter("score > 0.001 or score is null").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_every_training_text_counts(spark):
    """Texts with a passage in common stay, at nearly full weight; near copies weigh about one text together."""
    rng = random.Random(9)
    word = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, text = word(25), word(400)
    carriers = [" ".join(word(50) + passage + word(50)) for _ in range(60)]
    copies = [" ".join([*text[:-1], f"end{i}"]) for i in range(60)]
    rows = [(t, y) for y, part in ((0, carriers), (1, copies)) for t in part] + [(None, 0), ("x", 0), ("x", 0)]
    got = toxicity.weighted(spark.createDataFrame(rows, "text string, toxic int")).collect()
    assert sorted(((r["text"], r["toxic"]) for r in got), key=str) == sorted(rows, key=str)
    assert all(0 < r["weight"] <= toxicity.UNIT for r in got)
    total = lambda texts: sum(r["weight"] for r in got if r["text"] in texts) / toxicity.UNIT
    assert total(carriers) > 40 and total(copies) < 4 and abs(total(["x"]) - 1) < 0.001


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade")))
    assert (model.cuts[1:] > model.cuts[:-1]).all()
    got = quality.score(docs, model).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in got)
    assert right >= 0.9 * len(got)
    odd = quality.score(frame(spark, [None, "", "x"]), model).collect()
    assert len(odd) == 3 and all(0 <= r["expected_grade"] <= 2 for r in odd)
    assert quality.fit(docs, labels.select("doc_id", F.lit(None).cast("int").alias("grade"))) is None
    assert quality.score(docs, None).filter("kept").count() == docs.count()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- x --><div class="ad">Buy &amp; now</div>%s
<aside>Side</aside><form><input value=1>Send</form><div id="comments"><p>Reader says</p></div><footer>&copy; me</footer></body></html>"""


@pytest.fixture
def one_part(spark):
    """All pages in one sorted part; at the edge of a part a page may lack its neighbour."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_html_main_text(spark, one_part):
    article = "<article><h1>Head &amp; tail</h1><p><b>One\n  two<br><p>three&nbsp;x</article>"
    plain = "<div>Shared menu line</div><div>%s</div><div>Shared end line</div>"
    rows = [(0, "https://h.example/a/1", PAGE % article), (1, "https://h.example/a/1?x=2", PAGE % article), (2, None, None), (3, "", ""), (4, "::", "plain &lt;text&gt;")]
    rows += [(10 + i, f"https://k.example/p/{i}.html", PAGE % (plain % f"Own text {i}")) for i in range(4)]
    got = {r["page_id"]: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[0]["text"] == got[1]["text"] == "Head & tail One two three x"
    assert got[2]["text"] == got[3]["text"] == "" and got[4]["text"] == "plain <text>" and got[2]["url"] is None
    both = [got[10 + i]["text"] for i in range(4)]
    assert all(f"Own text {i}" in t for i, t in enumerate(both)) and sum("Shared" in t for t in both) <= 2
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_shared_lines_inside_articles(spark):
    article = "<article><p>Sign up for our letter</p><h1>Head %s</h1><p>Long own text of page %s, and more of it</p><p>Read more</p></article>"
    rows = [(i, f"https://m.example/p/{i}.html", PAGE % (article % (i, i))) for i in range(4)]
    rows += [(4, "https://n.example/p/4", PAGE % (article % (4, 4))), (5, "https://n.example/p/4?again", PAGE % (article % (4, 4))), (6, "https://o.example/p", PAGE % (article % (6, 6)))]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    own = "Head {0} Long own text of page {0}, and more of it"
    assert [got[i] for i in range(4)] == [own.format(i) for i in range(4)]
    assert [got[i] for i in (4, 5, 6)] == [f"Sign up for our letter {own.format(i)} Read more" for i in (4, 4, 6)]


def test_html_does_not_depend_on_the_parts(spark):
    plain = "<div>Shared menu line</div><div>%s</div><div>Shared end line</div>"
    rows = [(i if i else None, f"https://k.example/p/{i:03}.html", PAGE % (plain % f"Own text {i}")) for i in range(40)]
    rows += [(100, "https://l.example/a", PAGE % "<p>Alone</p>"), (40, "https://k.example/p/039.html", rows[-1][2]), (7, rows[7][1], rows[7][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = {}
        for n in (1, 7, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got[n] = sorted((r["page_id"] or 0, r["url"], r["text"]) for r in html_text.extract(pages).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got[1]) == len(rows) and got[1] == got[7] == got[64]
    assert all(t == f"Own text {i}" for i, u, t in got[64] if i < 39 and i != 7 and "k.example" in u)


def test_shared_lines_are_a_longest_common_subsequence():
    assert html_text.shared(list("abcbdab"), list("bdcaba")) and len(html_text.shared(list("abcbdab"), list("bdcaba"))) == 4
    many = [f"l{i}" for i in range(3000)]
    assert html_text.shared(many, ["new", *many[:2000], "x", *many[2500:]]) == {*range(2000), *range(2500, 3000)}


def test_shared_lines_that_repeat_on_long_pages():
    rng = random.Random(8)
    for _ in range(40):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(25))] for _ in "ab")
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = html_text.shared(a, b)
        rest = iter(b)
        assert len(got) == best[-1][-1] and all(a[i] in rest for i in sorted(got))
    page = lambda p: [x for i in range(1500) for x in (f"{p}{i}", "Reply")]
    menu = ["Menu", "Reply"] * 800
    assert len(html_text.shared(menu + page("own"), menu + page("other"))) == 3100


def test_rollup_replays_and_failures(spark):
    docs = frame(spark, ["a b", None, "", "a b c"]).withColumn("new", F.lit("z"))
    roll = token_counts.Rollup(spark, stage_path(spark, f"tables/test-{uuid.uuid4().hex}"))
    assert roll.totals().count() == 0
    assert roll.commit("1", token_counts.signed(docs, 1)) and not roll.commit("1", token_counts.signed(docs, 1))
    total = lambda: {r["tokenizer"]: (r["docs"], r["tokens"]) for r in roll.totals().collect()}
    assert total() == {"words-v1": (4, 5), "bytes4-v1": (4, 3)}
    with pytest.raises(Exception):  # noqa: B017  an attempt that fails leaves no trace in the totals
        roll.commit("2", token_counts.signed(docs, 1).withColumn("tokens", F.raise_error(F.lit("lost")).cast("long")))
    assert total() == {"words-v1": (4, 5), "bytes4-v1": (4, 3)}
    roll.commit("2", token_counts.signed(docs.filter("doc_id = 3"), -1))
    roll.commit("3", token_counts.revised(docs.filter("doc_id = 0"), "text", "new"))
    assert total() == {"words-v1": (3, 1), "bytes4-v1": (3, 1)}
    again = token_counts.Rollup(spark, roll.path)
    assert {r["tokenizer"]: r["tokens"] for r in again.totals().collect()} == {"words-v1": 1, "bytes4-v1": 1}


def test_pipeline_keeps_what_each_stage_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = corpus_pipeline.run(spark, SF)
    assert mixed.columns == [*docs.columns, "source_size", "target", "taken", "finish"]
    rows = mixed.collect()
    ids = [r["doc_id"] for r in rows]
    assert len(set(ids)) == len(ids) and all(0 < r["taken"] for r in rows)
    assert not any(re.search(r"password=[0-9a-f]{16}|AKIA[0-9A-Z]{16}", r["text"]) for r in rows)
    _, comp = brute_components([r["text"] for r in rows])
    assert comp == list(range(len(rows)))
