"""T3-T5 without a category cap: ordinals, slots and sparse vectors against plain Python."""

from pyspark.sql import functions as F

from tierlens.operators import encoding as en
from tierlens.operators import ml


def test_dictionary_is_ordered_and_counted(spark):
    rows = [(i, None if i % 7 == 0 else f"c{(i * 37) % 501}", "x" if i % 3 else "é") for i in range(4000)]
    d = spark.createDataFrame(rows, "id long, a string, `b.c` string").repartition(5)
    got = {(r["column_name"], r["category"]): (r["ordinal"], r["n"]) for r in en.fit_dictionary(d, ["a", "b.c"]).collect()}
    for name, j in (("a", 1), ("b.c", 2)):
        values = [r[j] for r in rows if r[j] is not None]
        for i, v in enumerate(sorted(set(values), key=lambda s: s.encode())):
            assert got.pop((name, v)) == (i, values.count(v))
    assert not got


def test_unseen_missing_hot_and_clashing_names(spark):
    train = spark.createDataFrame([("hot",)] * 3000 + [(f"v{i}",) for i in range(2500)] + [(None,)], "v string")
    dictionary = en.fit_dictionary(train, ["v"])
    rows = [(1, "hot", 5), (2, "v7", 6), (3, None, 7), (4, "never", 8), (2, "v7", 6), (5, "", 9)]
    test = spark.createDataFrame(rows, "id int, v string, __value int").withColumns({n: F.lit(0) for n in ("near", "__near", "__key", "__far", "n", "category", "ordinal")})
    order = sorted(["hot"] + [f"v{i}" for i in range(2500)])
    place = {v: i for i, v in enumerate(order)}
    out = en.encode(test, dictionary, ["v"])
    assert out.columns == [*test.columns, "v__ord"]
    assert sorted((r["id"], r["v__ord"], r["__value"]) for r in out.collect() if r["v__ord"] is not None) == [(1, place["hot"], 5), (2, place["v7"], 6), (2, place["v7"], 6)]
    assert out.count() == 6
    filled = {r["id"]: r["slots"] for r in en.slots(test, dictionary, ["v"], fill=True).collect()}
    assert filled[3] == [place["hot"]] and filled[4] == [] and filled[5] == []
    vec = {r["id"]: r["v__ohe"] for r in en.one_hot_vectors(test, dictionary, ["v"]).collect()}
    assert all(v.size == 2501 for v in vec.values())
    assert vec[1].indices.tolist() == [place["hot"]] and vec[3].numNonzeros() == vec[4].numNonzeros() == 0


def test_frequent_values_meet_no_shuffle_by_value(spark):
    """Only rows with a rare value keep it as their join key."""
    d = spark.createDataFrame([("hot",)] * 5000 + [(f"v{i}",) for i in range(50)], "v string")
    dictionary = en.fit_dictionary(d, ["v"])
    sizes = en.column_sizes(dictionary, ["v"])["v"]
    assert sizes == (51, 5050, "hot")
    assert dictionary.where(F.col("n") * en.HOT > sizes[1]).count() == 1
    plan = en.encode(d, dictionary, ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan and "CartesianProduct" not in plan


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "v string")
    dictionary = en.fit_dictionary(empty, ["v"])
    assert dictionary.count() == 0
    d = spark.createDataFrame([(None,), ("a",)], "v string")
    assert [r["v__ord"] for r in en.encode(d, dictionary, ["v"], fill=True).collect()] == [None, None]
    assert [r["slots"] for r in en.slots(d, dictionary, ["v"]).collect()] == [[], []]
    assert all(r["v__ohe"].numNonzeros() == 0 for r in en.one_hot_vectors(d, dictionary, ["v"]).collect())


def test_modes_count_each_column_once(spark):
    d = spark.createDataFrame([("b", 1), ("a", 1), ("a", 2), ("b", None), (None, 2)], "s string, k int")
    got = {r["column_name"]: (r["mode"], r["mode_count"]) for r in ml.fit_modes(d, ["s", "k"]).collect()}
    assert got == {"s": ("a", 2), "k": ("1", 2)}
    assert "Generate" not in ml.fit_modes(d, ["s", "k"])._jdf.queryExecution().optimizedPlan().toString()
