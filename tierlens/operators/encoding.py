"""T3-T5 for columns with any number of categories: a dictionary of ordinals as a table, applied by joins.

* ``value_counts``: each column is read and counted on its own, so no row is multiplied.
* ``fit_dictionary``: (column_name, category, ordinal, n). Ordinals follow the categories' order. Range partitions of
  the counted categories are ranked side by side; what the partitions before hold is added. Neither the driver nor one
  task sees a column's categories.
* ``encode``: the ordinals of a table's rows. A category that holds more than 1 / HOT of the fitted rows is looked up in
  a broadcast of fewer than HOT rows, so frequent values meet no shuffle by value; all others by a shuffle join.
* ``slots`` and ``one_hot_vectors``: the one-hot form as the places of its ones, and as sparse ML vectors. The driver
  reads one number for each column.

Defined results: null values are no category; a null, or with ``fill`` a value that is still null, and an unseen value
have a null ordinal, no slot and an all-zero vector; an empty table or an all-null column gives an empty dictionary;
repeated rows count as often as they stand; other columns of any name are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

HOT = 1_000
SPREAD = 4_096


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n) of the non-null values of each column, as text."""
    out = None
    for c in cols:
        one = df.select(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")).where("value IS NOT NULL") \
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionAll(one)
    return out


def fit_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, category, ordinal, n), ordinals from 0 in the byte order of the categories."""
    counts = value_counts(df, cols).repartitionByRange("column_name", "value").withColumn("part", F.spark_partition_id())
    t = cut_lineage(counts, "categories")
    sizes = t.groupBy("column_name", "part").agg(F.count(F.lit(1)).alias("here"))
    upto = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("column_name", "part", F.coalesce(F.sum("here").over(upto), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("column_name", "part").orderBy("value"))
    # as many rows as there are columns and partitions
    ranked = t.withColumn("inside", inside).join(F.broadcast(before), ["column_name", "part"])
    return cut_lineage(ranked.select("column_name", F.col("value").alias("category"), (F.col("before") + F.col("inside") - 1).alias("ordinal"), "n"), "dictionary")


def column_sizes(dictionary: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, int, str | None]]:
    """Categories, counted rows and mode (ties: the smallest) of each column."""
    got = dictionary.groupBy("column_name").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("rows"),
                                                F.min_by("category", F.struct(-F.col("n"), "category")).alias("mode")).collect()
    found = {r["column_name"]: (r["size"], r["rows"], r["mode"]) for r in got}
    return {c: found.get(c, (0, 0, None)) for c in cols}


def _free(taken: Sequence[str], name: str) -> str:
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name += "_"
    return name


def encode(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], fill: bool = False, suffix: str = "__ord") -> DataFrame:
    """Add each column's ordinal as ``<column><suffix>``; ``fill`` gives missing values the column's mode."""
    sizes, keep = column_sizes(dictionary, cols), list(df.columns)
    for c in cols:
        _, rows, mode = sizes[c]
        value, near, key, far = (_free([*df.columns, *(f"{k}{suffix}" for k in cols)], f"__{n}") for n in ("value", "near", "key", "far"))
        text = F.col(f"`{c}`").cast("string")
        df = df.withColumn(value, F.coalesce(text, F.lit(mode)) if fill else text)
        own = dictionary.where(F.col("column_name") == c)
        frequent = F.col("n") * HOT > rows
        hot = own.where(frequent).select(F.col("category").alias(value), F.col("ordinal").alias(near))
        cold = own.where(~frequent).select(F.concat(F.lit("="), "category").alias(key), F.col("ordinal").alias(far))
        df = df.join(F.broadcast(hot), value, "left")  # fewer than HOT rows
        # rows that are done, or have no value, spread evenly and meet nothing
        done = F.concat(F.lit("#"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))
        df = df.withColumn(key, F.when(F.col(near).isNull() & F.col(value).isNotNull(), F.concat(F.lit("="), F.col(value))).otherwise(done))
        df = df.join(cold, key, "left").withColumn(f"{c}{suffix}", F.coalesce(near, far)).drop(value, near, key, far)
    return df.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{c}{suffix}`") for c in cols])


def slots(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], fill: bool = False, out: str = "slots") -> DataFrame:
    """Add the places of a row's ones in the one-hot encoding of all columns side by side, ascending."""
    sizes, start, places = column_sizes(dictionary, cols), 0, []
    for c in cols:
        places.append(F.col(f"`{c}__ord`") + F.lit(start).cast("long"))
        start += sizes[c][0]
    d = encode(df, dictionary, cols, fill)
    return d.withColumn(out, F.array_compact(F.array(*places))).drop(*[f"{c}__ord" for c in cols])


def one_hot_vectors(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], fill: bool = False, suffix: str = "__ohe") -> DataFrame:
    """Add each column's one-hot encoding as a sparse vector of as many places as it has categories."""
    sizes = column_sizes(dictionary, cols)
    inputs = [f"{c}__ord" for c in cols]
    d = encode(df, dictionary, cols, fill).withColumns({i: F.coalesce(F.col(f"`{i}`"), F.lit(max(sizes[c][0], 1))).cast("double") for i, c in zip(inputs, cols, strict=True)})
    # the place after the last category stands for none and is dropped
    ends = df.sparkSession.createDataFrame([tuple(float(max(sizes[c][0], 1)) for c in cols)], ", ".join(f"`{i}` double" for i in inputs))
    encoder = OneHotEncoder(inputCols=inputs, outputCols=[f"{c}{suffix}" for c in cols], dropLast=True, handleInvalid="error")
    return encoder.fit(ends).transform(d).drop(*inputs)
