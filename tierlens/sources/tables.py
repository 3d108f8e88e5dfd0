"""Scans and sinks.

Parquet is the scale format: splittable, column-pruned and filter-pushed.
The raw CSV reader exists for parity with the reference's input format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import NA_TOKENS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read one driver table; selecting columns here lets the scan prune."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_raw_csv(spark: SparkSession, path: str, header_names: Sequence[str] | None = None,
                 min_rows: int = 10, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Read a raw indicator CSV as all-string columns.

    Quoted fields and a header that contains a newline need ``multiLine``;
    that makes each file one split, so at scale the input should be many
    files (or Parquet). Pandas' default missing tokens become NULL. Raises
    if the path does not exist; warns (returns anyway) below ``min_rows``.
    """
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.globStatus(jvm_path):  # a file, a folder or a glob of them
        raise FileNotFoundError(path)
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("escape", '"').option("quote", '"'))
    if header_names is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in header_names]))
    else:
        reader = reader.option("inferSchema", False)
    df = reader.csv(path)
    tokens = list(na_tokens)
    df = df.select(*[F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string"))
                     .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])
    if df.limit(min_rows).count() < min_rows:
        import warnings
        warnings.warn(f"{path}: fewer than {min_rows} rows")
    return df


RAW_NAME = "raw_name"


def parquet_names(df: DataFrame) -> DataFrame:
    """Columns as column_0, column_1, ..., each with its raw name in its metadata: raw headers hold characters that
    a table's column names may not."""
    return df.select(*[F.col(f"`{c}`").alias(f"column_{i}", metadata={RAW_NAME: c}) for i, c in enumerate(df.columns)])


def original_names(df: DataFrame) -> DataFrame:
    """The raw names back from the metadata."""
    return df.toDF(*[f.metadata.get(RAW_NAME, f.name) for f in df.schema.fields])


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Write a stage checkpoint or a report table (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_raw_csv(df: DataFrame, path: str) -> str:
    """Raw text files with a header, every field quoted, quotes doubled."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """Re-read a stage checkpoint or a report table."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).csv(path)
    return r.format(fmt).load(path)


def write_text_report(lines: DataFrame, path: str, line_col: str = "line") -> str:
    """One text file of report lines (the report table is small)."""
    lines.select(F.col(line_col).cast("string")).coalesce(1).write.mode("overwrite").text(path)
    return path


def from_rows(spark: SparkSession, rows: Sequence[dict] | Sequence[tuple], schema) -> DataFrame:
    """A DataFrame from in-memory rows (scenario and what-if inputs)."""
    return spark.createDataFrame(list(rows), schema)
