"""Rescoring on each new input (M9) with Structured Streaming.

Scoring is stateless, so each micro-batch is scored by the same batch
function used offline (``foreachBatch``) from saved statistics or a saved
model, and each batch is written idempotently under its batch id, so a
replay after a failure overwrites instead of duplicating (exactly-once
output on a replayable source). What is stateful is which rows to score:
``newest_versions`` keeps the last version of each row, in groups of keys, and drops replays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import band, zscore
from ..session import stage_path

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over one table's Parquet files in ``sf_dir``."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir)


def run_scoring_stream(stream: DataFrame, score_batch: Callable[[DataFrame], DataFrame], sink: str,
                       checkpoint: str, available_now: bool = True, timeout_s: float | None = None) -> str:
    """Run ``score_batch`` on every micro-batch and append the result to a
    Parquet sink, one idempotent sub-folder per batch id. A source without
    rows leaves an empty sink of the right schema. A query that does not end
    in ``timeout_s`` seconds is stopped and raises: no partial sink passes
    for a whole one."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    ended = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination(), True)[1]
    if not ended:
        q.stop()
        raise TimeoutError(f"the scoring stream did not end in {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    spark = stream.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(sink)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        score_batch(spark.createDataFrame([], stream.schema)).write.parquet(f"{sink}/batch_id=-1")
    return sink


#: State groups of ``newest_versions``: a group keeps the versions of its share of the keys, so that a micro-batch
#: costs at most so many calls of Python however many keys it brings.
KEY_GROUPS = 1024
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def newest_versions(stream: DataFrame, key: str, version: str, ts: str, delay: str, key_groups: int = KEY_GROUPS) -> DataFrame:
    """Rows that bring a higher ``version`` of their ``key`` than any before: the state store keeps two numbers for
    each key, in ``key_groups`` groups of keys. Replayed and overtaken versions are dropped, also across restarts, as
    the state is checkpointed with the stream. Rows later than the watermark are dropped, and a key's state ends when
    the watermark has passed its newest row by ``delay``, so the state holds the keys of that span only. Null keys are
    one key; a null version is none."""
    fields, spark = stream.schema.fields, stream.sparkSession
    wait_ms = int(spark.range(1).select(F.expr(f"unix_millis(timestamp_seconds(0) + INTERVAL {delay})")).first()[0])
    at = {f.name: f"c{i}" for i, f in enumerate(fields)}
    cols, k, v, t = [F.col(f"`{f.name}`") for f in fields], at[key], at[version], at[ts]
    # whole numbers stay whole in pandas only without nulls: those travel as flags
    whole = [i for i, f in enumerate(fields) if isinstance(f.dataType, _WHOLE)]
    rows = stream.select(*[(F.coalesce(c, F.lit(0).cast(f.dataType)) if i in whole else c).alias(f"c{i}") for i, (c, f) in enumerate(zip(cols, fields, strict=True))],
                         *[cols[i].isNull().alias(f"n{i}") for i in whole], cols[fields.index(stream.schema[key])].cast("string").alias("id"),
                         cols[fields.index(stream.schema[version])].isNotNull().alias("valid"))
    ms = f"unix_millis({t})" if isinstance(stream.schema[ts].dataType, T.TimestampType) else f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {t})"
    rows = rows.withColumn("ms", F.coalesce(F.expr(ms), F.lit(0).cast("long")))
    kept = [f"c{i}" for i in range(len(fields))] + [f"n{i}" for i in whole]
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in kept])

    def keep(_, frames, state):
        import pickle

        import pandas as pd

        known = pickle.loads(bytes(state.get[0])) if state.exists else {}  # id: version, end of its state
        now, out = state.getCurrentWatermarkMs(), None
        came = set()
        if not state.hasTimedOut:
            held = None
            for pdf in frames:  # only the newest row of each key is held
                came.update(pdf["id"])
                pdf = pdf[pdf["valid"]]
                held = pdf if held is None else pd.concat([held, pdf])
                held = held.sort_values([v, t], kind="stable").drop_duplicates("id", keep="last")
            newer = []
            for i, number, time in zip(held["id"].tolist(), held[v].tolist(), held["ms"].tolist(), strict=True):
                seen = known.get(i)
                newer.append(seen is None or number > seen[0])
                if newer[-1]:
                    # the row's time is not before the watermark, so neither is the time-out
                    known[i] = int(number), max(time + wait_ms, now + 1)
                    came.discard(i)
            for i in came.intersection(known):
                known[i] = known[i][0], now + wait_ms + 1
            came.update(held["id"])
            out = held.loc[newer, kept]
        known = {i: s for i, s in known.items() if s[1] >= now or i in came}
        if known:
            state.update((pickle.dumps(known),))
            state.setTimeoutTimestamp(max(min(s[1] for s in known.values()), now + 1))
        elif state.exists:
            state.remove()
        if out is not None and len(out):
            yield out

    rows = rows.withColumn("key_group", F.pmod(F.xxhash64("id"), F.lit(key_groups)))
    newest = rows.withWatermark(t, delay).groupBy("key_group").applyInPandasWithState(keep, schema, "known binary", "append", "EventTimeTimeout")
    return newest.select(*[(F.when(~F.col(f"n{i}"), F.col(f"c{i}")) if i in whole else F.col(f"c{i}")).alias(f.name) for i, f in enumerate(fields)])


def rescore_stream(versions: DataFrame, score_batch: Callable[[DataFrame], DataFrame], run_dir: str, key: str = "entity_key",
                   version: str = "version", ts: str = "changed_at", delay: str = "2 hours", timeout_s: float | None = None) -> DataFrame:
    """M9: score every new version of every row with a saved model or saved statistics, and give the newest score of
    each row. A key's versions are compared once more over the sink, since a key whose state has ended may return."""
    sink = run_scoring_stream(newest_versions(versions, key, version, ts, delay), score_batch, f"{run_dir}/sink", f"{run_dir}/checkpoint", timeout_s=timeout_s)
    scored = versions.sparkSession.read.parquet(sink).drop("batch_id")
    rest = [c for c in scored.columns if c != key]
    best = scored.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(version, ts)).alias("r"))
    return best.select(key, "r.*")


def event_value_scorer(stats: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Batch scoring function for events: z-score of ``value`` against the
    static fitted stats (one row, read once) and a level band."""
    row = stats.first()
    mean, sd = (None if row[k] is None else float(row[k]) for k in ("mean", "sd"))

    def score(batch: DataFrame) -> DataFrame:
        sd_col = F.lit(sd).cast("double")
        z = zscore(F.col("value"), F.lit(mean).cast("double"), sd_col)
        return batch.select("event_id", "event_type", "value", z.alias("z_value")) \
            .withColumn("level", band("z_value", ((1.0, "high"), (-1.0, "normal")), "low"))
    return score


def score_events(spark: SparkSession, sf_dir: str, run_dir: str | None = None) -> DataFrame:
    """M9 end to end: fit stats on the events table (batch, one aggregate),
    then rescore the events as a stream until all available input is done;
    returns the sink as a DataFrame."""
    stats = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet") \
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    base = run_dir or stage_path(spark, f"stream-{uuid.uuid4().hex[:12]}")
    sink = run_scoring_stream(read_table_stream(spark, sf_dir, "events", EVENT_SCHEMA),
                              event_value_scorer(stats), f"{base}/sink", f"{base}/checkpoint")
    return spark.read.parquet(sink).drop("batch_id")
