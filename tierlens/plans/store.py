"""Restartable stages and a versioned metric store on a shared folder.

A stage is named; its key is a hash of its name, its parameters and the keys of its inputs. Its rows are written to
a folder of their own attempt and committed by a manifest file that names key, attempt and schema. A rerun that
finds the key reads the rows; a changed input, parameter or predecessor gives another key, so the stage and all
that follow run again and their earlier tables go. A run killed while writing leaves no manifest file: its folder
is ignored and removed by the next commit. Nothing is locked: two runs of one key commit equal tables.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SharedFolder:
    """Listing, reading and removing files of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def put(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def get(self, path: str) -> str:
        return "\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect())

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def fingerprint(self, path: str) -> str:
        """Names, lengths and times of the files under a path or a glob: what a stage that reads it depends on."""
        fs, p = self._at(path)
        seen = []
        for top in fs.globStatus(p) or []:
            todo = [top]
            while todo:
                s = todo.pop()
                if s.isDirectory():
                    todo += list(fs.listStatus(s.getPath()))
                elif not s.getPath().getName().startswith(("_", ".")):
                    seen.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
        if not seen:
            raise FileNotFoundError(path)
        return hashlib.sha256(json.dumps(sorted(seen)).encode()).hexdigest()


class StageStore(SharedFolder):
    """Named stages of one flow. ``ran`` lists those that this object computed, ``keys`` the key of each seen."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path)
        self.ran: list[str] = []
        self.keys: dict[str, str] = {}

    def key(self, name: str, inputs: Mapping[str, str], params: Mapping) -> str:
        said = json.dumps([name, dict(inputs), dict(params)], sort_keys=True, default=repr)
        return hashlib.sha256(said.encode()).hexdigest()

    def _committed(self, name: str) -> dict[str, str]:
        """key -> attempt."""
        return dict(n.split("~", 1) for n in self.names(f"{self.path}/manifest/{name}") if "~" in n and not n.startswith("."))

    def stage(self, name: str, inputs: Mapping[str, str], params: Mapping, build: Callable[[], DataFrame]) -> DataFrame:
        """The rows of a stage: read if its key is committed, else built, written, committed and read back."""
        key = self.keys[name] = self.key(name, inputs, params)
        attempt = self._committed(name).get(key)
        if attempt is None:
            attempt = uuid.uuid4().hex
            out = build()
            out.write.parquet(f"{self.path}/stages/{name}/{attempt}")
            entry = {"stage": name, "key": key, "inputs": dict(inputs), "params": json.loads(json.dumps(dict(params), default=repr)), "schema": json.loads(out.schema.json())}
            self.put(f"{self.path}/manifest/{name}/{key}~{attempt}", json.dumps(entry, sort_keys=True))
            self.ran.append(name)
            self._remove_stale(name, f"{key}~{attempt}", attempt)
        return self.read(name, key, attempt)

    def read(self, name: str, key: str, attempt: str) -> DataFrame:
        entry = json.loads(self.get(f"{self.path}/manifest/{name}/{key}~{attempt}"))
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{self.path}/stages/{name}/{attempt}")

    def _remove_stale(self, name: str, marker: str, attempt: str) -> None:
        for n in self.names(f"{self.path}/manifest/{name}"):
            if n != marker and not n.startswith("."):
                self.remove(f"{self.path}/manifest/{name}/{n}")
        for n in self.names(f"{self.path}/stages/{name}"):
            if n != attempt:
                self.remove(f"{self.path}/stages/{name}/{n}")


class MetricStore(SharedFolder):
    """Result tables kept by run: writing a run's table again replaces that run's rows and no others."""

    def put_table(self, table: str, run: str, rows: DataFrame) -> None:
        out = rows.withColumn("run", F.lit(run))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{self.path}/{table}")

    def table(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.path}/{table}").withColumn("run", F.col("run").cast("string"))

    def put_text(self, report: str, run: str, lines: DataFrame, order: Sequence[str], line: str = "line") -> None:
        """A text report of a run, its lines in order. A report has a line for each class of each model."""
        lines.coalesce(1).sortWithinPartitions(*order).select(line).write.mode("overwrite").text(f"{self.path}/{report}/run={run}")

    def text(self, report: str, run: str) -> DataFrame:
        return self.spark.read.text(f"{self.path}/{report}/run={run}")
