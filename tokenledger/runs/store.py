"""Written layers and append-only logs under one folder.

``AppendLog``: rows are kept by (run, scope) partition and written with dynamic partition
overwrite, so writing a run's rows again replaces them and adds nothing; other runs stay.

``LayerStore``: a layer's rows lie in ``<layer>/partition_month=.../layer_version=...``.  A
write makes new version folders and touches no published one.  Publishing appends one row a
month to the manifest log; readers take each month's latest published version, so the swap is
one committed append, a broken write is never seen, and a one-month refresh rewrites one month.
Months are partition columns of what is read: filters on them prune folders."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MONTH, VERSION = "partition_month", "layer_version"
UNDATED = "all"
#: Months that a task writes side by side (with more, it sorts its rows by month) and the bytes it holds of each.
OPEN_MONTHS, OPEN_BYTES = 64, 16 << 20


@contextmanager
def months_side_by_side(spark: SparkSession) -> Iterator[None]:
    """Writers of months keep one file of each open instead of sorting whole rows by month."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_MONTHS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return sorted(x.getPath().toString() for x in found or [])


def files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time) of a table's files: one file, or those of a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
    out = []
    for f in found:
        inner = f.getPath().getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(f.getPath()) if f.isDirectory() else [f]
        out += [(x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in inner]
    return sorted(out)


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the greatest ``order`` columns (G30): one hash aggregation,
    partial in each task, without sorting a key's history."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("row")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


class AppendLog:
    """An append-only table of ``schema``; ``pipeline_run_id`` and ``scope`` name the partition."""

    def __init__(self, spark: SparkSession, path: str, schema: str, scope: str):
        self.spark, self.path, self.scope = spark, path, scope
        self.schema = T.StructType.fromDDL(schema)
        self.parts = ["pipeline_run_id", scope]

    def append(self, rows: list[tuple]) -> None:
        """Adds the rows of a run; rows that the run wrote before for the same scope are replaced."""
        if any(not r[self.schema.fieldNames().index(p)] for r in rows for p in self.parts):
            raise ValueError(f"log rows need {' and '.join(self.parts)}")
        if rows:
            table = pa.Table.from_pylist([dict(zip(self.schema.fieldNames(), r)) for r in rows], to_arrow_schema(self.schema))
            (self.spark.createDataFrame(table, self.schema).coalesce(1).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*self.parts).parquet(self.path))

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.fieldNames())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)


@dataclass
class Staged:
    """A written, unpublished version of a layer."""
    layer: str
    version: str
    months: list[str]
    rows: int
    schema: T.StructType
    df: DataFrame


class LayerStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.manifest = AppendLog(spark, f"{self.base}/_log/manifest",
                                  "pipeline_run_id string, layer string, partition_month string, layer_version string, "
                                  "published_at timestamp_ntz, schema_json string", "layer")

    def _paths(self, layer: str, version: str) -> list[str]:
        return folders(self.spark, f"{self.base}/{layer}/{MONTH}=*/{VERSION}={version}")

    def _open(self, layer: str, schema: T.StructType, paths: list[str]) -> DataFrame:
        full = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType()), T.StructField(VERSION, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", f"{self.base}/{layer}").parquet(*paths)

    def stage(self, layer: str, df: DataFrame, version: str, month_of: str | None = None, cluster_by: tuple[str, ...] = (),
              ordered: bool = False) -> Staged:
        """Writes a version of the layer beside the published one.

        Rows are rebalanced by month (a month of any size is split over tasks, small ones are
        joined) and sorted on the clustering columns within a file, so that a reader skips by
        month and by min / max.  With ``ordered`` the rows of each task come clustered: they are
        written where they are, a file a task and month, without a shuffle or a sort of whole
        rows.  The row count is taken while writing."""
        for path in self._paths(layer, version):
            remove_folder(self.spark, path)  # an earlier try of this version
        month: Column = F.date_format(month_of, "yyyy-MM") if month_of else F.lit(UNDATED)
        seen = Observation()
        out = df.withColumn(MONTH, month).withColumn(VERSION, F.lit(version)).observe(seen, F.count(F.lit(1)).alias("rows"))
        if month_of and not ordered:
            out = out.hint("rebalance", MONTH).sortWithinPartitions(MONTH, *cluster_by)
        write = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH, VERSION)
        if ordered:
            write = write.option("parquet.block.size", OPEN_BYTES).option("compression", "zstd")  # a task holds a file a month open
        write.parquet(f"{self.base}/{layer}")
        paths = self._paths(layer, version)
        months = [p.split(f"{MONTH}=")[1].split("/")[0] for p in paths]
        return Staged(layer, version, months, seen.get["rows"], df.schema, self._open(layer, df.schema, paths).drop(MONTH, VERSION))

    def reload(self) -> None:
        """Reads the manifest again: what other sessions published since."""
        rows = latest(self.manifest.read(), ["layer", MONTH], ["published_at", "pipeline_run_id"]).collect()  # a row a layer and month
        self._known: dict[str, dict[str, tuple[str | None, str]]] = {}
        for r in rows:
            self._known.setdefault(r["layer"], {})[r[MONTH]] = (r[VERSION], r["schema_json"])

    def current(self, layer: str) -> dict[str, str]:
        """The published version of each month that the layer has."""
        if not hasattr(self, "_known"):
            self.reload()
        return {m: v for m, (v, _) in sorted(self._known.get(layer, {}).items()) if v is not None}

    def publish(self, staged: list[Staged], run_id: str, at: dt.datetime, only_months: list[str] | None = None) -> None:
        """Makes the staged versions the published ones, all by one append.  A full refresh
        (``only_months`` None) also ends the months it doesn't have; else just the named months
        change hands.  One session publishes at a time."""
        rows = []
        for s in staged:
            gone = [m for m in (self.current(s.layer) if only_months is None else only_months) if m not in s.months]
            months = s.months if only_months is None else [m for m in s.months if m in only_months]
            shape = json.dumps(s.schema.jsonValue())
            changes = [*((m, s.version) for m in months), *((m, None) for m in gone)] or [(UNDATED, None)]
            rows += [(run_id, s.layer, m, v, at, shape) for m, v in changes]
        self.manifest.append(rows)
        for _, layer, m, v, _, shape in rows:
            self._known.setdefault(layer, {})[m] = (v, shape)

    def read(self, layer: str, with_month: bool = False) -> DataFrame:
        """The published rows; with ``with_month`` the partition column to filter on stays."""
        months = self.current(layer)
        if layer not in self._known:
            raise LookupError(f"layer {layer} was never published under {self.base}")
        shape = sorted(self._known[layer].items())[-1][1]
        df = self._open(layer, T.StructType.fromJson(json.loads(shape[1])),
                        [f"{self.base}/{layer}/{MONTH}={m}/{VERSION}={v}" for m, v in months.items()])
        return df.drop(VERSION) if with_month else df.drop(MONTH, VERSION)

    def vacuum(self, layer: str) -> int:
        """Deletes the folders that no month's published version uses; returns how many."""
        used = {f"{MONTH}={m}/{VERSION}={v}" for m, v in self.current(layer).items()}
        old = [p for p in folders(self.spark, f"{self.base}/{layer}/{MONTH}=*/{VERSION}=*") if "/".join(p.split("/")[-2:]) not in used]
        for path in old:
            remove_folder(self.spark, path)
        return len(old)
