"""Small Spark helpers of the subpackage: the shared folder, Arrow passes over text columns."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.llm.tokens import blocks


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``; a local one is
    set only where the session names none and runs on one machine (tests).  A cluster session
    without one is an error: its executors share no local folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: cuts the lineage, and a
    lost executor loses none of it."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its own columns of these names renamed, and the mapping that names them back."""
    wanted, back = {n.lower() for n in names}, {}
    for c in [c for c in df.columns if c.lower() in wanted]:
        other = unused(df, f"{c}_")
        df, back = df.withColumnRenamed(c, other), back | {other: c}
    return df, back


def fold(key: str, n: int) -> Column:
    """crc32 of the key's text, mod n; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def tidy() -> None:
    """Hands freed memory back to the system: Python workers live on between tasks, and an
    executor counts what all of them still hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # not glibc


def tidied(fn):
    """``fn`` of one or two tables, with freed memory handed back after each call."""
    def one(a):
        out = fn(a)
        tidy()
        return out

    def two(a, b):
        out = fn(a, b)
        tidy()
        return out
    return two if fn.__code__.co_argcount - len(fn.__defaults__ or ()) == 2 else one


def per_block(df: DataFrame, text: str, fn: Callable[[pa.Table], pa.Table | None], schema: str,
              limit: int | None = None) -> DataFrame:
    """``fn`` on consecutive rows of about 1 MB of text at a time (whole texts), without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text, **({"limit": limit} if limit else {})):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield from out.to_batches()
            tidy()
    return df.mapInArrow(run, schema)


def sql_type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()
