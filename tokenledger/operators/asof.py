"""Latest-row and as-of operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (row_number = 1; QUALIFY)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def asof_latest(left: DataFrame, right: DataFrame, on: str, left_date: str, right_date: str,
                tie: str, fields: list[str], prefix: str = "") -> DataFrame:
    """For each left row, attach the latest right row with
    ``right_date <= left_date`` (ties: highest ``tie``).  Left rows without
    one keep NULLs.

    Linear form instead of an N x M inequality join: both sides are unioned
    into one event stream per key, ordered by date with right events before
    left rows of the same date, and ``last(..., ignorenulls)`` carries the
    latest right payload forward.  Rows per key are the key's own events,
    so a key never holds more than its own left rows plus its decisions.
    """
    payload = F.struct(*[F.col(f) for f in fields])
    r = right.select(F.col(on).alias("_k"), F.col(right_date).alias("_d"), F.lit(0).alias("_kind"),
                     F.col(tie).alias("_tie"), payload.alias("_payload"))
    lcols = left.columns
    l_ = left.select("*", F.col(on).alias("_k"), F.col(left_date).alias("_d"), F.lit(1).alias("_kind"))
    w = (Window.partitionBy("_k").orderBy("_d", "_kind", "_tie")
         .rowsBetween(Window.unboundedPreceding, 0))
    carried = (l_.unionByName(r, allowMissingColumns=True)
               .withColumn("_latest", F.last("_payload", ignorenulls=True).over(w))
               .filter(F.col("_kind") == 1))
    return carried.select(*lcols, *[F.col(f"_latest.{f}").alias(prefix + f) for f in fields])
