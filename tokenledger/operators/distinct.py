"""Exact distinct counts beside other aggregates, with a narrow shuffle.

One aggregation with a distinct count sends all of its buffers (sums, counts) for every distinct
id.  Here the other aggregates are reduced in each task to a row a group, and only prints of the
ids travel: 64 bits of the group's keys and 96 bits of the id, 12 bytes that do not shrink.  Two
ids of a group are taken for one if both hashes agree: among n ids of a group about n^2 / 2^97
pairs, none up to 10^13 ids.  The groups themselves are told apart by 64 bits, n^2 / 2^65."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

G, A, B, N = "_gc_group", "_gc_a", "_gc_b", "_gc_n"


def prints(col: str) -> tuple[str, str]:
    """SQL of the two hashes of a column; a null has a null first one."""
    return f"IF({col} IS NULL, NULL, xxhash64({col}))", f"hash({col})"


def group_print(keys: list[str]) -> Column:
    """A hash of the keys in which nulls have their place."""
    return F.xxhash64(*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys])


def group_counts(df: DataFrame, keys: list[str], aggs: list[Column], of: str, name: str) -> DataFrame:
    """``df`` grouped by ``keys``: the aggregates, and as ``name`` the number of distinct non-null
    ``of`` behind the first aggregate.  Null keys are a group."""
    whole = df.groupBy(*keys).agg(*aggs).withColumn(G, group_print(keys))
    a, b = prints(of)
    ids = df.filter(F.col(of).isNotNull()).select(group_print(keys).alias(G), F.expr(a).alias(A), F.expr(b).alias(B)).distinct()
    counted = ids.groupBy(G).agg(F.count(F.lit(1)).alias(N))
    at = len(keys) + 1
    out = whole.columns[:-1]
    return whole.join(counted, G, "left").select(*out[:at], F.coalesce(F.col(N), F.lit(0).cast("long")).alias(name), *out[at:])
