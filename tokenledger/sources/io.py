"""

* S01/S02 typed CSV scan: explicit schema, header, quoted newlines, FAILFAST
  (zero bad records), then a NOT NULL check for the required columns (file
  sources relax nullability).
* S03/S04 full-refresh sinks: overwrite, optionally partitioned by month and
  sorted within partitions on the clustering columns (min/max skipping).
* S08 source-vs-loaded row counts per table.
* S09 provider-native JSON usage payloads -> the common usage columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_from_triples(triples: list[tuple[str, str, str]]) -> T.StructType:
    """(name, type, mode) triples -> StructType; mode REQUIRED -> nullable False."""
    types = {"STRING": T.StringType(), "BOOL": T.BooleanType(), "BOOLEAN": T.BooleanType(),
             "DATE": T.DateType(), "INT64": T.LongType(), "INTEGER": T.LongType(),
             "NUMERIC": T.DecimalType(28, 9), "TIMESTAMP": T.TimestampType(), "FLOAT64": T.DoubleType()}
    return T.StructType([T.StructField(n, types[t.upper()], m.upper() != "REQUIRED") for n, t, m in triples])


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV scan that fails on the first malformed record, then
    rejects NULLs in required columns."""
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
          .option("mode", "FAILFAST").option("encoding", "UTF-8").csv(path))
    required = [f.name for f in schema.fields if not f.nullable]
    if required:
        bad = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
        nulls = {c: bad[c] for c in required if bad[c]}
        if nulls:
            raise ValueError(f"NULL values in required columns: {nulls}")
    return df


def write_table(df: DataFrame, path: str, partition_month_of: str | None = None,
                cluster_by: list[str] | None = None) -> None:
    """Full refresh.  With ``partition_month_of`` the table is
    partitioned by the month of that date column (one directory per month,
    so readers prune months), and rows are sorted within partitions on the
    clustering columns."""
    out = df
    if partition_month_of:
        out = out.withColumn("partition_month", F.date_format(F.col(partition_month_of), "yyyy-MM"))
        out = out.repartition("partition_month")
    if cluster_by:
        out = out.sortWithinPartitions(*cluster_by)
    w = out.write.mode("overwrite")
    if partition_month_of:
        w = w.partitionBy("partition_month")
    w.parquet(path)


def load_reconciliation(source_counts: DataFrame, loaded: dict[str, DataFrame]) -> DataFrame:
    """One row per table with source and loaded row counts, difference
    and PASS/FAIL.  ``source_counts`` has (table_name, source_row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("loaded_row_count")).withColumn("table_name", F.lit(name))
             for name, df in loaded.items()]
    counted = parts[0]
    for p in parts[1:]:
        counted = counted.unionByName(p)
    j = source_counts.join(counted, "table_name", "full")
    diff = F.coalesce("source_row_count", F.lit(0)) - F.coalesce("loaded_row_count", F.lit(0))
    return j.select("table_name", "source_row_count", "loaded_row_count", diff.alias("row_count_difference"),
                    F.when(diff == 0, "PASS").otherwise("FAIL").alias("status"))


# Provider JSON field paths -> common usage columns.
# FIXED VALUES: the provider payload paths of the field-map contract.
OPENAI_USAGE_PATHS = {
    "input_tokens": "usage.input_tokens",
    "output_tokens": "usage.output_tokens",
    "cached_input_tokens": "usage.input_tokens_details.cached_tokens",
    "reasoning_tokens": "usage.output_tokens_details.reasoning_tokens",
}
ANTHROPIC_USAGE_PATHS = {
    "uncached_input_tokens": "usage.input_tokens",
    "output_tokens": "usage.output_tokens",
    "cache_read_input_tokens": "usage.cache_read_input_tokens",
    "cache_creation_5m_tokens": "usage.cache_creation.ephemeral_5m_input_tokens",
    "cache_creation_1h_tokens": "usage.cache_creation.ephemeral_1h_input_tokens",
}


def _path_or_null(df: DataFrame, path: str):
    node = df.schema
    for part in path.split("."):
        if not isinstance(node, T.StructType) or part not in node.fieldNames():
            return F.lit(None).cast("bigint")
        node = node[part].dataType
    return F.col(path).cast("bigint")


def normalize_provider_json(spark: SparkSession, openai_path: str | None = None,
                            anthropic_path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Read each provider's native JSON, select its nested paths into
    the common columns, and union by name (missing columns become NULL)."""
    keep = keep or []
    parts = []
    for provider, path, paths in (("openai", openai_path, OPENAI_USAGE_PATHS),
                                  ("anthropic", anthropic_path, ANTHROPIC_USAGE_PATHS)):
        if not path:
            continue
        raw = spark.read.option("multiLine", True).json(path)
        cols = [F.lit(provider).alias("provider")]
        cols += [F.col(k) for k in keep if k in raw.columns]
        cols += [_path_or_null(raw, p).alias(name) for name, p in paths.items()]
        parts.append(raw.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
