"""Percentage split with explicit residual (G11), source-measure anchor
and bi-temporal restatement flag (G13).

The attribution bridge is cut into date segments per (provider, project,
key) and month; a segment carries its owners as an array, with the anchor
marked, the summed percentage and, where that is below 1, one residual entry.
A usage row meets at most one segment and explodes its array: the usage fact
is read once, without a window or a regrouping of the fact, however hot a
single key is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.functions.numeric import PCT
from tokenledger.operators.lookup import MONTH, covered_segments, joined_small

BRIDGE_KEYS = ["provider", "provider_project_id", "api_key_id"]
ANCHOR_ORDER = ["application_name", "department_name", "cost_center", "mapping_id"]
OWNER_COLS = ["mapping_id", "application_name", "department_name", "cost_center", "allocation_percentage", "mapping_status",
              "allocation_method", "allocation_confidence", "effective_start_date", "effective_end_date", "mapping_recorded_date"]


def bridge_segments(bridge: DataFrame) -> DataFrame:
    """Per key, month and elementary segment: count and summed percentage of the
    covering mappings, and the mappings themselves, the anchor first (by
    application, department, cost centre, mapping id)."""
    owner = F.struct(*ANCHOR_ORDER, *[c for c in OWNER_COLS if c not in ANCHOR_ORDER])
    return (covered_segments(bridge, BRIDGE_KEYS, "effective_start_date", "effective_end_date")
            .groupBy(*BRIDGE_KEYS, MONTH, "seg_start", "seg_end")
            .agg(F.count(F.lit(1)).alias("matched_mapping_count"),
                 F.sum("allocation_percentage").alias("mapped_allocation_percentage"),
                 F.array_sort(F.collect_list(owner)).alias("owners")))


def _residual(mapped, no_mapping):
    """The entry of the part that no owner takes."""
    values = {"mapping_id": F.lit(None).cast("string"), "application_name": F.lit("Unallocated"),
              "department_name": F.lit("Unallocated"), "cost_center": F.lit("UNALLOCATED"),
              "allocation_percentage": (F.lit(1) - mapped).cast(PCT), "mapping_status": F.lit("unallocated"),
              "allocation_method": F.when(no_mapping, "no_mapping").otherwise("unallocated_residual"),
              "allocation_confidence": F.lit("none"), "effective_start_date": F.lit(None).cast("date"),
              "effective_end_date": F.lit(None).cast("date"), "mapping_recorded_date": F.lit(None).cast("date")}
    return [values[c].alias(c) for c in OWNER_COLS]


def allocate_percent(usage: DataFrame, bridge: DataFrame, measures: list[str],
                     money_measures: list[str]) -> DataFrame:
    """Split each usage row across its effective owners; add a residual row
    (1 - sum %) when the owners cover less than 100 %, a ``no_mapping`` row
    when there is none.  Every measure is multiplied into allocated_/
    unallocated_ columns and exposed once, unsplit, on the anchor row."""
    tag = "_b_"
    segs = bridge_segments(bridge)
    segs = segs.select(*[F.col(c).alias(tag + c) for c in [*BRIDGE_KEYS, MONTH, "seg_start", "seg_end"]],
                       "matched_mapping_count", "mapped_allocation_percentage", "owners")
    cond = F.trunc(usage["usage_date"], "MM") == segs[tag + MONTH]
    for k in BRIDGE_KEYS:
        cond = cond & (usage[k] == segs[tag + k])
    cond = cond & usage["usage_date"].between(segs[tag + "seg_start"], segs[tag + "seg_end"])
    u = joined_small(usage, segs, bridge, cond).drop(*[c for c in segs.columns if c.startswith(tag)])
    mapped = F.coalesce(F.col("mapped_allocation_percentage"), F.lit(0))
    no_mapping = F.col("matched_mapping_count").isNull()

    entry = bridge.select(*OWNER_COLS).schema
    kind = "array<struct<status:string,anchor:boolean," + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in entry) + ">>"
    allocated = F.transform("owners", lambda o, i: F.struct(
        F.lit("Allocated").alias("status"), (i == 0).alias("anchor"), *[o[c].alias(c) for c in OWNER_COLS]))
    rest = F.when(mapped < 1, F.array(F.struct(F.lit("Unallocated").alias("status"), no_mapping.alias("anchor"),
                                               *_residual(mapped, no_mapping))).cast(kind))
    none = F.array().cast(kind)
    rows = u.withColumn("_owner", F.explode(F.concat(F.coalesce(allocated.cast(kind), none), F.coalesce(rest, none))))
    rows = rows.drop("owners").select("*", *[F.col("_owner")[c].alias(c) for c in OWNER_COLS],
                                      F.col("_owner.status").alias("allocation_status"),
                                      F.col("_owner.anchor").alias("source_measure_anchor_flag")).drop("_owner")
    rows = rows.withColumn("is_historical_restatement", F.coalesce(
        (F.col("mapping_recorded_date") > F.col("effective_start_date"))
        & (F.col("usage_date") < F.col("mapping_recorded_date")), F.lit(False)))
    # sum of the row percentages of this source row: mapped + residual
    rows = rows.withColumn(
        "total_distribution_percentage",
        F.when(mapped < 1, F.lit(1)).otherwise(mapped).cast("decimal(7,4)"))
    pct = F.col("allocation_percentage")
    is_alloc = F.col("allocation_status") == "Allocated"
    out = {}
    for m in measures:
        scaled = F.col(m) * pct
        if m in money_measures:
            scaled = scaled.cast("decimal(32,13)")  # exact: the split conserves the source amount
        else:
            scaled = scaled.cast("decimal(28,4)")
        zero = F.lit(0).cast(scaled_type(m in money_measures))
        out[f"src__{m}"] = F.when(F.col("source_measure_anchor_flag"), F.col(m))
        out[f"alloc__{m}"] = F.when(is_alloc, scaled).otherwise(zero)
        out[f"unalloc__{m}"] = F.when(~is_alloc, scaled).otherwise(zero)
    return rows.withColumns(out)


def scaled_type(is_money: bool) -> str:
    return "decimal(32,13)" if is_money else "decimal(28,4)"
