"""
re-aimed from row-by-row file loops to grouped / windowed Spark checks that
do not depend on file order.  Each returns violating rows (empty = valid)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def decision_chain_violations(decisions: DataFrame, controls: DataFrame) -> DataFrame:
    """Per experiment, the first decision starts from 'planned', every
    previous_status equals the prior new_status, dates strictly increase,
    and the last new_status equals the control's current_status."""
    w = Window.partitionBy("experiment_id").orderBy("decision_date", "experiment_decision_id")
    d = decisions.withColumns({
        "_rn": F.row_number().over(w),
        "_prev_new": F.lag("new_status").over(w),
        "_prev_date": F.lag("decision_date").over(w),
        "_is_last": F.lead("experiment_decision_id").over(w).isNull(),
    }).join(controls.select("experiment_id", "current_status"), "experiment_id", "left")
    reason = (F.when((F.col("_rn") == 1) & (F.col("previous_status") != "planned"), "chain_not_from_planned")
              .when((F.col("_rn") > 1) & (F.col("previous_status") != F.col("_prev_new")), "broken_chain")
              .when((F.col("_rn") > 1) & (F.col("decision_date") <= F.col("_prev_date")), "dates_not_increasing")
              .when(F.col("_is_last") & (F.col("new_status") != F.col("current_status")), "final_status_mismatch"))
    return d.withColumn("violation", reason).filter(F.col("violation").isNotNull()) \
            .select("experiment_id", "experiment_decision_id", "decision_date", "violation")


def window_overlap_violations(dim: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Effective windows per key must not overlap (inclusive ends, so a
    window starting on the previous end overlaps)."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    return (dim.withColumn("_prev_end", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
            .filter(F.col("_prev_end") >= F.col(start))
            .select(*keys, start, end, F.col("_prev_end").alias("overlapping_previous_end")))


def containment_violations(inner: DataFrame, outer: DataFrame, on: list[str], inner_start: str,
                           inner_end: str, outer_start: str, outer_end: str) -> DataFrame:
    """Every inner window must be covered by one outer window of
    the same key (interval containment); returns uncovered inner rows."""
    o = outer.select(*[F.col(k).alias("_o_" + k) for k in on], F.col(outer_start).alias("_os"),
                     F.col(outer_end).alias("_oe"))
    cond = None
    for k in on:
        c = inner[k] == o["_o_" + k]
        cond = c if cond is None else cond & c
    cond = cond & (o["_os"] <= inner[inner_start]) & (o["_oe"] >= inner[inner_end])
    return inner.join(o, cond, "left_anti")
