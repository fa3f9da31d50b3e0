"""One corrupted table per control class must raise violation_count > 0
"""

from pyspark.sql import functions as F

from tokenledger.plans.pipeline import Pipeline
from tokenledger.quality import controls as C

SF = "/root/testdata/sf0.001"


def _run(p, cid):
    ctl = [c for c in C.catalogue() if c.control_id == cid]
    assert ctl, cid
    (row,) = C.evaluate(p, ctl).collect()
    return row.violation_count


def test_clean_data_passes(spark):
    p = Pipeline(spark, SF)
    for cid in ["usage_grain_unique", "all_usage_rows_are_priced", "provider_reported_total_reconciles",
                "every_source_row_has_one_anchor", "monthly_usage_rollup_has_no_orphans",
                "unallocated_cost_is_visible", "batch_savings_match_token_economics"]:
        assert _run(p, cid) == 0, cid


def test_duplicate_usage_row_breaks_unique_grain(spark):
    p = Pipeline(spark, SF)
    raw = p.raw_usage
    p.__dict__["raw_usage"] = raw.unionByName(raw.limit(1))
    assert _run(p, "usage_grain_unique") == 1
    assert _run(p, "normalized_row_count_matches_raw") == 0   # staging follows raw


def test_unpriced_row_breaks_row_rule(spark):
    p = Pipeline(spark, SF)
    p.__dict__["usage_priced"] = p.usage_priced.withColumn(
        "pricing_status", F.when(F.col("usage_date") == F.lit("2025-03-01").cast("date"), "Missing rate")
        .otherwise(F.col("pricing_status")))
    assert _run(p, "all_usage_rows_are_priced") > 0


def test_changed_total_breaks_total_parity(spark):
    p = Pipeline(spark, SF)
    _ = p.provider_cost_stg
    p.__dict__["cost_reconciliation"] = p.cost_reconciliation.withColumn(
        "provider_reported_cost", (F.col("provider_reported_cost") + F.lit(1)).cast("decimal(28,9)"))
    assert _run(p, "provider_reported_total_reconciles") == 1


def test_double_anchor_breaks_group_rule(spark):
    p = Pipeline(spark, SF)
    p.__dict__["usage_daily"] = p.usage_daily.withColumn("source_measure_anchor_flag", F.lit(True))
    assert _run(p, "every_source_row_has_one_anchor") > 0


def test_orphan_rollup_breaks_anti_join(spark):
    p = Pipeline(spark, SF)
    p.__dict__["provider_cost_stg"] = p.provider_cost_stg.filter(F.col("line_item_type") != "usage")
    assert _run(p, "monthly_usage_rollup_has_no_orphans") > 0


def test_missing_kind_breaks_must_exist(spark):
    p = Pipeline(spark, SF)
    p.__dict__["application_cost"] = p.application_cost.filter(F.col("allocation_confidence") != "medium")
    assert _run(p, "allocation_confidence_is_visible") == 1


def test_wrong_savings_break_join_rule(spark):
    p = Pipeline(spark, SF)
    p.__dict__["optimization"] = p.optimization.withColumn(
        "modeled_monthly_savings", (F.col("modeled_monthly_savings") + F.lit(1)).cast("decimal(28,9)"))
    assert _run(p, "batch_savings_match_token_economics") > 0


def test_lost_staging_rows_break_count_parity(spark):
    p = Pipeline(spark, SF)
    assert _run(p, "E2E-01") == 0
    p.__dict__["usage_normalized"] = p.usage_normalized.filter("api_key_id <> 'key-8'")
    del p.__dict__["usage_priced"]
    p.__dict__["telemetry_stg"] = p.telemetry_stg.filter("api_key_id <> 'key-8'")
    for cid in ["E2E-01", "normalized_row_count_matches_raw", "E2E-03", "staged_telemetry_row_count_matches_raw"]:
        assert _run(p, cid) > 0, cid


def test_lost_attempts_break_monthly_summary(spark):
    p = Pipeline(spark, SF)
    p.__dict__["telemetry_coverage_monthly"] = p.telemetry_coverage_monthly.withColumn("telemetry_attempt_count", F.col("telemetry_attempt_count") - 1)
    assert _run(p, "monthly_summary_reconciles_to_daily") == 1


def test_unknown_keys_count_fact_rows(spark):
    p = Pipeline(spark, SF)
    n = p.fact_usage_monthly.filter("provider = 'openai'").count()
    p.__dict__["fact_usage_monthly"] = p.fact_usage_monthly.withColumn(
        "provider_key", F.when(F.col("provider") == "openai", "?").otherwise(F.col("provider_key")))
    assert _run(p, "all_fact_provider_keys_resolve") == n


def test_composite_and_one_verdict_controls(spark):
    p = Pipeline(spark, SF)
    p.__dict__["token_economics"] = p.token_economics.withColumns(
        {"usage_cost_estimate": (F.col("usage_cost_estimate") + 1).cast("decimal(28,9)"), "total_tokens": F.col("total_tokens") + 1})
    assert _run(p, "E2E-13") == 1
