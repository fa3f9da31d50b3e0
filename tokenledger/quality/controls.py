"""The control catalogue: every stage control and the end-to-end controls,
expressed with the classes of ``quality.spec``, plus their evaluation.

``evaluate(p)`` returns one row per control (stage, control_id, class,
violation_count, status).  Row rules and must-exist rules on the same table
are batched into ONE aggregate per table (a single scan computes all of
their ``count_if`` columns), then unpivoted with ``stack``; the remaining
controls are small aggregates unioned together.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.quality.spec import (Control, composite, count_parity, group_rule, join_rule,
                                      must_exist, no_orphans, row_rule, total_parity, unique_grain)
from tokenledger.sources import constants as K

M6, M7, M8, M9, M10, M11, M12, M13, M14, M15 = K.EXPECTED_PIPELINES
M16 = "M16_END_TO_END_CONTROLS"
M17 = "M17_SEMANTIC_MODEL"
TOL6 = "0.000001"
TOL9 = "0.000000001"
PRICED = "pricing_status = 'Priced'"
VALID = "telemetry_validation_status = 'Valid'"
USAGE = "line_item_type = 'usage'"
DAY = ("usage_date", "provider", "provider_project_id", "model")
TE = ("billing_month", "provider", "provider_project_id", "model", "model_snapshot", "usage_type")
USAGE_GRAIN = ["usage_date", "provider", "usage_type", "provider_project_id", "api_key_id", "model",
               "provider_service_tier", "is_batch", "context_window_tier"]
COST_GRAIN = ["billing_period", "provider", "provider_project_id", "model", "line_item_type",
              "provider_line_item_id"]

# FIXTURE VALUES: the four scenario controls of the allocation stage name
# fixture keys and their expected owners.
SHARED_KEY, SHARED_SPLIT = "key-2", (("search-ranking", "0.60"), ("doc-summarizer", "0.30"), ("Unallocated", "0.10"))
OWNER_CHANGE_KEY, OWNER_CHANGE_DATE, CC_BEFORE, CC_AFTER = "key-1", "2026-01-01", "CC400", "CC410"
LATE_KEY, LATE_RECORDED = "key-5", "2026-02-01"
UNMAPPED_KEY = "key-8"


def _alloc_rule(cid, source, alloc, unalloc, tol=TOL9, stage=M9):
    return group_rule(stage, cid, "usage_daily", ["source_usage_key"],
                      f"ABS(SUM({source}) - (SUM({alloc}) + SUM({unalloc}))) > {tol}")


def _scope_rule(cid, source, alloc, unalloc, where=None, stage=M12):
    return group_rule(stage, cid, "application_cost", ["financial_source_scope_id"],
                      f"ABS(SUM({source}) - (SUM({alloc}) + SUM({unalloc}))) > {TOL6}", where)


def _sum(t, e, w=None):
    return (t, f"SUM({e})", w)


def catalogue() -> list[Control]:
    c: list[Control] = []
    # ---- M6 raw load --------------------------------------------------------
    c += [
        unique_grain(M6, "usage_grain_unique", "raw_usage", USAGE_GRAIN),
        unique_grain(M6, "cost_grain_unique", "raw_cost", COST_GRAIN),
        unique_grain(M6, "telemetry_attempt_grain_unique", "raw_telemetry", ["provider_request_id"]),
        row_rule(M6, "usage_reasoning_not_above_output", "raw_usage", "COALESCE(reasoning_tokens, 0) > output_tokens"),
        row_rule(M6, "telemetry_reasoning_not_above_output", "raw_telemetry", "reasoning_tokens > output_tokens"),
        row_rule(M6, "openai_cached_input_not_above_input", "raw_usage",
                 "provider = 'openai' AND COALESCE(cached_input_tokens, 0) > input_tokens"),
        group_rule(M6, "allocation_not_above_100_percent", "bridge",
                   ["provider", "provider_project_id", "api_key_id", "effective_start_date", "effective_end_date"],
                   "SUM(allocation_percentage) > 1.000000001"),
        row_rule(M6, "all_cost_records_are_usd", "raw_cost", "UPPER(billing_currency) <> 'USD'"),
        row_rule(M6, "all_experiment_limits_are_usd", "experiment_control", "UPPER(limit_currency) <> 'USD'"),
        composite(M6, "all_rows_are_marked_synthetic", [
            row_rule(M6, "-", "raw_usage", "NOT is_synthetic"), row_rule(M6, "-", "raw_cost", "NOT is_synthetic"),
            row_rule(M6, "-", "raw_telemetry", "NOT is_synthetic")]),
    ]
    # ---- M7 staging ---------------------------------------------------------
    c += [
        count_parity(M7, "normalized_row_count_matches_raw", "usage_normalized", "raw_usage"),
        unique_grain(M7, "normalized_source_key_is_unique", "usage_normalized", ["source_usage_key"]),
        row_rule(M7, "every_usage_row_resolves_one_model_map", "usage_normalized", "model_map_match_count <> 1"),
        row_rule(M7, "every_usage_row_resolves_one_service_tier", "usage_normalized", "service_tier_match_count <> 1"),
        row_rule(M7, "all_normalized_tokens_are_valid", "usage_normalized", "token_validation_status <> 'Valid'"),
        row_rule(M7, "every_usage_row_resolves_one_rate", "usage_priced", "rate_match_count <> 1"),
        row_rule(M7, "all_usage_rows_are_priced", "usage_priced",
                 "pricing_status <> 'Priced' OR usage_cost_estimate IS NULL OR usage_cost_estimate < 0"),
        row_rule(M7, "historical_rate_window_contains_usage_date", "usage_priced",
                 "usage_date NOT BETWEEN rate_effective_start AND rate_effective_end"),
        row_rule(M7, "historical_model_window_contains_usage_date", "usage_priced",
                 "usage_date NOT BETWEEN model_map_effective_start AND model_map_effective_end"),
        row_rule(M7, "priced_usage_is_usd", "usage_priced", "rate_currency <> 'USD'"),
        count_parity(M7, "staged_cost_row_count_matches_raw", "provider_cost_stg", "raw_cost"),
        row_rule(M7, "staged_cost_is_usd", "provider_cost_stg", "financial_validation_status <> 'Valid'"),
        count_parity(M7, "staged_telemetry_row_count_matches_raw", "telemetry_stg", "raw_telemetry"),
        row_rule(M7, "staged_telemetry_tokens_are_valid", "telemetry_stg", "telemetry_validation_status <> 'Valid'"),
    ]
    # ---- M8 reconciliation ----------------------------------------------------
    cr = "cost_reconciliation"
    c += [
        count_parity(M8, "fact_row_count_matches_cost_source", cr, "provider_cost_stg"),
        unique_grain(M8, "reconciliation_fact_grain_is_unique", cr, ["reconciliation_fact_id"]),
        row_rule(M8, "every_usage_line_has_one_monthly_rollup", cr,
                 "line_item_type = 'usage' AND usage_rollup_match_count <> 1"),
        row_rule(M8, "non_usage_lines_have_no_usage_estimate", cr,
                 "line_item_type <> 'usage' AND (usage_cost_estimate IS NOT NULL OR usage_to_reported_variance IS NOT NULL"
                 " OR usage_to_reported_variance_pct IS NOT NULL OR usage_reconciliation_status <> 'NOT_APPLICABLE')"),
        row_rule(M8, "all_reconciliation_exceptions_have_reason_codes", cr,
                 "exception_status = 'EXCEPTION' AND variance_reason_code IS NULL"),
        total_parity(M8, "provider_reported_total_reconciles",
                     [(_sum(cr, "provider_reported_cost"), _sum("provider_cost_stg", "provider_reported_cost"))], TOL6),
        total_parity(M8, "invoice_billed_total_reconciles",
                     [(_sum(cr, "invoice_billed_cost"), _sum("provider_cost_stg", "invoice_billed_cost"))], TOL6),
        total_parity(M8, "usage_estimate_total_reconciles",
                     [(_sum(cr, "usage_cost_estimate", USAGE), _sum("usage_cost_monthly", "usage_cost_estimate"))], TOL6),
        row_rule(M8, "no_unpriced_daily_rows_reach_reconciliation", cr,
                 "line_item_type = 'usage' AND COALESCE(unpriced_daily_row_count, 0) <> 0"),
        row_rule(M8, "all_reconciliation_currency_is_usd", cr,
                 "billing_currency <> 'USD' OR (line_item_type = 'usage' AND estimate_currency <> 'USD')"),
        no_orphans(M8, "monthly_usage_rollup_has_no_orphans", "usage_cost_monthly", "provider_cost_stg",
                   ["billing_month", "provider", "provider_project_id", "model"], where_b=USAGE),
        row_rule(M8, "status_values_are_controlled", cr,
                 "usage_reconciliation_status NOT IN ('PASS', 'EXCEPTION', 'NOT_APPLICABLE')"
                 " OR invoice_reconciliation_status NOT IN ('PASS', 'EXCEPTION')"
                 " OR exception_status NOT IN ('PASS', 'EXCEPTION')"),
    ]
    # ---- M9 allocation --------------------------------------------------------
    ud = "usage_daily"
    split = " OR ".join(
        f"ABS(MAX(CASE WHEN {'allocation_status' if app == 'Unallocated' else 'application_name'} = "
        f"'{'Unallocated' if app == 'Unallocated' else app}' THEN allocation_percentage END) - {pct}) > {TOL9}"
        for app, pct in SHARED_SPLIT)
    c += [
        group_rule(M9, "every_source_row_has_one_anchor", ud, ["source_usage_key"],
                   "count_if(source_measure_anchor_flag) <> 1"),
        count_parity(M9, "source_anchor_count_matches_priced_usage", ud, "usage_priced", where_b=PRICED,
                     agg_a="count_if(source_measure_anchor_flag)"),
        unique_grain(M9, "allocation_fact_grain_is_unique", ud, ["usage_allocation_fact_id"]),
        group_rule(M9, "distribution_percentage_equals_100_percent", ud, ["source_usage_key"],
                   f"ABS(MAX(total_distribution_percentage) - 1) > {TOL9}"),
        row_rule(M9, "allocation_percentage_is_valid", ud, "allocation_percentage <= 0 OR allocation_percentage > 1"),
        _alloc_rule("cost_allocation_reconciles_to_source", "source_usage_cost_estimate",
                    "allocated_usage_cost_estimate", "unallocated_usage_cost_estimate"),
        _alloc_rule("request_allocation_reconciles_to_source", "source_request_count",
                    "allocated_request_count", "unallocated_request_count"),
        _alloc_rule("input_token_allocation_reconciles_to_source", "source_total_input_tokens",
                    "allocated_total_input_tokens", "unallocated_total_input_tokens"),
        _alloc_rule("output_token_allocation_reconciles_to_source", "source_output_tokens",
                    "allocated_output_tokens", "unallocated_output_tokens"),
        _alloc_rule("reasoning_token_allocation_reconciles_to_source", "source_reasoning_tokens",
                    "allocated_reasoning_tokens", "unallocated_reasoning_tokens"),
        total_parity(M9, "source_cost_total_matches_priced_usage",
                     [(_sum(ud, "source_usage_cost_estimate"), _sum("usage_priced", "usage_cost_estimate", PRICED))], TOL6),
        group_rule(M9, "shared_key_has_60_30_10_split", ud, ["source_usage_key"], f"{split}",
                   where=f"api_key_id = '{SHARED_KEY}'"),
        row_rule(M9, "developer_ownership_change_is_respected", ud,
                 f"api_key_id = '{OWNER_CHANGE_KEY}' AND allocation_status = 'Allocated' AND ("
                 f"(usage_date < DATE '{OWNER_CHANGE_DATE}' AND cost_center <> '{CC_BEFORE}') OR "
                 f"(usage_date >= DATE '{OWNER_CHANGE_DATE}' AND cost_center <> '{CC_AFTER}'))"),
        row_rule(M9, "late_mapping_is_flagged_as_restatement", ud,
                 f"api_key_id = '{LATE_KEY}' AND usage_date < DATE '{LATE_RECORDED}' "
                 "AND allocation_status = 'Allocated' AND NOT is_historical_restatement"),
        row_rule(M9, "unmapped_key_is_fully_unallocated", ud,
                 f"api_key_id = '{UNMAPPED_KEY}' AND (allocation_status <> 'Unallocated' OR "
                 f"ABS(allocation_percentage - 1) > {TOL9} OR application_name <> 'Unallocated' OR "
                 "cost_center <> 'UNALLOCATED')"),
        row_rule(M9, "all_rows_are_usd_and_synthetic", ud, "billing_currency <> 'USD' OR NOT is_synthetic"),
    ]
    # ---- M10 telemetry --------------------------------------------------------
    tr = "telemetry_recon_daily"
    c += [
        unique_grain(M10, "daily_reconciliation_grain_is_unique", tr, ["telemetry_reconciliation_id"]),
        no_orphans(M10, "all_provider_usage_groups_are_represented", "usage_priced", tr, DAY, where_a=PRICED),
        no_orphans(M10, "all_telemetry_groups_are_represented", "telemetry_stg", tr, DAY, where_a=VALID),
        total_parity(M10, "provider_request_total_reconciles",
                     [(_sum(tr, "provider_request_count"), _sum("usage_priced", "request_count", PRICED))]),
        total_parity(M10, "provider_token_total_reconciles",
                     [(_sum(tr, "provider_total_tokens"),
                       _sum("usage_priced", "normalized_total_input_tokens + output_tokens", PRICED))]),
        total_parity(M10, "provider_cost_total_reconciles",
                     [(_sum(tr, "provider_usage_cost_estimate"), _sum("usage_priced", "usage_cost_estimate", PRICED))],
                     TOL6),
        total_parity(M10, "telemetry_attempt_total_reconciles",
                     [(_sum(tr, "telemetry_attempt_count"), ("telemetry_stg", "COUNT(*)", VALID))]),
        total_parity(M10, "telemetry_token_total_reconciles",
                     [(_sum(tr, "telemetry_total_tokens"),
                       _sum("telemetry_stg", "normalized_total_input_tokens + output_tokens", VALID))]),
        row_rule(M10, "logical_requests_have_one_final_attempt", tr,
                 "has_telemetry AND telemetry_logical_request_count <> telemetry_final_attempt_count"),
        row_rule(M10, "successful_requests_do_not_exceed_logical_requests", tr,
                 "telemetry_successful_logical_request_count > telemetry_logical_request_count"),
        row_rule(M10, "zero_provider_tokens_have_null_coverage", tr,
                 "COALESCE(provider_total_tokens, 0) = 0 AND telemetry_token_coverage_pct IS NOT NULL"),
        row_rule(M10, "untraceable_cost_is_valid", tr,
                 "untraceable_provider_usage_cost_estimate < 0 OR untraceable_provider_usage_cost_estimate > "
                 f"provider_usage_cost_estimate + {TOL9}"),
        row_rule(M10, "exceptions_have_reason_codes", tr,
                 "reconciliation_status = 'EXCEPTION' AND variance_reason_code IS NULL"),
        total_parity(M10, "monthly_summary_reconciles_to_daily", [
            (_sum("telemetry_coverage_monthly", "provider_usage_cost_estimate"), _sum(tr, "provider_usage_cost_estimate")),
            (_sum("telemetry_coverage_monthly", "telemetry_attempt_count"), _sum(tr, "telemetry_attempt_count")),
        ], TOL6),
    ]
    # ---- M11 token economics --------------------------------------------------
    te = "token_economics"
    c += [
        unique_grain(M11, "token_economics_grain_is_unique", te, ["token_economics_id"]),
        total_parity(M11, "usage_cost_total_reconciles",
                     [(_sum(te, "usage_cost_estimate"), _sum("usage_priced", "usage_cost_estimate", PRICED))], TOL6),
        total_parity(M11, "request_total_reconciles",
                     [(_sum(te, "request_count"), _sum("usage_priced", "request_count", PRICED))]),
        total_parity(M11, "input_token_total_reconciles",
                     [(_sum(te, "normalized_total_input_tokens"),
                       _sum("usage_priced", "normalized_total_input_tokens", PRICED))]),
        total_parity(M11, "output_and_reasoning_totals_reconcile", [
            (_sum(te, "output_tokens"), _sum("usage_priced", "output_tokens", PRICED)),
            (_sum(te, "reasoning_tokens"), _sum("usage_priced", "reasoning_tokens", PRICED))]),
        row_rule(M11, "reasoning_tokens_do_not_exceed_output", te, "reasoning_tokens > output_tokens"),
        row_rule(M11, "cache_share_is_null_or_between_zero_and_one", te,
                 "(normalized_total_input_tokens = 0 AND cache_read_share IS NOT NULL) OR cache_read_share < 0 "
                 "OR cache_read_share > 1"),
        row_rule(M11, "reasoning_overhead_is_null_or_between_zero_and_one", te,
                 "(output_tokens = 0 AND reasoning_overhead_pct IS NOT NULL) OR reasoning_overhead_pct < 0 "
                 "OR reasoning_overhead_pct > 1"),
        row_rule(M11, "batch_adoption_is_null_or_between_zero_and_one", te,
                 "(request_count = 0 AND batch_adoption_pct IS NOT NULL) OR batch_adoption_pct < 0 "
                 "OR batch_adoption_pct > 1"),
        row_rule(M11, "cost_per_token_metrics_are_valid", te,
                 "cost_per_million_input_tokens < 0 OR cost_per_million_output_tokens < 0 OR "
                 "cost_per_million_total_tokens < 0 OR estimated_cost_per_provider_request < 0"),
        row_rule(M11, "cache_savings_is_nonnegative_and_bounded", te,
                 f"estimated_cache_savings < 0 OR estimated_cache_savings > no_cache_baseline_cost + {TOL9}"),
        row_rule(M11, "batch_savings_is_nonnegative", te,
                 "estimated_batch_savings_opportunity < 0 OR nonbatch_rows_without_one_batch_rate <> 0"),
        total_parity(M11, "telemetry_failure_and_retry_costs_reconcile", [
            (_sum(te, "estimated_failed_attempt_cost"),
             _sum("telemetry_stg", "CASE WHEN attempt_status = 'failed' THEN usage_cost_estimate ELSE 0 END", VALID)),
            (_sum(te, "estimated_retry_cost"),
             _sum("telemetry_stg", "CASE WHEN is_retry_attempt THEN usage_cost_estimate ELSE 0 END", VALID))], TOL6),
        row_rule(M11, "financial_basis_and_currency_are_labeled", te,
                 "financial_basis <> 'usage_cost_estimate' OR billing_currency <> 'USD' OR "
                 "failure_cost_label <> 'Estimated from request telemetry'"),
    ]
    # ---- M12 application cost -------------------------------------------------
    ac = "application_cost"
    c += [
        unique_grain(M12, "application_cost_grain_is_unique", ac, ["application_cost_id"]),
        group_rule(M12, "every_financial_scope_has_one_source_anchor", ac, ["financial_source_scope_id"],
                   "count_if(source_measure_anchor_flag) <> 1"),
        total_parity(M12, "source_invoice_total_reconciles",
                     [(_sum(ac, "source_invoice_billed_cost"), _sum(cr, "invoice_billed_cost"))], TOL6),
        total_parity(M12, "source_reported_total_reconciles",
                     [(_sum(ac, "source_provider_reported_cost"), _sum(cr, "provider_reported_cost"))], TOL6),
        total_parity(M12, "source_usage_estimate_reconciles",
                     [(_sum(ac, "source_usage_cost_estimate", USAGE), _sum(cr, "usage_cost_estimate", USAGE))], TOL6),
        _scope_rule("invoice_allocation_reconciles_by_scope", "source_invoice_billed_cost",
                    "allocated_invoice_billed_cost", "unallocated_invoice_billed_cost"),
        _scope_rule("reported_allocation_reconciles_by_scope", "source_provider_reported_cost",
                    "allocated_provider_reported_cost", "unallocated_provider_reported_cost"),
        _scope_rule("usage_estimate_allocation_reconciles_by_scope", "source_usage_cost_estimate",
                    "allocated_usage_cost_estimate", "unallocated_usage_cost_estimate", USAGE),
        group_rule(M12, "usage_driver_shares_sum_to_one", ac, ["financial_source_scope_id"],
                   f"ABS(SUM(financial_allocation_share) - 1) > {TOL9}",
                   where="line_item_type = 'usage' AND eligible_driver_denominator > 0"),
        row_rule(M12, "allocation_status_matches_cost_columns", ac,
                 "(allocation_status = 'Allocated' AND unallocated_invoice_billed_cost <> 0) OR "
                 "(allocation_status = 'Unallocated' AND allocated_invoice_billed_cost <> 0) OR "
                 "(allocation_status = 'Financial scope retained' AND allocated_invoice_billed_cost <> 0)"),
        row_rule(M12, "non_usage_lines_remain_scope_retained", ac,
                 "line_item_type <> 'usage' AND (application_name <> 'Unallocated' OR department_name <> 'Unallocated'"
                 " OR cost_center <> 'UNALLOCATED' OR allocation_status <> 'Financial scope retained' OR "
                 "allocation_method <> 'scope_retained' OR allocated_invoice_billed_cost <> 0)"),
        no_orphans(M12, "every_usage_financial_scope_is_represented", cr, ac,
                   ["billing_month", "provider", "provider_project_id", "model", "line_item_scope", "line_item_type"],
                   where_a=USAGE, where_b=USAGE),
        group_rule(M12, "line_item_type_totals_reconcile", "line_item_totals", ["line_item_type"],
                   f"ABS(COALESCE(SUM(source_cost), 0) - COALESCE(SUM(distributed_cost), 0)) > {TOL6}"),
        must_exist(M12, "unallocated_cost_is_visible", ac,
                   "allocation_status IN ('Unallocated', 'Financial scope retained')"),
        must_exist(M12, "allocation_confidence_is_visible", ac, "allocation_confidence = 'medium'"),
        row_rule(M12, "currency_basis_and_synthetic_flag_are_valid", ac,
                 "billing_currency <> 'USD' OR financial_basis <> 'invoice_billed_cost' OR NOT is_synthetic"),
    ]
    # ---- M13 optimization -----------------------------------------------------
    op = "optimization"
    c += [
        unique_grain(M13, "recommendation_grain_is_unique", op, ["recommendation_id"]),
        row_rule(M13, "recommendation_types_are_controlled", op,
                 "optimization_type NOT IN ('BATCH_MIGRATION', 'RETRY_REDUCTION', 'TELEMETRY_COVERAGE', "
                 "'CACHE_REUSE_ASSESSMENT')"),
        row_rule(M13, "modeled_savings_are_not_negative", op, "modeled_monthly_savings < 0"),
        row_rule(M13, "identified_savings_annualize_monthly_savings", op,
                 "modeled_monthly_savings IS NOT NULL AND ABS(identified_annualized_savings - "
                 f"modeled_monthly_savings * 12) > {TOL6}"),
        row_rule(M13, "approved_implemented_realized_are_zero", op,
                 "approved_annualized_savings <> 0 OR implemented_annualized_savings <> 0 OR realized_savings <> 0 "
                 "OR is_approved OR is_implemented OR is_realized"),
        join_rule(M13, "batch_savings_match_token_economics", op, te, TE,
                  f"o.optimization_type = 'BATCH_MIGRATION' AND ABS(o.modeled_monthly_savings - "
                  f"t.estimated_batch_savings_opportunity) > {TOL6}"),
        join_rule(M13, "retry_savings_use_50_percent_target", op, te, TE,
                  f"o.optimization_type = 'RETRY_REDUCTION' AND ABS(o.modeled_monthly_savings - "
                  f"t.estimated_retry_cost * 0.50) > {TOL6}"),
        row_rule(M13, "unquantified_recommendations_have_no_modeled_savings", op,
                 "savings_stage = 'UNQUANTIFIED' AND (modeled_monthly_savings IS NOT NULL OR "
                 "identified_annualized_savings <> 0)"),
        row_rule(M13, "ready_recommendations_are_quantified", op,
                 "evaluation_gate_status = 'READY_FOR_EVALUATION' AND (modeled_monthly_savings IS NULL OR "
                 "modeled_monthly_savings <= 0 OR savings_stage <> 'IDENTIFIED')"),
        row_rule(M13, "retry_gate_respects_telemetry_coverage", op,
                 "optimization_type = 'RETRY_REDUCTION' AND ((telemetry_token_coverage_pct >= 0.95 AND "
                 "evaluation_gate_status <> 'READY_FOR_EVALUATION') OR (telemetry_token_coverage_pct < 0.95 AND "
                 "evaluation_gate_status <> 'HOLD_FOR_DATA'))"),
        row_rule(M13, "telemetry_recommendations_are_data_holds", op,
                 "optimization_type = 'TELEMETRY_COVERAGE' AND (evaluation_gate_status <> 'HOLD_FOR_DATA' OR "
                 "savings_stage <> 'UNQUANTIFIED' OR modeled_monthly_savings IS NOT NULL OR cost_at_risk < 0 OR "
                 "NOT requires_telemetry_remediation)"),
        row_rule(M13, "cache_recommendations_require_benchmark", op,
                 "optimization_type = 'CACHE_REUSE_ASSESSMENT' AND (evaluation_gate_status <> 'REQUIRES_BENCHMARK' "
                 "OR savings_stage <> 'UNQUANTIFIED' OR modeled_monthly_savings IS NOT NULL)"),
        row_rule(M13, "every_recommendation_has_rationale_and_assumption", op,
                 "recommendation_title IS NULL OR recommendation_rationale IS NULL OR gate_reason IS NULL OR "
                 "assumption_text IS NULL OR LENGTH(TRIM(recommendation_rationale)) = 0 OR "
                 "LENGTH(TRIM(assumption_text)) = 0"),
        row_rule(M13, "financial_basis_and_currency_are_valid", op,
                 "financial_basis <> 'usage_cost_estimate' OR billing_currency <> 'USD'"),
        row_rule(M13, "evaluation_ready_flag_matches_gate", op,
                 "evaluation_ready_flag <> CASE WHEN evaluation_gate_status = 'READY_FOR_EVALUATION' THEN 1 ELSE 0 END"),
        row_rule(M13, "identified_savings_only_come_from_quantified_types", op,
                 "identified_annualized_savings > 0 AND optimization_type NOT IN ('BATCH_MIGRATION', 'RETRY_REDUCTION')"),
    ]
    # ---- M14 unit economics ---------------------------------------------------
    ue = "unit_economics"
    c += [
        unique_grain(M14, "unit_economics_grain_is_unique", ue, ["unit_economics_id"]),
        count_parity(M14, "every_token_economics_row_is_represented", ue, te),
        total_parity(M14, "estimated_usage_cost_reconciles",
                     [(_sum(ue, "usage_cost_estimate"), _sum(te, "usage_cost_estimate"))], TOL6),
        total_parity(M14, "invoice_usage_cost_reconciles",
                     [(_sum(ue, "invoice_billed_usage_cost"), _sum(cr, "invoice_billed_cost", USAGE))], TOL6),
        total_parity(M14, "provider_reported_usage_cost_reconciles",
                     [(_sum(ue, "provider_reported_usage_cost"), _sum(cr, "provider_reported_cost", USAGE))], TOL6),
        total_parity(M14, "request_and_token_totals_reconcile", [
            (_sum(ue, "provider_request_count"), _sum(te, "request_count")),
            (_sum(ue, "total_tokens"), _sum(te, "total_tokens"))]),
        total_parity(M14, "telemetry_counts_reconcile", [
            (_sum(ue, "telemetry_attempt_count"), _sum(te, "telemetry_attempt_count")),
            (_sum(ue, "telemetry_logical_request_count"), _sum(te, "telemetry_logical_request_count")),
            (_sum(ue, "successful_logical_request_count"), _sum(te, "successful_logical_request_count"))]),
        row_rule(M14, "provider_request_unit_cost_formula_is_correct", ue,
                 "(provider_request_count = 0 AND invoice_cost_per_provider_request IS NOT NULL) OR "
                 "(provider_request_count > 0 AND ABS(invoice_cost_per_provider_request - "
                 "CASE WHEN provider_request_count > 0 THEN CAST(invoice_billed_usage_cost AS DOUBLE) / "
                 f"provider_request_count END) > {TOL9})"),
        row_rule(M14, "million_token_unit_cost_formula_is_correct", ue,
                 "(total_tokens = 0 AND invoice_cost_per_million_total_tokens IS NOT NULL) OR "
                 "(total_tokens > 0 AND ABS(invoice_cost_per_million_total_tokens - "
                 "CASE WHEN total_tokens > 0 THEN CAST(invoice_billed_usage_cost * 1000000 AS DOUBLE) / "
                 f"total_tokens END) > {TOL9})"),
        row_rule(M14, "insufficient_coverage_withholds_governed_metrics", ue,
                 "NOT telemetry_quality_gate_passed AND (governed_invoice_cost_per_logical_request IS NOT NULL OR "
                 "governed_invoice_cost_per_successful_request IS NOT NULL OR "
                 "governed_retry_cost_per_successful_request IS NOT NULL OR measurement_quality_status <> "
                 "'INSUFFICIENT' OR unit_economics_status <> 'LIMITED_TELEMETRY')"),
        row_rule(M14, "sufficient_coverage_publishes_valid_metrics", ue,
                 "telemetry_quality_gate_passed AND (measurement_quality_status <> 'SUFFICIENT' OR "
                 "unit_economics_status <> 'PUBLISHABLE' OR (telemetry_logical_request_count > 0 AND "
                 "governed_invoice_cost_per_logical_request IS NULL) OR (successful_logical_request_count > 0 AND "
                 "governed_invoice_cost_per_successful_request IS NULL))"),
        row_rule(M14, "observed_rates_are_null_or_between_zero_and_one", ue,
                 "observed_success_rate < 0 OR observed_success_rate > 1 OR observed_retry_attempt_rate < 0 OR "
                 "observed_retry_attempt_rate > 1 OR observed_failed_attempt_rate < 0 OR "
                 "observed_failed_attempt_rate > 1"),
        row_rule(M14, "attempts_per_logical_request_is_valid", ue,
                 "(telemetry_logical_request_count = 0 AND observed_attempts_per_logical_request IS NOT NULL) OR "
                 "(telemetry_logical_request_count > 0 AND observed_attempts_per_logical_request < 1)"),
        row_rule(M14, "retry_and_failure_costs_are_valid", ue,
                 "estimated_retry_cost < 0 OR estimated_failed_attempt_cost < 0 OR estimated_retry_cost > "
                 f"telemetry_usage_cost_estimate + {TOL6} OR estimated_failed_attempt_cost > "
                 f"telemetry_usage_cost_estimate + {TOL6}"),
        row_rule(M14, "measurement_status_matches_coverage_gate", ue,
                 "telemetry_quality_gate_passed <> (telemetry_token_coverage_pct BETWEEN 0.95 AND 1.05)"),
        row_rule(M14, "basis_currency_and_synthetic_flag_are_valid", ue,
                 "financial_basis <> 'invoice_billed_cost_usage_lines' OR operational_cost_basis <> "
                 "'usage_cost_estimate' OR billing_currency <> 'USD' OR retry_and_failure_cost_label <> "
                 "'Estimated from request telemetry' OR NOT is_synthetic"),
    ]
    # ---- M15 experiments --------------------------------------------------------
    ed, ex = "experiment_driver_daily", "experiments"
    c += [
        unique_grain(M15, "experiment_driver_grain_is_unique", ed, ["experiment_driver_id"]),
        unique_grain(M15, "experiment_governance_grain_is_unique", ex, ["experiment_governance_id"]),
        no_orphans(M15, "all_controlled_experiments_are_present", "experiment_control", ex, ["experiment_id"]),
        total_parity(M15, "driver_operational_cost_reconciles_to_experiment_telemetry", [
            (_sum(ed, "experiment_driver_cost_estimate"),
             _sum("telemetry_stg", "usage_cost_estimate", VALID + " AND experiment_id IS NOT NULL"))], TOL6),
        row_rule(M15, "experiment_driver_shares_are_valid", ed,
                 "financial_allocation_share < 0 OR financial_allocation_share > 1"),
        group_rule(M15, "experiment_shares_do_not_overallocate_financial_scope", ed,
                   ["billing_month", "provider", "provider_project_id", "model"],
                   "SUM(financial_allocation_share) > 1.000000001"),
        group_rule(M15, "experiment_invoice_cost_does_not_exceed_usage_invoice", ed,
                   ["billing_month", "provider", "provider_project_id", "model"],
                   f"SUM(allocated_invoice_billed_experiment_cost) > MAX(monthly_invoice_billed_usage_cost) + {TOL6}"),
        row_rule(M15, "experiment_driver_formula_is_correct", ed,
                 "ABS(allocated_invoice_billed_experiment_cost - CAST(monthly_invoice_billed_usage_cost AS DOUBLE) "
                 f"* financial_allocation_share) > {TOL6}"),
        row_rule(M15, "evaluation_dates_respect_control_window", ex,
                 "evaluation_date < start_date OR evaluation_date > planned_end_date OR period_start_date < start_date"
                 " OR period_end_date > planned_end_date OR period_start_date > period_end_date"),
        row_rule(M15, "limit_period_shapes_are_correct", ex,
                 "(spending_limit_period = 'day' AND (period_start_date <> evaluation_date OR period_end_date <> "
                 "evaluation_date)) OR (spending_limit_period = 'lifetime' AND period_start_date <> start_date) OR "
                 "spending_limit_period NOT IN ('day', 'month', 'lifetime')"),
        row_rule(M15, "threshold_formulas_are_correct", ex,
                 f"ABS(warning_spend_threshold - spending_limit * warning_threshold) > {TOL6} OR "
                 f"ABS(hard_stop_spend_threshold - spending_limit * hard_stop_threshold) > {TOL6}"),
        row_rule(M15, "threshold_status_matches_spend", ex,
                 "(period_invoice_billed_experiment_cost >= hard_stop_spend_threshold AND threshold_status <> "
                 "'HARD_STOP') OR (period_invoice_billed_experiment_cost < hard_stop_spend_threshold AND "
                 "period_invoice_billed_experiment_cost >= warning_spend_threshold AND threshold_status <> 'WARNING')"
                 " OR (period_invoice_billed_experiment_cost < warning_spend_threshold AND threshold_status <> "
                 "'WITHIN_LIMIT')"),
        row_rule(M15, "decision_as_of_date_is_not_from_the_future", ex, "latest_decision_date > evaluation_date"),
        row_rule(M15, "final_decision_status_aligns_with_control", ex,
                 "evaluation_date = planned_end_date AND decision_status_as_of_date <> source_current_status"),
        row_rule(M15, "governance_exceptions_have_reasons", ex,
                 "governance_exception_status = 'EXCEPTION' AND governance_exception_reason IS NULL"),
        row_rule(M15, "hard_stop_action_status_is_consistent", ex,
                 "(threshold_status = 'HARD_STOP' AND decision_status_as_of_date = 'stopped' AND "
                 "governance_action_status <> 'HARD_STOP_COMPLIANT') OR (threshold_status = 'HARD_STOP' AND "
                 "COALESCE(decision_status_as_of_date, '') <> 'stopped' AND governance_action_status <> "
                 "'HARD_STOP_ACTION_REQUIRED')"),
        row_rule(M15, "decision_financial_mismatch_is_explicit", ex,
                 "decision_financial_evidence_status = 'FINANCIAL_EVIDENCE_MISMATCH' AND "
                 "governance_exception_status <> 'EXCEPTION'"),
        row_rule(M15, "financial_basis_currency_and_nonusage_exclusion_are_valid", ex,
                 "financial_basis <> 'allocated_invoice_billed_cost_usage_lines_only' OR operational_basis <> "
                 "'request_telemetry_usage_cost_estimate' OR limit_currency <> 'USD'"),
    ]
    # ---- M16 end-to-end -------------------------------------------------------------
    c += [
        count_parity(M16, "E2E-01", "raw_usage", "usage_priced"),
        count_parity(M16, "E2E-02", "raw_cost", cr),
        count_parity(M16, "E2E-03", "raw_telemetry", "telemetry_stg"),
        unique_grain(M16, "E2E-04", "raw_usage", USAGE_GRAIN),
        unique_grain(M16, "E2E-05", "raw_cost", COST_GRAIN),
        unique_grain(M16, "E2E-06", "raw_telemetry", ["provider_request_id"]),
        row_rule(M16, "E2E-07", "usage_priced",
                 "model_map_match_count <> 1 OR service_tier_match_count <> 1 OR rate_match_count <> 1 OR "
                 "token_validation_status <> 'Valid' OR pricing_status <> 'Priced' OR usage_cost_estimate IS NULL OR "
                 "usage_cost_estimate < 0 OR usage_date NOT BETWEEN model_map_effective_start AND "
                 "model_map_effective_end OR usage_date NOT BETWEEN rate_effective_start AND rate_effective_end"),
        total_parity(M16, "E2E-08", [(_sum(cr, "usage_cost_estimate", USAGE),
                                      _sum("usage_priced", "usage_cost_estimate", PRICED))], TOL6),
        total_parity(M16, "E2E-09", [(_sum(cr, "provider_reported_cost"), _sum("raw_cost", "provider_reported_cost"))],
                     TOL6),
        total_parity(M16, "E2E-10", [(_sum(cr, "invoice_billed_cost"), _sum("raw_cost", "invoice_billed_cost"))], TOL6),
        _alloc_rule("E2E-11", "source_usage_cost_estimate", "allocated_usage_cost_estimate",
                    "unallocated_usage_cost_estimate", stage=M16),
        total_parity(M16, "E2E-12", [(_sum(tr, "provider_usage_cost_estimate"),
                                      _sum("usage_priced", "usage_cost_estimate", PRICED))], TOL6),
        total_parity(M16, "E2E-13", [  # one verdict, 0 or 1
            (_sum(te, "usage_cost_estimate"), _sum("usage_priced", "usage_cost_estimate", PRICED)),
            (_sum(te, "total_tokens"), _sum("usage_priced", "normalized_total_input_tokens + output_tokens", PRICED))], TOL6),
        _scope_rule("E2E-14", "source_invoice_billed_cost", "allocated_invoice_billed_cost",
                    "unallocated_invoice_billed_cost", stage=M16),
        row_rule(M16, "E2E-15", op,
                 "approved_annualized_savings <> 0 OR implemented_annualized_savings <> 0 OR realized_savings <> 0 "
                 "OR is_approved OR is_implemented OR is_realized"),
        composite(M16, "E2E-16", [
            total_parity(M16, "-", [(_sum(ue, "invoice_billed_usage_cost"), _sum(cr, "invoice_billed_cost", USAGE))],
                         TOL6),
            row_rule(M16, "-", ue, "measurement_quality_status = 'INSUFFICIENT' AND "
                     "(governed_invoice_cost_per_logical_request IS NOT NULL OR "
                     "governed_invoice_cost_per_successful_request IS NOT NULL OR "
                     "governed_retry_cost_per_successful_request IS NOT NULL)")]),
        composite(M16, "E2E-17", [
            no_orphans(M16, "-", "experiment_control", ex, ["experiment_id"]),
            row_rule(M16, "-", ex, "governance_exception_status = 'EXCEPTION' AND governance_exception_reason IS NULL")]),
        row_rule(M16, "E2E-18", "pipeline_status", "status <> 'PASS'"),
    ]
    # ---- M17 semantic -------------------------------------------------------------
    facts = ["fact_financial_monthly", "fact_usage_monthly", "fact_unit_economics_monthly",
             "fact_optimization_monthly"]
    c += [
        composite(M17, "date_dimension_is_unique_and_complete", [
            unique_grain(M17, "-", "dim_date", ["date_key"]),
            count_parity(M17, "-", "dim_date", "dim_date", agg_b=f"MIN({(K.PERIOD_END - K.PERIOD_START).days + 1})")]),
        unique_grain(M17, "provider_dimension_key_is_unique", "dim_provider", ["provider_key"]),
        unique_grain(M17, "model_dimension_key_is_unique", "dim_model", ["model_key"]),
        unique_grain(M17, "application_dimension_key_is_unique", "dim_application", ["application_key"]),
        unique_grain(M17, "experiment_dimension_key_is_unique", "dim_experiment", ["experiment_key"]),
        total_parity(M17, "financial_fact_reconciles_to_application_cost", [
            (_sum("fact_financial_monthly", "invoice_billed_cost"),
             _sum(ac, "COALESCE(allocated_invoice_billed_cost, 0) + COALESCE(unallocated_invoice_billed_cost, 0)"))],
            TOL6),
        total_parity(M17, "usage_fact_reconciles_to_token_economics", [
            (_sum("fact_usage_monthly", "usage_cost_estimate"), _sum(te, "usage_cost_estimate"))], TOL6),
        total_parity(M17, "unit_economics_fact_reconciles", [
            (_sum("fact_unit_economics_monthly", "invoice_billed_usage_cost"), _sum(ue, "invoice_billed_usage_cost"))],
            TOL6),
        total_parity(M17, "optimization_fact_reconciles", [
            (_sum("fact_optimization_monthly", "identified_annualized_savings"),
             _sum(op, "identified_annualized_savings"))], TOL6),
        unique_grain(M17, "experiment_current_has_one_row_per_experiment", "fact_experiment_current",
                     ["experiment_key"]),
        composite(M17, "all_fact_provider_keys_resolve",
                  [no_orphans(M17, "-", f, "dim_provider", ["provider_key"], rows=True) for f in facts]),
        composite(M17, "all_fact_model_keys_resolve",
                  [no_orphans(M17, "-", f, "dim_model", ["model_key"], rows=True) for f in facts]),
    ]
    return c


# ---------------------------------------------------------------------------
# evaluation
# ---------------------------------------------------------------------------

def _one_call(agg: str) -> bool:
    """A single aggregate call, which can take the filter of its rows itself."""
    if "DISTINCT" in agg or not re.fullmatch(r"\w+\(.*\)", agg, re.DOTALL):
        return False
    depth = 0
    for i, ch in enumerate(agg):
        depth += (ch == "(") - (ch == ")")
        if ch == ")" and not depth:
            return i == len(agg) - 1
    return False


def _source_key(src, agg):
    """Scalars over the same source are computed in one aggregate pass:
    plain tables by (table, filter); HAVING rules by (table, keys, filter)."""
    kind = type(src).__name__
    if kind == "Table":
        return ("T", src.name, None if _one_call(agg) else src.where, "DISTINCT" in agg and (agg, src.where))
    if kind == "Groups":
        return ("G", src.name, src.keys, src.where)
    return ("X", id(src))


def _measure(p, controls: list[Control]) -> tuple[DataFrame, list[str]]:
    """(scalar, value) rows, and each control's formula over its scalars' names.

    Every scalar of every control is grouped by its source; each source is
    scanned ONCE with all of its aggregates (HAVING rules on the same table
    and keys become boolean columns of one grouped pass).  Each source yields
    (scalar, value) rows; one grouping by control then applies its formula, so
    the suite is a union of scans without a cross join.  Distinct counts are
    kept apart from the row rules of their table, which then need no shuffle
    of rows."""
    groups: dict[tuple, list[tuple[str, object]]] = {}
    renamed: list[str] = []
    for ci, ct in enumerate(controls):
        expr = ct.combine
        for name in sorted(ct.scalars, key=len, reverse=True):
            col = f"s{ci}_{name}"
            expr = re.sub(rf"\b{name}\b", col, expr)
            s = ct.scalars[name]
            groups.setdefault(_source_key(s.source, s.agg), []).append((col, s))
        renamed.append(expr)
    measured = None
    for key, items in groups.items():
        src = items[0][1].source
        if key[0] == "G":
            table = getattr(p, src.name)
            if src.where:
                table = table.filter(F.expr(src.where))
            flags = table.groupBy(*src.keys).agg(
                *[F.expr(s.source.having).alias(f"h_{col}") for col, s in items])
            one = flags.agg(*[F.count_if(F.col(f"h_{col}")).alias(col) for col, _ in items])
        elif key[0] == "T" and key[2] is None and not key[3]:  # filters ride on the aggregates: one scan a table
            one = getattr(p, src.name).agg(*[F.expr(s.agg + (f" FILTER (WHERE {s.source.where})" if s.source.where else "")).alias(col)
                                             for col, s in items])
        else:
            one = src.spark(p).agg(*[F.expr(s.agg).alias(col) for col, s in items])
        cells = ", ".join(f"'{col}', CAST({col} AS DECIMAL(38,9))" for col, _ in items)
        part = one.select(F.expr(f"stack({len(items)}, {cells})").alias("scalar", "value"))
        measured = part if measured is None else measured.unionByName(part)

    return measured, renamed


def evaluate(p, controls: list[Control] | None = None) -> DataFrame:
    """One row per control: pipeline_name, control_id, control_class,
    violation_count, status (PASS iff 0).  See ``_measure`` for the scans."""
    controls = controls if controls is not None else catalogue()
    measured, renamed = _measure(p, controls)
    # one row a control: its own scalars side by side, then its formula
    owner = p.spark.createDataFrame(
        [(f"s{ci}_{name}", ci) for ci, ct in enumerate(controls) for name in ct.scalars], "scalar string, control int")
    values = measured.join(F.broadcast(owner), "scalar").groupBy("control").agg(
        F.map_from_entries(F.collect_list(F.struct("scalar", "value"))).alias("v"))  # a few scalars each
    formulas = []
    for ci, (ct, expr) in enumerate(zip(controls, renamed)):
        for name in sorted(ct.scalars, key=len, reverse=True):
            expr = re.sub(rf"\bs{ci}_{name}\b", f"v['s{ci}_{name}']", expr)
        formulas.append((ci, ct, expr))
    cases = " ".join(f"WHEN {ci} THEN CAST({expr} AS BIGINT)" for ci, _, expr in formulas)
    names = p.spark.createDataFrame([(ci, ct.stage, ct.control_id, ct.klass) for ci, ct, _ in formulas],
                                    "control int, pipeline_name string, control_id string, control_class string")
    out = names.join(values, "control").select(
        "pipeline_name", "control_id", "control_class", F.expr(f"CASE control {cases} END").alias("violation_count"))
    return out.withColumn("status", F.when(F.col("violation_count") == 0, "PASS").otherwise("FAIL"))


def verdicts(p, controls: list[Control]) -> list[tuple[Control, int]]:
    """The violation count of each control, for a stage's gate: the scalars (a few a control)
    come to the driver in one collect, the formulas are constants for the optimizer."""
    measured, renamed = _measure(p, controls)
    cells = {r["scalar"]: r["value"] for r in measured.collect()}
    if not controls:
        return []
    literal = {k: "CAST(NULL AS DECIMAL(38,9))" if v is None else f"CAST('{v}' AS DECIMAL(38,9))" for k, v in cells.items()}
    exprs = [f"CAST({re.sub(r'[$]?\bs[0-9]+_[A-Za-z0-9_]+', lambda m: literal.get(m[0], m[0]), e)} AS BIGINT) AS v{i}" for i, e in enumerate(renamed)]
    row = p.spark.sql("SELECT " + ", ".join(exprs)).first()
    return [(c, row[f"v{i}"]) for i, c in enumerate(controls)]


def evaluate_sql(controls: list[Control] | None = None) -> str:
    controls = controls if controls is not None else catalogue()
    parts = [f"SELECT '{ct.stage}' AS pipeline_name, '{ct.control_id}' AS control_id, "
             f"'{ct.klass}' AS control_class, violation_count FROM ({ct.sql()}) x" for ct in controls]
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT *, CASE WHEN violation_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
            f"FROM (\n{body}\n) r")
