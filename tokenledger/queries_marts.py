"""Registered mart queries (P07, P12-P17) and their operator views."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tokenledger.queries import DEC, register as _register

register = partial(_register, shared=True)  # these start from models that others use too

MK = ["billing_month", "provider", "provider_project_id", "model"]
TEK = MK + ["model_snapshot", "usage_type"]

register("telemetry_coverage_monthly", "telemetry_coverage_monthly", MK + [
    "usage_type", "provider_request_count", "telemetry_attempt_count", "telemetry_logical_request_count",
    "telemetry_successful_logical_request_count", "telemetry_retry_attempt_count", "provider_total_tokens",
    "telemetry_total_tokens", ("provider_usage_cost_estimate", DEC), ("telemetry_usage_cost_estimate", DEC),
    ("telemetry_retry_cost_estimate", DEC), ("telemetry_failed_attempt_cost_estimate", DEC),
    ("untraceable_provider_usage_cost_estimate", DEC), "telemetry_token_coverage_pct",
    "telemetry_request_coverage_pct", "request_count_variance", "token_count_variance", "exception_day_count",
    "observed_day_count"])

register("token_economics", "token_economics", ["token_economics_id"] + TEK + [
    "source_daily_row_count", "request_count", "batch_request_count", "nonbatch_request_count",
    "normalized_total_input_tokens", "normalized_cache_read_tokens", "output_tokens", "reasoning_tokens",
    "total_tokens", ("usage_cost_estimate", DEC), ("estimated_input_cost", DEC), ("estimated_output_cost", DEC),
    ("estimated_reasoning_output_cost", DEC), ("no_cache_baseline_cost", DEC),
    "nonbatch_rows_without_one_batch_rate", "cache_read_share", "reasoning_overhead_pct", "batch_adoption_pct",
    "cost_per_million_input_tokens", "cost_per_million_output_tokens", "cost_per_million_total_tokens",
    "estimated_cost_per_provider_request", "telemetry_attempt_count", "telemetry_logical_request_count",
    "successful_logical_request_count", "retry_attempt_count", "failed_attempt_count",
    ("telemetry_usage_cost_estimate", DEC), ("estimated_retry_cost", DEC), ("estimated_failed_attempt_cost", DEC),
    ("estimated_mid_generation_failure_cost", DEC), "failed_attempt_cost_share", "retry_cost_share"])

register("cache_savings", "token_economics", ["token_economics_id"] + TEK + [
    ("no_cache_baseline_cost", DEC), ("usage_cost_estimate", DEC), ("estimated_cache_savings", DEC),
    "cache_read_share"])

register("batch_opportunity", "token_economics", ["token_economics_id"] + TEK + [
    "batch_request_count", "nonbatch_request_count", ("estimated_batch_savings_opportunity", DEC),
    "batch_adoption_pct", "nonbatch_rows_without_one_batch_rate"])

_APP = ["application_cost_id", "financial_source_scope_id"] + MK + [
    "model_snapshot", "usage_type", "line_item_scope", "line_item_type", "application_name", "department_name",
    "cost_center", "allocation_status", "allocation_method", "allocation_confidence", "is_historical_restatement",
    "is_restatement", "source_line_count", ("driver_usage_cost_estimate", DEC), ("eligible_driver_denominator", DEC),
    "financial_allocation_share", ("distributed_request_count", DEC), ("distributed_total_input_tokens", DEC),
    "source_measure_anchor_flag", ("source_usage_cost_estimate", DEC), ("source_provider_reported_cost", DEC),
    ("source_invoice_billed_cost", DEC), ("allocated_usage_cost_estimate", DEC),
    ("unallocated_usage_cost_estimate", DEC), ("allocated_provider_reported_cost", DEC),
    ("unallocated_provider_reported_cost", DEC), ("allocated_invoice_billed_cost", DEC),
    ("unallocated_invoice_billed_cost", DEC), "cost_basis_label"]

register("application_cost", "application_cost", _APP)
register("application_cost_gaps", "application_cost_gaps", _APP)
register("zero_driver_fallback", "application_cost_gaps", _APP,
         where="allocation_method = 'no_eligible_driver'",
         spark_filter=lambda: F.col("allocation_method") == "no_eligible_driver")
register("scope_retained_lines", "application_cost", _APP,
         where="allocation_status = 'Financial scope retained'",
         spark_filter=lambda: F.col("allocation_status") == "Financial scope retained")

register("optimization_recommendations", "optimization", ["recommendation_id"] + TEK + [
    "optimization_type", "recommendation_title", "recommendation_rationale", ("eligible_cost_base", DEC),
    ("cost_at_risk", DEC), ("modeled_monthly_savings", DEC), ("identified_annualized_savings", DEC),
    ("realized_savings", DEC), "savings_stage", "evaluation_gate_status", "gate_reason", "savings_confidence",
    "estimation_method", "telemetry_token_coverage_pct", "measurement_quality_status",
    "requires_telemetry_remediation", "evaluation_ready_flag", "recommendation_generated_date"])

register("unit_economics", "unit_economics", ["unit_economics_id"] + TEK + [
    "financial_usage_line_count", "provider_request_count", "total_tokens", ("usage_cost_estimate", DEC),
    ("reconciled_usage_cost_estimate", DEC), ("provider_reported_usage_cost", DEC),
    ("invoice_billed_usage_cost", DEC), ("invoice_to_estimate_variance", DEC), "invoice_to_estimate_variance_pct",
    "telemetry_token_coverage_pct", "telemetry_quality_gate_passed", "invoice_cost_per_provider_request",
    "invoice_cost_per_thousand_provider_requests", "invoice_cost_per_million_total_tokens",
    "invoice_cost_per_million_input_tokens", "invoice_cost_per_million_output_tokens",
    "governed_invoice_cost_per_logical_request", "governed_invoice_cost_per_successful_request",
    "observed_success_rate", "observed_retry_attempt_rate", "observed_failed_attempt_rate",
    "observed_attempts_per_logical_request", "average_tokens_per_provider_request", "reasoning_overhead_pct",
    "estimated_retry_cost_share", "governed_retry_cost_per_successful_request", "measurement_quality_status",
    "unit_economics_status"])

register("experiment_driver_daily", "experiment_driver_daily", [
    "experiment_driver_id", "usage_date", "billing_month", "provider", "provider_project_id", "model",
    "experiment_id", "telemetry_attempt_count", "telemetry_logical_request_count",
    "successful_logical_request_count", "retry_attempt_count", "telemetry_total_tokens",
    ("experiment_driver_cost_estimate", DEC), ("estimated_retry_cost", DEC),
    ("monthly_usage_cost_estimate", DEC), ("monthly_invoice_billed_usage_cost", DEC),
    "telemetry_token_coverage_pct", "financial_allocation_share",
    ("allocated_provider_reported_experiment_cost", DEC), ("allocated_invoice_billed_experiment_cost", DEC),
    "measurement_quality_status", "spend_quality_label"])

register("experiment_calendar", "experiment_daily", [
    "experiment_id", "spending_limit_period", "calendar_date", ("daily_invoice_billed_experiment_cost", DEC),
    ("daily_provider_reported_experiment_cost", DEC), ("daily_driver_cost_estimate", DEC),
    "daily_telemetry_attempt_count", "daily_logical_request_count", "daily_successful_request_count",
    "daily_retry_attempt_count", ("daily_estimated_retry_cost", DEC), "daily_measurement_quality_status",
    "daily_spend_quality_label"])

register("experiment_periods", "experiment_periods", [
    "experiment_id", "spending_limit_period", "evaluation_date", "period_start_date", "period_end_date",
    ("period_invoice_billed_experiment_cost", DEC), ("period_provider_reported_experiment_cost", DEC),
    ("period_driver_cost_estimate", DEC), "period_telemetry_attempt_count", "period_logical_request_count",
    "period_successful_request_count", "period_retry_attempt_count", ("period_estimated_retry_cost", DEC),
    "period_measurement_quality_status", "period_spend_quality_label"])

register("experiment_thresholds", "experiments", [
    "experiment_governance_id", "experiment_id", "evaluation_date", ("spending_limit", DEC),
    ("warning_spend_threshold", DEC), ("hard_stop_spend_threshold", DEC), "spend_to_limit_pct", "threshold_status",
    ("max_period_spend_to_date", DEC), "first_warning_date", "first_hard_stop_date"])

register("experiment_asof_decision", "experiments", [
    "experiment_governance_id", "experiment_id", "evaluation_date", "latest_experiment_decision_id",
    "latest_decision", "latest_decision_date", "latest_decided_by", "latest_previous_status",
    "decision_status_as_of_date"])

register("experiment_governance", "experiments", [
    "experiment_governance_id", "experiment_id", "spending_limit_period", "evaluation_date", "period_start_date",
    "period_end_date", ("period_invoice_billed_experiment_cost", DEC), "threshold_status",
    "governance_action_status", "decision_financial_evidence_status", "governance_exception_reason",
    "governance_exception_status", "observed_success_rate", "observed_retry_attempt_rate",
    "invoice_cost_per_successful_request"])
