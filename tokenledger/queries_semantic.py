"""Registered semantic-layer queries."""

from __future__ import annotations

from functools import partial

from tokenledger.plans.semantic import (EXP_CURRENT_COLS, FIN_KEYS, OPT_FACT_COLS, UNIT_FACT_COLS,
                                        USAGE_FACT_COLS)
from tokenledger.queries import DEC, register as _register

register = partial(_register, shared=True)  # these start from models that others use too

_MONEYISH = {"usage_cost_estimate", "provider_reported_cost", "invoice_billed_cost", "allocated_invoice_billed_cost",
             "unallocated_invoice_billed_cost", "distributed_request_count", "distributed_total_input_tokens",
             "distributed_output_tokens", "distributed_reasoning_tokens", "estimated_input_cost",
             "estimated_output_cost", "estimated_reasoning_output_cost", "no_cache_baseline_cost",
             "estimated_cache_savings", "estimated_batch_savings_opportunity", "telemetry_usage_cost_estimate",
             "estimated_retry_cost", "estimated_failed_attempt_cost", "estimated_mid_generation_failure_cost",
             "invoice_billed_usage_cost", "provider_reported_usage_cost", "untraceable_provider_usage_cost_estimate",
             "eligible_cost_base", "cost_at_risk", "modeled_monthly_savings", "identified_annualized_savings",
             "approved_annualized_savings", "implemented_annualized_savings", "realized_savings",
             "spending_limit", "period_invoice_billed_experiment_cost", "period_provider_reported_experiment_cost",
             "period_driver_cost_estimate", "period_estimated_retry_cost"}


def spec(cols):
    return [(c, DEC) if c in _MONEYISH else c for c in cols]


_KEYS = ["date_key", "provider_key", "model_key", "billing_month", "provider", "provider_project_id", "model",
         "model_snapshot", "usage_type"]

register("dim_date", "dim_date", [
    "date_key", "date", "year", "quarter_number", "quarter_name", "month_number", "month_name", "month_short_name",
    "year_month", "year_month_sort", "month_start_date", "month_end_date", "day_of_month", "day_name",
    "day_of_week_number"])
register("dim_provider", "dim_provider", ["provider_key", "provider", "provider_display_name"])
register("dim_model", "dim_model", ["model_key", "provider", "model", "model_snapshot", "usage_type",
                                    "provider_model_label"])
register("dim_application", "dim_application", ["application_key", "application_name", "department_name",
                                                "cost_center", "is_unallocated"])
register("fact_financial_monthly", "fact_financial_monthly", spec(
    ["financial_monthly_id", "date_key", "provider_key", "model_key", "application_key"] + FIN_KEYS + [
        "has_historical_restatement", "distributed_request_count", "distributed_total_input_tokens",
        "distributed_output_tokens", "distributed_reasoning_tokens", "usage_cost_estimate", "provider_reported_cost",
        "invoice_billed_cost", "allocated_invoice_billed_cost", "unallocated_invoice_billed_cost", "billing_currency",
        "financial_basis"]))
register("fact_usage_monthly", "fact_usage_monthly", spec(["usage_monthly_id"] + _KEYS + USAGE_FACT_COLS))
register("fact_unit_economics_monthly", "fact_unit_economics_monthly",
         spec(["unit_economics_id"] + _KEYS + UNIT_FACT_COLS))
register("fact_optimization_monthly", "fact_optimization_monthly",
         spec(["recommendation_id"] + _KEYS + OPT_FACT_COLS))
register("fact_experiment_current", "fact_experiment_current",
         spec(["experiment_key", "date_key"] + EXP_CURRENT_COLS))
