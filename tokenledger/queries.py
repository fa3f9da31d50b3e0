"""Registered queries: each is a Spark plan over a Pipeline plus the DuckDB
oracle text that computes the same rows.

A query publishes a projection described once by a column spec; the spec
renders both the Spark select and the SQL select, so names and value types
(money and fixed-point quantities as DOUBLE of a 6-decimal value) agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.functions.numeric import as_double
from tokenledger.oracle import compose
from tokenledger.oracle.sqlfn import dbl
from tokenledger.plans.pipeline import Pipeline

DEC = "dec"  # decimal published as DOUBLE of its 6-decimal rounding


@dataclass
class Query:
    name: str
    build: Callable[[Pipeline], DataFrame]
    sql: str | None
    layered: bool = False  # runs on deployed, audited layers and their logs
    shared: bool = False  # starts from shared models, written once a session


REGISTRY: dict[str, Query] = {}


def spec_spark(spec) -> list:
    out = []
    for s in spec:
        if isinstance(s, tuple):
            name, kind = s
            out.append(as_double(F.col(name)).alias(name) if kind == DEC else F.col(name).alias(name))
        else:
            out.append(F.col(s))
    return out


def spec_sql(spec) -> str:
    out = []
    for s in spec:
        if isinstance(s, tuple):
            name, kind = s
            out.append(f"{dbl(name)} AS {name}" if kind == DEC else name)
        else:
            out.append(s)
    return ", ".join(out)


def register(name: str, model: str, spec, where: str | None = None, sql_model: str | None = None,
             spark_filter=None, layered: bool = False, shared: bool = False):
    """Register a projection of a pipeline model."""
    def build(p: Pipeline) -> DataFrame:
        df = getattr(p, model)
        if spark_filter is not None:
            df = df.filter(spark_filter())
        return df.select(*spec_spark(spec))
    sql = f"SELECT {spec_sql(spec)} FROM {sql_model or model}" + (f" WHERE {where}" if where else "")
    REGISTRY[name] = Query(name, build, compose(sql), layered, shared)


def register_custom(name: str, build: Callable[[Pipeline], DataFrame], sql: str | None,
                    layered: bool = False, shared: bool = False):
    REGISTRY[name] = Query(name, build, compose(sql) if sql else None, layered, shared)


# ---------------------------------------------------------------------------
# raw feeds and staging
# ---------------------------------------------------------------------------
USAGE_GRAIN = ["usage_date", "provider", "usage_type", "provider_project_id", "api_key_id", "model",
               "provider_service_tier", "is_batch", "context_window_tier"]

register("provider_usage_feed", "raw_usage", USAGE_GRAIN + [
    "request_count", "input_tokens", "output_tokens", "reasoning_tokens", "cached_input_tokens",
    "uncached_input_tokens", "cache_read_input_tokens", "cache_creation_5m_tokens",
    "cache_creation_1h_tokens", "is_synthetic"])

register("request_telemetry_feed", "raw_telemetry", [
    "provider_request_id", "logical_request_id", "attempt_number", "attempt_status", "is_final_attempt",
    "final_request_status", "retry_reason", "usage_date", "provider", "provider_project_id", "api_key_id",
    "application_name", "experiment_id", "model", "failure_stage", "input_tokens", "output_tokens",
    "reasoning_tokens", "cached_input_tokens", "uncached_input_tokens", "cache_read_input_tokens",
    "cache_creation_5m_tokens", "cache_creation_1h_tokens", ("usage_cost_estimate", DEC)])

register("provider_cost_feed", "raw_cost", [
    "billing_period", "provider", "provider_project_id", "model", "line_item_scope", "line_item_type",
    "provider_line_item_id", ("provider_reported_cost", DEC), ("invoice_billed_cost", DEC),
    "billing_currency", ("credit_amount", DEC), "adjustment_reason", "invoice_issue_date",
    "is_restatement"])

register("effective_lookup_model", "usage_normalized", [
    "source_usage_key", "usage_date", "provider", "model", "model_map_match_count", "model_snapshot",
    "model_map_effective_start", "model_map_effective_end", "reasoning_capable",
    "model_map_resolution_status", "service_tier_match_count", "normalized_processing_tier",
    "service_tier_resolution_status"])

register("normalize_tokens", "usage_normalized", [
    "source_usage_key", "provider", "normalized_total_input_tokens", "normalized_uncached_input_tokens",
    "normalized_cache_read_tokens", "normalized_cache_creation_5m_tokens",
    "normalized_cache_creation_1h_tokens", "provider_total_tokens", "visible_output_tokens",
    "reasoning_tokens", "token_validation_status"])

register("effective_lookup_rate", "usage_priced", [
    "source_usage_key", "model_snapshot", "is_batch", "rate_match_count", "rate_effective_start",
    "rate_effective_end", ("input_rate_per_million", DEC), ("cached_input_rate_per_million", DEC),
    ("cache_write_5m_rate_per_million", DEC), ("cache_write_1h_rate_per_million", DEC),
    ("output_rate_per_million", DEC), ("contracted_discount", DEC), "rate_currency", "rate_status"])

register("price_usage", "usage_priced", [
    "source_usage_key", "usage_date", "provider", "provider_project_id", "api_key_id", "model",
    "model_snapshot", "is_batch", "normalized_total_input_tokens", "output_tokens",
    ("usage_cost_estimate", DEC), "pricing_status"])

register("staged_provider_cost", "provider_cost_stg", [
    "billing_period", "billing_month", "provider", "provider_project_id", "model", "line_item_scope",
    "line_item_type", "provider_line_item_id", ("provider_reported_cost", DEC),
    ("invoice_billed_cost", DEC), "billing_currency", "adjustment_reason",
    "usage_reconciliation_applicability", "financial_validation_status"])

register("staged_request_telemetry", "telemetry_stg", [
    "provider_request_id", "usage_date", "provider", "model", "usage_type",
    "normalized_total_input_tokens", "normalized_cache_read_tokens", "provider_total_tokens",
    "visible_output_tokens", "is_successful_logical_request", "is_retry_attempt",
    "telemetry_validation_status", ("usage_cost_estimate", DEC)])

# ---------------------------------------------------------------------------
# core
# ---------------------------------------------------------------------------
register("usage_cost_monthly", "usage_cost_monthly", [
    "billing_month", "provider", "provider_project_id", "model", "source_daily_row_count",
    "distinct_api_key_count", "request_count", "normalized_total_input_tokens",
    "normalized_uncached_input_tokens", "normalized_cache_read_tokens",
    "normalized_cache_creation_5m_tokens", "normalized_cache_creation_1h_tokens", "output_tokens",
    "reasoning_tokens", "visible_output_tokens", ("usage_cost_estimate", DEC),
    "unpriced_daily_row_count", "estimate_currency"])

register("cost_reconciliation", "cost_reconciliation", [
    "reconciliation_fact_id", "billing_month", "provider", "provider_project_id", "model",
    "line_item_scope", "line_item_type", "provider_line_item_id", ("provider_reported_cost", DEC),
    ("invoice_billed_cost", DEC), "usage_rollup_match_count", "source_daily_row_count",
    "request_count", "normalized_total_input_tokens", "output_tokens", ("usage_cost_estimate", DEC),
    ("usage_to_reported_variance", DEC), ("reported_to_invoice_variance", DEC),
    "usage_to_reported_variance_pct", "reported_to_invoice_variance_pct",
    "usage_reconciliation_status", "invoice_reconciliation_status", "exception_status"])

register("variance_reason_codes", "cost_reconciliation", [
    "reconciliation_fact_id", "line_item_type", "source_adjustment_reason",
    "usage_variance_reason_code", "invoice_variance_reason_code", "variance_reason_code",
    "exception_status"])

_ALLOC_NAMES = ["request_count", "total_input_tokens", "uncached_input_tokens", "cache_read_tokens",
                "cache_creation_5m_tokens", "cache_creation_1h_tokens", "output_tokens",
                "reasoning_tokens", "visible_output_tokens", "usage_cost_estimate"]

register("allocate_percent", "usage_daily", [
    "usage_allocation_fact_id", "source_usage_key", "usage_date", "provider", "provider_project_id",
    "api_key_id", "model", "application_name", "department_name", "cost_center", "mapping_id",
    "allocation_status", "allocation_method", "allocation_confidence",
    ("allocation_percentage", DEC), ("total_distribution_percentage", DEC)]
    + [(f"allocated_{n}", DEC) for n in _ALLOC_NAMES]
    + [(f"unallocated_{n}", DEC) for n in _ALLOC_NAMES])

register("source_anchor", "usage_daily", [
    "usage_allocation_fact_id", "source_usage_key", "source_measure_anchor_flag"]
    + [(f"source_{n}", DEC) if n == "usage_cost_estimate" else f"source_{n}" for n in _ALLOC_NAMES])

register("restatement_flag", "usage_daily", [
    "usage_allocation_fact_id", "usage_date", "api_key_id", "mapping_id", "effective_start_date",
    "effective_end_date", "mapping_recorded_date", "is_historical_restatement"])

register("application_driver_monthly", "app_driver_monthly", [
    "billing_month", "provider", "provider_project_id", "model", "model_snapshot", "usage_type",
    "application_name", "department_name", "cost_center", "allocation_status", "allocation_method",
    "allocation_confidence", "is_historical_restatement", ("distributed_request_count", DEC),
    ("distributed_total_input_tokens", DEC), ("distributed_output_tokens", DEC),
    ("distributed_reasoning_tokens", DEC), ("driver_usage_cost_estimate", DEC), "billing_currency",
    "is_synthetic"])

register("telemetry_rollup", "telemetry_recon_daily", [
    "usage_date", "provider", "provider_project_id", "model", "telemetry_attempt_count",
    "telemetry_logical_request_count", "telemetry_final_attempt_count",
    "telemetry_successful_logical_request_count", "telemetry_retry_attempt_count",
    "telemetry_failed_attempt_count", "telemetry_total_tokens", ("telemetry_usage_cost_estimate", DEC),
    ("telemetry_retry_cost_estimate", DEC), ("telemetry_failed_attempt_cost_estimate", DEC),
    ("telemetry_mid_generation_failure_cost_estimate", DEC)])

register("telemetry_reconciliation_daily", "telemetry_recon_daily", [
    "telemetry_reconciliation_id", "usage_date", "provider", "provider_project_id", "model", "usage_type",
    "provider_request_count", "provider_total_tokens", ("provider_usage_cost_estimate", DEC),
    "telemetry_attempt_count", "telemetry_total_tokens", "has_provider_usage", "has_telemetry",
    "telemetry_token_coverage_pct", "telemetry_request_coverage_pct", "request_count_variance",
    "token_count_variance", "request_count_variance_pct", "token_count_variance_pct",
    ("untraceable_provider_usage_cost_estimate", DEC), "coverage_status", "reconciliation_status",
    "variance_reason_code"])
