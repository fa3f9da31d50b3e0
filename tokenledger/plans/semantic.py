"""Semantic layer: conformed dimensions (P21-P25, G32/G33) and conformed
monthly facts (P26-P30, G34).  Facts keep their own grain; dimensions are
distinct projections of the marts (small), keyed by hashes of their natural
keys so facts never need a join to find their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenledger.functions.keys import hash_key
from tokenledger.functions.numeric import MONEY, money

NA = "Not applicable"


def _na(c: str):
    return F.coalesce(F.col(c), F.lit(NA))


def date_key(c: str):
    return F.date_format(F.col(c), "yyyyMMdd").cast("int")


def provider_key():
    return hash_key("provider")


def model_key():
    return hash_key("provider", "model", "model_snapshot", "usage_type")


def application_key():
    return hash_key("application_name", "department_name", "cost_center")


def dim_date(usage_priced: DataFrame) -> DataFrame:
    """Calendar over the reporting window observed in the usage feed."""
    bounds = usage_priced.agg(F.min("usage_date").alias("d0"), F.max("usage_date").alias("d1"))
    d = bounds.select(F.explode(F.sequence("d0", "d1")).alias("date"))
    return d.select(
        date_key("date").alias("date_key"), "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter("date").cast("string")).alias("quarter_name"),
        F.month("date").alias("month_number"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "MMM").alias("month_short_name"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        (F.year("date") * 100 + F.month("date")).alias("year_month_sort"),
        F.trunc("date", "MM").alias("month_start_date"),
        F.last_day("date").alias("month_end_date"),
        F.dayofmonth("date").alias("day_of_month"),
        F.date_format("date", "EEEE").alias("day_name"),
        F.dayofweek("date").alias("day_of_week_number"))


def dim_provider(token: DataFrame, app_cost: DataFrame) -> DataFrame:
    p = token.select("provider").union(app_cost.select("provider")).distinct()
    return p.select(provider_key().alias("provider_key"), "provider",
                    F.when(F.col("provider") == "openai", "OpenAI")
                     .when(F.col("provider") == "anthropic", "Anthropic")
                     .otherwise(F.col("provider")).alias("provider_display_name"))


def dim_model(token: DataFrame, app_cost: DataFrame) -> DataFrame:
    cols = ["provider", "model", "model_snapshot", "usage_type"]
    sel = [F.col("provider")] + [_na(c).alias(c) for c in cols[1:]]
    m = token.select(*sel).union(app_cost.select(*sel)).distinct()
    return m.select(model_key().alias("model_key"), *cols,
                    F.concat(F.col("provider"), F.lit(" | "), F.col("model")).alias("provider_model_label"))


def dim_application(app_cost: DataFrame) -> DataFrame:
    a = app_cost.select(F.coalesce("application_name", F.lit("Unallocated")).alias("application_name"),
                        F.coalesce("department_name", F.lit("Unallocated")).alias("department_name"),
                        F.coalesce("cost_center", F.lit("UNALLOCATED")).alias("cost_center")).distinct()
    return a.select(application_key().alias("application_key"), "application_name", "department_name",
                    "cost_center", (F.col("application_name") == "Unallocated").alias("is_unallocated"))


def dim_experiment(controls: DataFrame) -> DataFrame:
    return controls.select(F.col("experiment_id").alias("experiment_key"), "experiment_id", "owner", "approver",
                           "hypothesis", "application_name", "cost_center", "spending_limit",
                           "spending_limit_period", "limit_currency", "warning_threshold",
                           "hard_stop_threshold", "start_date", "planned_end_date", "current_status",
                           "override_reason")


FIN_KEYS = ["billing_month", "provider", "provider_project_id", "model", "model_snapshot", "usage_type",
            "line_item_scope", "line_item_type", "application_name", "department_name", "cost_center",
            "allocation_status", "allocation_method", "allocation_confidence"]


def fact_financial_monthly(app_cost: DataFrame) -> DataFrame:
    """Sentinel -> aggregate to the 14-column grain -> keys."""
    z4 = F.lit(0).cast("decimal(28,4)")
    zm = F.lit(0).cast(MONEY)
    c = F.col
    n = app_cost.select(
        "billing_month", "provider", "provider_project_id", _na("model").alias("model"),
        _na("model_snapshot").alias("model_snapshot"), _na("usage_type").alias("usage_type"),
        "line_item_scope", "line_item_type",
        F.coalesce("application_name", F.lit("Unallocated")).alias("application_name"),
        F.coalesce("department_name", F.lit("Unallocated")).alias("department_name"),
        F.coalesce("cost_center", F.lit("UNALLOCATED")).alias("cost_center"),
        "allocation_status", "allocation_method", "allocation_confidence",
        F.coalesce("is_historical_restatement", F.lit(False)).alias("is_historical_restatement"),
        *[F.coalesce(c(x), z4).alias(x) for x in ["distributed_request_count", "distributed_total_input_tokens",
                                                 "distributed_output_tokens", "distributed_reasoning_tokens"]],
        (F.coalesce(c("allocated_usage_cost_estimate"), zm) + F.coalesce(c("unallocated_usage_cost_estimate"), zm))
        .alias("usage_cost_estimate"),
        (F.coalesce(c("allocated_provider_reported_cost"), zm)
         + F.coalesce(c("unallocated_provider_reported_cost"), zm)).alias("provider_reported_cost"),
        (F.coalesce(c("allocated_invoice_billed_cost"), zm) + F.coalesce(c("unallocated_invoice_billed_cost"), zm))
        .alias("invoice_billed_cost"),
        F.coalesce(c("allocated_invoice_billed_cost"), zm).alias("allocated_invoice_billed_cost"),
        F.coalesce(c("unallocated_invoice_billed_cost"), zm).alias("unallocated_invoice_billed_cost"),
        "billing_currency", "financial_basis")
    a = n.groupBy(*FIN_KEYS, "billing_currency", "financial_basis").agg(
        F.bool_or("is_historical_restatement").alias("has_historical_restatement"),
        *[F.sum(x).cast("decimal(28,4)").alias(x) for x in ["distributed_request_count",
                                                            "distributed_total_input_tokens",
                                                            "distributed_output_tokens",
                                                            "distributed_reasoning_tokens"]],
        *[money(F.sum(x)).alias(x) for x in ["usage_cost_estimate", "provider_reported_cost", "invoice_billed_cost",
                                             "allocated_invoice_billed_cost", "unallocated_invoice_billed_cost"]])
    return a.select(hash_key(*FIN_KEYS).alias("financial_monthly_id"), date_key("billing_month").alias("date_key"),
                    provider_key().alias("provider_key"), model_key().alias("model_key"),
                    application_key().alias("application_key"), *a.columns)


def _conformed(df: DataFrame, id_col: str | None, keep: list[str]) -> DataFrame:
    n = df.select(*([id_col] if id_col else []), "billing_month", "provider", "provider_project_id",
                  _na("model").alias("model"), _na("model_snapshot").alias("model_snapshot"),
                  _na("usage_type").alias("usage_type"), *keep)
    return n.select(*([id_col] if id_col else []), date_key("billing_month").alias("date_key"),
                    provider_key().alias("provider_key"), model_key().alias("model_key"),
                    *[c for c in n.columns if c != id_col])


USAGE_FACT_COLS = [
    "request_count", "batch_request_count", "nonbatch_request_count", "normalized_total_input_tokens",
    "normalized_uncached_input_tokens", "normalized_cache_read_tokens", "normalized_cache_creation_5m_tokens",
    "normalized_cache_creation_1h_tokens", "output_tokens", "reasoning_tokens", "visible_output_tokens",
    "total_tokens", "usage_cost_estimate", "estimated_input_cost", "estimated_output_cost",
    "estimated_reasoning_output_cost", "no_cache_baseline_cost", "estimated_cache_savings",
    "estimated_batch_savings_opportunity", "telemetry_attempt_count", "telemetry_logical_request_count",
    "successful_logical_request_count", "retry_attempt_count", "failed_attempt_count",
    "telemetry_usage_cost_estimate", "estimated_retry_cost", "estimated_failed_attempt_cost",
    "estimated_mid_generation_failure_cost", "billing_currency", "financial_basis"]

UNIT_FACT_COLS = [
    "provider_request_count", "total_tokens", "invoice_billed_usage_cost", "provider_reported_usage_cost",
    "usage_cost_estimate", "telemetry_attempt_count", "telemetry_logical_request_count",
    "successful_logical_request_count", "retry_attempt_count", "failed_attempt_count", "estimated_retry_cost",
    "estimated_failed_attempt_cost", "untraceable_provider_usage_cost_estimate", "telemetry_token_coverage_pct",
    "telemetry_request_coverage_pct", "telemetry_quality_gate_passed", "measurement_quality_status",
    "unit_economics_status", "billing_currency", "financial_basis", "operational_cost_basis"]

OPT_FACT_COLS = [
    "optimization_type", "recommendation_title", "recommendation_rationale", "eligible_cost_base", "cost_at_risk",
    "modeled_monthly_savings", "identified_annualized_savings", "approved_annualized_savings",
    "implemented_annualized_savings", "realized_savings", "savings_stage", "evaluation_gate_status", "gate_reason",
    "savings_confidence", "estimation_method", "assumption_text", "telemetry_token_coverage_pct",
    "measurement_quality_status", "requires_telemetry_remediation", "evaluation_ready_flag",
    "recommendation_generated_date", "financial_basis", "billing_currency"]


def fact_usage_monthly(token: DataFrame) -> DataFrame:
    return _conformed(token.withColumnRenamed("token_economics_id", "usage_monthly_id"), "usage_monthly_id",
                      USAGE_FACT_COLS)


def fact_unit_economics_monthly(unit: DataFrame) -> DataFrame:
    return _conformed(unit, "unit_economics_id", UNIT_FACT_COLS)


def fact_optimization_monthly(opt: DataFrame) -> DataFrame:
    return _conformed(opt, "recommendation_id", OPT_FACT_COLS)


EXP_CURRENT_COLS = [
    "experiment_governance_id", "experiment_id", "evaluation_date", "owner", "approver", "application_name",
    "cost_center", "spending_limit", "spending_limit_period", "limit_currency",
    "period_invoice_billed_experiment_cost", "period_provider_reported_experiment_cost",
    "period_driver_cost_estimate", "period_telemetry_attempt_count", "period_logical_request_count",
    "period_successful_request_count", "period_retry_attempt_count", "period_estimated_retry_cost",
    "spend_to_limit_pct", "threshold_status", "governance_action_status", "decision_financial_evidence_status",
    "governance_exception_status", "governance_exception_reason", "period_measurement_quality_status",
    "period_spend_quality_label", "latest_decision", "latest_decision_date", "decision_status_as_of_date",
    "observed_success_rate", "observed_retry_attempt_rate", "invoice_cost_per_successful_request",
    "financial_basis", "operational_basis"]


def fact_experiment_current(experiments: DataFrame) -> DataFrame:
    """Latest evaluation per experiment."""
    w = Window.partitionBy("experiment_id").orderBy(F.col("evaluation_date").desc(),
                                                    F.col("experiment_governance_id").desc())
    latest = experiments.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return latest.select(F.col("experiment_id").alias("experiment_key"),
                         date_key("evaluation_date").alias("date_key"), *EXP_CURRENT_COLS)
