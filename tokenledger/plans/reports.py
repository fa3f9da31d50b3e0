"""

A measure is an aggregate over one fact, evaluated at any grain: ratios are
ratios of sums at the requested grain, never means of ratios, and no fact
is joined to another fact row by row (each is aggregated first).  Measure
texts are Spark SQL aggregate expressions; the DuckDB oracle runs the same
text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USAGE = "line_item_type = 'usage'"


def _money(e: str) -> str:
    return f"CAST(CAST(ROUND({e}, 6) AS DECIMAL(38,6)) AS DOUBLE)"


def _m9(e: str) -> str:
    """A money sum narrowed to DECIMAL(28,9) so that sums can be combined
    exactly (two DECIMAL(38,9) operands would lose a digit of scale)."""
    return f"CAST({e} AS DECIMAL(28,9))"


def _div(n: str, d: str) -> str:
    return f"(CASE WHEN CAST({d} AS DOUBLE) <> 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)"


_USAGE_EST = f"SUM(CASE WHEN {USAGE} THEN usage_cost_estimate END)"
_USAGE_REP = f"SUM(CASE WHEN {USAGE} THEN provider_reported_cost END)"
_USAGE_INV = f"SUM(CASE WHEN {USAGE} THEN invoice_billed_cost END)"

# name -> aggregate SQL text (published as DOUBLE / BIGINT)
FINANCIAL = {
    "total_invoice_cost": _money("SUM(invoice_billed_cost)"),
    "total_provider_reported_cost": _money("SUM(provider_reported_cost)"),
    "total_usage_cost_estimate": _money("SUM(usage_cost_estimate)"),
    "total_usage_invoice_cost": _money(f"SUM(CASE WHEN {USAGE} THEN invoice_billed_cost END)"),
    "non_usage_invoice_cost": _money(f"SUM(CASE WHEN NOT ({USAGE}) THEN invoice_billed_cost END)"),
    "allocated_usage_invoice_cost": _money(f"SUM(CASE WHEN {USAGE} THEN allocated_invoice_billed_cost END)"),
    "unallocated_usage_invoice_cost": _money(f"SUM(CASE WHEN {USAGE} THEN unallocated_invoice_billed_cost END)"),
    "allocation_coverage_pct": _div(f"SUM(CASE WHEN {USAGE} THEN allocated_invoice_billed_cost END)",
                                    f"SUM(CASE WHEN {USAGE} THEN invoice_billed_cost END)"),
    "invoice_vs_estimate_variance": _money(
        _m9(f"SUM(CASE WHEN {USAGE} THEN invoice_billed_cost END)") + " - " + _m9("SUM(usage_cost_estimate)")),
    "usage_to_reported_variance": _money(
        _m9(f"SUM(CASE WHEN {USAGE} THEN provider_reported_cost END)") + " - "
        + _m9(f"SUM(CASE WHEN {USAGE} THEN usage_cost_estimate END)")),
    "usage_estimate_usage_lines": _money(_USAGE_EST),
    "provider_reported_cost_usage_lines": _money(_USAGE_REP),
    "non_usage_provider_reported_cost": _money(_m9("SUM(provider_reported_cost)") + f" - COALESCE({_m9(_USAGE_REP)}, 0)"),
    "invoice_vs_estimate_variance_pct": _div(_m9(_USAGE_INV) + " - " + _m9("SUM(usage_cost_estimate)"), "SUM(usage_cost_estimate)"),
    "usage_to_reported_variance_pct": _div(_m9(_USAGE_REP) + " - " + _m9(_USAGE_EST), f"ABS({_USAGE_EST})"),
    "reported_to_invoice_variance_pct": _div(_m9("SUM(invoice_billed_cost)") + " - " + _m9("SUM(provider_reported_cost)"),
                                             "ABS(SUM(provider_reported_cost))"),
    "unallocated_usage_pct": _div(f"SUM(CASE WHEN {USAGE} THEN unallocated_invoice_billed_cost END)", _USAGE_INV),
    "applications_requiring_review": "COUNT(DISTINCT CASE WHEN allocation_status = 'Allocated' AND (allocation_confidence = 'medium' "
                                     "OR has_historical_restatement) THEN application_key END)",
    "reported_to_invoice_variance": _money(_m9("SUM(invoice_billed_cost)") + " - " + _m9("SUM(provider_reported_cost)")),
    "high_confidence_allocation_pct": _div(
        f"SUM(CASE WHEN {USAGE} AND allocation_confidence = 'high' THEN allocated_invoice_billed_cost END)",
        f"SUM(CASE WHEN {USAGE} THEN allocated_invoice_billed_cost END)"),
    "distributed_requests": _money("SUM(distributed_request_count)"),
    "distributed_tokens": _money("SUM(distributed_total_input_tokens + distributed_output_tokens "
                                 "+ distributed_reasoning_tokens)"),
}

USAGE_MEASURES = {
    "provider_requests": "SUM(request_count)",
    "total_tokens": "SUM(total_tokens)",
    "input_tokens": "SUM(normalized_total_input_tokens)",
    "output_tokens": "SUM(output_tokens)",
    "reasoning_tokens": "SUM(reasoning_tokens)",
    "cache_read_tokens": "SUM(normalized_cache_read_tokens)",
    "cache_read_share": _div("SUM(normalized_cache_read_tokens)", "SUM(normalized_total_input_tokens)"),
    "batch_requests": "SUM(batch_request_count)",
    "batch_adoption_pct": _div("SUM(batch_request_count)", "SUM(request_count)"),
    "telemetry_attempts": "SUM(telemetry_attempt_count)",
    "logical_requests": "SUM(telemetry_logical_request_count)",
    "successful_requests": "SUM(successful_logical_request_count)",
    "retry_attempts": "SUM(retry_attempt_count)",
    "failed_attempts": "SUM(failed_attempt_count)",
    "retry_rate_pct": _div("SUM(retry_attempt_count)", "SUM(telemetry_attempt_count)"),
    "estimated_retry_cost": _money("SUM(estimated_retry_cost)"),
    "estimated_failed_attempt_cost": _money("SUM(estimated_failed_attempt_cost)"),
    "estimated_cache_savings": _money("SUM(estimated_cache_savings)"),
    "estimated_batch_opportunity": _money("SUM(estimated_batch_savings_opportunity)"),
}

UNIT_MEASURES = {
    "invoice_cost_per_provider_request": _div("SUM(invoice_billed_usage_cost)", "SUM(provider_request_count)"),
    "invoice_cost_per_million_tokens": _div("CAST(SUM(invoice_billed_usage_cost) AS DOUBLE) * 1000000",
                                            "SUM(total_tokens)"),
    "governed_invoice_cost_per_logical_request": _div(
        "SUM(CASE WHEN measurement_quality_status = 'SUFFICIENT' THEN invoice_billed_usage_cost END)",
        "SUM(CASE WHEN measurement_quality_status = 'SUFFICIENT' THEN telemetry_logical_request_count END)"),
    "governed_invoice_cost_per_successful_request": _div(
        "SUM(CASE WHEN measurement_quality_status = 'SUFFICIENT' THEN invoice_billed_usage_cost END)",
        "SUM(CASE WHEN measurement_quality_status = 'SUFFICIENT' THEN successful_logical_request_count END)"),
    "telemetry_token_coverage_pct": _div("SUM(CAST(telemetry_token_coverage_pct * total_tokens AS DECIMAL(38,6)))",
                                         "SUM(total_tokens)"),
    "untraceable_usage_cost": _money("SUM(untraceable_provider_usage_cost_estimate)"),
}

OPT_MEASURES = {
    "identified_annualized_savings": _money("SUM(identified_annualized_savings)"),
    "approved_annualized_savings": _money("SUM(approved_annualized_savings)"),
    "implemented_annualized_savings": _money("SUM(implemented_annualized_savings)"),
    "realized_savings": _money("SUM(realized_savings)"),
    "ready_recommendations": "count_if(evaluation_gate_status = 'READY_FOR_EVALUATION')",
    "data_hold_recommendations": "count_if(evaluation_gate_status = 'HOLD_FOR_DATA')",
}

GOVERNANCE_MEASURES = {
    "passed_controls": "count_if(status = 'PASS')",
    "failed_controls": "count_if(status = 'FAIL')",
    "control_pass_pct": _div("count_if(status = 'PASS')", "count_if(status IN ('PASS', 'FAIL'))"),
}

PIPELINE_MEASURES = {
    "pipelines": "COUNT(*)",
    "failed_pipelines": "count_if(status <> 'PASS')",
    "attention_pipelines": "count_if(status <> 'PASS')",
}


def measure(fact: DataFrame, measures: dict[str, str], by: list[str]) -> DataFrame:
    """Evaluate named measures at the grain ``by`` (one aggregate pass)."""
    aggs = [F.expr(e).alias(n) for n, e in measures.items()]
    return fact.groupBy(*by).agg(*aggs) if by else fact.agg(*aggs)


def measure_sql(table: str, measures: dict[str, str], by: list[str]) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in measures.items())
    if by:
        return f"SELECT {', '.join(by)}, {cols} FROM {table} GROUP BY {', '.join(by)}"
    return f"SELECT {cols} FROM {table}"


# ---------------------------------------------------------------------------
# reports
# ---------------------------------------------------------------------------

def top_applications(fin: DataFrame, n: int = 5) -> DataFrame:
    """Top-n applications by invoice cost over all lines (ties by name), with
    their usage invoice cost."""
    g = measure(fin, {"total_invoice_cost": _money("SUM(invoice_billed_cost)"), "usage_invoice_cost": _money(_USAGE_INV)},
                ["application_name"])
    order = [F.col("total_invoice_cost").desc(), F.col("application_name")]
    top = g.orderBy(*order).limit(n)  # top-k per partition, then a final k-row merge
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def mom_invoice(fin: DataFrame) -> DataFrame:
    """Invoice cost by month with previous month and month-over-month change."""
    m = measure(fin, {"invoice_cost": _money("SUM(invoice_billed_cost)")}, ["billing_month"])
    w = Window.orderBy("billing_month")
    prev = F.lag("invoice_cost").over(w)
    prev_month = F.lag("billing_month").over(w)
    return m.select("billing_month", "invoice_cost",
                    F.when(prev_month == F.add_months("billing_month", -1), prev).alias("previous_month_invoice_cost"),
                    ).withColumn("invoice_cost_mom_pct",
                                 F.expr(_div("invoice_cost - previous_month_invoice_cost",
                                             "previous_month_invoice_cost")))


def chargeback_rollup(fin: DataFrame) -> DataFrame:
    """Department > application > cost centre with subtotals and share of total."""
    u = fin.filter(USAGE)
    r = (u.rollup("department_name", "application_name", "cost_center")
         .agg(F.expr("SUM(invoice_billed_cost)").alias("_cost"),
              F.grouping_id().alias("grouping_level")))
    total = r.filter("grouping_level = 7").select(F.col("_cost").alias("_total"), F.lit(1).alias("_one"))
    return r.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").select(  # one row
        "department_name", "application_name", "cost_center", "grouping_level",
        F.expr(_money("_cost")).alias("usage_invoice_cost"),
        F.expr(_div("_cost", "_total")).alias("share_of_total"))


def reconciliation_bridge(fin: DataFrame) -> DataFrame:
    """Four ordered amounts that lead from the usage estimate to the invoice
    (they add up to the invoice total); one row -> stack."""
    one = fin.agg(
        F.expr(_m9(f"SUM(CASE WHEN {USAGE} THEN usage_cost_estimate END)")).alias("est"),
        F.expr(_m9(f"SUM(CASE WHEN {USAGE} THEN provider_reported_cost END)")).alias("rep_u"),
        F.expr(_m9("SUM(provider_reported_cost)")).alias("rep"),
        F.expr(_m9("SUM(invoice_billed_cost)")).alias("inv"))
    return one.select(F.expr(
        "stack(4, 1, 'Usage Estimate', CAST(est AS DECIMAL(28,9)), 2, 'Usage → Reported Variance', "
        "CAST(rep_u - est AS DECIMAL(28,9)), 3, 'Non-Usage Reported Cost', "
        "CAST(rep - rep_u AS DECIMAL(28,9)), 4, 'Reported → Invoice Variance', CAST(inv - rep AS DECIMAL(28,9)))"
    ).alias("sort_order", "stage", "_amt")).select("sort_order", "stage", F.expr(_money("_amt")).alias("amount"))


def cost_per_million_by_model(fin: DataFrame, usage: DataFrame) -> DataFrame:
    """Two facts aggregated separately by model, then joined."""
    a = measure(fin.filter(USAGE), {"_inv": "SUM(invoice_billed_cost)"}, ["provider", "model"])
    b = measure(usage, {"_tok": "SUM(total_tokens)", "_read": "SUM(normalized_cache_read_tokens)",
                        "_in": "SUM(normalized_total_input_tokens)"}, ["provider", "model"])
    j = a.join(b, ["provider", "model"], "full")
    return j.select("provider", "model", F.expr(_money("_inv")).alias("usage_invoice_cost"),
                    F.col("_tok").alias("total_tokens"),
                    F.expr(_div("CAST(_inv AS DOUBLE) * 1000000", "_tok")).alias("cost_per_million_tokens"),
                    F.expr(_div("_read", "_in")).alias("cache_utilization_pct"))


def savings_by_type(opt: DataFrame) -> DataFrame:
    """Identified annualised savings by optimisation type, > 0 only."""
    g = measure(opt, {"_s": "SUM(identified_annualized_savings)", "recommendations": "COUNT(*)"},
                ["optimization_type"])
    return g.filter("_s > 0").select("optimization_type", F.expr(_money("_s")).alias("identified_annualized_savings"),
                                     "recommendations")


def attempt_sequence_check(telemetry: DataFrame) -> DataFrame:
    """Per logical request, attempts numbered 1..n without gaps, exactly
    one final attempt and one final status; one summary row."""
    per = telemetry.groupBy("logical_request_id").agg(
        F.min("attempt_number").alias("mn"), F.max("attempt_number").alias("mx"),
        F.count(F.lit(1)).alias("n"), F.count_if("is_final_attempt").alias("finals"),
        F.max(F.xxhash64("final_request_status")).alias("high"), F.min(F.xxhash64("final_request_status")).alias("low"))
    return per.agg(F.count(F.lit(1)).alias("logical_requests"),
                   F.count_if((F.col("mn") != 1) | (F.col("mx") != F.col("n"))).alias("numbering_violations"),
                   F.count_if(F.col("finals") != 1).alias("final_attempt_violations"),
                   F.count_if(F.col("high") != F.col("low")).alias("final_status_violations"))


# ---------------------------------------------------------------------------
# ---------------------------------------------------------------------------
STAGE_SUMMARIES = {
    "cost_reconciliation": {
        "reconciliation_rows": "COUNT(*)",
        "usage_rows": f"count_if({USAGE})",
        "non_usage_rows": f"count_if(NOT ({USAGE}))",
        "usage_exceptions": "count_if(usage_reconciliation_status = 'EXCEPTION')",
        "invoice_exceptions": "count_if(invoice_reconciliation_status = 'EXCEPTION')",
        "usage_cost_estimate": _money("SUM(usage_cost_estimate)"),
        "provider_reported_cost": _money("SUM(provider_reported_cost)"),
        "invoice_billed_cost": _money("SUM(invoice_billed_cost)"),
    },
    "usage_daily": {
        "allocation_rows": "COUNT(*)",
        "source_rows": "count_if(source_measure_anchor_flag)",
        "allocated_rows": "count_if(allocation_status = 'Allocated')",
        "unallocated_rows": "count_if(allocation_status = 'Unallocated')",
        "source_cost": _money("SUM(source_usage_cost_estimate)"),
        "restated_rows": "count_if(is_historical_restatement)",
        "allocated_cost": _money("SUM(allocated_usage_cost_estimate)"),
        "unallocated_cost": _money("SUM(unallocated_usage_cost_estimate)"),
        "unallocated_cost_pct": _div(_m9("SUM(unallocated_usage_cost_estimate)"),
                                     _m9("SUM(source_usage_cost_estimate)")),
    },
    "telemetry_recon_daily": {
        "daily_rows": "COUNT(*)",
        "exception_days": "count_if(reconciliation_status = 'EXCEPTION')",
        "provider_request_count": "SUM(provider_request_count)",
        "telemetry_attempt_count": "SUM(telemetry_attempt_count)",
        "telemetry_logical_request_count": "SUM(telemetry_logical_request_count)",
        "telemetry_retry_attempt_count": "SUM(telemetry_retry_attempt_count)",
        "provider_total_tokens": "SUM(provider_total_tokens)",
        "telemetry_total_tokens": "SUM(telemetry_total_tokens)",
        "overall_token_coverage_pct": _div("SUM(telemetry_total_tokens)", "SUM(provider_total_tokens)"),
        "untraceable_cost": _money("SUM(untraceable_provider_usage_cost_estimate)"),
    },
    "token_economics": {
        "token_rows": "COUNT(*)",
        "request_count": "SUM(request_count)",
        "usage_cost_estimate": _money("SUM(usage_cost_estimate)"),
        "estimated_retry_cost": _money("SUM(estimated_retry_cost)"),
        "estimated_failed_attempt_cost": _money("SUM(estimated_failed_attempt_cost)"),
        "total_tokens": "SUM(total_tokens)",
        "cache_read_share": _div("SUM(normalized_cache_read_tokens)", "SUM(normalized_total_input_tokens)"),
        "reasoning_overhead_pct": _div("SUM(reasoning_tokens)", "SUM(output_tokens)"),
        "batch_adoption_pct": _div("SUM(batch_request_count)", "SUM(request_count)"),
        "estimated_cache_savings": _money("SUM(estimated_cache_savings)"),
        "estimated_batch_savings_opportunity": _money("SUM(estimated_batch_savings_opportunity)"),
    },
    "application_cost": {
        "application_cost_rows": "COUNT(*)",
        "restated_rows": "count_if(is_historical_restatement)",
        "invoice_billed_cost": _money(_m9("SUM(allocated_invoice_billed_cost)") + " + "
                                      + _m9("SUM(unallocated_invoice_billed_cost)")),
        "financial_source_scopes": "COUNT(DISTINCT financial_source_scope_id)",
        "source_invoice_billed_cost": _money("SUM(source_invoice_billed_cost)"),
        "allocated_invoice_billed_cost": _money("SUM(allocated_invoice_billed_cost)"),
        "unallocated_invoice_billed_cost": _money("SUM(unallocated_invoice_billed_cost)"),
        "unallocated_usage_invoice_cost": _money(f"SUM(CASE WHEN {USAGE} THEN unallocated_invoice_billed_cost ELSE 0 END)"),
        "scope_retained_non_usage_cost": _money(f"SUM(CASE WHEN {USAGE} THEN 0 ELSE unallocated_invoice_billed_cost END)"),
        "unallocated_usage_invoice_pct": _div(f"SUM(CASE WHEN {USAGE} THEN unallocated_invoice_billed_cost ELSE 0 END)",
                                              f"SUM(CASE WHEN {USAGE} THEN source_invoice_billed_cost ELSE 0 END)"),
        "medium_confidence_rows": "count_if(allocation_confidence = 'medium')",
    },
    "optimization": {
        "recommendation_rows": "COUNT(*)",
        "ready_rows": "count_if(evaluation_gate_status = 'READY_FOR_EVALUATION')",
        "hold_rows": "count_if(evaluation_gate_status = 'HOLD_FOR_DATA')",
        "benchmark_rows": "count_if(evaluation_gate_status = 'REQUIRES_BENCHMARK')",
        "identified_monthly_savings": _money("SUM(modeled_monthly_savings)"),
        "identified_annualized_savings": _money("SUM(identified_annualized_savings)"),
        "approved_annualized_savings": _money("SUM(approved_annualized_savings)"),
        "implemented_annualized_savings": _money("SUM(implemented_annualized_savings)"),
        "realized_savings": _money("SUM(realized_savings)"),
        "cost_at_risk": _money("SUM(cost_at_risk)"),
    },
    "unit_economics": {
        "unit_rows": "COUNT(*)",
        "sufficient_rows": "count_if(measurement_quality_status = 'SUFFICIENT')",
        "insufficient_rows": "count_if(measurement_quality_status = 'INSUFFICIENT')",
        "provider_request_count": "SUM(provider_request_count)",
        "telemetry_logical_request_count": "SUM(telemetry_logical_request_count)",
        "successful_logical_request_count": "SUM(successful_logical_request_count)",
        "invoice_billed_usage_cost": _money("SUM(invoice_billed_usage_cost)"),
        "estimated_retry_cost": _money("SUM(estimated_retry_cost)"),
        "estimated_failed_attempt_cost": _money("SUM(estimated_failed_attempt_cost)"),
        "untraceable_cost": _money("SUM(untraceable_provider_usage_cost_estimate)"),
        "portfolio_invoice_cost_per_million_tokens": _div(
            "CAST(SUM(invoice_billed_usage_cost) AS DOUBLE) * 1000000", "SUM(total_tokens)"),
        "portfolio_invoice_cost_per_provider_request": _div("SUM(invoice_billed_usage_cost)",
                                                            "SUM(provider_request_count)"),
    },
    "experiments": {
        "evaluation_rows": "COUNT(*)",
        "experiment_count": "COUNT(DISTINCT experiment_id)",
        "hard_stop_action_required_rows": "count_if(governance_action_status = 'HARD_STOP_ACTION_REQUIRED')",
        "financial_evidence_mismatch_rows": "count_if(decision_financial_evidence_status = 'FINANCIAL_EVIDENCE_MISMATCH')",
        "limited_measurement_rows": "count_if(period_measurement_quality_status = 'LIMITED')",
        "hard_stop_rows": "count_if(threshold_status = 'HARD_STOP')",
        "warning_rows": "count_if(threshold_status = 'WARNING')",
        "exception_rows": "count_if(governance_exception_status = 'EXCEPTION')",
        "max_spend_to_limit_pct": "MAX(spend_to_limit_pct)",
        "max_period_spend": _money("MAX(period_invoice_billed_experiment_cost)"),
    },
}

EXPERIMENT_MEASURES = {
    "current_experiments": "COUNT(DISTINCT experiment_id)",
    "experiments_within_limit": "COUNT(DISTINCT CASE WHEN threshold_status = 'WITHIN_LIMIT' THEN experiment_id END)",
    "experiments_at_warning": "COUNT(DISTINCT CASE WHEN threshold_status = 'WARNING' THEN experiment_id END)",
    "experiments_at_hard_stop": "COUNT(DISTINCT CASE WHEN threshold_status = 'HARD_STOP' THEN experiment_id END)",
    "experiments_requiring_action": "COUNT(DISTINCT CASE WHEN threshold_status IN ('WARNING', 'HARD_STOP') "
                                    "THEN experiment_id END)",
    "experiment_governance_exceptions": "COUNT(DISTINCT CASE WHEN governance_exception_status = 'EXCEPTION' "
                                        "THEN experiment_id END)",
    "experiments_within_guardrail_pct": _div(
        "COUNT(DISTINCT CASE WHEN threshold_status = 'WITHIN_LIMIT' THEN experiment_id END)", "COUNT(DISTINCT experiment_id)"),
    "current_experiment_spend": _money("SUM(period_invoice_billed_experiment_cost)"),
    "experiment_spend_to_limit_pct": "MAX(spend_to_limit_pct)",
}


def latest_month_opportunities(opt: DataFrame) -> DataFrame:
    """Opportunities of the latest month (global max via a one-row
    aggregate joined back, not an unpartitioned window), > 0 by title."""
    latest = opt.agg(F.max("billing_month").alias("_latest"))
    cur = opt.join(F.broadcast(latest), F.col("billing_month") == F.col("_latest"))
    g = measure(cur, {"_s": "SUM(identified_annualized_savings)"}, ["optimization_type", "recommendation_title"])
    return g.filter("_s > 0").select("optimization_type", "recommendation_title",
                                     F.expr(_money("_s")).alias("identified_annualized_savings"))


def recommendation_table(opt: DataFrame) -> DataFrame:
    """Quantified recommendations with the number of provider and model scopes
    (actions) that each title covers."""
    g = opt.groupBy("recommendation_title", "optimization_type", "provider", "model").agg(
        F.expr("SUM(identified_annualized_savings)").alias("_s"), F.count(F.lit(1)).alias("_n")).filter("_s > 0")
    return g.groupBy("recommendation_title", "optimization_type").agg(
        F.count(F.lit(1)).alias("quantified_actions"), F.sum("_n").alias("recommendations"),
        F.expr(_money("SUM(_s)")).alias("identified_annualized_savings"))
