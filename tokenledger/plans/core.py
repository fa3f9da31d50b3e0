"""Core models: monthly usage cost (P08), cost reconciliation (P09), daily
usage allocation (P10), application invoice driver (P06) and daily
telemetry reconciliation (P11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.functions.keys import hash_key
from tokenledger.functions.numeric import MONEY, money, ratio, strict_greatest
from tokenledger.operators.allocate import allocate_percent
from tokenledger.operators.distinct import group_counts
from tokenledger.sources import constants as K

MONTH_KEYS = ["billing_month", "provider", "provider_project_id", "model"]


def usage_cost_monthly(priced: DataFrame) -> DataFrame:
    """Month x provider x project x model rollup of priced usage."""
    return (priced.withColumn("billing_month", F.trunc("usage_date", "MM"))
            .groupBy(*MONTH_KEYS)
            .agg(F.count(F.lit(1)).alias("source_daily_row_count"),
                 F.count_distinct("api_key_id").alias("distinct_api_key_count"),
                 F.sum("request_count").alias("request_count"),
                 F.sum("normalized_total_input_tokens").alias("normalized_total_input_tokens"),
                 F.sum("normalized_uncached_input_tokens").alias("normalized_uncached_input_tokens"),
                 F.sum("normalized_cache_read_tokens").alias("normalized_cache_read_tokens"),
                 F.sum("normalized_cache_creation_5m_tokens").alias("normalized_cache_creation_5m_tokens"),
                 F.sum("normalized_cache_creation_1h_tokens").alias("normalized_cache_creation_1h_tokens"),
                 F.sum("output_tokens").alias("output_tokens"),
                 F.sum("reasoning_tokens").alias("reasoning_tokens"),
                 F.sum("visible_output_tokens").alias("visible_output_tokens"),
                 money(F.sum("usage_cost_estimate")).alias("usage_cost_estimate"),
                 F.count_if(F.col("pricing_status") != "Priced").alias("unpriced_daily_row_count"))
            .withColumn("estimate_currency", F.lit("USD")))


ESTIMATE_COLS = ["source_daily_row_count", "distinct_api_key_count", "request_count",
                 "normalized_total_input_tokens", "output_tokens", "reasoning_tokens",
                 "usage_cost_estimate", "estimate_currency", "unpriced_daily_row_count"]


def cost_reconciliation(cost: DataFrame, monthly: DataFrame) -> DataFrame:
    """Attach the usage estimate to usage lines only (guard in the join
    condition), two-step variance with tolerance, reason codes."""
    u = monthly.select(*[F.col(k).alias("_u_" + k) for k in MONTH_KEYS],
                       *[F.col(c).alias("_u_" + c) for c in ESTIMATE_COLS])
    usage = F.col("line_item_type") == "usage"
    cond = (cost["line_item_type"] == "usage")
    for k in MONTH_KEYS:
        cond = cond & (cost[k] == u["_u_" + k])
    j = cost.join(u, cond, "left")
    j = j.select(
        hash_key("billing_month", "provider", "provider_project_id", "model", "line_item_type",
                 "provider_line_item_id").alias("reconciliation_fact_id"),
        "billing_period", "billing_month", "provider", "provider_project_id", "model",
        "line_item_scope", "line_item_type", "provider_line_item_id", "provider_reported_cost",
        "invoice_billed_cost", "billing_currency", "credit_amount",
        F.col("adjustment_reason").alias("source_adjustment_reason"),
        "invoice_issue_date", "is_restatement", "is_synthetic", "usage_reconciliation_applicability",
        F.when(F.col("_u_billing_month").isNull(), 0).otherwise(1).alias("usage_rollup_match_count"),
        *[F.when(usage, F.col("_u_" + c)).alias(c) for c in ESTIMATE_COLS])
    est = F.col("usage_cost_estimate")
    j = j.withColumns({
        "usage_to_reported_variance": F.when(usage, F.col("provider_reported_cost") - est).cast(MONEY),
        "reported_to_invoice_variance": (F.col("invoice_billed_cost")
                                         - F.col("provider_reported_cost")).cast(MONEY),
    })
    j = j.withColumns({
        "usage_to_reported_variance_pct": F.when(usage, ratio(
            "usage_to_reported_variance", F.abs(est), True, True)),
        "reported_to_invoice_variance_pct": ratio(
            "reported_to_invoice_variance", F.abs(F.col("provider_reported_cost")), True, True),
    })
    tol = F.lit(str(K.ABS_TOLERANCE_USD)).cast("decimal(3,2)")
    j = j.withColumns({
        "usage_reconciliation_status":
            F.when(~usage, "NOT_APPLICABLE").when(est.isNull(), "EXCEPTION")
             .when(F.abs("usage_to_reported_variance") <= tol, "PASS")
             .when(F.abs("usage_to_reported_variance_pct") <= K.PCT_TOLERANCE, "PASS")
             .otherwise("EXCEPTION"),
        "invoice_reconciliation_status":
            F.when(F.abs("reported_to_invoice_variance") <= tol, "PASS")
             .when(F.abs("reported_to_invoice_variance_pct") <= K.PCT_TOLERANCE, "PASS")
             .otherwise("EXCEPTION"),
    })
    src = F.col("source_adjustment_reason")
    lt = F.col("line_item_type")
    type_code = (F.when(lt == "credit", "CREDIT").when(lt == "tax", "TAX")
                 .when(lt == "commitment_true_up", "COMMITMENT_TRUE_UP")
                 .when(lt == "correction", "CORRECTION").when(lt == "adjustment", "ADJUSTMENT")
                 .otherwise("UNCLASSIFIED_INVOICE_VARIANCE"))
    j = j.withColumns({
        "usage_variance_reason_code":
            F.when(F.col("usage_reconciliation_status") != "EXCEPTION", F.lit(None).cast("string"))
             .when(est.isNull(), "MISSING_USAGE_ESTIMATE")
             .when(src.isin("LATE_USAGE", "INVOICE_CUTOFF"), src)
             .when(src == "ROUTINE_ROUNDING", "INDEPENDENT_SOURCE_ESTIMATE_DIFFERENCE")
             .otherwise(F.coalesce(src, F.lit("UNCLASSIFIED_USAGE_VARIANCE"))),
        "invoice_variance_reason_code":
            F.when(F.col("invoice_reconciliation_status") != "EXCEPTION", F.lit(None).cast("string"))
             .otherwise(F.coalesce(src, type_code)),
    })
    ue = F.col("usage_reconciliation_status") == "EXCEPTION"
    ie = F.col("invoice_reconciliation_status") == "EXCEPTION"
    return j.withColumns({
        "variance_reason_code":
            F.when(ue & ie, F.concat(F.col("usage_variance_reason_code"), F.lit("|"),
                                     F.col("invoice_variance_reason_code")))
             .when(ue, F.col("usage_variance_reason_code"))
             .when(ie, F.col("invoice_variance_reason_code")),
        "exception_status": F.when(ue | ie, "EXCEPTION").otherwise("PASS"),
    })


ALLOC_MEASURES = [
    ("request_count", "request_count", False),
    ("normalized_total_input_tokens", "total_input_tokens", False),
    ("normalized_uncached_input_tokens", "uncached_input_tokens", False),
    ("normalized_cache_read_tokens", "cache_read_tokens", False),
    ("normalized_cache_creation_5m_tokens", "cache_creation_5m_tokens", False),
    ("normalized_cache_creation_1h_tokens", "cache_creation_1h_tokens", False),
    ("output_tokens", "output_tokens", False),
    ("reasoning_tokens", "reasoning_tokens", False),
    ("visible_output_tokens", "visible_output_tokens", False),
    ("usage_cost_estimate", "usage_cost_estimate", True),
]

USAGE_SOURCE_COLS = [
    "source_usage_key", "usage_date", "provider", "usage_type", "provider_project_id", "api_key_id",
    "model", "model_snapshot", "provider_service_tier", "normalized_processing_tier", "is_batch",
    "context_window_tier", "rate_currency", "is_synthetic"]


def usage_daily_allocation(priced: DataFrame, bridge: DataFrame) -> DataFrame:
    """P10: priced usage split across effective owners with residual rows."""
    src = priced.filter(F.col("pricing_status") == "Priced").select(
        *USAGE_SOURCE_COLS, *[m for m, _, _ in ALLOC_MEASURES])
    rows = allocate_percent(src, bridge, [m for m, _, _ in ALLOC_MEASURES],
                            [m for m, _, is_money in ALLOC_MEASURES if is_money])
    cols = [
        hash_key("source_usage_key", "application_name", "department_name", "cost_center",
                 "allocation_status", F.coalesce(F.col("mapping_id"), F.lit("UNALLOCATED")))
        .alias("usage_allocation_fact_id"),
        "source_usage_key", "usage_date", "provider", "usage_type", "provider_project_id",
        "api_key_id", "model", "model_snapshot", "provider_service_tier",
        "normalized_processing_tier", "is_batch", "context_window_tier", "application_name",
        "department_name", "cost_center", "mapping_id", "mapping_status", "allocation_method",
        "allocation_confidence", "effective_start_date", "effective_end_date",
        "mapping_recorded_date", "is_historical_restatement", "allocation_status",
        "allocation_percentage", "total_distribution_percentage", "source_measure_anchor_flag"]
    for m, name, _ in ALLOC_MEASURES:
        cols.append(F.col(f"src__{m}").alias(f"source_{name}"))
    for m, name, _ in ALLOC_MEASURES:
        cols.append(F.col(f"alloc__{m}").alias(f"allocated_{name}"))
    for m, name, _ in ALLOC_MEASURES:
        cols.append(F.col(f"unalloc__{m}").alias(f"unallocated_{name}"))
    cols += [F.col("rate_currency").alias("billing_currency"), "is_synthetic"]
    return rows.select(*cols)


DRIVER_KEYS = ["billing_month", "provider", "provider_project_id", "model", "model_snapshot",
               "usage_type", "application_name", "department_name", "cost_center",
               "allocation_status", "allocation_method", "allocation_confidence"]


def application_invoice_driver_monthly(daily: DataFrame) -> DataFrame:
    """Monthly owner drivers (allocated + unallocated) per scope."""
    def both(n):
        return F.col(f"allocated_{n}") + F.col(f"unallocated_{n}")
    return (daily.withColumn("billing_month", F.trunc("usage_date", "MM"))
            .groupBy(*DRIVER_KEYS, "billing_currency")
            .agg(F.bool_or("is_historical_restatement").alias("is_historical_restatement"),
                 F.sum(both("request_count")).cast("decimal(28,4)").alias("distributed_request_count"),
                 F.sum(both("total_input_tokens")).cast("decimal(28,4)").alias("distributed_total_input_tokens"),
                 F.sum(both("output_tokens")).cast("decimal(28,4)").alias("distributed_output_tokens"),
                 F.sum(both("reasoning_tokens")).cast("decimal(28,4)").alias("distributed_reasoning_tokens"),
                 money(F.sum(both("usage_cost_estimate"))).alias("driver_usage_cost_estimate"),
                 F.bool_and("is_synthetic").alias("is_synthetic")))


DAY_KEYS = ["usage_date", "provider", "provider_project_id", "model"]


def provider_usage_daily(priced: DataFrame) -> DataFrame:
    return (priced.filter(F.col("pricing_status") == "Priced")
            .groupBy(*DAY_KEYS, "usage_type")  # the model decides the usage type
            .agg(F.sum("request_count").alias("provider_request_count"),
                 F.sum("normalized_total_input_tokens").alias("provider_input_tokens"),
                 F.sum("output_tokens").alias("provider_output_tokens"),
                 F.sum(F.col("normalized_total_input_tokens") + F.col("output_tokens"))
                  .alias("provider_total_tokens"),
                 money(F.sum("usage_cost_estimate")).alias("provider_usage_cost_estimate"),
                 F.count(F.lit(1)).alias("provider_usage_row_count")))


def telemetry_daily(telemetry: DataFrame, keys=None) -> DataFrame:
    """G18 rollup of valid attempts by day (or any keys)."""
    keys = keys or DAY_KEYS
    cost = F.col("usage_cost_estimate")
    zero = F.lit(0).cast(MONEY)
    return group_counts(
        telemetry.filter(F.col("telemetry_validation_status") == "Valid"), [*keys, "usage_type"],
        [F.count(F.lit(1)).alias("telemetry_attempt_count"),
         F.count_if("is_final_attempt").alias("telemetry_final_attempt_count"),
         F.count_if("is_successful_logical_request").alias("telemetry_successful_logical_request_count"),
         F.count_if("is_retry_attempt").alias("telemetry_retry_attempt_count"),
         F.count_if(F.col("attempt_status") == "failed").alias("telemetry_failed_attempt_count"),
         F.sum("normalized_total_input_tokens").alias("telemetry_input_tokens"),
         F.sum("output_tokens").alias("telemetry_output_tokens"),
         F.sum(F.col("normalized_total_input_tokens") + F.col("output_tokens")).alias("telemetry_total_tokens"),
         money(F.sum(cost)).alias("telemetry_usage_cost_estimate"),
         money(F.sum(F.when(F.col("is_retry_attempt"), cost).otherwise(zero))).alias("telemetry_retry_cost_estimate"),
         money(F.sum(F.when(F.col("attempt_status") == "failed", cost).otherwise(zero)))
          .alias("telemetry_failed_attempt_cost_estimate"),
         money(F.sum(F.when(F.col("failure_stage") == "mid_generation_error", cost).otherwise(zero)))
          .alias("telemetry_mid_generation_failure_cost_estimate"),
         F.count(F.lit(1)).alias("telemetry_row_count")],
        "logical_request_id", "telemetry_logical_request_count")


PROVIDER_SIDE = ["provider_request_count", "provider_input_tokens", "provider_output_tokens",
                 "provider_total_tokens", "provider_usage_cost_estimate", "provider_usage_row_count"]
TELEMETRY_SIDE = ["telemetry_attempt_count", "telemetry_logical_request_count",
                  "telemetry_final_attempt_count", "telemetry_successful_logical_request_count",
                  "telemetry_retry_attempt_count", "telemetry_failed_attempt_count",
                  "telemetry_input_tokens", "telemetry_output_tokens", "telemetry_total_tokens",
                  "telemetry_usage_cost_estimate", "telemetry_retry_cost_estimate",
                  "telemetry_failed_attempt_cost_estimate",
                  "telemetry_mid_generation_failure_cost_estimate", "telemetry_row_count"]


def telemetry_reconciliation_daily(priced: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Both sides pre-aggregated to the day grain, then one full outer
    join on that small grain (G14) with coverage, variance and status."""
    p = provider_usage_daily(priced).select(*[F.col(c).alias("p_" + c) for c in DAY_KEYS + ["usage_type"]],
                                            *PROVIDER_SIDE)
    t = telemetry_daily(telemetry).select(*[F.col(c).alias("t_" + c) for c in DAY_KEYS + ["usage_type"]],
                                          *TELEMETRY_SIDE)
    cond = None
    for k in DAY_KEYS:
        c = p["p_" + k] == t["t_" + k]
        cond = c if cond is None else cond & c
    j = p.join(t, cond, "full")
    j = j.select(*[F.coalesce(F.col("p_" + k), F.col("t_" + k)).alias(k) for k in DAY_KEYS + ["usage_type"]],
                 *PROVIDER_SIDE, *TELEMETRY_SIDE,
                 F.col("p_usage_date").isNotNull().alias("has_provider_usage"),
                 F.col("t_usage_date").isNotNull().alias("has_telemetry"))
    j = j.withColumns({
        "telemetry_token_coverage_pct": ratio("telemetry_total_tokens", "provider_total_tokens"),
        "telemetry_request_coverage_pct": ratio("telemetry_attempt_count", "provider_request_count"),
        "request_count_variance": F.col("telemetry_attempt_count") - F.col("provider_request_count"),
        "token_count_variance": F.col("telemetry_total_tokens") - F.col("provider_total_tokens"),
        "input_token_variance": F.col("telemetry_input_tokens") - F.col("provider_input_tokens"),
        "output_token_variance": F.col("telemetry_output_tokens") - F.col("provider_output_tokens"),
        "request_count_variance_pct": ratio(F.col("telemetry_attempt_count") - F.col("provider_request_count"),
                                            "provider_request_count"),
        "token_count_variance_pct": ratio(F.col("telemetry_total_tokens") - F.col("provider_total_tokens"),
                                          "provider_total_tokens"),
    })
    cov = F.col("telemetry_token_coverage_pct")
    untraceable_share = strict_greatest(F.lit(1.0) - F.coalesce(cov, F.lit(0.0)), F.lit(0.0))
    from tokenledger.functions.numeric import money_times_ratio
    j = j.withColumn(
        "untraceable_provider_usage_cost_estimate",
        F.when(F.col("provider_total_tokens").isNull(), F.lit(None).cast(MONEY))
         .when(F.col("provider_total_tokens") == 0, F.col("provider_usage_cost_estimate"))
         .otherwise(money_times_ratio("provider_usage_cost_estimate", untraceable_share)))
    has_p, has_t = F.col("has_provider_usage"), F.col("has_telemetry")
    req_pct = F.abs(F.col("request_count_variance_pct"))
    return j.select(
        hash_key(*DAY_KEYS).alias("telemetry_reconciliation_id"), "*",
        F.when(~has_p, "NO_PROVIDER_USAGE").when(~has_t, "NO_TELEMETRY")
         .when(cov < K.COVERAGE_LOW, "PARTIAL_COVERAGE").when(cov > K.COVERAGE_HIGH, "OVER_COVERAGE")
         .when(F.col("provider_request_count").isNull(), "REQUEST_COUNT_UNAVAILABLE")
         .when(req_pct > K.REQUEST_TOLERANCE, "REQUEST_MISMATCH")
         .otherwise("WITHIN_TOLERANCE").alias("coverage_status"),
        F.when(~has_p | ~has_t, "EXCEPTION")
         .when(cov.between(K.COVERAGE_LOW, K.COVERAGE_HIGH)
               & (F.col("provider_request_count").isNull() | (req_pct <= K.REQUEST_TOLERANCE)), "PASS")
         .otherwise("EXCEPTION").alias("reconciliation_status"),
        F.when(~has_p, "TELEMETRY_WITHOUT_PROVIDER_USAGE")
         .when(~has_t, "PROVIDER_USAGE_WITHOUT_TELEMETRY")
         .when(cov < K.COVERAGE_LOW, "INCOMPLETE_TELEMETRY_CAPTURE")
         .when(cov > K.COVERAGE_HIGH, "TELEMETRY_EXCEEDS_PROVIDER_USAGE")
         .when(req_pct > K.REQUEST_TOLERANCE, "REQUEST_COUNT_DIFFERENCE")
         .alias("variance_reason_code"),
    )
