"""Mart models: telemetry coverage (P12), token economics (P13), application
cost (P14), optimisation (P15), unit economics (P16), experiment invoice
driver (P07) and experiment governance (P17).

Every mart works on pre-aggregated monthly / daily grains (bounded by
calendar x keys x models), so after the first aggregation of the large
feeds the joins here move only small data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenledger.functions.keys import hash_key
from tokenledger.functions.numeric import (MONEY, as_double, discounted, money,
                                           money_times_ratio, per_million, ratio,
                                           strict_greatest)
from tokenledger.operators.asof import asof_latest
from tokenledger.operators.distinct import group_counts
from tokenledger.operators.lookup import effective_lookup
from tokenledger.sources import constants as K

M_KEYS = ["billing_month", "provider", "provider_project_id", "model"]
TE_KEYS = M_KEYS + ["model_snapshot", "usage_type"]
def zero() -> Column:
    return F.lit(0).cast(MONEY)


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi join on same-named keys keeping the left key columns."""
    r = right.select(*[F.col(k).alias("_r_" + k) for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k] == r["_r_" + k]
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*["_r_" + k for k in keys])


# ---------------------------------------------------------------------------
# P12
# ---------------------------------------------------------------------------

def telemetry_coverage_monthly(daily: DataFrame) -> DataFrame:
    s = F.sum
    return (daily.withColumn("billing_month", F.trunc("usage_date", "MM"))
            .groupBy(*M_KEYS, "usage_type")
            .agg(s("provider_request_count").alias("provider_request_count"),
                 s("telemetry_attempt_count").alias("telemetry_attempt_count"),
                 s("telemetry_logical_request_count").alias("telemetry_logical_request_count"),
                 s("telemetry_successful_logical_request_count").alias("telemetry_successful_logical_request_count"),
                 s("telemetry_retry_attempt_count").alias("telemetry_retry_attempt_count"),
                 s("provider_total_tokens").alias("provider_total_tokens"),
                 s("telemetry_total_tokens").alias("telemetry_total_tokens"),
                 money(s("provider_usage_cost_estimate")).alias("provider_usage_cost_estimate"),
                 money(s("telemetry_usage_cost_estimate")).alias("telemetry_usage_cost_estimate"),
                 money(s("telemetry_retry_cost_estimate")).alias("telemetry_retry_cost_estimate"),
                 money(s("telemetry_failed_attempt_cost_estimate")).alias("telemetry_failed_attempt_cost_estimate"),
                 money(s("untraceable_provider_usage_cost_estimate")).alias("untraceable_provider_usage_cost_estimate"),
                 F.count_if(F.col("reconciliation_status") == "EXCEPTION").alias("exception_day_count"),
                 F.count(F.lit(1)).alias("observed_day_count"))
            .withColumns({
                "telemetry_token_coverage_pct": ratio("telemetry_total_tokens", "provider_total_tokens"),
                "telemetry_request_coverage_pct": ratio("telemetry_attempt_count", "provider_request_count"),
                "request_count_variance": F.col("telemetry_attempt_count") - F.col("provider_request_count"),
                "token_count_variance": F.col("telemetry_total_tokens") - F.col("provider_total_tokens"),
            }))


# ---------------------------------------------------------------------------
# P13
# ---------------------------------------------------------------------------

def token_economics(priced: DataFrame, rate_card: DataFrame, telemetry: DataFrame) -> DataFrame:
    u = priced.filter(F.col("pricing_status") == "Priced")
    u = effective_lookup(
        u, rate_card.filter(F.col("is_batch")),
        on={"provider": "provider", "usage_type": "usage_type", "model_snapshot": "model_snapshot",
            "normalized_processing_tier": "normalized_processing_tier",
            "context_window_tier": "context_window_tier"},
        date_col="usage_date", start="effective_start", end="effective_end",
        fields=["input_rate_per_million", "output_rate_per_million", "contracted_discount"],
        rename={"input_rate_per_million": "batch_input_rate", "output_rate_per_million": "batch_output_rate",
                "contracted_discount": "batch_discount"},
        count_col="batch_rate_match_count")
    c = F.col
    u = u.withColumns({
        "estimated_input_cost": discounted(per_million(
            c("normalized_uncached_input_tokens") * c("input_rate_per_million")
            + c("normalized_cache_read_tokens") * F.coalesce(c("cached_input_rate_per_million"), c("input_rate_per_million"))
            + c("normalized_cache_creation_5m_tokens") * F.coalesce(c("cache_write_5m_rate_per_million"), F.lit(0))
            + c("normalized_cache_creation_1h_tokens") * F.coalesce(c("cache_write_1h_rate_per_million"), F.lit(0))),
            "contracted_discount"),
        "estimated_output_cost": discounted(per_million(c("output_tokens") * c("output_rate_per_million")),
                                            "contracted_discount"),
        "estimated_reasoning_output_cost": discounted(per_million(
            c("reasoning_tokens") * c("output_rate_per_million")), "contracted_discount"),
        "no_cache_baseline_cost": discounted(per_million(
            c("normalized_total_input_tokens") * c("input_rate_per_million")
            + c("output_tokens") * c("output_rate_per_million")), "contracted_discount"),
        "batch_equivalent_cost_estimate":
            F.when(c("is_batch"), c("usage_cost_estimate"))
             .when(c("batch_rate_match_count") != 1, F.lit(None).cast(MONEY))
             .otherwise(discounted(per_million(
                 c("normalized_total_input_tokens") * c("batch_input_rate")
                 + c("output_tokens") * c("batch_output_rate")), "batch_discount")),
    })
    s = F.sum
    um = (u.withColumn("billing_month", F.trunc("usage_date", "MM"))
          .groupBy(*TE_KEYS)
          .agg(F.count(F.lit(1)).alias("source_daily_row_count"),
               s("request_count").alias("request_count"),
               s(F.when(c("is_batch"), c("request_count")).otherwise(F.lit(0))).alias("batch_request_count"),
               s(F.when(~c("is_batch"), c("request_count")).otherwise(F.lit(0))).alias("nonbatch_request_count"),
               s("normalized_total_input_tokens").alias("normalized_total_input_tokens"),
               s("normalized_uncached_input_tokens").alias("normalized_uncached_input_tokens"),
               s("normalized_cache_read_tokens").alias("normalized_cache_read_tokens"),
               s("normalized_cache_creation_5m_tokens").alias("normalized_cache_creation_5m_tokens"),
               s("normalized_cache_creation_1h_tokens").alias("normalized_cache_creation_1h_tokens"),
               s("output_tokens").alias("output_tokens"),
               s("reasoning_tokens").alias("reasoning_tokens"),
               s("visible_output_tokens").alias("visible_output_tokens"),
               s(c("normalized_total_input_tokens") + c("output_tokens")).alias("total_tokens"),
               money(s("usage_cost_estimate")).alias("usage_cost_estimate"),
               money(s("estimated_input_cost")).alias("estimated_input_cost"),
               money(s("estimated_output_cost")).alias("estimated_output_cost"),
               money(s("estimated_reasoning_output_cost")).alias("estimated_reasoning_output_cost"),
               money(s("no_cache_baseline_cost")).alias("no_cache_baseline_cost"),
               money(s(strict_greatest(c("no_cache_baseline_cost") - c("usage_cost_estimate"), zero())))
                .alias("estimated_cache_savings"),
               money(s(F.when(c("is_batch"), zero())
                       .when(c("batch_equivalent_cost_estimate").isNull(), zero())
                       .otherwise(strict_greatest(c("usage_cost_estimate") - c("batch_equivalent_cost_estimate"), zero()))))
                .alias("estimated_batch_savings_opportunity"),
               F.count_if(~c("is_batch") & (c("batch_rate_match_count") != 1))
                .alias("nonbatch_rows_without_one_batch_rate"))
          .withColumns({"billing_currency": F.lit("USD"), "financial_basis": F.lit("usage_cost_estimate")}))
    cost = c("usage_cost_estimate")
    tm = group_counts(
        telemetry.filter(c("telemetry_validation_status") == "Valid").withColumn("billing_month", F.trunc("usage_date", "MM")),
        [*M_KEYS, "usage_type"],
        [F.count(F.lit(1)).alias("telemetry_attempt_count"),
         F.count_if("is_successful_logical_request").alias("successful_logical_request_count"),
         F.count_if("is_retry_attempt").alias("retry_attempt_count"),
         F.count_if(c("attempt_status") == "failed").alias("failed_attempt_count"),
         money(s(cost)).alias("telemetry_usage_cost_estimate"),
         money(s(F.when(c("is_retry_attempt"), cost).otherwise(zero()))).alias("estimated_retry_cost"),
         money(s(F.when(c("attempt_status") == "failed", cost).otherwise(zero()))).alias("estimated_failed_attempt_cost"),
         money(s(F.when(c("failure_stage") == "mid_generation_error", cost).otherwise(zero())))
          .alias("estimated_mid_generation_failure_cost")],
        "logical_request_id", "telemetry_logical_request_count")
    tm = tm.select(*[F.col(x).alias("t_" + x) for x in tm.columns])
    cond = None
    for k in M_KEYS + ["usage_type"]:
        cc = um[k] == tm["t_" + k]
        cond = cc if cond is None else cond & cc
    j = um.join(tm, cond, "left")
    m6 = F.lit("1000000").cast("decimal(7,0)")
    tcols = {
        "telemetry_attempt_count": F.coalesce(c("t_telemetry_attempt_count"), F.lit(0).cast("bigint")),
        "telemetry_logical_request_count": F.coalesce(c("t_telemetry_logical_request_count"), F.lit(0).cast("bigint")),
        "successful_logical_request_count": F.coalesce(c("t_successful_logical_request_count"), F.lit(0).cast("bigint")),
        "retry_attempt_count": F.coalesce(c("t_retry_attempt_count"), F.lit(0).cast("bigint")),
        "failed_attempt_count": F.coalesce(c("t_failed_attempt_count"), F.lit(0).cast("bigint")),
        "telemetry_usage_cost_estimate": F.coalesce(c("t_telemetry_usage_cost_estimate"), zero()),
        "estimated_retry_cost": F.coalesce(c("t_estimated_retry_cost"), zero()),
        "estimated_failed_attempt_cost": F.coalesce(c("t_estimated_failed_attempt_cost"), zero()),
        "estimated_mid_generation_failure_cost": F.coalesce(c("t_estimated_mid_generation_failure_cost"), zero()),
    }
    out = j.select(
        hash_key(*TE_KEYS).alias("token_economics_id"),
        *um.columns,
        ratio("normalized_cache_read_tokens", "normalized_total_input_tokens").alias("cache_read_share"),
        ratio("reasoning_tokens", "output_tokens").alias("reasoning_overhead_pct"),
        ratio("batch_request_count", "request_count").alias("batch_adoption_pct"),
        ratio(c("estimated_input_cost") * m6, "normalized_total_input_tokens", True).alias("cost_per_million_input_tokens"),
        ratio(c("estimated_output_cost") * m6, "output_tokens", True).alias("cost_per_million_output_tokens"),
        ratio(c("usage_cost_estimate") * m6, "total_tokens", True).alias("cost_per_million_total_tokens"),
        ratio("usage_cost_estimate", "request_count", True).alias("estimated_cost_per_provider_request"),
        *[v.alias(k) for k, v in tcols.items()],
        ratio("t_estimated_failed_attempt_cost", "t_telemetry_usage_cost_estimate", True, True)
         .alias("failed_attempt_cost_share"),
        ratio("t_estimated_retry_cost", "t_telemetry_usage_cost_estimate", True, True).alias("retry_cost_share"),
        F.lit("Estimated from request telemetry").alias("failure_cost_label"),
    )
    return out


# ---------------------------------------------------------------------------
# P14
# ---------------------------------------------------------------------------
SCOPE = M_KEYS + ["line_item_scope", "line_item_type"]


def _scope_agg(recon: DataFrame, usage: bool) -> DataFrame:
    c = F.col
    f = recon.filter(c("line_item_type") == "usage") if usage else recon.filter(c("line_item_type") != "usage")
    aggs = [F.count(F.lit(1)).alias("source_line_count")]
    if usage:
        aggs.append(money(F.sum("usage_cost_estimate")).alias("source_usage_cost_estimate"))
    aggs += [money(F.sum("provider_reported_cost")).alias("source_provider_reported_cost"),
             money(F.sum("invoice_billed_cost")).alias("source_invoice_billed_cost"),
             F.bool_or("is_restatement").alias("is_restatement"),
             F.bool_and("is_synthetic").alias("is_synthetic")]
    return f.groupBy(*SCOPE, "billing_currency").agg(*aggs)


APP_COST_COLS = [
    "application_cost_id", "financial_source_scope_id", *M_KEYS, "model_snapshot", "usage_type",
    "line_item_scope", "line_item_type", "application_name", "department_name", "cost_center",
    "allocation_status", "allocation_method", "allocation_confidence", "is_historical_restatement",
    "is_restatement", "source_line_count", "driver_usage_cost_estimate", "eligible_driver_denominator",
    "financial_allocation_share", "distributed_request_count", "distributed_total_input_tokens",
    "distributed_output_tokens", "distributed_reasoning_tokens", "source_measure_anchor_flag",
    "source_usage_cost_estimate", "source_provider_reported_cost", "source_invoice_billed_cost",
    "allocated_usage_cost_estimate", "unallocated_usage_cost_estimate",
    "allocated_provider_reported_cost", "unallocated_provider_reported_cost",
    "allocated_invoice_billed_cost", "unallocated_invoice_billed_cost", "billing_currency",
    "financial_basis", "cost_basis_label", "is_synthetic"]


def application_cost(recon: DataFrame, drivers: DataFrame) -> DataFrame:
    """Usage invoice lines split by driver share (G19), whole-scope
    fallback when no driver (G20), non-usage lines retained at scope (G21)."""
    c = F.col
    scope = _scope_agg(recon, usage=True)
    d = drivers.select(*M_KEYS, "model_snapshot", "usage_type", "application_name", "department_name",
                       "cost_center", "allocation_status", "allocation_method", "allocation_confidence",
                       "is_historical_restatement", "distributed_request_count",
                       "distributed_total_input_tokens", "distributed_output_tokens",
                       "distributed_reasoning_tokens", "driver_usage_cost_estimate")
    # denominators per scope are computed by aggregation and joined back,
    # instead of a window over the joined rows
    denom = d.groupBy(*M_KEYS).agg(money(F.sum("driver_usage_cost_estimate")).alias("eligible_driver_denominator"))
    scope_d = _join(scope, denom, M_KEYS, "left")
    has_driver = c("eligible_driver_denominator") > 0
    withd = _join(scope_d.filter(has_driver), d, M_KEYS, "inner")
    anchor_w = Window.partitionBy(*SCOPE).orderBy(
        F.when(c("allocation_status") == "Allocated", 0).otherwise(1), "application_name",
        "department_name", "cost_center", "model_snapshot", "usage_type", "allocation_method",
        "allocation_confidence")
    withd = withd.withColumns({
        "financial_allocation_share": ratio("driver_usage_cost_estimate", "eligible_driver_denominator", True, True),
        "_anchor": F.row_number().over(anchor_w) == 1,
    })
    alloc = c("allocation_status") == "Allocated"
    unalloc = c("allocation_status") == "Unallocated"
    share = c("financial_allocation_share")
    usage_rows = withd.select(
        hash_key(*SCOPE, "application_name", "department_name", "cost_center", "allocation_status",
                 "model_snapshot", "usage_type", "allocation_method", "allocation_confidence")
         .alias("application_cost_id"),
        hash_key(*SCOPE).alias("financial_source_scope_id"),
        *M_KEYS, "model_snapshot", "usage_type", "line_item_scope", "line_item_type", "application_name",
        "department_name", "cost_center", "allocation_status", "allocation_method", "allocation_confidence",
        "is_historical_restatement", "is_restatement", "source_line_count", "driver_usage_cost_estimate",
        "eligible_driver_denominator", "financial_allocation_share", "distributed_request_count",
        "distributed_total_input_tokens", "distributed_output_tokens", "distributed_reasoning_tokens",
        c("_anchor").alias("source_measure_anchor_flag"),
        F.when(c("_anchor"), c("source_usage_cost_estimate")).alias("source_usage_cost_estimate"),
        F.when(c("_anchor"), c("source_provider_reported_cost")).alias("source_provider_reported_cost"),
        F.when(c("_anchor"), c("source_invoice_billed_cost")).alias("source_invoice_billed_cost"),
        F.when(alloc, c("driver_usage_cost_estimate")).otherwise(zero()).alias("allocated_usage_cost_estimate"),
        F.when(unalloc, c("driver_usage_cost_estimate")).otherwise(zero()).alias("unallocated_usage_cost_estimate"),
        F.when(alloc, money_times_ratio("source_provider_reported_cost", share)).otherwise(zero())
         .alias("allocated_provider_reported_cost"),
        F.when(unalloc, money_times_ratio("source_provider_reported_cost", share)).otherwise(zero())
         .alias("unallocated_provider_reported_cost"),
        F.when(alloc, money_times_ratio("source_invoice_billed_cost", share)).otherwise(zero())
         .alias("allocated_invoice_billed_cost"),
        F.when(unalloc, money_times_ratio("source_invoice_billed_cost", share)).otherwise(zero())
         .alias("unallocated_invoice_billed_cost"),
        "billing_currency", F.lit("invoice_billed_cost").alias("financial_basis"),
        F.lit("Allocated invoiced cost").alias("cost_basis_label"), "is_synthetic")
    qty0 = F.lit(0).cast("decimal(28,4)")
    nodrv = scope_d.filter(~F.coalesce(has_driver, F.lit(False))).select(  # none, zero or negative
        hash_key(*SCOPE, F.lit("NO_ELIGIBLE_DRIVER")).alias("application_cost_id"),
        hash_key(*SCOPE).alias("financial_source_scope_id"),
        *M_KEYS, F.lit(None).cast("string").alias("model_snapshot"), F.lit(None).cast("string").alias("usage_type"),
        "line_item_scope", "line_item_type", F.lit("Unallocated").alias("application_name"),
        F.lit("Unallocated").alias("department_name"), F.lit("UNALLOCATED").alias("cost_center"),
        F.lit("Unallocated").alias("allocation_status"), F.lit("no_eligible_driver").alias("allocation_method"),
        F.lit("none").alias("allocation_confidence"), F.lit(False).alias("is_historical_restatement"),
        "is_restatement", "source_line_count", zero().alias("driver_usage_cost_estimate"),
        zero().alias("eligible_driver_denominator"), F.lit(None).cast("double").alias("financial_allocation_share"),
        qty0.alias("distributed_request_count"), qty0.alias("distributed_total_input_tokens"),
        qty0.alias("distributed_output_tokens"), qty0.alias("distributed_reasoning_tokens"),
        F.lit(True).alias("source_measure_anchor_flag"), "source_usage_cost_estimate",
        "source_provider_reported_cost", "source_invoice_billed_cost",
        zero().alias("allocated_usage_cost_estimate"), c("source_usage_cost_estimate").alias("unallocated_usage_cost_estimate"),
        zero().alias("allocated_provider_reported_cost"),
        c("source_provider_reported_cost").alias("unallocated_provider_reported_cost"),
        zero().alias("allocated_invoice_billed_cost"),
        c("source_invoice_billed_cost").alias("unallocated_invoice_billed_cost"),
        "billing_currency", F.lit("invoice_billed_cost").alias("financial_basis"),
        F.lit("Allocated invoiced cost").alias("cost_basis_label"), "is_synthetic")
    nu = _scope_agg(recon, usage=False)
    nmoney = F.lit(None).cast(MONEY)
    nqty = F.lit(None).cast("decimal(28,4)")
    nonusage = nu.select(
        hash_key(*SCOPE, F.lit("SCOPE_RETAINED")).alias("application_cost_id"),
        hash_key(*SCOPE).alias("financial_source_scope_id"),
        *M_KEYS, F.lit(None).cast("string").alias("model_snapshot"), F.lit(None).cast("string").alias("usage_type"),
        "line_item_scope", "line_item_type", F.lit("Unallocated").alias("application_name"),
        F.lit("Unallocated").alias("department_name"), F.lit("UNALLOCATED").alias("cost_center"),
        F.lit("Financial scope retained").alias("allocation_status"), F.lit("scope_retained").alias("allocation_method"),
        F.lit("none").alias("allocation_confidence"), F.lit(False).alias("is_historical_restatement"),
        "is_restatement", "source_line_count", nmoney.alias("driver_usage_cost_estimate"),
        nmoney.alias("eligible_driver_denominator"), F.lit(None).cast("double").alias("financial_allocation_share"),
        nqty.alias("distributed_request_count"), nqty.alias("distributed_total_input_tokens"),
        nqty.alias("distributed_output_tokens"), nqty.alias("distributed_reasoning_tokens"),
        F.lit(True).alias("source_measure_anchor_flag"), nmoney.alias("source_usage_cost_estimate"),
        "source_provider_reported_cost", "source_invoice_billed_cost",
        nmoney.alias("allocated_usage_cost_estimate"), nmoney.alias("unallocated_usage_cost_estimate"),
        zero().alias("allocated_provider_reported_cost"),
        c("source_provider_reported_cost").alias("unallocated_provider_reported_cost"),
        zero().alias("allocated_invoice_billed_cost"),
        c("source_invoice_billed_cost").alias("unallocated_invoice_billed_cost"),
        "billing_currency", F.lit("invoice_billed_cost").alias("financial_basis"),
        F.lit("Scope-retained invoiced cost").alias("cost_basis_label"), "is_synthetic")
    return usage_rows.unionByName(nodrv).unionByName(nonusage)


# ---------------------------------------------------------------------------
# P15
# ---------------------------------------------------------------------------
# FIXED VALUES: recommendation texts and labels (reference wording)
REC_TEXT = {
    "BATCH_MIGRATION": dict(
        title="Move eligible asynchronous workloads to Batch",
        rationale=("The historical batch-rate comparison identifies ", " USD of monthly modeled opportunity."),
        gate_reason="Historical batch rate exists and modeled monthly savings exceeds 5 USD.",
        confidence="HIGH", method="Rate-based model",
        assumption=("Assumes eligible nonbatch workloads can move to the matching historical "
                    "Batch rate without changing request volume or output quality.")),
    "RETRY_REDUCTION": dict(
        title="Reduce avoidable retries",
        rationale=("Request telemetry estimates ", " USD of monthly retry cost."),
        gate_ready="Telemetry coverage meets the 95 percent evaluation threshold.",
        gate_hold="Telemetry coverage is below 95 percent; improve measurement first.",
        confidence="MEDIUM", method="Assumption-based model",
        assumption=("Models a 50 percent reduction in retry cost. This is not approved, "
                    "implemented, or realized savings.")),
    "TELEMETRY_COVERAGE": dict(
        title="Improve request-level telemetry coverage",
        rationale=("", " USD of monthly estimated provider usage cost is not traceable "
                       "to complete request telemetry."),
        gate_reason="Measurement must be improved before financial savings can be evaluated.",
        confidence="UNQUANTIFIED", method="Cost-at-risk signal",
        assumption=("The cost-at-risk value measures incomplete traceability. "
                    "It is not a savings estimate.")),
    "CACHE_REUSE_ASSESSMENT": dict(
        title="Evaluate additional prompt-cache reuse",
        rationale=("Observed cache-read share is ", " percent, below the 20 percent benchmark."),
        gate_reason=("Run a controlled benchmark because future cache-hit improvement "
                     "and cache-write behavior are not yet proven."),
        confidence="UNQUANTIFIED", method="Benchmark required",
        assumption=("No savings amount is assigned until a controlled cache experiment "
                    "measures hit-rate change, write overhead, quality, and latency.")),
}


def fmt2(x) -> Column:
    """'%.2f' of a money value, rounded exactly in decimal first."""
    return F.format_string("%.2f", F.round(x, 2).cast("double"))


def pct1_of_ratio(num: str, den: str) -> Column:
    """One-decimal percentage text of num/den computed in integers (half up)."""
    n, d = F.col(num), F.col(den)
    n, d = n.cast("decimal(28,0)"), d.cast("decimal(20,0)")
    tenths = F.when(d > 0, F.floor((n * 2000 + d) / (d * 2))).otherwise(F.lit(0)).cast("bigint")
    return F.concat((tenths / 10).cast("bigint").cast("string"), F.lit("."), (tenths % 10).cast("string"))


def optimization(token: DataFrame, coverage: DataFrame) -> DataFrame:
    """Four rule-based recommendation types in ONE pass over the token base:
    each row builds an array of candidate structs, keeps those whose rule
    fires, and explodes them (no four-fold rescan, no union)."""
    c = F.col
    cov = coverage.select(*M_KEYS, "usage_type", "telemetry_token_coverage_pct",
                          "untraceable_provider_usage_cost_estimate")
    base = _join(token.select(*TE_KEYS, "request_count", "total_tokens", "normalized_total_input_tokens",
                              "normalized_cache_read_tokens", "cache_read_share", "usage_cost_estimate",
                              "estimated_input_cost", "estimated_batch_savings_opportunity",
                              "estimated_retry_cost"),
                 cov, M_KEYS + ["usage_type"], "left")
    base = base.withColumns({
        "telemetry_token_coverage_pct": F.coalesce(c("telemetry_token_coverage_pct"), F.lit(0.0)),
        "untraceable_provider_usage_cost_estimate": F.coalesce(c("untraceable_provider_usage_cost_estimate"), zero()),
    })
    cov_ok = c("telemetry_token_coverage_pct") >= K.COVERAGE_LOW
    nullm = F.lit(None).cast(MONEY)

    def rec(kind, applies, rationale, eligible, at_risk, monthly, annual, stage, gate, gate_reason,
            quality, remediation):
        t = REC_TEXT[kind]
        return F.when(applies, F.struct(
            F.lit(kind).alias("optimization_type"), F.lit(t["title"]).alias("recommendation_title"),
            rationale.alias("recommendation_rationale"), eligible.cast(MONEY).alias("eligible_cost_base"),
            at_risk.cast(MONEY).alias("cost_at_risk"), monthly.cast(MONEY).alias("modeled_monthly_savings"),
            annual.cast(MONEY).alias("identified_annualized_savings"), F.lit(stage).alias("savings_stage"),
            gate.alias("evaluation_gate_status"), gate_reason.alias("gate_reason"),
            F.lit(t["confidence"]).alias("savings_confidence"), F.lit(t["method"]).alias("estimation_method"),
            F.lit(t["assumption"]).alias("assumption_text"), quality.alias("measurement_quality_status"),
            remediation.alias("requires_telemetry_remediation")))

    twelve = F.lit(K.ANNUALIZATION_MONTHS).cast("decimal(2,0)")
    half = F.lit(str(K.RETRY_REDUCTION_TARGET)).cast("decimal(2,1)")
    bt, rt, tt, ct = (REC_TEXT[k]["rationale"] for k in K.RECOMMENDATION_TYPES)
    cands = F.array(
        rec("BATCH_MIGRATION", c("estimated_batch_savings_opportunity") >= K.BATCH_MIN_MONTHLY_SAVINGS,
            F.concat(F.lit(bt[0]), fmt2(c("estimated_batch_savings_opportunity")), F.lit(bt[1])),
            c("usage_cost_estimate"), zero(), c("estimated_batch_savings_opportunity"),
            money(c("estimated_batch_savings_opportunity") * twelve), "IDENTIFIED",
            F.lit("READY_FOR_EVALUATION"), F.lit(REC_TEXT["BATCH_MIGRATION"]["gate_reason"]),
            F.lit("NOT_REQUIRED"), F.lit(False)),
        rec("RETRY_REDUCTION", c("estimated_retry_cost") >= K.RETRY_MIN_MONTHLY_COST,
            F.concat(F.lit(rt[0]), fmt2(c("estimated_retry_cost")), F.lit(rt[1])),
            c("usage_cost_estimate"), c("estimated_retry_cost"), money(c("estimated_retry_cost") * half),
            money(money(c("estimated_retry_cost") * half) * twelve), "IDENTIFIED",
            F.when(cov_ok, "READY_FOR_EVALUATION").otherwise("HOLD_FOR_DATA"),
            F.when(cov_ok, REC_TEXT["RETRY_REDUCTION"]["gate_ready"])
             .otherwise(REC_TEXT["RETRY_REDUCTION"]["gate_hold"]),
            F.when(cov_ok, "SUFFICIENT").otherwise("INSUFFICIENT"), ~cov_ok),
        rec("TELEMETRY_COVERAGE",
            (c("telemetry_token_coverage_pct") < K.COVERAGE_LOW)
            & (c("untraceable_provider_usage_cost_estimate") >= K.COVERAGE_MIN_AT_RISK),
            F.concat(F.lit(tt[0]), fmt2(c("untraceable_provider_usage_cost_estimate")), F.lit(tt[1])),
            c("usage_cost_estimate"), c("untraceable_provider_usage_cost_estimate"), nullm, zero(),
            "UNQUANTIFIED", F.lit("HOLD_FOR_DATA"), F.lit(REC_TEXT["TELEMETRY_COVERAGE"]["gate_reason"]),
            F.lit("INSUFFICIENT"), F.lit(True)),
        rec("CACHE_REUSE_ASSESSMENT",
            (c("usage_type") == "text_generation") & (c("normalized_total_input_tokens") > 0)
            & (F.coalesce(c("cache_read_share"), F.lit(0.0)) < K.CACHE_SHARE_BELOW)
            & (c("estimated_input_cost") >= K.CACHE_MIN_INPUT_COST),
            F.concat(F.lit(ct[0]), pct1_of_ratio("normalized_cache_read_tokens", "normalized_total_input_tokens"),
                     F.lit(ct[1])),
            c("estimated_input_cost"), c("estimated_input_cost"), nullm, zero(), "UNQUANTIFIED",
            F.lit("REQUIRES_BENCHMARK"), F.lit(REC_TEXT["CACHE_REUSE_ASSESSMENT"]["gate_reason"]),
            F.when(cov_ok, "SUFFICIENT").otherwise("INSUFFICIENT"), ~cov_ok),
    )
    exploded = (base.select(*TE_KEYS, "telemetry_token_coverage_pct",
                            F.explode(F.filter(cands, lambda x: x.isNotNull())).alias("r"))
                .select(*TE_KEYS, "telemetry_token_coverage_pct", "r.*"))
    return exploded.select(
        hash_key(*TE_KEYS, "optimization_type").alias("recommendation_id"),
        *TE_KEYS, "optimization_type", "recommendation_title", "recommendation_rationale",
        "eligible_cost_base", "cost_at_risk", "modeled_monthly_savings", "identified_annualized_savings",
        zero().alias("approved_annualized_savings"), zero().alias("implemented_annualized_savings"),
        zero().alias("realized_savings"), "savings_stage", "evaluation_gate_status", "gate_reason",
        "savings_confidence", "estimation_method", "assumption_text", "telemetry_token_coverage_pct",
        "measurement_quality_status", "requires_telemetry_remediation",
        F.lit(False).alias("is_approved"), F.lit(False).alias("is_implemented"), F.lit(False).alias("is_realized"),
        F.lit("usage_cost_estimate").alias("financial_basis"), F.lit("USD").alias("billing_currency"),
        F.when(c("evaluation_gate_status") == "READY_FOR_EVALUATION", 1).otherwise(0).alias("evaluation_ready_flag"),
        F.lit(K.AS_OF_DATE.isoformat()).cast("date").alias("recommendation_generated_date"))


# ---------------------------------------------------------------------------
# P16
# ---------------------------------------------------------------------------

def unit_economics(token: DataFrame, recon: DataFrame, coverage: DataFrame) -> DataFrame:
    c = F.col
    fin = (recon.filter(c("line_item_type") == "usage").groupBy(*M_KEYS, "billing_currency")
           .agg(F.count(F.lit(1)).alias("financial_usage_line_count"),
                money(F.sum("usage_cost_estimate")).alias("reconciled_usage_cost_estimate"),
                money(F.sum("provider_reported_cost")).alias("provider_reported_usage_cost"),
                money(F.sum("invoice_billed_cost")).alias("invoice_billed_usage_cost"),
                F.bool_and("is_synthetic").alias("is_synthetic")))
    t = token.select(*TE_KEYS, "financial_basis", c("request_count").alias("provider_request_count"),
                     "normalized_total_input_tokens", "output_tokens", "reasoning_tokens",
                     "visible_output_tokens", "total_tokens", "usage_cost_estimate",
                     "telemetry_attempt_count", "telemetry_logical_request_count",
                     "successful_logical_request_count", "retry_attempt_count", "failed_attempt_count",
                     "telemetry_usage_cost_estimate", "estimated_retry_cost", "estimated_failed_attempt_cost",
                     "estimated_mid_generation_failure_cost").drop("financial_basis")
    b = _join(t, fin, M_KEYS, "inner")
    cov = coverage.select(*M_KEYS, "usage_type", "telemetry_token_coverage_pct", "telemetry_request_coverage_pct",
                          "untraceable_provider_usage_cost_estimate", "exception_day_count", "observed_day_count")
    b = _join(b, cov, M_KEYS + ["usage_type"], "left")
    gate = c("telemetry_token_coverage_pct").between(K.COVERAGE_LOW, K.COVERAGE_HIGH)
    b = b.withColumns({
        "invoice_to_estimate_variance": (c("invoice_billed_usage_cost") - c("usage_cost_estimate")).cast(MONEY),
        "telemetry_quality_gate_passed": gate,
    })
    b = b.withColumn("invoice_to_estimate_variance_pct",
                     ratio("invoice_to_estimate_variance", F.abs(c("usage_cost_estimate")), True, True))
    inv = "invoice_billed_usage_cost"
    k1 = F.lit(1000).cast("decimal(4,0)")
    m6 = F.lit("1000000").cast("decimal(7,0)")
    g = c("telemetry_quality_gate_passed")
    return b.select(
        hash_key(*TE_KEYS).alias("unit_economics_id"), "*",
        ratio(inv, "provider_request_count", True).alias("invoice_cost_per_provider_request"),
        ratio(c(inv) * k1, "provider_request_count", True).alias("invoice_cost_per_thousand_provider_requests"),
        ratio(c(inv) * m6, "total_tokens", True).alias("invoice_cost_per_million_total_tokens"),
        ratio(c(inv) * m6, "normalized_total_input_tokens", True).alias("invoice_cost_per_million_input_tokens"),
        ratio(c(inv) * m6, "output_tokens", True).alias("invoice_cost_per_million_output_tokens"),
        F.when(g, ratio(inv, "telemetry_logical_request_count", True)).alias("governed_invoice_cost_per_logical_request"),
        F.when(g, ratio(inv, "successful_logical_request_count", True)).alias("governed_invoice_cost_per_successful_request"),
        ratio("successful_logical_request_count", "telemetry_logical_request_count").alias("observed_success_rate"),
        ratio("retry_attempt_count", "telemetry_attempt_count").alias("observed_retry_attempt_rate"),
        ratio("failed_attempt_count", "telemetry_attempt_count").alias("observed_failed_attempt_rate"),
        ratio("telemetry_attempt_count", "telemetry_logical_request_count").alias("observed_attempts_per_logical_request"),
        ratio("total_tokens", "provider_request_count").alias("average_tokens_per_provider_request"),
        ratio("normalized_total_input_tokens", "provider_request_count").alias("average_input_tokens_per_provider_request"),
        ratio("output_tokens", "provider_request_count").alias("average_output_tokens_per_provider_request"),
        ratio("reasoning_tokens", "output_tokens").alias("reasoning_overhead_pct"),
        ratio("estimated_retry_cost", "telemetry_usage_cost_estimate", True, True).alias("estimated_retry_cost_share"),
        ratio("estimated_failed_attempt_cost", "telemetry_usage_cost_estimate", True, True)
         .alias("estimated_failed_attempt_cost_share"),
        F.when(g, ratio("estimated_retry_cost", "successful_logical_request_count", True))
         .alias("governed_retry_cost_per_successful_request"),
        F.when(g, "SUFFICIENT").otherwise("INSUFFICIENT").alias("measurement_quality_status"),
        F.when(g, "PUBLISHABLE").otherwise("LIMITED_TELEMETRY").alias("unit_economics_status"),
        F.when(g, "Telemetry-dependent unit economics passed the 95%-105% token coverage gate.")
         .otherwise("Provider-based metrics are valid, but logical-request and successful-request "
                    "cost metrics are withheld.").alias("measurement_quality_note"),
        F.lit("invoice_billed_cost_usage_lines").alias("financial_basis"),
        F.lit("usage_cost_estimate").alias("operational_cost_basis"),
        F.lit("Estimated from request telemetry").alias("retry_and_failure_cost_label"))


# ---------------------------------------------------------------------------
# P07
# ---------------------------------------------------------------------------

def experiment_driver_daily(telemetry: DataFrame, recon: DataFrame, coverage: DataFrame) -> DataFrame:
    c = F.col
    cost = c("usage_cost_estimate")
    e = group_counts(
        telemetry.filter((c("telemetry_validation_status") == "Valid") & c("experiment_id").isNotNull())
        .withColumn("billing_month", F.trunc("usage_date", "MM")), ["usage_date", *M_KEYS, "experiment_id"],
        [F.count(F.lit(1)).alias("telemetry_attempt_count"),
         F.count_if("is_successful_logical_request").alias("successful_logical_request_count"),
         F.count_if("is_retry_attempt").alias("retry_attempt_count"),
         F.sum(c("normalized_total_input_tokens") + c("output_tokens")).alias("telemetry_total_tokens"),
         money(F.sum(cost)).alias("experiment_driver_cost_estimate"),
         money(F.sum(F.when(c("is_retry_attempt"), cost).otherwise(zero()))).alias("estimated_retry_cost")],
        "logical_request_id", "telemetry_logical_request_count")
    i = (recon.filter(c("line_item_type") == "usage").groupBy(*M_KEYS, "billing_currency")
         .agg(money(F.sum("usage_cost_estimate")).alias("monthly_usage_cost_estimate"),
              money(F.sum("provider_reported_cost")).alias("monthly_provider_reported_usage_cost"),
              money(F.sum("invoice_billed_cost")).alias("monthly_invoice_billed_usage_cost")))
    cov = coverage.select(*M_KEYS, "telemetry_token_coverage_pct")
    j = _join(_join(e, i, M_KEYS, "inner"), cov, M_KEYS, "left")
    j = j.withColumn("financial_allocation_share",
                     ratio("experiment_driver_cost_estimate", "monthly_usage_cost_estimate", True, True))
    inband = c("telemetry_token_coverage_pct").between(K.COVERAGE_LOW, K.COVERAGE_HIGH)
    return j.select(
        hash_key("usage_date", "provider", "provider_project_id", "model", "experiment_id").alias("experiment_driver_id"),
        "*",
        money_times_ratio("monthly_provider_reported_usage_cost", c("financial_allocation_share"))
         .alias("allocated_provider_reported_experiment_cost"),
        money_times_ratio("monthly_invoice_billed_usage_cost", c("financial_allocation_share"))
         .alias("allocated_invoice_billed_experiment_cost"),
        F.when(c("monthly_usage_cost_estimate").isNull() | (c("monthly_usage_cost_estimate") == 0), "NO_ELIGIBLE_DRIVER")
         .when(inband, "SUFFICIENT").otherwise("LIMITED").alias("measurement_quality_status"),
        F.when(inband, "BEST_ESTIMATE").otherwise("LOWER_BOUND").alias("spend_quality_label"),
        F.lit("allocated_invoice_billed_cost_usage_lines_only").alias("financial_basis"),
        F.lit("request_telemetry_usage_cost_estimate").alias("operational_basis"))


# ---------------------------------------------------------------------------
# P17
# ---------------------------------------------------------------------------
CONTROL_COLS = ["experiment_id", "owner", "approver", "hypothesis", "application_name", "cost_center",
                "spending_limit", "spending_limit_period", "limit_currency", "warning_threshold",
                "hard_stop_threshold", "start_date", "planned_end_date", "source_current_status",
                "override_reason"]
DAILY_MEASURES = [
    ("allocated_invoice_billed_experiment_cost", "daily_invoice_billed_experiment_cost", "period_invoice_billed_experiment_cost", True),
    ("allocated_provider_reported_experiment_cost", "daily_provider_reported_experiment_cost", "period_provider_reported_experiment_cost", True),
    ("experiment_driver_cost_estimate", "daily_driver_cost_estimate", "period_driver_cost_estimate", True),
    ("telemetry_attempt_count", "daily_telemetry_attempt_count", "period_telemetry_attempt_count", False),
    ("telemetry_logical_request_count", "daily_logical_request_count", "period_logical_request_count", False),
    ("successful_logical_request_count", "daily_successful_request_count", "period_successful_request_count", False),
    ("retry_attempt_count", "daily_retry_attempt_count", "period_retry_attempt_count", False),
    ("estimated_retry_cost", "daily_estimated_retry_cost", "period_estimated_retry_cost", True),
]


def experiment_calendar(controls: DataFrame) -> DataFrame:
    """G24 date spine: one row per experiment and day of its window."""
    ctl = controls.select(*[c for c in CONTROL_COLS if c != "source_current_status"],
                          F.col("current_status").alias("source_current_status"))
    return ctl.withColumn("calendar_date", F.explode(F.sequence("start_date", "planned_end_date")))


def experiment_daily(controls: DataFrame, drivers: DataFrame) -> DataFrame:
    """Zero-filled daily experiment activity (spine left join, then sum)."""
    c = F.col
    cal = experiment_calendar(controls)
    d = drivers.select(F.col("experiment_id").alias("_e"), F.col("usage_date").alias("_d"), "experiment_driver_id",
                       "measurement_quality_status", "spend_quality_label", *[m for m, _, _, _ in DAILY_MEASURES])
    j = cal.join(d, (cal["experiment_id"] == d["_e"]) & (cal["calendar_date"] == d["_d"]), "left")
    aggs = []
    for src, daily, _, is_money in DAILY_MEASURES:
        z = zero() if is_money else F.lit(0).cast("bigint")
        s = money(F.sum(src)) if is_money else F.sum(src)
        aggs.append(F.coalesce(s, z).alias(daily))
    n = F.count("experiment_driver_id")
    aggs += [
        F.when(n == 0, "NO_ACTIVITY").when(F.count_if(c("measurement_quality_status") == "LIMITED") > 0, "LIMITED")
         .otherwise("SUFFICIENT").alias("daily_measurement_quality_status"),
        F.when(n == 0, "NO_ACTIVITY").when(F.count_if(c("spend_quality_label") == "LOWER_BOUND") > 0, "LOWER_BOUND")
         .otherwise("BEST_ESTIMATE").alias("daily_spend_quality_label"),
    ]
    return j.groupBy(*CONTROL_COLS, "calendar_date").agg(*aggs)


def experiment_periods(daily: DataFrame) -> DataFrame:
    """Day rows, month totals, lifetime running totals, unioned."""
    c = F.col
    period_cols = [p for _, _, p, _ in DAILY_MEASURES]
    day = daily.filter(c("spending_limit_period") == "day").select(
        *CONTROL_COLS, c("calendar_date").alias("evaluation_date"), c("calendar_date").alias("period_start_date"),
        c("calendar_date").alias("period_end_date"),
        *[c(d).alias(p) for _, d, p, _ in DAILY_MEASURES],
        c("daily_measurement_quality_status").alias("period_measurement_quality_status"),
        c("daily_spend_quality_label").alias("period_spend_quality_label"))
    mon_src = daily.filter(c("spending_limit_period") == "month").withColumn("_m", F.trunc("calendar_date", "MM"))
    att = F.sum("daily_telemetry_attempt_count")
    month = (mon_src.groupBy(*CONTROL_COLS, "_m").agg(
        F.max("calendar_date").alias("evaluation_date"), F.min("calendar_date").alias("period_start_date"),
        F.max("calendar_date").alias("period_end_date"),
        *[(money(F.sum(d)) if m else F.sum(d)).alias(p) for _, d, p, m in DAILY_MEASURES],
        F.when(att == 0, "NO_ACTIVITY").when(F.count_if(c("daily_measurement_quality_status") == "LIMITED") > 0, "LIMITED")
         .otherwise("SUFFICIENT").alias("period_measurement_quality_status"),
        F.when(att == 0, "NO_ACTIVITY").when(F.count_if(c("daily_spend_quality_label") == "LOWER_BOUND") > 0, "LOWER_BOUND")
         .otherwise("BEST_ESTIMATE").alias("period_spend_quality_label")).drop("_m"))
    w = Window.partitionBy("experiment_id").orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, 0)
    life_src = daily.filter(c("spending_limit_period") == "lifetime")
    run_att = F.sum("daily_telemetry_attempt_count").over(w)
    life = life_src.select(
        *CONTROL_COLS, c("calendar_date").alias("evaluation_date"), c("start_date").alias("period_start_date"),
        c("calendar_date").alias("period_end_date"),
        *[(money(F.sum(d).over(w)) if m else F.sum(d).over(w)).alias(p) for _, d, p, m in DAILY_MEASURES],
        F.when(run_att == 0, "NO_ACTIVITY")
         .when(F.count_if(c("daily_measurement_quality_status") == "LIMITED").over(w) > 0, "LIMITED")
         .otherwise("SUFFICIENT").alias("period_measurement_quality_status"),
        F.when(run_att == 0, "NO_ACTIVITY")
         .when(F.count_if(c("daily_spend_quality_label") == "LOWER_BOUND").over(w) > 0, "LOWER_BOUND")
         .otherwise("BEST_ESTIMATE").alias("period_spend_quality_label"))
    del period_cols
    return day.unionByName(month).unionByName(life)


def experiment_governance(periods: DataFrame, decisions: DataFrame) -> DataFrame:
    """G26 thresholds, G28 breach history, G27 as-of decision, G29 audit."""
    c = F.col
    spend = c("period_invoice_billed_experiment_cost")
    t = periods.withColumns({
        "warning_spend_threshold": money(c("spending_limit") * c("warning_threshold")),
        "hard_stop_spend_threshold": money(c("spending_limit") * c("hard_stop_threshold")),
        "spend_to_limit_pct": ratio(spend, "spending_limit", True, True),
    })
    t = t.withColumn("threshold_status",
                     F.when(spend >= c("hard_stop_spend_threshold"), "HARD_STOP")
                      .when(spend >= c("warning_spend_threshold"), "WARNING").otherwise("WITHIN_LIMIT"))
    run = Window.partitionBy("experiment_id").orderBy("evaluation_date").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("experiment_id")
    h = t.withColumns({
        "max_period_spend_to_date": F.max(spend).over(run),
        "first_warning_date": F.min(F.when(c("threshold_status") == "WARNING", c("evaluation_date"))).over(whole),
        "first_hard_stop_date": F.min(F.when(c("threshold_status") == "HARD_STOP", c("evaluation_date"))).over(whole),
    })
    r = asof_latest(h, decisions, on="experiment_id", left_date="evaluation_date", right_date="decision_date",
                    tie="experiment_decision_id",
                    fields=["experiment_decision_id", "decision", "decision_date", "decided_by", "rationale",
                            "previous_status", "new_status"], prefix="_d_")
    r = r.select(*h.columns,
                 c("_d_experiment_decision_id").alias("latest_experiment_decision_id"),
                 c("_d_decision").alias("latest_decision"), c("_d_decision_date").alias("latest_decision_date"),
                 c("_d_decided_by").alias("latest_decided_by"), c("_d_rationale").alias("latest_decision_rationale"),
                 c("_d_previous_status").alias("latest_previous_status"),
                 c("_d_new_status").alias("decision_status_as_of_date"))
    fin_stop = ((c("latest_decision") == "Stop")
                & F.lower(F.coalesce(c("latest_decision_rationale"), F.lit(""))).rlike(K.FINANCIAL_RATIONALE_PATTERN)
                & (c("max_period_spend_to_date") < c("hard_stop_spend_threshold")))
    hard = c("threshold_status") == "HARD_STOP"
    not_stopped = c("decision_status_as_of_date") != "stopped"
    limited = c("period_measurement_quality_status") == "LIMITED"
    return r.select(
        hash_key("experiment_id", "spending_limit_period", "evaluation_date", "period_start_date",
                 "period_end_date").alias("experiment_governance_id"), "*",
        F.when(hard & (c("decision_status_as_of_date") == "stopped"), "HARD_STOP_COMPLIANT")
         .when(hard, "HARD_STOP_ACTION_REQUIRED").when(c("threshold_status") == "WARNING", "WARNING_REVIEW_REQUIRED")
         .otherwise("WITHIN_LIMIT").alias("governance_action_status"),
        F.when(fin_stop, "FINANCIAL_EVIDENCE_MISMATCH").when(c("latest_decision").isNull(), "NO_DECISION_AS_OF_DATE")
         .otherwise("SUPPORTED_OR_NONFINANCIAL").alias("decision_financial_evidence_status"),
        F.when(fin_stop, "Decision rationale references financial limits, but no calculated hard-stop breach exists.")
         .when(hard & not_stopped, "Calculated hard-stop threshold was reached without a stopped status.")
         .when(limited, "Spend is a lower-bound estimate because telemetry coverage is limited.")
         .alias("governance_exception_reason"),
        F.when(fin_stop | (hard & not_stopped) | limited, "EXCEPTION").otherwise("PASS")
         .alias("governance_exception_status"),
        ratio("period_successful_request_count", "period_logical_request_count").alias("observed_success_rate"),
        ratio("period_retry_attempt_count", "period_telemetry_attempt_count").alias("observed_retry_attempt_rate"),
        ratio(spend, "period_successful_request_count", True).alias("invoice_cost_per_successful_request"),
        F.lit("allocated_invoice_billed_cost_usage_lines_only").alias("financial_basis"),
        F.lit("request_telemetry_usage_cost_estimate").alias("operational_basis"))


__all__ = ["telemetry_coverage_monthly", "token_economics", "application_cost", "optimization",
           "unit_economics", "experiment_driver_daily", "experiment_daily", "experiment_periods",
           "experiment_governance", "as_double"]
