"""Staging models P01-P05: tier map, normalised usage, priced usage, staged
provider cost and staged request telemetry.  All are 1:1 with their source
rows; the only joins are broadcast lookups against bounded constant dims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.functions.keys import hash_key
from tokenledger.operators.lookup import effective_lookup, lookup_with_count
from tokenledger.operators.pricing import (normalize_usage_tokens, normalized_cache_read,
                                           normalized_input_tokens, token_cost)
from tokenledger.sources.feeds import USAGE_GRAIN


def _status_by_count(count_col: str, ok: str, none: str, many: str):
    c = F.col(count_col)
    return F.when(c == 1, ok).when(c == 0, none).otherwise(many)


def usage_normalized(raw_usage: DataFrame, model_map: DataFrame, tier_map: DataFrame) -> DataFrame:
    """Resolve model snapshot and processing tier, normalise tokens, tag rows."""
    df = raw_usage.withColumn("source_usage_key", hash_key(*USAGE_GRAIN))
    df = effective_lookup(
        df, model_map,
        on={"provider": "provider", "usage_type": "usage_type", "model": "provider_model_name"},
        date_col="usage_date", start="effective_start", end="effective_end",
        fields=["model_snapshot", "effective_start", "effective_end", "reasoning_capable"],
        rename={"effective_start": "model_map_effective_start",
                "effective_end": "model_map_effective_end"},
        count_col="model_map_match_count")
    df = lookup_with_count(
        df, tier_map,
        on={"provider": "provider", "provider_service_tier": "provider_service_tier",
            "is_batch": "is_batch"},
        fields=["normalized_processing_tier"], count_col="service_tier_match_count")
    df = df.withColumn("reasoning_tokens", F.coalesce(F.col("reasoning_tokens"), F.lit(0).cast("bigint")))
    df = normalize_usage_tokens(df)
    reasoning_bad = F.col("reasoning_tokens") > F.col("output_tokens")
    cached_bad = (F.col("provider") == "openai") & (
        F.coalesce(F.col("cached_input_tokens"), F.lit(0)) > F.col("input_tokens"))
    emb_bad = (F.col("usage_type") == "embedding") & (F.col("output_tokens") != 0)
    return df.withColumns({
        "model_map_resolution_status": _status_by_count(
            "model_map_match_count", "Resolved", "Missing model map", "Multiple model maps"),
        "service_tier_resolution_status": _status_by_count(
            "service_tier_match_count", "Resolved", "Missing service tier", "Multiple service tiers"),
        "token_validation_status": F.when(reasoning_bad, "Invalid reasoning tokens")
            .when(cached_bad, "Invalid cached input")
            .when(emb_bad, "Invalid embedding output").otherwise("Valid"),
    })


RATE_FIELDS = ["effective_start", "effective_end", "input_rate_per_million",
               "cached_input_rate_per_million", "cache_write_5m_rate_per_million",
               "cache_write_1h_rate_per_million", "output_rate_per_million",
               "contracted_discount", "rate_currency", "rate_basis", "rate_source", "rate_status"]

RATE_KEYS = {"provider": "provider", "usage_type": "usage_type",
             "model_snapshot": "model_snapshot",
             "normalized_processing_tier": "normalized_processing_tier",
             "is_batch": "is_batch", "context_window_tier": "context_window_tier"}


def usage_priced(normalized: DataFrame, rate_card: DataFrame) -> DataFrame:
    """One effective rate per row, cost estimate only when exactly one rate."""
    df = effective_lookup(
        normalized, rate_card, on=RATE_KEYS, date_col="usage_date",
        start="effective_start", end="effective_end", fields=RATE_FIELDS,
        rename={"effective_start": "rate_effective_start", "effective_end": "rate_effective_end"},
        count_col="rate_match_count")
    cost = token_cost("normalized_uncached_input_tokens", "normalized_cache_read_tokens",
                      "normalized_cache_creation_5m_tokens", "normalized_cache_creation_1h_tokens",
                      "output_tokens", "input_rate_per_million", "cached_input_rate_per_million",
                      "cache_write_5m_rate_per_million", "cache_write_1h_rate_per_million",
                      "output_rate_per_million", "contracted_discount")
    n = F.col("rate_match_count")
    priced = ((n == 1) & (F.col("rate_currency") == "USD")
              & (F.col("token_validation_status") == "Valid")
              & (F.col("model_map_resolution_status") == "Resolved")
              & (F.col("service_tier_resolution_status") == "Resolved"))
    return df.withColumns({
        "usage_cost_estimate": F.when(n == 1, cost),
        "pricing_status": F.when(priced, "Priced").when(n == 0, "Missing rate")
            .when(n > 1, "Multiple rates").when(F.col("rate_currency") != "USD", "Invalid currency")
            .otherwise("Invalid upstream record"),
    })


def provider_cost(raw_cost: DataFrame) -> DataFrame:
    """Staged cost lines (1:1)."""
    cur = F.upper("billing_currency")
    return raw_cost.select(
        "billing_period",
        F.trunc("billing_period", "MM").alias("billing_month"),
        "provider", "provider_project_id",
        F.nullif(F.col("model"), F.lit("")).alias("model"),
        "line_item_scope", "line_item_type", "provider_line_item_id",
        "provider_reported_cost", "invoice_billed_cost",
        cur.alias("billing_currency"), "credit_amount",
        F.nullif(F.col("adjustment_reason"), F.lit("")).alias("adjustment_reason"),
        "invoice_issue_date", "is_restatement", "is_synthetic",
        F.when(F.col("line_item_type") == "usage", "Applicable").otherwise("Not applicable")
         .alias("usage_reconciliation_applicability"),
        F.when(cur == "USD", "Valid").otherwise("Invalid currency").alias("financial_validation_status"),
    )


def request_telemetry(raw: DataFrame) -> DataFrame:
    """Telemetry with usage type, normalised tokens and attempt flags (1:1)."""
    return raw.withColumns({
        "usage_type": F.when(F.col("model").startswith("text-embedding-"), "embedding")
                       .otherwise("text_generation"),
        "normalized_total_input_tokens": normalized_input_tokens(),
        "normalized_cache_read_tokens": normalized_cache_read(),
        "provider_total_tokens": F.col("input_tokens") + F.col("output_tokens"),
        "visible_output_tokens": F.col("output_tokens") - F.col("reasoning_tokens"),
        "is_successful_logical_request": F.col("is_final_attempt")
            & (F.col("final_request_status") == "success"),
        "is_retry_attempt": ~F.col("is_final_attempt"),
        "telemetry_validation_status":
            F.when(F.col("reasoning_tokens") > F.col("output_tokens"), "Invalid reasoning tokens")
             .when((F.col("provider") == "openai")
                   & (F.col("cached_input_tokens") > F.col("input_tokens")), "Invalid cached input")
             .otherwise("Valid"),
    })
