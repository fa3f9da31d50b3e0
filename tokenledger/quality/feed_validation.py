"""Feed validation over whole feeds (V01, V03, V04, V05, V08): one scan a feed, one row a rule
with the number of rows that break it.

A rule is a predicate that a broken row satisfies.  ``column_set`` compares the feed's
columns with the expected set and counts the differences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.sources import constants as K

# FIXED VALUES: expected columns and vocabularies of the feeds
USAGE_COLUMNS = ["usage_date", "provider", "usage_type", "provider_project_id", "api_key_id", "model", "provider_service_tier", "is_batch",
                 "context_window_tier", "request_count", "input_tokens", "output_tokens", "reasoning_tokens", "cached_input_tokens",
                 "uncached_input_tokens", "cache_read_input_tokens", "cache_creation_5m_tokens", "cache_creation_1h_tokens", "is_synthetic"]
CACHE_COLUMNS = ["uncached_input_tokens", "cache_read_input_tokens", "cache_creation_5m_tokens", "cache_creation_1h_tokens"]
USAGE_KINDS = ["openai/text_generation", "openai/embedding", "anthropic/text_generation"]
REASONING_MODEL = "chat-large"
FAILURE_STAGES = ["rejected_pre_processing", "mid_generation_error"]


def _none_of(column: str, values: list[str]) -> str:
    return f"{column} IS NULL OR {column} NOT IN ({', '.join(repr(v) for v in values)})"


OPENAI, ANTHROPIC = "provider = 'openai'", "provider = 'anthropic'"
FILLED = " OR ".join(f"{c} IS NOT NULL" for c in CACHE_COLUMNS)

USAGE_RULES = {
    "synthetic_flag": "NOT is_synthetic",
    "reasoning_is_blank": "reasoning_tokens IS NOT NULL",
    "output_not_negative": "COALESCE(output_tokens, 0) < 0",
    "openai_has_request_count": f"{OPENAI} AND request_count IS NULL",
    "openai_cached_within_input": f"{OPENAI} AND NOT COALESCE(cached_input_tokens, 0) BETWEEN 0 AND COALESCE(input_tokens, 0)",
    "openai_has_no_anthropic_fields": f"{OPENAI} AND ({FILLED})",
    "embedding_has_no_output": "usage_type = 'embedding' AND COALESCE(output_tokens, 0) <> 0",
    "anthropic_has_no_openai_fields": f"{ANTHROPIC} AND (request_count IS NOT NULL OR input_tokens IS NOT NULL OR cached_input_tokens IS NOT NULL)",
    "anthropic_parts_not_negative": f"{ANTHROPIC} AND LEAST({', '.join(f'COALESCE({c}, 0)' for c in CACHE_COLUMNS)}) < 0",
    "batch_has_no_cache": "is_batch AND (COALESCE(cached_input_tokens, 0) <> 0 OR COALESCE(cache_read_input_tokens, 0) <> 0 "
                          "OR COALESCE(cache_creation_5m_tokens, 0) <> 0 OR COALESCE(cache_creation_1h_tokens, 0) <> 0)",
    "date_in_period": f"usage_date < DATE '{K.PERIOD_START}' OR usage_date > DATE '{K.PERIOD_END}'",
    "known_kind": _none_of("CONCAT(provider, '/', usage_type)", USAGE_KINDS),
}

COST_RULES = {
    "currency_is_usd": _none_of("billing_currency", ["USD"]),
    "synthetic_flag": "NOT is_synthetic",
    "known_line_type": _none_of("line_item_type", ["usage", *K.NON_USAGE_LINE_TYPES]),
    "usage_has_model": "line_item_type = 'usage' AND (line_item_scope <> 'model' OR COALESCE(model, '') = '')",
    "other_lines_have_no_model": "line_item_type <> 'usage' AND COALESCE(model, '') <> ''",
    "other_lines_have_no_reported_cost": "line_item_type <> 'usage' AND provider_reported_cost <> 0",
    "credit_is_negative": "line_item_type = 'credit' AND (credit_amount >= 0 OR invoice_billed_cost >= 0)",
    "only_credits_have_credit": "line_item_type <> 'credit' AND credit_amount <> 0",
    "adjustment_reason_present": "COALESCE(adjustment_reason, '') = ''",
}

TELEMETRY_RULES = {
    "synthetic_flag": "NOT is_synthetic",
    "retry_reason_only_on_retries": "is_final_attempt <> (COALESCE(retry_reason, '') = '')",
    "reasoning_within_output": "NOT COALESCE(reasoning_tokens, 0) BETWEEN 0 AND COALESCE(output_tokens, 0)",
    "cost_not_negative": "usage_cost_estimate < 0",
    "rejected_uses_nothing": "failure_stage = 'rejected_pre_processing' AND (COALESCE(input_tokens, 0) <> 0 OR "
                             "COALESCE(output_tokens, 0) <> 0 OR usage_cost_estimate <> 0)",
    "openai_cached_within_input": f"{OPENAI} AND COALESCE(cached_input_tokens, 0) > COALESCE(input_tokens, 0)",
    "openai_has_no_uncached_part": f"{OPENAI} AND COALESCE(uncached_input_tokens, 0) <> 0",
    "anthropic_has_no_input_total": f"{ANTHROPIC} AND (COALESCE(input_tokens, 0) <> 0 OR COALESCE(cached_input_tokens, 0) <> 0)",
    "reasoning_only_on_reasoning_model": f"COALESCE(reasoning_tokens, 0) > 0 AND NOT ({OPENAI} AND model = '{REASONING_MODEL}')",
    "success_has_no_failure_stage": "attempt_status = 'success' AND COALESCE(failure_stage, '') <> ''",
    "failure_has_known_stage": "attempt_status <> 'success' AND (" + _none_of("failure_stage", FAILURE_STAGES) + ")",
}


#: Rules of a whole feed: an aggregate that counts what is wrong.  The row band of the usage feed
#: is its grain: at least a row, at most one a day, key, model kind and batch flag.
USAGE_GRAINS_A_DAY = 10 * 3 * 2
USAGE_WHOLE = {"row_count_in_band": f"CAST(COUNT(*) NOT BETWEEN 1 AND {((K.PERIOD_END - K.PERIOD_START).days + 1) * USAGE_GRAINS_A_DAY} AS BIGINT)"}
COST_WHOLE = {
    "all_line_types_occur": " + ".join(f"CAST(count_if(line_item_type = '{t}') = 0 AS BIGINT)" for t in ["usage", *K.NON_USAGE_LINE_TYPES]),
    "totals_differ": "CAST(ABS(COALESCE(SUM(provider_reported_cost), 0) - COALESCE(SUM(invoice_billed_cost), 0)) < 0.000001 AS BIGINT)",
}


def validate(feed: DataFrame, rules: dict[str, str], columns: list[str] | None = None, whole: dict[str, str] | None = None) -> DataFrame:
    """(rule, violations) of one feed; one aggregate pass for the rules of rows and of the whole."""
    whole = whole or {}
    one = feed.agg(*[F.count_if(F.expr(p)).alias(n) for n, p in rules.items()], *[F.expr(p).alias(n) for n, p in whole.items()])
    pairs = [f"'{n}', {n}" for n in (*rules, *whole)]
    if columns is not None:
        pairs.append(f"'column_set', {len(set(columns) ^ set(feed.columns))}L")
    return one.select(F.expr(f"stack({len(pairs)}, {', '.join(pairs)})").alias("rule", "violations"))
