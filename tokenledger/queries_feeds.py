"""
states each rule the other way round: rows minus the rows that are in order."""

from __future__ import annotations

from tokenledger.quality import feed_validation as V
from tokenledger.queries import register_custom

USAGE_IN_ORDER = {
    "synthetic_flag": "is_synthetic", "reasoning_is_blank": "reasoning_tokens IS NULL", "output_not_negative": "ifnull(output_tokens, 0) >= 0",
    "openai_has_request_count": "provider != 'openai' OR request_count IS NOT NULL",
    "openai_cached_within_input": "provider != 'openai' OR (ifnull(cached_input_tokens, 0) >= 0 AND ifnull(input_tokens, 0) - ifnull(cached_input_tokens, 0) >= 0)",
    "openai_has_no_anthropic_fields": "provider != 'openai' OR coalesce(uncached_input_tokens, cache_read_input_tokens, cache_creation_5m_tokens, cache_creation_1h_tokens) IS NULL",
    "embedding_has_no_output": "usage_type != 'embedding' OR ifnull(output_tokens, 0) = 0",
    "anthropic_has_no_openai_fields": "provider != 'anthropic' OR coalesce(request_count, input_tokens, cached_input_tokens) IS NULL",
    "anthropic_parts_not_negative": "provider != 'anthropic' OR list_min([uncached_input_tokens, cache_read_input_tokens, cache_creation_5m_tokens, cache_creation_1h_tokens, 0]) >= 0",
    "batch_has_no_cache": "NOT is_batch OR list_max(list_transform([cached_input_tokens, cache_read_input_tokens, cache_creation_5m_tokens, cache_creation_1h_tokens], lambda x: abs(ifnull(x, 0)))) = 0",
    "date_in_period": "usage_date BETWEEN DATE '2025-01-01' AND DATE '2026-06-30'",
    "known_kind": "(provider, usage_type) IN (('openai', 'text_generation'), ('openai', 'embedding'), ('anthropic', 'text_generation'))",
}
COST_IN_ORDER = {
    "currency_is_usd": "billing_currency = 'USD'", "synthetic_flag": "is_synthetic",
    "known_line_type": "line_item_type IN ('usage', 'credit', 'commitment_true_up', 'correction', 'adjustment', 'tax')",
    "usage_has_model": "line_item_type != 'usage' OR (line_item_scope = 'model' AND length(model) > 0)",
    "other_lines_have_no_model": "line_item_type = 'usage' OR length(ifnull(model, '')) = 0",
    "other_lines_have_no_reported_cost": "line_item_type = 'usage' OR provider_reported_cost = 0",
    "credit_is_negative": "line_item_type != 'credit' OR greatest(credit_amount, invoice_billed_cost) < 0",
    "only_credits_have_credit": "line_item_type = 'credit' OR credit_amount = 0",
    "adjustment_reason_present": "length(adjustment_reason) > 0",
}
TELEMETRY_IN_ORDER = {
    "synthetic_flag": "is_synthetic", "retry_reason_only_on_retries": "is_final_attempt = (length(ifnull(retry_reason, '')) = 0)",
    "reasoning_within_output": "ifnull(reasoning_tokens, 0) >= 0 AND ifnull(output_tokens, 0) >= ifnull(reasoning_tokens, 0)",
    "cost_not_negative": "usage_cost_estimate >= 0",
    "rejected_uses_nothing": "ifnull(failure_stage, '') != 'rejected_pre_processing' OR (ifnull(input_tokens, 0), ifnull(output_tokens, 0), usage_cost_estimate) = (0, 0, 0)",
    "openai_cached_within_input": "provider != 'openai' OR ifnull(input_tokens, 0) - ifnull(cached_input_tokens, 0) >= 0",
    "openai_has_no_uncached_part": "provider != 'openai' OR ifnull(uncached_input_tokens, 0) = 0",
    "anthropic_has_no_input_total": "provider != 'anthropic' OR (ifnull(input_tokens, 0) = 0 AND ifnull(cached_input_tokens, 0) = 0)",
    "reasoning_only_on_reasoning_model": "ifnull(reasoning_tokens, 0) <= 0 OR provider || '/' || model = 'openai/chat-large'",
    "success_has_no_failure_stage": "attempt_status != 'success' OR length(ifnull(failure_stage, '')) = 0",
    "failure_has_known_stage": "attempt_status = 'success' OR ifnull(failure_stage, '') IN ('rejected_pre_processing', 'mid_generation_error')",
}


USAGE_WHOLE = {"row_count_in_band": "SELECT if(count(*) = 0 OR count(*) > 546 * 60, 1, 0) FROM raw_usage"}
COST_WHOLE = {
    "all_line_types_occur": "SELECT 6 - count(DISTINCT line_item_type) FILTER (WHERE line_item_type IN ('usage', 'credit', 'commitment_true_up', "
                            "'correction', 'adjustment', 'tax')) FROM raw_cost",
    "totals_differ": "SELECT count(*) FROM (SELECT sum(provider_reported_cost) AS r, sum(invoice_billed_cost) AS i FROM raw_cost) WHERE round(ifnull(r, 0), 6) = round(ifnull(i, 0), 6)",
}


def _sql(feed: str, in_order: dict[str, str], whole: dict[str, str] | None = None, column_set: bool = False) -> str:
    rows = [f"SELECT '{n}' AS rule, count(*) - count(*) FILTER (WHERE {p}) AS violations FROM {feed}" for n, p in in_order.items()]
    rows += [f"SELECT '{n}', ({text})" for n, text in (whole or {}).items()]
    if column_set:
        rows.append("SELECT 'column_set', 0")
    return "\nUNION ALL ".join(rows)


register_custom("feed_validation_usage", lambda p: V.validate(p.raw_usage, V.USAGE_RULES, V.USAGE_COLUMNS, V.USAGE_WHOLE),
                _sql("raw_usage", USAGE_IN_ORDER, USAGE_WHOLE, True))
register_custom("feed_validation_cost", lambda p: V.validate(p.raw_cost, V.COST_RULES, whole=V.COST_WHOLE), _sql("raw_cost", COST_IN_ORDER, COST_WHOLE))
register_custom("feed_validation_telemetry", lambda p: V.validate(p.raw_telemetry, V.TELEMETRY_RULES), _sql("raw_telemetry", TELEMETRY_IN_ORDER))
