"""DuckDB texts for the staging and core models (P01-P11), derived another way than the
Spark plans: dimensions are expanded to one row a day and met by equality, owners are lists
unnested per day, variances are checks in long form met with small rule tables, telemetry is
counted request by request first."""

from __future__ import annotations

from tokenledger.oracle.feeds_sql import CTES
from tokenledger.oracle.sqlfn import MONEY, hash_key, money, money_times_ratio, ratio, token_cost
from tokenledger.sources import constants as K


def trunc_month(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def days(start: str, end: str) -> str:
    return f"CAST(unnest(generate_series({start}, {end}, INTERVAL 1 DAY)) AS DATE)"


USAGE_GRAIN = ["usage_date", "provider", "usage_type", "provider_project_id", "api_key_id", "model",
               "provider_service_tier", "is_batch", "context_window_tier"]
RATE_KEY = ["provider", "usage_type", "model_snapshot", "normalized_processing_tier", "is_batch", "context_window_tier"]
RATE_FIELDS = {"effective_start": "rate_effective_start", "effective_end": "rate_effective_end",
               **{f: f for f in ["input_rate_per_million", "cached_input_rate_per_million", "cache_write_5m_rate_per_million",
                                 "cache_write_1h_rate_per_million", "output_rate_per_million", "contracted_discount",
                                 "rate_currency", "rate_basis", "rate_source", "rate_status"]}}

# uncached, cache read, five-minute write, one-hour write
_PARTS = """CASE provider
    WHEN 'openai' THEN [input_tokens - ifnull(cached_input_tokens, 0), ifnull(cached_input_tokens, 0), 0, 0]
    WHEN 'anthropic' THEN list_transform([uncached_input_tokens, cache_read_input_tokens, cache_creation_5m_tokens,
                                          cache_creation_1h_tokens], lambda x: ifnull(x, 0)) END"""
_TOTAL = "CAST(list_sum(parts) AS BIGINT)"

CTES["model_day"] = f"""
SELECT provider, usage_type, provider_model_name, day, count(*) AS n, arg_min(m, m.effective_start) AS pick
FROM (SELECT *, {days('effective_start', 'effective_end')} AS day, struct_pack(effective_start, effective_end, model_snapshot, reasoning_capable) AS m
      FROM model_map) GROUP BY ALL"""

CTES["tier_key"] = """
SELECT provider, provider_service_tier, is_batch, count(*) AS n, min(normalized_processing_tier) AS tier
FROM service_tier_map GROUP BY ALL"""

CTES["rate_day"] = f"""
SELECT {", ".join(RATE_KEY)}, day, count(*) AS n, arg_min(r, r.effective_start) AS pick
FROM (SELECT *, {days('effective_start', 'effective_end')} AS day, struct_pack({", ".join(RATE_FIELDS)}) AS r FROM rate_card)
GROUP BY ALL"""

_RESOLVED = "list_extract({names}, CAST(least({n}, 2) AS INT) + 1)"
_MODEL = "['Missing model map', 'Resolved', 'Multiple model maps']"
_TIER = "['Missing service tier', 'Resolved', 'Multiple service tiers']"

CTES["usage_normalized"] = f"""
SELECT * EXCLUDE (parts), {_TOTAL} AS normalized_total_input_tokens, parts[1] AS normalized_uncached_input_tokens,
  parts[2] AS normalized_cache_read_tokens, parts[3] AS normalized_cache_creation_5m_tokens,
  parts[4] AS normalized_cache_creation_1h_tokens, input_tokens + output_tokens AS provider_total_tokens,
  output_tokens - reasoning_tokens AS visible_output_tokens,
  {_RESOLVED.format(names=_MODEL, n='model_map_match_count')} AS model_map_resolution_status,
  {_RESOLVED.format(names=_TIER, n='service_tier_match_count')} AS service_tier_resolution_status,
  ifnull(list_filter([
      CASE WHEN output_tokens < reasoning_tokens THEN 'Invalid reasoning tokens' END,
      CASE WHEN provider = 'openai' AND parts[1] < 0 THEN 'Invalid cached input' END,
      CASE WHEN usage_type = 'embedding' AND output_tokens != 0 THEN 'Invalid embedding output' END], lambda x: x IS NOT NULL)[1],
    'Valid') AS token_validation_status
FROM (
  SELECT u.* REPLACE (ifnull(u.reasoning_tokens, 0) AS reasoning_tokens), {_PARTS.replace('provider', 'u.provider', 1)} AS parts,
    {hash_key(*[f'u.{c}' for c in USAGE_GRAIN])} AS source_usage_key,
    ifnull(d.n, 0) AS model_map_match_count, d.pick.model_snapshot AS model_snapshot,
    d.pick.effective_start AS model_map_effective_start, d.pick.effective_end AS model_map_effective_end,
    d.pick.reasoning_capable AS reasoning_capable,
    ifnull(t.n, 0) AS service_tier_match_count, t.tier AS normalized_processing_tier
  FROM raw_usage u
  LEFT JOIN model_day d ON (d.provider, d.usage_type, d.provider_model_name, d.day) = (u.provider, u.usage_type, u.model, u.usage_date)
  LEFT JOIN tier_key t ON (t.provider, t.provider_service_tier, t.is_batch) = (u.provider, u.provider_service_tier, u.is_batch)
)"""

_PRICE = token_cost("normalized_uncached_input_tokens", "normalized_cache_read_tokens",
                    "normalized_cache_creation_5m_tokens", "normalized_cache_creation_1h_tokens",
                    "output_tokens", "input_rate_per_million", "cached_input_rate_per_million",
                    "cache_write_5m_rate_per_million", "cache_write_1h_rate_per_million",
                    "output_rate_per_million", "contracted_discount")

CTES["usage_priced"] = f"""
SELECT *, CASE rate_match_count WHEN 1 THEN {_PRICE} END AS usage_cost_estimate,
  CASE least(rate_match_count, 2) WHEN 0 THEN 'Missing rate' WHEN 2 THEN 'Multiple rates'
    ELSE CASE WHEN rate_currency != 'USD' THEN 'Invalid currency'
              WHEN [token_validation_status, model_map_resolution_status, service_tier_resolution_status] = ['Valid', 'Resolved', 'Resolved']
              THEN 'Priced' ELSE 'Invalid upstream record' END END AS pricing_status
FROM (
  SELECT n.*, ifnull(r.n, 0) AS rate_match_count, {", ".join(f"r.pick.{f} AS {a}" for f, a in RATE_FIELDS.items())}
  FROM usage_normalized n LEFT JOIN rate_day r
    ON ({", ".join('r.' + k for k in RATE_KEY)}, r.day) = ({", ".join('n.' + k for k in RATE_KEY)}, n.usage_date)
)"""

CTES["provider_cost_stg"] = f"""
SELECT * REPLACE (CASE WHEN model != '' THEN model END AS model, upper(billing_currency) AS billing_currency,
    CASE WHEN adjustment_reason != '' THEN adjustment_reason END AS adjustment_reason),
  {trunc_month('billing_period')} AS billing_month,
  if(line_item_type = 'usage', 'Applicable', 'Not applicable') AS usage_reconciliation_applicability,
  if(upper(billing_currency) = 'USD', 'Valid', 'Invalid currency') AS financial_validation_status
FROM raw_cost"""

CTES["telemetry_stg"] = f"""
SELECT * EXCLUDE (parts), if(model LIKE 'text-embedding-%', 'embedding', 'text_generation') AS usage_type,
  {_TOTAL} AS normalized_total_input_tokens, parts[2] AS normalized_cache_read_tokens,
  input_tokens + output_tokens AS provider_total_tokens, output_tokens - reasoning_tokens AS visible_output_tokens,
  (final_request_status, is_final_attempt) = ('success', true) AS is_successful_logical_request,
  is_final_attempt = false AS is_retry_attempt,
  if(output_tokens < reasoning_tokens, 'Invalid reasoning tokens',
     if(provider = 'openai' AND input_tokens < cached_input_tokens, 'Invalid cached input', 'Valid')) AS telemetry_validation_status
FROM (SELECT *, {_PARTS} AS parts FROM raw_telemetry)"""

_MONTH_SUMS = ["request_count", "normalized_total_input_tokens", "normalized_uncached_input_tokens", "normalized_cache_read_tokens",
               "normalized_cache_creation_5m_tokens", "normalized_cache_creation_1h_tokens", "output_tokens", "reasoning_tokens",
               "visible_output_tokens"]

CTES["usage_cost_monthly"] = f"""
SELECT billing_month, provider, provider_project_id, model, sum(lines) AS source_daily_row_count,
  count(*) AS distinct_api_key_count, {", ".join(f"sum({c}) AS {c}" for c in _MONTH_SUMS)},
  {money('sum(cost)')} AS usage_cost_estimate, sum(unpriced) AS unpriced_daily_row_count, 'USD' AS estimate_currency
FROM (
  SELECT {trunc_month('usage_date')} AS billing_month, provider, provider_project_id, model, api_key_id, count(*) AS lines,
    {", ".join(f"sum({c}) AS {c}" for c in _MONTH_SUMS)}, sum(usage_cost_estimate) AS cost,
    sum(if(pricing_status = 'Priced', 0, 1)) AS unpriced
  FROM usage_priced GROUP BY ALL
) GROUP BY ALL"""

_EST = ["source_daily_row_count", "distinct_api_key_count", "request_count", "normalized_total_input_tokens", "output_tokens",
        "reasoning_tokens", "usage_cost_estimate", "estimate_currency", "unpriced_daily_row_count"]

_TYPE_CODES = ", ".join(f"('{t}', '{t.upper()}')" for t in K.NON_USAGE_LINE_TYPES)

# each line is checked twice: estimate -> reported (usage lines), reported -> invoiced (all lines)
CTES["recon_lines"] = f"""
SELECT {hash_key('c.billing_month', 'c.provider', 'c.provider_project_id', 'c.model', 'c.line_item_type', 'c.provider_line_item_id')}
    AS reconciliation_fact_id,
  c.* RENAME (adjustment_reason AS source_adjustment_reason), if(u.model IS NULL, 0, 1) AS usage_rollup_match_count,
  {", ".join('u.' + e for e in _EST)}
FROM provider_cost_stg c LEFT JOIN usage_cost_monthly u
  ON (u.billing_month, u.provider, u.provider_project_id, u.model, 'usage')
   = (c.billing_month, c.provider, c.provider_project_id, c.model, c.line_item_type)"""

CTES["recon_checks"] = f"""
SELECT line, kind, gap, pct, source, coalesce(
    CASE WHEN kind = 'usage' AND line_item_type != 'usage' THEN 'NOT_APPLICABLE' END,
    CASE WHEN least(abs(CAST(gap AS DOUBLE)) / 1.00, abs(pct) / 0.01) <= 1 THEN 'PASS' END, 'EXCEPTION') AS status
FROM (
  SELECT line, kind, line_item_type, source, gap, {ratio('gap', 'abs(base)')} AS pct
  FROM (
    SELECT reconciliation_fact_id AS line, line_item_type, source_adjustment_reason AS source, 'usage' AS kind,
      usage_cost_estimate AS base, CAST(if(line_item_type = 'usage', provider_reported_cost - usage_cost_estimate, NULL) AS {MONEY}) AS gap
    FROM recon_lines
    UNION ALL
    SELECT reconciliation_fact_id, line_item_type, source_adjustment_reason, 'invoice', provider_reported_cost,
      CAST(invoice_billed_cost - provider_reported_cost AS {MONEY})
    FROM recon_lines
  )
)"""

CTES["recon_reasons"] = f"""
SELECT c.line, c.kind, c.gap, c.pct, c.status, CASE c.status WHEN 'EXCEPTION' THEN
    if(c.kind = 'usage',
       if(c.gap IS NULL, 'MISSING_USAGE_ESTIMATE', coalesce(s.code, c.source, 'UNCLASSIFIED_USAGE_VARIANCE')),
       coalesce(c.source, t.code, 'UNCLASSIFIED_INVOICE_VARIANCE')) END AS reason
FROM recon_checks c
JOIN recon_lines l ON l.reconciliation_fact_id = c.line
LEFT JOIN (VALUES ('ROUTINE_ROUNDING', 'INDEPENDENT_SOURCE_ESTIMATE_DIFFERENCE')) s(source, code) ON s.source = c.source
LEFT JOIN (VALUES {_TYPE_CODES}) t(kind, code) ON t.kind = l.line_item_type"""

_PICK = "max(CASE kind WHEN '{k}' THEN {c} END)"

CTES["cost_reconciliation"] = f"""
SELECT l.*, r.* EXCLUDE (line), nullif(concat_ws('|', usage_variance_reason_code, invoice_variance_reason_code), '') AS variance_reason_code,
  if('EXCEPTION' IN (usage_reconciliation_status, invoice_reconciliation_status), 'EXCEPTION', 'PASS') AS exception_status
FROM recon_lines l JOIN (
  SELECT line, {_PICK.format(k='usage', c='gap')} AS usage_to_reported_variance, {_PICK.format(k='invoice', c='gap')} AS reported_to_invoice_variance,
    {_PICK.format(k='usage', c='pct')} AS usage_to_reported_variance_pct, {_PICK.format(k='invoice', c='pct')} AS reported_to_invoice_variance_pct,
    {_PICK.format(k='usage', c='status')} AS usage_reconciliation_status, {_PICK.format(k='invoice', c='status')} AS invoice_reconciliation_status,
    {_PICK.format(k='usage', c='reason')} AS usage_variance_reason_code, {_PICK.format(k='invoice', c='reason')} AS invoice_variance_reason_code
  FROM recon_reasons GROUP BY line
) r ON r.line = l.reconciliation_fact_id"""

# ---- P10 allocation: owners of each key and day as one list, the anchor first, the rest last ----
_ALLOC = {"request_count": "request_count", "normalized_total_input_tokens": "total_input_tokens",
          "normalized_uncached_input_tokens": "uncached_input_tokens", "normalized_cache_read_tokens": "cache_read_tokens",
          "normalized_cache_creation_5m_tokens": "cache_creation_5m_tokens", "normalized_cache_creation_1h_tokens": "cache_creation_1h_tokens",
          "output_tokens": "output_tokens", "reasoning_tokens": "reasoning_tokens", "visible_output_tokens": "visible_output_tokens",
          "usage_cost_estimate": "usage_cost_estimate"}
_OWNER = ["application_name", "department_name", "cost_center", "mapping_id", "allocation_percentage", "mapping_status",
          "allocation_method", "allocation_confidence", "effective_start_date", "effective_end_date", "mapping_recorded_date"]
_KIND = {m: "DECIMAL(32,13)" if m == "usage_cost_estimate" else "DECIMAL(28,4)" for m in _ALLOC}

CTES["owner_day"] = f"""
SELECT provider, provider_project_id, api_key_id, day, sum(allocation_percentage) AS mapped, list(o ORDER BY o) AS owners
FROM (SELECT *, {days('effective_start_date', 'effective_end_date')} AS day, struct_pack({", ".join(_OWNER)}) AS o FROM bridge)
GROUP BY ALL"""

_REST = ("struct_pack(application_name := 'Unallocated', department_name := 'Unallocated', cost_center := 'UNALLOCATED', "
         "mapping_id := CAST(NULL AS VARCHAR), allocation_percentage := CAST(1 - ifnull(d.mapped, 0) AS DECIMAL(5,4)), "
         "mapping_status := 'unallocated', allocation_method := if(d.day IS NULL, 'no_mapping', 'unallocated_residual'), "
         "allocation_confidence := 'none', effective_start_date := CAST(NULL AS DATE), effective_end_date := CAST(NULL AS DATE), "
         "mapping_recorded_date := CAST(NULL AS DATE))")
_DAY_COLS = ["source_usage_key", "usage_date", "provider", "usage_type", "provider_project_id", "api_key_id", "model", "model_snapshot",
             "provider_service_tier", "normalized_processing_tier", "is_batch", "context_window_tier"]


def _part(m: str, n: str, status: str) -> str:
    return (f"if(allocation_status = '{status}', CAST({m} * allocation_percentage AS {_KIND[m]}), CAST(0 AS {_KIND[m]})) "
            f"AS {status.lower()}_{n}")


CTES["usage_daily"] = f"""
SELECT {hash_key('source_usage_key', 'application_name', 'department_name', 'cost_center', 'allocation_status', "ifnull(mapping_id, 'UNALLOCATED')")}
    AS usage_allocation_fact_id,
  {", ".join(_DAY_COLS)}, {", ".join(_OWNER)},
  ifnull(mapping_recorded_date > greatest(effective_start_date, usage_date), false) AS is_historical_restatement,
  allocation_status, CAST(greatest(mapped, 1) AS DECIMAL(7,4)) AS total_distribution_percentage, place = 1 AS source_measure_anchor_flag,
  {", ".join(f"if(place = 1, {m}, NULL) AS source_{n}" for m, n in _ALLOC.items())},
  {", ".join(_part(m, n, 'Allocated') for m, n in _ALLOC.items())},
  {", ".join(_part(m, n, 'Unallocated') for m, n in _ALLOC.items())},
  rate_currency AS billing_currency, is_synthetic
FROM (
  SELECT * EXCLUDE (entry), {", ".join(f"entry.{c} AS {c}" for c in _OWNER)},
    if(entry.mapping_id IS NULL, 'Unallocated', 'Allocated') AS allocation_status
  FROM (
    SELECT u.*, ifnull(d.mapped, 0) AS mapped, unnest(list_concat(ifnull(d.owners, []), if(ifnull(d.mapped, 0) < 1, [{_REST}], []))) AS entry,
      unnest(range(1, len(ifnull(d.owners, [])) + if(ifnull(d.mapped, 0) < 1, 2, 1))) AS place
    FROM usage_priced u LEFT JOIN owner_day d
      ON (d.provider, d.provider_project_id, d.api_key_id, d.day) = (u.provider, u.provider_project_id, u.api_key_id, u.usage_date)
    WHERE u.pricing_status = 'Priced'
  )
)"""

_DRIVERS = ["request_count", "total_input_tokens", "output_tokens", "reasoning_tokens"]
CTES["app_driver_monthly"] = f"""
SELECT {trunc_month('usage_date')} AS billing_month, provider, provider_project_id, model, model_snapshot, usage_type,
  application_name, department_name, cost_center, allocation_status, allocation_method, allocation_confidence, billing_currency,
  max(is_historical_restatement) AS is_historical_restatement, min(is_synthetic) AS is_synthetic,
  {", ".join(f"CAST(sum(if(allocation_status = 'Allocated', allocated_{n}, unallocated_{n})) AS DECIMAL(28,4)) AS distributed_{n}" for n in _DRIVERS)},
  {money("sum(if(allocation_status = 'Allocated', allocated_usage_cost_estimate, unallocated_usage_cost_estimate))")} AS driver_usage_cost_estimate
FROM usage_daily GROUP BY ALL"""

# ---- P11: one row a request and day first; both sides stacked and folded by key --------------------
CTES["provider_usage_daily"] = f"""
SELECT usage_date, provider, provider_project_id, model, usage_type, count(*) AS provider_usage_row_count,
  sum(request_count) AS provider_request_count, sum(normalized_total_input_tokens) AS provider_input_tokens,
  sum(output_tokens) AS provider_output_tokens, sum(normalized_total_input_tokens) + sum(output_tokens) AS provider_total_tokens,
  {money('sum(usage_cost_estimate)')} AS provider_usage_cost_estimate
FROM usage_priced WHERE pricing_status = 'Priced' GROUP BY ALL"""

ATTEMPT_SUMS = {
    "attempts": "count(*)", "finals": "sum(CAST(is_final_attempt AS INT))", "successes": "sum(CAST(is_successful_logical_request AS INT))",
    "retries": "sum(CAST(is_retry_attempt AS INT))", "failures": "sum(if(attempt_status = 'failed', 1, 0))",
    "tokens_in": "sum(normalized_total_input_tokens)", "tokens_out": "sum(output_tokens)", "cost": "sum(usage_cost_estimate)",
    "cost_retry": f"sum(if(is_retry_attempt, usage_cost_estimate, CAST(0 AS {MONEY})))",
    "cost_failed": f"sum(if(attempt_status = 'failed', usage_cost_estimate, CAST(0 AS {MONEY})))",
    "cost_mid": f"sum(if(ifnull(failure_stage, '') = 'mid_generation_error', usage_cost_estimate, CAST(0 AS {MONEY})))"}


def requests_of(keys: str, where: str = "true") -> str:
    """One row a logical request and key: the sums of its valid attempts."""
    sums = ", ".join(f"{e} AS {n}" for n, e in ATTEMPT_SUMS.items())
    return (f"SELECT {keys}, logical_request_id, {sums} FROM telemetry_stg "
            f"WHERE telemetry_validation_status = 'Valid' AND {where} GROUP BY ALL")


CTES["telemetry_daily"] = f"""
SELECT usage_date, provider, provider_project_id, model, usage_type, count(*) AS telemetry_logical_request_count,
  sum(attempts) AS telemetry_attempt_count, sum(finals) AS telemetry_final_attempt_count,
  sum(successes) AS telemetry_successful_logical_request_count, sum(retries) AS telemetry_retry_attempt_count,
  sum(failures) AS telemetry_failed_attempt_count, sum(tokens_in) AS telemetry_input_tokens, sum(tokens_out) AS telemetry_output_tokens,
  sum(tokens_in) + sum(tokens_out) AS telemetry_total_tokens, {money('sum(cost)')} AS telemetry_usage_cost_estimate,
  {money('sum(cost_retry)')} AS telemetry_retry_cost_estimate, {money('sum(cost_failed)')} AS telemetry_failed_attempt_cost_estimate,
  {money('sum(cost_mid)')} AS telemetry_mid_generation_failure_cost_estimate, sum(attempts) AS telemetry_row_count
FROM ({requests_of('usage_date, provider, provider_project_id, model, usage_type')}) GROUP BY ALL"""

_SIDES = {"p": ["provider_request_count", "provider_input_tokens", "provider_output_tokens", "provider_total_tokens",
                "provider_usage_cost_estimate", "provider_usage_row_count"],
          "t": ["telemetry_attempt_count", "telemetry_logical_request_count", "telemetry_final_attempt_count",
                "telemetry_successful_logical_request_count", "telemetry_retry_attempt_count", "telemetry_failed_attempt_count",
                "telemetry_input_tokens", "telemetry_output_tokens", "telemetry_total_tokens", "telemetry_usage_cost_estimate",
                "telemetry_retry_cost_estimate", "telemetry_failed_attempt_cost_estimate",
                "telemetry_mid_generation_failure_cost_estimate", "telemetry_row_count"]}
_GAPS = {"request_count_variance": ("telemetry_attempt_count", "provider_request_count"),
         "token_count_variance": ("telemetry_total_tokens", "provider_total_tokens"),
         "input_token_variance": ("telemetry_input_tokens", "provider_input_tokens"),
         "output_token_variance": ("telemetry_output_tokens", "provider_output_tokens")}

CTES["telemetry_sides"] = f"""
SELECT usage_date, provider, provider_project_id, model, usage_type,
  {", ".join(f"max({c}) AS {c}" for c in _SIDES['p'] + _SIDES['t'])},
  max(side = 'p') AS has_provider_usage, max(side = 't') AS has_telemetry
FROM (SELECT *, 'p' AS side FROM provider_usage_daily UNION ALL BY NAME SELECT *, 't' AS side FROM telemetry_daily)
GROUP BY ALL"""

# coverage verdicts: coverage_status, reconciliation_status, variance_reason_code
_VERDICTS = """(VALUES ('none_p', 'NO_PROVIDER_USAGE', 'EXCEPTION', 'TELEMETRY_WITHOUT_PROVIDER_USAGE'),
  ('none_t', 'NO_TELEMETRY', 'EXCEPTION', 'PROVIDER_USAGE_WITHOUT_TELEMETRY'), ('low', 'PARTIAL_COVERAGE', 'EXCEPTION', 'INCOMPLETE_TELEMETRY_CAPTURE'),
  ('high', 'OVER_COVERAGE', 'EXCEPTION', 'TELEMETRY_EXCEEDS_PROVIDER_USAGE'), ('blind', 'REQUEST_COUNT_UNAVAILABLE', 'PASS', NULL),
  ('count', 'REQUEST_MISMATCH', 'EXCEPTION', 'REQUEST_COUNT_DIFFERENCE'), ('fine', 'WITHIN_TOLERANCE', 'PASS', NULL))
  v(verdict, coverage_status, reconciliation_status, variance_reason_code)"""

CTES["telemetry_recon_daily"] = f"""
SELECT * EXCLUDE (verdict, untraced),
  CASE WHEN provider_total_tokens = 0 THEN provider_usage_cost_estimate
       ELSE {money_times_ratio('provider_usage_cost_estimate', 'untraced')} END AS untraceable_provider_usage_cost_estimate
FROM (
  SELECT *, CASE WHEN NOT has_provider_usage THEN 'none_p' WHEN NOT has_telemetry THEN 'none_t'
      WHEN telemetry_token_coverage_pct NOT BETWEEN 0.95 AND 1.05 THEN if(telemetry_token_coverage_pct < 1, 'low', 'high')
      WHEN provider_request_count IS NULL THEN 'blind' WHEN abs(request_count_variance_pct) > 0.05 THEN 'count' ELSE 'fine' END AS verdict,
    greatest(1.0 - ifnull(telemetry_token_coverage_pct, 0.0), 0.0) AS untraced
  FROM (
    SELECT {hash_key('usage_date', 'provider', 'provider_project_id', 'model')} AS telemetry_reconciliation_id, *,
      {", ".join(f"{a} - {b} AS {n}" for n, (a, b) in _GAPS.items())},
      {ratio('telemetry_total_tokens', 'provider_total_tokens')} AS telemetry_token_coverage_pct,
      {ratio('telemetry_attempt_count', 'provider_request_count')} AS telemetry_request_coverage_pct,
      {ratio('telemetry_attempt_count - provider_request_count', 'provider_request_count')} AS request_count_variance_pct,
      {ratio('telemetry_total_tokens - provider_total_tokens', 'provider_total_tokens')} AS token_count_variance_pct
    FROM telemetry_sides
  )
) JOIN {_VERDICTS} USING (verdict)"""
