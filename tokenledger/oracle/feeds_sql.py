"""DuckDB CTE texts for the eight feeds (same rules as tokenledger.sources.feeds)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tokenledger.oracle.sqlfn import MONEY, token_cost
from tokenledger.sources import constants as K


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, Decimal):
        return f"{v}"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def values_cte(rows, cols, types) -> str:
    body = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    sel = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in zip(cols, types))
    return f"SELECT {sel} FROM (VALUES\n    {body}) AS v({', '.join(cols)})"


FOLD = ("CAST(DATE '2025-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST({c} AS DATE)) % 546 "
        "AS INTEGER) AS DATE)")

CTES: dict[str, str] = {}

CTES["line_base"] = f"""
SELECT *,
  CASE WHEN provider = 'openai' THEN 'default' WHEN is_batch THEN 'batch' ELSE 'standard' END AS provider_service_tier,
  'standard' AS context_window_tier,
  CASE WHEN is_batch THEN CAST(0 AS BIGINT) ELSE (in_tok * disc_pct * 5) // 100 END AS cached_tok,
  CASE WHEN is_batch OR provider = 'openai' THEN CAST(0 AS BIGINT) ELSE (in_tok * 2) // 100 END AS w5_tok,
  CASE WHEN is_batch OR provider = 'openai' THEN CAST(0 AS BIGINT) ELSE in_tok // 100 END AS w1_tok,
  CASE WHEN model = 'chat-large' THEN (out_tok * tax_pct) // 100 ELSE CAST(0 AS BIGINT) END AS reasoning_tok
FROM (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
              CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y-%m-%d'),
              CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS logical_request_id,
    l_orderkey, l_partkey,
    {FOLD.format(c='l_shipdate')} AS usage_date,
    CASE WHEN l_suppkey % 2 = 0 THEN 'openai' ELSE 'anthropic' END AS provider,
    'proj-' || CAST((l_suppkey % 10) // 2 AS VARCHAR) AS provider_project_id,
    'key-' || CAST(l_suppkey % 10 AS VARCHAR) AS api_key_id,
    CASE WHEN l_suppkey % 2 = 0 AND l_partkey % 5 = 0 THEN 'embedding' ELSE 'text_generation' END AS usage_type,
    CASE WHEN l_suppkey % 2 = 0 THEN
           CASE WHEN l_partkey % 5 = 0 THEN 'text-embedding-s' WHEN l_partkey % 5 <= 2 THEN 'chat-mini'
                ELSE 'chat-large' END
         ELSE CASE WHEN l_partkey % 5 < 2 THEN 'assist-small' ELSE 'assist-large' END END AS model,
    (l_linestatus = 'F' AND l_returnflag = 'R') AS is_batch,
    CAST(floor(l_extendedprice) AS BIGINT) * 100 AS in_tok,
    CASE WHEN l_suppkey % 2 = 0 AND l_partkey % 5 = 0 THEN CAST(0 AS BIGINT)
         ELSE CAST(l_quantity AS BIGINT) * 2000 END AS out_tok,
    CAST(round(l_discount * 100) AS BIGINT) AS disc_pct,
    CAST(round(l_tax * 100) AS BIGINT) AS tax_pct,
    1 + CAST(l_partkey % 9 = 0 AS INTEGER) + CAST(l_partkey % 27 = 0 AS INTEGER) AS attempts,
    (l_orderkey + l_linenumber) % 25 <> 0 AS has_telemetry,
    l_orderkey % 29 = 0 AS final_failed,
    l_partkey % 54 = 0 AS rejected_retries,
    CASE WHEN l_partkey % 16 < 4 THEN 'EXP-' || CAST(l_partkey % 4 AS VARCHAR) END AS experiment_id
  FROM lineitem
) b"""

CTES["raw_usage"] = """
SELECT usage_date, provider, usage_type, provider_project_id, api_key_id, model,
  provider_service_tier, is_batch, context_window_tier,
  CASE WHEN provider = 'openai' THEN _req END AS request_count,
  CASE WHEN provider = 'openai' THEN _in END AS input_tokens,
  _out AS output_tokens,
  CAST(NULL AS BIGINT) AS reasoning_tokens,
  CASE WHEN provider = 'openai' THEN _cached END AS cached_input_tokens,
  CASE WHEN provider = 'openai' THEN NULL ELSE _in - _cached - _w5 - _w1 END AS uncached_input_tokens,
  CASE WHEN provider = 'openai' THEN NULL ELSE _cached END AS cache_read_input_tokens,
  CASE WHEN provider = 'openai' THEN NULL ELSE _w5 END AS cache_creation_5m_tokens,
  CASE WHEN provider = 'openai' THEN NULL ELSE _w1 END AS cache_creation_1h_tokens,
  TRUE AS is_synthetic
FROM (
  SELECT usage_date, provider, usage_type, provider_project_id, api_key_id, model,
    provider_service_tier, is_batch, context_window_tier,
    CAST(SUM(attempts) AS BIGINT) AS _req, CAST(SUM(in_tok * attempts) AS BIGINT) AS _in,
    CAST(SUM(cached_tok * attempts) AS BIGINT) AS _cached, CAST(SUM(w5_tok * attempts) AS BIGINT) AS _w5,
    CAST(SUM(w1_tok * attempts) AS BIGINT) AS _w1, CAST(SUM(out_tok * attempts) AS BIGINT) AS _out
  FROM line_base
  GROUP BY ALL
) g"""

_MM_COLS = ["provider", "usage_type", "provider_model_name", "model_snapshot", "effective_start",
            "effective_end", "reasoning_capable"]
_MM_TYPES = ["VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR", "DATE", "DATE", "BOOLEAN"]
CTES["model_map"] = values_cte(K.MODEL_MAP, _MM_COLS, _MM_TYPES)

_TIER_COLS = ["provider", "provider_service_tier", "is_batch", "normalized_processing_tier"]
CTES["service_tier_map"] = values_cte(K.SERVICE_TIER_MAP, _TIER_COLS,
                                      ["VARCHAR", "VARCHAR", "BOOLEAN", "VARCHAR"])

RATE_COLS = ["provider", "usage_type", "model_snapshot", "normalized_processing_tier", "is_batch",
             "context_window_tier", "effective_start", "effective_end", "input_rate_per_million",
             "cached_input_rate_per_million", "cache_write_5m_rate_per_million",
             "cache_write_1h_rate_per_million", "output_rate_per_million", "contracted_discount",
             "rate_currency", "rate_basis", "rate_source", "retrieved_date", "rate_status"]
_RATE_TYPES = ["VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR", "BOOLEAN", "VARCHAR", "DATE", "DATE",
               "DECIMAL(10,6)", "DECIMAL(10,6)", "DECIMAL(10,6)", "DECIMAL(10,6)", "DECIMAL(10,6)",
               "DECIMAL(5,4)", "VARCHAR", "VARCHAR", "VARCHAR", "DATE", "VARCHAR"]
CTES["rate_card"] = values_cte([tuple(r[c] for c in RATE_COLS) for r in K.rate_card_rows()],
                               RATE_COLS, _RATE_TYPES)

_BRIDGE_COLS = ["mapping_id", "provider", "provider_project_id", "api_key_id", "application_name",
                "department_name", "cost_center", "allocation_percentage", "effective_start_date",
                "effective_end_date", "mapping_status", "allocation_method", "allocation_confidence",
                "mapping_recorded_date", "is_synthetic"]
_BRIDGE_TYPES = ["VARCHAR"] * 7 + ["DECIMAL(5,4)", "DATE", "DATE", "VARCHAR", "VARCHAR", "VARCHAR",
                                   "DATE", "BOOLEAN"]
CTES["bridge"] = values_cte(
    [(mid, "openai" if k % 2 == 0 else "anthropic", f"proj-{k // 2}", f"key-{k}", app, dept, cc, pct,
      s, e, "active", "mapped", conf, rec, True)
     for (mid, k, app, dept, cc, pct, s, e, conf, rec) in K.BRIDGE], _BRIDGE_COLS, _BRIDGE_TYPES)

_EXP_COLS = ["experiment_id", "owner", "approver", "hypothesis", "application_name", "cost_center",
             "spending_limit", "spending_limit_period", "limit_currency", "warning_threshold",
             "hard_stop_threshold", "start_date", "planned_end_date", "current_status",
             "override_reason", "is_synthetic"]
_EXP_TYPES = ["VARCHAR"] * 6 + [MONEY, "VARCHAR", "VARCHAR", "DECIMAL(5,4)", "DECIMAL(5,4)", "DATE",
                                "DATE", "VARCHAR", "VARCHAR", "BOOLEAN"]
CTES["experiment_control"] = values_cte(
    [(e[0], e[1], e[2], e[3], e[4], e[5], e[6], e[7], "USD", e[8], e[9], e[10], e[11], e[12], e[13], True)
     for e in K.EXPERIMENTS], _EXP_COLS, _EXP_TYPES)

_DEC_COLS = ["experiment_decision_id", "experiment_id", "decision", "decision_date", "decided_by",
             "rationale", "previous_status", "new_status", "is_synthetic"]
CTES["experiment_decision"] = values_cte(
    [d + (True,) for d in K.DECISIONS], _DEC_COLS,
    ["VARCHAR", "VARCHAR", "VARCHAR", "DATE", "VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR", "BOOLEAN"])

_TEL_COST = token_cost("in_tok - cached_tok - w5_tok - w1_tok", "cached_tok", "w5_tok", "w1_tok",
                       "out_tok", "r.input_rate_per_million", "r.cached_input_rate_per_million",
                       "r.cache_write_5m_rate_per_million", "r.cache_write_1h_rate_per_million",
                       "r.output_rate_per_million", "r.contracted_discount")

CTES["tel_lines"] = f"""
SELECT b.*, {_TEL_COST} AS line_cost
FROM line_base b
LEFT JOIN model_map m
  ON m.provider = b.provider AND m.usage_type = b.usage_type AND m.provider_model_name = b.model
  AND b.usage_date BETWEEN m.effective_start AND m.effective_end
LEFT JOIN rate_card r
  ON r.provider = b.provider AND r.usage_type = b.usage_type AND r.model_snapshot = m.model_snapshot
  AND r.normalized_processing_tier = 'standard' AND r.is_batch = b.is_batch
  AND r.context_window_tier = b.context_window_tier
  AND b.usage_date BETWEEN r.effective_start AND r.effective_end
WHERE b.has_telemetry"""

CTES["raw_telemetry"] = f"""
SELECT logical_request_id,
  logical_request_id || '-' || CAST(attempt_number AS VARCHAR) AS provider_request_id,
  CAST(attempt_number AS BIGINT) AS attempt_number,
  CASE WHEN is_final THEN final_status ELSE 'failed' END AS attempt_status,
  is_final AS is_final_attempt,
  final_status AS final_request_status,
  CASE WHEN NOT is_final THEN 'timeout' END AS retry_reason,
  usage_date, provider, provider_project_id, api_key_id,
  'app-' || api_key_id AS application_name,
  experiment_id, model,
  CASE WHEN rejected THEN 'rejected_pre_processing'
       WHEN NOT is_final OR final_failed THEN 'mid_generation_error' END AS failure_stage,
  CASE WHEN rejected OR provider <> 'openai' THEN 0 ELSE in_tok END AS input_tokens,
  CASE WHEN rejected THEN 0 ELSE out_tok END AS output_tokens,
  CASE WHEN rejected THEN 0 ELSE reasoning_tok END AS reasoning_tokens,
  CASE WHEN rejected OR provider <> 'openai' THEN 0 ELSE cached_tok END AS cached_input_tokens,
  CASE WHEN rejected OR provider = 'openai' THEN 0 ELSE in_tok - cached_tok - w5_tok - w1_tok END AS uncached_input_tokens,
  CASE WHEN rejected OR provider = 'openai' THEN 0 ELSE cached_tok END AS cache_read_input_tokens,
  CASE WHEN rejected THEN 0 ELSE w5_tok END AS cache_creation_5m_tokens,
  CASE WHEN rejected THEN 0 ELSE w1_tok END AS cache_creation_1h_tokens,
  CASE WHEN rejected THEN CAST(0 AS {MONEY}) ELSE line_cost END AS usage_cost_estimate,
  TRUE AS is_synthetic
FROM (
  SELECT t.*, a.attempt_number,
    a.attempt_number = t.attempts AS is_final,
    CASE WHEN t.final_failed THEN 'failed' ELSE 'success' END AS final_status,
    a.attempt_number < t.attempts AND t.rejected_retries AS rejected
  FROM tel_lines t, LATERAL (SELECT unnest(range(1, t.attempts + 1)) AS attempt_number) a
) x"""

_F_REP = "CAST(1 + CAST(((month(billing_month) * 7 + ascii(right(provider_project_id, 1)) * 3 + length(model)) % 9) - 4 AS DECIMAL(3,0)) * CAST(0.004 AS DECIMAL(4,3)) AS DECIMAL(5,3))"
_F_INV = "CAST(1 + CAST(((month(billing_month) * 5 + ascii(right(provider_project_id, 1)) + length(model) * 2) % 7) - 3 AS DECIMAL(3,0)) * CAST(0.005 AS DECIMAL(4,3)) AS DECIMAL(5,3))"

CTES["usage_lines"] = f"""
SELECT billing_month AS billing_period, provider, provider_project_id, model,
  'model' AS line_item_scope, 'usage' AS line_item_type,
  concat_ws('-', 'usage', strftime(billing_month, '%Y%m'), provider_project_id, model) AS provider_line_item_id,
  reported AS provider_reported_cost,
  CAST(ROUND(reported * f_inv, 6) AS {MONEY}) AS invoice_billed_cost,
  'USD' AS billing_currency, CAST(0 AS {MONEY}) AS credit_amount,
  CASE month(billing_month) % 4 WHEN 0 THEN 'LATE_USAGE' WHEN 1 THEN 'INVOICE_CUTOFF'
       WHEN 2 THEN 'ROUTINE_ROUNDING' END AS adjustment_reason,
  CAST(last_day(billing_month) + 5 AS DATE) AS invoice_issue_date,
  FALSE AS is_restatement, TRUE AS is_synthetic
FROM (
  SELECT *, CAST(ROUND(CAST(usage_cost_estimate AS {MONEY}) * {_F_REP}, 6) AS {MONEY}) AS reported,
    {_F_INV} AS f_inv
  FROM usage_cost_monthly
) u"""

_TYPE_CASE = "CASE left(o_orderpriority, 1) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in K.PRIORITY_LINE_TYPE.items()) + " END"

CTES["non_usage_lines"] = f"""
SELECT billing_period,
  CASE WHEN k % 2 = 0 THEN 'openai' ELSE 'anthropic' END AS provider,
  'proj-' || CAST(k // 2 AS VARCHAR) AS provider_project_id,
  CAST(NULL AS VARCHAR) AS model,
  CASE WHEN line_item_type = 'tax' THEN 'invoice' ELSE 'project' END AS line_item_scope,
  line_item_type,
  concat_ws('-', line_item_type, strftime(billing_period, '%Y%m'), 'key', CAST(k AS VARCHAR)) AS provider_line_item_id,
  CAST(0 AS {MONEY}) AS provider_reported_cost,
  CAST(signed AS {MONEY}) AS invoice_billed_cost,
  'USD' AS billing_currency,
  CAST(CASE WHEN line_item_type = 'credit' THEN signed ELSE 0 END AS {MONEY}) AS credit_amount,
  CAST(NULL AS VARCHAR) AS adjustment_reason,
  CAST(last_day(billing_period) + 5 AS DATE) AS invoice_issue_date,
  line_item_type = 'correction' AS is_restatement,
  TRUE AS is_synthetic
FROM (
  SELECT *, CASE WHEN line_item_type IN ('credit', 'correction') THEN -amount ELSE amount END AS signed
  FROM (
    SELECT billing_period, k, line_item_type,
      CAST(SUM(price) * CAST(0.0001 AS DECIMAL(5,4)) AS {MONEY}) AS amount
    FROM (
      SELECT CAST(date_trunc('month', {FOLD.format(c='o_orderdate')}) AS DATE) AS billing_period,
        o_custkey % 10 AS k, {_TYPE_CASE} AS line_item_type,
        CAST(o_totalprice AS DECIMAL(15,2)) AS price
      FROM orders
    ) o
    GROUP BY billing_period, k, line_item_type
  ) g
) s"""

CTES["raw_cost"] = """
SELECT * FROM usage_lines
UNION ALL
SELECT * FROM non_usage_lines"""
