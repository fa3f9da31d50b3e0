"""DuckDB CTE texts for the semantic layer."""

from __future__ import annotations

from tokenledger.oracle.feeds_sql import CTES
from tokenledger.oracle.sqlfn import MONEY, hash_key, money
from tokenledger.plans.semantic import (EXP_CURRENT_COLS, FIN_KEYS, OPT_FACT_COLS, UNIT_FACT_COLS,
                                        USAGE_FACT_COLS)

NA = "'Not applicable'"
PK = hash_key("provider")
MKEY = hash_key("provider", "model", "model_snapshot", "usage_type")
AKEY = hash_key("application_name", "department_name", "cost_center")


def dk(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


CTES["dim_date"] = f"""
SELECT {dk('date')} AS date_key, date, year(date) AS year, quarter(date) AS quarter_number,
  'Q' || CAST(quarter(date) AS VARCHAR) AS quarter_name, month(date) AS month_number,
  strftime(date, '%B') AS month_name, strftime(date, '%b') AS month_short_name,
  strftime(date, '%Y-%m') AS year_month, year(date) * 100 + month(date) AS year_month_sort,
  CAST(date_trunc('month', date) AS DATE) AS month_start_date, last_day(date) AS month_end_date,
  day(date) AS day_of_month, strftime(date, '%A') AS day_name, dayofweek(date) + 1 AS day_of_week_number
FROM (
  SELECT CAST(unnest(generate_series(min(usage_date), max(usage_date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM usage_priced
) d"""

CTES["dim_provider"] = f"""
SELECT {PK} AS provider_key, provider,
  CASE WHEN provider = 'openai' THEN 'OpenAI' WHEN provider = 'anthropic' THEN 'Anthropic' ELSE provider END
    AS provider_display_name
FROM (SELECT provider FROM token_economics UNION SELECT provider FROM application_cost) p"""

_M = f"provider, COALESCE(model, {NA}) AS model, COALESCE(model_snapshot, {NA}) AS model_snapshot, COALESCE(usage_type, {NA}) AS usage_type"
CTES["dim_model"] = f"""
SELECT {MKEY} AS model_key, provider, model, model_snapshot, usage_type, provider || ' | ' || model AS provider_model_label
FROM (SELECT {_M} FROM token_economics UNION SELECT {_M} FROM application_cost) m"""

CTES["dim_application"] = f"""
SELECT {AKEY} AS application_key, application_name, department_name, cost_center,
  application_name = 'Unallocated' AS is_unallocated
FROM (
  SELECT DISTINCT COALESCE(application_name, 'Unallocated') AS application_name,
    COALESCE(department_name, 'Unallocated') AS department_name, COALESCE(cost_center, 'UNALLOCATED') AS cost_center
  FROM application_cost
) a"""

_Z = f"CAST(0 AS {MONEY})"
_Z4 = "CAST(0 AS DECIMAL(28,4))"
_Q = ["distributed_request_count", "distributed_total_input_tokens", "distributed_output_tokens",
      "distributed_reasoning_tokens"]
_MON = ["usage_cost_estimate", "provider_reported_cost", "invoice_billed_cost", "allocated_invoice_billed_cost",
        "unallocated_invoice_billed_cost"]

CTES["fact_financial_monthly"] = f"""
SELECT {hash_key(*FIN_KEYS)} AS financial_monthly_id, {dk('billing_month')} AS date_key, {PK} AS provider_key,
  {MKEY} AS model_key, {AKEY} AS application_key, *
FROM (
  SELECT {", ".join(FIN_KEYS)}, bool_or(is_historical_restatement) AS has_historical_restatement,
    {", ".join(f"CAST(SUM({x}) AS DECIMAL(28,4)) AS {x}" for x in _Q)},
    {", ".join(f"{money(f'SUM({x})')} AS {x}" for x in _MON)},
    min(billing_currency) AS billing_currency, min(financial_basis) AS financial_basis
  FROM (
    SELECT billing_month, provider, provider_project_id, COALESCE(model, {NA}) AS model,
      COALESCE(model_snapshot, {NA}) AS model_snapshot, COALESCE(usage_type, {NA}) AS usage_type,
      line_item_scope, line_item_type, COALESCE(application_name, 'Unallocated') AS application_name,
      COALESCE(department_name, 'Unallocated') AS department_name, COALESCE(cost_center, 'UNALLOCATED') AS cost_center,
      allocation_status, allocation_method, allocation_confidence,
      COALESCE(is_historical_restatement, FALSE) AS is_historical_restatement,
      {", ".join(f"COALESCE({x}, {_Z4}) AS {x}" for x in _Q)},
      COALESCE(allocated_usage_cost_estimate, {_Z}) + COALESCE(unallocated_usage_cost_estimate, {_Z}) AS usage_cost_estimate,
      COALESCE(allocated_provider_reported_cost, {_Z}) + COALESCE(unallocated_provider_reported_cost, {_Z}) AS provider_reported_cost,
      COALESCE(allocated_invoice_billed_cost, {_Z}) + COALESCE(unallocated_invoice_billed_cost, {_Z}) AS invoice_billed_cost,
      COALESCE(allocated_invoice_billed_cost, {_Z}) AS allocated_invoice_billed_cost,
      COALESCE(unallocated_invoice_billed_cost, {_Z}) AS unallocated_invoice_billed_cost,
      billing_currency, financial_basis
    FROM application_cost
  ) n
  GROUP BY ALL
) a"""


def _conf(src: str, id_expr: str, id_name: str, keep: list[str]) -> str:
    return f"""
SELECT {id_name}, {dk('billing_month')} AS date_key, {PK} AS provider_key, {MKEY} AS model_key,
  billing_month, provider, provider_project_id, model, model_snapshot, usage_type, {", ".join(keep)}
FROM (
  SELECT {id_expr} AS {id_name}, billing_month, provider, provider_project_id, COALESCE(model, {NA}) AS model,
    COALESCE(model_snapshot, {NA}) AS model_snapshot, COALESCE(usage_type, {NA}) AS usage_type, {", ".join(keep)}
  FROM {src}
) n"""


CTES["fact_usage_monthly"] = _conf("token_economics", "token_economics_id", "usage_monthly_id", USAGE_FACT_COLS)
CTES["fact_unit_economics_monthly"] = _conf("unit_economics", "unit_economics_id", "unit_economics_id", UNIT_FACT_COLS)
CTES["fact_optimization_monthly"] = _conf("optimization", "recommendation_id", "recommendation_id", OPT_FACT_COLS)

CTES["fact_experiment_current"] = f"""
SELECT experiment_id AS experiment_key, {dk('evaluation_date')} AS date_key, {", ".join(EXP_CURRENT_COLS)}
FROM experiments
QUALIFY ROW_NUMBER() OVER (PARTITION BY experiment_id ORDER BY evaluation_date DESC, experiment_governance_id DESC) = 1"""
