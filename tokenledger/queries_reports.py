
from __future__ import annotations

from functools import partial

from tokenledger.plans import reports as R
from tokenledger.queries import register_custom as _register_custom

register_custom = partial(_register_custom, shared=True)  # these start from models that others use too

FIN = "fact_financial_monthly"
USE = "fact_usage_monthly"


def _measure_query(name, table, measures, by, layered=False):
    register_custom(name, lambda p: R.measure(getattr(p, table), measures, by),
                    R.measure_sql(table, measures, by), layered=layered)


_measure_query("measures_financial", FIN, R.FINANCIAL, ["billing_month", "provider"])
_measure_query("measures_usage", USE, R.USAGE_MEASURES, ["billing_month", "provider", "model"])
_measure_query("measures_unit", "fact_unit_economics_monthly", R.UNIT_MEASURES, ["billing_month"])
_measure_query("measures_optimization", "fact_optimization_monthly", R.OPT_MEASURES, ["optimization_type"])
_measure_query("measures_governance", "control_results", R.GOVERNANCE_MEASURES, ["pipeline_name"], layered=True)

_M = R._money
_D = R._div
U = R.USAGE

register_custom("top5_applications", lambda p: R.top_applications(p.fact_financial_monthly), f"""
WITH spend AS (
  SELECT application_name, round(sum(invoice_billed_cost), 6) AS every_line,
    round(sum(invoice_billed_cost) FILTER (WHERE line_item_type = 'usage'), 6) AS usage_lines
  FROM {FIN} GROUP BY application_name)
SELECT application_name, CAST(every_line AS DOUBLE) AS total_invoice_cost, CAST(usage_lines AS DOUBLE) AS usage_invoice_cost,
  (SELECT count(*) + 1 FROM spend o WHERE o.every_line > s.every_line
     OR (o.every_line = s.every_line AND o.application_name < s.application_name)) AS rank
FROM spend s QUALIFY row_number() OVER (ORDER BY every_line DESC, application_name) <= 5""")

register_custom("mom_invoice", lambda p: R.mom_invoice(p.fact_financial_monthly), f"""
SELECT billing_month, invoice_cost, previous_month_invoice_cost,
  {_D('invoice_cost - previous_month_invoice_cost', 'previous_month_invoice_cost')} AS invoice_cost_mom_pct
FROM (
  SELECT billing_month, invoice_cost,
    CASE WHEN lag(billing_month) OVER (ORDER BY billing_month) = CAST(billing_month - INTERVAL 1 MONTH AS DATE)
         THEN lag(invoice_cost) OVER (ORDER BY billing_month) END AS previous_month_invoice_cost
  FROM (SELECT billing_month, {_M('SUM(invoice_billed_cost)')} AS invoice_cost FROM {FIN} GROUP BY billing_month) m
) x""")

register_custom("chargeback_rollup", lambda p: R.chargeback_rollup(p.fact_financial_monthly), f"""
SELECT department_name, application_name, cost_center, grouping_level,
  {_M('_cost')} AS usage_invoice_cost, {_D('_cost', '_total')} AS share_of_total
FROM (
  SELECT department_name, application_name, cost_center,
    GROUPING(department_name, application_name, cost_center) AS grouping_level,
    SUM(invoice_billed_cost) AS _cost
  FROM {FIN} WHERE {U} GROUP BY ROLLUP (department_name, application_name, cost_center)
) r, (SELECT SUM(invoice_billed_cost) AS _total FROM {FIN} WHERE {U}) t""")

register_custom("reconciliation_bridge", lambda p: R.reconciliation_bridge(p.fact_financial_monthly), f"""
WITH sums AS (
  SELECT sum(usage_cost_estimate) FILTER (WHERE line_item_type = 'usage') AS estimate,
    sum(provider_reported_cost) FILTER (WHERE line_item_type = 'usage') AS reported_usage,
    sum(provider_reported_cost) FILTER (WHERE line_item_type <> 'usage') AS reported_other,
    sum(invoice_billed_cost) AS invoiced
  FROM {FIN})
SELECT k AS sort_order, ['Usage Estimate', 'Usage → Reported Variance', 'Non-Usage Reported Cost', 'Reported → Invoice Variance'][k] AS stage,
  CAST(round([estimate, reported_usage - estimate, reported_other, invoiced - reported_usage - reported_other][k], 6) AS DOUBLE) AS amount
FROM sums, (SELECT unnest([1, 2, 3, 4]) AS k) n""")

register_custom("cost_per_million_by_model",
                lambda p: R.cost_per_million_by_model(p.fact_financial_monthly, p.fact_usage_monthly), f"""
SELECT COALESCE(a.provider, b.provider) AS provider, COALESCE(a.model, b.model) AS model,
  {_M('a._inv')} AS usage_invoice_cost, b._tok AS total_tokens,
  {_D('CAST(a._inv AS DOUBLE) * 1000000', 'b._tok')} AS cost_per_million_tokens,
  {_D('b._read', 'b._in')} AS cache_utilization_pct
FROM (SELECT provider, model, SUM(invoice_billed_cost) AS _inv FROM {FIN} WHERE {U} GROUP BY 1, 2) a
FULL OUTER JOIN (SELECT provider, model, SUM(total_tokens) AS _tok, SUM(normalized_cache_read_tokens) AS _read,
                   SUM(normalized_total_input_tokens) AS _in FROM {USE} GROUP BY 1, 2) b
  ON a.provider = b.provider AND a.model = b.model""")

register_custom("savings_by_type", lambda p: R.savings_by_type(p.fact_optimization_monthly), f"""
SELECT optimization_type, {_M('_s')} AS identified_annualized_savings, recommendations FROM (
  SELECT optimization_type, SUM(identified_annualized_savings) AS _s, COUNT(*) AS recommendations
  FROM fact_optimization_monthly GROUP BY optimization_type) g WHERE _s > 0""")

register_custom("attempt_sequence_check", lambda p: R.attempt_sequence_check(p.raw_telemetry), """
SELECT COUNT(*) AS logical_requests,
  COUNT(*) FILTER (WHERE mn <> 1 OR mx <> n) AS numbering_violations,
  COUNT(*) FILTER (WHERE finals <> 1) AS final_attempt_violations,
  COUNT(*) FILTER (WHERE statuses <> 1) AS final_status_violations
FROM (
  SELECT logical_request_id, min(attempt_number) AS mn, max(attempt_number) AS mx, COUNT(*) AS n,
    COUNT(*) FILTER (WHERE is_final_attempt) AS finals, COUNT(DISTINCT final_request_status) AS statuses
  FROM raw_telemetry GROUP BY logical_request_id
) per""")

for _table, _measures in R.STAGE_SUMMARIES.items():
    _measure_query(f"stage_summary_{_table}", _table, _measures, [])

_EXPERIMENT_SQL = """SELECT {by} count(*) AS current_experiments,
  sum(CASE threshold_status WHEN 'WITHIN_LIMIT' THEN 1 ELSE 0 END) AS experiments_within_limit,
  sum(CASE threshold_status WHEN 'WARNING' THEN 1 ELSE 0 END) AS experiments_at_warning,
  sum(CASE threshold_status WHEN 'HARD_STOP' THEN 1 ELSE 0 END) AS experiments_at_hard_stop,
  sum(CASE WHEN threshold_status IN ('WARNING', 'HARD_STOP') THEN 1 ELSE 0 END) AS experiments_requiring_action,
  sum(CASE governance_exception_status WHEN 'EXCEPTION' THEN 1 ELSE 0 END) AS experiment_governance_exceptions,
  avg(CASE threshold_status WHEN 'WITHIN_LIMIT' THEN 1.0 ELSE 0.0 END) AS experiments_within_guardrail_pct,
  CAST(round(sum(period_invoice_billed_experiment_cost), 6) AS DOUBLE) AS current_experiment_spend,
  max(spend_to_limit_pct) AS experiment_spend_to_limit_pct
FROM fact_experiment_current {group}"""
for _name, _by in (("measures_experiments", ["spending_limit_period"]), ("measures_experiments_by_id", ["experiment_id"]),
                   ("measures_experiments_overall", [])):
    register_custom(_name, lambda p, by=_by: R.measure(p.fact_experiment_current, R.EXPERIMENT_MEASURES, by),
                    _EXPERIMENT_SQL.format(by="".join(f"{x}, " for x in _by), group="GROUP BY " + ", ".join(_by) if _by else ""))

_measure_query("measures_financial_by_month", FIN, R.FINANCIAL, ["billing_month"])
_measure_query("measures_usage_by_month", USE, R.USAGE_MEASURES, ["billing_month"])
_measure_query("measures_pipelines", "pipeline_status", R.PIPELINE_MEASURES, [], layered=True)
register_custom("invoice_by_provider", lambda p: R.measure(
    p.fact_financial_monthly, {"total_invoice_cost": R._money("SUM(invoice_billed_cost)")}, ["provider"]), f"""
SELECT provider, CAST(round(sum(invoice_billed_cost), 6) AS DOUBLE) AS total_invoice_cost FROM {FIN} GROUP BY ALL""")
register_custom("recommendation_table", lambda p: R.recommendation_table(p.fact_optimization_monthly), """
WITH scoped AS (
  SELECT recommendation_title, optimization_type, provider, model, sum(identified_annualized_savings) AS saved, count(*) AS n
  FROM fact_optimization_monthly GROUP BY ALL HAVING sum(identified_annualized_savings) > 0)
SELECT recommendation_title, optimization_type, count(*) AS quantified_actions, CAST(sum(n) AS BIGINT) AS recommendations,
  CAST(round(sum(saved), 6) AS DOUBLE) AS identified_annualized_savings FROM scoped GROUP BY ALL""")

register_custom("latest_month_opportunities", lambda p: R.latest_month_opportunities(p.fact_optimization_monthly),
                f"""
SELECT optimization_type, recommendation_title, {_M('_s')} AS identified_annualized_savings FROM (
  SELECT optimization_type, recommendation_title, SUM(identified_annualized_savings) AS _s
  FROM fact_optimization_monthly
  WHERE billing_month = (SELECT max(billing_month) FROM fact_optimization_monthly)
  GROUP BY 1, 2) g WHERE _s > 0""")

register_custom("spend_to_limit_by_experiment", lambda p: p.fact_experiment_current.select(
    "experiment_id", "spending_limit_period", "evaluation_date", "spend_to_limit_pct", "threshold_status",
    "governance_action_status"), """
SELECT experiment_id, spending_limit_period, evaluation_date, spend_to_limit_pct, threshold_status,
  governance_action_status FROM fact_experiment_current""")
