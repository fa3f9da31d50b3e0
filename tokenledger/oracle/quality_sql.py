"""DuckDB CTE texts for the quality layer: controls, and the logs of two runs."""

from __future__ import annotations

from tokenledger.oracle.feeds_sql import CTES
from tokenledger.plans.pipeline import RUN_1, RUN_2
from tokenledger.quality.controls import catalogue, evaluate_sql
from tokenledger.quality.status import CATALOG, catalog_rows
from tokenledger.runs.deploy import STAGES
from tokenledger.sources import constants as K

CTES["dim_experiment"] = """
SELECT experiment_id AS experiment_key, experiment_id, owner, approver, hypothesis, application_name, cost_center,
  spending_limit, spending_limit_period, limit_currency, warning_threshold, hard_stop_threshold, start_date,
  planned_end_date, current_status, override_reason
FROM experiment_control"""

CTES["line_item_totals"] = """
SELECT line_item_type, SUM(invoice_billed_cost) AS source_cost, CAST(NULL AS DECIMAL(38,9)) AS distributed_cost
FROM cost_reconciliation GROUP BY line_item_type
UNION ALL
SELECT line_item_type, NULL, CAST(SUM(allocated_invoice_billed_cost) + SUM(unallocated_invoice_billed_cost) AS DECIMAL(38,9))
FROM application_cost GROUP BY line_item_type"""

CTES["stage_control_results"] = evaluate_sql([c for c in catalogue() if c.stage in K.EXPECTED_PIPELINES])

CTES["control_results"] = evaluate_sql()

# ---- logs of two runs: the whole deployment, then an audit of the first five stages ----------


def _text(x) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


_EXP = ", ".join(f"({i + 1}, '{n}', {len(STAGES[n])})" for i, n in enumerate(K.EXPECTED_PIPELINES))
CTES["run_log"] = f"""
WITH stages AS (SELECT * FROM (VALUES {_EXP}) v(run_order, pipeline_name, tables)),
verdicts AS (
  SELECT pipeline_name, bool_and(violation_count = 0) AS good,
    string_agg(control_id, ', ' ORDER BY control_id) FILTER (WHERE violation_count <> 0) AS failed
  FROM stage_control_results GROUP BY pipeline_name),
runs AS (SELECT * FROM (VALUES ('{RUN_1[0]}', TIMESTAMP '{RUN_1[1]}', 10), ('{RUN_2[0]}', TIMESTAMP '{RUN_2[1]}', 5)) r(pipeline_run_id, logged_at, stages))
SELECT pipeline_run_id, pipeline_name, logged_at, if(good, 'PASS', 'FAIL') AS status, CASE WHEN runs.stages = 10 THEN tables ELSE 0 END AS loaded,
  CASE WHEN NOT good THEN pipeline_name || ' failed: ' || failed END AS error_message
FROM runs JOIN stages ON run_order <= runs.stages JOIN verdicts USING (pipeline_name)"""
CTES["pipeline_status"] = f"""
SELECT e.run_order, e.pipeline_name, r.pipeline_run_id, r.logged_at AS started_at, r.logged_at AS completed_at, COALESCE(r.status, 'MISSING') AS status,
  r.loaded AS loaded_table_count, r.error_message, CAST(r.status IS NOT DISTINCT FROM 'PASS' AS INTEGER) AS pass_flag,
  CAST(r.status IS DISTINCT FROM 'PASS' AS INTEGER) AS attention_flag
FROM (SELECT * FROM (VALUES {_EXP}) v(run_order, pipeline_name, tables)) e
LEFT JOIN (SELECT * FROM run_log QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY logged_at DESC, pipeline_run_id DESC) = 1) r
  ON e.pipeline_name = r.pipeline_name"""
_CAT = ", ".join("(" + ", ".join(map(_text, r)) + ")" for r in catalog_rows(catalogue()))
_AGAIN = ", ".join(f"'{n}'" for n in K.EXPECTED_PIPELINES[:5])
CTES["control_status"] = f"""
WITH log AS (
  SELECT *, '{RUN_1[0]}' AS pipeline_run_id, TIMESTAMP '{RUN_1[1]}' AS checked_at FROM control_results
  UNION ALL
  SELECT *, '{RUN_2[0]}', TIMESTAMP '{RUN_2[1]}' FROM control_results WHERE pipeline_name IN ({_AGAIN})),
newest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY pipeline_name, control_id ORDER BY checked_at DESC, pipeline_run_id DESC) = 1)
SELECT c.*, n.pipeline_run_id, n.violation_count, COALESCE(n.status, 'MISSING') AS status, n.checked_at,
  CAST(n.status IS NOT DISTINCT FROM 'PASS' AS INTEGER) AS pass_flag, CAST(n.status IS NOT DISTINCT FROM 'FAIL' AS INTEGER) AS fail_flag
FROM (SELECT * FROM (VALUES {_CAT}) v({', '.join(x.split()[0] for x in CATALOG.split(', '))})) c
LEFT JOIN newest n ON c.pipeline_name = n.pipeline_name AND c.control_id = n.control_id"""
_LOADS = {"raw_usage": "raw_usage", "raw_telemetry": "raw_telemetry", "raw_cost": "raw_cost", "usage_priced": "raw_usage",
          "provider_cost_stg": "raw_cost", "telemetry_stg": "raw_telemetry", "cost_reconciliation": "provider_cost_stg"}
CTES["load_reconciliation"] = "\nUNION ALL\n".join(f"""
SELECT '{table}' AS table_name, '{RUN_1[0]}' AS pipeline_run_id, source.n AS source_row_count, loaded.n AS loaded_row_count,
  loaded.n - source.n AS row_count_difference, if(loaded.n = source.n, 'PASS', 'FAIL') AS status, TIMESTAMP '{RUN_1[1]}' AS checked_at
FROM (SELECT count(*) AS n FROM {source}) source, (SELECT count(*) AS n FROM {table}) loaded""" for table, source in _LOADS.items())
