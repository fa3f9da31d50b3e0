"""Registered month-context measures, insight texts and display columns.  The oracle looks each
context up by a subquery over the fact instead of grouping sets and joins."""

from __future__ import annotations

from functools import partial

from tokenledger.oracle.sqlfn import dbl
from tokenledger.plans import insights as I
from tokenledger.queries import register_custom as _register_custom

register_custom = partial(_register_custom, shared=True)  # these start from models that others use too

FIN, OPT = "fact_financial_monthly", "fact_optimization_monthly"

_IN = "(c.provider = 'all' OR f.provider = c.provider) AND (c.application_name = 'all' OR f.application_name = c.application_name)"
register_custom("month_context_measures", lambda p: I.month_context_measures(p.fact_financial_monthly), f"""
WITH members AS (SELECT DISTINCT provider, application_name FROM {FIN}),
choices AS (
  SELECT provider, application_name FROM members UNION SELECT provider, 'all' FROM members
  UNION SELECT 'all', application_name FROM members UNION SELECT 'all', 'all' FROM members),
months AS (SELECT DISTINCT billing_month FROM {FIN}),
contexts AS (SELECT * FROM choices, months),
told AS (
  SELECT c.*,
    (SELECT sum(invoice_billed_cost) FROM {FIN} f WHERE {_IN} AND f.billing_month = c.billing_month) AS latest,
    (SELECT sum(invoice_billed_cost) FROM {FIN} f WHERE {_IN} AND f.billing_month = c.billing_month - INTERVAL 1 MONTH) AS previous,
    (SELECT sum(invoice_billed_cost) FROM {FIN} f WHERE {_IN} AND f.billing_month = c.billing_month AND f.line_item_type = 'usage') AS mine,
    (SELECT sum(invoice_billed_cost) FROM {FIN} f WHERE (c.provider = 'all' OR f.provider = c.provider)
       AND f.billing_month = c.billing_month AND f.line_item_type = 'usage') AS everyone
  FROM contexts c)
SELECT billing_month, provider, application_name, {dbl('latest')} AS latest_month_invoice_cost, {dbl('previous')} AS previous_month_invoice_cost,
  ({dbl('latest')} - {dbl('previous')}) / nullif({dbl('previous')}, 0) AS invoice_cost_mom_pct,
  CAST(mine AS DOUBLE) / nullif(CAST(everyone AS DOUBLE), 0) AS usage_invoice_cost_share_pct
FROM told WHERE latest IS NOT NULL OR previous IS NOT NULL""")


def _fixed(x: str, digits: int) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(38,9)), {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"


def _dollars(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN NULL ELSE if({x} < 0, '-$', '$') || CASE WHEN abs({x}) >= 1000000 THEN {_fixed(f'abs({x}) / 1e6', 2)} || 'M' "
            f"WHEN abs({x}) >= 1000 THEN {_fixed(f'abs({x}) / 1e3', 2)} || 'K' ELSE regexp_replace({_fixed(f'abs({x})', 2)}, '^1000', '1,000') END END)")


def _percent(x: str, digits: int) -> str:
    return f"({_fixed(f'({x}) * 100', digits)} || '%')"


_SCOPED = "(c.context = 'all' OR provider = c.context)"
_SUM = f"SELECT sum({{}}) FROM {FIN} WHERE {_SCOPED} AND {{}}"
_LINES = "line_item_type = 'usage'"
_NAMES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in I.TYPE_IN_TEXT.items())


def _best(table: str, name: str, amount: str, where: str = "true") -> str:
    return (f"(SELECT struct_pack(n := {name}, v := CAST(sum({amount}) AS DOUBLE)) FROM {table} WHERE {_SCOPED} AND {where} GROUP BY {name} "
            f"HAVING sum({amount}) > 0 ORDER BY sum({amount}) DESC, {name} LIMIT 1)")


_OPP_BY_SCOPE = f"SELECT recommendation_title, provider, model FROM {OPT} WHERE {_SCOPED} GROUP BY ALL HAVING sum(identified_annualized_savings) > 0"
_MOVED = (f"CASE WHEN mom IS NULL THEN 'has no prior-month comparison' WHEN mom < 0 THEN 'fell ' || {_percent('abs(mom)', 1)} "
          f"WHEN mom > 0 THEN 'rose ' || {_percent('mom', 1)} ELSE 'was unchanged' END")
register_custom("insight_texts", lambda p: I.insight_texts(p.fact_financial_monthly, p.fact_usage_monthly, p.fact_optimization_monthly, p.dim_date), f"""
WITH contexts AS (SELECT DISTINCT provider AS context FROM {FIN} UNION SELECT 'all'),
usage_tokens AS (SELECT p.provider, u.total_tokens FROM fact_usage_monthly u JOIN dim_provider p ON u.provider_key = p.provider_key),
told AS (
  SELECT context, (SELECT max(month_start_date) FROM dim_date) AS m,
    ({_SUM.format('invoice_billed_cost', 'billing_month = (SELECT max(month_start_date) FROM dim_date)')}) AS latest_raw,
    ({_SUM.format('invoice_billed_cost', "billing_month = (SELECT max(month_start_date) - INTERVAL 1 MONTH FROM dim_date)")}) AS previous_raw,
    ({_SUM.format('invoice_billed_cost', _LINES)}) AS used, ({_SUM.format('provider_reported_cost', _LINES)}) AS reported,
    ({_SUM.format('usage_cost_estimate', _LINES)}) AS estimate,
    {_best(FIN, 'application_name', 'invoice_billed_cost', _LINES)} AS app,
    {_best(OPT, 'optimization_type', 'identified_annualized_savings')} AS kind,
    {_best(OPT, 'recommendation_title', 'identified_annualized_savings')} AS title,
    (SELECT sum(identified_annualized_savings) FROM {OPT} WHERE {_SCOPED}) AS saved,
    (SELECT count(*) FROM ({_OPP_BY_SCOPE})) AS actions,
    (SELECT sum(total_tokens) FROM usage_tokens WHERE {_SCOPED}) AS tokens
  FROM contexts c),
figures AS (
  SELECT *, {dbl('latest_raw')} AS latest, {dbl('saved')} AS opportunity,
    ({dbl('latest_raw')} - {dbl('previous_raw')}) / nullif({dbl('previous_raw')}, 0) AS mom,
    ({dbl('reported')} - {dbl('estimate')}) / nullif(abs({dbl('estimate')}), 0) AS gap,
    app.v / nullif(CAST(used AS DOUBLE), 0) AS app_share, kind.v / nullif(CAST(saved AS DOUBLE), 0) AS kind_share,
    title.v / nullif(CAST(saved AS DOUBLE), 0) AS title_share
  FROM told)
SELECT context,
  concat('SPEND SIGNAL', chr(10), chr(8226), ' Latest invoice cost ', {_MOVED}, ' to ', {_dollars('latest')},
    '. Validate whether the movement reflects demand, model mix or efficiency.', chr(10), chr(10), 'CONCENTRATION RISK', chr(10), chr(8226), ' ',
    app.n, ' represents ', {_percent('app_share', 1)}, ' of usage cost and should be the first workload investigated.', chr(10), chr(10),
    'DECISION PRIORITY', chr(10), chr(8226), ' ', {_dollars('opportunity')}, ' of modeled annualized opportunity is identified. ',
    {_percent('title_share', 0)}, ' is driven by ',
    CASE WHEN contains(lower(title.n), 'batch') THEN 'batch migration' WHEN contains(lower(title.n), 'retry') THEN 'retry reduction' ELSE title.n END,
    '. Provider-reported usage is ', CASE WHEN gap < 0 THEN {_percent('abs(gap)', 1)} || ' below the usage estimate'
      WHEN gap > 0 THEN {_percent('gap', 1)} || ' above the usage estimate' ELSE 'aligned with the usage estimate' END,
    ', so validate pricing before approval.') AS executive_readout,
  concat('Latest invoice cost ', {_MOVED}, ' to ', ifnull({_dollars('latest')}, 'N/A'), '.', chr(10),
    'Validate whether demand, model mix or efficiency caused the ', CASE WHEN mom < 0 THEN 'decline' WHEN mom > 0 THEN 'increase' ELSE 'movement' END, '.')
    AS spend_signal_insight,
  concat(app.n, ' drives ', {_percent('app_share', 1)}, ' of usage cost.', chr(10), 'Prioritize this workload for cost and architecture review.')
    AS concentration_risk_insight,
  concat({_dollars('opportunity')}, ' modeled annualized opportunity; ', {_percent('kind_share', 0)}, ' comes from ',
    CASE kind.n {_NAMES} ELSE lower(kind.n) END, '.', chr(10), 'Validate the ', {_percent('abs(gap)', 1)}, ' pricing gap before approval.')
    AS decision_priority_insight,
  {_fixed('CAST(tokens AS DOUBLE) / 1e9', 1)} || 'B' AS total_tokens_card_display, actions AS quantified_recommendation_actions
FROM figures""")

_TYPES = ", ".join(f"('{k}', '{v}')" for k, v in I.TYPE_DISPLAY.items())
_GATES = ", ".join(f"('{k}', '{v}')" for k, v in I.GATE_DISPLAY.items())
register_custom("recommendation_displays", lambda p: I.recommendation_displays(p.fact_optimization_monthly), f"""
SELECT o.optimization_type, recommendation_title, o.evaluation_gate_status,
  CASE WHEN recommendation_title ILIKE '%asynchronous%' THEN 'Batch migration' WHEN recommendation_title ILIKE '%retry%' THEN 'Retry reduction'
    ELSE recommendation_title END AS recommendation_display,
  ifnull(t.display, o.optimization_type) AS optimization_type_display, ifnull(g.display, o.evaluation_gate_status) AS evaluation_status_display,
  count(*) AS recommendations
FROM {OPT} o LEFT JOIN (SELECT * FROM (VALUES {_TYPES}) v(k, display)) t ON t.k = o.optimization_type
LEFT JOIN (SELECT * FROM (VALUES {_GATES}) v(k, display)) g ON g.k = o.evaluation_gate_status GROUP BY ALL""")
