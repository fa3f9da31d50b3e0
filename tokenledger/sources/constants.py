"""Constant tables and controlled vocabularies.

Two kinds of values live here:

* FIXED VALUES that must equal the reference behaviour (service-tier map,
  status vocabularies, tolerances, policy thresholds).  They are listed
  plainly, in natural order.
* FIXTURE VALUES for the dimension feeds that the driver tables do not
  carry (model map, rate card, attribution bridge, experiment controls and
  decisions).  They follow the scenario list of FIXTURES.md section 3.

Everything is small and bounded by construction (tens of rows), so the
DataFrames built from these lists are safe to broadcast.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal as D

# ---------------------------------------------------------------------------
# FIXED VALUES (reference semantics)
# ---------------------------------------------------------------------------

# provider, provider_service_tier, is_batch, normalized_processing_tier
SERVICE_TIER_MAP = [
    ("openai", "default", False, "standard"),
    ("openai", "default", True, "standard"),
    ("anthropic", "standard", False, "standard"),
    ("anthropic", "batch", True, "standard"),
]

MODEL_MAP_STATUSES = ["Resolved", "Missing model map", "Multiple model maps"]
SERVICE_TIER_STATUSES = ["Resolved", "Missing service tier", "Multiple service tiers"]
TOKEN_VALIDATION_STATUSES = [
    "Invalid reasoning tokens", "Invalid cached input", "Invalid embedding output", "Valid",
]
PRICING_STATUSES = [
    "Priced", "Missing rate", "Multiple rates", "Invalid currency", "Invalid upstream record",
]
RECONCILIATION_STATUSES = ["PASS", "EXCEPTION", "NOT_APPLICABLE"]
COVERAGE_STATUSES = [
    "NO_PROVIDER_USAGE", "NO_TELEMETRY", "PARTIAL_COVERAGE", "OVER_COVERAGE",
    "REQUEST_COUNT_UNAVAILABLE", "REQUEST_MISMATCH", "WITHIN_TOLERANCE",
]
NON_USAGE_LINE_TYPES = ["credit", "commitment_true_up", "correction", "adjustment", "tax"]
RECOMMENDATION_TYPES = [
    "BATCH_MIGRATION", "RETRY_REDUCTION", "TELEMETRY_COVERAGE", "CACHE_REUSE_ASSESSMENT",
]
# recommendations are stamped with this date instead of the run date (repeatable output)
AS_OF_DATE = _dt.date(2026, 7, 1)

# reconciliation tolerance: a row passes if |variance| <= 1.00 USD or |pct| <= 1 %
ABS_TOLERANCE_USD = D("1.00")
PCT_TOLERANCE = 0.01
# telemetry coverage band and request tolerance
COVERAGE_LOW = 0.95
COVERAGE_HIGH = 1.05
REQUEST_TOLERANCE = 0.05

# optimisation policy
BATCH_MIN_MONTHLY_SAVINGS = D("5")
RETRY_MIN_MONTHLY_COST = D("5")
RETRY_REDUCTION_TARGET = D("0.5")
COVERAGE_MIN_AT_RISK = D("1")
CACHE_SHARE_BELOW = 0.20
CACHE_MIN_INPUT_COST = D("5")
ANNUALIZATION_MONTHS = 12

# decision rationale words that make a Stop "financial"
FINANCIAL_RATIONALE_PATTERN = "spend|limit|budget|cost"

# stages expected in the pipeline run log, in run order
EXPECTED_PIPELINES = [
    "M6_BIGQUERY_RAW_LAYER", "M7_STAGING_NORMALIZATION_PRICING", "M8_MONTHLY_COST_RECONCILIATION",
    "M9_DAILY_USAGE_ALLOCATION", "M10_TELEMETRY_RECONCILIATION", "M11_TOKEN_ECONOMICS",
    "M12_APPLICATION_COST_CHARGEBACK", "M13_OPTIMIZATION_EVALUATION_GATE", "M14_UNIT_ECONOMICS",
    "M15_EXPERIMENT_GOVERNANCE",
]

# reporting calendar
PERIOD_START = _dt.date(2025, 1, 1)
PERIOD_END = _dt.date(2026, 6, 30)

# ---------------------------------------------------------------------------
# FIXTURE VALUES (dimension feeds; FIXTURES.md section 3)
# ---------------------------------------------------------------------------

_D = _dt.date
OPEN_END = _D(2026, 6, 30)

# provider, usage_type, provider_model_name, model_snapshot, start, end, reasoning_capable
MODEL_MAP = [
    ("openai", "embedding", "text-embedding-s", "text-embedding-s-v1", _D(2025, 1, 1), OPEN_END, False),
    ("openai", "text_generation", "chat-mini", "chat-mini-v1", _D(2025, 1, 1), OPEN_END, False),
    ("openai", "text_generation", "chat-large", "chat-large-2025-01", _D(2025, 1, 1), _D(2025, 8, 31), True),
    ("openai", "text_generation", "chat-large", "chat-large-2025-09", _D(2025, 9, 1), OPEN_END, True),
    ("anthropic", "text_generation", "assist-small", "assist-small-v1", _D(2025, 1, 1), OPEN_END, False),
    ("anthropic", "text_generation", "assist-large", "assist-large-v1", _D(2025, 1, 1), OPEN_END, True),
]

# Standard (non-batch) rates per million tokens by snapshot window:
# provider, usage_type, snapshot, start, end, input, cached_input, write_5m, write_1h, output, discount
_STANDARD_RATES = [
    ("openai", "text_generation", "chat-mini-v1", _D(2025, 1, 1), OPEN_END,
     D("0.15"), D("0.075"), None, None, D("0.60"), D("0.05")),
    ("openai", "text_generation", "chat-large-2025-01", _D(2025, 1, 1), _D(2025, 8, 31),
     D("1.25"), D("0.125"), None, None, D("10"), D("0")),
    ("openai", "text_generation", "chat-large-2025-09", _D(2025, 9, 1), OPEN_END,
     D("1.25"), D("0.125"), None, None, D("10"), D("0")),
    ("openai", "embedding", "text-embedding-s-v1", _D(2025, 1, 1), OPEN_END,
     D("0.02"), None, None, None, D("0"), D("0")),
    ("anthropic", "text_generation", "assist-small-v1", _D(2025, 1, 1), OPEN_END,
     D("0.80"), D("0.08"), D("1.00"), D("1.60"), D("4"), D("0")),
    ("anthropic", "text_generation", "assist-large-v1", _D(2025, 1, 1), _D(2025, 6, 30),
     D("3"), D("0.30"), D("3.75"), D("6"), D("15"), D("0")),
    ("anthropic", "text_generation", "assist-large-v1", _D(2025, 7, 1), OPEN_END,
     D("3.30"), D("0.30"), D("4.125"), D("6.60"), D("15"), D("0")),
]


def rate_card_rows():
    """Rate card rows: every standard window plus its batch twin at half the
    input/output rate and with no cache rates."""
    rows = []
    for (prov, utype, snap, start, end, rin, rcached, r5, r1, rout, disc) in _STANDARD_RATES:
        common = dict(provider=prov, usage_type=utype, model_snapshot=snap,
                      normalized_processing_tier="standard", context_window_tier="standard",
                      effective_start=start, effective_end=end, contracted_discount=disc,
                      rate_currency="USD", rate_basis="per_million_tokens",
                      rate_source="fixture_price_list", retrieved_date=_D(2025, 1, 1),
                      rate_status="active")
        rows.append(dict(common, is_batch=False, input_rate_per_million=rin,
                         cached_input_rate_per_million=rcached,
                         cache_write_5m_rate_per_million=r5,
                         cache_write_1h_rate_per_million=r1,
                         output_rate_per_million=rout))
        rows.append(dict(common, is_batch=True, input_rate_per_million=rin / 2,
                         cached_input_rate_per_million=None,
                         cache_write_5m_rate_per_million=None,
                         cache_write_1h_rate_per_million=None,
                         output_rate_per_million=rout / 2))
    return rows


# Attribution bridge.  api key k belongs to provider openai when k is even,
# anthropic when odd, and to project proj-{k div 2}.
# mapping_id, key, application, department, cost_center, pct, start, end,
# confidence, recorded
BRIDGE = [
    ("MAP-001", 0, "support-assistant", "Customer Success", "CC100", D("1.0"),
     _D(2025, 1, 1), OPEN_END, "high", _D(2025, 1, 1)),
    ("MAP-002", 2, "search-ranking", "Engineering", "CC200", D("0.6"),
     _D(2025, 1, 1), OPEN_END, "high", _D(2025, 1, 1)),
    ("MAP-003", 2, "doc-summarizer", "Operations", "CC300", D("0.3"),
     _D(2025, 1, 1), OPEN_END, "high", _D(2025, 1, 1)),
    ("MAP-004", 4, "code-review-bot", "Engineering", "CC210", D("1.0"),
     _D(2025, 4, 1), OPEN_END, "high", _D(2025, 4, 1)),
    ("MAP-005", 6, "sales-email", "Sales", "CC500", D("1.0"),
     _D(2025, 1, 1), OPEN_END, "medium", _D(2025, 1, 1)),
    ("MAP-006", 1, "developer-sandbox", "Research", "CC400", D("1.0"),
     _D(2025, 1, 1), _D(2025, 12, 31), "high", _D(2025, 1, 1)),
    ("MAP-007", 1, "developer-sandbox", "Research", "CC410", D("1.0"),
     _D(2026, 1, 1), OPEN_END, "high", _D(2026, 1, 1)),
    ("MAP-008", 3, "analytics-copilot", "Finance", "CC600", D("1.0"),
     _D(2025, 1, 1), OPEN_END, "high", _D(2025, 1, 1)),
    ("MAP-009", 5, "translation-hub", "Marketing", "CC700", D("1.0"),
     _D(2025, 9, 1), _D(2026, 3, 31), "high", _D(2026, 2, 1)),
    ("MAP-010", 7, "fraud-triage", "Risk", "CC800", D("1.0"),
     _D(2025, 1, 1), OPEN_END, "high", _D(2025, 1, 1)),
    ("MAP-011", 9, "support-assistant", "Customer Success", "CC100", D("0.5"),
     _D(2025, 1, 1), OPEN_END, "high", _D(2025, 1, 1)),
    ("MAP-012", 9, "research-agent", "Research", "CC400", D("0.5"),
     _D(2025, 1, 1), OPEN_END, "high", _D(2025, 1, 1)),
]

# Experiment controls: id, owner, approver, hypothesis, application, cost_center,
# limit, period, warning, hard_stop, start, planned_end, current_status, override
EXPERIMENTS = [
    ("EXP-0", "owner-a", "approver-x", "Longer context improves answer quality",
     "support-assistant", "CC100", D("20000"), "lifetime", D("0.8"), D("1.0"),
     _D(2025, 1, 1), OPEN_END, "stopped", None),
    ("EXP-1", "owner-b", "approver-x", "Smaller model keeps accuracy for routing",
     "search-ranking", "CC200", D("1600"), "month", D("0.8"), D("1.0"),
     _D(2025, 1, 1), OPEN_END, "running", None),
    ("EXP-2", "owner-c", "approver-y", "Tool use reduces retries",
     "fraud-triage", "CC800", D("130"), "day", D("0.7"), D("1.0"),
     _D(2025, 1, 1), OPEN_END, "running", None),
    ("EXP-3", "owner-d", "approver-y", "Summaries shorten review time",
     "doc-summarizer", "CC300", D("60000"), "lifetime", D("0.8"), D("1.0"),
     _D(2025, 1, 1), OPEN_END, "stopped", "Business priority changed"),
]

# Decisions: id, experiment, decision, date, decided_by, rationale, previous, new
DECISIONS = [
    ("DEC-001", "EXP-0", "Continue", _D(2025, 1, 1), "approver-x",
     "Kick-off approved", "planned", "running"),
    ("DEC-002", "EXP-0", "Stop", _D(2026, 6, 1), "approver-x",
     "Lifetime spend passed the hard stop", "running", "stopped"),
    ("DEC-003", "EXP-1", "Continue", _D(2025, 2, 1), "approver-x",
     "First month reviewed", "planned", "running"),
    ("DEC-004", "EXP-1", "Modify", _D(2025, 9, 15), "approver-x",
     "Route long prompts to the larger model", "running", "running"),
    ("DEC-005", "EXP-2", "Continue", _D(2025, 1, 1), "approver-y",
     "Kick-off approved", "planned", "running"),
    ("DEC-006", "EXP-2", "Scale", _D(2025, 6, 1), "approver-y",
     "Retry rate improved", "running", "running"),
    ("DEC-007", "EXP-3", "Continue", _D(2025, 1, 1), "approver-y",
     "Kick-off approved", "planned", "running"),
    ("DEC-008", "EXP-3", "Modify", _D(2025, 10, 1), "approver-y",
     "Shorter summaries", "running", "running"),
    ("DEC-009", "EXP-3", "Stop", _D(2026, 3, 1), "approver-y",
     "Stopped over budget concerns", "running", "stopped"),
]

# Non-usage cost line type by first character of o_orderpriority
PRIORITY_LINE_TYPE = {"1": "credit", "2": "commitment_true_up", "3": "correction",
                      "4": "adjustment", "5": "tax"}
# adjustment_reason of usage lines by billing month % 4
USAGE_ADJUSTMENT_REASONS = ["LATE_USAGE", "INVOICE_CUTOFF", "ROUTINE_ROUNDING", None]
