"""Registered quality-layer queries: every control's verdict, and the marts over the run,
control and load logs of two runs (a whole deployment, then a later audit of five stages)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tokenledger.plans.pipeline import RUN_2, Pipeline
from tokenledger.queries import register, register_custom
from tokenledger.sources import constants as K

AUDITED_AGAIN = K.EXPECTED_PIPELINES[:5]

register("control_results", "control_results",
         ["pipeline_name", "control_id", "control_class", "violation_count", "status"], layered=True)


def twice(p: Pipeline) -> Pipeline:
    """The deployed pipeline after a second, partial run; the log keeps both."""
    d = p.deployment
    if d.logs.runs.read().filter(f"pipeline_run_id = '{RUN_2[0]}'").isEmpty():
        d.clock = lambda: RUN_2[1]
        d.run(RUN_2[0], AUDITED_AGAIN, rewrite=False)
    return p


def _times(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: df[c].cast("string") for c in cols})


register_custom("pipeline_status", lambda p: _times(twice(p).pipeline_status, "started_at", "completed_at"),
                "SELECT * REPLACE (CAST(started_at AS VARCHAR) AS started_at, CAST(completed_at AS VARCHAR) AS completed_at) FROM pipeline_status",
                layered=True)
register_custom("control_status_latest", lambda p: _times(twice(p).control_status, "checked_at"),
                "SELECT * REPLACE (CAST(checked_at AS VARCHAR) AS checked_at) FROM control_status", layered=True)
register_custom("load_reconciliation_latest", lambda p: _times(p.load_reconciliation, "checked_at"),
                "SELECT * REPLACE (CAST(checked_at AS VARCHAR) AS checked_at) FROM load_reconciliation", layered=True)
