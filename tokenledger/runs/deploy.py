"""Deployment of the model layers, stage by stage: write, audit, publish.

A stage writes its layers beside the published ones, reconciles what was loaded with its
source, evaluates its controls on the staged rows and appends every result to the logs.  Only
a stage without a failed check is published; a failed one raises with the ids of what failed,
after its results and its FAIL row in the run log are written, and readers keep the old layers.
``on_fail="record"`` publishes nevertheless and leaves the verdict to the logs."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.quality import controls as C
from tokenledger.runs.store import AppendLog, LayerStore, Staged, latest, months_side_by_side
from tokenledger.sources import constants as K
from tokenledger.sources import feeds


@dataclass(frozen=True)
class Layer:
    """A written model: its month column and clustering columns; ``ordered`` where the rows of a
    task come in their order (attempt-level layers, too large to shuffle as whole rows)."""
    month_of: str | None = None
    cluster_by: tuple[str, ...] = ()
    ordered: bool = False


#: FIXED VALUES: partition and clustering columns of the published tables.
LAYERS = {
    "raw_usage": Layer("usage_date", ("provider", "usage_type", "model", "provider_project_id")),
    "raw_telemetry": Layer("usage_date", ("provider", "model", "provider_project_id", "application_name"), ordered=True),
    "raw_cost": Layer("billing_period", ("provider", "provider_project_id", "line_item_type", "model")),
    "usage_priced": Layer("usage_date", ("provider", "usage_type", "model_snapshot", "provider_project_id")),
    "provider_cost_stg": Layer("billing_month", ("provider", "provider_project_id", "line_item_type", "model")),
    "telemetry_stg": Layer("usage_date", ("provider", "model", "provider_project_id", "application_name"), ordered=True),
    "usage_cost_monthly": Layer("billing_month", ("provider", "provider_project_id", "model")),
    "cost_reconciliation": Layer("billing_month", ("provider", "provider_project_id", "line_item_type", "model")),
    "usage_daily": Layer("usage_date", ("provider", "application_name", "department_name", "model_snapshot")),
    "app_driver_monthly": Layer("billing_month", ("provider", "provider_project_id", "model", "application_name")),
    "telemetry_recon_daily": Layer("usage_date", ("provider", "provider_project_id", "model", "coverage_status")),
    "telemetry_coverage_monthly": Layer("billing_month", ("provider", "provider_project_id", "model")),
    "token_economics": Layer("billing_month", ("provider", "provider_project_id", "model", "usage_type")),
    "application_cost": Layer("billing_month", ("provider", "application_name", "department_name", "line_item_type")),
    "optimization": Layer("billing_month", ("provider", "optimization_type", "evaluation_gate_status", "model")),
    "unit_economics": Layer("billing_month", ("provider", "model", "measurement_quality_status", "usage_type")),
    "experiment_driver_daily": Layer("usage_date", ("experiment_id", "provider", "provider_project_id", "model")),
    "experiment_daily": Layer(), "experiment_periods": Layer(),
    "experiments": Layer("evaluation_date", ("experiment_id", "spending_limit_period", "threshold_status", "governance_action_status")),
    "dim_date": Layer(), "dim_provider": Layer(), "dim_model": Layer(), "dim_application": Layer(),
    "fact_financial_monthly": Layer("billing_month", ("provider_key", "model_key", "application_key", "line_item_type")),
    "fact_usage_monthly": Layer("billing_month", ("provider_key", "model_key", "usage_type")),
    "fact_unit_economics_monthly": Layer("billing_month", ("provider_key", "model_key", "measurement_quality_status")),
    "fact_optimization_monthly": Layer("billing_month", ("provider_key", "model_key", "optimization_type", "evaluation_gate_status")),
    "fact_experiment_current": Layer(),
}

#: The layers of each stage: groups in order of dependency, the layers of a group side by side.
GROUPS: dict[str, tuple[tuple[str, ...], ...]] = {
    C.M6: (("raw_usage", "raw_telemetry"), ("raw_cost",)),
    C.M7: (("usage_priced", "provider_cost_stg", "telemetry_stg"),),
    C.M8: (("usage_cost_monthly",), ("cost_reconciliation",)),
    C.M9: (("usage_daily",), ("app_driver_monthly",)),
    C.M10: (("telemetry_recon_daily",), ("telemetry_coverage_monthly",)),
    C.M11: (("token_economics",),),
    C.M12: (("application_cost",),),
    C.M13: (("optimization",),),
    C.M14: (("unit_economics",),),
    C.M15: (("experiment_driver_daily",), ("experiment_daily",), ("experiment_periods",), ("experiments",)),
    C.M16: (),
    C.M17: (("dim_date", "dim_provider", "dim_model", "dim_application", "fact_financial_monthly", "fact_usage_monthly",
             "fact_unit_economics_monthly", "fact_optimization_monthly", "fact_experiment_current"),),
}
STAGES: dict[str, tuple[str, ...]] = {stage: tuple(n for g in groups for n in g) for stage, groups in GROUPS.items()}

#: Layers that a raw feed is derived from in this fixture: written before it, published by their own stage.
BEFORE = {"raw_cost": ("usage_priced", "usage_cost_monthly")}
#: Layers and source counts that are worked on at the same time.
WORKERS = 4

#: Models that are row-preserving projections of a wider written layer.
ONE_TO_ONE = {"usage_priced": ("usage_normalized",)}


def _usage_rows(p) -> DataFrame:
    return p.line_base.select(*feeds.USAGE_GRAIN).distinct().agg(F.count("*").alias("n"))


def _telemetry_rows(p) -> DataFrame:
    return p.line_base.filter("has_telemetry").agg(F.coalesce(F.sum("attempts"), F.lit(0)).cast("long").alias("n"))


def _cost_rows(p) -> DataFrame:
    month = F.trunc("usage_date", "MM").alias("month")
    usage = p.line_base.select(month, "provider", "provider_project_id", "model").distinct().agg(F.count("*").alias("n"))
    orders = (p.table("orders").select(F.trunc(feeds.fold_date("o_orderdate"), "MM"), F.col("o_custkey") % 10, F.substring("o_orderpriority", 1, 1))
              .distinct().agg(F.count("*").alias("n")))
    return usage.unionByName(orders).agg(F.sum("n").alias("n"))


#: What a layer is loaded from: a count of the given tables, or an earlier layer of which it
#: keeps every row.
SOURCES: dict[str, Callable | str] = {
    "raw_usage": _usage_rows, "raw_telemetry": _telemetry_rows, "raw_cost": _cost_rows,
    "usage_priced": "raw_usage", "provider_cost_stg": "raw_cost", "telemetry_stg": "raw_telemetry", "cost_reconciliation": "provider_cost_stg",
}

RUN_LOG = ("pipeline_run_id string, pipeline_name string, started_at timestamp_ntz, completed_at timestamp_ntz, status string, "
           "loaded_table_count long, error_message string")
CONTROL_LOG = "pipeline_run_id string, pipeline_name string, control_id string, control_class string, violation_count long, status string, checked_at timestamp_ntz"
LOAD_LOG = ("pipeline_run_id string, table_name string, source_row_count long, loaded_row_count long, row_count_difference long, "
            "status string, checked_at timestamp_ntz")


class ControlsFailed(RuntimeError):
    """A stage's checks failed: ``failed`` lists the control ids and table names."""

    def __init__(self, stage: str, failed: list[str]):
        super().__init__(f"{stage} failed: {', '.join(failed)}")
        self.failed = failed


class Logs:
    """The three logs of a warehouse folder."""

    def __init__(self, spark, base: str):
        self.runs = AppendLog(spark, f"{base}/_log/pipeline_run_log", RUN_LOG, "pipeline_name")
        self.controls = AppendLog(spark, f"{base}/_log/control_result", CONTROL_LOG, "pipeline_name")
        self.loads = AppendLog(spark, f"{base}/_log/load_reconciliation", LOAD_LOG, "table_name")


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Deployment:
    """Runs of the stages over one pipeline's input, kept under ``base``."""

    def __init__(self, p, base: str, clock: Callable[[], dt.datetime] = utc_now, on_fail: str = "raise"):
        if on_fail not in ("raise", "record"):
            raise ValueError("on_fail is 'raise' or 'record'")
        self.p, self.base, self.clock, self.on_fail = p, base.rstrip("/"), clock, on_fail
        self.store, self.logs = LayerStore(p.spark, base), Logs(p.spark, self.base)
        self._early: dict[str, Staged] = {}
        self.seconds: dict[str, float] = {}
        self.rows: dict[str, int] = {}
        p.deployment = self
        p.lines_clustered = True

    def run(self, run_id: str, stages: list[str] | None = None, rewrite: bool = True) -> None:
        """The stages in order.  ``rewrite=False`` audits the layers as they are."""
        wanted = list(STAGES) if stages is None else stages
        if unknown := set(wanted) - set(STAGES):
            raise ValueError(f"unknown stages: {sorted(unknown)}")
        with months_side_by_side(self.p.spark):
            for stage in (s for s in STAGES if s in wanted):
                self._stage(run_id, stage, rewrite)

    def _stage(self, run_id: str, stage: str, rewrite: bool) -> None:
        started = self.clock()
        before = {n: self.p.__dict__.get(n) for s in STAGES[stage] for n in (s, *ONE_TO_ONE.get(s, ()))}
        staged: list[Staged] = []
        try:
            if rewrite:
                staged = self._load(run_id, stage)
            failed = self._reconcile(run_id, staged) + self._audit(run_id, stage)
            if failed and self.on_fail == "raise":
                raise ControlsFailed(stage, failed)
            if staged:
                self.store.publish(staged, run_id, self.clock())
            self._log(run_id, stage, started, "FAIL" if failed else "PASS", len(staged), str(ControlsFailed(stage, failed)) if failed else None)
        except Exception as e:
            self._early.clear()
            for name, df in before.items():  # readers of this pipeline go back to what was published
                self.p.__dict__.pop(name, None)
                if df is not None:
                    self.p.__dict__[name] = df
            self._log(run_id, stage, started, "FAIL", 0, f"{type(e).__name__}: {e}"[:1000])
            raise

    def _write(self, run_id: str, name: str) -> Staged:
        t0 = time.perf_counter()
        columns = {child: getattr(self.p, child).columns for child in ONE_TO_ONE.get(name, ())}
        spec = LAYERS[name]
        staged = self.store.stage(name, getattr(self.p, name), run_id, spec.month_of, spec.cluster_by, spec.ordered)
        self.p.__dict__[name] = staged.df
        for child, cols in columns.items():
            self.p.__dict__[child] = staged.df.select(*cols)
        self.rows[name] = staged.rows
        self.seconds[name] = round(time.perf_counter() - t0, 3)
        return staged

    def _load(self, run_id: str, stage: str) -> list[Staged]:
        """Writes the stage's layers; the rows of their sources are counted meanwhile."""
        staged = []
        with ThreadPoolExecutor(WORKERS) as pool:
            counts = {n: pool.submit(lambda n=n: SOURCES[n](self.p).first()["n"] or 0) for n in STAGES[stage] if callable(SOURCES.get(n))}
            for group in GROUPS[stage]:
                for name in group:
                    for dep in BEFORE.get(name, ()):
                        self._early[dep] = self._write(run_id, dep)
                staged += pool.map(lambda n: self._early.pop(n, None) or self._write(run_id, n), group)
            self.expected = {n: c.result() for n, c in counts.items()}
        return staged

    def _reconcile(self, run_id: str, staged: list[Staged]) -> list[str]:
        """Rows loaded (counted while writing) against rows of the source."""
        now, rows = self.clock(), []
        for s in staged:
            source = SOURCES.get(s.layer)
            if source is not None:
                expected = self._rows_of(source) if isinstance(source, str) else self.expected[s.layer]
                diff = s.rows - expected
                rows.append((run_id, s.layer, expected, s.rows, diff, "PASS" if diff == 0 else "FAIL", now))
        self.logs.loads.append(rows)
        return [r[1] for r in rows if r[5] != "PASS"]

    def _rows_of(self, layer: str) -> int:
        """Rows of a layer as counted when this deployment wrote it, else of the published one."""
        return self.rows[layer] if layer in self.rows else getattr(self.p, layer).count()

    def _audit(self, run_id: str, stage: str) -> list[str]:
        """Evaluates and logs the stage's controls; the failed ids."""
        t0 = time.perf_counter()
        controls = [c for c in C.catalogue() if c.stage == stage]
        found = C.verdicts(self.p, controls)
        now = self.clock()
        self.logs.controls.append([(run_id, stage, c.control_id, c.klass, n, "PASS" if n == 0 else "FAIL", now) for c, n in found])
        self.seconds[f"audit {stage}"] = round(time.perf_counter() - t0, 3)
        return [c.control_id for c, n in found if n != 0]

    def _log(self, run_id: str, stage: str, started: dt.datetime, status: str, tables: int, error: str | None) -> None:
        self.logs.runs.append([(run_id, stage, started, self.clock(), status, tables, error)])
        for model in ("pipeline_status", "control_status"):
            self.p.__dict__.pop(model, None)

    def refresh_month(self, run_id: str, layer: str, df: DataFrame, month: str) -> None:
        """Rewrites one month ('yyyy-MM') of a layer from ``df`` and publishes it; all other
        months keep their files."""
        spec = LAYERS[layer]
        if spec.month_of is None:
            raise ValueError(f"{layer} has no months")
        part = df.filter(F.date_format(spec.month_of, "yyyy-MM") == month)
        staged = self.store.stage(layer, part, run_id, spec.month_of, spec.cluster_by)
        self.store.publish([staged], run_id, self.clock(), only_months=[month])
        self.p.__dict__[layer] = self.store.read(layer)

    def open(self) -> None:
        """Makes the pipeline read every published layer."""
        for name in LAYERS:
            try:
                self.p.__dict__[name] = self.store.read(name)
            except LookupError:
                continue


# ---- marts over the logs -----------------------------------------------------------------

def control_status(catalog: DataFrame, results: DataFrame) -> DataFrame:
    """Each catalogued control with its latest logged result, by (checked_at, run id)."""
    newest = latest(results.drop("control_class"), ["pipeline_name", "control_id"], ["checked_at", "pipeline_run_id"])
    return catalog.join(newest, ["pipeline_name", "control_id"], "left").select(
        *catalog.columns, "pipeline_run_id", "violation_count", F.coalesce("status", F.lit("MISSING")).alias("status"), "checked_at",
        (F.coalesce(F.col("status") == "PASS", F.lit(False))).cast("int").alias("pass_flag"),
        (F.coalesce(F.col("status") == "FAIL", F.lit(False))).cast("int").alias("fail_flag"))


def pipeline_status(spark, runs: DataFrame) -> DataFrame:
    """Every expected stage with its latest logged run (G31); one that never ran is MISSING."""
    expected = spark.createDataFrame([(i + 1, n) for i, n in enumerate(K.EXPECTED_PIPELINES)], "run_order int, pipeline_name string")
    newest = latest(runs, ["pipeline_name"], ["completed_at", "pipeline_run_id"])
    return expected.join(newest, "pipeline_name", "left").select(
        "run_order", "pipeline_name", "pipeline_run_id", "started_at", "completed_at", F.coalesce("status", F.lit("MISSING")).alias("status"),
        "loaded_table_count", "error_message", F.coalesce((F.col("status") == "PASS").cast("int"), F.lit(0)).alias("pass_flag"),
        F.coalesce((F.col("status") != "PASS").cast("int"), F.lit(1)).alias("attention_flag"))


def load_reconciliation(loads: DataFrame) -> DataFrame:
    """P20: each table's latest load against its source."""
    return latest(loads, ["table_name"], ["checked_at", "pipeline_run_id"])
