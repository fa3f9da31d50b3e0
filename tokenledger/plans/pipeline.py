"""The whole model graph for one input folder, as lazily built DataFrames.

``Pipeline(spark, sf_dir)`` reads only the driver tables a model needs
(column-pruned parquet scans) and exposes each model as a cached property,
so queries that share a model share one logical plan.  Nothing is
written unless ``materialize()`` is called.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tokenledger.plans import core, marts, semantic, staging
from tokenledger.sources import feeds


def shared(fn):
    """A model that several others start from.  In a sharing pipeline it is written once, when
    first asked for, and read back: no query then derives it twice."""
    def build(self: Pipeline) -> DataFrame:
        df = fn(self)
        return self._keep(fn.__name__, df) if self.shared_base else df

    build.__doc__ = fn.__doc__
    return cached_property(build)


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, shared_base: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.shared_base = shared_base

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.shared_base}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- raw feeds -------------------------------------------------------
    @cached_property
    def line_base(self) -> DataFrame:
        return feeds.line_base(self.table("lineitem"))

    @cached_property
    def model_map(self) -> DataFrame:
        return feeds.model_map(self.spark)

    @cached_property
    def service_tier_map(self) -> DataFrame:
        return feeds.service_tier_map(self.spark)

    @cached_property
    def rate_card(self) -> DataFrame:
        return feeds.rate_card(self.spark)

    @cached_property
    def bridge(self) -> DataFrame:
        return feeds.bridge(self.spark)

    @cached_property
    def experiment_control(self) -> DataFrame:
        return feeds.experiment_control(self.spark)

    @cached_property
    def experiment_decision(self) -> DataFrame:
        return feeds.experiment_decision(self.spark)

    @shared
    def raw_usage(self) -> DataFrame:
        return feeds.provider_usage(self.line_base)

    @cached_property
    def raw_telemetry(self) -> DataFrame:
        lines = feeds.line_base(feeds.clustered(self.table("lineitem"))) if self.lines_clustered else self.line_base
        return feeds.request_telemetry(lines, self.model_map, self.rate_card)

    @shared
    def raw_cost(self) -> DataFrame:
        return feeds.usage_cost_lines(self.usage_cost_monthly).unionByName(
            feeds.non_usage_cost_lines(self.table("orders")))

    # ---- staging -----------------------------------------------------------
    @cached_property
    def usage_normalized(self) -> DataFrame:
        return staging.usage_normalized(self.raw_usage, self.model_map, self.service_tier_map)

    @shared
    def usage_priced(self) -> DataFrame:
        return staging.usage_priced(self.usage_normalized, self.rate_card)

    @cached_property
    def provider_cost_stg(self) -> DataFrame:
        return staging.provider_cost(self.raw_cost)

    @shared
    def telemetry_stg(self) -> DataFrame:
        return staging.request_telemetry(self.raw_telemetry)

    # ---- core --------------------------------------------------------------
    @shared
    def usage_cost_monthly(self) -> DataFrame:
        return core.usage_cost_monthly(self.usage_priced)

    @shared
    def cost_reconciliation(self) -> DataFrame:
        return core.cost_reconciliation(self.provider_cost_stg, self.usage_cost_monthly)

    @shared
    def usage_daily(self) -> DataFrame:
        return core.usage_daily_allocation(self.usage_priced, self.bridge)

    @shared
    def app_driver_monthly(self) -> DataFrame:
        return core.application_invoice_driver_monthly(self.usage_daily)

    @shared
    def telemetry_recon_daily(self) -> DataFrame:
        return core.telemetry_reconciliation_daily(self.usage_priced, self.telemetry_stg)

    # ---- marts -------------------------------------------------------------
    @shared
    def telemetry_coverage_monthly(self) -> DataFrame:
        return marts.telemetry_coverage_monthly(self.telemetry_recon_daily)

    @shared
    def token_economics(self) -> DataFrame:
        return marts.token_economics(self.usage_priced, self.rate_card, self.telemetry_stg)

    @shared
    def application_cost(self) -> DataFrame:
        return marts.application_cost(self.cost_reconciliation, self.app_driver_monthly)

    @cached_property
    def application_cost_gaps(self) -> DataFrame:
        """P14 where scopes lack drivers: none in every fifth month of one provider, a negative
        total in July of the other."""
        from pyspark.sql import functions as F
        month, provider, cost = F.month("billing_month"), F.col("provider"), F.col("driver_usage_cost_estimate")
        d = self.app_driver_monthly.filter(~((provider == "openai") & (month % 5 == 0)))
        turned = F.when((provider == "anthropic") & (month == 7), -cost).otherwise(cost).cast(d.schema["driver_usage_cost_estimate"].dataType)
        return marts.application_cost(self.cost_reconciliation, d.withColumn("driver_usage_cost_estimate", turned))

    @shared
    def optimization(self) -> DataFrame:
        return marts.optimization(self.token_economics, self.telemetry_coverage_monthly)

    @shared
    def unit_economics(self) -> DataFrame:
        return marts.unit_economics(self.token_economics, self.cost_reconciliation,
                                    self.telemetry_coverage_monthly)

    @shared
    def experiment_driver_daily(self) -> DataFrame:
        return marts.experiment_driver_daily(self.telemetry_stg, self.cost_reconciliation,
                                             self.telemetry_coverage_monthly)

    @shared
    def experiment_daily(self) -> DataFrame:
        return marts.experiment_daily(self.experiment_control, self.experiment_driver_daily)

    @shared
    def experiment_periods(self) -> DataFrame:
        return marts.experiment_periods(self.experiment_daily)

    @shared
    def experiments(self) -> DataFrame:
        return marts.experiment_governance(self.experiment_periods, self.experiment_decision)

    # ---- semantic ----------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return semantic.dim_date(self.usage_priced)

    @cached_property
    def dim_provider(self) -> DataFrame:
        return semantic.dim_provider(self.token_economics, self.application_cost)

    @cached_property
    def dim_model(self) -> DataFrame:
        return semantic.dim_model(self.token_economics, self.application_cost)

    @cached_property
    def dim_application(self) -> DataFrame:
        return semantic.dim_application(self.application_cost)

    @cached_property
    def dim_experiment(self) -> DataFrame:
        return semantic.dim_experiment(self.experiment_control)

    @shared
    def fact_financial_monthly(self) -> DataFrame:
        return semantic.fact_financial_monthly(self.application_cost)

    @shared
    def fact_usage_monthly(self) -> DataFrame:
        return semantic.fact_usage_monthly(self.token_economics)

    @cached_property
    def fact_unit_economics_monthly(self) -> DataFrame:
        return semantic.fact_unit_economics_monthly(self.unit_economics)

    @shared
    def fact_optimization_monthly(self) -> DataFrame:
        return semantic.fact_optimization_monthly(self.optimization)

    @cached_property
    def fact_experiment_current(self) -> DataFrame:
        return semantic.fact_experiment_current(self.experiments)

    # ---- quality -----------------------------------------------------------
    @cached_property
    def line_item_totals(self) -> DataFrame:
        """Per line type: source invoice total and distributed total, as a
        union of the two grouped sides (full-outer parity without a join)."""
        from pyspark.sql import functions as F
        src = (self.cost_reconciliation.groupBy("line_item_type")
               .agg(F.sum("invoice_billed_cost").alias("source_cost"))
               .withColumn("distributed_cost", F.lit(None).cast("decimal(38,9)")))
        dst = (self.application_cost.groupBy("line_item_type")
               .agg((F.sum("allocated_invoice_billed_cost") + F.sum("unallocated_invoice_billed_cost"))
                    .cast("decimal(38,9)").alias("distributed_cost"))
               .withColumn("source_cost", F.lit(None).cast("decimal(38,9)")))
        return src.unionByName(dst)

    #: Set by a deployment: its logs answer for what ran and with which result.
    deployment = None
    #: Set by a deployment: telemetry is made from lines in the order of its layers.
    lines_clustered = False

    @cached_property
    def pipeline_status(self) -> DataFrame:
        """Expected stages with their latest logged run; without a deployment none ever ran."""
        from tokenledger.runs.deploy import RUN_LOG, pipeline_status
        runs = self.deployment.logs.runs.read() if self.deployment else self.spark.createDataFrame([], RUN_LOG)
        return pipeline_status(self.spark, runs)

    @property
    def control_results(self) -> DataFrame:
        """Every control's verdict: the latest logged one of each, or evaluated now where there
        is no deployment."""
        from tokenledger.quality.controls import evaluate
        from tokenledger.runs.store import latest
        if self.deployment is None:
            return evaluate(self)
        return latest(self.deployment.logs.controls.read(), ["pipeline_name", "control_id"], ["checked_at", "pipeline_run_id"])

    @cached_property
    def control_catalog(self) -> DataFrame:
        from tokenledger.quality.controls import catalogue
        from tokenledger.quality.status import control_catalog
        return control_catalog(self.spark, catalogue())

    @cached_property
    def control_status(self) -> DataFrame:
        from tokenledger.runs.deploy import CONTROL_LOG, control_status
        results = self.deployment.logs.controls.read() if self.deployment else self.spark.createDataFrame([], CONTROL_LOG)
        return control_status(self.control_catalog, results)

    @property
    def load_reconciliation(self) -> DataFrame:
        from tokenledger.runs.deploy import LOAD_LOG, load_reconciliation
        return load_reconciliation(self.deployment.logs.loads.read() if self.deployment else self.spark.createDataFrame([], LOAD_LOG))

    # ---- materialisation -----------------------------------------------------
    def materialize(self, base: str | None = None, run_id: str = "run-1", clock: Callable[[], dt.datetime] | None = None) -> str:
        """Deploys every stage (see ``runs.deploy``) under the session's shared folder and reads
        the published layers from then on: later models start from a scan, and a lost executor
        recomputes from the written layer.  Verdicts are recorded, not raised."""
        from tokenledger.runs.deploy import Deployment, utc_now
        from tokenledger.session import checkpoint_dir
        base = base or f"{checkpoint_dir(self.spark).rstrip('/')}/layers-{uuid.uuid4().hex[:12]}"
        run = Deployment(self, base, clock or utc_now, on_fail="record")
        run.run(run_id)
        self.layer_seconds = run.seconds
        return base


#: Run ids and scheduled times of the runs behind the registered queries.
RUN_1, RUN_2 = ("run-1", dt.datetime(2026, 7, 1)), ("run-2", dt.datetime(2026, 7, 2))

_CACHE: dict[tuple[str, ...], Pipeline] = {}


def input_version(spark: SparkSession, sf_dir: str) -> str:
    """A digest of the input files' names, sizes and times: other contents, other version."""
    import hashlib

    from tokenledger.runs.store import files
    return hashlib.sha256(repr(files(spark, f"{sf_dir}/lineitem.parquet") + files(spark, f"{sf_dir}/orders.parquet")).encode()).hexdigest()[:16]


def pipeline(spark: SparkSession, sf_dir: str, materialized: bool = False, sharing: bool = False) -> Pipeline:
    """Pipeline for one version of an input folder, one per session and kind.  ``materialized``
    returns a deployed pipeline (all layers written and audited), ``sharing`` one that writes a
    shared model when a query first needs it, keyed by model and input version."""
    from tokenledger.session import checkpoint_dir
    sf_dir = sf_dir.rstrip("/")
    kind = "deployed" if materialized else "shared" if sharing else "plain"
    key = (spark.sparkContext.applicationId, sf_dir, kind, input_version(spark, sf_dir))
    if key not in _CACHE:
        base = f"{checkpoint_dir(spark).rstrip('/')}/shared-{uuid.uuid4().hex[:12]}/{key[3]}" if kind == "shared" else None
        p = Pipeline(spark, sf_dir, base)
        if materialized:
            p.materialize(run_id=RUN_1[0], clock=lambda: RUN_1[1])
        _CACHE[key] = p
    return _CACHE[key]


def release(spark: SparkSession) -> int:
    """Forgets this session's pipelines and deletes what they wrote; results made from them
    must have been read.  Returns how many were dropped."""
    from tokenledger.runs.store import remove_folder
    mine = [k for k in _CACHE if k[0] == spark.sparkContext.applicationId]
    for key in mine:
        p = _CACHE.pop(key)
        for base in (p.shared_base, p.deployment.base if p.deployment else None):
            if base:
                remove_folder(spark, base)
    return len(mine)
