"""The control catalogue (P31): one row a control with its name, domain, severity and layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# FIXED VALUES: the end-to-end controls of the registry: name, domain, data layer, description.
END_TO_END = {
    "E2E-01": ("Raw usage reaches priced staging", "Completeness", "Raw to staging", "Raw provider usage and priced staging contain the same number of rows."),
    "E2E-02": ("Raw cost reaches reconciliation", "Completeness", "Raw to core", "Raw provider cost and the reconciliation fact contain the same number of rows."),
    "E2E-03": ("Raw telemetry reaches staging", "Completeness", "Raw to staging", "Raw and staged request telemetry contain the same number of attempts."),
    "E2E-04": ("Provider usage grain is unique", "Grain", "Raw", "Provider usage contains no duplicate records at its locked grain."),
    "E2E-05": ("Provider cost grain is unique", "Grain", "Raw", "Provider cost contains no duplicate records at its locked grain."),
    "E2E-06": ("Telemetry attempt grain is unique", "Grain", "Raw", "Every provider request attempt has one unique provider request ID."),
    "E2E-07": ("Usage pricing resolves historically", "Pricing", "Staging", "Every usage row resolves one model, one tier, one historical rate, and a valid price."),
    "E2E-08": ("Usage estimate reconciles monthly", "Financial reconciliation", "Staging to core", "Monthly reconciliation retains the complete token-derived usage estimate."),
    "E2E-09": ("Provider-reported cost reconciles", "Financial reconciliation", "Staging to core", "Provider-reported cost totals reconcile to the provider cost source."),
    "E2E-10": ("Invoice-billed cost reconciles", "Financial reconciliation", "Staging to core", "Invoice-billed cost totals reconcile to the provider cost source."),
    "E2E-11": ("Daily allocation reconciles", "Allocation", "Core", "Allocated plus unallocated daily usage cost equals source usage cost for every source row."),
    "E2E-12": ("Telemetry reconciliation preserves provider cost", "Telemetry", "Core", "The telemetry reconciliation fact preserves the complete provider usage-cost estimate."),
    "E2E-13": ("Token economics reconciles", "Token economics", "Mart", "Token-economics cost and token totals reconcile to historically priced usage."),
    "E2E-14": ("Application chargeback reconciles", "Chargeback", "Mart", "Allocated plus unallocated application invoice cost equals source invoice cost."),
    "E2E-15": ("Savings stages remain governed", "Optimization governance", "Mart", "M13 does not falsely populate approved, implemented, or realized savings."),
    "E2E-16": ("Unit economics is financially governed", "Unit economics", "Mart", "Invoice usage cost reconciles and weak telemetry withholds governed request-cost metrics."),
    "E2E-17": ("Experiment governance is complete", "Experiment governance", "Mart", "Every controlled experiment is present and every governance exception has a reason."),
    "E2E-18": ("Required cloud pipelines passed", "Pipeline health", "Control", "The latest M6 through M15 pipeline runs all exist and have PASS status."),
}
CATALOG = ("control_id string, pipeline_name string, control_class string, source_tables string, control_name string, "
           "control_domain string, severity string, data_layer string, description string")


def catalog_rows(controls) -> list[tuple]:
    """The registry's columns; controls of a single stage are named by their id."""
    rows = []
    for c in controls:
        name, domain, layer, text = END_TO_END.get(c.control_id, (c.control_id, None, None, None))
        severity = "CRITICAL" if c.control_id in END_TO_END else "STAGE"
        rows.append((c.control_id, c.stage, c.klass, ",".join(c.tables), name, domain, severity, layer, text))
    return rows


def control_catalog(spark: SparkSession, controls) -> DataFrame:
    return spark.createDataFrame(catalog_rows(controls), CATALOG)
