"""The eight raw feeds, derived from the driver's TPC-H-like tables.

The driver supplies ``lineitem`` / ``orders``; every feed is a projection of
them (FIXTURES.md section 3), so its size grows with the scale factor:

* line base      : one ``lineitem`` row = one logical request;
* provider usage : the base grouped to the 9-column daily grain (small at any
                   scale: days x keys x models), sums weighted by attempts;
* telemetry      : the base exploded to one row per attempt (the big feed);
* provider cost  : monthly usage lines from the priced estimate plus
                   non-usage lines grouped from ``orders``;
* model map, rate card, bridge, experiments, decisions: constant tables.

All work is JVM-side column expressions; the constant dimensions are tiny and
are the only broadcast sides.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tokenledger.functions.numeric import DISCOUNT, MONEY, PCT, RATE
from tokenledger.operators.lookup import effective_lookup
from tokenledger.operators.pricing import token_cost
from tokenledger.sources import constants as K

FOLD_DAYS = 546  # 2025-01-01 .. 2026-06-30
FOLD_ORIGIN = "1995-01-01"

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]


#: The models of the feeds, in their order.
MODELS = ["assist-large", "assist-small", "chat-large", "chat-mini", "text-embedding-s"]


def fold_date(ts_col: str) -> Column:
    """Map a driver timestamp onto the 18-month reporting window."""
    days = F.datediff(F.to_date(F.col(ts_col)), F.lit(FOLD_ORIGIN).cast("date"))
    return F.date_add(F.lit(K.PERIOD_START.isoformat()).cast("date"), days % FOLD_DAYS)


def key_provider(k: Column) -> Column:
    return F.when(k % 2 == 0, F.lit("openai")).otherwise(F.lit("anthropic"))


def key_project(k: Column) -> Column:
    return F.concat(F.lit("proj-"), F.floor(k / 2).cast("string"))


def model_name(openai: Column, pm5: Column) -> Column:
    return (F.when(openai, F.when(pm5 == 0, "text-embedding-s").when(pm5 <= 2, "chat-mini").otherwise("chat-large"))
            .otherwise(F.when(pm5 < 2, "assist-small").otherwise("assist-large")))


def clustered(lineitem: DataFrame) -> DataFrame:
    """The lines of each task by month, provider, model and project: one number of a narrow row
    is sorted, before ids and texts are made, and all that is derived row by row keeps the order.
    The count of lines is observed, as a sort with nothing but joins behind it is left out."""
    k, pm5 = F.col("l_suppkey") % 10, F.col("l_partkey") % 5
    model = F.array_position(F.array(*[F.lit(m) for m in MODELS]), model_name(k % 2 == 0, pm5))
    month = F.datediff(F.trunc(fold_date("l_shipdate"), "MM"), F.lit(K.PERIOD_START.isoformat()).cast("date"))
    order = ((month * 2 + (key_provider(k) == "openai").cast("int")) * 16 + model) * 16 + F.floor(k / 2)
    return (lineitem.select(*LINEITEM_COLS, order.cast("long").alias("_order")).sortWithinPartitions("_order").drop("_order")
            .observe("clustered lines", F.count(F.lit(1)).alias("lines")))


def line_base(lineitem: DataFrame) -> DataFrame:
    li = lineitem.select(*LINEITEM_COLS)
    qty = F.col("l_quantity").cast("bigint")
    k = F.col("l_suppkey") % 10
    pm5 = F.col("l_partkey") % 5
    openai = F.col("l_suppkey") % 2 == 0
    base = li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                    F.date_format(F.col("l_shipdate"), "yyyy-MM-dd"), qty.cast("string")
                    ).alias("logical_request_id"),
        "l_orderkey", "l_partkey",
        fold_date("l_shipdate").alias("usage_date"),
        key_provider(k).alias("provider"),
        key_project(k).alias("provider_project_id"),
        F.concat(F.lit("key-"), k.cast("string")).alias("api_key_id"),
        F.when(openai & (pm5 == 0), "embedding").otherwise("text_generation").alias("usage_type"),
        model_name(openai, pm5).alias("model"),
        ((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R")).alias("is_batch"),
        (F.floor(F.col("l_extendedprice")).cast("bigint") * 100).alias("in_tok"),
        F.when(openai & (pm5 == 0), F.lit(0).cast("bigint")).otherwise(qty * 2000).alias("out_tok"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("disc_pct"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tax_pct"),
        (1 + (F.col("l_partkey") % 9 == 0).cast("int")
         + (F.col("l_partkey") % 27 == 0).cast("int")).alias("attempts"),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % 25 != 0).alias("has_telemetry"),
        (F.col("l_orderkey") % 29 == 0).alias("final_failed"),
        (F.col("l_partkey") % 54 == 0).alias("rejected_retries"),
        F.when(F.col("l_partkey") % 16 < 4,
               F.concat(F.lit("EXP-"), (F.col("l_partkey") % 4).cast("string"))).alias("experiment_id"),
    )
    zero = F.lit(0).cast("bigint")
    batch = F.col("is_batch")
    return base.withColumns({
        "provider_service_tier": F.when(F.col("provider") == "openai", "default")
                                  .when(batch, "batch").otherwise("standard"),
        "context_window_tier": F.lit("standard"),
        "cached_tok": F.when(batch, zero).otherwise(
            F.floor(F.col("in_tok") * F.col("disc_pct") * 5 / 100).cast("bigint")),
        "w5_tok": F.when(batch | (F.col("provider") == "openai"), zero)
                   .otherwise(F.floor(F.col("in_tok") * 2 / 100).cast("bigint")),
        "w1_tok": F.when(batch | (F.col("provider") == "openai"), zero)
                   .otherwise(F.floor(F.col("in_tok") / 100).cast("bigint")),
        "reasoning_tok": F.when(F.col("model") == "chat-large",
                                F.floor(F.col("out_tok") * F.col("tax_pct") / 100).cast("bigint"))
                          .otherwise(zero),
    })


USAGE_GRAIN = ["usage_date", "provider", "usage_type", "provider_project_id", "api_key_id",
               "model", "provider_service_tier", "is_batch", "context_window_tier"]


def provider_usage(base: DataFrame) -> DataFrame:
    """Daily provider usage feed: base grouped to the 9-column grain.

    A partial (map-side) aggregate collapses each task's rows before the
    shuffle, so the exchange carries at most one row per grain per task."""
    a = F.col("attempts")
    agg = base.groupBy(*USAGE_GRAIN).agg(
        F.sum(a).alias("_req"),
        F.sum(F.col("in_tok") * a).alias("_in"),
        F.sum(F.col("cached_tok") * a).alias("_cached"),
        F.sum(F.col("w5_tok") * a).alias("_w5"),
        F.sum(F.col("w1_tok") * a).alias("_w1"),
        F.sum(F.col("out_tok") * a).alias("_out"),
    )
    oa = F.col("provider") == "openai"
    nul = F.lit(None).cast("bigint")
    return agg.select(
        *USAGE_GRAIN,
        F.when(oa, F.col("_req")).otherwise(nul).alias("request_count"),
        F.when(oa, F.col("_in")).otherwise(nul).alias("input_tokens"),
        F.col("_out").alias("output_tokens"),
        nul.alias("reasoning_tokens"),
        F.when(oa, F.col("_cached")).otherwise(nul).alias("cached_input_tokens"),
        F.when(oa, nul).otherwise(F.col("_in") - F.col("_cached") - F.col("_w5") - F.col("_w1"))
         .alias("uncached_input_tokens"),
        F.when(oa, nul).otherwise(F.col("_cached")).alias("cache_read_input_tokens"),
        F.when(oa, nul).otherwise(F.col("_w5")).alias("cache_creation_5m_tokens"),
        F.when(oa, nul).otherwise(F.col("_w1")).alias("cache_creation_1h_tokens"),
        F.lit(True).alias("is_synthetic"),
    )


def request_telemetry(base: DataFrame, model_map: DataFrame, rate_card: DataFrame) -> DataFrame:
    """Attempt-level telemetry: lines with telemetry, exploded to attempts.

    Each line is priced once (broadcast effective-dated lookups, no shuffle)
    before the explode; rejected retries carry zero tokens and zero cost."""
    lines = base.filter(F.col("has_telemetry"))
    lines = effective_lookup(
        lines, model_map,
        on={"provider": "provider", "usage_type": "usage_type", "model": "provider_model_name"},
        date_col="usage_date", start="effective_start", end="effective_end",
        fields=["model_snapshot"], count_col="_mm_count")
    lines = lines.withColumn("_tier", F.lit("standard"))
    lines = effective_lookup(
        lines, rate_card,
        on={"provider": "provider", "usage_type": "usage_type", "model_snapshot": "model_snapshot",
            "_tier": "normalized_processing_tier", "is_batch": "is_batch",
            "context_window_tier": "context_window_tier"},
        date_col="usage_date", start="effective_start", end="effective_end",
        fields=["input_rate_per_million", "cached_input_rate_per_million",
                "cache_write_5m_rate_per_million", "cache_write_1h_rate_per_million",
                "output_rate_per_million", "contracted_discount"],
        count_col="_rate_count")
    oa = F.col("provider") == "openai"
    uncached = F.col("in_tok") - F.col("cached_tok") - F.col("w5_tok") - F.col("w1_tok")
    lines = lines.withColumn("_line_cost", token_cost(
        uncached, "cached_tok", "w5_tok", "w1_tok", "out_tok",
        "input_rate_per_million", "cached_input_rate_per_million",
        "cache_write_5m_rate_per_million", "cache_write_1h_rate_per_million",
        "output_rate_per_million", "contracted_discount"))
    att = lines.withColumn("attempt_number", F.explode(F.sequence(F.lit(1), F.col("attempts"))))
    final = F.col("attempt_number") == F.col("attempts")
    rejected = ~final & F.col("rejected_retries")
    zero = F.lit(0).cast("bigint")

    def tok(expr: Column) -> Column:
        return F.when(rejected, zero).otherwise(expr)

    final_status = F.when(F.col("final_failed"), "failed").otherwise("success")
    return att.select(
        "logical_request_id",
        F.concat(F.col("logical_request_id"), F.lit("-"), F.col("attempt_number").cast("string"))
         .alias("provider_request_id"),
        F.col("attempt_number").cast("bigint").alias("attempt_number"),
        F.when(final, final_status).otherwise("failed").alias("attempt_status"),
        final.alias("is_final_attempt"),
        final_status.alias("final_request_status"),
        F.when(~final, "timeout").alias("retry_reason"),
        "usage_date", "provider", "provider_project_id", "api_key_id",
        F.concat(F.lit("app-"), F.col("api_key_id")).alias("application_name"),
        "experiment_id", "model",
        F.when(rejected, "rejected_pre_processing")
         .when(~final | F.col("final_failed"), "mid_generation_error").alias("failure_stage"),
        tok(F.when(oa, F.col("in_tok")).otherwise(zero)).alias("input_tokens"),
        tok(F.col("out_tok")).alias("output_tokens"),
        tok(F.col("reasoning_tok")).alias("reasoning_tokens"),
        tok(F.when(oa, F.col("cached_tok")).otherwise(zero)).alias("cached_input_tokens"),
        tok(F.when(oa, zero).otherwise(uncached)).alias("uncached_input_tokens"),
        tok(F.when(oa, zero).otherwise(F.col("cached_tok"))).alias("cache_read_input_tokens"),
        tok(F.col("w5_tok")).alias("cache_creation_5m_tokens"),
        tok(F.col("w1_tok")).alias("cache_creation_1h_tokens"),
        F.when(rejected, F.lit(0).cast(MONEY)).otherwise(F.col("_line_cost")).alias("usage_cost_estimate"),
        F.lit(True).alias("is_synthetic"),
    )


def _int_factor(k: Column, step: str) -> Column:
    """1 + k * step as an exact DECIMAL(5,3)."""
    return (F.lit(1) + k.cast(T.DecimalType(3, 0)) * F.lit(step).cast(T.DecimalType(4, 3))
            ).cast(T.DecimalType(5, 3))


def usage_cost_lines(usage_monthly: DataFrame) -> DataFrame:
    """One provider usage cost line per month x provider x project x model of
    the estimate, with deterministic reported / invoiced divergence."""
    m = F.month("billing_month")
    p = F.ascii(F.substring(F.col("provider_project_id"), -1, 1))
    ln = F.length("model")
    f_rep = _int_factor((m * 7 + p * 3 + ln) % 9 - 4, "0.004")
    f_inv = _int_factor((m * 5 + p + ln * 2) % 7 - 3, "0.005")
    reported = F.round(F.col("usage_cost_estimate").cast(MONEY) * f_rep, 6).cast(MONEY)
    reasons = K.USAGE_ADJUSTMENT_REASONS
    reason = F.when(m % 4 == 0, reasons[0]).when(m % 4 == 1, reasons[1]) \
        .when(m % 4 == 2, reasons[2]).otherwise(F.lit(None).cast("string"))
    return (usage_monthly
            .select("billing_month", "provider", "provider_project_id", "model",
                    reported.alias("provider_reported_cost"), reason.alias("adjustment_reason"),
                    f_inv.alias("_f_inv"))
            .select(
                F.col("billing_month").alias("billing_period"), "provider", "provider_project_id",
                "model", F.lit("model").alias("line_item_scope"), F.lit("usage").alias("line_item_type"),
                F.concat_ws("-", F.lit("usage"), F.date_format("billing_month", "yyyyMM"),
                            F.col("provider_project_id"), F.col("model")).alias("provider_line_item_id"),
                "provider_reported_cost",
                F.round(F.col("provider_reported_cost") * F.col("_f_inv"), 6).cast(MONEY)
                 .alias("invoice_billed_cost"),
                F.lit("USD").alias("billing_currency"),
                F.lit(0).cast(MONEY).alias("credit_amount"),
                "adjustment_reason",
                F.date_add(F.last_day("billing_month"), 5).alias("invoice_issue_date"),
                F.lit(False).alias("is_restatement"),
                F.lit(True).alias("is_synthetic")))


def non_usage_cost_lines(orders: DataFrame) -> DataFrame:
    """Credits, true-ups, corrections, adjustments and tax from ``orders``:
    month x key x type, amount = sum(o_totalprice) / 10000 (exact decimals)."""
    o = orders.select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    month = F.trunc(fold_date("o_orderdate"), "MM")
    k = F.col("o_custkey") % 10
    first = F.substring(F.col("o_orderpriority"), 1, 1)
    ltype = F.lit(None).cast("string")
    for ch, name in K.PRIORITY_LINE_TYPE.items():
        ltype = F.when(first == ch, name).otherwise(ltype)
    g = (o.select(month.alias("billing_period"), k.alias("k"), ltype.alias("line_item_type"),
                  F.col("o_totalprice").cast(T.DecimalType(15, 2)).alias("price"))
         .groupBy("billing_period", "k", "line_item_type")
         .agg(F.sum("price").alias("total")))
    amount = (F.col("total") * F.lit("0.0001").cast(T.DecimalType(5, 4))).cast(MONEY)
    signed = F.when(F.col("line_item_type").isin("credit", "correction"), -amount).otherwise(amount)
    return g.select(
        "billing_period",
        key_provider(F.col("k")).alias("provider"),
        key_project(F.col("k")).alias("provider_project_id"),
        F.lit(None).cast("string").alias("model"),
        F.when(F.col("line_item_type") == "tax", "invoice").otherwise("project").alias("line_item_scope"),
        "line_item_type",
        F.concat_ws("-", F.col("line_item_type"), F.date_format("billing_period", "yyyyMM"),
                    F.lit("key"), F.col("k").cast("string")).alias("provider_line_item_id"),
        F.lit(0).cast(MONEY).alias("provider_reported_cost"),
        signed.cast(MONEY).alias("invoice_billed_cost"),
        F.lit("USD").alias("billing_currency"),
        F.when(F.col("line_item_type") == "credit", signed).otherwise(F.lit(0)).cast(MONEY)
         .alias("credit_amount"),
        F.lit(None).cast("string").alias("adjustment_reason"),
        F.date_add(F.last_day("billing_period"), 5).alias("invoice_issue_date"),
        (F.col("line_item_type") == "correction").alias("is_restatement"),
        F.lit(True).alias("is_synthetic"),
    )


# ---------------------------------------------------------------------------
# constant dimensions
# ---------------------------------------------------------------------------

SERVICE_TIER_SCHEMA = T.StructType([
    T.StructField("provider", T.StringType(), False),
    T.StructField("provider_service_tier", T.StringType(), False),
    T.StructField("is_batch", T.BooleanType(), False),
    T.StructField("normalized_processing_tier", T.StringType(), False),
])

MODEL_MAP_SCHEMA = T.StructType([
    T.StructField("provider", T.StringType(), False),
    T.StructField("usage_type", T.StringType(), False),
    T.StructField("provider_model_name", T.StringType(), False),
    T.StructField("model_snapshot", T.StringType(), False),
    T.StructField("effective_start", T.DateType(), False),
    T.StructField("effective_end", T.DateType(), False),
    T.StructField("reasoning_capable", T.BooleanType(), False),
])

RATE_CARD_SCHEMA = T.StructType([
    T.StructField("provider", T.StringType(), False),
    T.StructField("usage_type", T.StringType(), False),
    T.StructField("model_snapshot", T.StringType(), False),
    T.StructField("normalized_processing_tier", T.StringType(), False),
    T.StructField("is_batch", T.BooleanType(), False),
    T.StructField("context_window_tier", T.StringType(), False),
    T.StructField("effective_start", T.DateType(), False),
    T.StructField("effective_end", T.DateType(), False),
    T.StructField("input_rate_per_million", RATE, False),
    T.StructField("cached_input_rate_per_million", RATE, True),
    T.StructField("cache_write_5m_rate_per_million", RATE, True),
    T.StructField("cache_write_1h_rate_per_million", RATE, True),
    T.StructField("output_rate_per_million", RATE, False),
    T.StructField("contracted_discount", DISCOUNT, False),
    T.StructField("rate_currency", T.StringType(), False),
    T.StructField("rate_basis", T.StringType(), False),
    T.StructField("rate_source", T.StringType(), False),
    T.StructField("retrieved_date", T.DateType(), False),
    T.StructField("rate_status", T.StringType(), False),
])

BRIDGE_SCHEMA = T.StructType([
    T.StructField("mapping_id", T.StringType(), False),
    T.StructField("provider", T.StringType(), False),
    T.StructField("provider_project_id", T.StringType(), False),
    T.StructField("api_key_id", T.StringType(), False),
    T.StructField("application_name", T.StringType(), False),
    T.StructField("department_name", T.StringType(), False),
    T.StructField("cost_center", T.StringType(), False),
    T.StructField("allocation_percentage", PCT, False),
    T.StructField("effective_start_date", T.DateType(), False),
    T.StructField("effective_end_date", T.DateType(), False),
    T.StructField("mapping_status", T.StringType(), False),
    T.StructField("allocation_method", T.StringType(), False),
    T.StructField("allocation_confidence", T.StringType(), False),
    T.StructField("mapping_recorded_date", T.DateType(), False),
    T.StructField("is_synthetic", T.BooleanType(), False),
])

EXPERIMENT_SCHEMA = T.StructType([
    T.StructField("experiment_id", T.StringType(), False),
    T.StructField("owner", T.StringType(), False),
    T.StructField("approver", T.StringType(), False),
    T.StructField("hypothesis", T.StringType(), False),
    T.StructField("application_name", T.StringType(), False),
    T.StructField("cost_center", T.StringType(), False),
    T.StructField("spending_limit", MONEY, False),
    T.StructField("spending_limit_period", T.StringType(), False),
    T.StructField("limit_currency", T.StringType(), False),
    T.StructField("warning_threshold", PCT, False),
    T.StructField("hard_stop_threshold", PCT, False),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("planned_end_date", T.DateType(), False),
    T.StructField("current_status", T.StringType(), False),
    T.StructField("override_reason", T.StringType(), True),
    T.StructField("is_synthetic", T.BooleanType(), False),
])

DECISION_SCHEMA = T.StructType([
    T.StructField("experiment_decision_id", T.StringType(), False),
    T.StructField("experiment_id", T.StringType(), False),
    T.StructField("decision", T.StringType(), False),
    T.StructField("decision_date", T.DateType(), False),
    T.StructField("decided_by", T.StringType(), False),
    T.StructField("rationale", T.StringType(), False),
    T.StructField("previous_status", T.StringType(), False),
    T.StructField("new_status", T.StringType(), False),
    T.StructField("is_synthetic", T.BooleanType(), False),
])


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A constant table that the planner knows the size of (a local relation)."""
    columns = list(zip(*rows)) if rows else [() for _ in schema]
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)


def service_tier_map(spark: SparkSession) -> DataFrame:
    return local_table(spark, K.SERVICE_TIER_MAP, SERVICE_TIER_SCHEMA)


def model_map(spark: SparkSession) -> DataFrame:
    return local_table(spark, K.MODEL_MAP, MODEL_MAP_SCHEMA)


def rate_card(spark: SparkSession) -> DataFrame:
    rows = [tuple(r[f.name] for f in RATE_CARD_SCHEMA.fields) for r in K.rate_card_rows()]
    return local_table(spark, rows, RATE_CARD_SCHEMA)


def bridge(spark: SparkSession) -> DataFrame:
    rows = []
    for (mid, k, app, dept, cc, pct, start, end, conf, rec) in K.BRIDGE:
        rows.append((mid, "openai" if k % 2 == 0 else "anthropic", f"proj-{k // 2}", f"key-{k}",
                     app, dept, cc, pct, start, end, "active", "mapped", conf, rec, True))
    return local_table(spark, rows, BRIDGE_SCHEMA)


def experiment_control(spark: SparkSession) -> DataFrame:
    rows = [(e[0], e[1], e[2], e[3], e[4], e[5], e[6], e[7], "USD", e[8], e[9], e[10], e[11],
             e[12], e[13], True) for e in K.EXPERIMENTS]
    return local_table(spark, rows, EXPERIMENT_SCHEMA)


def experiment_decision(spark: SparkSession) -> DataFrame:
    return local_table(spark, [d + (True,) for d in K.DECISIONS], DECISION_SCHEMA)
