"""Month-offset and share measures in any context, and the sentences and card texts made from

A context is a choice of provider and application (each may be open) and a month.  Removing a
filter means looking a measure up in another context: the previous month replaces the month by
an offset, a share's denominator opens the application.  All contexts come from one pass with
grouping sets; the look-ups are equi joins between the few context rows.  Texts round half away
from zero on exact decimals, so every engine writes the same characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenledger.plans.reports import _money

KEYS = ["billing_month", "provider", "application_name"]
ALL = "all"

# FIXED VALUES: display names of optimisation types and gate states, and their names in sentences.
TYPE_DISPLAY = {"BATCH_MIGRATION": "Batch Migration", "RETRY_REDUCTION": "Retry Reduction", "CACHE_REUSE_ASSESSMENT": "Cache Reuse",
                "MODEL_RIGHTSIZING": "Model Right-Sizing", "TELEMETRY_COVERAGE": "Telemetry Coverage"}
TYPE_IN_TEXT = {"BATCH_MIGRATION": "batch migration", "RETRY_REDUCTION": "retry reduction", "CACHE_REUSE_ASSESSMENT": "cache reuse",
                "MODEL_RIGHTSIZING": "model right-sizing", "TELEMETRY_COVERAGE": "telemetry coverage"}
GATE_DISPLAY = {"READY_FOR_EVALUATION": "Ready", "REQUIRES_BENCHMARK": "Needs Benchmark", "HOLD_FOR_DATA": "Data Hold"}


def named(col: Column, names: dict[str, str], other: Column) -> Column:
    out = F.lit(None).cast("string")
    for value, name in names.items():
        out = F.when(col == value, name).otherwise(out)
    return F.coalesce(out, other)


def fixed(x: Column, digits: int) -> Column:
    """A number with so many decimals."""
    return F.round(x.cast("decimal(38,9)"), digits).cast(f"decimal(38,{digits})").cast("string")


def dollars(x: Column) -> Column:
    """$1.23M, $1.23K or $1.23, the sign in front."""
    size = F.abs(x.cast("double"))
    text = (F.when(size >= 1e6, F.concat(fixed(size / 1e6, 2), F.lit("M"))).when(size >= 1e3, F.concat(fixed(size / 1e3, 2), F.lit("K")))
            .otherwise(F.regexp_replace(fixed(size, 2), "^1000", "1,000")))
    return F.concat(F.when(x < 0, "-$").otherwise("$"), text)


def percent(x: Column, digits: int) -> Column:
    return F.concat(fixed(x.cast("double") * 100, digits), F.lit("%"))


def ratio(n: Column, d: Column) -> Column:
    return F.try_divide(n.cast("double"), d.cast("double"))


def month_context_measures(fin: DataFrame) -> DataFrame:
    """Latest and previous month's invoice cost, the change, and the usage cost share for every
    month and every choice of provider and application.

    ``provider`` or ``application_name`` 'all' stands for no filter.  A month without rows whose
    previous month has some is a context too, up to the last month of the table."""
    usage = F.when(F.col("line_item_type") == "usage", F.col("invoice_billed_cost"))
    sets = [[F.col(k) for k in ks] for ks in (KEYS, KEYS[:2], [KEYS[0], KEYS[2]], KEYS[:1])]
    c = fin.groupingSets(sets, *KEYS).agg(
        F.sum("invoice_billed_cost").alias("cost"), F.sum(usage).alias("usage_cost"), F.grouping("provider").alias("any_p"),
        F.grouping("application_name").alias("any_a"))
    c = c.select("billing_month", *[F.when(F.col(g) == 1, ALL).otherwise(F.col(k)).alias(k) for k, g in (("provider", "any_p"), ("application_name", "any_a"))],
                 "cost", "usage_cost")
    earlier = c.select(F.add_months("billing_month", 1).alias("billing_month"), "provider", "application_name", F.col("cost").alias("before"))
    last = c.filter(f"provider = '{ALL}' and application_name = '{ALL}'").agg(F.max("billing_month").alias("last"))
    months = c.select("billing_month").distinct().union(last.select(F.col("last"))).distinct()
    both = c.join(earlier.join(F.broadcast(months), "billing_month", "left_semi"), KEYS, "full")
    opened = c.filter(F.col("application_name") == ALL).select("billing_month", "provider", F.col("usage_cost").alias("whole"))
    out = both.join(opened, ["billing_month", "provider"], "left")
    cost, before = (F.expr(_money(x)) for x in ("cost", "before"))
    return out.select(*KEYS, cost.alias("latest_month_invoice_cost"), before.alias("previous_month_invoice_cost"),
                      ratio(cost - before, before).alias("invoice_cost_mom_pct"), ratio(F.col("usage_cost"), F.col("whole")).alias("usage_invoice_cost_share_pct"))


def _contexts(df: DataFrame, provider: str = "provider") -> DataFrame:
    """Each row once for the whole and once for its provider."""
    return df.withColumn("context", F.explode(F.array(F.lit(ALL), F.col(provider))))


def _top(df: DataFrame, name: str, value: str) -> DataFrame:
    """(context, top, top_value): the greatest positive value, ties by name."""
    order = F.struct((-F.col(value)).alias("v"), F.col(name).alias("n"))
    return df.filter(F.col(value) > 0).groupBy("context").agg(F.min_by(F.struct(F.col(name).alias("top"), F.col(value).alias("top_value")), order).alias("t")) \
        .select("context", "t.*")


def insight_texts(fin: DataFrame, usage: DataFrame, opt: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row of texts a context: all providers together, then each provider."""
    lines = F.col("line_item_type") == "usage"
    base = _contexts(fin.groupBy("billing_month", "provider", "application_name").agg(
        F.sum("invoice_billed_cost").alias("cost"), F.sum(F.when(lines, F.col("invoice_billed_cost"))).alias("used"),
        F.sum(F.when(lines, F.col("provider_reported_cost"))).alias("reported"), F.sum(F.when(lines, F.col("usage_cost_estimate"))).alias("estimate")))
    month = dim_date.agg(F.max("month_start_date").alias("m"))
    marks = month.select(F.explode(F.array(F.struct(F.col("m").alias("billing_month"), F.lit("latest").alias("role")),
                                           F.struct(F.add_months("m", -1).alias("billing_month"), F.lit("previous").alias("role")))).alias("x")).select("x.*")
    spend = base.join(F.broadcast(marks), "billing_month", "left").groupBy("context").agg(
        *[F.sum(F.when(F.col("role") == r, F.col("cost"))).alias(r) for r in ("latest", "previous")],
        *[F.sum(x).alias(x) for x in ("used", "reported", "estimate")])
    app = _top(base.groupBy("context", "application_name").agg(F.sum("used").alias("v")), "application_name", "v")
    saved = _contexts(opt.groupBy("provider", "model", "optimization_type", "recommendation_title").agg(F.sum("identified_annualized_savings").alias("v")))
    kind, title = (_top(saved.groupBy("context", k).agg(F.sum("v").alias("v")), k, "v") for k in ("optimization_type", "recommendation_title"))
    total = saved.groupBy("context").agg(F.sum("v").alias("opportunity"))
    actions = (saved.groupBy("context", "recommendation_title", "provider", "model").agg(F.sum("v").alias("v")).filter("v > 0")
               .groupBy("context").agg(F.count(F.lit(1)).alias("quantified_recommendation_actions")))
    tokens = _contexts(usage.groupBy("provider").agg(F.sum("total_tokens").alias("tokens"))).groupBy("context").agg(F.sum("tokens").alias("tokens"))
    row = spend
    for name, part in (("app", app), ("kind", kind), ("title", title)):
        row = row.join(part.withColumnsRenamed({"top": name, "top_value": f"{name}_value"}), "context", "left")
    row = row.join(total, "context", "left").join(actions, "context", "left").join(tokens, "context", "left")

    latest, previous, opportunity = (F.expr(_money(x)) for x in ("latest", "previous", "opportunity"))
    mom = ratio(latest - previous, previous)
    moved = (F.when(mom.isNull(), "has no prior-month comparison").when(mom < 0, F.concat(F.lit("fell "), percent(F.abs(mom), 1)))
             .when(mom > 0, F.concat(F.lit("rose "), percent(mom, 1))).otherwise("was unchanged"))
    movement = F.when(mom < 0, "decline").when(mom > 0, "increase").otherwise("movement")
    gap = ratio(F.expr(_money("reported")) - F.expr(_money("estimate")), F.abs(F.expr(_money("estimate"))))
    gap_text = (F.when(gap < 0, F.concat(percent(F.abs(gap), 1), F.lit(" below the usage estimate")))
                .when(gap > 0, F.concat(percent(gap, 1), F.lit(" above the usage estimate"))).otherwise("aligned with the usage estimate"))
    share = percent(ratio(F.col("app_value"), F.col("used")), 1)
    title_kind = (F.when(F.lower("title").contains("batch"), "batch migration").when(F.lower("title").contains("retry"), "retry reduction")
                  .otherwise(F.col("title")))

    def text(*parts) -> Column:  # a blank value is written as nothing
        return F.concat(*[F.coalesce(p, F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])

    return row.select(
        "context",
        text("SPEND SIGNAL\n• Latest invoice cost ", moved, " to ", dollars(latest), ". Validate whether the movement reflects demand, model mix or "
             "efficiency.\n\nCONCENTRATION RISK\n• ", F.col("app"), " represents ", share, " of usage cost and should be the first workload investigated."
             "\n\nDECISION PRIORITY\n• ", dollars(opportunity), " of modeled annualized opportunity is identified. ",
             percent(ratio(F.col("title_value"), F.col("opportunity")), 0), " is driven by ", title_kind, ". Provider-reported usage is ", gap_text,
             ", so validate pricing before approval.").alias("executive_readout"),
        text("Latest invoice cost ", moved, " to ", F.coalesce(dollars(latest), F.lit("N/A")),
             ".\nValidate whether demand, model mix or efficiency caused the ", movement, ".").alias("spend_signal_insight"),
        text(F.col("app"), " drives ", share, " of usage cost.\nPrioritize this workload for cost and architecture review.").alias("concentration_risk_insight"),
        text(dollars(opportunity), " modeled annualized opportunity; ", percent(ratio(F.col("kind_value"), F.col("opportunity")), 0), " comes from ",
             named(F.col("kind"), TYPE_IN_TEXT, F.lower("kind")), ".\nValidate the ", percent(F.abs(gap), 1), " pricing gap before approval.")
        .alias("decision_priority_insight"),
        F.concat(fixed(F.col("tokens").cast("double") / 1e9, 1), F.lit("B")).alias("total_tokens_card_display"),
        F.coalesce("quantified_recommendation_actions", F.lit(0)).alias("quantified_recommendation_actions"))


def recommendation_displays(opt: DataFrame) -> DataFrame:
    """Display columns of the recommendations, with how many rows show each combination."""
    low = F.lower("recommendation_title")
    return opt.select(
        "optimization_type", "recommendation_title", "evaluation_gate_status",
        F.when(low.contains("asynchronous"), "Batch migration").when(low.contains("retry"), "Retry reduction").otherwise(F.col("recommendation_title"))
        .alias("recommendation_display"),
        named(F.col("optimization_type"), TYPE_DISPLAY, F.col("optimization_type")).alias("optimization_type_display"),
        named(F.col("evaluation_gate_status"), GATE_DISPLAY, F.col("evaluation_gate_status")).alias("evaluation_status_display"),
    ).groupBy("optimization_type", "recommendation_title", "evaluation_gate_status", "recommendation_display", "optimization_type_display",
              "evaluation_status_display").agg(F.count(F.lit(1)).alias("recommendations"))
