
import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tokenledger.operators.allocate import allocate_percent
from tokenledger.operators.asof import asof_latest, latest_per_key
from tokenledger.operators.lookup import effective_lookup
from tokenledger.operators.pricing import token_cost
from tokenledger.functions.keys import hash_key
from tokenledger.functions.numeric import as_double, ratio, strict_greatest
from tokenledger.operators.lookup import fits_broadcast
from tokenledger.plans.marts import application_cost, pct1_of_ratio
from tokenledger.plans import reports

d = dt.date


def test_effective_lookup_boundaries_and_cardinality(spark):
    dim = spark.createDataFrame([
        ("m", "s1", d(2025, 1, 10), d(2025, 1, 20)),
        ("m", "s2", d(2025, 1, 15), d(2025, 1, 25)),   # overlaps s1 on 15..20
        ("n", "t1", d(2025, 1, 1), d(2025, 12, 31)),
    ], "k string, snap string, effective_start date, effective_end date")
    fact = spark.createDataFrame([
        (1, "m", d(2025, 1, 9)), (2, "m", d(2025, 1, 10)), (3, "m", d(2025, 1, 14)),
        (4, "m", d(2025, 1, 15)), (5, "m", d(2025, 1, 20)), (6, "m", d(2025, 1, 25)),
        (7, "m", d(2025, 1, 26)), (8, "x", d(2025, 1, 15)), (9, "n", d(2025, 6, 1)),
    ], "id int, k string, dt date")
    out = {r.id: (r.cnt, r.snap) for r in effective_lookup(
        fact, dim, {"k": "k"}, "dt", "effective_start", "effective_end", ["snap"], "cnt").collect()}
    assert out[1] == (0, None)           # day before
    assert out[2] == (1, "s1")           # on start
    assert out[3] == (1, "s1")
    assert out[4][0] == 2 and out[4][1] == "s1"   # overlap: count 2, first by start
    assert out[5][0] == 2                # on end of s1, inside s2
    assert out[6] == (1, "s2")           # on end
    assert out[7] == (0, None)           # day after
    assert out[8] == (0, None)           # no key
    assert out[9] == (1, "t1")
    assert len(out) == 9                 # every fact row kept, no fan-out


def test_token_cost_fallbacks_and_discount(spark):
    df = spark.createDataFrame([
        (1_000_000, 1_000_000, 0, 0, 1_000_000, D("3"), None, None, None, D("15"), D("0")),
        (1_000_000, 0, 1_000_000, 1_000_000, 0, D("1"), D("0.1"), None, None, D("2"), D("0.05")),
        (0, 0, 0, 0, 0, D("1"), D("0.1"), D("1.25"), D("2"), D("2"), D("0")),
    ], "u long, r long, w5 long, w1 long, o long, rin decimal(10,6), rc decimal(10,6), "
       "r5 decimal(10,6), r1 decimal(10,6), ro decimal(10,6), disc decimal(5,4)")
    got = [r.c for r in df.select(token_cost("u", "r", "w5", "w1", "o", "rin", "rc", "r5", "r1", "ro", "disc")
                                  .alias("c")).collect()]
    # NULL cached rate falls back to the input rate: 3 + 3 + 15
    assert got[0] == D("21.000000000")
    # NULL write rates bill 0; discount 5 %: (1) * 0.95
    assert got[1] == D("0.950000000")
    assert got[2] == D("0E-9")


def test_ratio_and_strict_greatest(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 4, 2), (None, 2, -1)], "a int, b int, c int")
    rows = df.select(ratio("a", "b").alias("r"), strict_greatest(F.col("c"), F.lit(0)).alias("g")).collect()
    assert rows[0].r is None and rows[0].g is None      # zero denominator; NULL propagates
    assert rows[1].r == 0.25 and rows[1].g == 2
    assert rows[2].r is None and rows[2].g == 0


def test_allocate_percent_residual_and_conservation(spark):
    bridge = spark.createDataFrame([
        ("M1", "p", "j", "k1", "a1", "d", "c", D("1.0"), d(2025, 1, 1), d(2025, 12, 31), "x", "y", "high", d(2025, 1, 1), True),
        ("M2", "p", "j", "k2", "a1", "d", "c", D("0.6"), d(2025, 1, 1), d(2025, 12, 31), "x", "y", "high", d(2025, 1, 1), True),
        ("M3", "p", "j", "k2", "a2", "d", "c", D("0.3"), d(2025, 1, 1), d(2025, 12, 31), "x", "y", "high", d(2025, 1, 1), True),
        ("M4", "p", "j", "k4", "a1", "d", "c", D("0.7"), d(2025, 1, 1), d(2025, 12, 31), "x", "y", "high", d(2025, 1, 1), True),
        ("M5", "p", "j", "k4", "a3", "d", "c", D("0.5"), d(2025, 1, 1), d(2025, 12, 31), "x", "y", "high", d(2025, 3, 1), True),
    ], "mapping_id string, provider string, provider_project_id string, api_key_id string, "
       "application_name string, department_name string, cost_center string, allocation_percentage decimal(5,4), "
       "effective_start_date date, effective_end_date date, mapping_status string, allocation_method string, "
       "allocation_confidence string, mapping_recorded_date date, is_synthetic boolean")
    usage = spark.createDataFrame([
        ("u1", "p", "j", "k1", d(2025, 2, 1), 100, D("10.000000001")),
        ("u2", "p", "j", "k2", d(2025, 2, 1), 100, D("10.000000001")),
        ("u3", "p", "j", "k3", d(2025, 2, 1), 100, D("10.000000001")),
        ("u4", "p", "j", "k4", d(2025, 2, 1), 100, D("10.000000001")),
    ], "source_usage_key string, provider string, provider_project_id string, api_key_id string, "
       "usage_date date, tokens long, cost decimal(28,9)")
    rows = allocate_percent(usage, bridge, ["tokens", "cost"], ["cost"]).collect()
    by = {}
    for r in rows:
        by.setdefault(r.source_usage_key, []).append(r)
    assert len(by["u1"]) == 1 and by["u1"][0].allocation_status == "Allocated"
    u2 = sorted(by["u2"], key=lambda r: r.allocation_status)
    assert [r.allocation_status for r in u2].count("Unallocated") == 1
    assert [r.allocation_method for r in u2 if r.allocation_status == "Unallocated"] == ["unallocated_residual"]
    assert [r.allocation_method for r in by["u3"]] == ["no_mapping"]
    assert all(r.allocation_status == "Allocated" for r in by["u4"])   # 120 %: no residual (kept, flagged by a control)
    assert any(r.is_historical_restatement for r in by["u4"])           # recorded after start, usage before recorded
    for key in ("u1", "u2", "u3"):
        rs = by[key]
        assert sum(1 for r in rs if r.source_measure_anchor_flag) == 1
        total = sum(r.alloc__cost + r.unalloc__cost for r in rs)
        assert total == D("10.000000001")                          # conservation, exact
        assert sum(r.alloc__tokens + r.unalloc__tokens for r in rs) == 100


def test_asof_latest(spark):
    left = spark.createDataFrame([("e1", d(2025, 1, 1)), ("e1", d(2025, 1, 5)), ("e1", d(2025, 1, 10)),
                                  ("e2", d(2025, 1, 5))], "k string, dt date")
    right = spark.createDataFrame([("D1", "e1", d(2025, 1, 5), "a"), ("D2", "e1", d(2025, 1, 5), "b"),
                                   ("D3", "e1", d(2025, 1, 8), "c"), ("D4", "e2", d(2025, 2, 1), "z")],
                                  "id string, k string, ddate date, v string")
    out = {(r.k, r.dt): r.x_v for r in asof_latest(left, right, "k", "dt", "ddate", "id", ["v"], "x_").collect()}
    assert out[("e1", d(2025, 1, 1))] is None        # nothing yet
    assert out[("e1", d(2025, 1, 5))] == "b"         # same day, tie -> highest id
    assert out[("e1", d(2025, 1, 10))] == "c"
    assert out[("e2", d(2025, 1, 5))] is None        # only a future decision


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, v int")
    got = {r.k: r.v for r in latest_per_key(df, ["k"], [F.col("v").desc()]).collect()}
    assert got == {"a": 3, "b": 2}


def test_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("∅", "c"), ("-", "c"), ("", "c"), ("1:a", ""), ("1", ":a")], "x string, y string")
    assert df.select(hash_key("x", "y").alias("k")).distinct().count() == 8


def test_published_sums_are_wide(spark):
    df = spark.createDataFrame([(D("1234567890123"),), (D("98765432109876543210"),)], "x decimal(28,4)")
    assert [r[0] for r in df.select(as_double("x")).collect()] == [1234567890123.0, 98765432109876543210.0]
    fin = df.select(F.lit("usage").alias("line_item_type"), F.col("x").alias("distributed_total_input_tokens"),
                    F.lit(0).cast("decimal(28,4)").alias("distributed_output_tokens"), F.lit(0).cast("decimal(28,4)").alias("distributed_reasoning_tokens"))
    (row,) = reports.measure(fin, {"t": reports.FINANCIAL["distributed_tokens"]}, []).collect()
    assert row.t == 98765433344444433333.0
    big = spark.createDataFrame([(9_000_000_000_000_000, 9_000_000_000_000_000)], "n long, d long")
    assert big.select(pct1_of_ratio("n", "d")).first()[0] == "100.0"


def _wide_dim(spark, n):
    """n windows: keys with four windows each, two of them overlapping on the 10th to the 12th."""
    k = F.col("id") % (n // 4)
    part = (F.col("id") / (n // 4)).cast("int")
    start = F.element_at(F.array(*[F.lit(x).cast("date") for x in ("2025-01-01", "2025-01-10", "2025-02-01", "2025-03-15")]), part + 1)
    end = F.element_at(F.array(*[F.lit(x).cast("date") for x in ("2025-01-12", "2025-01-31", "2025-03-14", "2026-01-31")]), part + 1)
    return spark.range(n).select(k.cast("string").alias("k"), F.concat(F.lit("s"), part.cast("string")).alias("snap"),
                                 start.alias("effective_start"), end.alias("effective_end"))


def test_lookup_has_no_size_limit(spark):
    n = 200_000
    dim = _wide_dim(spark, n)
    assert not fits_broadcast(spark.range(10**9)) and fits_broadcast(spark.range(10))
    days = {d(2025, 1, 5): (1, "s0"), d(2025, 1, 11): (2, "s0"), d(2025, 1, 13): (1, "s1"), d(2025, 2, 28): (1, "s2"),
            d(2025, 12, 31): (1, "s3"), d(2026, 2, 1): (0, None)}
    fact = spark.createDataFrame([(str(k), x) for k in range(0, n // 4, 997) for x in days] + [("none", d(2025, 1, 5))], "k string, dt date")
    got = effective_lookup(fact, dim, {"k": "k"}, "dt", "effective_start", "effective_end", ["snap"], "cnt").collect()
    assert len(got) == fact.count()
    assert all((r.cnt, r.snap) == (days[r.dt] if r.k != "none" else (0, None)) for r in got)


def test_allocation_has_no_size_limit(spark):
    n = 200_000
    dim = _wide_dim(spark, n).select(
        F.lit("p").alias("provider"), F.lit("j").alias("provider_project_id"), F.col("k").alias("api_key_id"),
        F.concat_ws("-", "k", "snap").alias("mapping_id"), F.col("snap").alias("application_name"), F.lit("d").alias("department_name"),
        F.lit("c").alias("cost_center"), F.lit("0.4").cast("decimal(5,4)").alias("allocation_percentage"),
        F.col("effective_start").alias("effective_start_date"), F.col("effective_end").alias("effective_end_date"),
        F.lit("active").alias("mapping_status"), F.lit("mapped").alias("allocation_method"), F.lit("high").alias("allocation_confidence"),
        F.lit("2025-02-01").cast("date").alias("mapping_recorded_date"))
    use = spark.createDataFrame([(str(k), x) for k in range(0, n // 4, 1999) for x in (d(2025, 1, 11), d(2025, 3, 1))] + [("none", d(2025, 1, 5))],
                                "api_key_id string, usage_date date")
    use = use.select(F.lit("p").alias("provider"), F.lit("j").alias("provider_project_id"), "api_key_id", "usage_date", F.lit(10).cast("bigint").alias("q"))
    got = allocate_percent(use, dim, ["q"], []).collect()
    per = {}
    for r in got:
        per.setdefault((r.api_key_id, r.usage_date), []).append(r)
    assert len(per) == use.count()
    for (k, x), rs in per.items():
        assert sum(r.alloc__q + r.unalloc__q for r in rs) == 10 and sum(r.source_measure_anchor_flag for r in rs) == 1
        want = {"none": ["Unallocated"]}.get(k, ["Unallocated", "s0", "s1"] if x.month == 1 else ["Unallocated", "s2"])
        assert sorted(r.application_name for r in rs) == want
        assert all(r.is_historical_restatement == (r.application_name in ("s0", "s1")) for r in rs)


def test_scope_without_driver_and_with_two_snapshots(spark):
    """A usage scope without any driver stays whole; two snapshots of a model split one scope."""
    recon = spark.createDataFrame(
        [(d(2025, 1, 1), "p", "j", m, "model", "usage", D("6"), D("8"), D("10"), "USD", False, True) for m in ("alone", "two")],
        "billing_month date, provider string, provider_project_id string, model string, line_item_scope string, line_item_type string, "
        "usage_cost_estimate decimal(28,9), provider_reported_cost decimal(28,9), invoice_billed_cost decimal(28,9), billing_currency string, "
        "is_restatement boolean, is_synthetic boolean")
    drivers = spark.createDataFrame(
        [(d(2025, 1, 1), "p", "j", "two", s, "text_generation", "app", "dep", "cc", "Allocated", "mapped", "high", False, D("1"), D("1"), D("1"), D("0"), c, "USD", True)
         for s, c in (("v1", D("1")), ("v2", D("3")))],
        "billing_month date, provider string, provider_project_id string, model string, model_snapshot string, usage_type string, application_name string, "
        "department_name string, cost_center string, allocation_status string, allocation_method string, allocation_confidence string, "
        "is_historical_restatement boolean, distributed_request_count decimal(28,4), distributed_total_input_tokens decimal(28,4), "
        "distributed_output_tokens decimal(28,4), distributed_reasoning_tokens decimal(28,4), driver_usage_cost_estimate decimal(28,9), "
        "billing_currency string, is_synthetic boolean")
    got = {(r.model, r.model_snapshot): r for r in application_cost(recon, drivers).collect()}
    alone = got["alone", None]
    assert alone.allocation_method == "no_eligible_driver" and alone.unallocated_invoice_billed_cost == 10 and alone.source_measure_anchor_flag
    assert got["two", "v1"].allocated_invoice_billed_cost == D("2.5") and got["two", "v2"].allocated_invoice_billed_cost == D("7.5")
    assert len(got) == 3 and sum(r.source_measure_anchor_flag for (m, _), r in got.items() if m == "two") == 1


def test_group_counts_match_a_distinct_count(spark):
    from pyspark.sql import functions as F

    from tokenledger.operators.distinct import group_counts
    rows = [(None, "a", "x", 1), (None, "a", "x", 2), ("a", None, "x", 3), ("a", None, "y", 4), ("b", "b", None, 5), (None, None, None, 6),
            (None, None, "z", 7), ("b", "b", "x", 8), ("b", "b", "X", 9)]
    df = spark.createDataFrame(rows, "k string, l string, id string, v int")
    plain = df.groupBy("k", "l").agg(F.sum("v").alias("s"), F.count_distinct("id").alias("n"), F.max("v").alias("m"))
    got = group_counts(df, ["k", "l"], [F.sum("v").alias("s"), F.max("v").alias("m")], "id", "n")
    assert got.columns == plain.columns and got.schema["n"].dataType == plain.schema["n"].dataType
    assert sorted(got.collect(), key=repr) == sorted(plain.collect(), key=repr)
    assert group_counts(df.filter("false"), ["k"], [F.sum("v").alias("s")], "id", "n").count() == 0


def test_request_ids_do_not_cross_a_shuffle(spark):
    """Ids and the buffers of all other aggregates travelled row by row before."""
    import re

    from tokenledger.plans import core
    from tokenledger.plans.pipeline import Pipeline
    plan = core.telemetry_daily(Pipeline(spark, "/root/testdata/sf0.001").telemetry_stg)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and not re.search(r"hashpartitioning\([^)]*logical_request_id", plan)


def test_unique_grain_counts_repeats_and_nulls(spark):
    from tokenledger.quality import controls as C
    from tokenledger.quality.spec import unique_grain

    class P:
        pass
    p = P()
    p.spark, p.t = spark, spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    control = unique_grain("s", "c", "t", ["k"])
    assert C.verdicts(p, [control])[0][1] == 3  # COUNT(*) - COUNT(DISTINCT k): one repeat, two nulls
    assert "xxhash64" in control.scalars["v"].agg and "xxhash64" not in control.sql()
