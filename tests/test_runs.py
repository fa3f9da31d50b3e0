
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tokenledger.plans.pipeline import Pipeline
from tokenledger.quality import controls as C
from tokenledger.runs import deploy as D
from tokenledger.runs.store import AppendLog, LayerStore, folders, latest, months_side_by_side

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2026, 7, 1)


def days(n):
    return lambda: DAY + dt.timedelta(days=n)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_append_log_keeps_runs_and_replaces_a_repeated_one(spark, tmp_path):
    log = AppendLog(spark, f"{tmp_path}/log", "pipeline_run_id string, stage string, n long, at timestamp_ntz", "stage")
    assert log.read().count() == 0
    log.append([("r1", "a", 1, DAY), ("r1", "b", 2, None)])
    log.append([("2026-01-01", "a", 3, DAY)])  # a run id that looks like a date stays text
    once = rows(log.read())
    log.append([("r1", "a", 1, DAY), ("r1", "b", 2, None)])
    assert rows(log.read()) == once and len(once) == 3
    log.append([("r1", "a", 9, DAY)])
    assert rows(log.read().filter("pipeline_run_id = 'r1'")) == [("r1", "a", 9, DAY), ("r1", "b", 2, None)]
    log.append([])
    with pytest.raises(ValueError):
        log.append([("", "a", 1, DAY)])


def test_latest_orders_by_time_then_run(spark):
    df = spark.createDataFrame([("k", "r1", 1, "x"), ("k", "r2", 1, "y"), ("k", "r3", 0, "z"), ("l", "r1", 5, None)], "k string, run string, t int, v string")
    assert rows(latest(df, ["k"], ["t", "run"])) == [("k", "r2", 1, "y"), ("l", "r1", 5, None)]


def test_layers_swap_by_month(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    df = spark.range(90).select("id", F.expr("date_add(date'2025-01-01', cast(id as int))").alias("day"), F.col("id") % 3 == 0)
    df = df.toDF("id", "day", "flag")
    with pytest.raises(LookupError):
        store.read("t")
    first = store.stage("t", df, "v1", "day", ("flag", "id"))
    assert first.rows == 90 and first.months == ["2025-01", "2025-02", "2025-03"]
    with pytest.raises(LookupError):
        store.read("t")  # written, not published
    store.publish([first], "v1", DAY)
    assert rows(store.read("t")) == rows(df)
    before = folders(spark, f"{tmp_path}/t/*/*/*.parquet")
    again = store.stage("t", df.filter("month(day) = 2").withColumn("id", F.col("id") + 1000), "v2", "day", ("flag", "id"))
    store.publish([again], "v2", DAY + dt.timedelta(1), only_months=["2025-02"])
    assert set(before) < set(folders(spark, f"{tmp_path}/t/*/*/*.parquet"))  # no file of another month was touched
    want = rows(df.withColumn("id", F.when(F.month("day") == 2, F.col("id") + 1000).otherwise(F.col("id"))))
    assert rows(LayerStore(spark, str(tmp_path)).read("t")) == want  # as another session sees it
    # a full refresh without March ends March; old folders go only when asked to
    store.publish([store.stage("t", df.filter("month(day) < 3"), "v3", "day")], "v3", DAY + dt.timedelta(2))
    assert rows(store.read("t")) == rows(df.filter("month(day) < 3"))
    assert store.vacuum("t") == 4 and rows(store.read("t")) == rows(df.filter("month(day) < 3"))
    store.publish([store.stage("t", df.limit(0), "v4", "day")], "v4", DAY + dt.timedelta(3))
    assert store.read("t").columns == df.columns and store.read("t").count() == 0


def test_month_filters_prune_folders_and_sorted_files(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    df = spark.range(1000).select("id", F.expr("date_add(date'2025-01-01', cast(id % 365 as int))").alias("day"))
    store.publish([store.stage("t", df, "v1", "day", ("id",))], "v1", DAY)
    plan = store.read("t", with_month=True).filter("partition_month = '2025-06'").select("id")._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines()[::-1] if "PartitionFilters" in line)
    assert "partition_month" in scan.split("PartitionFilters:")[1].split("]")[0]
    part = spark.read.parquet(folders(spark, f"{tmp_path}/t/partition_month=2025-06/*")[0])
    ids = [r.id for r in part.collect()]
    assert ids == sorted(ids) and len(ids) == 90


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """A good run of three stages, a broken second input, and what the logs say."""
    base = str(tmp_path_factory.mktemp("warehouse"))
    good = D.Deployment(Pipeline(spark, SF), base, days(0))
    good.run("run-a", [C.M6, C.M7, C.M8])
    published = rows(good.store.read("raw_cost"))
    p = Pipeline(spark, SF)
    p.__dict__["raw_cost"] = p.raw_cost.withColumn(
        "billing_currency", F.when(F.col("line_item_type") == "tax", "EUR").otherwise(F.col("billing_currency")))
    bad = D.Deployment(p, base, days(1))
    with pytest.raises(D.ControlsFailed) as error:
        bad.run("run-b", [C.M6, C.M7])
    return base, good, bad, published, error.value


def test_failed_stage_raises_after_its_results_are_logged(spark, runs):
    base, good, bad, published, error = runs
    assert error.failed == ["all_cost_records_are_usd"]
    logs = D.Logs(spark, base)
    assert logs.controls.read().filter("pipeline_run_id = 'run-b'").count() == 10
    run = {(r.pipeline_run_id, r.pipeline_name): r for r in logs.runs.read().collect()}
    assert set(run) == {("run-a", C.M6), ("run-a", C.M7), ("run-a", C.M8), ("run-b", C.M6)}  # M7 of run-b never started
    assert run["run-b", C.M6].status == "FAIL" and "all_cost_records_are_usd" in run["run-b", C.M6].error_message
    assert run["run-a", C.M6].loaded_table_count == 3 and run["run-a", C.M6].error_message is None
    # the old layer is what everybody reads
    assert rows(LayerStore(spark, base).read("raw_cost")) == published


def test_status_marts_pick_the_latest_run(spark, runs):
    _, good, *_ = runs
    good.p.__dict__.pop("pipeline_status", None)
    got = {r.pipeline_name: r for r in good.p.pipeline_status.collect()}
    assert (got[C.M6].status, got[C.M6].pipeline_run_id, got[C.M6].attention_flag, got[C.M6].pass_flag) == ("FAIL", "run-b", 1, 0)
    assert (got[C.M7].status, got[C.M7].attention_flag) == ("PASS", 0)
    assert (got[C.M9].status, got[C.M9].pipeline_run_id, got[C.M9].attention_flag) == ("MISSING", None, 1)
    assert len(got) == 10
    controls = {r.control_id: r for r in good.p.control_status.collect()}
    assert len(controls) == 176
    usd = controls["all_cost_records_are_usd"]
    assert (usd.status, usd.pipeline_run_id, usd.fail_flag, usd.checked_at) == ("FAIL", "run-b", 1, DAY + dt.timedelta(1))
    assert controls["all_usage_rows_are_priced"].pipeline_run_id == "run-a"
    assert (controls["E2E-18"].status, controls["E2E-18"].severity, controls["E2E-18"].control_domain) == ("MISSING", "CRITICAL", "Pipeline health")
    (e2e,) = C.evaluate(good.p, [c for c in C.catalogue() if c.control_id == "E2E-18"]).collect()
    assert e2e.violation_count == 8  # one failed, seven never ran


def test_repeated_run_adds_nothing(spark, runs):
    base, good, *_ = runs
    logs = D.Logs(spark, base)
    before = [rows(x.read()) for x in (logs.runs, logs.controls, logs.loads)]
    good.run("run-a", [C.M8], rewrite=False)
    after = [rows(x.read()) for x in (logs.runs, logs.controls, logs.loads)]
    assert [len(x) for x in before] == [len(x) for x in after] and before[1:] == after[1:]


def test_load_reconciliation(spark, runs, tmp_path):
    base, good, *_ = runs
    got = {r.table_name: r for r in good.p.load_reconciliation.collect()}
    assert set(got) == {"raw_usage", "raw_telemetry", "raw_cost", "usage_priced", "provider_cost_stg", "telemetry_stg", "cost_reconciliation"}
    assert all(r.status == "PASS" and r.row_count_difference == 0 and r.loaded_row_count > 0 for r in got.values())
    assert got["raw_telemetry"].loaded_row_count == good.p.raw_telemetry.count()
    p = Pipeline(spark, SF)
    p.__dict__["raw_telemetry"] = p.raw_telemetry.filter("attempt_number = 1")
    d = D.Deployment(p, str(tmp_path), days(0))
    with pytest.raises(D.ControlsFailed) as error:
        d.run("short", [C.M6])
    assert error.value.failed == ["raw_telemetry"]
    (bad,) = p.load_reconciliation.filter("status = 'FAIL'").collect()
    assert bad.table_name == "raw_telemetry" and bad.row_count_difference < 0


def test_refresh_of_one_month(spark, runs):
    base, good, *_ = runs
    before = good.store.current("usage_priced")
    changed = good.p.usage_priced.withColumn("usage_cost_estimate", (F.col("usage_cost_estimate") * 2).cast(good.p.usage_priced.schema["usage_cost_estimate"].dataType))
    good.clock = days(3)
    good.refresh_month("fix", "usage_priced", changed, "2025-03")
    after = good.store.current("usage_priced")
    assert {m for m in after if after[m] != before.get(m)} == {"2025-03"} and set(after) == set(before)
    with pytest.raises(ValueError):
        good.refresh_month("fix", "dim_date", good.p.usage_priced, "2025-03")


def test_every_layer_belongs_to_a_stage():
    assert sorted(n for s in D.STAGES.values() for n in s) == sorted(D.LAYERS)
    with pytest.raises(ValueError):
        D.Deployment(Pipeline(None, SF), "x", on_fail="ignore")


def test_shared_models_are_derived_once(spark):
    import __spark_entry__ as E
    from tokenledger.plans import pipeline as P
    plans = {}
    for name in ("application_cost", "experiment_governance"):
        df = E.queries()[name](spark, SF)
        plans[name] = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "lineitem.parquet" not in plans[name] and plans[name].count("FileScan") == 1
    shared = P.pipeline(spark, SF, sharing=True)
    assert shared is P.pipeline(spark, SF + "/", sharing=True) and shared.shared_base
    assert shared.cost_reconciliation is shared.cost_reconciliation
    assert P.input_version(spark, SF) != P.input_version(spark, SF.replace("0.001", "0.01"))


def test_ordered_layers_are_written_without_a_shuffle(spark, tmp_path):
    """Attempt-level layers: each task writes its rows in their order, a file a month."""
    assert {n for n, x in D.LAYERS.items() if x.ordered} == {"raw_telemetry", "telemetry_stg"}
    store = LayerStore(spark, str(tmp_path))
    df = spark.range(0, 80, 1, 4).select("id", F.expr("date_add(date'2025-01-01', cast(id % 40 as int))").alias("day"))
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with months_side_by_side(spark):
        staged = store.stage("t", df, "v1", "day", ("id",), ordered=True)
    assert spark.conf.get(name) == before
    assert staged.rows == 80 and staged.months == ["2025-01", "2025-02"] and rows(staged.df) == rows(df)
    files = folders(spark, f"{tmp_path}/t/*/*/*.parquet")
    assert len(files) == 6  # 4 tasks; days 0-19 lie in one month, 20-39 in two
    for f in files:
        ids = [r.id for r in spark.read.parquet(f).collect()]
        assert ids == sorted(ids)


def test_telemetry_comes_clustered_from_a_deployment(spark, runs):
    _, good, *_ = runs
    plain = Pipeline(spark, SF)
    assert good.p.lines_clustered and not plain.lines_clustered
    assert rows(good.p.raw_telemetry) == rows(plain.raw_telemetry.select(good.p.raw_telemetry.columns))
    files = folders(spark, f"{good.base}/telemetry_stg/*/*/*.parquet")
    keys = [tuple(r) for r in spark.read.parquet(files[0]).select("provider", "model", "provider_project_id", "application_name").collect()]
    assert len(keys) > 10 and keys == sorted(keys)
