"""Sources / sinks (S01, S04, S08, S09) and feed validation jobs."""

import datetime as dt
import json

import pytest

from tokenledger.quality.feed_rules import (containment_violations, decision_chain_violations,
                                            window_overlap_violations)
from tokenledger.sources import feeds
from tokenledger.sources.io import (load_reconciliation, normalize_provider_json, read_typed_csv,
                                    schema_from_triples, write_table)

d = dt.date


def test_typed_csv_failfast_and_required(spark, tmp_path):
    schema = schema_from_triples([("usage_date", "DATE", "REQUIRED"), ("provider", "STRING", "REQUIRED"),
                                  ("request_count", "INT64", "NULLABLE"), ("note", "STRING", "NULLABLE")])
    good = tmp_path / "good.csv"
    good.write_text('usage_date,provider,request_count,note\n2025-01-01,openai,3,"two\nlines"\n'
                    "2025-01-02,anthropic,,x\n")
    df = read_typed_csv(spark, str(good), schema)
    rows = df.orderBy("usage_date").collect()
    assert len(rows) == 2 and rows[0].note == "two\nlines" and rows[1].request_count is None
    bad = tmp_path / "bad.csv"
    bad.write_text("usage_date,provider,request_count,note\n2025-01-01,openai,notanumber,x\n")
    with pytest.raises(Exception):
        read_typed_csv(spark, str(bad), schema).collect()
    missing = tmp_path / "missing.csv"
    missing.write_text("usage_date,provider,request_count,note\n2025-01-01,,1,x\n")
    with pytest.raises(ValueError):
        read_typed_csv(spark, str(missing), schema)


def test_partitioned_sink_and_load_reconciliation(spark, tmp_path):
    df = spark.createDataFrame([(d(2025, 1, 3), "a", 1), (d(2025, 2, 1), "b", 2), (d(2025, 2, 9), "a", 3)],
                               "usage_date date, provider string, v int")
    out = str(tmp_path / "t")
    write_table(df, out, partition_month_of="usage_date", cluster_by=["provider"])
    back = spark.read.parquet(out)
    assert back.filter("partition_month = '2025-02'").count() == 2
    src = spark.createDataFrame([("t", 3), ("u", 1)], "table_name string, source_row_count long")
    rec = {r.table_name: r for r in load_reconciliation(src, {"t": back}).collect()}
    assert rec["t"].status == "PASS" and rec["u"].status == "FAIL"


def test_provider_json_normalization(spark, tmp_path):
    o = tmp_path / "openai.json"
    o.write_text(json.dumps([{"id": "r1", "usage": {"input_tokens": 100, "output_tokens": 20,
                                                    "input_tokens_details": {"cached_tokens": 40},
                                                    "output_tokens_details": {"reasoning_tokens": 5}}}]))
    a = tmp_path / "anthropic.json"
    a.write_text(json.dumps([{"id": "m1", "usage": {"input_tokens": 50, "output_tokens": 10,
                                                    "cache_read_input_tokens": 30,
                                                    "cache_creation": {"ephemeral_5m_input_tokens": 7}}}]))
    rows = {r.provider: r for r in normalize_provider_json(spark, str(o), str(a), keep=["id"]).collect()}
    assert rows["openai"].cached_input_tokens == 40 and rows["openai"].reasoning_tokens == 5
    assert rows["openai"].cache_read_input_tokens is None
    assert rows["anthropic"].cache_creation_5m_tokens == 7 and rows["anthropic"].cache_creation_1h_tokens is None
    assert rows["anthropic"].uncached_input_tokens == 50


def test_fixture_dimensions_are_valid(spark):
    mm = feeds.model_map(spark)
    assert window_overlap_violations(mm, ["provider", "usage_type", "provider_model_name"],
                                     "effective_start", "effective_end").count() == 0
    rc = feeds.rate_card(spark)
    keys = ["provider", "usage_type", "model_snapshot", "normalized_processing_tier", "is_batch",
            "context_window_tier"]
    assert window_overlap_violations(rc, keys, "effective_start", "effective_end").count() == 0
    assert decision_chain_violations(feeds.experiment_decision(spark), feeds.experiment_control(spark)).count() == 0
    # every rate window lies inside its snapshot's model-map window
    assert containment_violations(rc, mm, ["model_snapshot"], "effective_start", "effective_end",
                                  "effective_start", "effective_end").count() == 0
    # a model-map window is not inside one rate window when the price changes mid-window
    std = rc.filter("NOT is_batch")
    split = containment_violations(mm, std, ["model_snapshot"], "effective_start", "effective_end",
                                   "effective_start", "effective_end").collect()
    assert [r.model_snapshot for r in split] == ["assist-large-v1"]


def test_feed_rules_catch_bad_rows(spark):
    dim = spark.createDataFrame([("k", d(2025, 1, 1), d(2025, 1, 31)), ("k", d(2025, 1, 31), d(2025, 2, 28)),
                                 ("j", d(2025, 1, 1), d(2025, 1, 10)), ("j", d(2025, 1, 11), d(2025, 1, 20))],
                                "k string, s date, e date")
    bad = window_overlap_violations(dim, ["k"], "s", "e").collect()
    assert [(r.k, r.s) for r in bad] == [("k", d(2025, 1, 31))]     # touching windows overlap
    dec = spark.createDataFrame([("D1", "E", "Continue", d(2025, 1, 1), "running", "running"),
                                 ("D2", "E", "Stop", d(2025, 1, 1), "paused", "stopped")],
                                "experiment_decision_id string, experiment_id string, decision string, "
                                "decision_date date, previous_status string, new_status string")
    ctl = spark.createDataFrame([("E", "running")], "experiment_id string, current_status string")
    kinds = sorted(r.violation for r in decision_chain_violations(dec, ctl).collect())
    assert kinds == ["broken_chain", "chain_not_from_planned"]
