"""What the plans must look like to hold at scale."""

import re

import pytest

from packetflow import schemas
from packetflow.operators import admission, outbox
from packetflow.plans.queries import QUERIES

#: Those that write nothing before their result is asked for.
WRITES = (
    "stream_", "cdc_union", "relay_ticks", "relay_workers", "ledger_lookup", "client_lookup", "stats_protocols",
    "stats_clients", "stats_total", "stats_incremental",
)
NO_STREAM = sorted(n for n in QUERIES if not n.startswith(WRITES))


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@pytest.mark.parametrize("name", NO_STREAM)
def test_no_cross_joins_no_python_and_narrow_scans(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "BatchEval" not in text
    assert "props" not in re.findall(r"ReadSchema: (.*)", text)[0]


@pytest.mark.parametrize(
    "name", ["ledger", "client_state_store", "client_state_merge", "fixed_window_admission",
             "outbox_worker_claims"],
)
def test_groups_are_cut_down_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    partial = [i for i, line in enumerate(text.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    assert partial
    shuffles = [i for i, line in enumerate(text.splitlines()) if "Exchange hashpartitioning" in line]
    assert any(s < p for s in shuffles for p in partial)


@pytest.mark.usefixtures("shared_models")
@pytest.mark.parametrize("name", ["outbox_reserve", "stats_clients"])
def test_limits_are_top_n(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize(
    "name", ["parse_change_events", "skipped_events", "packet_stats_by_proto", "client_state_store"]
)
def test_documents_are_parsed_once(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    # One parse of the document; the other is the rare second look at text with a bracket.
    assert text.count("from_json") == 2


def test_statistics_read_no_payload(spark, sf_dir):
    text = plan(QUERIES["packet_stats_by_proto"](spark, sf_dir))
    assert "payload" not in text


@pytest.mark.parametrize("limit", [3, 5000])
def test_large_limits_are_cut_down_too(spark, sf_dir, limit):
    calls = spark.createDataFrame([], "call_id bigint, ts_ms bigint, subject string, user_name string, remote_ip string")
    assert "WindowGroupLimit" in plan(admission.fixed_window_admission(calls, permits=limit))
    rows = spark.createDataFrame([], schemas.OUTBOX)
    assert "WindowGroupLimit" in plan(outbox.worker_claims(rows, 0, workers=4, limit=limit))


@pytest.mark.usefixtures("shared_models")
@pytest.mark.parametrize("name", ["ledger_lookup", "client_lookup"])
def test_lookups_push_the_key_to_the_scan_of_the_stored_table(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    key = "transaction_id" if name == "ledger_lookup" else "client_id"
    assert re.search(rf"PushedFilters: \[[^\]]*EqualTo\({key}", text)
