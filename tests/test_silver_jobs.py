"""Silver jobs with deletes, decoded decimals and streams; the same through the command line."""

import pytest

from cdclake import __main__ as cli
from cdclake.functions.decimal import decode_decimal
from cdclake.operators.cdc import latest_state
from cdclake.plans import roles
from cdclake.plans.jobs import Layout, build_silver_dimensions, gold_from_silver, stream_silver
from cdclake.schemas import TABLES, TOPIC_PREFIX
from cdclake.session import scratch_path
from cdclake.sinks.snapshots import SnapshotTable
from cdclake.streaming.silver import current_rows
from tests.conftest import SF_SMALL, envelope

SPECS = {"user_activity": roles.ACTIVITY}


def activity_lake(spark):
    layout = Layout(scratch_path(spark, "lake"))
    bronze = roles.bronze_rows(roles.activity_records(spark, SF_SMALL))
    bronze.repartition(3).write.partitionBy("source_table").parquet(layout.bronze)
    return layout, bronze


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select("user_id", "event_type", "value", "props").collect())


@pytest.mark.parametrize("deletes", ["ignore", "apply"])
def test_batch_and_stream_jobs_agree(spark, deletes):
    layout, bronze = activity_lake(spark)
    wanted = rows(latest_state(bronze, roles.ACTIVITY_SCHEMA, ["user_id"], deletes=deletes))
    assert build_silver_dimensions(spark, layout, ("user_activity",), SPECS, deletes=deletes) == {"user_activity": "ok"}
    assert rows(SnapshotTable(spark, layout.silver("user_activity"), use_delta=False).read()) == wanted
    if deletes == "ignore":  # the schema from the records, all from one parse
        one_parse = Layout(layout.root + "-variant")
        bronze.write.partitionBy("source_table").parquet(one_parse.bronze)
        assert build_silver_dimensions(spark, one_parse, ("user_activity",), SPECS, schema="variant") == {"user_activity": "ok"}
        assert rows(SnapshotTable(spark, one_parse.silver("user_activity"), use_delta=False).read()) == wanted
    streamed = Layout(scratch_path(spark, "lake"))
    bronze.repartition(3).write.partitionBy("source_table").parquet(streamed.bronze)
    stream_silver(spark, streamed, ("user_activity",), SPECS, deletes, max_per_trigger=1)
    table = SnapshotTable(spark, streamed.silver("user_activity"), use_delta=False)
    assert rows(current_rows(table)) == wanted
    # what lands later is taken up by the next run
    more = [(envelope(None, {"user_id": -5, "event_type": "signup", "value": 1.0, "props": "{}"}, "c", 1), 0, 1, f"{TOPIC_PREFIX}user_activity")]
    spark.createDataFrame(more, "json_payload string, partition int, offset long, source_table string").write.mode("append").partitionBy("source_table").parquet(streamed.bronze)
    stream_silver(spark, streamed, ("user_activity",), SPECS, deletes)
    assert len(rows(current_rows(table))) == len(wanted) + 1


def test_gold_leaves_deleted_rows_of_a_stream_out(spark):
    layout = Layout(scratch_path(spark, "lake"))
    topic = f"{TOPIC_PREFIX}location"
    row = {"LocationID": 1, "addr1": 5.0, "addr2": None, "Region": "R", "Country": "C"}
    events = [(envelope(None, row, "c", 1), 0, 1, topic), (envelope(None, {**row, "LocationID": 2, "Region": "Q"}, "c", 1), 0, 2, topic),
              (envelope(None, None, "d", 2, before={"LocationID": 2}), 0, 3, topic)]
    spark.createDataFrame(events, "json_payload string, partition int, offset long, source_table string").write.partitionBy("source_table").parquet(layout.bronze)
    stream_silver(spark, layout, ("location",), deletes="apply")
    fact = [(1, 10, 12.5, 0, 0.5, "W", 7, 5.0, 1.0)]
    SnapshotTable(spark, layout.silver("transaction"), use_delta=False).overwrite(spark.createDataFrame(
        fact, "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, z_score double, ProductCD string, card1 long, addr1 double, addr2 double"))
    gold = gold_from_silver(spark, layout, allow_missing=True).collect()
    assert [(r.Region, r.Country) for r in gold] == [("R", "C")]


def test_command_line_options_reach_the_jobs(spark, monkeypatch):
    """Deletes, decimals to decode, tables of a stream, and how CSV lines are read."""
    layout = Layout(scratch_path(spark, "lake"))
    topic = f"{TOPIC_PREFIX}user_accounts"
    base = {"account_number": "1", "client_no": "c", "current_balance": "MDk="}
    events = [(envelope(None, base, "c", 1), 0, 1, topic), (envelope(None, {**base, "account_number": "2"}, "c", 1), 0, 2, topic),
              (envelope(None, None, "d", 2, before={"account_number": "2"}), 0, 3, topic)]
    bronze = spark.createDataFrame(events, "json_payload string, partition int, offset long, source_table string")
    bronze.write.partitionBy("source_table").parquet(layout.bronze)
    monkeypatch.setattr(cli, "build_session", lambda **_: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)
    monkeypatch.setattr(cli, "drop_scratch", lambda _: None)
    cli.main(["silver-dims", "--root", layout.root, "--deletes", "apply", "--decode-decimals", "user_accounts.current_balance"])
    found = SnapshotTable(spark, layout.silver("user_accounts"), use_delta=False).read().collect()
    wanted = bronze.limit(1).select(decode_decimal(__import__("pyspark").sql.functions.lit("MDk="), scale=2, signed=True)).first()[0]
    assert [(r.account_number, r.current_balance) for r in found] == [("1", wanted)]
    calls = {}
    monkeypatch.setattr(cli, "stream_silver", lambda *a, **k: calls.update(tables=a[2], **k))
    cli.main(["silver-stream", "--root", layout.root, "--tables", "location", "--deletes", "apply", "--max-per-trigger", "2"])
    assert calls == {"tables": ["location"], "deletes": "apply", "max_per_trigger": 2}
    monkeypatch.setattr(cli, "load_source_table", lambda *a: calls.update(lines=a[-1]) or spark.range(1))
    cli.main(["load-source", "--root", layout.root, "--table", "location", "--files", "x.csv", "--csv-lines", "split"])
    assert calls["lines"] == "split" and "user_accounts" in TABLES
