import random

import pytest
from pyspark.sql import types as T

from cdclake.operators.cdc import latest_state
from cdclake.session import scratch_path
from cdclake.sinks.snapshots import SnapshotTable
from cdclake.streaming.silver import (
    BATCH_COL,
    batch_changes,
    bronze_table_stream,
    current_rows,
    stream_latest,
    stream_upserts,
    upsert_batch,
)
from tests.conftest import SF_SMALL, envelope

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
BRONZE = "json_payload string, partition int, offset long, source_table string"
TOPIC = "dbserver1.public.t"


def log(n=240, keys=25, seed=2):
    """Changes with equal times, deletes, tombstones, rows without a key, and changes that are out of order."""
    rng, out = random.Random(seed), []
    for i in range(n):
        key, ts = rng.randrange(keys), rng.randrange(40)
        kind = rng.random()
        if kind < 0.15:
            text = envelope(None, None, "d", ts, before={"k": key})
        elif kind < 0.2:
            text = None if kind < 0.18 else envelope(None, {"k": None, "v": "no key"}, "u", ts)
        else:
            text = envelope(None, {"k": key, "v": f"{key}-{i}"}, "u", ts)
        out.append((text, rng.randrange(3), i, TOPIC))
    return out


def state(df):
    return sorted((r.k, r.v) for r in df.select("k", "v").collect() if r.k is not None)


def data_files(table):
    return sorted(table.read().inputFiles())


def stream(spark, parts):
    """A stream of one batch for each part, the other topic's rows beside."""
    root = scratch_path(spark, "stream")
    for part in parts:
        spark.createDataFrame(part + [("x", 0, 0, "dbserver1.public.other")], BRONZE).coalesce(1).write.partitionBy("source_table").mode("append").parquet(f"{root}/bronze")
    return root, bronze_table_stream(spark, f"{root}/bronze", "t", max_per_trigger=1)


@pytest.mark.parametrize("deletes", ["ignore", "apply"])
def test_batches_in_any_order_give_the_latest_state(spark, deletes):
    rows = log()
    parts = [rows[0::3], rows[2::3], rows[1::3]]
    root, source = stream(spark, parts)
    table = SnapshotTable(spark, f"{root}/silver", use_delta=False, buckets=4)
    seen = []
    stream_upserts(source, table, ROW, ["k"], f"{root}/checkpoint", deletes, after_batch=lambda changes, i: seen.append((changes, i)))
    wanted = state(latest_state(spark.createDataFrame(rows, BRONZE), ROW, ["k"], deletes=deletes))
    assert state(current_rows(table)) == wanted and len(seen) >= 3
    # every batch once more, under its id and under a new one: no row and no file changes
    files = data_files(table)
    for changes, i in seen:
        assert upsert_batch(table, changes, i, ["k"]) == 0 and upsert_batch(table, changes, i + 100, ["k"]) == 0
    assert data_files(table) == files
    # a restart finds nothing new
    stream_upserts(source, table, ROW, ["k"], f"{root}/checkpoint", deletes)
    assert data_files(table) == files and {r[0] for r in table.read().select(BATCH_COL).distinct().collect()} <= {i for _, i in seen}


def test_a_late_change_does_not_undo_a_delete(spark):
    table = SnapshotTable(spark, scratch_path(spark, "silver"), use_delta=False)

    def batch(i, *texts):
        frame = spark.createDataFrame([(t, 0, 10 * i + j, TOPIC) for j, t in enumerate(texts)], BRONZE)
        upsert_batch(table, batch_changes(frame, ROW, ["k"], "apply"), i, ["k"])

    batch(0, envelope(None, {"k": 1, "v": "a"}, "c", 1), envelope(None, {"k": 2, "v": "b"}, "c", 1))
    batch(1, envelope(None, None, "d", 9, before={"k": 1}))
    batch(2, envelope(None, {"k": 1, "v": "late"}, "u", 5), envelope(None, {"k": 2, "v": "B"}, "u", 5))
    assert state(current_rows(table)) == [(2, "B")]
    batch(3, envelope(None, {"k": 1, "v": "back"}, "c", 12))
    assert state(current_rows(table)) == [(1, "back"), (2, "B")]


def test_state_store_equals_the_latest_state_after_every_batch(spark):
    rows = log(seed=5)
    parts = [rows[0::3], rows[2::3], rows[1::3]]
    root, source = stream(spark, parts)
    table = SnapshotTable(spark, f"{root}/silver", use_delta=False, buckets=4)
    after = []
    stream_latest(source, table, ROW, ["k"], f"{root}/checkpoint", after_batch=lambda _: after.append(state(table.read())))
    arrived, batches = [], []
    for part in parts:
        arrived += part
        batches.append(state(latest_state(spark.createDataFrame(arrived, BRONZE), ROW, ["k"], deletes="apply")))
    # the stream reads the oldest file first; other topics' files make batches without changes
    assert [a for i, a in enumerate(after) if a != (after[i - 1] if i else [])] == batches
    assert after[-1] == batches[-1]


def test_the_state_needs_no_window(spark):
    from cdclake.streaming.silver import latest_stream

    plan = latest_stream(spark.createDataFrame(log(20), BRONZE), ROW, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_the_activity_stream_has_files_for_all_tasks(spark):
    """Four batches, each of several files where the session has more than four shuffle partitions."""
    from cdclake.plans.catalog import _activity_batches

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        root = scratch_path(spark, "files")
        _activity_batches(spark, SF_SMALL, root)
        assert len(spark.read.parquet(f"{root}/bronze").inputFiles()) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
