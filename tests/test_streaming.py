from pyspark.sql import functions as F

from cdclake.plans import roles
from cdclake.session import scratch_path
from cdclake.streaming.bronze import change_stream, land_bronze, to_bronze
from tests.conftest import SF_SMALL


def test_restart_adds_no_duplicates(spark):
    root = scratch_path(spark, "stream")
    recs = roles.activity_records(spark, SF_SMALL)
    recs.repartition(4).write.parquet(f"{root}/in")
    expected = recs.count()
    for _ in range(2):
        land_bronze(to_bronze(change_stream(spark, files_dir=f"{root}/in", max_per_trigger=1)), f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == expected
    audit = out.agg(F.count_distinct("job_start_time").alias("j"), F.count_if(F.col("status") != "SUCCESS").alias("bad")).first()
    assert audit.j == 1 and audit.bad == 0
    assert out.select("source_table").distinct().first()[0] == "dbserver1.public.user_activity"


def test_topic_pattern_filters_other_topics(spark):
    root = scratch_path(spark, "stream")
    df = spark.createDataFrame([(b"k", b"v", "other.topic", 0, 1), (b"k", b"v", "dbserver1.public.x", 0, 2)],
                               "key binary, value binary, topic string, partition int, offset long")
    df.write.parquet(f"{root}/in")
    land_bronze(to_bronze(change_stream(spark, files_dir=f"{root}/in")), f"{root}/out", f"{root}/ckpt")
    assert [r.source_table for r in spark.read.parquet(f"{root}/out").collect()] == ["dbserver1.public.x"]


def test_failing_dimension_does_not_stop_the_others(spark):
    from cdclake.plans.jobs import Layout, build_silver_dimensions
    from cdclake.schemas import TableSpec, struct

    layout = Layout(scratch_path(spark, "lake"))
    roles.bronze_rows(roles.activity_records(spark, SF_SMALL)).write.partitionBy("source_table").parquet(layout.bronze)
    broken = TableSpec("user_activity_broken", ("no_such_key",), struct([("user_id", "long")]))
    specs = {"user_activity": roles.ACTIVITY, "missing_table": roles.ACTIVITY, "user_activity_broken": broken}
    status = build_silver_dimensions(spark, layout, tables=("missing_table", "user_activity", "user_activity_broken"), specs=specs)
    assert status["user_activity"] == "ok"
    assert status["missing_table"] == "empty"


def test_job_start_is_the_same_instant_in_any_zone(spark, monkeypatch):
    import datetime as dt
    import os
    import time

    monkeypatch.setitem(os.environ, "TZ", "America/New_York")
    time.tzset()
    try:
        raw = spark.createDataFrame([(b"k", b"v", "t", 0, 1)], "key binary, value binary, topic string, partition int, offset long")
        row = to_bronze(raw).select(F.unix_micros("job_start_time").alias("s"), F.unix_micros("ingestion_time").alias("i")).first()
        assert abs(row.s - row.i) < 60_000_000
        at = dt.datetime(2026, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)
        assert to_bronze(raw, at).select(F.unix_micros("job_start_time")).first()[0] == round(at.timestamp() * 1e6)
    finally:
        monkeypatch.undo()
        time.tzset()
