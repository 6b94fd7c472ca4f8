from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.operators.cdc import (
    OP_COL,
    infer_json_schema,
    latest_changes,
    latest_records,
    latest_state,
    parse_envelopes,
    present_fields,
)
from tests.conftest import envelope

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
SCHEMA = "json_payload string, partition int, offset long"


def _bronze(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_delete_keeps_last_live_version(spark):
    b = _bronze(spark, [
        (envelope(None, {"id": 1, "v": "a"}, "c", 1), 0, 1),
        (envelope(None, {"id": 1, "v": "b"}, "u", 2), 0, 2),
        (envelope(None, None, "d", 3, before={"id": 1}), 0, 3),
    ])
    got = latest_state(b, ROW, ["id"]).collect()
    assert [(r.id, r.v) for r in got] == [(1, "b")]
    assert latest_state(b, ROW, ["id"], deletes="apply").count() == 0


def test_tombstone_and_bad_json_dropped(spark):
    b = _bronze(spark, [
        (envelope(None, {"id": 1, "v": "a"}, "c", 1), 0, 1),
        (None, 0, 2),
        ("{bad", 0, 3),
    ])
    assert parse_envelopes(b, ROW).count() == 1
    assert latest_state(b, ROW, ["id"]).count() == 1


def test_ties_broken_by_position(spark):
    b = _bronze(spark, [
        (envelope(None, {"id": 1, "v": "old"}, "u", 5), 0, 7),
        (envelope(None, {"id": 1, "v": "new"}, "u", 5), 0, 9),
    ])
    assert latest_state(b, ROW, ["id"]).first().v == "new"


def test_null_key_keeps_one_row(spark):
    b = _bronze(spark, [
        (envelope(None, {"id": None, "v": "a"}, "c", 1), 0, 1),
        (envelope(None, {"id": None, "v": "b"}, "c", 2), 0, 2),
    ])
    got = latest_state(b, ROW, ["id"]).collect()
    assert len(got) == 1 and got[0].v == "b"


def test_infer_schema_merges_documents(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": 2, "extra": "x"}',)], "j string")
    schema = infer_json_schema(df, "j")
    assert sorted(schema.fieldNames()) == ["extra", "k"]


WIDE = T.StructType([*ROW.fields, *[T.StructField(f"w{i}", T.DoubleType()) for i in range(5)]])


def test_fields_that_no_text_names_are_null_columns(spark):
    b = _bronze(spark, [
        (envelope(None, {"id": 1, "v": "a", "w3": 1.5, "other": 1}, "c", 1), 0, 1),
        (envelope(None, {"id": 2, "w1": None}, "c", 2), 0, 2),
        (envelope(None, None, "d", 3, before={"id": 1}), 0, 3),
        (None, 0, 4),
    ])
    present = present_fields(b, WIDE)
    assert present == ["id", "v", "w1", "w3"]
    some, whole = parse_envelopes(b, WIDE, present=present), parse_envelopes(b, WIDE)
    assert some.schema.simpleString() == whole.schema.simpleString()
    assert some.collect() == whole.collect()
    assert "w4" not in some._jdf.queryExecution().optimizedPlan().toString().split("from_json(", 1)[1].split(" AS ", 1)[0]
    # what a parser makes of a broken text depends on the schema
    broken = b.union(_bronze(spark, [('{"payload":{"after":{"id":3,"w4":2.5,"v":', 0, 5)]))
    assert present_fields(broken, WIDE) == WIDE.fieldNames()
    assert present_fields(b.where("false"), WIDE) == []
    assert parse_envelopes(b.where("false"), WIDE, present=[]).collect() == []


def test_parsing_carries_columns(spark):
    b = _bronze(spark, [(envelope(None, {"id": 1, "v": "a"}, "c", 1), 0, 1)]).withColumn("score", F.lit(0.5))
    got = parse_envelopes(b, ROW, carry=("score",))
    assert got.columns[-1] == "score" and got.first().score == 0.5


def test_latest_reads_the_text_once(spark):
    """No filter on the text below the selection, and still the winners of the changes that take part."""
    made = spark.range(20).select(F.to_json(F.struct(F.struct(
        F.struct(F.col("id")).alias("after"), F.when(F.col("id") % 2 == 0, "c").otherwise("d").alias("op")).alias("payload"))).alias("json_payload"))
    plan = latest_records(made, ROW, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 1
    b = _bronze(spark, [
        (envelope(None, {"id": 1, "v": "a"}, "c", 1), 0, 1),
        ('{"payload":{"after":{"id":1,"v":"z"},"op":"u","source":{"ts_ms":9', 0, 2),  # cut off
        ('{"payload":{"after":{"id":1,"v":"y"},"op":null,"source":{"ts_ms":9}}}', 0, 3),
        (envelope(None, None, "d", 8, before={"id": 1}), 0, 4),
        (envelope(None, None, "d", 1, before={"id": 2}), 0, 5),
    ])
    assert [(r.id, r.v) for r in latest_state(b, ROW, ["id"]).collect()] == [(1, "a")]
    assert latest_state(b, ROW, ["id"], deletes="apply").collect() == []
    assert sorted((r.id, r[OP_COL]) for r in latest_changes(b, ROW, ["id"]).collect()) == [(1, "d"), (2, "d")]
