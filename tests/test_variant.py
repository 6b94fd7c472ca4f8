import random

import pytest
from pyspark.sql import types as T

from cdclake.operators.cdc import infer_json_schema, latest_state
from cdclake.operators.variant import latest_envelopes, latest_rows, parse_once, row_schema, rows_of
from cdclake.session import scratch_path
from cdclake.sinks.snapshots import SnapshotTable
from tests.conftest import envelope

BRONZE = "json_payload string, partition int, offset long"
ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("amt", T.DoubleType())])


def log(n=200, seed=4):
    rng, out = random.Random(seed), []
    for i in range(n):
        key, ts = rng.randrange(20), rng.randrange(30)
        kind = rng.random()
        text = (envelope(None, None, "d", ts, before={"k": key}) if kind < 0.15 else None if kind < 0.18 else "no json" if kind < 0.2
                else envelope(None, {"k": key, "v": None if kind < 0.3 else f"é{i}", "amt": i / 4}, "u", ts))
        out.append((text, rng.randrange(3), i))
    return out


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("deletes", ["ignore", "apply"])
def test_equals_the_latest_state_of_the_text(spark, deletes):
    bronze = spark.createDataFrame(log(), BRONZE)
    assert rows(latest_rows(bronze, ["k"], deletes, ROW)) == rows(latest_state(bronze, ROW, ["k"], deletes=deletes))
    assert rows(latest_rows(bronze, ["k"], deletes).select("k", "v", "amt")) == rows(latest_state(bronze, ROW, ["k"], deletes=deletes))
    with pytest.raises(ValueError):
        latest_rows(bronze, ["k"], "other", ROW)


def test_schema_is_that_of_all_rows(spark):
    texts = [envelope(None, {"k": 1, "a b": "x"}, "c", 1), envelope(None, {"k": 2, "n": 1.5}, "c", 1), envelope(None, {"k": 3, "n": 2}, "c", 1), "{", None]
    bronze = spark.createDataFrame([(t, 0, i) for i, t in enumerate(texts)], BRONZE)
    schema = row_schema(parse_once(bronze))
    assert {f.name: f.dataType.simpleString() for f in schema} == {"k": "bigint", "a b": "string", "n": "double"}
    inferred = infer_json_schema(bronze, "json_payload")["payload"].dataType["after"].dataType
    assert {f.name: f.dataType for f in schema} == {f.name: f.dataType for f in inferred}
    assert rows(latest_rows(bronze, ["k"]).select("k", "a b", "n")) == sorted(map(repr, [(1, "x", None), (2, None, 1.5), (3, None, 2.0)]))


def test_a_new_column_reaches_the_table(spark):
    table = SnapshotTable(spark, scratch_path(spark, "variant"), use_delta=False)
    for arrival in ([{"k": 1, "v": "a"}, {"k": 2, "v": "b"}], [{"k": 2, "v": "B", "more": {"x": 1}}, {"k": 3, "v": "c"}]):
        bronze = spark.createDataFrame([(envelope(None, r, "c", 1), 0, i) for i, r in enumerate(arrival)], BRONZE)
        table.upsert(latest_rows(bronze, ["k"]), ["k"])
    found = {r.k: (r.v, r.more) for r in table.read().collect()}
    assert found == {1: ("a", None), 2: ("B", (1,)), 3: ("c", None)}


def test_the_text_is_parsed_once(spark):
    """Header and row come from one parse: it is below the window, and nothing above it parses."""
    bronze = spark.createDataFrame(log(30), BRONZE)
    path = scratch_path(spark, "bronze")
    bronze.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = rows_of(latest_envelopes(parse_once(stored), [ROW["k"]]), ROW)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "from_json" not in plan and "get_json_object" not in plan, plan
