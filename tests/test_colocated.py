"""Bucketed copies: joined without an exchange, opened again from their folders, replaced by a rewrite."""

import glob
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cdclake.plans.jobs import Layout, build_gold_job, colocate_silver, colocated_name
from cdclake.sinks.colocated import open_colocated, write_colocated
from tests.test_gold import _lake


@pytest.fixture
def no_broadcast(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark):
    fact = spark.range(1000).selectExpr("id AS k", "id * 2 AS v").union(spark.createDataFrame([(None, 5), (None, 6), (7, 7)], "k long, v long"))
    side = spark.range(0, 2000, 3).selectExpr("id AS k2", "concat('s', id) AS `odd name`")
    return fact, side


def test_join_without_exchange_and_open_again(spark, no_broadcast, tmp_path):
    root = f"{tmp_path}/colocated"
    fact, side = _tables(spark)
    a = write_colocated(fact, "co_fact", f"{root}/fact", ["k"], 6)
    b = write_colocated(side, "co_side", f"{root}/side", ["k2"], 6)
    expected = Counter(map(tuple, fact.join(side, F.col("k") == F.col("k2"), "left").collect()))
    for _ in range(2):
        joined = a.join(b, F.col("k") == F.col("k2"), "left")
        assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
        assert Counter(map(tuple, joined.collect())) == expected
        # a task wrote one file a bucket
        assert 0 < len(glob.glob(f"{root}/fact/buckets6-k/*.parquet")) <= 6
        for name in ("co_fact", "co_side"):  # as in an application that has not made them
            spark.sql(f"DROP TABLE {name}")
        a, b = open_colocated(spark, "co_fact", f"{root}/fact"), open_colocated(spark, "co_side", f"{root}/side")


def test_rewrite_with_other_buckets(spark, no_broadcast, tmp_path):
    root = f"{tmp_path}/colocated"
    fact, _ = _tables(spark)
    write_colocated(fact, "co_again", root, ["k"], 3)
    again = write_colocated(fact.where("k < 10"), "co_again", root, ["k"], 5)
    assert again.count() == 11 and [p.rsplit("/", 1)[1] for p in glob.glob(f"{root}/b*")] == ["buckets5-k"]
    spark.sql("DROP TABLE co_again")
    assert open_colocated(spark, "co_again", root).count() == 11
    empty = write_colocated(fact.where("false"), "co_none", f"{root}-none", ["k"], 2)
    assert empty.count() == 0 and empty.columns == ["k", "v"]
    spark.sql("DROP TABLE co_none")
    empty = open_colocated(spark, "co_none", f"{root}-none")
    assert empty.count() == 0 and empty.columns == ["k", "v"]
    with pytest.raises(FileNotFoundError):
        open_colocated(spark, "co_absent", f"{root}/nothing")


def test_gold_joins_identity_without_a_shuffle(spark, no_broadcast):
    layout = _lake(spark)
    plain = build_gold_job(spark, layout).collect()
    colocate_silver(spark, layout, buckets=4)
    from cdclake.plans.jobs import gold_from_silver

    plan = _plan(gold_from_silver(spark, layout, colocated=True))
    assert not re.search(r"hashpartitioning\((TransactionID|_dev_txn)", plan)
    assert colocated_name(layout, "identity") != colocated_name(Layout("/elsewhere"), "identity")
    for table in ("transaction", "identity"):
        spark.sql(f"DROP TABLE {colocated_name(layout, table)}")
    assert build_gold_job(spark, layout, colocated=True).collect() == plain
