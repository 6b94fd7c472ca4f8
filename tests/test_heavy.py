"""Left joins of skewed facts: heavy keys named by a sketch, joined without a shuffle."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cdclake.operators.heavy import broadcast_limit, heavy_keys, left_join_heavy, stored_bytes
from cdclake.session import staged


@pytest.fixture(scope="module")
def fact(spark):
    """-1 in a third of the rows, 7 in a tenth, nulls in a tenth, the rest spread thinly."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 10 = 1 THEN 7 WHEN id % 10 = 2 THEN NULL ELSE 100 + id % 4001 END")
    return staged(spark.range(30_000).select("id", key.cast("long").alias("card")), "fact")


def test_heavy_keys_are_found_by_their_share(fact):
    exact = Counter(r.card for r in fact.collect())
    for share in (0.01, 0.05, 0.2):
        named = heavy_keys(fact, "card", share)
        assert named == [k for k, n in exact.most_common() if k is not None and n >= share * 30_000]
    assert heavy_keys(fact, "card", 0.5) == []
    assert heavy_keys(fact.where("false"), "card") == heavy_keys(fact.where("card IS NULL"), "card") == []
    with pytest.raises(ValueError):
        heavy_keys(fact, "card", 0)


def test_strings_and_keys_with_odd_names(spark):
    rows = spark.createDataFrame([("a",)] * 9 + [("b",)], "`the key` string")
    assert heavy_keys(rows, "the key", 0.5) == ["a"]


@pytest.mark.parametrize("heavy", [[], [-1], [-1, 7], [-1, 7, 100, 999_999]])
def test_same_rows_as_a_plain_join(spark, fact, heavy):
    side = spark.range(50, 3000).select(F.col("id").alias("s"), F.concat(F.lit("p"), "id").alias("p")).union(
        spark.createDataFrame([(-1, None), (None, "no card")], "s long, p string"))
    plain = fact.join(side, fact["card"] == side["s"], "left")
    split = left_join_heavy(fact, side, "card", "s", heavy)
    assert split.columns == plain.columns
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))


def test_rows_of_heavy_cards_are_not_shuffled(spark, fact):
    side = staged(spark.range(50, 3000).selectExpr("id AS s", "concat('p', id) AS p"), "side")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        assert broadcast_limit(side) == 0
        df = left_join_heavy(fact, side, "card", "s", heavy_keys(fact, "card"))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot, rest = plan.index("BroadcastHashJoin [card"), plan.index("SortMergeJoin [card")
    first, second = sorted((hot, rest))
    parts = {hot: plan[first:second], rest: plan[second:]} if hot < rest else {rest: plan[first:second], hot: plan[second:]}
    assert "hashpartitioning" not in parts[hot] and "hashpartitioning(card" in parts[rest]
    # the filters reach the scans
    pushed = [line for line in parts[rest].splitlines() if "FileScan" in line and "card" in line]
    assert "Not(In(card, [-1,7]))" in pushed[0].replace(", 7", ",7")


def test_sizes(spark, fact):
    assert 1000 < stored_bytes(fact) < 10_000_000
    assert stored_bytes(staged(fact.where("false"), "none")) >= 0
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
        assert broadcast_limit(fact) == 16384
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_gold_joins_the_hot_card_by_broadcast(spark):
    """A card profile above the broadcast limit: card -1 takes the broadcast, no skew is left for the shuffle."""
    from cdclake.plans.catalog import gold_frame

    confs = {"spark.sql.autoBroadcastJoinThreshold": "16k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "16k"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        plan = gold_frame(spark, "/root/testdata/sf0.01", heavy_share=0.01)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "BroadcastHashJoin [card1" in plan and "SortMergeJoin [card1" in plan
    assert "NOT (card1" in plan
