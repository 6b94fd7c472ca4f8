"""Plan shape checks: pruning, pushdown, partial aggregation, partial group limits."""

from cdclake.operators.cdc import latest_records
from cdclake.operators.features import zscore
from cdclake.plans import roles
from cdclake.session import scratch_path
from cdclake.sources.bronze import read_bronze_table
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_read_prunes_partitions(spark):
    root = scratch_path(spark, "bronze")
    roles.bronze_rows(roles.activity_records(spark, SF_SMALL)).write.partitionBy("source_table").parquet(root)
    plan = _plan(read_bronze_table(spark, root, "user_activity").select("offset"))
    assert "PartitionFilters: [isnotnull(source_table" in plan
    assert "ReadSchema: struct<offset:bigint>" in plan


def test_latest_has_partial_group_limit_before_shuffle(spark):
    b = roles.bronze_rows(roles.activity_records(spark, SF_SMALL))
    plan = _plan(latest_records(b, roles.ACTIVITY_SCHEMA, ["user_id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_zscore_aggregates_partially(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = _plan(zscore(df, "o_custkey", "o_totalprice"))
    assert "partial_avg" in plan and "partial_stddev_samp" in plan
    assert "Window" not in plan  # no per-group window: a hot group is reduced map-side


def test_scan_prunes_columns_and_pushes_filters(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = _plan(o.where("o_orderstatus = 'F'").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_seed_lookup_is_broadcast_by_size(spark):
    from cdclake.plans.catalog import q_seed_lookup

    plan = _plan(q_seed_lookup(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning(ProductCD" not in plan  # the fact is never shuffled by product code


def test_hot_card_is_split_by_skew_join(spark):
    """Card -1 holds about a third of the fact; without a broadcast the join-back is split."""
    from cdclake.plans.catalog import q_zscore

    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        df = q_zscore(spark, "/root/testdata/sf0.1")  # enough rows for the size thresholds
        df.collect()
        assert "SortMergeJoin(skew=true)" in _plan(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_gold_never_shuffles_the_fact_by_small_lookups(spark):
    from cdclake.plans.catalog import gold_frame

    g = gold_frame(spark, SF_SMALL)
    g.collect()
    plan = _plan(g)
    # the product and location lookups are broadcast joins: the fact is never
    # shuffled by product code (5 keys) or by address
    assert "BroadcastHashJoin [ProductCD" in plan
    assert "SortMergeJoin [ProductCD" not in plan
    assert "SortMergeJoin [knownfloatingpointnormalized(normalizenanandzero(addr1" not in plan


def test_latest_transactions_need_no_statistics(spark):
    from cdclake.plans.catalog import q_dq_not_null, q_fill_nulls, q_preview_limit

    for query in (q_fill_nulls, q_preview_limit, q_dq_not_null):
        plan = _plan(query(spark, SF_SMALL))
        assert "stddev_samp" not in plan and "Join" not in plan.split("WindowGroupLimit")[0], query.__name__


def test_hot_card_of_gold_is_split_or_broadcast(spark):
    """Card -1 holds a third of the fact. With broadcasts on, the profile is broadcast from its
    known size; where it is too large for that, the skew join splits the card."""
    from cdclake.plans.catalog import gold_frame

    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    # a limit between the lookups' sizes and the card profile's
    limited = {"spark.sql.autoBroadcastJoinThreshold": "16k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "16k"}
    for confs, expected in ((small, "BroadcastHashJoin [card1"), (small | limited, "SortMergeJoin(skew=true) [card1")):
        old = {k: spark.conf.get(k, None) for k in confs}
        try:
            for k, v in confs.items():
                spark.conf.set(k, v)
            df = gold_frame(spark, "/root/testdata/sf0.1")
            df.collect()
            assert expected in _plan(df), expected
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_silver_fact_selects_and_parses_once(spark):
    from cdclake.plans.catalog import silver_txn

    plan = _plan(silver_txn(spark, SF_SMALL))
    assert "Window" not in plan  # ran once, before the statistics
    assert "partial_avg" in plan
    # the statistics read two columns of the staged winners and parse nothing; the payloads are read by the other side
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert {"json_payload" in s for s in scans} == {True, False}
    assert all("TransactionAmt" in s and "card1" in s for s in scans if "json_payload" not in s)
    statistics = plan[plan.index("partial_avg"):]
    assert "from_json" not in statistics[: statistics.index("FileScan")]


def test_wide_rows_are_parsed_after_the_scores_are_joined(spark):
    """What the score join moves is text; of the declared fields only those that the texts have are parsed."""
    from cdclake.plans.catalog import txn_bronze
    from cdclake.plans.jobs import parsed_fact, scored_transactions, silver_fact
    from cdclake.schemas import TABLES

    bronze = txn_bronze(spark, SF_SMALL)
    scored, present = scored_transactions(bronze)
    assert scored.columns == ["json_payload", "partition", "offset", "TransactionID", "avg_amt", "std_amt", "z_score"]
    assert 10 < len(present) < 20 and "V339" not in present
    plan = _plan(parsed_fact(scored, present))
    assert plan.index("from_json(") < plan.index("Join")
    fact = silver_fact(bronze)
    assert fact.columns == [*TABLES["transaction"].schema.fieldNames(), "avg_amt", "std_amt", "z_score"]
    some = silver_fact(bronze, columns=("TransactionID", "card1"))
    assert some.columns == ["TransactionID", "card1", "avg_amt", "std_amt", "z_score"]
    assert "V339" not in _plan(some)
    assert sorted(map(repr, some.collect())) == sorted(map(repr, fact.select(some.columns).collect()))


def test_change_texts_are_stored_before_they_are_read_often(spark):
    from cdclake.plans.catalog import q_wide_schema

    plan = q_wide_schema(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "StructsToJson" not in plan and "V339 AS" not in plan.split("from_json(", 1)[1].split(" AS ", 1)[0]


def test_gold_parses_what_it_reads(spark):
    from cdclake.plans.catalog import gold_frame

    assert "V339" not in _plan(gold_frame(spark, SF_SMALL))
