from cdclake.llm.common import hash_sample, maybe_among


def test_maybe_among_never_rules_out_a_present_id(spark):
    ids = spark.range(0, 3000, 3).toDF("id")
    rows = spark.range(6000).toDF("id")
    found = {r.id: r.maybe for r in maybe_among(rows, "id", ids).collect()}
    assert len(found) == 6000
    assert all(found[i] for i in range(0, 3000, 3))
    assert sum(found[i] for i in range(3000, 6000)) < 30
    assert not any(r.maybe for r in maybe_among(rows, "id", ids.limit(0)).collect())


def test_hash_sample_takes_the_smallest_hashes(spark):
    rows = spark.range(20_000).toDF("id")
    few = [(r.h, r.id) for r in hash_sample(rows, "id", 500).collect()]
    assert len(few) == 500 and few == sorted(few)
    more = [(r.h, r.id) for r in hash_sample(rows, "id", 2000).collect()]
    assert more[:500] == few
    assert hash_sample(rows, "id", 50_000).count() == 20_000
    assert hash_sample(rows.limit(0), "id", 10).count() == 0
