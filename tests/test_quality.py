from pyspark.sql import functions as F

from cdclake.operators import quality as dq


def test_orphans_and_their_rows(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 30), (5, None), (6, 20)], "id long, ref long")
    parent = spark.createDataFrame([(10,), (10,), (None,), (40,)], "k long")  # repeated parents count once
    assert sorted((r.ref, r.n_rows) for r in dq.fk_orphans(child, ["ref"], parent, ["k"]).collect()) == [(20, 2), (30, 2)]
    assert sorted(r.id for r in dq.fk_violations(child, ["ref"], parent, ["k"]).collect()) == [2, 3, 4, 6]
    assert dq.fk_orphans(child, ["ref"], child.select(F.col("ref").alias("k")), ["k"]).count() == 0
    assert dq.fk_orphans(child, ["ref"], parent.where("false"), ["k"]).agg(F.sum("n_rows")).first()[0] == 5


def test_keys_of_two_columns(spark):
    child = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, None, 2), (4, "b", None)], "id long, x string, y int")
    parent = spark.createDataFrame([("a", 1), ("b", 2)], "u string, v int")
    assert [r.id for r in dq.fk_violations(child, ["x", "y"], parent, ["u", "v"]).collect()] == [2]


def test_report_counts_rows_and_counted_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, 20)], "id long, ref long")
    parent = spark.createDataFrame([(10,)], "k long")
    checks = {"keys": dq.fk_orphans(child, ["ref"], parent, ["k"]), "rows": dq.fk_violations(child, ["ref"], parent, ["k"]),
              "none": dq.fk_orphans(child.where("ref = 10"), ["ref"], parent, ["k"])}
    assert {r.check_name: r.n_violations for r in dq.constraint_report(spark, checks).collect()} == {"keys": 2, "rows": 2, "none": 0}


def test_only_distinct_keys_of_the_child_are_shuffled(spark):
    """A key with most rows reaches the shuffle as one row a task."""
    child = spark.range(0, 20_000, 1, 4).select(F.col("id"), F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id") % 100).alias("ref"))
    plan = dq.fk_orphans(child, ["ref"], spark.range(50).withColumnRenamed("id", "k"), ["k"])._jdf.queryExecution().executedPlan().toString()
    child_side = plan[plan.index("partial_count"):]
    assert "Range (0, 20000" in child_side and "Exchange" not in child_side[: child_side.index("Range (0, 20000")]
