import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cdclake.operators.features import fill_defaults, zscore


def test_null_card_group_and_guards(spark):
    df = spark.createDataFrame(
        [(1, None, 10.0), (2, None, 30.0), (3, 7, 5.0), (4, 8, 2.0), (5, 8, 2.0)], "id int, card1 long, amt double"
    )
    out = zscore(fill_defaults(df, {"card1": -1}), "card1", "amt")
    z = {r.id: (r.card1, r.z_score) for r in out.collect()}
    assert z[1][0] == -1 and z[2][0] == -1  # both null cards share group -1
    assert abs(z[1][1] + 0.7071067811865475) < 1e-12
    assert z[3][1] == 0.0  # single row: sd null
    assert z[4][1] == 0.0 and z[5][1] == 0.0  # constant group: sd 0


def test_zscore_equals_window_form(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, 1, 2, 3, 3, 3]), float(rnd.randint(0, 10_000)) / 100) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, card1 long, amt double")
    w = Window.partitionBy("card1")
    ref = df.withColumn("m", F.avg("amt").over(w)).withColumn("s", F.stddev("amt").over(w)).withColumn(
        "z", F.when(F.col("s").isNull() | (F.col("s") == 0), 0.0).otherwise((F.col("amt") - F.col("m")) / F.col("s"))
    )
    want = {r.id: r.z for r in ref.collect()}
    got = {r.id: r.z_score for r in zscore(df, "card1", "amt").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
