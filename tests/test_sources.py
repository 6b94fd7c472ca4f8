from pyspark.sql import types as T

from cdclake.session import scratch_path
from cdclake.sources import csv as csvsrc

SCHEMA = T.StructType([T.StructField("id_01", T.IntegerType()), T.StructField("isFraud", T.IntegerType()),
                       T.StructField("amt", T.DoubleType())])


def test_load_files_order_alignment_and_accounting(spark):
    root = scratch_path(spark, "csv")
    spark.createDataFrame([("1", "0", "1.5"), ("2", "1", "x")], "`id-01 ` string, isFraud string, amt string") \
        .coalesce(1).write.option("header", True).csv(f"{root}/train_transaction.csv")
    spark.createDataFrame([("3", "2.5")], "`id-01` string, amt string").coalesce(1) \
        .write.option("header", True).csv(f"{root}/test_transaction.csv")
    files = [f"{root}/test_transaction.csv", f"{root}/nope.csv", f"{root}/train_transaction.csv"]
    loaded = csvsrc.load_files(spark, files, SCHEMA)
    rows = sorted((r.id_01, r.isFraud, r.amt, r.source_rank) for r in csvsrc.accepted_rows(loaded).collect())
    assert rows == [(1, 0, 1.5, 0), (3, None, 2.5, 1)]  # train first; test rows get a null label
    m = csvsrc.load_metrics(loaded, "transaction").first()
    assert (m.rows_accepted, m.rows_failed) == (2, 1)  # the 'x' amount fails that row only


def test_load_source_table_appends_and_quarantines(spark):
    from cdclake.plans.jobs import load_source_table
    from cdclake.sinks.snapshots import SnapshotTable

    root = scratch_path(spark, "load")
    spark.createDataFrame([("1", "0", "1.5"), ("2", "1", "x")], "`id-01` string, isFraud string, amt string") \
        .write.option("header", True).csv(f"{root}/train_transaction.csv")
    target = SnapshotTable(spark, f"{root}/table", use_delta=False)
    m = load_source_table(spark, "transaction", [f"{root}/train_transaction.csv"], SCHEMA, target,
                          quarantine_path=f"{root}/q").first()
    assert (m.rows_accepted, m.rows_failed) == (1, 1)
    assert [r.id_01 for r in target.read().collect()] == [1]
    assert [r.id_01 for r in spark.read.parquet(f"{root}/q").collect()] == [2]


def _write(path, text):
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_ragged_and_quoted_rows(spark, tmp_path):
    path = str(tmp_path / "train_transaction.csv")
    _write(path, 'id-01,isFraud,amt\n1,0,1.5\n2,0\n3,0,2.5,9\n4,"0","3.5"\n5,NA,nan\n6,x,1\n')
    loaded = {r.id_01: r for r in csvsrc.load_files(spark, [path], SCHEMA).collect()}
    assert {k: r._load_failed for k, r in loaded.items()} == {1: False, 2: True, 3: True, 4: False, 5: False, 6: True}
    assert loaded[3]._raw_record == "3,0,2.5,9" and loaded[1]._raw_record is None
    assert (loaded[5].isFraud, loaded[5].amt) == (None, None)
    text = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    path = str(tmp_path / "quoted.csv")
    _write(path, 'a,b\n"one ""x""\ntwo, three",4\n5,6\n')
    rows = csvsrc.accepted_rows(csvsrc.load_files(spark, [path], text)).collect()
    assert sorted((r.a, r.b) for r in rows) == [("5", "6"), ('one "x"\ntwo, three', "4")]


def test_no_file_loads_nothing(spark):
    from cdclake.plans.jobs import load_source_table
    from cdclake.sinks.snapshots import SnapshotTable

    root = scratch_path(spark, "load")
    target = SnapshotTable(spark, f"{root}/table", use_delta=False)
    m = load_source_table(spark, "transaction", [f"{root}/nope.csv"], SCHEMA, target).first()
    assert (m.rows_accepted, m.rows_failed) == (0, 0) and not target.exists()


def test_loaded_table_has_the_declared_columns(spark, tmp_path):
    from cdclake.plans.jobs import load_source_table
    from cdclake.sinks.snapshots import SnapshotTable

    path = str(tmp_path / "t.csv")
    _write(path, "id_01,isFraud,amt\n1,0,1.5\n")
    target = SnapshotTable(spark, str(tmp_path / "table"), use_delta=False)
    load_source_table(spark, "t", [path], SCHEMA, target)
    assert target.read().columns == SCHEMA.names
