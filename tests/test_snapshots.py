import threading

import pytest
from pyspark.sql import functions as F

from cdclake.session import scratch_path
from cdclake.sinks.snapshots import SnapshotTable

S = "k long, v string"


def _table(spark, **options):
    return SnapshotTable(spark, scratch_path(spark, "snap"), use_delta=False, **options)


def _rows(t):
    return sorted(((r.k, r.v) for r in t.read().collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def _files(t):
    """Data files by bucket folder."""
    out = {}
    for f in t.read().inputFiles():
        folder, name = f.rsplit("/", 2)[1:]
        out.setdefault(folder, set()).add(name)
    return out


def test_upsert_semantics_and_rerun(spark):
    t = _table(spark)
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], S), ["k"])
    src = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], S)
    t.upsert(src, ["k"])
    assert _rows(t) == [(None, "m"), (None, "n"), (1, "a"), (2, "B"), (3, "c")]
    t.upsert(src, ["k"])  # a re-run replaces matched keys again; the null key is added again (MERGE never matches null)
    got = _rows(t)
    assert [x for x in got if x[0] is not None] == [(1, "a"), (2, "B"), (3, "c")]
    assert len([x for x in got if x[0] is None]) == 3


def test_one_changed_key_rewrites_one_bucket(spark):
    t = _table(spark, buckets=8)
    t.upsert(spark.range(200).selectExpr("id AS k", "'old' AS v"), ["k"])
    before = _files(t)
    assert len(before) == 9  # and the folder that keeps the columns
    assert t.upsert(spark.createDataFrame([(77, "new")], S), ["k"]) == 1
    after = _files(t)
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1 and not before[changed[0]] & after[changed[0]]
    assert _rows(t) == sorted([(i, "old") for i in range(200) if i != 77] + [(77, "new")])
    assert t.upsert(spark.createDataFrame([], S), ["k"]) == 0 and _files(t) == after


def test_an_upsert_reads_only_its_buckets(spark):
    """Files of other buckets may even be gone."""
    t = _table(spark, buckets=8)
    t.upsert(spark.range(200).selectExpr("id AS k", "'old' AS v"), ["k"])
    one = spark.createDataFrame([(77, "new")], S)
    column = t._layout()[0]
    bucket = t._bucketed(one, column, 8, ["k"]).select(F.col(f"`{column}`")).first()[0]
    jvm, (fs, _) = spark._jvm, t._fs()
    for folder, names in _files(t).items():
        if folder not in (f"{column}={bucket}", f"{column}=-1"):
            for name in names:
                fs.create(jvm.org.apache.hadoop.fs.Path(f"{t.path}/{folder}/{name}"), True).close()  # no parquet any more
    kept = spark.read.schema(f"{S}").parquet(f"{t.path}/{column}={bucket}").count()
    assert t.upsert(one, ["k"]) == 1
    assert spark.read.schema(S).parquet(f"{t.path}/{column}={bucket}").where("v = 'new'").count() == 1
    assert spark.read.schema(S).parquet(f"{t.path}/{column}={bucket}").count() == kept


def test_two_writers_lose_nothing(spark):
    t = _table(spark, buckets=2)
    t.upsert(spark.range(10).selectExpr("id AS k", "'old' AS v"), ["k"])

    def write(start):
        SnapshotTable(spark, t.path, use_delta=False).upsert(spark.range(start, start + 30, 2).selectExpr("id AS k", f"'w{start}' AS v"), ["k"])

    writers = [threading.Thread(target=write, args=(start,)) for start in (0, 1)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert _rows(t) == [(i, f"w{i % 2}") for i in range(30)]


def test_a_failed_change_leaves_the_table(spark):
    t = _table(spark, buckets=4)
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b")], S), ["k"])
    bad = spark.createDataFrame([(1, "x")], S).withColumn("v", F.expr("IF(k = 1, raise_error('broken'), v)").cast("string"))
    for change in (lambda: t.upsert(bad, ["k"]), lambda: t.overwrite(bad), lambda: t.overwrite(bad, ["k"])):
        with pytest.raises(Exception, match="broken"):
            change()
        assert _rows(t) == [(1, "a"), (2, "b")]


def test_insert_if_absent_and_append(spark):
    for keys in ((), ("k",)):
        t = _table(spark)
        t.overwrite(spark.createDataFrame([(1, "a")], S), keys)
        t.insert_if_absent(spark.createDataFrame([(1, "x"), (2, "y"), (2, "b")], S), ["k"])
        assert _rows(t) == [(1, "a"), (2, "b")]  # existing key untouched, one new row per key
        t.append(spark.createDataFrame([(1, "a")], S))
        assert t.read().where(F.col("k") == 1).count() == 2
    new = _table(spark)
    new.insert_if_absent(spark.createDataFrame([(2, "y"), (2, "b")], S), ["k"])
    assert _rows(new) == [(2, "b")]


def _changes(spark, *events):
    from pyspark.sql import types as T

    from cdclake.operators.cdc import latest_changes

    row = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    log = spark.createDataFrame([(e, 0, i) for i, e in enumerate(events)], "json_payload string, partition int, offset long")
    return latest_changes(log, row, ["k"])


def test_apply_changes_deletes_rows(spark):
    from tests.conftest import envelope

    t = _table(spark)
    t.apply_changes(_changes(spark, envelope(None, {"k": 1, "v": "a"}, "c", 1), envelope(None, {"k": 2, "v": "b"}, "c", 1)), ["k"])
    t.apply_changes(_changes(spark, envelope(None, None, "d", 5, before={"k": 1}), envelope(None, {"k": 3, "v": "c"}, "c", 5)), ["k"])
    assert _rows(t) == [(2, "b"), (3, "c")]
    # the last rows of their buckets go, the columns stay
    t.apply_changes(_changes(spark, *[envelope(None, None, "d", 9, before={"k": k}) for k in (2, 3, 4)]), ["k"])
    assert _rows(t) == [] and t.read().columns == ["k", "v"]
    t.upsert(spark.createDataFrame([(3, "again")], S), ["k"])
    assert _rows(t) == [(3, "again")]


def test_append_adds_files_and_reads_nothing(spark):
    t = _table(spark)
    t.overwrite(spark.createDataFrame([(1, "a")], S))
    old = set(t.read().inputFiles())
    t.append(spark.createDataFrame([(2, "b")], S))
    t.append(spark.createDataFrame([(3,)], "k long"))
    assert _rows(t) == [(1, "a"), (2, "b"), (3, None)]
    assert old < set(t.read().inputFiles())
    t.upsert(spark.createDataFrame([(3, "c")], S), ["k"])  # gets its buckets now
    assert _rows(t) == [(1, "a"), (2, "b"), (3, "c")]
    t.append(spark.createDataFrame([(4, "d")], S))
    assert t.upsert(spark.createDataFrame([(4, "D")], S), ["k"]) == 1
    assert _rows(t) == [(1, "a"), (2, "b"), (3, "c"), (4, "D")]


def test_new_columns_and_number_types(spark):
    t = _table(spark, buckets=4)
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b")], S), ["k"])
    t.upsert(spark.createDataFrame([(2, "B", 7)], "k int, v string, more int"), ["k"])  # the same key in a narrower type
    assert sorted((r.k, r.v, r.more) for r in t.read().collect()) == [(1, "a", None), (2, "B", 7)]


def test_empty_tables(spark):
    t = _table(spark)
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    t.upsert(spark.createDataFrame([], S), ["k"])
    assert t.exists() and t.read().columns == ["k", "v"] and t.read().count() == 0
    t.upsert(spark.createDataFrame([(1, "a")], S), ["k"])
    assert _rows(t) == [(1, "a")]
    t.overwrite(t.read().where("k > 1"))  # from its own rows
    assert t.exists() and t.read().count() == 0


def test_upsert_evaluates_its_source_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    t = _table(spark)
    t.upsert(spark.createDataFrame([(1, "a")], S), ["k"])
    source = spark.createDataFrame([(1, "b"), (2, "c")], S).mapInArrow(count, S)
    t.upsert(source, ["k"])
    assert calls.value == 2 and _rows(t) == [(1, "b"), (2, "c")]


def test_rows_are_finished_after_they_are_dealt(spark):
    """Narrow rows go through the shuffle and the sort; the wide ones are made and written without another."""
    def finish(rows, carry=()):
        return rows.select("k", "v", *[(F.col("k") + i).alias(f"w{i}") for i in range(3)], *carry)

    t, plain = _table(spark, buckets=4), _table(spark, buckets=4)
    rows = spark.createDataFrame([(i, str(i)) for i in range(40)] + [(None, "n")], S)
    t.upsert(rows, ["k"], finish)
    plain.upsert(finish(rows), ["k"])
    assert t.read().schema == plain.read().schema
    assert sorted(map(repr, t.read().collect())) == sorted(map(repr, plain.read().collect()))
    assert set(_files(t)) == set(_files(plain))
    t.upsert(spark.createDataFrame([(1, "new"), (99, "z")], S), ["k"], finish)  # a table that is there
    got = {r.k: (r.v, r.w2) for r in t.read().collect()}
    assert got[1] == ("new", 3) and got[99] == ("z", 101) and got[2] == ("2", 4) and len(got) == 42
    whole = _table(spark)
    whole.overwrite(rows, (), finish)
    assert whole.read().columns == ["k", "v", "w0", "w1", "w2"]
