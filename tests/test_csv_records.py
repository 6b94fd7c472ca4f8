import random

import pytest
from pyspark.sql import types as T

from cdclake.sources import csv as csvsrc
from cdclake.sources.csv_records import csv_records, from_inside, from_outside


def machine(line, inside):
    """One character after the other."""
    state, i = ("in" if inside else "start"), 0
    while i < len(line):
        c = line[i]
        if state == "in":
            if c == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    state = "after"
        elif c == ",":
            state = "start"
        elif state == "start":
            state = "in" if c == '"' else "plain"
        i += 1
    return state == "in"


def test_effects_of_a_line():
    rng = random.Random(1)
    for _ in range(20_000):
        line = "".join(rng.choice('",a"') for _ in range(rng.randint(0, 14)))
        assert from_outside(line) == machine(line, False), line
        assert from_inside(line) == machine(line, True), line


def field(rng, i):
    kind = rng.random()
    if kind < 0.3:
        return f'"{i} ""quoted"", and{rng.choice(["", chr(10), chr(13) + chr(10)])}{"long " * rng.randrange(30)}{rng.choice(["", chr(10) * 3, chr(10) + "1,2,3"])}"'
    return rng.choice(["", f"x{i}", f'5"disk{i}', '""', "NA", "é ü"])


def write(path, rows, rng, crlf=False):
    end = "\r\n" if crlf else "\n"
    lines = ["id,a,b"]
    for i in range(rows):
        fields = [str(i), field(rng, i), field(rng, i)]
        if rng.random() < 0.05:
            fields = fields[:2] if rng.random() < 0.5 else [*fields, "more"]
        lines.append(",".join(fields))
        if rng.random() < 0.02:
            lines.append("")
    path.write_bytes((end.join(lines) + (end if rng.random() < 0.5 else "")).encode())
    return str(path)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "700b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize(("seed", "crlf"), [(1, False), (2, False), (3, True)])
def test_split_reads_equal_whole_reads(spark, tmp_path, small_splits, seed, crlf):
    path = write(tmp_path / "t.csv", 400, random.Random(seed), crlf)
    split = csvsrc.read_raw_csv(spark, path, "split")
    assert rows(split) == rows(csvsrc.read_raw_csv(spark, path, "whole"))
    assert rows(csvsrc.read_raw_csv(spark, path)) == rows(split)  # larger than a split: read in splits


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = write(tmp_path / "t.csv", 400, random.Random(4))
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 10
    assert csv_records(spark, path).rdd.getNumPartitions() > 10
    assert csvsrc.read_raw_csv(spark, path, "whole").rdd.getNumPartitions() == 1


def test_a_record_longer_than_many_splits(spark, tmp_path, small_splits):
    """The header, a record and the last, unfinished record each span splits; some splits have no quote at all."""
    long = "\n".join(f"line {i}, " + "y" * 60 for i in range(100))
    (tmp_path / "t.csv").write_text(f'"a\n{long}",b\n1,2\n"{long}",3\n4,"{long}"\n5,"{long}')
    found = sorted(r.value for r in csv_records(spark, str(tmp_path / "t.csv")).collect())
    assert found == sorted(["1,2", f'"{long}",3', f'4,"{long}"', f'5,"{long}'])


def test_every_file_of_a_folder_drops_its_header(spark, tmp_path, small_splits):
    rng = random.Random(5)
    (tmp_path / "t.csv").mkdir()
    for i in range(3):
        write(tmp_path / "t.csv" / f"part-{i}.csv", 60, rng)
    (tmp_path / "t.csv" / "part-3.csv").write_text("id,a,b\n")
    path = str(tmp_path / "t.csv")
    assert rows(csvsrc.read_raw_csv(spark, path, "split")) == rows(csvsrc.read_raw_csv(spark, path, "whole"))


def test_loads_and_accounts_alike(spark, tmp_path, small_splits):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    path = write(tmp_path / "t.csv", 300, random.Random(6))
    split, whole = (csvsrc.load_files(spark, [path], schema, lines) for lines in ("split", "whole"))
    assert rows(split) == rows(whole)
    assert rows(csvsrc.load_metrics(split, "t")) == rows(csvsrc.load_metrics(whole, "t"))
    with pytest.raises(ValueError):
        csvsrc.load_files(spark, [path], schema, "other")


def test_empty_files(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_text("id,a,b")
    assert csvsrc.read_raw_csv(spark, str(tmp_path / "t.csv"), "split").count() == 0
