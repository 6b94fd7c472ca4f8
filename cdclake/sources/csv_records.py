"""Records of large CSV files, read by many tasks although a quoted field may span lines.

A file is read as lines, split like any text file. Whether a line begins
inside a quoted field depends on all quotes before it, so a split alone cannot
tell where its records begin. It can tell what it does to either case: read
from outside a quote it ends in one state, read from inside in another. A
prefix over the splits of a file (one small row each) composes these and fixes
the state in which every split begins; then each split is cut into records. A
record over a split's border comes in pieces, which are joined.

Splits that begin outside a quote and whose lines are all whole records stay
in the JVM; only the others are cut by :func:`_cut`, batch by batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdclake.session import staged

# the quoted part of a field after its first quote; quotes inside are doubled
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
# a whole field: quoted, with whatever follows up to the comma, or unquoted (quotes inside it mean nothing)
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+'
_ENDS_INSIDE = re.compile(rf'(?:{_FIELD},)*+"{_INSIDE}')
_STAYS_INSIDE = re.compile(_INSIDE)

#: Kinds of a piece of text: a whole record, the rest of a record begun in an earlier split, a record that
#: ends in a later split, and the same for the header record of a file.
RECORD, REST, BEGIN, BEGIN_HEADER = range(4)


def from_outside(line: str, start: int = 0) -> bool:
    """Whether a line read from outside a quote ends inside one."""
    return '"' in line and _ENDS_INSIDE.fullmatch(line, start) is not None


def from_inside(line: str) -> bool:
    """Whether a line read from inside a quote ends inside one."""
    inside = _STAYS_INSIDE.match(line).end()
    if inside == len(line):
        return True
    comma = line.find(",", inside + 1)
    return comma >= 0 and from_outside(line, comma + 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in the order of their splits, which are named by file and start."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").cast("bigint").alias("start"), "value"
    )


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: where it ends from outside and from inside a quote, whether all lines end outside from outside,
    and whether its first line ends in a carriage return."""
    found: dict[tuple[int, int], list] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        quoted = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            key = (int(file[first]), int(start[first]))
            state = found.get(key) or found.setdefault(key, [False, True, True, batch.column(3)[first].as_py()])
            for at in np.flatnonzero(quoted[first:last]).tolist():
                line = batch.column(2)[first + at].as_py()
                outside, inside = from_outside(line), None
                state[2] = state[2] and not outside
                for i in (0, 1):
                    if not state[i]:
                        state[i] = outside
                    else:
                        inside = from_inside(line) if inside is None else inside
                        state[i] = inside
    if found:
        keys, states = list(found), list(found.values())
        yield pa.RecordBatch.from_pydict({
            "file": [k[0] for k in keys], "start": [k[1] for k in keys],
            "outside": [s[0] for s in states], "inside": [s[1] for s in states], "plain": [s[2] for s in states],
            "returns": [s[3] for s in states],
        })


def split_states(lines: DataFrame) -> DataFrame:
    """``file, start, open, returns, goes_on, plain``: whether each split begins and ends inside a quote.

    ``returns``: the file's first line ends in a carriage return, so all its line breaks have one.

    A prefix over the splits of a file: a split either ends in one state whatever it began in, or keeps the state,
    or turns it. The state after the last one of the first kind, turned as
    often as splits since then turn it, is where the next split begins.
    """
    # lines without a quote change nothing: their text stays in the JVM
    quotes = lines.select(
        "file", "start", F.when(F.col("value").contains('"'), F.col("value")).alias("value"), F.col("value").endswith("\r").alias("returns")
    )
    effects = quotes.mapInArrow(_effects, "file bigint, start bigint, outside boolean, inside boolean, plain boolean, returns boolean")
    order = Window.partitionBy("file").orderBy("start")
    before, before_or_at = (order.rowsBetween(Window.unboundedPreceding, end) for end in (-1, 0))
    turns = F.sum((F.col("outside") & ~F.col("inside")).cast("int")).over(before_or_at)
    fixed = F.when(F.col("outside") == F.col("inside"), (F.col("outside").cast("int") + F.col("turns")) % 2)
    began = F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(0)) + F.coalesce(F.last("turns").over(before), F.lit(0))
    # one row a split
    return staged(effects, "csv-splits").withColumn("turns", turns).withColumn("fixed", fixed).select(
        "file", "start", (began % 2 == 1).alias("open"), "plain", "outside", "inside", F.first("returns").over(before_or_at).alias("returns")
    ).select("file", "start", "open", "returns", F.when(F.col("open"), F.col("inside")).otherwise(F.col("outside")).alias("goes_on"), "plain")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of the splits that come, line by line in order."""
    at, parts, inside, kind = None, [], False, RECORD
    out: tuple[list, ...] = ([], [], [], [], [])

    def give(what: int) -> None:
        if at is not None and parts:
            for column, value in zip(out, (*at, what, "\n".join(parts)), strict=True):
                column.append(value)

    def taken() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.string())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(column, t) for column, t in zip(out, kinds, strict=True)], ["file", "start", "returns", "kind", "value"]
        )
        for column in out:
            column.clear()
        return batch

    def unfinished() -> int:
        # a rest that does not end here goes on in the next split as a rest
        return {RECORD: BEGIN, BEGIN_HEADER: BEGIN_HEADER}.get(kind, REST)

    for batch in batches:
        for file, start, returns, opened, line in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if (file, start, returns) != at:
                give(unfinished())
                at, parts, inside = (file, start, returns), [], opened
                # the first record of a file is its header
                kind = REST if opened else BEGIN_HEADER if start == 0 else RECORD
            parts.append(line)
            inside = from_inside(line) if inside else from_outside(line)
            if not inside:
                if kind != BEGIN_HEADER:
                    give(kind)
                parts, kind = [], RECORD
        if out[0]:
            yield taken()
    give(unfinished())
    if out[0]:
        yield taken()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``value, returns``: the text of every record of the files at ``path``, without the header record of each file.

    ``returns`` says that the file's line breaks are carriage return and
    newline; the one that ends the record is taken off. Empty lines between
    records are no records. No row is collected; the splits' states (one row
    a split) are the only broadcast.
    """
    lines = _lines(spark, path)
    states = staged(split_states(lines), "csv-states")
    stated = lines.join(F.broadcast(states), ["file", "start"])
    # the first split of a file has its header to drop
    whole = F.col("plain") & ~F.col("open") & (F.col("start") > 0)

    def cut(some) -> DataFrame:
        rows = stated.where(some).select("file", "start", "returns", "open", "value")
        return rows.mapInArrow(_cut, "file bigint, start bigint, returns boolean, kind int, value string")

    kept = ("value", "returns")
    records = stated.where(whole).select(*kept).unionByName(cut(~whole).where(F.col("kind") == RECORD).select(*kept))
    # begins and rests, at most two a split: the rests after a begin belong to it
    pieces = cut(F.col("open") | F.col("goes_on")).where(F.col("kind") != RECORD)
    ordered = Window.partitionBy("file").orderBy("start", F.when(F.col("kind") == REST, 0).otherwise(1))
    numbered = pieces.withColumn("record", F.sum((F.col("kind") != REST).cast("int")).over(ordered))
    joined = numbered.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"), F.max("kind").alias("kind"), F.first("returns").alias("returns")
    )
    joined = joined.where(F.col("kind") != BEGIN_HEADER).select(F.array_join("parts.value", "\n").alias("value"), "returns")
    text = F.when(F.col("returns"), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value"))
    return records.unionByName(joined).withColumn("value", text).where("value != ''")
