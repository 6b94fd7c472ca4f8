"""Keyed snapshot tables: first write, upsert, insert-if-absent, append.

Delta Lake ``MERGE`` is used when the Delta package is importable. Without
it a keyed table is a parquet folder partitioned by a hash bucket of the key.
A change reads and rewrites only the buckets its keys fall into, with Spark's
dynamic partition overwrite; the files of all other buckets stay as they are.
The partition column's name holds the number of buckets and the key
(``bucket16-user_id``), so the folder itself says how it is laid out.
A table without a key is a plain parquet folder.

Spark stages the new files and puts them in place when the whole write has
succeeded, so a failed change leaves the table as it was. Changes of one table
queue up within an application; between applications one may write a table at
a time (Delta lifts that).
"""

from __future__ import annotations

import importlib.util
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdclake.session import staged

#: Buckets of a table that is made without saying how many.
BUCKETS = 16

_BUCKET = "bucket"
#: Makes a table's rows from narrower ones that have its key; columns named second are returned after the rows'.
Finish = Callable[[DataFrame, Sequence[str]], DataFrame]

_writers: dict[str, threading.RLock] = defaultdict(threading.RLock)


def delta_available(spark: SparkSession | None = None) -> bool:
    """The Delta Python package is importable and, given a session, its JVM classes are loaded."""
    if importlib.util.find_spec("delta") is None:
        return False
    if spark is None:
        return True
    try:
        spark._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
        return True
    except Exception:
        return False


def upsert_frames(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE semantics as a DataFrame: matched rows replaced, new rows added, others kept.

    ``t.k = s.k`` never matches a null key, so null-key source rows are
    always added and null-key target rows always kept, as with MERGE.
    Only the source keys are joined against the target; AQE broadcasts them
    when the incoming batch is small, so the target is then read without a
    shuffle.
    """
    skeys = source.select(*[F.col(k).alias(f"_uk{i}") for i, k in enumerate(keys)])
    cond = [target[k] == skeys[f"_uk{i}"] for i, k in enumerate(keys)]
    kept = target.join(skeys, cond, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def apply_changes_frames(target: DataFrame, changes: DataFrame, keys: Sequence[str], op_col: str = "_cdc_op") -> DataFrame:
    """Apply one latest change per key: deletes remove the key, other changes replace or add it."""
    ckeys = changes.select(*[F.col(k).alias(f"_ck{i}") for i, k in enumerate(keys)])
    cond = [target[k] == ckeys[f"_ck{i}"] for i, k in enumerate(keys)]
    kept = target.join(ckeys, cond, "left_anti")
    live = changes.where(F.col(op_col) != "d").drop(op_col)
    return kept.unionByName(live, allowMissingColumns=True)


def absent_rows(target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row of ``new`` for each key that ``target`` does not have."""
    order = list(order) if order else [F.col(c).asc_nulls_first() for c in new.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    first = new.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    tkeys = target.select(*[F.col(k).alias(f"_ik{i}") for i, k in enumerate(keys)])
    cond = [first[k] == tkeys[f"_ik{i}"] for i, k in enumerate(keys)]
    return first.join(tkeys, cond, "left_anti")


def changed_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key ``target`` does not have, or has with other values in ``columns``."""
    names = [*keys, *columns]
    stored = target.select(*[F.col(c).alias(f"_cr{i}") for i, c in enumerate(names)])
    return source.join(stored, [source[c].eqNullSafe(stored[f"_cr{i}"]) for i, c in enumerate(names)], "left_anti")


def insert_if_absent_frames(
    target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING``: one new row per absent key is appended."""
    return target.unionByName(absent_rows(target, new, keys, order), allowMissingColumns=True)


class SnapshotTable:
    """A table stored as parquet, keyed ones in hash buckets (or as Delta when present)."""

    def __init__(self, spark: SparkSession, path: str, use_delta: bool | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.use_delta = delta_available(spark) if use_delta is None else use_delta
        self.buckets = buckets

    # --- file system helpers (Hadoop FS, so any cluster file system works) ---
    def _fs(self, path: str | None = None):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path or self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str | None = None) -> list[str]:
        fs, p = self._fs(path)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def _layout(self) -> tuple[str, int, list[str]] | None:
        """Partition column, number of buckets and key of a bucketed table."""
        for name in self._names():
            column = name.split("=")[0]
            if "=" in name and column.startswith(_BUCKET):
                count, *keys = column[len(_BUCKET):].split("-")
                return column, int(count), keys
        return None

    def _bucketed(self, rows: DataFrame, column: str, count: int, keys: Sequence[str]) -> DataFrame:
        return rows.withColumn(column, F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(count)).cast("int"))

    def _column(self, keys: Sequence[str]) -> str:
        if any(set(k) & set("-=/") for k in keys):
            raise ValueError(f"the key {list(keys)} cannot name a folder")
        return "-".join([f"{_BUCKET}{self.buckets}", *keys])

    def exists(self) -> bool:
        if self.use_delta:
            from delta.tables import DeltaTable  # type: ignore

            return DeltaTable.isDeltaTable(self.spark, self.path)
        return any(n == "_SUCCESS" or n.endswith(".parquet") or n.startswith(_BUCKET) for n in self._names())

    def read(self) -> DataFrame:
        if self.use_delta:
            return self.spark.read.format("delta").load(self.path)
        layout = self._layout()
        rows = self._stored()
        return rows.drop(layout[0]) if layout else rows

    def _stored(self, column: str = "", buckets: Sequence[int] = ()) -> DataFrame:
        """The stored rows; with ``buckets`` only theirs: no other folder is listed, no other footer read."""
        if not self.exists():
            raise FileNotFoundError(f"no table at {self.path}")
        # an append or a change may lack columns of the table, or add some: they read as null elsewhere
        reader = self.spark.read.option("mergeSchema", True)
        if not buckets:
            return reader.parquet(self.path)
        there = set(self._names())
        folders = [f"{column}={b}" for b in (-1, *buckets)]  # the first one keeps the columns and has no rows
        return reader.option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in folders if f in there])

    def read_buckets_of(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The table's rows in the buckets that the keys of ``rows`` fall into (the whole table if it has none for them).

        ``rows`` is read once for its buckets; at most one number a bucket comes to the driver.
        """
        layout = None if self.use_delta else self._layout()
        if layout is None or layout[2] != list(keys):
            return self.read()
        column, count, _ = layout
        buckets = self._bucketed(rows.select(*[F.col(f"`{k}`") for k in keys]), column, count, keys).select(F.col(f"`{column}`")).distinct()
        found = [r[0] for r in buckets.collect()]
        return self._stored(column, found).drop(column) if found else self.read().where("false")

    # --- writes ---
    def overwrite(self, df: DataFrame, keys: Sequence[str] = (), finish: Finish | None = None) -> int:
        """Replace the whole table: written beside it, then put in its place. ``keys`` makes it a bucketed one.

        With ``finish`` a bucketed table's rows are ``finish(df, ())``; it is applied row by row, once the narrower
        rows of ``df`` are dealt to their buckets and sorted.
        """
        if finish and (self.use_delta or not keys):
            df, finish = finish(df, ()), None
        if self.use_delta:
            df.write.format("delta").mode("overwrite").save(self.path)
            return 0
        beside = f"{self.path}.new-{uuid.uuid4().hex[:12]}"
        fs, root = self._fs()
        written = self.spark._jvm.org.apache.hadoop.fs.Path(beside)
        try:
            if keys:
                column = self._column(keys)
                # keeps the columns of the table, whatever buckets have rows
                empty = df.limit(0)
                (finish(empty, ()) if finish else empty).write.parquet(f"{beside}/{column}=-1")
                self._write(self._bucketed(df, column, self.buckets, keys), column, beside, finish)
            else:
                df.write.parquet(beside)
            with _writers[self.path]:
                fs.delete(root, True)
                if not fs.rename(written, root):
                    raise RuntimeError(f"{beside} could not be moved to {self.path}")
        finally:
            fs.delete(written, True)
        return self.buckets if keys else 0

    def _write(self, rows: DataFrame, column: str, path: str | None = None, finish: Finish | None = None) -> None:
        """Replace the buckets that ``rows`` has rows of. A large bucket is split over tasks, small ones share one."""
        dealt = rows.hint("rebalance", F.col(f"`{column}`"))
        if finish:
            # sorted as the writer wants it before the rows get wide
            dealt = finish(dealt.sortWithinPartitions(F.col(f"`{column}`")), (column,))
        out = dealt.write.partitionBy(column)
        out.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path or self.path)

    def _files(self, column: str, bucket: int) -> set[str]:
        return set(self._names(f"{self.path}/{column}={bucket}"))

    def _change(self, source: DataFrame, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the buckets of the source's keys by ``merge(rows there, source)``; returns their number."""
        with _writers[self.path]:
            layout = self._layout()
            if layout is None or layout[2] != list(keys):  # a table without this key gets its buckets now
                old, new = self.read(), staged(source, "change")
                return self.overwrite(merge(old, new), keys)
            column, count, _ = layout
            # the source is used more than once (its buckets, keys and rows): evaluate it once
            new = staged(self._bucketed(source, column, count, keys), "change")
            name = f"`{column}`"
            touched = sorted(r[0] for r in new.select(F.col(name)).distinct().collect())  # at most one row a bucket
            if not touched:
                return 0
            before = {b: self._files(column, b) for b in touched}
            old = self._stored(column, touched)
            self._write(merge(old, new), column)
            # a bucket without rows left was not replaced: what is still there goes
            fs, _ = self._fs()
            for b in touched:
                for stale in before[b] & self._files(column, b):
                    fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{column}={b}/{stale}"), False)
            return len(touched)

    def upsert(self, source: DataFrame, keys: Sequence[str], finish: Finish | None = None) -> int:
        """Create the table from ``source`` if absent, else merge ``source`` into it by ``keys``.

        ``finish`` as in :meth:`overwrite`. Returns the number of buckets written.
        """
        if finish and (self.use_delta or self.exists()):
            source, finish = finish(source, ()), None
        if self.use_delta and self.exists():
            from delta.tables import DeltaTable  # type: ignore

            cond = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
            (
                DeltaTable.forPath(self.spark, self.path).alias("t")
                .merge(source.alias("s"), cond)
                .whenMatchedUpdateAll()
                .whenNotMatchedInsertAll()
                .execute()
            )
            return 0
        with _writers[self.path]:
            if not self.exists():
                return self.overwrite(source, keys, finish)
            if finish:  # made by another writer meanwhile
                source = finish(source, ())
            return self._change(source, keys, lambda old, new: upsert_frames(old, new, keys))

    def apply_changes(self, changes: DataFrame, keys: Sequence[str], op_col: str = "_cdc_op") -> int:
        """Apply latest changes per key (``cdc.latest_changes``): a delete removes the row."""
        if self.use_delta and self.exists():
            from delta.tables import DeltaTable  # type: ignore

            cond = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
            cols = {c: f"s.`{c}`" for c in changes.columns if c != op_col}
            (
                DeltaTable.forPath(self.spark, self.path).alias("t")
                .merge(changes.alias("s"), cond)
                .whenMatchedDelete(condition=f"s.`{op_col}` = 'd'")
                .whenMatchedUpdate(set=cols)
                .whenNotMatchedInsert(condition=f"s.`{op_col}` <> 'd'", values=cols)
                .execute()
            )
            return 0
        with _writers[self.path]:
            if not self.exists():
                return self.overwrite(changes.where(F.col(op_col) != "d").drop(op_col), keys)
            return self._change(changes, keys, lambda old, new: apply_changes_frames(old, new, keys, op_col))

    def insert_if_absent(self, new: DataFrame, keys: Sequence[str]) -> int:
        """Append one row for each key the table does not have; present rows are only read for their keys."""
        with _writers[self.path]:
            if not self.exists():
                return self.overwrite(insert_if_absent_frames(new.limit(0), new, keys), keys)
            return self.append(absent_rows(self.read(), new, keys))

    def append(self, df: DataFrame) -> int:
        """Add rows as new files; nothing that is there is read or rewritten."""
        if self.use_delta:
            df.write.format("delta").mode("append").save(self.path)
            return 0
        with _writers[self.path]:
            layout = self._layout()
            if layout is None:
                df.write.mode("append").parquet(self.path)
                return 0
            column, count, keys = layout
            rows = self._bucketed(df, column, count, keys)
            rows.hint("rebalance", F.col(f"`{column}`")).write.partitionBy(column).mode("append").parquet(self.path)
            return count
