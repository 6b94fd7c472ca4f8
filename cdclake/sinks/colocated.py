"""Bucketed tables of the catalog: copies that join on their key without a shuffle.

The planner knows the buckets of a catalog table, so two tables with the same
key and number of buckets are joined bucket by bucket. A table lies in the
folder ``<path>/buckets<n>-<key>``, which says how it is laid out, and
``<path>/columns`` keeps its columns (a table without rows has no file): an
application whose catalog does not hold it opens it from there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_FOLDER, _COLUMNS = "buckets", "columns"


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}`" for n in names)


def write_colocated(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Replace the table ``name`` under ``path`` by ``df``, one sorted file a bucket, and read it back.

    Rows are shuffled by the key once, here. ``buckets``: as many as the
    session's shuffle has partitions, unless given; tables that are to be
    joined need the same number. All rows with a null key share a bucket.
    """
    if any(set(k) & set("-=/") for k in keys):
        raise ValueError(f"the key {list(keys)} cannot name a folder")
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{path.rstrip('/')}/{_FOLDER}{n}-{'-'.join(keys)}"
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    others = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(_FOLDER)] if fs.exists(root) else []
    # the writer's hash is the buckets' one, so a task holds one bucket
    rows = df.repartition(n, *[df[k] for k in keys]).write.bucketBy(n, *keys).sortBy(*keys)
    rows.format("parquet").option("path", folder).mode("overwrite").saveAsTable(name)
    df.limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_COLUMNS}")
    for old in others:  # with another number of buckets or another key
        if old.getName() != folder.rsplit("/", 1)[1]:
            fs.delete(old, True)
    return spark.table(name)


def open_colocated(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The table under ``path``, entered in the catalog as ``name`` if it is not there."""
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)  # another application may have written it anew
        return spark.table(name)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith(_FOLDER)] if fs.exists(root) else []
    if len(found) != 1:
        raise FileNotFoundError(f"no single bucketed table at {path}: {found}")
    n, *keys = found[0][len(_FOLDER):].split("-")
    folder = f"{path.rstrip('/')}/{found[0]}"
    schema = spark.read.parquet(f"{path.rstrip('/')}/{_COLUMNS}").schema
    columns = ", ".join(f"{_quoted([f.name])} {f.dataType.simpleString()}" for f in schema)
    location = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(keys)}) SORTED BY ({_quoted(keys)}) "
              f"INTO {int(n)} BUCKETS LOCATION '{location}'")  # fmt: skip
    return spark.table(name)
