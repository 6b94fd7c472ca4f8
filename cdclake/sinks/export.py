"""Materialisation, parquet export and full-refresh serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdclake.sinks.snapshots import SnapshotTable


def materialize(df: DataFrame, path: str, num_files: int | None = None) -> DataFrame:
    """Write ``df`` and return a DataFrame reading it back (cuts the lineage).

    ``num_files`` fixes the file count with a hash repartition (the job this
    replaces used 8). Left unset, a ``REBALANCE`` lets AQE cut the output into
    partitions of the advisory size, which is what a large table needs.
    """
    out = df.repartition(num_files) if num_files else df.hint("rebalance")
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def export_parquet(df: DataFrame, path: str) -> int:
    """Overwrite ``path`` with ``df`` and return the row count of the written files.

    The count is read back from the parquet footers (no data pages), so task
    retries during the write can never inflate it.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def refresh_serving(spark: SparkSession, export_path: str, serving_path: str) -> int:
    """Full refresh of a serving table from exported files.

    The new contents are written as a new version and become current in one
    step when the write commits, so readers never see an empty table.
    """
    return SnapshotTable(spark, serving_path, use_delta=False).overwrite(spark.read.parquet(export_path))
