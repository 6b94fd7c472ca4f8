"""Batch reads of the bronze dataset and of snapshot tables registered as views."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.schemas import TOPIC_PREFIX
from cdclake.sinks.snapshots import SnapshotTable
from cdclake.streaming.silver import DELETED_COL, current_rows

log = logging.getLogger(__name__)


def read_bronze_table(spark: SparkSession, bronze_root: str, table: str) -> DataFrame:
    """Rows of one source table: a filter on the partition column, pruned to one folder."""
    topic = table if table.startswith(TOPIC_PREFIX) else f"{TOPIC_PREFIX}{table}"
    return spark.read.parquet(bronze_root).where(F.col("source_table") == topic)


def register_views(spark: SparkSession, tables: dict[str, str], prefix: str = "silver_") -> list[str]:
    """Register each snapshot table as a temp view; returns the names that exist.

    Only a table that was never written is left out. One that exists but
    cannot be read raises: results built without it would look complete.
    """
    done = []
    for name, path in tables.items():
        table = SnapshotTable(spark, path)
        if not table.exists():
            log.warning("no table at %s", path)
            continue
        rows = table.read()
        # a table kept by a stream: without deleted rows and the stream's own columns
        rows = current_rows(table) if DELETED_COL in rows.columns else rows
        rows.createOrReplaceTempView(f"{prefix}{name}")
        done.append(name)
    return done
