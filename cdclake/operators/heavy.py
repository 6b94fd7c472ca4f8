"""Left joins of a skewed fact: the heaviest keys are broadcast, only the other rows are shuffled.

A frequent-items sketch of the key column (built per task, merged, of fixed
size) names the keys that hold a given share of the rows. There are at most
``1 / share`` of them, so the part of a keyed side that they need is small
whatever the side's size. The sketch decides how a row travels, never what it
is joined to: a key that it names wrongly, or misses, costs time only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the rows that makes a key heavy.
HEAVY_SHARE = 0.01


def heavy_keys(rows: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """The keys (no null) that about ``share`` of ``rows`` or more have, most frequent first: at most ``1 / share`` (and one)."""
    if not 1e-4 <= share <= 1:
        raise ValueError("share must be between 0.0001 and 1")
    most = math.ceil(1 / share) + 1  # and null
    # the sketch's error is a small part of the share
    top = F.expr(f"approx_top_k(`{key}`, {most}, {20 * most})").alias("top")
    found = rows.select(F.col(f"`{key}`")).agg(top, F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found["top"] if r["item"] is not None and r["count"] >= share * found["n"]]


def left_join_heavy(rows: DataFrame, side: DataFrame, key: str, side_key: str, heavy: Sequence) -> DataFrame:
    """``rows`` left-joined to ``side`` on ``key = side_key``; rows with a ``heavy`` key are not shuffled.

    ``side`` has one row per ``side_key`` at most (which bounds what is
    broadcast) and no column name of ``rows``. Rows without a key match nothing
    and stay out of the shuffle too. ``rows`` is read twice, each row by one
    of the halves, so it should be a stored table.
    """
    match = F.col(key) == F.col(side_key)
    if not heavy:
        return rows.join(side, match, "left")
    hot = rows.where(F.col(key).isin(list(heavy)) | F.col(key).isNull())
    few = F.broadcast(side.where(F.col(side_key).isin(list(heavy))))
    rest = rows.where(~F.col(key).isin(list(heavy)))  # never true for null
    return hot.join(few, match, "left").unionByName(rest.join(side, match, "left"))


def stored_bytes(table: DataFrame) -> int:
    """Size of the files that ``table`` is read from (one row a file is looked at)."""
    files = table.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size")).first()[0] or 0


def broadcast_limit(table: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes, 0 if broadcasts are off."""
    spark = table.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return 0 if limit.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
