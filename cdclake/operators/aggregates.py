"""Group-bys, distinct projections and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def max_per_key(df: DataFrame, key: str | Sequence[str], cols: dict[str, str]) -> DataFrame:
    """``GROUP BY key`` with ``MAX`` of each column, maximised independently ({col: alias})."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[F.max(c).alias(a) for c, a in cols.items()])


def distinct_rows(df: DataFrame, cols: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """``SELECT DISTINCT cols`` with an optional not-null conjunction first."""
    out = df
    for c in not_null:
        out = out.where(F.col(c).isNotNull())
    return out.select(*cols).distinct()


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (a repeatable ``dropDuplicates(keys)``).

    Planned as a rank-1 window with a partial group limit before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_metrics(df: DataFrame, key: str) -> DataFrame:
    """Rows before and after keeping one row per key, in one aggregation pass.

    ``kept`` counts distinct non-null keys plus one if any key is null (a
    latest-per-key keeps one null-key row).
    """
    agg = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_distinct(F.col(key)).alias("_distinct"),
        F.max(F.col(key).isNull().cast("int")).alias("_has_null"),
    )
    kept = F.col("_distinct") + F.coalesce(F.col("_has_null"), F.lit(0))
    return agg.select(
        "rows_before",
        kept.cast("long").alias("rows_after"),
        (F.col("rows_before") - kept).cast("long").alias("rows_removed"),
    )
