"""Per-card amount features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_defaults(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Null fill per column (``fillna`` with a per-column dict)."""
    return df.fillna({k: v for k, v in values.items() if k in df.columns})


def zscore(
    df: DataFrame,
    group_col: str,
    value_col: str,
    mean_col: str = "avg_amt",
    std_col: str = "std_amt",
    out_col: str = "z_score",
    stats_source: DataFrame | None = None,
) -> DataFrame:
    """Z-score of ``value_col`` within its ``group_col`` group.

    Mean and sample standard deviation are computed with a group-by (partial
    aggregation on the map side, so a group holding a third of all rows is
    reduced before the shuffle) and joined back null-safely. Spark sizes the
    stats side at runtime: broadcast when small, else a sort-merge join whose
    skewed partitions AQE splits. A standard deviation that is null (one row)
    or zero gives a z-score of 0. ``stats_source`` (the same rows, possibly a
    narrower projection of them) is where the statistics are computed.
    The null-safe join key also keeps both join sides plain shuffles, which is
    what lets AQE split the hot group.
    """
    g = f"_zg_{group_col}"
    src = df if stats_source is None else stats_source
    stats = src.groupBy(F.col(group_col).alias(g)).agg(
        F.avg(value_col).alias(mean_col), F.stddev_samp(value_col).alias(std_col)
    )
    joined = df.join(stats, df[group_col].eqNullSafe(stats[g]), "left").drop(g)
    sd = F.col(std_col)
    return joined.withColumn(
        out_col,
        F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise((F.col(value_col) - F.col(mean_col)) / sd),
    )
