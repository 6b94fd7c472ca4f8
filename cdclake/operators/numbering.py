"""Dense sequence numbers without a single-task global window.

``row_number() over (order by k)`` with no partition moves every row into one
task. Here the rows are range-partitioned on the sort key, numbered inside
each partition and shifted by the row counts of the partitions before them.
The counts table has one row per partition (or per group and partition), so
it stays small however large the input is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_P = "_seq_p"
_I = "_seq_i"


def sequence_number(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    out: str = "seq",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 1, 2, ... in ``order_cols`` order, restarting per ``group_cols`` group.

    Equal to ``row_number() over (partition by group_cols order by order_cols)``
    (without groups: over the whole input). A group larger than one partition
    is spread over several range partitions and numbered across them.
    The range-partitioned rows are checkpointed to the shared checkpoint
    folder, so counts and rows come from the same materialised partitioning
    even when tasks are retried.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [*group_cols, *order_cols]
    ranged = (
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn(_P, F.spark_partition_id())
        # monotonically_increasing_id = (partition id << 33) + position in the partition
        .withColumn(_I, F.monotonically_increasing_id() - F.shiftleft(F.col(_P).cast("long"), 33))
        .checkpoint(eager=True)
    )
    if not group_cols:
        counts = ranged.groupBy(_P).agg(F.count(F.lit(1)).alias("_n"))
        # a running sum over the counts table: one row per range partition, so this
        # unpartitioned window sees at most ``n`` rows whatever the input size
        before = Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
        # one row per range partition: a bounded broadcast
        offsets = counts.select(_P, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
        out_df = ranged.join(F.broadcast(offsets), _P).withColumn(out, F.col("_off") + F.col(_I) + 1)
        return out_df.drop(_P, _I, "_off")

    gk = [f"_seq_g{i}" for i in range(len(group_cols))]
    counts = ranged.groupBy(*[F.col(c).alias(a) for c, a in zip(group_cols, gk)], _P).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_I).alias("_first")
    )
    before = Window.partitionBy(*gk).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    cond = [ranged[c].eqNullSafe(counts[a]) for c, a in zip(group_cols, gk)] + [ranged[_P] == counts[_P]]
    joined = ranged.join(counts, cond, "inner")
    result = joined.select(
        *[ranged[c] for c in df.columns],
        (ranged[_I] - F.col("_first") + F.col("_before") + 1).alias(out),
    )
    return result
