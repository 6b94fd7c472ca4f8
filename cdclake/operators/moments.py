"""Mergeable moments per group, and z-scores kept up to date without rereading the fact.

A group's state is its count, mean and sum of squared deviations. States of
disjoint rows merge (the pairwise update of means and squared deviations),
and a row that changed is taken back by merging it with a negative count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.session import staged
from cdclake.sinks.snapshots import SnapshotTable

#: Count, mean and sum of squared deviations of a group.
COUNT, MEAN, M2 = "_n", "_mean", "_m2"
BATCH = "_batch"


def moments(rows: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """``group, _n, _mean, _m2`` of the non-null values, by partial aggregation; a null group is a group."""
    value = F.col(value_col).cast("double")
    return rows.groupBy(group_col).agg(
        F.count(value).alias(COUNT), F.coalesce(F.avg(value), F.lit(0.0)).alias(MEAN),
        F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias(M2),
    )


def taken_back(states: DataFrame) -> DataFrame:
    """States that remove their rows when merged."""
    return states.withColumns({COUNT: -F.col(COUNT), M2: -F.col(M2)})


def merge_moments(left: DataFrame, right: DataFrame, group_col: str) -> DataFrame:
    """One state a group from at most one of either side. A group without rows left has the state 0, 0, 0.

    What is taken back must have been merged before: a state of as many rows
    added as taken back cannot say what they were.
    """
    other = right.select(F.col(group_col).alias("_g"), F.col(COUNT).alias("_n2"), F.col(MEAN).alias("_mean2"), F.col(M2).alias("_m22"))
    both = left.join(other, left[group_col].eqNullSafe(other["_g"]), "full")
    n1, n2 = F.coalesce(COUNT, F.lit(0)), F.coalesce("_n2", F.lit(0))
    a, b = F.coalesce(MEAN, F.lit(0.0)), F.coalesce("_mean2", F.lit(0.0))
    n, step = n1 + n2, b - a
    # which side has the row: the group itself may be null
    group = F.when(F.col(COUNT).isNotNull(), F.col(group_col)).otherwise(F.col("_g"))
    deviations = F.coalesce(M2, F.lit(0.0)) + F.coalesce("_m22", F.lit(0.0))
    return both.select(
        group.alias(group_col),
        n.alias(COUNT),
        F.when(n != 0, a + step * n2 / n).otherwise(0.0).alias(MEAN),
        # rounding must not leave a negative sum; a single value deviates from nothing
        F.when(n > 1, F.greatest(F.lit(0.0), deviations + step * step * n1 * n2 / n)).otherwise(0.0).alias(M2),
    )


def zscore_from_moments(
    rows: DataFrame,
    states: DataFrame,
    group_col: str,
    value_col: str,
    mean_col: str = "avg_amt",
    std_col: str = "std_amt",
    out_col: str = "z_score",
) -> DataFrame:
    """``rows`` with mean, sample standard deviation and z-score of their group's state.

    The join is null-safe, so that both sides are plain shuffles when the
    states are too many to broadcast, and a common group can be split.
    """
    stats = states.where(F.col(COUNT) > 0).select(
        F.col(group_col).alias("_g"), F.col(MEAN).alias(mean_col),
        F.when(F.col(COUNT) > 1, F.sqrt(F.col(M2) / (F.col(COUNT) - 1))).alias(std_col),
    )
    joined = rows.join(stats, rows[group_col].eqNullSafe(stats["_g"]), "left").drop("_g")
    sd = F.col(std_col)
    # the rounding of a few merges is no deviation
    still = sd.isNull() | (sd <= F.abs(mean_col) * 1e-9)
    return joined.withColumn(out_col, F.when(still, F.lit(0.0)).otherwise((F.col(value_col) - F.col(mean_col)) / sd))


class GroupStatistics:
    """Moments per group of a keyed table, updated by arrivals of changed rows.

    Two bucketed tables under ``root``: ``values`` (what each key counts with:
    its group and value) and ``moments`` (a state a group). An arrival reads
    only the buckets of ``values`` that its keys are in, takes back what
    changed, and merges the rest into the states of its groups. The table of
    the rows themselves is never read.

    An arrival has a number. A group keeps the last arrival merged into it, and
    ``values`` is written after ``moments``: an arrival that failed half-way is
    run again with its number and finishes, a replayed one changes nothing.
    Arrivals come in rising order of their numbers.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], group_col: str, value_col: str, buckets: int = 16):
        self.keys, self.group, self.value = list(keys), group_col, value_col
        self.values = SnapshotTable(spark, f"{root}/values", use_delta=False, buckets=buckets)
        self.moments = SnapshotTable(spark, f"{root}/moments", use_delta=False, buckets=buckets)

    def _keyed(self, states: DataFrame) -> DataFrame:
        # a key that is never null, so that the null group is matched too
        return states.withColumn("_group", F.coalesce(F.concat(F.lit("="), F.col(self.group).cast("string")), F.lit("null")))

    def update(self, rows: DataFrame, arrival: int) -> None:
        """Count in the latest rows (one a key) of an arrival."""
        new = staged(rows.select(*self.keys, self.group, F.col(self.value).cast("double").alias(self.value)), "arrival")
        changed, back = new, new.where("false").select(self.group, self.value)
        if self.values.exists():
            old = self.values.read_buckets_of(new, self.keys)
            pairs = old.select(*[F.col(k).alias(f"_o_{k}") for k in self.keys], F.col(self.group).alias("_o_group"), F.col(self.value).alias("_o_value"))
            match = [F.col(k) == F.col(f"_o_{k}") for k in self.keys]
            # the old rows of the arrival's keys only: not more than the arrival
            both = staged(new.join(pairs.join(new.select(*self.keys), match, "left_semi"), match, "left"), "arrival-pairs")
            known = F.col(f"_o_{self.keys[0]}").isNotNull()
            same = known & F.col(self.group).eqNullSafe(F.col("_o_group")) & F.col(self.value).eqNullSafe(F.col("_o_value"))
            changed = both.where(~same)
            back = changed.where(known).select(F.col("_o_group").alias(self.group), F.col("_o_value").alias(self.value))
            changed = changed.select(*new.columns)
        added = self._keyed(staged(moments(changed, self.group, self.value), "arrival-added"))
        gone = self._keyed(staged(taken_back(moments(back, self.group, self.value)), "arrival-back"))
        groups = staged(added.select("_group").union(gone.select("_group")).distinct(), "arrival-groups")
        stored = added.where("false").withColumn(BATCH, F.lit(arrival).cast("long"))
        if self.moments.exists():
            # the states of the arrival's groups; staged, as they are read below while they are replaced
            stored = staged(self.moments.read_buckets_of(groups, ["_group"]).join(groups, "_group", "left_semi"), "arrival-states")
        due = groups.join(stored.where(F.col(BATCH) >= arrival).select("_group"), "_group", "left_anti")
        # first what is taken back, then what is added
        now = self._of(stored, due)
        for states in (gone, added):
            now = merge_moments(now, self._of(states, due), self.group)
        self.moments.upsert(self._keyed(now).withColumn(BATCH, F.lit(arrival).cast("long")), ["_group"])
        self.values.upsert(changed, self.keys)

    def _of(self, states: DataFrame, groups: DataFrame) -> DataFrame:
        return states.join(groups, "_group", "left_semi").select(self.group, COUNT, MEAN, M2)

    def states(self) -> DataFrame:
        return self.moments.read().select(self.group, COUNT, MEAN, M2)
