"""Data-quality checks: counts, key uniqueness, foreign keys, not-null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.sources.seeds import values_table


def table_counts(bronze: DataFrame, expected: Sequence[str], table_col: str = "source_table") -> DataFrame:
    """Rows per table in one scan, right-joined to the expected list; missing tables report 0."""
    spark = bronze.sparkSession
    counts = bronze.groupBy(table_col).agg(F.count(F.lit(1)).alias("n_rows"))
    names = values_table(spark, [(t,) for t in expected], T.StructType([T.StructField(table_col, T.StringType())]))
    return names.join(counts, table_col, "left").select(
        table_col,
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        F.col("n_rows").isNotNull().alias("present"),
    )


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def fk_orphans(child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    """Foreign keys without a parent row, with the number of child rows that hold them (``n_rows``).

    The child's keys are counted before they are compared (partial aggregation
    in every map task), so what is shuffled are distinct keys, not child rows,
    and a key with a third of all rows is one row a task. The anti join needs
    no distinct parents. Keys with a null part refer to nothing and are left out.
    """
    present = child
    for c in child_keys:
        present = present.where(F.col(c).isNotNull())
    held = present.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n_rows"))
    p = parent.select(*[F.col(pk).alias(f"_fk{i}") for i, pk in enumerate(parent_keys)])
    cond = [held[c] == p[f"_fk{i}"] for i, c in enumerate(child_keys)]
    return held.join(p, cond, "left_anti")


def fk_violations(
    child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]
) -> DataFrame:
    """Child rows with a non-null foreign key that has no parent row: the child's rows with the (few) orphan keys."""
    orphans = fk_orphans(child, child_keys, parent, parent_keys).select(*[F.col(c).alias(f"_or{i}") for i, c in enumerate(child_keys)])
    return child.join(orphans, [child[c] == orphans[f"_or{i}"] for i, c in enumerate(child_keys)], "left_semi")


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: how many nulls it holds (one pass over the table)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stacked}) as (column_name, n_nulls)")


def constraint_report(spark: SparkSession, checks: dict[str, DataFrame]) -> DataFrame:
    """Violation counts of named checks, one row per check.

    A check gives its violating rows, or counted keys with ``n_rows``.
    """
    def violations(df: DataFrame):
        return F.coalesce(F.sum("n_rows"), F.lit(0)) if "n_rows" in df.columns else F.count(F.lit(1))

    parts = [df.agg(violations(df).alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations")
             for name, df in checks.items()]
    if not parts:
        return spark.createDataFrame([], "check_name string, n_violations long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
