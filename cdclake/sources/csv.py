"""CSV batch sources with header normalisation, schema alignment and row accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions.strings import normalize_column_name
from cdclake.sources.csv_records import csv_records

RANK_COL = "source_rank"
BAD_COL = "_load_failed"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def order_files(files: Sequence[str]) -> list[str]:
    """Training files first, then the rest, keeping the given order otherwise."""
    return sorted(files, key=lambda f: 0 if "train" in f.rsplit("/", 1)[-1] else 1)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Plain typed CSV read with a header row and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(paths)


CORRUPT_COL = "_raw_record"

# Texts that the original loader's reader takes as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: How lines are read: ``auto`` splits files that are larger than a split; ``split`` splits all; ``whole`` reads each
#: file in one task; ``single`` is for files known to have no line breaks in fields.
LINES = ("auto", "split", "whole", "single")


def _larger_than_a_split(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    sizes = []
    for status in found:
        fs = status.getPath().getFileSystem(spark._jsc.hadoopConfiguration())
        sizes += [st.getLen() for st in fs.listStatus(status.getPath())] if status.isDirectory() else [status.getLen()]
    limit = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return max(sizes, default=0) > limit


def read_raw_csv(spark: SparkSession, path: str, lines: str = "auto") -> DataFrame:
    """All columns as text, header names normalised (``id-01`` -> ``id_01``), plus ``_raw_record``.

    Quotes are doubled inside quoted fields and a quoted field may span lines.
    A row with more or fewer fields than the header keeps its text in
    ``_raw_record`` (null for well-formed rows). Large files are read by many
    tasks (:mod:`cdclake.sources.csv_records`); see ``LINES``.
    """
    if lines not in LINES:
        raise ValueError(f"lines must be one of {LINES}")
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    reader = spark.read.options(header=True, multiLine=lines != "single", **options)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT_COL]])
    if lines == "split" or (lines == "auto" and _larger_than_a_split(spark, path)):
        ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in schema.names)
        # like the reader of whole files: line breaks inside fields are newlines, the raw text keeps what the file has
        text = F.when(F.col("returns"), F.replace("value", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value"))
        parsed = csv_records(spark, path).select(F.from_csv(text, F.lit(ddl), {**options, "multiLine": "true"}).alias("row"), "value")
        raw = parsed.select("row.*", "value").withColumn(CORRUPT_COL, F.when(F.col(CORRUPT_COL).isNotNull(), F.col("value"))).drop("value")
    else:
        raw = reader.option("columnPruning", False).schema(schema).csv(path)
    return raw.toDF(*[normalize_column_name(c) for c in names], CORRUPT_COL)


def load_files(spark: SparkSession, files: Sequence[str], schema: T.StructType, lines: str = "auto") -> DataFrame:
    """Read a table spread over several CSV files into the declared schema.

    Files are taken training-first; missing files are skipped. Columns absent
    from a file are added as nulls, and so are the usual marks of missing
    values (``NA``, ``NaN``, ...). Every row gets ``source_rank`` (its file's
    position) and ``_load_failed``: true when a present value does not
    convert to the declared type or the row has the wrong number of fields
    (its text is then in ``_raw_record``). Conversion uses ``try_cast``, so
    one bad row never fails a batch.
    """
    parts = []
    for rank, f in enumerate([f for f in order_files(files) if path_exists(spark, f)]):
        parts.append(read_raw_csv(spark, f, lines).withColumn(RANK_COL, F.lit(rank)))
    if not parts:
        cols = [F.lit(None).cast(fld.dataType).alias(fld.name) for fld in schema.fields]
        return spark.range(0).select(
            *cols, F.lit(0).alias(RANK_COL), F.lit(False).alias(BAD_COL), F.lit(None).cast("string").alias(CORRUPT_COL)
        )
    raw = parts[0]
    for p in parts[1:]:
        raw = raw.unionByName(p, allowMissingColumns=True)
    marks = ", ".join(f"'{m}'" for m in MISSING)
    typed, bad = [], [F.col(CORRUPT_COL).isNotNull()]
    for fld in schema.fields:
        if fld.name not in raw.columns:
            typed.append(F.lit(None).cast(fld.dataType).alias(fld.name))
            continue
        text, missing = F.col(f"`{fld.name}`"), F.expr(f"trim(`{fld.name}`) IN ({marks})")
        if isinstance(fld.dataType, T.StringType):
            typed.append(F.when(~missing, text).alias(fld.name))
            continue
        value = text.try_cast(fld.dataType)
        if isinstance(fld.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        typed.append(value.alias(fld.name))
        # the list is looked at only where the conversion gave nothing
        bad.append(text.isNotNull() & value.isNull() & ~missing)
    return raw.select(*typed, F.col(RANK_COL), _any(bad).alias(BAD_COL), F.col(CORRUPT_COL))


def _any(conds: list) -> "F.Column":
    """OR of many conditions as a balanced tree (a 400-deep chain overflows the analyzer)."""
    while len(conds) > 1:
        conds = [conds[i] | conds[i + 1] if i + 1 < len(conds) else conds[i] for i in range(0, len(conds), 2)]
    return conds[0]


def accepted_rows(loaded: DataFrame) -> DataFrame:
    return loaded.where(~F.col(BAD_COL)).drop(BAD_COL, CORRUPT_COL)


def load_metrics(loaded: DataFrame, table: str) -> DataFrame:
    """Accepted and failed rows of one load, row level, one pass."""
    return loaded.agg(
        F.count_if(~F.col(BAD_COL)).alias("rows_accepted"),
        F.count_if(F.col(BAD_COL)).alias("rows_failed"),
    ).select(F.lit(table).alias("table_name"), "rows_accepted", "rows_failed")
