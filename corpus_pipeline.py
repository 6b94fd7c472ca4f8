"""Corpus pipeline over ``documents``: each stage reads what its predecessor wrote.

1. quality rules: documents that fail the base rule or a certified cutoff go;
2. n-gram Jaccard join: one document of every near-duplicate class stays;
3. secret scan: secrets in the texts are replaced by a mask;
4. mixing: the rows are written in the order of the Pfair schedule of their
   sources (none is dropped);
5. BPE encoding: token ids of every text, with ``mix_position``: the place in
   the mix, read off the mixed files. The rows are written in this order.
   Spark packs files into tasks by size, so who reads the result in the order
   of the mix sorts by this column.

All stages but the last return the columns of ``documents``. What a stage
does with nulls, empty texts, repeats, empty tables and extra columns is
stated in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdclake.llm import bpe, ngram_jaccard, pfair_mix, quality_rules, secret_scan
from cdclake.llm.common import read_table, stage
from cdclake.llm.queries import VOCABULARY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.keep_first(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pfair_mix.in_order(docs)


def file_positions(docs: DataFrame) -> DataFrame:
    """``docs`` with ``mix_position``: 0, 1, ... over its files in the order of their part numbers, and the rows in them.

    For rows that don't come straight from files, increasing numbers in the
    order of the partitions.
    """
    if not docs._jdf.queryExecution().analyzed().children().isEmpty() or not docs.inputFiles():
        return docs.withColumn("mix_position", F.monotonically_increasing_id())
    rows = docs.withColumns({"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    counts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    part = F.expr(r"try_cast(regexp_extract(_file, '^part-([0-9]+)', 1) AS bigint)")
    # one row per file: a bounded window and broadcast
    before = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(F.broadcast(offsets), "_file")
    return placed.withColumn("mix_position", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = file_positions(docs).select("doc_id", "text", "mix_position")
    ordered = placed.repartitionByRange(parts, "mix_position").sortWithinPartitions("mix_position")
    return bpe.encode(ordered, VOCABULARY, keep=("mix_position",))


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("secret_scan", secret_stage),
    ("pfair_mix", mixing_stage),
    ("bpe_encoding", encoding_stage),
]

#: SQL can express neither the certified cutoffs nor the mixing and the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
