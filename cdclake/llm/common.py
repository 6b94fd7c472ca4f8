"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdclake.session import scratch_path

#: Rows per Arrow batch handed to Python. Texts can be long, so batches stay small.
BATCH_ROWS = 1000
#: Bytes per Arrow batch, whatever the row count.
BATCH_BYTES = "16m"

WORD_CACHE_ENTRIES = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python worker: few rows and few bytes per Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_texts(df: DataFrame, make, schema: StructType | str, *columns: str) -> DataFrame:
    """``mapInArrow`` over ``columns`` only.

    ``make()`` runs once per task and returns a function from the columns'
    Python lists to a dict of output lists (or Arrow arrays).
    """
    small_batches(df.sparkSession)
    selected = df.select(*columns)
    out = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            got = work(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))
            arrays = [
                got[n] if isinstance(got[n], pa.Array) else pa.array(got[n], type=arrow.field(n).type) for n in names
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return selected.mapInArrow(run, out)


def nfc_lower(text: str) -> str:
    """NFC, then lower case character by character (no final-sigma rule)."""
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


def crc_fold(column, folds: int = 3):
    """crc32 of the id as text, modulo ``folds``: the fixed hold-out rule of the labelled queries."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(folds)


#: Ids of rows that have none: the last numbers there are, by the hash of the text.
_NO_ID = (1 << 63) - (1 << 40)


def known_id(id_col: str, text_col: str):
    """The id as bigint; rows without one get a number after all ids, the same for the same text."""
    late = F.lit((1 << 63) - 1) - F.pmod(F.xxhash64(F.col(f"`{text_col}`")), F.lit(1 << 40))
    return F.coalesce(F.col(f"`{id_col}`").cast("bigint"), late)


def given_id(column: str):
    """The id of :func:`known_id`; null again for rows that had none."""
    return F.when(F.col(column) < _NO_ID, F.col(column))


#: Rows of the id filter's table, at most; 64 bits each (4 MB in all), so it may be broadcast at any input size.
FILTER_WORDS = 1 << 18


def maybe_among(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``df`` with ``maybe``: false only for rows whose bigint ``key`` is certainly not in column ``key`` of ``ids``.

    A bitmap of the ids' hashes, of fixed size, is broadcast. Rows it rules out
    need no shuffle to be compared with the ids; the others still need the
    exact join. With more ids than bits it rules out little, and the join
    handles everything.
    """
    h = F.xxhash64(key, F.lit(29))
    word = F.pmod(h, F.lit(FILTER_WORDS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftrightunsigned(h, 40), F.lit(64)).cast("int"))
    bitmap = ids.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    joined = df.withColumn("_word", word).join(F.broadcast(bitmap), "_word", "left")
    hit = F.coalesce(F.col("_bits"), F.lit(0).cast("bigint")).bitwiseAND(bit) != 0
    return joined.withColumn("maybe", hit).drop("_word", "_bits")


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of ``key``, with the hash as column ``h``.

    A threshold from the row count thins the rows where they lie, so what
    meets in one task to be cut to ``rows`` is about ``1.2 * rows``, whatever
    the size of the input.
    """
    space = 1 << 40
    hashed = df.withColumn("h", F.pmod(F.xxhash64(key), F.lit(space)))
    n = df.count()
    if n > rows:
        hashed = hashed.where(F.col("h") < int(space * min(1.0, (1.2 * rows + 100) / n)))
    return hashed.orderBy("h", key).limit(rows)
