"""Streaming silver: change records upserted into keyed tables batch by batch.

Two ways, both driven by ``foreachBatch`` into a bucketed :class:`SnapshotTable`:

* :func:`stream_upserts` keeps, beside each row, where in the stream its last
  change stood and which batch brought it. A change is applied only if it is
  later than that, so batches may be replayed, or bring old changes late, and
  nothing is changed (not even a file is written).
* :func:`stream_latest` keeps the latest change of each key in Spark's state
  store (one ``max_by`` aggregation in update mode, one state row a key) and
  upserts the keys whose latest change is new. The target is never read for
  their positions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdclake.operators.cdc import OP_COL, POS_OFFSET, POS_PARTITION, TS_COL, latest_records, parse_envelopes
from cdclake.schemas import TOPIC_PREFIX, envelope_schema
from cdclake.session import staged
from cdclake.sinks.snapshots import SnapshotTable

#: The batch that brought a row's last change, and whether that was a delete.
BATCH_COL, DELETED_COL = "_cdc_batch", "_cdc_deleted"
POSITION = (TS_COL, POS_PARTITION, POS_OFFSET)
HELPERS = (*POSITION, BATCH_COL, DELETED_COL)


def _position(*columns: Column) -> Column:
    """Comparable place of a change in the stream: time, partition, offset; a missing one comes first."""
    return F.struct(*[F.coalesce(c.cast("long"), F.lit(-(1 << 63))) for c in columns])


def batch_changes(records: DataFrame, row: T.StructType, keys: Sequence[str], deletes: str = "ignore") -> DataFrame:
    """Latest change of each key of one batch of bronze rows, with its position and ``_cdc_deleted``.

    With ``deletes="ignore"`` delete events are dropped first; with
    ``"apply"`` a latest change that is a delete stays, as a row of the key
    only. Changes without a key are dropped: they can never be matched again.
    """
    apply = deletes == "apply"
    winners = latest_records(records, row, keys, deletes="keep" if apply else "ignore")
    rows = parse_envelopes(winners, row, keep_deletes=apply, keys=keys if apply else (), live_only=not apply)
    deleted = F.col(OP_COL) == "d" if apply else F.lit(False)
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.withColumn(DELETED_COL, deleted).drop(OP_COL)


def upsert_batch(table: SnapshotTable, changes: DataFrame, batch_id: int, keys: Sequence[str]) -> int:
    """Apply the changes that are later than what the table has; returns the number of buckets written.

    Deleted keys stay as marked rows, so a change from before the delete that
    comes late does not bring them back; :func:`current_rows` leaves them out.
    """
    marked = changes.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
    if table.exists():
        # positions of the keys that the batch has, from the buckets they are in; the semi join brings
        # them down to the size of the batch, which is small, and so broadcast, before the outer join
        stored = table.read_buckets_of(changes, keys).select(
            *[F.col(k).alias(f"_s_{k}") for k in keys], _position(*[F.col(c) for c in POSITION]).alias("_s_position")
        )
        same = [F.col(k) == F.col(f"_s_{k}") for k in keys]
        stored = stored.join(changes.select(*keys), same, "left_semi")
        later = F.col("_s_position").isNull() | (_position(*[F.col(c) for c in POSITION]) > F.col("_s_position"))
        marked = marked.join(stored, same, "left").where(later).select(*marked.columns)
    return table.upsert(marked, keys)


def current_rows(table: SnapshotTable) -> DataFrame:
    """The table's live rows, without the stream's own columns."""
    return table.read().where(~F.col(DELETED_COL)).drop(*HELPERS)


def _run(writer, checkpoint: str, interval: str | None, wait: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    query = writer.start()
    if wait:
        query.awaitTermination()
    return query


def stream_upserts(
    bronze: DataFrame,
    table: SnapshotTable,
    row: T.StructType,
    keys: Sequence[str],
    checkpoint: str,
    deletes: str = "ignore",
    interval: str | None = None,
    wait: bool = True,
    after_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Upsert a stream of bronze rows of one source table into ``table``.

    Each batch is read once, staged as its latest change per key.
    ``after_batch`` sees the staged changes and the batch id once they are in.
    """

    def apply(records: DataFrame, batch_id: int) -> None:
        changes = staged(batch_changes(records, row, keys, deletes), "stream-changes")
        upsert_batch(table, changes, batch_id, keys)
        if after_batch:
            after_batch(changes, batch_id)

    return _run(bronze.writeStream.foreachBatch(apply), checkpoint, interval, wait)


def bronze_table_stream(spark: SparkSession, bronze_root: str, table: str, max_per_trigger: int | None = None) -> DataFrame:
    """The landed bronze rows of one source table, as they come; other tables' folders are not read."""
    topic = table if table.startswith(TOPIC_PREFIX) else f"{TOPIC_PREFIX}{table}"
    reader = spark.readStream.schema("json_payload string, partition int, offset bigint, source_table string")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return reader.parquet(bronze_root).where(F.col("source_table") == topic)


def latest_stream(bronze: DataFrame, row: T.StructType, keys: Sequence[str], payload_col: str = "json_payload") -> DataFrame:
    """Streaming aggregation: the latest change text of each key, without a window.

    The state holds one row a key: its latest position, operation and payload
    text. Only the envelope's header is parsed here; the wide row is parsed
    from what the aggregation gives out.
    """
    key_schema = T.StructType([f for f in row.fields if f.name in keys])
    header = F.from_json(F.col(payload_col), envelope_schema(key_schema, key_schema))
    parsed = bronze.where(F.get_json_object(payload_col, "$.payload.op").isNotNull()).select(
        header.alias("_h"), payload_col, F.col("partition"), F.col("offset")
    )
    keyed = parsed.select(
        *[F.coalesce(F.col(f"_h.payload.after.{k}"), F.col(f"_h.payload.before.{k}")).alias(f"_k_{k}") for k in keys],
        _position(F.col("_h.payload.source.ts_ms"), F.col("partition"), F.col("offset")).alias("_at"),
        F.struct(payload_col, "partition", "offset").alias("_record"),
    )
    for k in keys:
        keyed = keyed.where(F.col(f"_k_{k}").isNotNull())
    return keyed.groupBy(*[f"_k_{k}" for k in keys]).agg(F.max_by("_record", "_at").alias("_record")).select("_record.*")


def stream_latest(
    bronze: DataFrame,
    table: SnapshotTable,
    row: T.StructType,
    keys: Sequence[str],
    checkpoint: str,
    interval: str | None = None,
    wait: bool = True,
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """The table of latest rows kept by the state store: update mode gives each batch's keys with their latest change.

    Deletes are applied: a key whose latest change is a delete leaves the table.
    """

    def apply(records: DataFrame, batch_id: int) -> None:
        rows = parse_envelopes(records, row, keep_deletes=True, keys=keys).drop(*POSITION)
        table.apply_changes(rows, keys)
        if after_batch:
            after_batch(batch_id)

    return _run(latest_stream(bronze, row, keys).writeStream.outputMode("update").foreachBatch(apply), checkpoint, interval, wait)
