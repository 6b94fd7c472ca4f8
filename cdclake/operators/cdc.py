"""Change-envelope parsing, flattening and latest-row-per-key."""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.schemas import envelope_schema

TS_COL = "cdc_ts_ms"
POS_PARTITION = "_cdc_partition"
POS_OFFSET = "_cdc_offset"
OP_COL = "_cdc_op"
CORRUPT = "_corrupt_record"  # the JSON reader's column for texts that it cannot read as declared


def parse_envelopes(
    bronze: DataFrame,
    after: T.StructType,
    payload_col: str = "json_payload",
    keep_deletes: bool = False,
    keys: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    live_only: bool = False,
    present: Collection[str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Parse change envelopes with a declared row schema and flatten ``payload.after``.

    Output: the row columns, ``cdc_ts_ms`` and the stream position
    (``_cdc_partition``, ``_cdc_offset``) used to break ties. By default
    delete events are dropped here (``op != 'd'``); rows whose ``op`` is null
    (tombstones, unparsable text) are dropped as well, because the predicate
    is not true for them. With ``keep_deletes`` the delete events stay, their
    ``keys`` taken from ``payload.before`` (a delete has no ``after``).

    ``columns`` restricts parsing to those fields of the declared schema (the
    JSON parser then skips the rest). The op filter reads the text with
    ``get_json_object``, so the full parse runs once per kept row; a filter on
    the parsed struct would be pushed below the projection and parse twice.
    ``live_only`` says that the rows hold no deletes or tombstones any more
    (the winners of :func:`latest_records`), so their text is not read for it.
    ``present`` names the fields that the texts have (:func:`present_fields`):
    the others are null columns and cost the parser nothing per row, which it
    otherwise charges for every declared field. ``carry`` names columns of
    ``bronze`` that are returned after the row's.
    """
    if columns is not None:
        wanted = set(columns) | set(keys)
        after = T.StructType([f for f in after.fields if f.name in wanted])
    before = T.StructType([f for f in after.fields if f.name in keys])
    absent = set() if present is None else {f.name for f in after.fields} - set(present) - set(keys)
    read = T.StructType([f for f in after.fields if f.name not in absent])
    env = F.from_json(F.col(payload_col), envelope_schema(read, before))
    cols = bronze.columns
    pos = [
        (F.col("partition") if "partition" in cols else F.lit(None).cast("int")).alias(POS_PARTITION),
        (F.col("offset") if "offset" in cols else F.lit(None).cast("long")).alias(POS_OFFSET),
    ]
    op_text = F.get_json_object(F.col(payload_col), "$.payload.op")
    if live_only:
        kept = bronze
    else:
        kept = bronze.where(op_text.isNotNull()) if keep_deletes else bronze.where(op_text != "d")
    parsed = kept.select(env.alias("_env"), *pos, *carry)
    extra = [F.col("_env.payload.op").alias(OP_COL)] if keep_deletes else []
    row_cols = [
        F.lit(None).cast(f.dataType).alias(f.name) if f.name in absent else
        (F.coalesce(F.col(f"_env.payload.after.{f.name}"), F.col(f"_env.payload.before.{f.name}"))
         if f.name in keys else F.col(f"_env.payload.after.{f.name}")).alias(f.name)
        for f in after.fields
    ]
    return parsed.select(
        *row_cols,
        F.col("_env.payload.source.ts_ms").alias(TS_COL),
        POS_PARTITION,
        POS_OFFSET,
        *extra,
        *carry,
    )


def present_fields(bronze: DataFrame, after: T.StructType, payload_col: str = "json_payload") -> list[str]:
    """The fields of the declared row schema that any ``payload.after`` names, in the schema's order.

    One narrow pass over the texts, which should be stored ones; only field
    names come to the driver. If any text does not read as an envelope, all
    fields count as present: what a parser makes of it depends on the schema.
    """
    names = T.MapType(T.StringType(), T.StringType())
    shape = T.StructType([
        T.StructField("payload", T.StructType([T.StructField("after", names)])), T.StructField(CORRUPT, T.StringType()),
    ])
    env = F.from_json(F.col(payload_col), shape)
    declared = [f.name for f in after.fields]
    # null stands for an unreadable text
    named = F.when(F.col(f"_e.{CORRUPT}").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(F.map_keys("_e.payload.after"))
    found = bronze.select(env.alias("_e")).select(F.explode(named).alias("name")).distinct()
    found = {r["name"] for r in found.where(F.col("name").isNull() | F.col("name").isin(declared)).collect()}
    return declared if None in found else [n for n in declared if n in found]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    drop_helpers: bool = True,
) -> DataFrame:
    """Keep the newest row per key: ``row_number() over (partition by keys order by ts desc) = 1``.

    Ties on the change time are broken by the stream position, newest first.
    Spark plans a partial ``WindowGroupLimit`` before the shuffle, so each map
    task forwards at most one row per key: a key with a third of all changes
    does not become a third of one reduce task.
    """
    if order is None:
        order = [F.col(TS_COL).desc_nulls_last()]
        order += [F.col(c).desc_nulls_last() for c in (POS_PARTITION, POS_OFFSET) if c in df.columns]
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    if drop_helpers:
        out = out.drop(*[c for c in (POS_PARTITION, POS_OFFSET) if c in out.columns])
    return out


def latest_records(
    bronze: DataFrame,
    after: T.StructType,
    keys: Sequence[str],
    deletes: str = "ignore",
    payload_col: str = "json_payload",
    carry: Sequence[str] = (),
) -> DataFrame:
    """The bronze rows that hold the latest change of each key (still unparsed).

    Only a small header (keys, change time, op) is parsed to pick the winner;
    the shuffle moves the compact payload text, and the wide row schema is
    parsed afterwards for the winners alone. With ``deletes="ignore"`` deletes
    are dropped before the pick (a deleted key keeps its last live version);
    with ``"apply"`` a key whose latest change is a delete has no row; with
    ``"keep"`` that delete is returned (to be applied to a snapshot).
    ``carry`` names row columns that are parsed with the header and returned
    beside the payload, for readers that need only these.
    """
    if deletes not in ("ignore", "apply", "keep"):
        raise ValueError("deletes must be 'ignore', 'apply' or 'keep'")
    key_schema = T.StructType([f for f in after.fields if f.name in keys])
    carried = T.StructType([f for f in after.fields if f.name in keys or f.name in carry])
    fields = [*envelope_schema(carried, key_schema).fields, T.StructField(CORRUPT, T.StringType())]
    header = F.from_json(F.col(payload_col), T.StructType(fields))
    cols = bronze.columns
    h = bronze.select(
        header.alias("_h"),
        F.col(payload_col),
        (F.col("partition") if "partition" in cols else F.lit(None).cast("int")).alias("partition"),
        (F.col("offset") if "offset" in cols else F.lit(None).cast("long")).alias("offset"),
    )
    # changes that take no part come after all others and are dropped when they win: a filter here would be
    # pushed below the projections, and the text made (or read) and parsed a second time
    unread = F.get_json_object(F.col(payload_col), "$.payload.op")
    op = F.when(F.col(f"_h.{CORRUPT}").isNull(), F.col("_h.payload.op")).otherwise(unread)
    takes_part = F.coalesce(op != "d" if deletes == "ignore" else op.isNotNull(), F.lit(False))
    keyed = h.select(
        takes_part.alias("_takes_part"),
        *[F.coalesce(F.col(f"_h.payload.after.{k}"), F.col(f"_h.payload.before.{k}")).alias(f"_k_{k}") for k in keys],
        F.col("_h.payload.source.ts_ms").alias(TS_COL),
        F.col("_h.payload.op").alias(OP_COL),
        *[F.col(f"_h.payload.after.{c}").alias(c) for c in carry],
        payload_col, "partition", "offset",
    )
    order = [F.col(c).desc_nulls_last() for c in ("_takes_part", TS_COL, "partition", "offset")]
    winners = latest_per_key(keyed, [f"_k_{k}" for k in keys], order=order, drop_helpers=False).where("_takes_part")
    if deletes == "apply":
        winners = winners.where(F.col(OP_COL) != "d")
    return winners.select(payload_col, "partition", "offset", *carry)


def latest_changes(bronze: DataFrame, after: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The latest change per key, deletes included, flattened, with its op in ``_cdc_op``.

    A delete row carries only its key (taken from ``payload.before``).
    Feed it to :meth:`cdclake.sinks.snapshots.SnapshotTable.apply_changes`.
    """
    winners = latest_records(bronze, after, keys, deletes="keep")
    rows = parse_envelopes(winners, after, keep_deletes=True, keys=keys)
    return rows.drop(POS_PARTITION, POS_OFFSET, TS_COL)


def latest_state(
    bronze: DataFrame,
    after: T.StructType,
    keys: Sequence[str],
    deletes: str = "ignore",
    keep_ts: bool = False,
) -> DataFrame:
    """Current state of a table from its change stream: latest row per key, flattened.

    ``deletes="ignore"``: deletes are filtered before the latest row is
    picked, so a deleted key keeps its last live version (the behaviour of
    the jobs this replaces). ``deletes="apply"``: the latest event wins and
    keys whose latest event is a delete disappear.
    """
    rows = parse_envelopes(latest_records(bronze, after, keys, deletes), after, live_only=True)
    rows = rows.drop(POS_PARTITION, POS_OFFSET)
    return rows if keep_ts else rows.drop(TS_COL)


def infer_json_schema(df: DataFrame, col: str) -> T.StructType:
    """Schema merged over all JSON documents of a text column.

    One aggregation over the documents, no copy of the text: every document is
    parsed as a variant and the schemas are merged map-side. Numbers with a
    fraction become doubles, integers longs; a field that changes its type
    between documents is read as text. Text that is no JSON object counts for
    nothing.
    """
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(col).cast("string"))).alias("s")).first()
    return struct_of_variant_schema(merged["s"] if merged else None)


def struct_of_variant_schema(variant_schema: str | None) -> T.StructType:
    """``OBJECT<a: BIGINT, ...>`` as a struct type with the types of the JSON reader."""
    if not variant_schema or not variant_schema.startswith("OBJECT<"):
        return T.StructType([])
    ddl = variant_schema.replace("OBJECT<", "STRUCT<")
    ddl = re.sub(r"DECIMAL\(\d+, ?\d+\)|FLOAT", "DOUBLE", ddl)
    ddl = re.sub(r"(?<=[:<] )(VOID|VARIANT)|(?<=ARRAY<)(VOID|VARIANT)", "STRING", ddl)
    return T.StructType.fromDDL(f"s {ddl}")["s"].dataType


def schema_from_sample(spark: SparkSession, df: DataFrame, col: str) -> str | None:
    """DDL schema of the first non-null document (``schema_of_json`` on one sample)."""
    first = df.select(col).where(F.col(col).isNotNull()).first()
    if first is None:
        return None
    return spark.range(1).select(F.schema_of_json(F.lit(first[0]))).first()[0]
