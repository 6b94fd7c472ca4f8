"""Change envelopes parsed once, as VARIANT: header, schema and rows are all taken from that one parse.

The text is parsed where it is read. The change's position and operation, the
key, the schema of tables without a declared one, and in the end the row
itself are taken from the parsed value by path, so no reader parses again and
a column that appears in a later change needs no new code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.operators.cdc import OP_COL, TS_COL, latest_per_key, struct_of_variant_schema

ENVELOPE = "_envelope"


def parse_once(bronze: DataFrame, payload_col: str = "json_payload") -> DataFrame:
    """``_envelope`` (VARIANT) and the stream position of every bronze row; text that is no JSON gives null."""
    cols = bronze.columns
    return bronze.select(
        F.try_parse_json(F.col(payload_col)).alias(ENVELOPE),
        (F.col("partition") if "partition" in cols else F.lit(None).cast("int")).alias("partition"),
        (F.col("offset") if "offset" in cols else F.lit(None).cast("long")).alias("offset"),
    )


def latest_envelopes(parsed: DataFrame, keys: Sequence[T.StructField], deletes: str = "ignore") -> DataFrame:
    """The envelopes that hold the latest change of each key (``keys``: its fields, with their types).

    ``deletes`` as in :func:`cdclake.operators.cdc.latest_records`.
    """
    if deletes not in ("ignore", "apply", "keep"):
        raise ValueError("deletes must be 'ignore', 'apply' or 'keep'")
    names = [f"_k_{f.name}" for f in keys]

    def header(envelope):
        def get(path: str, kind: str):
            return F.try_variant_get(envelope, f"$.payload.{path}", kind)

        key = [
            F.coalesce(get(f"after['{f.name}']", kind), get(f"before['{f.name}']", kind)).alias(n)
            for f, n in zip(keys, names, strict=True)
            for kind in [f.dataType.simpleString()]
        ]
        return F.struct(*key, get("source.ts_ms", "bigint").alias(TS_COL), get("op", "string").alias(OP_COL), envelope.alias(ENVELOPE))

    # a null operation (a tombstone, unreadable text) is no change
    wanted = (lambda h: h[OP_COL] != "d") if deletes == "ignore" else (lambda h: h[OP_COL].isNotNull())
    # a filter on the parsed column would be pushed below the parse and parse again; one inside a generator is not
    kept = F.explode_outer(F.filter(F.transform(F.array(ENVELOPE), header), wanted))
    keyed = parsed.select(kept.alias("_h"), "partition", "offset").where(F.col("_h").isNotNull()).select("_h.*", "partition", "offset")
    order = [F.col(c).desc_nulls_last() for c in (TS_COL, "partition", "offset")]
    latest = latest_per_key(keyed, names, order=order, drop_helpers=False)
    return latest.where(F.col(OP_COL) != "d") if deletes == "apply" else latest


def row_schema(parsed: DataFrame) -> T.StructType:
    """Schema merged over the rows of all envelopes, in one aggregation; only the schema comes to the driver."""
    after = F.try_variant_get(F.col(ENVELOPE), "$.payload.after", "variant")
    merged = parsed.agg(F.schema_of_variant_agg(after).alias("s")).first()
    return struct_of_variant_schema(merged["s"] if merged else None)


def rows_of(envelopes: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of the envelopes, flattened; a value that does not fit its type is null."""
    fields = [
        F.try_variant_get(F.col(ENVELOPE), f"$.payload.after['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in schema.fields
    ]
    return envelopes.select(*fields)


def latest_rows(bronze: DataFrame, key: Sequence[str], deletes: str = "ignore", schema: T.StructType | None = None) -> DataFrame:
    """Current rows of a table from its change records. Without a ``schema`` it is that of the records themselves."""
    parsed = parse_once(bronze)
    schema = schema or row_schema(parsed)
    return rows_of(latest_envelopes(parsed, [schema[k] for k in key], deletes), schema)
