"""The driver's test tables seen as the source database of the fraud lakehouse.

Every table here is a Spark derivation of the given parquet tables, so its
size grows with them:

* ``transaction`` = orders joined to their customer and nation
  (``o_orderkey`` is the transaction id and its second offset, ``o_custkey``
  the card, ``o_totalprice`` the amount, the priority the product code, the
  customer's nation and segment its address and e-mail domain);
* ``identity`` = the device of each order: the part of its first line item;
* ``user_activity`` = the ``events`` log as changes to one row per user
  (``error`` events are deletes, ``signup`` creates, the rest updates).

Change records carry the shape a relational change-capture connector
produces (``payload.after``, ``op``, ``source.ts_ms``), keyed per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions.decimal import encode_decimal
from cdclake.functions.timefn import epoch_millis
from cdclake.operators.aggregates import keep_one_per_key
from cdclake.schemas import TOPIC_PREFIX, TableSpec, struct

PARTITIONS = 3  # partitions per topic of the simulated change stream

# Order priority -> product code.
PRIORITY_TO_PRODUCT = {
    "1-URGENT": "H",
    "2-HIGH": "C",
    "3-MEDIUM": "W",
    "4-NOT SPECIFIED": "S",
    "5-LOW": "R",
}

ACTIVITY = TableSpec(
    "user_activity",
    ("user_id",),
    struct([("user_id", "long"), ("event_type", "string"), ("value", "double"), ("props", "string")]),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _product_code(c: Column) -> Column:
    m = F.create_map(*[x for kv in PRIORITY_TO_PRODUCT.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return m[c]


def source_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left").join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    return j.select(
        F.col("o_orderkey").alias("TransactionID"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("isFraud"),
        F.col("o_orderkey").alias("TransactionDT"),
        F.col("o_totalprice").alias("TransactionAmt"),
        _product_code(F.col("o_orderpriority")).alias("ProductCD"),
        F.col("o_custkey").alias("card1"),
        F.col("n_regionkey").cast("double").alias("card2"),
        F.col("c_nationkey").cast("double").alias("card3"),
        F.col("c_mktsegment").alias("card4"),
        F.when(F.col("c_acctbal") < 0, "debit").otherwise("credit").alias("card6"),
        F.col("c_nationkey").cast("double").alias("addr1"),
        F.col("n_regionkey").cast("double").alias("addr2"),
        F.concat(F.lower(F.col("c_mktsegment")), F.lit(".com")).alias("P_emaildomain"),
        F.col("o_orderdate").alias("_changed_at"),
    )


def source_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    # the first line of each order; line numbers repeat in the test data, so the
    # smaller part breaks ties (a rank-1 window: partial group limit before the shuffle)
    first = keep_one_per_key(li.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"],
                             [F.col("l_linenumber").asc(), F.col("l_partkey").asc()])
    first = first.select("l_orderkey", F.col("l_partkey").alias("_partkey"))
    j = first.join(p, first["_partkey"] == p["p_partkey"], "left")
    return j.select(
        F.col("l_orderkey").alias("TransactionID"),
        F.when(F.col("p_size") >= 25, "desktop").otherwise("mobile").alias("DeviceType"),
        F.col("p_name").alias("DeviceInfo"),
        F.col("p_brand").alias("id_30"),
        F.col("p_type").alias("id_31"),
        F.col("p_size").cast("string").alias("id_33"),
    )


def _records(rows: DataFrame, topic: str, key_cols: list[str], after_cols: list[Column],
             op: Column, ts_ms: Column, offset: Column) -> DataFrame:
    key = F.to_json(F.struct(*[F.col(k) for k in key_cols]))
    # a delete carries the row key in ``before`` and no ``after``
    before = F.when(op == "d", F.struct(*[F.col(k) for k in key_cols])).otherwise(F.lit(None))
    value = F.to_json(
        F.struct(
            F.struct(
                before.alias("before"),
                F.when(op == "d", F.lit(None)).otherwise(F.struct(*after_cols)).alias("after"),
                op.alias("op"),
                F.struct(ts_ms.alias("ts_ms")).alias("source"),
            ).alias("payload")
        )
    )
    return rows.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(f"{TOPIC_PREFIX}{topic}").alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(PARTITIONS)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
    )


def transaction_records(src_txn: DataFrame) -> DataFrame:
    """Each order is created with an unknown label (isFraud 0). Fulfilled orders get a later
    update: the whole row again, as the connector sends it, with the label, and with the card
    withheld (null). After the null fill all of these rows share card -1, a group holding
    about a third of the fact. Amounts travel as base64 NUMERIC(10,3)."""
    base = [c for c in src_txn.columns if c not in ("_changed_at", "isFraud", "TransactionAmt")]
    amt = encode_decimal("TransactionAmt", scale=3, nbytes=5).alias("TransactionAmt")
    ts = epoch_millis("_changed_at")
    create = _records(
        src_txn, "transaction", ["TransactionID"],
        [*[F.col(c) for c in base], amt, F.lit(0).alias("isFraud")],
        F.lit("c"), ts, F.col("TransactionID") * 2,
    )
    withheld = [F.lit(None).cast("long").alias(c) if c == "card1" else F.col(c) for c in base]
    update = _records(
        src_txn.where(F.col("isFraud") == 1), "transaction", ["TransactionID"],
        [*withheld, amt, F.lit(1).alias("isFraud")],
        F.lit("u"), ts + F.lit(86_400_000), F.col("TransactionID") * 2 + 1,
    )
    return create.unionByName(update)


def activity_op(event_type: Column) -> Column:
    return F.when(event_type == "error", "d").when(event_type == "signup", "c").otherwise("u")


def activity_records(spark: SparkSession, sf_dir: str, tombstones: bool = True) -> DataFrame:
    """``events`` as changes of a per-user row; a delete is followed by a tombstone (null value)."""
    return activity_records_from(table(spark, sf_dir, "events"), tombstones)


def activity_records_from(ev: DataFrame, tombstones: bool = True, more: list[Column] | None = None) -> DataFrame:
    """Change records of the given events; ``more`` are columns that their rows have beside the usual ones."""
    op = activity_op(F.col("event_type"))
    recs = _records(
        ev, ACTIVITY.name, ["user_id"],
        [F.col("user_id"), F.col("event_type"), F.col("value"), F.col("props"), *(more or [])],
        op, epoch_millis("ts"), F.col("event_id") * 2,
    )
    if not tombstones:
        return recs
    dels = ev.where(op == "d")
    key = F.to_json(F.struct("user_id"))
    tomb = dels.select(
        key.cast("binary").alias("key"),
        F.lit(None).cast("binary").alias("value"),
        F.lit(f"{TOPIC_PREFIX}{ACTIVITY.name}").alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(PARTITIONS)).cast("int").alias("partition"),
        (F.col("event_id") * 2 + 1).alias("offset"),
    )
    return recs.unionByName(tomb)


def dimension_records(name: str, rows: DataFrame, key_cols: list[str], offset: Column) -> DataFrame:
    """Initial snapshot of a dimension table: one create per row at time 0."""
    return _records(rows, name, key_cols, [F.col(c) for c in rows.columns], F.lit("r"), F.lit(0).cast("long"), offset)


def bronze_rows(records: DataFrame) -> DataFrame:
    """Batch stand-in for landed bronze rows (payload as text, position kept)."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("json_payload"),
        F.col("topic").alias("source_table"),
        "partition",
        "offset",
    )


ACTIVITY_SCHEMA: T.StructType = ACTIVITY.schema
