"""Query catalog: each entry runs one operator (or job) of the library over the driver's
test tables and returns a DataFrame whose columns match its SQL oracle.

Doubles derived by arithmetic are rounded in the *reported* columns only,
so that Spark and the oracle agree to the last printed digit.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions.decimal import decode_decimal, encode_decimal
from cdclake.functions.strings import email_local_part, falsy_default, truncate
from cdclake.functions.timefn import seconds_after
from cdclake.operators import aggregates as agg
from cdclake.operators import entities as ent
from cdclake.operators import quality as dq
from cdclake.operators.cdc import (
    POS_OFFSET,
    TS_COL,
    infer_json_schema,
    latest_changes,
    latest_state,
    parse_envelopes,
    present_fields,
    schema_from_sample,
)
from cdclake.operators.moments import GroupStatistics, zscore_from_moments
from cdclake.operators.gold import FACT_COLUMNS, FACT_FIELDS, build_gold, card_profile, device_profile, location_profile
from cdclake.operators.heavy import HEAVY_SHARE
from cdclake.operators.shaping import apply_defaults
from cdclake.operators.variant import latest_rows
from cdclake.plans import roles
from cdclake.plans.jobs import (
    Entities,
    Layout,
    build_silver_dimensions,
    colocate,
    latest_transactions,
    load_source_table,
    run_all,
    silver_fact,
    silver_table,
)
from cdclake.schemas import BRONZE_TABLES, TABLES, TOPIC_PREFIX
from cdclake.session import scratch_path, staged
from cdclake.sinks.export import export_parquet, materialize, refresh_serving
from cdclake.sinks.snapshots import SnapshotTable, upsert_frames
from cdclake.sources import csv as csvsrc
from cdclake.sources import seeds
from cdclake.sources.bronze import read_bronze_table
from cdclake.streaming.bronze import change_stream, land_bronze, to_bronze
from cdclake.streaming.silver import bronze_table_stream, current_rows, stream_latest, stream_upserts, upsert_batch

Query = Callable[[SparkSession, str], DataFrame]

# Batch boundaries used to split a table into two arrivals.
ACTIVITY_SECOND_BATCH_FROM = "2024-01-16 00:00:00"
ORDERS_SECOND_BATCH_FROM = "1998-01-01 00:00:00"
TRAIN_BEFORE = "1999-01-01 00:00:00"


def _r(c, n: int = 4):
    # Reported rounding: floor(x * 10^n + 0.501) / 10^n. The same IEEE steps in every
    # engine; the small guard puts exact half-way averages (common for cent amounts)
    # on one side even when two engines' sums differ in the last bit.
    scale = 10**n
    return F.floor(c * F.lit(float(scale)) + F.lit(0.501)) / F.lit(float(scale)) + F.lit(0.0)


def _t(spark, d, name):
    return roles.table(spark, d, name)


# ---------------------------------------------------------------- shared derivations
def src_txn(spark, d):
    return roles.source_transaction(spark, d)


def txn_bronze(spark, d):
    return roles.bronze_rows(roles.transaction_records(src_txn(spark, d)))


def activity_bronze(spark, d, tombstones=True):
    return roles.bronze_rows(roles.activity_records(spark, d, tombstones))


def silver_txn(spark, d):
    return silver_fact(txn_bronze(spark, d))


def latest_txn(spark, d):
    return latest_transactions(txn_bronze(spark, d))


def entities(spark, d) -> Entities:
    return Entities(src_txn(spark, d), roles.source_identity(spark, d))


def change_log(spark, d) -> DataFrame:
    """Change records of every source table (the full stream a connector would emit)."""
    e = entities(spark, d)
    recs = [
        roles.transaction_records(e.txn),
        roles.activity_records(spark, d),
        roles.dimension_records("identity", e.identity, ["TransactionID"], F.col("TransactionID")),
        roles.dimension_records("user_profile", e.users, ["client_no"], F.col("client_no").cast("long")),
        roles.dimension_records("user_accounts", e.accounts, ["account_number"], F.col("account_number").cast("long")),
        roles.dimension_records("master_card", e.master_card, ["Card_Key"], F.col("Card_Key")),
        roles.dimension_records("card_issuing_bank", e.banks, ["Bank_ID"], F.col("Bank_ID")),
        roles.dimension_records("description_card", e.networks, ["Card_Network_ID"], F.col("Card_Network_ID")),
        roles.dimension_records("device_fingerprint", e.devices, ["Device_ID"], F.col("Device_ID")),
        roles.dimension_records("location", e.location, ["LocationID"], F.col("LocationID")),
        roles.dimension_records("product_description", seeds.product_description(spark), ["ProductCD"], F.lit(0)),
        roles.dimension_records("status", seeds.status(spark), ["StatusID"], F.col("StatusID")),
        roles.dimension_records("blacklist_rules", seeds.blacklist_rules(spark), ["Rule_ID"], F.col("Rule_ID")),
    ]
    out = recs[0]
    for r in recs[1:]:
        out = out.unionByName(r)
    return out


# ---------------------------------------------------------------- functions / projections
def q_decimal_decode(spark, d):
    t = src_txn(spark, d).select("TransactionID", encode_decimal("TransactionAmt").alias("_b64"))
    return t.select("TransactionID", _r(decode_decimal("_b64"), 3).alias("TransactionAmt"))


def q_decimal_wide(spark, d):
    """Values of more than 8 bytes, and negative ones."""
    c = _t(spark, d, "customer").select(
        "c_custkey",
        encode_decimal("c_acctbal", nbytes=12).alias("_signed"),
        encode_decimal(F.abs("c_acctbal"), nbytes=20).alias("_wide"),
    )
    return c.select(
        "c_custkey",
        _r(decode_decimal("_signed", signed=True), 3).alias("balance"),
        _r(decode_decimal("_wide"), 3).alias("magnitude"),
    )


def q_interval_time(spark, d):
    return src_txn(spark, d).select("TransactionID", seconds_after("TransactionDT").alias("Transaction_Time"))


def q_cast_defaults(spark, d):
    o = _t(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.coalesce(F.col("o_orderpriority").try_cast("int"), F.lit(0)).alias("priority_int"),
        F.coalesce(F.substring("o_orderpriority", 1, 1).try_cast("int"), F.lit(0)).alias("priority_rank"),
        F.col("o_custkey").cast("string").alias("card_text"),
        falsy_default(F.regexp_replace("o_orderpriority", r"^[0-9]-", ""), "debit").alias("priority_name"),
    )


def q_string_shape(spark, d):
    c = _t(spark, d, "customer")
    return c.select(
        "c_custkey",
        truncate("c_name", 12).alias("name_short"),
        email_local_part(F.concat_ws(" ", "c_mktsegment", "c_name")).alias("email_local"),
        F.trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("segment"),
        F.substring("c_name", 1, 100).alias("name_preview"),
    )


def q_seed_lookup(spark, d):
    t = src_txn(spark, d).select("TransactionID", "ProductCD")
    # an inline VALUES table of known size: the planner's size check broadcasts it
    j = t.join(seeds.product_description(spark), "ProductCD", "left")
    return j.select("TransactionID", "ProductCD", F.coalesce("ProductDesc", F.lit("Unknown")).alias("ProductDesc"))


def q_preview_limit(spark, d):
    s = latest_txn(spark, d)
    return s.orderBy(F.col("TransactionAmt").desc(), F.col("TransactionID").asc()).limit(10).select(
        "TransactionID", _r(F.col("TransactionAmt"), 3).alias("TransactionAmt"), "isFraud"
    )


# ---------------------------------------------------------------- change data
def q_cdc_flatten(spark, d):
    rows = parse_envelopes(activity_bronze(spark, d), roles.ACTIVITY_SCHEMA)
    return rows.select("user_id", "event_type", "value", "props", TS_COL, F.col(POS_OFFSET).alias("change_offset"))


def q_cdc_latest(spark, d):
    return latest_state(activity_bronze(spark, d), roles.ACTIVITY_SCHEMA, ["user_id"], keep_ts=True)


def q_cdc_latest_apply(spark, d):
    return latest_state(activity_bronze(spark, d), roles.ACTIVITY_SCHEMA, ["user_id"], deletes="apply", keep_ts=True)


def _mixed_props(spark, d):
    """``props`` where every third document has a second key, and every fifth a fraction."""
    more = F.concat(F.expr("left(props, length(props) - 1)"), F.lit(', "tag": "'), F.col("event_type"), F.lit('"}'))
    half = F.concat(F.expr("left(props, length(props) - 1)"), F.lit(', "w": 0.5}'))
    mixed = F.when(F.col("event_id") % 3 == 0, more).when(F.col("event_id") % 5 == 0, half).otherwise(F.col("props"))
    return _t(spark, d, "events").select("event_id", mixed.alias("props"))


def q_json_inferred(spark, d):
    ev = _mixed_props(spark, d)
    schema = infer_json_schema(ev, "props")
    return ev.select("event_id", F.from_json("props", schema).alias("p")).select("event_id", "p.k", "p.tag", "p.w")


def q_json_sample_schema(spark, d):
    ev = _t(spark, d, "events")
    ddl = schema_from_sample(spark, ev, "props")
    return ev.select("event_id", F.from_json("props", ddl).alias("p")).select("event_id", "p.*")


def q_wide_schema(spark, d):
    schema = TABLES["transaction"].schema
    bronze = staged(txn_bronze(spark, d).select("json_payload"), "bronze")
    rows = parse_envelopes(bronze, schema, present=present_fields(bronze, schema))
    names = [f.name for f in TABLES["transaction"].schema.fields]
    counts = rows.agg(*[F.count(F.col(n)).alias(n) for n in names])
    stacked = ", ".join(f"'{n}', `{n}`" for n in names)
    return counts.selectExpr(f"stack({len(names)}, {stacked}) as (field_name, n_nonnull)")


def q_fill_nulls(spark, d):
    s = latest_txn(spark, d)
    return s.select("TransactionID", _r(F.col("TransactionAmt"), 3).alias("TransactionAmt"), "card1")


def q_zscore(spark, d):
    s = silver_txn(spark, d)
    return s.select(
        "TransactionID", "card1", _r(F.col("TransactionAmt"), 3).alias("TransactionAmt"),
        _r(F.col("avg_amt")).alias("avg_amt"), _r(F.col("std_amt")).alias("std_amt"), _r(F.col("z_score")).alias("z_score"),
    )


def q_zscore_incremental(spark, d):
    """The change log in two arrivals: the second one takes back what it changes and reads no old transaction."""
    bronze = staged(txn_bronze(spark, d), "bronze")
    ts = F.get_json_object("json_payload", "$.payload.source.ts_ms").cast("long")
    # never null, so that no change is in neither
    first = F.coalesce(ts < F.unix_millis(F.lit(TRAIN_BEFORE).cast("timestamp")), F.lit(True))
    columns = ("TransactionID", "card1", "TransactionAmt")
    root = scratch_path(spark, "card-statistics")
    cards = GroupStatistics(spark, f"{root}/statistics", ["TransactionID"], "card1", "TransactionAmt")
    fact = SnapshotTable(spark, f"{root}/fact", use_delta=False)
    for arrival, changes in enumerate((bronze.where(first), bronze.where(~first))):
        rows = staged(latest_transactions(changes, columns=columns).select(*columns), "arrived")
        cards.update(rows, arrival)
        fact.upsert(rows, ["TransactionID"])
    s = zscore_from_moments(fact.read(), cards.states(), "card1", "TransactionAmt")
    return s.select(
        "TransactionID", "card1", _r(F.col("TransactionAmt"), 3).alias("TransactionAmt"),
        _r(F.col("avg_amt")).alias("avg_amt"), _r(F.col("std_amt")).alias("std_amt"), _r(F.col("z_score")).alias("z_score"),
    )


def q_silver_fact(spark, d):
    s = silver_txn(spark, d)
    rounded = {"TransactionAmt": 3, "avg_amt": 4, "std_amt": 4, "z_score": 4}
    return s.select(*[(_r(F.col(c), rounded[c]).alias(c) if c in rounded else F.col(c)) for c in s.columns])


def q_dedup_metrics(spark, d):
    rows = parse_envelopes(txn_bronze(spark, d), TABLES["transaction"].schema, columns=["TransactionID"])
    return agg.dedup_metrics(rows, "TransactionID")


def _split_activity(spark, d):
    earlier, later = _split_activity_events(spark, d)
    return roles.bronze_rows(roles.activity_records_from(earlier)), roles.bronze_rows(roles.activity_records_from(later))


def _split_activity_events(spark, d):
    """The event log as two arrivals in time, every event in one of them. All events of every seventh
    user are in the first arrival, those of the next one in the second, so matched, kept and new keys all occur."""
    ev = _t(spark, d, "events")
    cut = F.lit(ACTIVITY_SECOND_BATCH_FROM).cast("timestamp_ntz")
    group = F.col("user_id") % 7
    # never null, so that no event is in neither
    first = F.coalesce(F.when(group == 0, F.lit(True)).when(group == 1, F.lit(False)).otherwise(F.col("ts") < cut), F.lit(False))
    return ev.where(first), ev.where(~first)


def q_upsert_merge(spark, d):
    b1, b2 = _split_activity(spark, d)
    spec = roles.ACTIVITY
    t1 = latest_state(b1, spec.schema, spec.key)
    t2 = latest_state(b2, spec.schema, spec.key)
    return upsert_frames(t1, t2, spec.key)


def q_upsert_roundtrip(spark, d):
    b1, b2 = _split_activity(spark, d)
    spec = roles.ACTIVITY
    table = SnapshotTable(spark, scratch_path(spark, "silver-activity"), use_delta=False)
    table.upsert(latest_state(b1, spec.schema, spec.key), spec.key)  # first write: create
    table.upsert(latest_state(b2, spec.schema, spec.key), spec.key)  # then merge
    return table.read()


def q_upsert_apply_deletes(spark, d):
    """Two arrivals applied with deletes: a key whose latest change is a delete leaves the table."""
    earlier, later = _split_activity(spark, d)
    spec = roles.ACTIVITY
    table = SnapshotTable(spark, scratch_path(spark, "silver-activity-cdc"), use_delta=False)
    table.apply_changes(latest_changes(earlier, spec.schema, spec.key), spec.key)
    table.apply_changes(latest_changes(later, spec.schema, spec.key), spec.key)
    return table.read()


def q_silver_dim(spark, d):
    root = scratch_path(spark, "lake")
    layout = Layout(root)
    activity_bronze(spark, d).write.partitionBy("source_table").parquet(layout.bronze)
    status = build_silver_dimensions(spark, layout, tables=("user_activity",), specs={"user_activity": roles.ACTIVITY})
    if status.get("user_activity") != "ok":
        raise RuntimeError(f"silver dimension job failed: {status}")
    return SnapshotTable(spark, layout.silver("user_activity")).read()


def q_silver_dim_inferred(spark, d):
    """A dimension whose schema is inferred from its change envelopes, not declared."""
    b = activity_bronze(spark, d)
    out = silver_table(b, roles.ACTIVITY, schema="infer")
    return out.select("user_id", "event_type", "value", "props")


def q_silver_variant(spark, d):
    """Two arrivals, the second with a column the first does not know: it is inferred, upserted and reaches the table."""
    earlier, later = _split_activity_events(spark, d)
    spec = roles.ACTIVITY
    table = SnapshotTable(spark, scratch_path(spark, "silver-variant"), use_delta=False)
    table.upsert(latest_rows(roles.bronze_rows(roles.activity_records_from(earlier)), spec.key), spec.key)
    channel = F.concat(F.col("event_type"), F.lit("-2")).alias("channel")
    table.upsert(latest_rows(roles.bronze_rows(roles.activity_records_from(later, more=[channel])), spec.key), spec.key)
    return table.read().select("user_id", "event_type", "value", "props", "channel")


# ---------------------------------------------------------------- entities
def q_user_entities(spark, d):
    return ent.resolve_users(src_txn(spark, d))


def q_account_numbers(spark, d):
    t = src_txn(spark, d)
    return ent.assign_accounts(t, ent.number_clients(t))


def q_account_numbers_long_domain(spark, d):
    """Domains that differ only after the profile column's 100 characters."""
    t = src_txn(spark, d).withColumn("P_emaildomain", F.concat(F.lit("sub." * 30), "P_emaildomain"))
    return ent.assign_accounts(t, ent.number_clients(t))


def q_card_links(spark, d):
    return entities(spark, d).master_card


def q_dim_location(spark, d):
    return ent.derive_location(src_txn(spark, d))


def q_dim_bank(spark, d):
    return ent.derive_banks(src_txn(spark, d))


def q_dim_network(spark, d):
    return ent.derive_networks(src_txn(spark, d))


def q_dim_device(spark, d):
    return ent.derive_devices(roles.source_identity(spark, d))


def q_column_defaults(spark, d):
    users = ent.resolve_users(src_txn(spark, d))
    full = apply_defaults(users, TABLES["user_profile"], skip=("created_at",))
    return full.select("client_no", "identity_type", F.col("kyc_level").cast("int").alias("kyc_level"), "status", "created_by")


def q_insert_if_absent(spark, d):
    t = src_txn(spark, d)
    first = t.where(F.col("_changed_at") < F.lit(ORDERS_SECOND_BATCH_FROM).cast("timestamp_ntz"))
    table = SnapshotTable(spark, scratch_path(spark, "banks"), use_delta=False)
    table.overwrite(ent.derive_banks(first))
    # the second arrival offers another country for every bank: only new banks may take it
    new_rows = ent.derive_banks(t).withColumn("Bank_Country_Code", F.col("Bank_Country_Code") + 100)
    table.insert_if_absent(new_rows, ["Bank_ID"])
    return table.read()


# ---------------------------------------------------------------- joins and aggregates
def q_join_left_agg(spark, d):
    c = _t(spark, d, "customer")
    o = _t(spark, d, "orders")
    a = agg.max_per_key(o, "o_custkey", {"o_orderkey": "max_orderkey", "o_totalprice": "max_totalprice"})
    j = c.join(a, c["c_custkey"] == a["o_custkey"], "left")
    return j.select(
        "c_custkey",
        F.coalesce("max_orderkey", F.lit(0)).alias("max_orderkey"),
        F.coalesce("max_totalprice", F.lit(0.0)).alias("max_totalprice"),
    )


def q_join_left_cond(spark, d):
    c = _t(spark, d, "customer")
    n = _t(spark, d, "nation")
    j = c.join(n, (c["c_nationkey"] == n["n_nationkey"]) & (n["n_regionkey"] == F.lit(1)), "left")
    return j.select("c_custkey", F.coalesce("n_name", F.lit("Unknown")).alias("n_name"))


def q_join_left_distinct(spark, d):
    s = _t(spark, d, "supplier")
    segs = _t(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    j = s.join(segs, s["s_nationkey"] == segs["c_nationkey"], "left")
    return j.select("s_suppkey", F.coalesce("c_mktsegment", F.lit("Unknown")).alias("mktsegment"))


def q_join_semi(spark, d):
    li = _t(spark, d, "lineitem")
    s = _t(spark, d, "supplier").where(F.col("s_acctbal") > 0)
    return li.join(s, li["l_suppkey"] == s["s_suppkey"], "left_semi").select("l_orderkey", "l_linenumber", "l_suppkey")


def q_card_dedup_max(spark, d):
    li = _t(spark, d, "lineitem")
    return agg.max_per_key(li, "l_partkey", {"l_orderkey": "max_orderkey", "l_suppkey": "max_suppkey", "l_linenumber": "max_linenumber"})


def q_distinct_pairs(spark, d):
    return agg.distinct_rows(_t(spark, d, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"])


def q_drop_duplicates(spark, d):
    li = _t(spark, d, "lineitem")
    # line numbers repeat: the other columns make the order total
    order = [F.col(c).asc() for c in ("l_linenumber", "l_partkey", "l_quantity", "l_suppkey")]
    one = agg.keep_one_per_key(li, ["l_orderkey"], order)
    return one.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


# ---------------------------------------------------------------- gold and serving
def gold_frame(spark, d, **heavy) -> DataFrame:
    with ThreadPoolExecutor(max_workers=2) as pool:
        fact = pool.submit(lambda: silver_fact(txn_bronze(spark, d), columns=FACT_FIELDS))
        e = entities(spark, d)
        s = fact.result()
    if heavy:
        s = staged(s.select(*FACT_COLUMNS), "silver-fact")
    return build_gold(
        s, seeds.product_description(spark), e.master_card, e.banks, e.networks, e.users, e.accounts,
        e.identity, e.devices, e.location, unique_ids=True, **heavy,
    )


def q_card_profile(spark, d):
    e = entities(spark, d)
    cards = card_profile(e.master_card, e.banks, e.networks, e.users, e.accounts)
    return cards.select("Card_Raw_ID", "client_no", "account_number", "account_status", "Bank_ID", "Network_Name", "Card_Type")


def q_device_profile(spark, d):
    e = entities(spark, d)
    return device_profile(e.identity, e.devices)


def q_location_profile(spark, d):
    """Locations with a region from their nation: the smallest (region, country) of an addr1."""
    n = _t(spark, d, "nation").select(
        F.col("n_regionkey").cast("double").alias("addr1"), F.lit(None).cast("double").alias("addr2"),
        F.concat(F.lit("R"), F.col("n_regionkey")).alias("Region"), F.col("n_name").alias("Country"),
    )
    return location_profile(n)


def q_gold_master(spark, d):
    g = gold_frame(spark, d)
    return g.withColumn("z_score", _r(F.col("z_score"))).withColumn("TransactionAmt", _r(F.col("TransactionAmt"), 3))


def q_gold_heavy_cards(spark, d):
    """Gold as for a card profile of any size: the cards that hold a hundredth of the fact each are joined by
    broadcast, the others on their own."""
    g = gold_frame(spark, d, heavy_share=HEAVY_SHARE, profile_limit=0)
    return g.withColumn("z_score", _r(F.col("z_score"))).withColumn("TransactionAmt", _r(F.col("TransactionAmt"), 3))


def q_gold_colocated(spark, d):
    """Gold from bucketed copies of the fact and of identity, joined bucket by bucket."""
    with ThreadPoolExecutor(max_workers=2) as pool:
        fact = pool.submit(lambda: silver_fact(txn_bronze(spark, d), columns=FACT_FIELDS))
        e = entities(spark, d)
        s, identity = colocate(fact.result(), e.identity, Layout(scratch_path(spark, "lake")))
    g = build_gold(
        s, seeds.product_description(spark), e.master_card, e.banks, e.networks, e.users, e.accounts,
        identity, e.devices, e.location, unique_ids=True, heavy_share=HEAVY_SHARE, colocated=True,
    )
    return g.withColumn("z_score", _r(F.col("z_score"))).withColumn("TransactionAmt", _r(F.col("TransactionAmt"), 3))


def q_medallion_gold(spark, d):
    """The whole run: stream the change log to bronze, build silver dimensions and the
    silver fact (two concurrent jobs), gold, export, serving refresh; read the served table."""
    layout = Layout(scratch_path(spark, "lake"))
    src_dir = f"{layout.root}/source/records"
    change_log(spark, d).write.parquet(src_dir)

    def land():
        land_bronze(to_bronze(change_stream(spark, files_dir=src_dir)), layout.bronze, layout.bronze_checkpoint)

    run_all(spark, layout, land=land)
    g = SnapshotTable(spark, layout.serving, use_delta=False).read()
    return g.withColumn("z_score", _r(F.col("z_score"))).withColumn("TransactionAmt", _r(F.col("TransactionAmt"), 3))


def _narrow_fact(spark, d):
    s = latest_txn(spark, d)
    return s.select("TransactionID", _r(F.col("TransactionAmt"), 3).alias("TransactionAmt"), "isFraud", "card1")


def q_materialize_roundtrip(spark, d):
    root = scratch_path(spark, "gold")
    back = materialize(_narrow_fact(spark, d), f"{root}/temp")
    export_parquet(back, f"{root}/export")
    return spark.read.parquet(f"{root}/export")


def q_serving_refresh(spark, d):
    root = scratch_path(spark, "serve")
    export_parquet(_narrow_fact(spark, d), f"{root}/export")
    refresh_serving(spark, f"{root}/export", f"{root}/serving")
    refresh_serving(spark, f"{root}/export", f"{root}/serving")  # a second full refresh replaces, never adds
    return SnapshotTable(spark, f"{root}/serving", use_delta=False).read()


def q_append_table(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cut = F.lit(ORDERS_SECOND_BATCH_FROM).cast("timestamp_ntz")
    table = SnapshotTable(spark, scratch_path(spark, "orders-append"), use_delta=False)
    table.append(o.where(F.col("o_orderdate") < cut))
    table.append(o.where(F.col("o_orderdate") >= cut))
    return table.read().select("o_orderkey", "o_custkey", "o_totalprice")


# ---------------------------------------------------------------- CSV sources
_ORDERS_CSV_SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"


def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "orders-csv")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    o.write.option("header", True).csv(path)
    return csvsrc.read_csv(spark, path, T.StructType.fromDDL(_ORDERS_CSV_SCHEMA))


def q_normalize_columns(spark, d):
    path = scratch_path(spark, "customer-csv")
    c = _t(spark, d, "customer")
    c.toDF(*[f"{n.replace('_', '-')} " for n in c.columns]).write.option("header", True).csv(path)
    schema = _t(spark, d, "customer").schema
    loaded = csvsrc.load_files(spark, [path], schema)
    return csvsrc.accepted_rows(loaded).drop(csvsrc.RANK_COL)


def _train_test_files(spark, d):
    root = scratch_path(spark, "raw")
    t = src_txn(spark, d)
    cut = F.lit(TRAIN_BEFORE).cast("timestamp_ntz")
    cols = ["TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "card1"]
    t.where(F.col("_changed_at") < cut).select(*cols, "isFraud").write.option("header", True).csv(f"{root}/train_transaction.csv")
    t.where(F.col("_changed_at") >= cut).select(*cols).write.option("header", True).csv(f"{root}/test_transaction.csv")
    return root


def q_union_train_test(spark, d):
    root = _train_test_files(spark, d)
    files = [f"{root}/test_transaction.csv", f"{root}/missing_transaction.csv", f"{root}/train_transaction.csv"]
    loaded = csvsrc.load_files(spark, files, TABLES["transaction"].schema)
    return csvsrc.accepted_rows(loaded).select("TransactionID", "isFraud", csvsrc.RANK_COL)


def q_load_metrics(spark, d):
    path = scratch_path(spark, "customer-export")
    c = _t(spark, d, "customer")
    # a locale-formatted export: thousands separators make some balances unreadable as numbers
    c.withColumn("c_acctbal", F.format_number("c_acctbal", 2)).write.option("header", True).csv(path)
    root = scratch_path(spark, "load-customer")
    target = SnapshotTable(spark, f"{root}/table", use_delta=False)
    return load_source_table(spark, "customer", [path], c.schema, target, quarantine_path=f"{root}/quarantine")


def q_load_ragged(spark, d):
    """Rows with a field too few or too many are quarantined; a quoted field may hold a line break and quotes."""
    c = _t(spark, d, "customer")
    kind = F.col("c_custkey") % 10
    fields = F.concat_ws(",", "c_custkey", F.when(kind == 2, F.concat(F.lit('"a ""b""\n'), F.col("c_name"), F.lit('"'))).otherwise(F.col("c_name")), "c_nationkey")
    balance = F.when(kind == 3, "NA").otherwise(F.col("c_acctbal").cast("string"))
    line = F.when(kind == 0, fields).when(kind == 1, F.concat_ws(",", fields, balance, "c_mktsegment", F.lit("x")))
    lines = c.select(line.otherwise(F.concat_ws(",", fields, balance, "c_mktsegment")).alias("value"))
    header = ",".join(c.columns)

    def with_header(batches):  # the first line of every file
        for i, batch in enumerate(batches):
            if i == 0:
                yield pa.RecordBatch.from_pydict({"value": [header]}, schema=batch.schema)
            yield batch

    root = scratch_path(spark, "load-ragged")
    lines.mapInArrow(with_header, "value string").write.text(f"{root}/customer.csv")
    target = SnapshotTable(spark, f"{root}/table", use_delta=False)
    load_source_table(spark, "customer", [f"{root}/customer.csv"], c.schema, target, quarantine_path=f"{root}/quarantine")
    return target.read().select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


# ---------------------------------------------------------------- streaming bronze
def _land(spark, records: DataFrame, root: str, runs: int = 1) -> str:
    """Land the records in about four micro-batches, whatever the number of files."""
    src_dir, out, ckpt = f"{root}/records", f"{root}/bronze", f"{root}/checkpoint"
    records.write.parquet(src_dir)
    per_trigger = max(1, len(spark.read.parquet(src_dir).inputFiles()) // 4)
    for _ in range(runs):
        raw = change_stream(spark, files_dir=src_dir, max_per_trigger=per_trigger)
        land_bronze(to_bronze(raw), out, ckpt)
    return out


def q_bronze_stream(spark, d):
    out = _land(spark, change_log(spark, d), scratch_path(spark, "bronze"))
    return spark.read.parquet(out).groupBy("source_table").agg(F.count(F.lit(1)).alias("n_rows"))


def _small_log(spark, d):
    return roles.transaction_records(src_txn(spark, d)).unionByName(roles.activity_records(spark, d))


def q_bronze_restart(spark, d):
    out = _land(spark, _small_log(spark, d), scratch_path(spark, "bronze"), runs=2)
    return spark.read.parquet(out).groupBy("source_table").agg(F.count(F.lit(1)).alias("n_rows"))


def q_bronze_audit(spark, d):
    out = _land(spark, _small_log(spark, d), scratch_path(spark, "bronze"))
    b = spark.read.parquet(out)
    return b.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("status") == "SUCCESS").alias("n_success"),
        F.count("ingestion_time").alias("n_ingestion_time"),
        F.count_distinct("job_start_time").alias("n_job_start"),
    )


def q_bronze_partition_read(spark, d):
    out = _land(spark, _small_log(spark, d), scratch_path(spark, "bronze"))
    b = read_bronze_table(spark, out, "user_activity")
    return b.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("kafka_key").alias("n_keys"),
        F.count_if(F.col("json_payload").isNull()).alias("n_tombstones"),
    )


def _activity_batches(spark, d, root: str) -> DataFrame:
    """The activity log landed in bronze, as a stream of four batches in no order of time.

    Each batch has a quarter of the files, which are as many as the session's shuffle has partitions (four at least).
    """
    per_batch = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    records = roles.activity_records(spark, d).repartition(4 * per_batch, F.xxhash64("offset"))
    roles.bronze_rows(records).write.partitionBy("source_table").parquet(f"{root}/bronze")
    files = len(spark.read.parquet(f"{root}/bronze").inputFiles())
    return bronze_table_stream(spark, f"{root}/bronze", roles.ACTIVITY.name, max_per_trigger=max(1, files // 4))


def _silver_stream(spark, d, deletes: str) -> DataFrame:
    """All batches upserted, then the first one once more: a replayed batch changes nothing."""
    root, spec = scratch_path(spark, "silver-stream"), roles.ACTIVITY
    table = SnapshotTable(spark, f"{root}/silver", use_delta=False)
    batches: dict[int, DataFrame] = {}
    stream_upserts(
        _activity_batches(spark, d, root), table, spec.schema, spec.key, f"{root}/checkpoint", deletes,
        after_batch=lambda changes, batch_id: batches.setdefault(batch_id, changes),
    )
    for batch_id, changes in list(batches.items())[:1]:
        upsert_batch(table, changes, batch_id, spec.key)
    return current_rows(table)


def q_silver_stream(spark, d):
    return _silver_stream(spark, d, "ignore")


def q_silver_stream_deletes(spark, d):
    return _silver_stream(spark, d, "apply")


def q_latest_stream(spark, d):
    """The latest rows kept by the state store, batch after batch."""
    root, spec = scratch_path(spark, "latest-stream"), roles.ACTIVITY
    table = SnapshotTable(spark, f"{root}/silver", use_delta=False)
    stream_latest(_activity_batches(spark, d, root), table, spec.schema, spec.key, f"{root}/checkpoint")
    return table.read()


# ---------------------------------------------------------------- data quality
def q_table_counts(spark, d):
    bronze = roles.bronze_rows(change_log(spark, d))
    return dq.table_counts(bronze, [f"{TOPIC_PREFIX}{t}" for t in BRONZE_TABLES])


def q_dq_unique(spark, d):
    rows = parse_envelopes(txn_bronze(spark, d), TABLES["transaction"].schema, columns=["TransactionID"])
    return dq.unique_violations(rows, ["TransactionID"])


def q_dq_fk(spark, d):
    e = entities(spark, d)
    li = _t(spark, d, "lineitem")
    fact = latest_transactions(roles.bronze_rows(roles.transaction_records(e.txn)))
    parts, suppliers, orders = (_t(spark, d, name) for name in ("part", "supplier", "orders"))
    checks = {
        "user_accounts.client_no": dq.fk_orphans(e.accounts, ["client_no"], e.users, ["client_no"]),
        "master_card.Client_No": dq.fk_orphans(e.master_card, ["Client_No"], e.users, ["client_no"]),
        "master_card.Bank_ID": dq.fk_orphans(e.master_card, ["Bank_ID"], e.banks, ["Bank_ID"]),
        "master_card.Card_Network_ID": dq.fk_orphans(e.master_card, ["Card_Network_ID"], e.networks, ["Card_Network_ID"]),
        "transaction.card1": dq.fk_orphans(fact, ["card1"], e.banks, ["Bank_ID"]),
        "lineitem.l_partkey": dq.fk_orphans(li, ["l_partkey"], parts, ["p_partkey"]),
        "lineitem.l_suppkey": dq.fk_orphans(li, ["l_suppkey"], suppliers, ["s_suppkey"]),
        "lineitem.l_orderkey": dq.fk_orphans(li, ["l_orderkey"], orders, ["o_orderkey"]),
    }
    return dq.constraint_report(spark, checks)


NOT_NULL_COLUMNS = ("TransactionID", "isFraud", "TransactionDT", "ProductCD", "card1", "card4", "card6", "addr1", "P_emaildomain", "R_emaildomain")


def q_dq_not_null(spark, d):
    return dq.not_null_violations(latest_txn(spark, d), NOT_NULL_COLUMNS)


QUERIES: dict[str, Query] = {
    "decimal_decode": q_decimal_decode,
    "decimal_wide": q_decimal_wide,
    "interval_time": q_interval_time,
    "cast_defaults": q_cast_defaults,
    "string_shape": q_string_shape,
    "seed_lookup": q_seed_lookup,
    "preview_limit": q_preview_limit,
    "cdc_flatten": q_cdc_flatten,
    "cdc_latest": q_cdc_latest,
    "cdc_latest_apply": q_cdc_latest_apply,
    "json_inferred": q_json_inferred,
    "json_sample_schema": q_json_sample_schema,
    "wide_schema": q_wide_schema,
    "fill_nulls": q_fill_nulls,
    "zscore": q_zscore,
    "zscore_incremental": q_zscore_incremental,
    "silver_fact": q_silver_fact,
    "dedup_metrics": q_dedup_metrics,
    "upsert_merge": q_upsert_merge,
    "upsert_roundtrip": q_upsert_roundtrip,
    "upsert_apply_deletes": q_upsert_apply_deletes,
    "silver_dim": q_silver_dim,
    "silver_dim_inferred": q_silver_dim_inferred,
    "silver_variant": q_silver_variant,
    "user_entities": q_user_entities,
    "account_numbers": q_account_numbers,
    "account_numbers_long_domain": q_account_numbers_long_domain,
    "card_links": q_card_links,
    "dim_location": q_dim_location,
    "dim_bank": q_dim_bank,
    "dim_network": q_dim_network,
    "dim_device": q_dim_device,
    "column_defaults": q_column_defaults,
    "insert_if_absent": q_insert_if_absent,
    "join_left_agg": q_join_left_agg,
    "join_left_cond": q_join_left_cond,
    "join_left_distinct": q_join_left_distinct,
    "join_semi": q_join_semi,
    "card_dedup_max": q_card_dedup_max,
    "distinct_pairs": q_distinct_pairs,
    "drop_duplicates": q_drop_duplicates,
    "card_profile": q_card_profile,
    "device_profile": q_device_profile,
    "location_profile": q_location_profile,
    "gold_master": q_gold_master,
    "gold_heavy_cards": q_gold_heavy_cards,
    "gold_colocated": q_gold_colocated,
    "medallion_gold": q_medallion_gold,
    "materialize_roundtrip": q_materialize_roundtrip,
    "serving_refresh": q_serving_refresh,
    "append_table": q_append_table,
    "csv_roundtrip": q_csv_roundtrip,
    "normalize_columns": q_normalize_columns,
    "union_train_test": q_union_train_test,
    "load_metrics": q_load_metrics,
    "load_ragged": q_load_ragged,
    "bronze_stream": q_bronze_stream,
    "bronze_restart": q_bronze_restart,
    "bronze_audit": q_bronze_audit,
    "bronze_partition_read": q_bronze_partition_read,
    "silver_stream": q_silver_stream,
    "silver_stream_deletes": q_silver_stream_deletes,
    "latest_stream": q_latest_stream,
    "table_counts": q_table_counts,
    "dq_unique": q_dq_unique,
    "dq_fk": q_dq_fk,
    "dq_not_null": q_dq_not_null,
}
