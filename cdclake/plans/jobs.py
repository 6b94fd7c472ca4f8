"""User-level jobs: silver dimensions, silver fact, gold, export, serving refresh, and the
whole bronze -> silver -> gold -> serve run in order."""

from __future__ import annotations

import logging
import zlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.decimal import decode_decimal
from cdclake.operators import entities as ent
from cdclake.operators.cdc import (
    POS_OFFSET,
    POS_PARTITION,
    TS_COL,
    infer_json_schema,
    latest_changes,
    latest_records,
    latest_state,
    parse_envelopes,
    present_fields,
)
from cdclake.operators.features import fill_defaults, zscore
from cdclake.operators.gold import FACT_COLUMNS, IDENTITY_COLUMNS, build_gold
from cdclake.operators.heavy import HEAVY_SHARE
from cdclake.operators.shaping import apply_defaults
from cdclake.operators.variant import latest_rows
from cdclake.schemas import DIMENSION_TABLES, TABLES, TableSpec
from cdclake.sinks.export import export_parquet, materialize, refresh_serving
from cdclake.session import scratch_path, staged
from cdclake.sinks.colocated import open_colocated, write_colocated
from cdclake.sinks.snapshots import SnapshotTable, absent_rows, changed_rows
from cdclake.sources import csv as csvsrc
from cdclake.sources import seeds
from cdclake.sources.bronze import read_bronze_table, register_views
from cdclake.streaming.silver import bronze_table_stream, stream_upserts

log = logging.getLogger(__name__)

# Null fill of the transaction fact.
FACT_FILL = {"TransactionAmt": 0.0, "card1": -1}


def latest_transactions(bronze: DataFrame, deletes: str = "ignore", columns: Sequence[str] | None = None) -> DataFrame:
    """Transaction change rows -> the latest row per TransactionID, amount decoded, nulls filled.

    The latest change per id is picked on the compact payload text and only
    the winners' payloads are parsed, with the declared 394-field schema or
    the ``columns`` of it that the caller reads.
    """
    spec = TABLES["transaction"]
    return _transaction_rows(latest_records(bronze, spec.schema, spec.key, deletes=deletes), columns)


def _transaction_rows(
    winners: DataFrame, columns: Sequence[str] | None = None, present: Sequence[str] | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    rows = parse_envelopes(winners, TABLES["transaction"].schema, columns=columns, live_only=True, present=present, carry=carry)
    return _filled(rows.drop(POS_PARTITION, POS_OFFSET, TS_COL))


def _filled(rows: DataFrame) -> DataFrame:
    if "TransactionAmt" in rows.columns:
        rows = rows.withColumn("TransactionAmt", decode_decimal("TransactionAmt", scale=3))
    return fill_defaults(rows, FACT_FILL)


#: What the scored changes have beside the text.
SCORES = ("avg_amt", "std_amt", "z_score")


def silver_fact(bronze: DataFrame, deletes: str = "ignore", columns: Sequence[str] | None = None) -> DataFrame:
    """The latest transactions with ``avg_amt``, ``std_amt`` and ``z_score`` per card (``card1``).

    With ``columns`` only these of the 394 declared ones, before the three.
    """
    scored, present = scored_transactions(bronze, deletes, columns)
    return parsed_fact(scored, present, columns)


def scored_transactions(
    bronze: DataFrame, deletes: str = "ignore", columns: Sequence[str] | None = None
) -> tuple[DataFrame, Sequence[str]]:
    """The latest change of each transaction, still text, with its id and the scores of its amount;
    and the fields that the texts have (``columns``, if given).

    The winners of the selection are written to the scratch folder as they
    came, with the two columns that the per-card statistics need beside the
    text. The scores are joined to the text: a row of 394 parsed columns takes
    over 3 KB wherever it is shuffled or sorted, so it is parsed after that.
    """
    spec = TABLES["transaction"]
    used = ("card1", "TransactionAmt")
    winners = staged(latest_records(bronze, spec.schema, spec.key, deletes=deletes, carry=(*spec.key, *used)), "latest-transactions")
    present = columns or present_fields(winners, spec.schema)
    return zscore(_filled(winners), *used, stats_source=_filled(winners.select(*used))).drop(*used), present


def parsed_fact(
    scored: DataFrame, present: Sequence[str], columns: Sequence[str] | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """The rows of :func:`scored_transactions`, parsed once."""
    return _transaction_rows(scored, columns, present, (*SCORES, *carry))


def silver_table(bronze: DataFrame, spec: TableSpec, deletes: str = "ignore", schema: str = "declared",
                 decode_decimals: Sequence[str] = (), scale: int = 2) -> DataFrame:
    """Latest row per key of one dimension table.

    ``schema="declared"`` parses with the table's declared schema;
    ``schema="infer"`` infers the row schema from the payloads themselves
    (merged over all documents), for tables that have no declared schema;
    ``schema="variant"`` does that too, and takes header, schema and rows from
    one parse of the text.
    ``decode_decimals`` names NUMERIC columns (balances, limits) that are
    decoded from their base64 form; silver otherwise keeps them as they come.
    """
    if schema == "variant":
        return _decoded(latest_rows(bronze, spec.key, deletes), decode_decimals, scale)
    row_schema = infer_row_schema(bronze) if schema == "infer" else spec.schema
    rows = latest_state(bronze, row_schema, spec.key, deletes=deletes)
    return _decoded(rows, decode_decimals, scale)


def _decoded(rows: DataFrame, columns: Sequence[str], scale: int = 2) -> DataFrame:
    return rows.withColumns({c: decode_decimal(c, scale=scale, signed=True) for c in columns})


def infer_row_schema(bronze: DataFrame, payload_col: str = "json_payload"):
    """The ``payload.after`` row schema inferred from the change envelopes."""
    env = infer_json_schema(bronze, payload_col)
    return env["payload"].dataType["after"].dataType


@dataclass
class Layout:
    """Where each layer lives (all under one shared root on a cluster)."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/all_tables"

    @property
    def bronze_checkpoint(self) -> str:
        return f"{self.root}/bronze/checkpoints"

    def source(self, table: str) -> str:
        """Tables of the source database: loaded CSV tables, entities and seeds."""
        return f"{self.root}/source/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def silver_checkpoint(self, table: str) -> str:
        return f"{self.root}/silver_checkpoints/{table}"

    def colocated(self, table: str) -> str:
        """What gold reads of the fact and of identity, bucketed by TransactionID."""
        return f"{self.root}/colocated/{table}"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/transaction_master"

    @property
    def export(self) -> str:
        return f"{self.root}/gold/transaction_master_parquet"

    @property
    def serving(self) -> str:
        return f"{self.root}/serving/gold_transaction_master"


def build_silver_dimensions(spark: SparkSession, layout: Layout, tables=DIMENSION_TABLES,
                            specs: dict[str, TableSpec] | None = None, parallelism: int = 4,
                            schema: str = "declared", decode_decimals: dict[str, Sequence[str]] | None = None,
                            deletes: str = "ignore") -> dict[str, str]:
    """Upsert each dimension's latest rows into its snapshot table.

    Tables are independent, so they are submitted as concurrent Spark jobs.
    An empty or failing table is reported and skipped; the others go on (the
    status says so, and :func:`run_all` stops there). ``schema="infer"`` takes
    the row schemas from the payloads; ``decode_decimals`` maps a table to its
    NUMERIC columns that are to be decoded. ``deletes="apply"`` removes the rows
    of keys whose latest change is a delete; by default deletes are ignored.
    """
    specs = specs or TABLES

    def one(name: str) -> str:
        try:
            bronze = read_bronze_table(spark, layout.bronze, name)
            if bronze.isEmpty():
                return "empty"
            decoded, target = (decode_decimals or {}).get(name, ()), SnapshotTable(spark, layout.silver(name))
            if deletes == "apply":
                row_schema = specs[name].schema if schema == "declared" else infer_row_schema(bronze)
                changes = latest_changes(bronze, row_schema, specs[name].key)
                target.apply_changes(_decoded(changes, decoded), specs[name].key)
            else:
                target.upsert(silver_table(bronze, specs[name], schema=schema, decode_decimals=decoded), specs[name].key)
            return "ok"
        except Exception as exc:
            log.warning("silver %s failed: %s", name, exc)
            return f"failed: {exc}"

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return dict(zip(tables, pool.map(one, tables)))


def require_ok(status: dict[str, str]) -> None:
    """Raise if a table failed: what is built on top of it would look complete."""
    failed = {n: s for n, s in status.items() if s.startswith("failed")}
    if failed:
        raise RuntimeError(f"silver tables failed: {failed}")


def build_silver_transaction(spark: SparkSession, layout: Layout, deletes: str = "ignore") -> int:
    """The fact from the whole change log; with ``deletes="apply"`` it replaces the table, so deleted transactions go."""
    bronze = read_bronze_table(spark, layout.bronze, "transaction")
    target, key = SnapshotTable(spark, layout.silver("transaction")), TABLES["transaction"].key
    scored, present = scored_transactions(bronze, deletes)

    def parsed(rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        return parsed_fact(rows, present, carry=carry)

    # dealt to the buckets as text
    return target.overwrite(scored, key, parsed) if deletes == "apply" else target.upsert(scored, key, parsed)


def stream_silver(
    spark: SparkSession, layout: Layout, tables=DIMENSION_TABLES, specs: dict[str, TableSpec] | None = None,
    deletes: str = "ignore", max_per_trigger: int | None = None, interval: str | None = None,
) -> None:
    """Upsert what bronze has new of each table, batch by batch; a later run goes on where this one stopped.

    Without an ``interval`` it drains what is there and stops. The tables keep
    the streams' positions, so they are written by this job only.
    """
    specs = specs or TABLES
    running = [
        stream_upserts(
            bronze_table_stream(spark, layout.bronze, name, max_per_trigger), SnapshotTable(spark, layout.silver(name), use_delta=False),
            specs[name].schema, specs[name].key, layout.silver_checkpoint(name), deletes, interval, wait=False,
        )
        for name in tables
    ]
    for query in running:
        query.awaitTermination()


GOLD_INPUTS = (
    "transaction", "identity", "user_profile", "user_accounts", "master_card", "card_issuing_bank",
    "description_card", "product_description", "device_fingerprint", "location",
)


def colocated_name(layout: Layout, table: str) -> str:
    """Catalog name of a bucketed copy: one a lake."""
    return f"colocated_{zlib.crc32(layout.root.encode()):08x}_{table}"


def colocate(fact: DataFrame, identity: DataFrame, layout: Layout, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Bucketed copies of what gold reads of ``fact`` and ``identity``.

    Worth it where gold is built several times from one fact (after changes of
    the dimensions): the shuffles by TransactionID are paid here, once.
    Identity rows without an id match no transaction and are left out.
    """
    some = identity.where(F.col("TransactionID").isNotNull()).select(*IDENTITY_COLUMNS)
    return (
        write_colocated(fact.select(*FACT_COLUMNS), colocated_name(layout, "transaction"), layout.colocated("transaction"), ["TransactionID"], buckets),
        write_colocated(some, colocated_name(layout, "identity"), layout.colocated("identity"), ["TransactionID"], buckets),
    )


def colocate_silver(spark: SparkSession, layout: Layout, buckets: int | None = None) -> None:
    """:func:`colocate` of the silver tables."""
    silver = [SnapshotTable(spark, layout.silver(name)).read() for name in ("transaction", "identity")]
    colocate(*silver, layout, buckets)


def gold_from_silver(spark: SparkSession, layout: Layout, allow_missing: bool = False, colocated: bool = False) -> DataFrame:
    """Register the silver tables as ``silver_<name>`` views and build the star from them.

    A table that was never written raises, unless ``allow_missing`` lets it
    stand in as an empty table of its declared schema (its gold columns then
    take their defaults). A table that cannot be read always raises. With
    ``colocated`` the fact and identity are the copies that
    :func:`colocate_silver` made last.
    """
    loaded = set(register_views(spark, {n: layout.silver(n) for n in GOLD_INPUTS}))
    missing = [n for n in GOLD_INPUTS if n not in loaded]
    if missing and not allow_missing:
        raise FileNotFoundError(f"silver tables missing: {missing}")

    def view(name: str) -> DataFrame:
        if colocated and name in ("transaction", "identity"):
            return open_colocated(spark, colocated_name(layout, name), layout.colocated(name))
        return spark.table(f"silver_{name}") if name in loaded else spark.createDataFrame([], TABLES[name].schema)

    return build_gold(
        view("transaction"), view("product_description"), view("master_card"), view("card_issuing_bank"),
        view("description_card"), view("user_profile"), view("user_accounts"), view("identity"),
        view("device_fingerprint"), view("location"),
        unique_ids=True,  # the silver fact is keyed by TransactionID
        heavy_share=HEAVY_SHARE,
        colocated=colocated,
    )


def build_gold_job(spark: SparkSession, layout: Layout, num_files: int | None = None, allow_missing: bool = False,
                   colocated: bool = False) -> DataFrame:
    """Gold star materialised to its own folder, read back for the export.

    ``num_files=None`` lets AQE size the output files; a fixed count (the job
    this replaces used 8) only suits small tables.
    """
    return materialize(gold_from_silver(spark, layout, allow_missing, colocated), layout.gold, num_files=num_files)


def export_and_serve(spark: SparkSession, layout: Layout) -> int:
    rows = export_parquet(spark.read.parquet(layout.gold), layout.export)
    refresh_serving(spark, layout.export, layout.serving)
    return rows


def run_all(spark: SparkSession, layout: Layout, land=None, allow_missing: bool = False) -> dict:
    """bronze -> {silver dimensions, silver fact} -> gold -> export -> serve.

    ``land`` is a callable that lands the bronze layer (a streaming run);
    the two silver jobs run on two driver threads, as independent Spark jobs.
    A failed dimension stops the run before gold.
    """
    if land is not None:
        land()
    with ThreadPoolExecutor(max_workers=2) as pool:
        dims = pool.submit(build_silver_dimensions, spark, layout)
        fact = pool.submit(build_silver_transaction, spark, layout)
        dim_status, _ = dims.result(), fact.result()
    require_ok(dim_status)
    build_gold_job(spark, layout, allow_missing=allow_missing)
    rows = export_and_serve(spark, layout)
    return {"dimensions": dim_status, "gold_rows": rows}


def load_source_table(
    spark: SparkSession,
    table: str,
    files: list[str],
    schema,
    target: SnapshotTable,
    quarantine_path: str | None = None,
    lines: str = "auto",
) -> DataFrame:
    """Load a table's CSV files (training files first) into ``target`` with row accounting.

    One pass over the files: every row is flagged (a present value that does
    not convert to its declared type, or a wrong number of fields, fails the
    row, not the batch) and written once, partitioned by the flag, to a
    staging folder. Accepted rows are appended to the target; failed rows go
    to the quarantine folder with their raw text. Returns one row: table name,
    accepted and failed counts, counted from the staged files (footers only),
    so retried tasks never count twice. Without any file nothing is loaded.
    """
    loaded = csvsrc.load_files(spark, files, schema, lines)
    if not any(csvsrc.path_exists(spark, f) for f in files):
        log.warning("no file to load for %s: %s", table, files)
    bad = F.col(csvsrc.BAD_COL)
    staging = scratch_path(spark, f"load-{table}")
    loaded.write.partitionBy(csvsrc.BAD_COL).parquet(staging)
    staged_rows = spark.read.schema(loaded.schema).parquet(staging)
    counts = staged_rows.agg(F.count_if(~bad).alias("rows_accepted"), F.count_if(bad).alias("rows_failed"))
    accepted, failed = counts.first()
    helpers = (csvsrc.BAD_COL, csvsrc.RANK_COL)
    if accepted:
        target.append(staged_rows.where(~bad).drop(*helpers, csvsrc.CORRUPT_COL))
    if failed and quarantine_path:
        staged_rows.where(bad).drop(*helpers).write.mode("append").parquet(quarantine_path)
    return counts.select(F.lit(table).alias("table_name"), "rows_accepted", "rows_failed")


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "product_description": seeds.product_description(spark),
        "status": seeds.status(spark),
        "blacklist_rules": seeds.blacklist_rules(spark),
    }


def load_seeds(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Write the seed tables into the source database; a rerun adds only keys that are not there."""
    return {
        name: SnapshotTable(spark, layout.source(name)).insert_if_absent(rows, TABLES[name].key)
        for name, rows in seed_tables(spark).items()
    }


# every entity derivation is a DISTINCT over a subset of these card-level columns
CARD_LEVEL_COLUMNS = ("card1", "card2", "card3", "card4", "card6", "addr1", "addr2", "P_emaildomain")


class Entities:
    """Users, accounts, dimensions and card links derived from one transaction source.

    The derivations read a staged table of the distinct card-level column
    combinations (sized by cards and addresses, not by transactions); the
    identity source, read by three consumers, is staged too. ``known`` maps
    table names to the rows of an earlier run, whose numbers stay.
    """

    def __init__(self, txn: DataFrame, identity: DataFrame, known: dict[str, DataFrame] | None = None):
        known = known or {}
        self.txn = txn
        with ThreadPoolExecutor(max_workers=4) as pool:
            cards = pool.submit(staged, txn.select(*CARD_LEVEL_COLUMNS).distinct(), "card-level")
            ids = pool.submit(staged, identity, "src-identity")
            self.cards, self.identity = cards.result(), ids.result()
            # independent derivations run as concurrent Spark jobs
            clients = pool.submit(lambda: staged(ent.number_clients(self.cards, known.get("client_numbers")), "clients"))
            networks = pool.submit(ent.derive_networks, self.cards, known.get("description_card"))
            location = pool.submit(ent.derive_location, self.cards, known.get("location"))
            devices = pool.submit(ent.derive_devices, self.identity, known.get("device_fingerprint"))
            self.banks = ent.derive_banks(self.cards)
            self.clients, self.networks = clients.result(), networks.result()
            self.users = ent.user_profiles(self.clients)
            accounts = pool.submit(ent.assign_accounts, self.cards, self.clients)
            links = pool.submit(ent.link_cards, self.cards, self.users, self.networks, self.banks, known.get("master_card"))
            self.location, self.devices = location.result(), devices.result()
            self.accounts, self.master_card = accounts.result(), links.result()

    def tables(self) -> dict[str, DataFrame]:
        """The entity tables by their source names."""
        return {
            "client_numbers": self.clients, "user_profile": self.users, "user_accounts": self.accounts,
            "card_issuing_bank": self.banks, "description_card": self.networks, "location": self.location,
            "device_fingerprint": self.devices, "master_card": self.master_card,
        }


def build_entities(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Derive the entity tables from the loaded transaction and identity tables and write them.

    Clients, networks, locations, devices and card links are registries that
    only grow: what a run finds new is numbered on from the largest number
    ever given and appended, and a key that vanishes keeps its row, so its
    number is never given again and is there when the key returns. Banks are
    inserted if absent. Profiles and accounts are shaped to their declared
    columns (defaults filled); only new and changed ones are upserted. A rerun
    over the same data writes nothing. Returns the rows added or changed.
    """
    def table(name: str) -> SnapshotTable:
        return SnapshotTable(spark, layout.source(name))

    registries = {"client_numbers": "client_no", "description_card": "Card_Network_ID", "location": "LocationID",
                  "device_fingerprint": "Device_ID", "master_card": "Card_Key"}
    known = {n: table(n).read() for n in registries if table(n).exists()}
    derived = Entities(table("transaction").read(), table("identity").read(), known).tables()

    def news(name: str) -> DataFrame:
        """What is not in the table yet; all of it is staged before the first table is written."""
        rows, target = derived[name], table(name)
        if target.exists():
            stored = target.read()
            if name in registries:
                rows = rows.join(stored.select(registries[name]), registries[name], "left_anti")
            elif name == "card_issuing_bank":
                rows = absent_rows(stored, rows, TABLES[name].key)
            else:
                key = TABLES[name].key
                rows = changed_rows(stored, rows, key, [c for c in rows.columns if c not in key and c in stored.columns])
        return staged(rows, name)

    with ThreadPoolExecutor(max_workers=4) as pool:
        new = dict(zip(derived, pool.map(news, derived), strict=True))
    written = {}
    for name, rows in new.items():
        target = table(name)
        written[name] = rows.count()  # of the staged files: footers only
        if target.exists() and not written[name]:
            continue
        if name in ("user_profile", "user_accounts"):
            target.upsert(apply_defaults(rows, TABLES[name]), TABLES[name].key)
        elif target.exists():
            target.append(rows)
        else:
            target.overwrite(rows)
    return written
