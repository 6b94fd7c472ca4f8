"""Entities derived from raw transactions: users, accounts, card links and dimensions.

All are distinct projections of the transaction fact, numbered with
:func:`cdclake.operators.numbering.sequence_number` in the order of their
values (the jobs this replaces number rows in whatever order a DISTINCT
returned them; a value order is one legal outcome and is repeatable).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdclake.functions.strings import falsy_default, title_word, truncate, zero_pad
from cdclake.operators.numbering import sequence_number


def _region_code(addr1: str = "addr1"):
    # int(addr1) with 0 when it does not convert (NaN, out of range)
    return F.coalesce(F.col(addr1).try_cast("int"), F.lit(0))


def _pg_int(c: str):
    # a relational CAST(real AS INT) rounds half to even; out-of-range gives null here
    return F.bround(F.col(c), 0).try_cast("int")


USER_PAIR = ("addr1", "P_emaildomain")


def number_clients(txn: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``addr1, P_emaildomain, client_no``: one client per distinct pair, numbered in value order.

    ``known`` holds the pairs and numbers of earlier runs: their numbers stay,
    and new pairs are numbered on from the largest one.
    """
    pairs = (
        txn.where(F.col("addr1").isNotNull() & F.col("P_emaildomain").isNotNull())
        .select(F.col("addr1").cast("double").alias("addr1"), "P_emaildomain")
        .distinct()
    )
    first = 0
    if known is not None:
        pairs = pairs.join(known.select(*USER_PAIR), list(USER_PAIR), "left_anti")
        first = known.agg(F.max(F.col("client_no").cast("long"))).first()[0] or 0
    new = sequence_number(pairs, list(USER_PAIR)).select(*USER_PAIR, zero_pad(F.col("seq") + F.lit(first), 8).alias("client_no"))
    return new if known is None else known.select(*USER_PAIR, "client_no").unionByName(new)


def user_profiles(clients: DataFrame) -> DataFrame:
    """Profile rows of numbered clients, as the profile table stores them.

    Personal attributes (names, phones, addresses) are not generated; they
    stay null and the gold job shows 'Unknown' for them.
    """
    return clients.select(
        "client_no",
        truncate(falsy_default("P_emaildomain", "unknown.com"), 100).alias("raw_email_domain"),
        _region_code().alias("raw_region_code"),
    )


def resolve_users(txn: DataFrame) -> DataFrame:
    """One client per distinct (addr1, P_emaildomain): ``client_no`` '00000001', ..."""
    return user_profiles(number_clients(txn))


def client_lookup(clients: DataFrame) -> DataFrame:
    """(region code, whole e-mail domain) -> client_no; the last-numbered client wins a shared key.

    The domain is the profile's (empty ones read 'unknown.com') before it is
    cut to the column's width, so two long domains never share a client.
    """
    return (
        clients.groupBy(_region_code().alias("_lk_region"), falsy_default("P_emaildomain", "unknown.com").alias("_lk_domain"))
        .agg(F.max_by("client_no", F.col("client_no").cast("long")).alias("client_no"))
    )


def assign_accounts(txn: DataFrame, clients: DataFrame) -> DataFrame:
    """One account per distinct (addr1, P_emaildomain, card1, card6) of a known client (:func:`number_clients`).

    Account number '190' + client_no + two-digit sequence within the client
    (ordered by card1, card6); the first account of a client is primary.
    Sequences of 100 and more keep all their digits.
    """
    cards = (
        txn.where(F.col("addr1").isNotNull() & F.col("P_emaildomain").isNotNull() & F.col("card1").isNotNull())
        .select("addr1", "P_emaildomain", "card1", "card6")
        .distinct()
        .withColumn("_rc", _region_code())
    )
    lookup = client_lookup(clients)
    joined = cards.join(
        lookup,
        (cards["_rc"] == lookup["_lk_region"]) & (cards["P_emaildomain"] == lookup["_lk_domain"]),
        "inner",
    ).select(cards["card1"], cards["card6"], cards["addr1"], cards["P_emaildomain"], lookup["client_no"])
    numbered = sequence_number(joined, ["card1", "card6", "addr1", "P_emaildomain"], group_cols=["client_no"])
    stt = zero_pad("seq", 2)
    card_type = falsy_default("card6", "debit")
    return numbered.select(
        truncate(F.concat(F.lit("190"), F.col("client_no"), stt), 20).alias("account_number"),
        F.col("client_no"),
        F.col("card1").cast("long").alias("linked_raw_card_bin"),
        truncate(card_type, 20).alias("linked_card_type"),
        truncate(F.concat(F.lit("ACCT "), title_word(card_type), F.lit(" "), stt), 100).alias("account_name"),
        F.lit("USD").alias("currency_code"),
        F.lit("50000.00").alias("daily_transfer_limit"),
        F.lit("OPEN").alias("account_status"),
        (F.col("seq") == 1).alias("is_primary"),
    )


def keep_numbers(rows: DataFrame, known: DataFrame | None, keys: list[str], id_col: str) -> DataFrame:
    """``rows`` with serial ids that stay the same between runs.

    Rows that ``known`` has (null-safe on ``keys``) keep their id; the others
    are numbered on from the largest one, in the order of their keys.
    """
    if known is None:
        return sequence_number(rows, keys, out=id_col)
    same = F.lit(True)
    old = known.select(*[F.col(k).alias(f"_kn_{k}") for k in keys], F.col(id_col))
    for k in keys:
        same = same & rows[k].eqNullSafe(old[f"_kn_{k}"])
    kept = rows.join(old, same).select(*rows.columns, id_col)
    first = known.agg(F.max(F.col(id_col).cast("long"))).first()[0] or 0
    fresh = sequence_number(rows.join(old, same, "left_anti"), keys, out=id_col)
    return kept.unionByName(fresh.withColumn(id_col, (F.col(id_col) + F.lit(first)).cast(kept.schema[id_col].dataType)))


def derive_networks(txn: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """description_card: distinct (card4, card6), both present, with a serial id."""
    pairs = (
        txn.where(F.col("card4").isNotNull() & F.col("card6").isNotNull())
        .select(F.col("card4").alias("Network_Name"), F.col("card6").alias("Card_Type"))
        .distinct()
    )
    numbered = keep_numbers(pairs, known, ["Network_Name", "Card_Type"], "Card_Network_ID")
    return numbered.select(
        F.col("Card_Network_ID").cast("long").alias("Card_Network_ID"),
        "Network_Name",
        "Card_Type",
        F.lit(None).cast("string").alias("Network_Country"),
        F.lit(None).cast("string").alias("Support_Hotline"),
    )


def derive_banks(txn: DataFrame) -> DataFrame:
    """card_issuing_bank: one row per card1 (insert-if-absent on Bank_ID keeps the first)."""
    rows = (
        txn.where(F.col("card1").isNotNull())
        .select(
            F.col("card1").cast("long").alias("Bank_ID"),
            _pg_int("card3").alias("Bank_Country_Code"),
            _pg_int("card2").alias("Bank_Sub_Branch"),
        )
        .distinct()
    )
    w = Window.partitionBy("Bank_ID").orderBy(
        F.col("Bank_Country_Code").asc_nulls_first(), F.col("Bank_Sub_Branch").asc_nulls_first()
    )
    first = rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return first.select(
        "Bank_ID", F.lit(None).cast("string").alias("Bank_Name"), "Bank_Country_Code", "Bank_Sub_Branch"
    )


def derive_location(txn: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """location: distinct (addr1, addr2) with either present, serial id; Region/Country unfilled."""
    pairs = (
        txn.where(F.col("addr1").isNotNull() | F.col("addr2").isNotNull())
        .select(F.col("addr1").cast("double").alias("addr1"), F.col("addr2").cast("double").alias("addr2"))
        .distinct()
    )
    numbered = keep_numbers(pairs, known, ["addr1", "addr2"], "LocationID")
    return numbered.select(
        F.col("LocationID").cast("long").alias("LocationID"),
        "addr1",
        "addr2",
        F.lit(None).cast("string").alias("Region"),
        F.lit(None).cast("string").alias("Country"),
    )


def derive_devices(identity: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """device_fingerprint: distinct device descriptions from identity rows, serial id."""
    rows = (
        identity.where(F.col("DeviceInfo").isNotNull())
        .select(
            F.col("DeviceInfo").alias("Device_Name"),
            F.col("DeviceType").alias("Device_Type"),
            F.col("id_30").alias("OS_Version"),
            F.col("id_31").alias("Browser_Version"),
            F.col("id_33").alias("Screen_Resolution"),
        )
        .distinct()
    )
    cols = ["Device_Name", "Device_Type", "OS_Version", "Browser_Version", "Screen_Resolution"]
    numbered = keep_numbers(rows, known, cols, "Device_ID")
    return numbered.select(F.col("Device_ID").cast("long").alias("Device_ID"), *cols)


def link_cards(
    txn: DataFrame, users: DataFrame, networks: DataFrame, banks: DataFrame, known: DataFrame | None = None
) -> DataFrame:
    """master_card: card -> client -> bank -> network, distinct, with a serial Card_Key.

    The transaction side is reduced to its distinct (card1, addr1, e-mail
    domain, card4, card6) combinations before any join, so the joins work on
    card-level rows, not on every transaction.
    """
    t = (
        txn.where(F.col("card1").isNotNull())
        .select("card1", "addr1", "P_emaildomain", "card4", "card6")
        .distinct()
    )
    linked = (
        t.join(users, (t["addr1"] == users["raw_region_code"]) & (t["P_emaildomain"] == users["raw_email_domain"]))
        .join(networks, (t["card4"] == networks["Network_Name"]) & (t["card6"] == networks["Card_Type"]))
        .join(banks.select("Bank_ID"), t["card1"] == banks["Bank_ID"], "left_semi")
        .select(
            t["card1"].cast("long").alias("Card_Raw_ID"),
            users["client_no"].alias("Client_No"),
            t["card1"].cast("long").alias("Bank_ID"),
            networks["Card_Network_ID"].alias("Card_Network_ID"),
        )
        .distinct()
    )
    numbered = keep_numbers(linked, known, ["Card_Raw_ID", "Client_No", "Card_Network_ID"], "Card_Key")
    return numbered.select(
        F.col("Card_Key").cast("long").alias("Card_Key"), "Card_Raw_ID", "Client_No", "Bank_ID", "Card_Network_ID"
    )
