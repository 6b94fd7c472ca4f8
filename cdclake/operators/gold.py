"""The gold star: one 28-column row per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdclake.functions.timefn import seconds_after
from cdclake.operators.heavy import broadcast_limit, heavy_keys, left_join_heavy, stored_bytes
from cdclake.session import staged

#: What gold reads of the fact.
FACT_COLUMNS = ("TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "z_score", "ProductCD", "card1", "addr1", "addr2")
#: The declared fields among them.
FACT_FIELDS = tuple(c for c in FACT_COLUMNS if c != "z_score")
#: What gold reads of identity.
IDENTITY_COLUMNS = ("TransactionID", "DeviceType", "DeviceInfo")

GOLD_COLUMNS = (
    "TransactionID", "Transaction_Time", "TransactionAmt", "isFraud", "z_score", "ProductDesc",
    "client_no", "full_name", "email_address", "phone_number", "customer_segment", "kyc_level",
    "account_number", "current_balance", "account_status", "Beneficiary_Name", "Bank_Name",
    "Network_Name", "Card_Type", "addr1", "addr2", "Region", "Country", "DeviceType", "Device_Name",
    "OS_Version", "Browser_Version", "Screen_Resolution",
)


def _pick(df: DataFrame, cols: list[str]) -> DataFrame:
    """Select ``cols``; a column the table does not carry (never generated) is null text."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in cols])


def _first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def card_profile(
    master_card: DataFrame,
    banks: DataFrame,
    networks: DataFrame,
    users: DataFrame,
    accounts: DataFrame,
) -> DataFrame:
    """Card-level side of the star: one row per Card_Raw_ID.

    ``MAX`` per column of the card links (columns are maximised
    independently, as in the query this replaces), then bank, network, client
    and the client's primary account. Every join here is between dimensions,
    sized by the number of cards, not by the number of transactions.
    """
    mc = master_card.groupBy("Card_Raw_ID").agg(
        F.max("Client_No").alias("_mc_client"),
        F.max("Bank_ID").alias("Bank_ID"),
        F.max("Card_Network_ID").alias("Card_Network_ID"),
    )
    primary = _first_per_key(
        _pick(accounts.where(F.col("is_primary") == F.lit(True)), ["client_no", "account_number", "current_balance", "account_status"]),
        "client_no",
        ["account_number"],
    ).withColumnRenamed("client_no", "_pa_client")
    up = _pick(users, ["client_no", "full_name", "email_address", "phone_number", "customer_segment", "kyc_level"])
    # the client shown is the matched profile's (null when the link points to no profile)
    return (
        mc.join(_pick(banks, ["Bank_ID", "Bank_Name"]), "Bank_ID", "left")
        .join(_pick(networks, ["Card_Network_ID", "Network_Name", "Card_Type"]), "Card_Network_ID", "left")
        .join(up, F.col("_mc_client") == up["client_no"], "left")
        .join(primary, F.col("client_no") == F.col("_pa_client"), "left")
        .drop("_mc_client", "_pa_client")
    )


def named_devices(devices: DataFrame) -> DataFrame:
    """One device per Device_Name: the one with the smallest id."""
    return _first_per_key(
        _pick(devices, ["Device_ID", "Device_Name", "OS_Version", "Browser_Version", "Screen_Resolution"]),
        "Device_Name",
        ["Device_ID"],
    ).drop("Device_ID")


def device_profile(identity: DataFrame, devices: DataFrame) -> DataFrame:
    """Transaction-level device side: identity joined to one device per Device_Name (smallest id)."""
    dev = named_devices(devices)
    i = _pick(identity, list(IDENTITY_COLUMNS))
    return i.join(dev, i["DeviceInfo"] == dev["Device_Name"], "left").drop("DeviceInfo")


def location_profile(location: DataFrame) -> DataFrame:
    """One (Region, Country) per addr1: the smallest of its distinct values."""
    loc = _pick(location, ["addr1", "Region", "Country"]).distinct()
    return _first_per_key(loc, "addr1", ["Region", "Country"])


def build_gold(
    transactions: DataFrame,
    products: DataFrame,
    master_card: DataFrame,
    banks: DataFrame,
    networks: DataFrame,
    users: DataFrame,
    accounts: DataFrame,
    identity: DataFrame,
    devices: DataFrame,
    location: DataFrame,
    unique_ids: bool = False,
    heavy_share: float | None = None,
    profile_limit: int | None = None,
    colocated: bool = False,
) -> DataFrame:
    """Left-join the fact to every dimension and shape the 28 output columns.

    Each dimension side is made unique on its join key before the join, so
    no transaction fans out and no de-duplication shuffle of the wide result
    is needed; only rows with a null TransactionID (which never match) are
    collapsed to one, as a ``dropDuplicates`` on the key would, and on the
    narrow fact before any join. ``unique_ids`` says that the fact already has
    one row per id (the silver fact does), which saves that step.

    The fact is shuffled twice at most: once by card (card profile) and once
    by TransactionID (identity); small sides are broadcast from their
    measured size. The card profile, a chain of joins on an aggregate, is
    written to the scratch folder first: its size is then known, and if it is
    too large to broadcast, both sides of the card join are plain shuffles,
    so adaptive execution can split a card that holds most transactions.

    With ``heavy_share``, for a fact that is a stored table, such cards are not
    shuffled at all: where the profile is too large to broadcast whole, the
    profiles of the cards that hold this share of the fact are broadcast, and
    only the other transactions are shuffled by card. ``profile_limit`` is the
    size in bytes from which on this is done (the session's broadcast limit).

    ``colocated`` says that fact and identity are bucketed alike by
    TransactionID (``sinks.colocated``): they are joined first, bucket by
    bucket, and the fact's only shuffle is the one by card.
    """
    t = transactions.select(*FACT_COLUMNS)
    if not unique_ids:
        null_keyed = t.where(F.col("TransactionID").isNull()).dropDuplicates(["TransactionID"])
        t = t.where(F.col("TransactionID").isNotNull()).unionByName(null_keyed)
    pd_ = products.select("ProductCD", "ProductDesc").dropDuplicates(["ProductCD"])
    cards = staged(card_profile(master_card, banks, networks, users, accounts), "card-profile")
    if colocated:
        i = _pick(identity, list(IDENTITY_COLUMNS)).withColumnRenamed("TransactionID", "_dev_txn")
        t = t.join(i, F.col("TransactionID") == F.col("_dev_txn"), "left").drop("_dev_txn")
    loc = location_profile(location)

    # lookups that the size check broadcasts go first (no shuffle of the fact); then the
    # card side and the transaction-keyed identity side, one shuffle each at most
    limit = broadcast_limit(cards) if profile_limit is None else profile_limit
    heavy = heavy_keys(t, "card1", heavy_share) if heavy_share and stored_bytes(cards) > limit else []
    looked_up = (
        t.join(pd_, t["ProductCD"] == pd_["ProductCD"], "left")
        .drop(pd_["ProductCD"])
        .join(loc, t["addr1"] == loc["addr1"], "left")
        .drop(loc["addr1"])
    )
    carded = left_join_heavy(looked_up, cards, "card1", "Card_Raw_ID", heavy)
    if colocated:
        # written first, as the card profile is: most transactions may have no device name
        dev = staged(named_devices(devices), "named-devices")
        j = carded.join(dev, F.col("DeviceInfo") == F.col("Device_Name"), "left")
    else:
        dev = device_profile(identity, devices).withColumnRenamed("TransactionID", "_dev_txn")
        j = carded.join(dev, F.col("TransactionID") == F.col("_dev_txn"), "left").drop("_dev_txn")
    unk = F.lit("Unknown")
    return j.select(
        F.col("TransactionID"),
        seconds_after("TransactionDT").alias("Transaction_Time"),
        F.col("TransactionAmt").cast("double").alias("TransactionAmt"),
        F.col("isFraud").cast("int").alias("isFraud"),
        F.col("z_score").cast("double").alias("z_score"),
        F.coalesce("ProductDesc", unk).alias("ProductDesc"),
        F.coalesce("client_no", unk).alias("client_no"),
        F.coalesce("full_name", unk).alias("full_name"),
        F.coalesce("email_address", unk).alias("email_address"),
        F.coalesce("phone_number", unk).alias("phone_number"),
        F.coalesce("customer_segment", unk).alias("customer_segment"),
        F.coalesce(F.col("kyc_level").cast("int"), F.lit(0)).alias("kyc_level"),
        F.coalesce("account_number", unk).alias("account_number"),
        F.coalesce(F.col("current_balance").cast("string"), F.lit("0")).alias("current_balance"),
        F.coalesce("account_status", unk).alias("account_status"),
        unk.alias("Beneficiary_Name"),
        F.coalesce("Bank_Name", unk).alias("Bank_Name"),
        F.coalesce("Network_Name", unk).alias("Network_Name"),
        F.coalesce("Card_Type", unk).alias("Card_Type"),
        F.col("addr1").cast("double").alias("addr1"),
        F.col("addr2").cast("double").alias("addr2"),
        F.coalesce("Region", unk).alias("Region"),
        F.coalesce("Country", unk).alias("Country"),
        F.coalesce("DeviceType", unk).alias("DeviceType"),
        F.coalesce("Device_Name", unk).alias("Device_Name"),
        F.coalesce("OS_Version", unk).alias("OS_Version"),
        F.coalesce("Browser_Version", unk).alias("Browser_Version"),
        F.coalesce("Screen_Resolution", unk).alias("Screen_Resolution"),
    )
