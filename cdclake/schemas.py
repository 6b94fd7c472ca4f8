"""Declared schemas of the source tables, their keys, defaults and foreign keys.

Types are the silver (post-parse) types. Keys and serial ids are 64-bit so
the keys of very large tables fit. The change stream encodes values
the way a relational change-capture connector does: ``DATE`` as days since
the epoch (int), ``TIMESTAMP`` as microseconds since the epoch (long) and
``NUMERIC`` as base64 big-endian bytes (string, decoded by
:func:`cdclake.functions.decimal.decode_decimal`). Silver keeps these
values as they arrive, like the jobs this library re-implements.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "short": T.ShortType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields])


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    schema: T.StructType
    # column -> SQL expression used when the value is missing on insert
    defaults: dict[str, str] = field(default_factory=dict)
    # (columns, parent table, parent columns)
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    not_null: tuple[str, ...] = ()

    @property
    def topic(self) -> str:
        return f"{TOPIC_PREFIX}{self.name}"


# Topic naming of the change-capture connector.
TOPIC_PREFIX = "dbserver1.public."
TOPIC_PATTERN = r"dbserver1\.public\..+"


def transaction_fields() -> list[tuple[str, str]]:
    """The 394 fields of the transaction fact: 17 named + C1-14 + D1-15 + M1-9 + V1-339."""
    named = [
        ("TransactionID", "long"), ("isFraud", "int"), ("TransactionDT", "long"),
        ("TransactionAmt", "string"), ("ProductCD", "string"), ("card1", "long"),
        ("card2", "double"), ("card3", "double"), ("card4", "string"), ("card5", "double"),
        ("card6", "string"), ("addr1", "double"), ("addr2", "double"), ("dist1", "double"),
        ("dist2", "double"), ("P_emaildomain", "string"), ("R_emaildomain", "string"),
    ]
    numbered = (
        [(f"C{i}", "double") for i in range(1, 15)]
        + [(f"D{i}", "double") for i in range(1, 16)]
        + [(f"M{i}", "string") for i in range(1, 10)]
        + [(f"V{i}", "double") for i in range(1, 340)]
    )
    return named + numbered


def identity_fields() -> list[tuple[str, str]]:
    # id_12, 15, 16, 23, 27-31 and 33-38 are text; the other id_ columns are numbers.
    text_ids = {12, 15, 16, 23, 27, 28, 29, 30, 31, 33, 34, 35, 36, 37, 38}
    ids = [(f"id_{i:02d}", "string" if i in text_ids else "double") for i in range(1, 39)]
    return [("TransactionID", "long")] + ids + [("DeviceType", "string"), ("DeviceInfo", "string")]


TABLES: dict[str, TableSpec] = {
    "transaction": TableSpec("transaction", ("TransactionID",), struct(transaction_fields())),
    "identity": TableSpec("identity", ("TransactionID",), struct(identity_fields())),
    "user_profile": TableSpec(
        "user_profile",
        ("client_no",),
        struct([
            ("client_no", "string"), ("full_name", "string"), ("tax_code", "string"),
            ("identity_card_id", "string"), ("identity_type", "string"),
            ("raw_email_domain", "string"), ("raw_region_code", "int"),
            ("email_address", "string"), ("phone_number", "string"),
            ("permanent_address", "string"), ("kyc_level", "short"),
            ("customer_segment", "string"), ("status", "string"), ("created_at", "long"),
            ("created_by", "string"), ("updated_at", "long"), ("updated_by", "string"),
            ("deleted_at", "long"), ("deleted_reason", "string"),
        ]),
        defaults={
            "identity_type": "'CCCD'", "kyc_level": "CAST(1 AS SMALLINT)", "status": "'ACTIVE'",
            "created_at": "unix_micros(current_timestamp())", "created_by": "'SYSTEM_ETL'",
        },
    ),
    "user_accounts": TableSpec(
        "user_accounts",
        ("account_number",),
        struct([
            ("account_number", "string"), ("client_no", "string"),
            ("linked_raw_card_bin", "long"), ("linked_card_type", "string"),
            ("account_name", "string"), ("currency_code", "string"),
            ("current_balance", "string"), ("daily_transfer_limit", "string"),
            ("account_status", "string"), ("is_primary", "boolean"), ("opened_date", "int"),
            ("closed_date", "int"), ("created_at", "long"), ("created_by", "string"),
            ("deleted_at", "long"),
        ]),
        defaults={
            "currency_code": "'USD'", "account_status": "'OPEN'", "is_primary": "false",
            "opened_date": "unix_date(current_date())",
            "created_at": "unix_micros(current_timestamp())", "created_by": "'SYSTEM_ETL'",
        },
        foreign_keys=((("client_no",), "user_profile", ("client_no",)),),
        not_null=("client_no",),
    ),
    "master_card": TableSpec(
        "master_card",
        ("Card_Key",),
        struct([
            ("Card_Key", "long"), ("Card_Raw_ID", "long"), ("Client_No", "string"),
            ("Bank_ID", "long"), ("Card_Network_ID", "long"),
        ]),
        foreign_keys=(
            (("Client_No",), "user_profile", ("client_no",)),
            (("Bank_ID",), "card_issuing_bank", ("Bank_ID",)),
            (("Card_Network_ID",), "description_card", ("Card_Network_ID",)),
        ),
    ),
    "beneficiary_list": TableSpec(
        "beneficiary_list",
        ("Beneficiary_ID",),
        struct([
            ("Beneficiary_ID", "int"), ("Client_No", "string"), ("Beneficiary_Name", "string"),
            ("Beneficiary_Account", "string"), ("Beneficiary_Bank", "string"),
            ("Beneficiary_Email", "string"), ("Relation_Type", "string"), ("Date_Added", "int"),
        ]),
        defaults={"Date_Added": "unix_date(current_date())"},
    ),
    "card_issuing_bank": TableSpec(
        "card_issuing_bank",
        ("Bank_ID",),
        struct([
            ("Bank_ID", "long"), ("Bank_Name", "string"), ("Bank_Country_Code", "int"),
            ("Bank_Sub_Branch", "int"),
        ]),
    ),
    "description_card": TableSpec(
        "description_card",
        ("Card_Network_ID",),
        struct([
            ("Card_Network_ID", "long"), ("Network_Name", "string"), ("Card_Type", "string"),
            ("Network_Country", "string"), ("Support_Hotline", "string"),
        ]),
    ),
    "device_fingerprint": TableSpec(
        "device_fingerprint",
        ("Device_ID",),
        struct([
            ("Device_ID", "long"), ("Device_Name", "string"), ("Device_Type", "string"),
            ("OS_Version", "string"), ("Browser_Version", "string"),
            ("Screen_Resolution", "string"),
        ]),
    ),
    "product_description": TableSpec(
        "product_description",
        ("ProductCD",),
        struct([("ProductCD", "string"), ("ProductDesc", "string")]),
    ),
    "status": TableSpec(
        "status",
        ("StatusID",),
        struct([("StatusID", "int"), ("StatusCode", "string"), ("Description", "string")]),
    ),
    "location": TableSpec(
        "location",
        ("LocationID",),
        struct([
            ("LocationID", "long"), ("addr1", "double"), ("addr2", "double"),
            ("Region", "string"), ("Country", "string"),
        ]),
    ),
    "blacklist_rules": TableSpec(
        "blacklist_rules",
        ("Rule_ID",),
        struct([
            ("Rule_ID", "int"), ("Rule_Name", "string"), ("Criteria_Logic", "string"),
            ("Action_Type", "string"), ("Severity_Level", "int"), ("Created_Date", "long"),
            ("Is_Active", "boolean"),
        ]),
        defaults={"Created_Date": "unix_micros(current_timestamp())", "Is_Active": "true"},
    ),
}

# The twelve dimension tables handled by the silver dimension job, in job order.
DIMENSION_TABLES = (
    "identity", "user_profile", "location", "card_issuing_bank", "device_fingerprint",
    "beneficiary_list", "user_accounts", "master_card", "blacklist_rules",
    "product_description", "status", "description_card",
)

# The thirteen bronze tables checked by the row-count report.
BRONZE_TABLES = (
    "transaction", "user_accounts", "user_profile", "status", "beneficiary_list",
    "blacklist_rules", "card_issuing_bank", "description_card", "device_fingerprint",
    "identity", "location", "master_card", "product_description",
)

# Raw change-stream record, as delivered by a Kafka source.
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
])


def envelope_schema(after: T.StructType, before: T.StructType | None = None) -> T.StructType:
    """``{"payload": {"before", "after", "op", "source": {"ts_ms"}}}`` around a row schema.

    ``before`` defaults to the row schema; readers that only need the key of a
    delete pass the key fields alone.
    """
    return T.StructType([
        T.StructField("payload", T.StructType([
            T.StructField("before", after if before is None else before, True),
            T.StructField("after", after, True),
            T.StructField("op", T.StringType(), True),
            T.StructField("source", T.StructType([T.StructField("ts_ms", T.LongType(), True)]), True),
        ]), True),
    ])
