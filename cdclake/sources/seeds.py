"""Literal seed tables of the source database (five rows each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cdclake.schemas import TABLES

# Seed rows of product_description (ProductCD, ProductDesc).
PRODUCT_DESCRIPTION = [
    ("W", "Web Transaction (Giao dịch qua Web)"),
    ("C", "Credit Payment (Thanh toán tín dụng)"),
    ("R", "Retail (Bán lẻ)"),
    ("H", "High Value (Giao dịch giá trị cao)"),
    ("S", "Service (Dịch vụ)"),
]

# Seed rows of status (StatusID, StatusCode, Description).
STATUS = [
    (1, "PENDING", "Giao dịch đang chờ xử lý"),
    (2, "COMPLETED", "Giao dịch thành công"),
    (3, "FAILED", "Giao dịch thất bại"),
    (4, "BLOCKED", "Giao dịch bị chặn do nghi ngờ gian lận"),
    (5, "REVIEW", "Giao dịch cần kiểm tra thủ công"),
]

# Seed rows of blacklist_rules (Rule_Name, Criteria_Logic, Action_Type, Severity_Level).
# The criteria are stored text; nothing evaluates them.
BLACKLIST_RULES = [
    ("High Amount Transaction", "TransactionAmt > 5000 AND card_type = Credit", "ALERT", 5),
    ("Foreign IP Address", "addr2 != Billing_Country_Code", "2FA_REQ", 7),
    ("Blacklisted Device", "Device_ID IN (SELECT Blacklisted_Device_ID FROM blacklist_devices)", "BLOCK", 10),
    ("High Velocity", "Transaction_Count_1Min > 5", "BLOCK", 9),
    ("Suspicious Email Domain", "P_emaildomain IN (protonmail.com, tempmail.org)", "REVIEW", 6),
]


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A literal table as an inline ``VALUES`` relation: the planner knows its exact size,
    so a join against it is broadcast by the size check, not by a blind hint."""
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(f"c{i}" for i in range(len(schema.fields)))
    cols = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({names})")


def product_description(spark: SparkSession) -> DataFrame:
    return values_table(spark, PRODUCT_DESCRIPTION, TABLES["product_description"].schema)


def status(spark: SparkSession) -> DataFrame:
    return values_table(spark, STATUS, TABLES["status"].schema)


def blacklist_rules(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, n, c, a, s, None, True) for i, (n, c, a, s) in enumerate(BLACKLIST_RULES)]
    return values_table(spark, rows, TABLES["blacklist_rules"].schema)
