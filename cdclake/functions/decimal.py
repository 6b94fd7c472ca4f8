"""NUMERIC values on the change stream: base64 big-endian bytes with a fixed scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BASE64 = r"^[A-Za-z0-9+/]+={0,2}$"
# Hex digits that conv() turns into an unsigned 64-bit value without loss.
_CHUNK = 15
_DEC = "decimal(38,0)"


def _unsigned(digits: Column) -> Column:
    """Big-endian hex digits of any length as a double.

    Up to 16 digits (8 bytes) go through one ``conv``. Of longer values the
    first 30 significant digits are exact decimals, far more than a double
    holds, and the rest is their power of 16. No lambda: the projection stays
    inside code generation.
    """
    short = F.ltrim(digits, F.lit("0"))
    n = F.length(short)
    part = lambda c: F.conv(c, 16, 10).cast(_DEC)
    head = F.substring(F.lpad(short, F.greatest(n, F.lit(2 * _CHUNK)), F.lit("0")), F.lit(1), F.lit(2 * _CHUNK))
    high, low = F.left(head, F.lit(_CHUNK)), F.right(head, F.lit(_CHUNK))
    exact = (part(high) * F.lit(16**_CHUNK).cast("decimal(19,0)") + part(low)).cast("double")
    wide = exact * F.pow(F.lit(16.0), F.greatest(n - 2 * _CHUNK, F.lit(0)))
    return F.when(F.length(digits) <= 16, F.conv(digits, 16, 10).cast("double")).otherwise(wide)


def decode_decimal(c: Column | str, scale: int = 3, signed: bool = False) -> Column:
    """Decode a base64 unscaled integer of any length to a double, guarded so nothing raises.

    Null, empty, badly padded or non-base64 input gives 0.0. The bytes are
    read as an unsigned big-endian integer (``signed=False``, the behaviour of
    the job this replaces) or as two's complement: a negative value is minus
    (its complement plus one), computed on the digits, so wide values keep
    their precision.
    """
    text = F.col(c) if isinstance(c, str) else c
    raw = F.try_to_binary(text, F.lit("base64"))
    digits = F.hex(raw)
    value = _unsigned(digits)
    if signed:
        complement = F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")
        value = F.when(F.substring(digits, 1, 1) >= "8", -(_unsigned(complement) + F.lit(1.0))).otherwise(value)
    bad = text.isNull() | (F.length(text) == 0) | (F.length(text) % 4 != 0) | ~text.rlike(_BASE64) | raw.isNull()
    return F.coalesce(F.when(bad, F.lit(0.0)).otherwise(value / F.lit(10.0**scale)), F.lit(0.0))


def encode_decimal(c: Column | str, scale: int = 3, nbytes: int = 5) -> Column:
    """Inverse of :func:`decode_decimal` (test and fixture side); negative values as two's complement."""
    value = F.col(c) if isinstance(c, str) else c
    unscaled = F.round(value * F.lit(10**scale)).cast("long")
    magnitude = F.lpad(F.hex(F.when(unscaled < 0, -unscaled - 1).otherwise(unscaled)), 2 * nbytes, "0")
    digits = F.when(unscaled < 0, F.translate(magnitude, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(magnitude)
    return F.base64(F.unhex(digits))
