"""Column functions: every one is a composition of Spark built-ins."""

from cdclake.functions.decimal import decode_decimal, encode_decimal
from cdclake.functions.strings import (
    email_local_part,
    falsy_default,
    normalize_column_name,
    title_word,
    truncate,
    zero_pad,
)
from cdclake.functions.timefn import epoch_millis, seconds_after

__all__ = [
    "decode_decimal", "encode_decimal", "email_local_part", "epoch_millis", "falsy_default",
    "normalize_column_name", "seconds_after", "title_word", "truncate", "zero_pad",
]
