"""String shaping used by entity generation and previews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_pad(c: Column | str, width: int) -> Column:
    """Left-pad a number with zeros to ``width`` digits; longer numbers are kept whole."""
    return F.format_string(f"%0{width}d", _c(c).cast("long"))


def truncate(c: Column | str, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(c), 1, n)


def falsy_default(c: Column | str, default: str) -> Column:
    """Replace null or empty text with ``default``."""
    return F.coalesce(F.nullif(_c(c).cast("string"), F.lit("")), F.lit(default))


def title_word(c: Column | str) -> Column:
    """Capitalise the first letter of each word and lower-case the rest."""
    return F.initcap(_c(c))


def normalize_column_name(name: str) -> str:
    """``id-01 `` -> ``id_01``."""
    return name.replace("-", "_").strip()


def email_local_part(c: Column | str) -> Column:
    """``Jane Doe`` -> ``jane.doe``."""
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit("."))
