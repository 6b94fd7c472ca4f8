"""Column shaping: declared defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.schemas import TableSpec


def apply_defaults(df: DataFrame, spec: TableSpec, skip: Sequence[str] = ()) -> DataFrame:
    """Shape ``df`` to the table's schema: missing values take the column default, absent
    columns without a default are null. ``skip`` leaves columns out (e.g. load times)."""
    cols = []
    for fld in spec.schema.fields:
        if fld.name in skip:
            continue
        present = F.col(fld.name).cast(fld.dataType) if fld.name in df.columns else F.lit(None).cast(fld.dataType)
        default = spec.defaults.get(fld.name)
        value = F.coalesce(present, F.expr(default).cast(fld.dataType)) if default else present
        cols.append(value.alias(fld.name))
    return df.select(*cols)
