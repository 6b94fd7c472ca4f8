"""Time helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the epoch that transaction second offsets count from.
TRANSACTION_EPOCH = _dt.datetime(2026, 1, 1, 0, 0, 0)
_EPOCH_1970 = _dt.datetime(1970, 1, 1, 0, 0, 0)


def seconds_after(offset: Column | str, epoch: _dt.datetime = TRANSACTION_EPOCH) -> Column:
    """``TIMESTAMP epoch + INTERVAL 1 SECOND * offset`` as a zone-free timestamp; null stays null."""
    secs = F.col(offset) if isinstance(offset, str) else offset
    return F.lit(epoch).cast("timestamp_ntz") + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since the epoch of a zone-free timestamp (read as UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH_1970).cast("timestamp_ntz"), c.cast("timestamp_ntz"))
