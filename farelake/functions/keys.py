"""Message key and epoch milliseconds of the published trip events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trip_key(vendor: str = "VendorID", pickup: str = "tpep_pickup_datetime") -> Column:
    """``vendor:yyyy-MM-dd``; a NULL part is left out, so the key itself is never NULL."""
    return F.concat_ws(":", F.col(vendor), F.col(pickup).cast("date"))


def epoch_millis(column: str) -> Column:
    """Milliseconds since 1970 UTC; a wall-clock column is read in the session's time zone."""
    return F.unix_millis(F.col(column).cast("timestamp"))
