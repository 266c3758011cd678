"""Zone names on the trip stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.operators.joins import broadcast_if_small


def enrich_with_zones(trips: DataFrame, locations: DataFrame) -> DataFrame:
    """Add the pickup zone's four columns; trips from an unknown zone are left out. The zones are counted here: a few are
    broadcast, more are shuffled."""
    zones = broadcast_if_small(locations.select("location_id", "borough", "zone", "service_zone"))
    return trips.join(zones, F.col("PULocationID") == F.col("location_id"), "inner")


def enrich_batches(zones: Callable[[], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Function of a batch that adds the zones as they are when the batch runs: ``zones`` reads them again each time, so
    changed names count from the next batch on, and a table that has grown is no longer broadcast."""
    return lambda batch: enrich_with_zones(batch, zones())
