"""The framed Avro message: a zero byte, the schema id in four bytes, then the record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER_BYTES = 5


def strip_header(value: Column) -> Column:
    return F.substring(value, HEADER_BYTES + 1, 2**31 - 1)


def add_header(record: Column, schema_id: int) -> Column:
    header = F.lit(bytes([0]) + schema_id.to_bytes(HEADER_BYTES - 1, "big"))
    return F.concat(header, record)


def decode_envelope(
    df: DataFrame,
    avro_schema: str,
    mode: str = "FAILFAST",
    decode: Callable[[Column, str, dict[str, str]], Column] | None = None,
) -> DataFrame:
    """Message rows -> trip rows with the columns of the Avro record.

    ``mode`` FAILFAST stops at a broken message, PERMISSIVE turns it into NULLs. ``decode`` replaces
    the Avro reader, which needs the spark-avro package on the cluster.
    """
    if decode is None:
        from pyspark.sql.avro.functions import from_avro as decode
    record = decode(strip_header(F.col("value")), avro_schema, {"mode": mode})
    return df.select(record.alias("data")).select("data.*")
