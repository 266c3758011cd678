"""Literal lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def static_dim(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A handful of literal rows as a local relation: no Python worker, and Spark knows its size."""
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema=schema)
