"""Trips and zones from files, at rest or as a rate-limited stream."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators.clean import conform_trips
from farelake.operators.star import dim_location
from farelake.schemas import ZONE_CSV

_UNLIKE = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
_ANY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def read_trips(spark: SparkSession, path: str, mixed: bool = False) -> DataFrame:
    """Trip files; a trial run is given fewer of them. ``mixed``: their columns differ in physical type, as they do
    between months; the footers of all files are read first (see ``read_trip_files``)."""
    if not mixed:
        return spark.read.parquet(path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return read_trip_files(spark, [unquote(name) for name in listed.inputFiles()])


def _together(spark: SparkSession, files: Sequence[str]) -> T.StructType | None:
    """The one schema of ``files``, or None if a column has several types. One job reads all their footers."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*files).schema
    except (PySparkException, Py4JJavaError) as error:
        if any(name in str(error) for name in _UNLIKE):
            return None
        raise


def _kinds(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in schema}


def alike_files(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """``files`` in groups that can be read as one table: (schema, files) of each.

    Files that don't fit together are halved, in the order of their names, until they do. Types change from one month on,
    so a few halvings find the months; groups that fit each other are then put together again.
    """

    def halved(names: list[str]) -> list[tuple[T.StructType, list[str]]]:
        schema = _together(spark, names)
        if schema is not None:
            return [(schema, names)]
        middle = len(names) // 2
        return halved(names[:middle]) + halved(names[middle:])

    groups: list[tuple[T.StructType, list[str]]] = []
    for schema, names in halved(sorted(files)):
        kinds = _kinds(schema)
        for k, (other, there) in enumerate(groups):
            known = _kinds(other)
            if all(known.get(name, kind) == kind for name, kind in kinds.items()):
                more = [f for f in schema if f.name.lower() not in known]
                groups[k] = (T.StructType([*other, *more]), there + names)
                break
        else:
            groups.append((schema, names))
    return groups


def read_trip_files(spark: SparkSession, files: Sequence[str], optional: Collection[str] = ()) -> DataFrame:
    """Files of one or more physical types as one table with the columns and types of the trip schema.

    Each group of alike files is read in its own types and conformed, then all are joined by name. A column that only
    other files have is NULL; one that no file has is an error, as it is for alike files, but for ``optional``. Pickup and dropoff times stay
    wall-clock times if they are so in all files, else they are read in the session's time zone.
    """
    if not files:
        raise ValueError("no trip files")
    groups = alike_files(spark, files)
    known = {name for schema, _ in groups for name in _kinds(schema)} | set(optional)
    tables = [conform_trips(spark.read.schema(s).parquet(*names), optional=known) for s, names in groups]
    return reduce(DataFrame.unionByName, tables)


def replay_file_names(
    spark: SparkSession, path: str, max_files: int | None = 1, max_bytes: int | None = None, latest_first: bool = True
) -> DataFrame:
    """Stream of the trip files' names, limited like ``replay_trips``; their contents are not read."""
    names = spark.readStream.format("binaryFile").schema(_ANY_FILE).options(**_limits(max_files, max_bytes, latest_first))
    return names.option("recursiveFileLookup", "true").load(path).select("path")


# Fees that older trip files don't have.
LATER_FEES = ("congestion_surcharge", "airport_fee", "cbd_congestion_fee")


def mixed_batches(
    write: Callable[[DataFrame, int], None], optional: Collection[str] = LATER_FEES
) -> Callable[[DataFrame, int], None]:
    """Per-batch function over ``replay_file_names``: hands ``write`` the trips of the batch's files, in whatever types
    these store them. A file of new types may come at any time; columns of ``optional`` that no file of a batch has are
    NULL in it. The names of a batch, no more than its limit of files, pass through the driver."""

    def run(names: DataFrame, batch_id: int) -> None:
        files = [row.path for row in names.collect()]
        if files:
            write(read_trip_files(names.sparkSession, files, optional), batch_id)

    return run


def read_landed_trips(spark: SparkSession, path: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Trips landed by pickup day; year and month prune the folders that are listed and read."""
    trips = spark.read.parquet(path)
    for name, value in (("year", year), ("month", month)):
        if value is not None:
            trips = trips.filter(F.col(name) == value)
    return trips.drop("year", "month", "day")


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header line -> location dimension."""
    return dim_location(spark.read.schema(ZONE_CSV).csv(path, header=True, enforceSchema=False))


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    """Schema for a file stream, taken from the files already there."""
    return spark.read.parquet(path).schema


def replay_trips(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files: int | None = 1,
    max_bytes: int | None = None,
    latest_first: bool = True,
    **options: str,
) -> DataFrame:
    """Stream of the trip files, limited per trigger by files or by bytes, newest file first.

    Files count as new however old they are: unless ``maxFileAge`` is given, it is set beyond any file's age. (Spark
    otherwise skips files a week older than the newest it has seen, when the oldest come first.)
    """
    return (
        spark.readStream.schema(schema or schema_of(spark, path))
        .options(**_limits(max_files, max_bytes, latest_first))
        .options(**options)
        .parquet(path)
    )


def _limits(max_files: int | None, max_bytes: int | None, latest_first: bool) -> dict[str, str]:
    if (max_files is None) == (max_bytes is None):
        raise ValueError("give exactly one of max_files and max_bytes")
    if max_files is not None:
        limit, value = "maxFilesPerTrigger", max_files
    else:
        limit, value = "maxBytesPerTrigger", max_bytes
    if not isinstance(value, int) or isinstance(value, bool) or value <= 0:
        raise ValueError(f"{limit} must be a positive whole number, not {value!r}")
    return {limit: str(value), "latestFirst": str(latest_first).lower(), "maxFileAge": "36500d"}
