"""Tables in a database over JDBC; the vendor's driver comes with the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_options(
    url: str,
    table: str,
    properties: dict[str, str],
    column: str | None = None,
    lower: object | None = None,
    upper: object | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. With a column and its range the read is split into that many queries."""
    options = {"url": url, "dbtable": table, **properties}
    split = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    given = {k: str(v) for k, v in split.items() if v is not None}
    if given and len(given) != len(split):
        raise ValueError("a split read needs column, lower, upper and partitions together")
    return options | given


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    column: str | None = None,
    lower: object | None = None,
    upper: object | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Whole table, or a range-split read: rows beyond the bounds go to the first and last part. The column is a
    number, a date or a timestamp; the bounds of the latter two are texts.

    Without a split one task reads the table: use that for lookup tables, never for the fact.
    """
    return (
        spark.read.format("jdbc")
        .options(**table_options(url, table, properties, column, lower, upper, partitions))
        .load()
    )


#: Bounds that are looked for in a sample for each part.
FINE = 8


def split_predicates(sample: DataFrame, column: str, parts: int, tie: str | None = None) -> list[str]:
    """About ``parts`` SQL conditions on ``column`` that hold about equally many rows each and every row once, nulls
    too. ``sample`` holds values of ``column`` as they are distributed in the table: moments, dates, or numbers that a
    double holds exactly.

    The bounds are quantiles of the sample, so hot hours get narrower ranges. A single value, or null, with about a
    part's share is taken out of its range; one with more is split by ``tie``, a column of whole numbers.
    """
    moments = sample.schema[column].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")
    number = F.unix_micros(F.col(column).cast("timestamp")) if moments else F.col(column)
    values = sample.select(number.cast("double").alias("v"), F.col(column).cast("string").alias("text"))
    shares = [k / (FINE * parts) for k in range(1, FINE * parts)]
    bounds = sorted(set(values.approxQuantile("v", shares, 1 / (2 * FINE * parts)))) if parts > 1 else []
    if not bounds:
        return ["1 = 1"]
    # Rows by the number of bounds up to a value, and whether it is the last of these.
    known = F.array(*map(F.lit, bounds))
    cells = values.groupBy(
        F.col("v").isNull().alias("none"),
        F.size(F.filter(known, lambda b: b <= F.col("v"))).alias("up_to"),
        F.array_contains(known, F.col("v")).alias("on"),
    ).agg(F.count("*").alias("n"), F.min("text").alias("text"))
    counts = {(r.none, r.up_to, r.on): (r.n, r.text) for r in cells.collect()}
    total = sum(n for n, _ in counts.values())
    ideal = total / parts

    def apart(condition: str, rows: int) -> list[str]:
        if rows < 0.75 * ideal:
            return []
        pieces = round(rows / ideal) if tie else 1
        if pieces <= 1:
            return [condition]
        return [f"{condition} AND mod(abs(coalesce({tie}, 0)), {pieces}) = {k}" for k in range(pieces)]

    nulls = sum(n for (none, _, _), (n, _) in counts.items() if none)
    found = apart(f"{column} IS NULL", nulls)
    null_with = [] if found else [f"{column} IS NULL"]
    ordered = sorted(((up_to, not on), n, text) for (none, up_to, on), (n, text) in counts.items() if not none)
    texts = {up_to: f"'{text}'" if moments else text for (up_to, after), _, text in ordered if not after}
    hot = {}
    for (up_to, after), n, _ in ordered:
        if not after and (pieces := apart(f"{column} = {texts[up_to]}", n)):
            found += pieces
            hot[up_to] = n
    rest = total - sum(hot.values()) - (0 if null_with else nulls)
    groups = max(1, round(rest / ideal))
    held, low, out = nulls if null_with else 0, None, []

    def close(high: str | None) -> None:
        inside = [c for c in (low, high) if c]
        inside += [f"{column} <> {texts[k]}" for k in hot]
        out.append(" AND ".join(inside) or f"{column} IS NOT NULL")

    filled = 0
    for (up_to, after), n, _ in ordered:
        if not after and up_to in hot:
            continue
        # Cut before this cell if that is nearer to an even share.
        if len(out) + 1 < groups and held and filled + held + n / 2 > rest * (len(out) + 1) / groups:
            bound = texts[up_to]
            close(f"{column} <= {bound}" if after else f"{column} < {bound}")
            low = f"{column} > {bound}" if after else f"{column} >= {bound}"
            filled, held = filled + held, 0
        held += n
    close(None)
    if null_with:
        out[0] = f"({out[0]}) OR {null_with[0]}"
    return found + out


def read_parts(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], predicates: Sequence[str]
) -> DataFrame:
    """Table as one read for each of ``predicates``."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)


def read_sample(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str, key: str | None, every: int
) -> DataFrame:
    """``column`` of each row whose whole-number ``key`` divides by ``every``, or of all rows without a key."""
    where = f" WHERE mod({key}, {every}) = 0" if key else ""
    query = f"SELECT {column} FROM {table}{where}"
    return spark.read.format("jdbc").options(url=url, query=query, **properties).load()


def read_span(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str
) -> tuple[str, str] | None:
    """First and last value of a timestamp column, as bounds of a split read; None for an empty table."""
    query = f"SELECT min({column}) AS lo, max({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **properties).load().head()
    return None if row is None or row["lo"] is None else (str(row["lo"]), str(row["hi"]))


def require_database(spark: SparkSession, name: str) -> None:
    """Fail early if the target database is not in the catalog."""
    if not spark.catalog.databaseExists(name):
        raise LookupError(f"database {name!r} does not exist")


def require_jdbc(spark: SparkSession, url: str, properties: dict[str, str], probe: str = "SELECT 1 AS ok") -> None:
    """Fail early if the target database cannot be reached or queried."""
    try:
        spark.read.format("jdbc").options(url=url, query=probe, **properties).load().head()
    except Exception as error:
        raise LookupError(f"cannot query {url}") from error
