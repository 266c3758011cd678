"""Tables in a database over JDBC; the vendor's driver comes with the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


# Databases whose dialect tells Spark that emptying a table leaves others alone; elsewhere Spark drops it.
KEEPS_TABLE = ("jdbc:postgresql:", "jdbc:mysql:", "jdbc:sqlserver:", "jdbc:h2:", "jdbc:derby:", "jdbc:mariadb:")


def create_clause(order_by: Sequence[str], engine: str = "MergeTree") -> str:
    """Clause that Spark appends to CREATE TABLE: storage engine and physical sort key."""
    keys = ", ".join(order_by)
    return f"ENGINE = {engine} ORDER BY {keys if len(order_by) == 1 else f'({keys})'}"


def writer_options(
    url: str,
    table: str,
    properties: dict[str, str],
    order_by: Sequence[str] = (),
    mode: str = "append",
    engine: str | None = "MergeTree",
    batch_rows: int = 50_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **properties}
    if order_by and engine:
        options["createTableOptions"] = create_clause(order_by, engine)
    if mode == "overwrite":
        if not url.startswith(KEEPS_TABLE):
            raise ValueError(
                f"Spark would drop and create {table} anew, and its declared types be lost: "
                "empty the table in the database, then append to it"
            )
        # Empty the table instead of dropping it, so its declared types and sort key stay.
        options["truncate"] = "true"
    return options


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    order_by: Sequence[str] = (),
    mode: str = "append",
    engine: str | None = "MergeTree",
    connections: int | None = None,
) -> None:
    """Append to a table, or replace its rows; every partition writes over its own connection."""
    if connections is not None:
        df = df.coalesce(connections)
    df.write.format("jdbc").mode(mode).options(
        **writer_options(url, table, properties, order_by, mode, engine)
    ).save()
