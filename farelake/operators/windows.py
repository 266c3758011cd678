"""Window functions over marts. Apply them to aggregated rows only, never to trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.functions.exact import money_parts


def moving_average(column: str, order_by: str, rows: int) -> Column:
    """Average of this and the ``rows - 1`` rows before it; missing dates are not filled in."""
    span = Window.orderBy(order_by).rowsBetween(1 - rows, 0)
    return F.round(F.avg(column).over(span), 2)


def moving_average_money(column: str, order_by: str, rows: int) -> Column:
    """The same for amounts already rounded to cents: summed as whole cents, divided once."""
    span = Window.orderBy(order_by).rowsBetween(1 - rows, 0)
    cents, rest = money_parts(column)
    total = F.sum(F.expr(cents)).over(span) + 100 * F.sum(F.expr(rest)).over(span)
    return F.round(total / (100 * F.nullif(F.count(column).over(span), F.lit(0))), 2)


def rank_desc(column: str, *partition_by: str) -> Column:
    """Rank by descending value, ties sharing a rank."""
    return F.rank().over(Window.partitionBy(*partition_by).orderBy(F.col(column).desc()))


def top_ranked(df: DataFrame, column: str, k: int, rank_name: str) -> DataFrame:
    """Rows of rank 1..k with their rank; ties at rank k are all kept.

    Spark drops lower ranks in every partition before it brings the rest together.
    """
    return df.withColumn(rank_name, rank_desc(column)).filter(F.col(rank_name) <= k)
