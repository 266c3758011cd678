"""Additive state for sums and averages of money, exact to the cent.

A plain sum of doubles changes its last digits with the partitioning, which shows once an average
is rounded at a tie, and a decimal sum costs over ten times as much per row. So each value is
split into whole cents (a long, summed exactly) and what is left below a cent (a double, 0 for
clean data). Both parts are plain sums: Spark combines them before the shuffle, and a state can
be merged again to a coarser grain without losing anything.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE = ["trip_time_seconds", "passenger_count"]


def money_parts(name: str) -> tuple[str, str]:
    """Whole cents of a column and what is left, as SQL; the latter is NULL where the column is."""
    # What does not fit a long (NaN, infinity) stays in the double part.
    cents = f"coalesce(try_cast(rint({name} * 100) AS bigint), 0)"
    return cents, f"{name} - {cents} / 100D"


def _state(name: str, averaged: bool, extremes: bool) -> dict[str, str]:
    """State columns of one measure and the aggregate that fills each."""
    if name in WHOLE:
        parts = {f"{name}__sum": f"sum(bigint({name}))"}
    else:
        cents, rest = money_parts(name)
        parts = {f"{name}__cents": f"sum({cents})", f"{name}__rest": f"sum({rest})"}
    if averaged:
        parts[f"{name}__n"] = f"count({name})"
    if extremes:
        parts |= {f"{name}__max": f"max({name})", f"{name}__min": f"min({name})"}
    return parts


@dataclass(frozen=True)
class Measures:
    """What a mart needs to know about its groups, apart from their number of rows."""

    totals: tuple[str, ...] = ()
    means: tuple[str, ...] = ()
    extremes: tuple[str, ...] = ()

    def _parts(self) -> dict[str, str]:
        names = dict.fromkeys([*self.means, *self.totals, *self.extremes])
        parts = {"n": "count(*)"}
        for name in names:
            parts |= _state(name, name in self.means, name in self.extremes)
        return parts

    def of_rows(self, rows: DataFrame, keys: Iterable[str]) -> DataFrame:
        """Rows -> one state row per key."""
        return rows.groupBy(*keys).agg(*[F.expr(f"{part} AS {name}") for name, part in self._parts().items()])

    def of_states(self, states: DataFrame, keys: Iterable[str]) -> DataFrame:
        """State rows, of these measures or more -> state rows at a coarser grain."""

        def merged(name: str) -> str:
            how = name[-3:] if name.endswith(("__max", "__min")) else "sum"
            return f"{how}({name}) AS {name}"

        return states.groupBy(*keys).agg(*[F.expr(merged(name)) for name in self._parts()])

    def __or__(self, other: Measures) -> Measures:
        return Measures(*[tuple(dict.fromkeys(getattr(self, f) + getattr(other, f))) for f in _FIELDS])


_FIELDS = ("totals", "means", "extremes")


def _in_cents(name: str) -> Column:
    return F.expr(f"{name}__cents + 100 * {name}__rest")


def total(name: str) -> Column:
    return F.round(_in_cents(name) / 100, 2)


def mean(name: str) -> Column:
    """Average rounded to two decimals; one correctly rounded division, NULL for an empty group."""
    count = F.expr(f"nullif({name}__n, 0)")
    if name in WHOLE:
        return F.round(F.col(f"{name}__sum") / count, 2)
    return F.round(_in_cents(name) / (100 * count), 2)
