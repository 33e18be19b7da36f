"""Measures: what an aggregate reports, declared once and run three ways.

A measure is plain data (SQL expression text), so the same declaration drives
the batch aggregate, the signed aggregate over a change stream and the
restatement of stored state (see ``retally.operators.aggregate``).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

MONEY = "DECIMAL(20,4)"


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str                   # total | tally | heads | earliest | latest | fixed | ratio
    value: str | None = None    # expression; for a ratio the numerator measure
    where: str | None = None    # condition; for a ratio the denominator measure
    type: str = MONEY

    @property
    def summand(self) -> str:
        """What a total adds up per row."""
        return f"IF({self.where}, {self.value}, 0)" if self.where else self.value


def total(name: str, value: str, where: str | None = None, type: str = MONEY) -> Measure:
    """``SUM(value)``, or ``SUM(IF(where, value, 0))``.

    Null only when every summed input is null; a null condition adds zero.
    """
    return Measure(name, "total", value, where, type)


def tally(name: str, where: str, type: str = "BIGINT") -> Measure:
    """Number of rows for which ``where`` is true."""
    return Measure(name, "tally", None, where, type)


def filled(name: str, column: str, type: str = "BIGINT") -> Measure:
    """``COUNT(column)``: rows where the column is not null."""
    return tally(name, f"{column} IS NOT NULL", type)


def heads(name: str, value: str, where: str | None = None, type: str = "BIGINT") -> Measure:
    """``COUNT(DISTINCT IF(where, value, NULL))``."""
    return Measure(name, "heads", value, where, type)


def heads_of(name: str, parts: Iterable[str], where: str | None = None, type: str = "BIGINT") -> Measure:
    """Distinct combinations of several columns, a combination with a null part not counted.

    Same count as over the parts glued with a separator (a null part makes the
    text null), without building the text for every row.
    """
    parts = list(parts)
    whole = " AND ".join([f"{p} IS NOT NULL" for p in parts] + ([f"({where})"] if where else []))
    return Measure(name, "heads", f"struct({', '.join(parts)})", whole, type)


def earliest(name: str, value: str, type: str = "TIMESTAMP_NTZ") -> Measure:
    return Measure(name, "earliest", value, None, type)


def latest(name: str, value: str, type: str = "TIMESTAMP_NTZ") -> Measure:
    return Measure(name, "latest", value, None, type)


def fixed(name: str, literal: str, type: str) -> Measure:
    return Measure(name, "fixed", literal, None, type)


def ratio(name: str, numerator: str, denominator: str) -> Measure:
    """``-numerator / denominator`` over two finished totals: 0 when the denominator is 0."""
    return Measure(name, "ratio", numerator, denominator)
