"""Dimension mirrors: a keyed table kept equal to its source."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from retally.operators import changelog as C
from retally.operators.cleanse import masked
from retally.schemas import Table

# fixed values: columns that are never copied unless asked for
SECRETS = ("password",)


def mirror(changes: DataFrame, table: Table, exclude: Iterable[str] = SECRETS, hashed: Iterable[str] = ()) -> DataFrame:
    """The mirrored table after a snapshot and its changes."""
    return masked(C.current_rows(changes, table.key), exclude, hashed)


def snapshot_then_changes(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Start from a whole table, go on with its changes."""
    return C.snapshot(rows).unionByName(changes)
