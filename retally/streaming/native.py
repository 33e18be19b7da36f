"""Reports whose state Structured Streaming keeps itself.

``running``          sums and counts: one streaming aggregation in update mode.
``distinct_heads``   distinct counts with reference counts in keyed state, with
                     an optional time to live.
``per_window``       counts per time window, bounded by a watermark; ``closed_windows`` each once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from retally.operators.aggregate import ROWS, SIGN, Aggregate, deltas, finished_deltas


EVENT_TIME = "event_time"


def bounded(df: DataFrame, column: str = "update_time", lateness: str = "5 minutes") -> DataFrame:
    """Declare how late rows may be; nothing is dropped unless an operator below asks for it.

    A watermark needs an instant, so the zone-less ``column`` is read as UTC
    into ``event_time``; the column itself stays.
    """
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column))
    return df.withColumn(EVENT_TIME, local.cast("timestamp")).withWatermark(EVENT_TIME, lateness)


def once_within(changes: DataFrame, identity: Sequence[str], column: str, lateness: str) -> DataFrame:
    """Each change once when the log may deliver it again; identities are remembered for ``lateness``."""
    return bounded(changes, column, lateness).dropDuplicatesWithinWatermark(list(identity)).drop(EVENT_TIME)


def running(signed: DataFrame, agg: Aggregate) -> DataFrame:
    """Streaming aggregate of signed rows for update mode.

    Rows are the group's current values and ``op``: ``u`` to write, ``d`` once
    the group has no rows left.  For sums, counts, ratios and constants;
    distinct counts and extremes need ``retally.streaming.restate``.
    """
    if agg.slots(True):
        raise ValueError(f"{agg.name} counts distinct values or extremes; use Restatement")
    plain = replace(agg, factors=())
    return finished_deltas(deltas(signed, plain), plain)


class _References(StatefulProcessor):
    """How often each value of a group is referenced; one row out per group and batch."""

    def __init__(self, keys: Sequence[str], ttl_ms: int | None):
        self.keys, self.ttl_ms = list(keys), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        value = T.StructType([T.StructField("value", T.StringType())])
        count = T.StructType([T.StructField("n", T.LongType())])
        self.seen = handle.getMapState("seen", value, count, self.ttl_ms)
        self.alive = handle.getValueState("alive", count, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        net: dict[str, int] = {}
        for pdf in rows:
            for value, n in pdf.groupby("counted")["change"].sum().items():
                net[value] = net.get(value, 0) + int(n)
        alive = self.alive.get()[0] if self.alive.exists() else 0
        for value, n in net.items():
            had = self.seen.getValue((value,))[0] if self.seen.containsKey((value,)) else 0
            alive += int(had + n > 0) - int(had > 0)
            if had + n:
                self.seen.updateValue((value,), (had + n,))
            elif had:
                self.seen.removeKey((value,))
        self.alive.update((alive,))
        yield pd.DataFrame({**{k: [v] for k, v in zip(self.keys, key)}, "heads": [alive]})

    def close(self) -> None:
        pass


# state processors receive no column whose name starts with an underscore
SALT = "piece"


def distinct_heads(signed: DataFrame, keys: Sequence[str], value: str, salts: int = 16,
                   ttl_ms: int | None = None) -> DataFrame:
    """Distinct values per group over a stream of signed rows (needs the RocksDB state store).

    A group is kept in ``salts`` pieces by the hash of the value, so a group
    with a third of all rows is spread; add the pieces with ``heads_of_pieces``.
    With ``ttl_ms`` a value not touched for that long is forgotten, as in a job
    that bounds its state; without it counts stay exact.
    """
    typed = signed.where(F.col(value).isNotNull()).select(
        *keys, F.pmod(F.xxhash64(value), F.lit(salts)).cast("int").alias(SALT),
        F.col(value).cast("string").alias("counted"), F.col(SIGN).cast("long").alias("change"))
    grouped = [*keys, SALT]
    out = T.StructType([typed.schema[k] for k in grouped] + [T.StructField("heads", T.LongType())])
    return typed.groupBy(*grouped).transformWithStateInPandas(
        _References(grouped, ttl_ms), out, "Update", "ProcessingTime" if ttl_ms else "None")


def heads_of_pieces(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct count per group from the latest row of each of its pieces."""
    return pieces.groupBy(*keys).agg(F.sum("heads").alias("heads")).where("heads > 0")


def closed_windows(rows: DataFrame, column: str, width: str, lateness: str, keys: Sequence[str] = ()) -> DataFrame:
    """Windows of a stream, each once, when no row of it is expected any more (append mode).

    The watermark is the latest time seen in earlier batches less ``lateness``.  Rows of windows that ended before
    it are left out; ``late_rows`` counts them.
    """
    return per_window(bounded(rows, column, lateness), column, width, keys)


def late_rows(query: StreamingQuery) -> int:
    """Rows a query has dropped as late so far (those of one window and task that were added up before count as one)."""
    return sum(operator.numRowsDroppedByWatermark for progress in query.recentProgress for operator in progress.stateOperators)


def per_window(df: DataFrame, column: str, width: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per tumbling window (logins per minute, orders per hour); batch or stream.

    Windows of a ``bounded`` stream are taken over its ``event_time``.
    """
    if EVENT_TIME in df.columns:
        column = EVENT_TIME
    counted = df.groupBy(F.window(column, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("rows_in_window"))

    def wall(edge: str):
        at = F.col(f"w.{edge}")
        if column == EVENT_TIME:
            at = F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))
        return at.alias(f"window_{edge}")

    return counted.select(wall("start"), wall("end"), *keys, "rows_in_window")
