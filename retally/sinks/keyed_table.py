"""Keyed targets: the last write of a key wins, a delete removes it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from retally.operators.changelog import changed_keys
from retally.operators.conform import enforce_not_null
from retally.sinks.batch_log import BatchLog


#: Stored bytes behind one task that reads a table as a whole (zstd; some ten times as much when shuffled).
TASK_BYTES = 4 << 20
_PLACE = T.StructType([T.StructField("ts_ms", T.LongType()), T.StructField("pos", T.LongType())])


def _order():
    """Place of a change; at one place the delete of an update comes before its insert."""
    return F.struct("at", F.col("op") != "d")


class KeyedTable:
    """A keyed table over files, written by change batches (before, after, op).

    The stored batches are themselves the change stream of the table, so a
    reader can follow it instead of the table.  Changes that carry their place
    (ts_ms, pos) are applied in that order, whatever batch they arrive in;
    ``keep_deleted`` then remembers deletes, so that a late older change cannot
    bring a row back.  Other changes are applied batch by batch.

    ``late`` bounds how long: changes (which then need a place) further behind the latest ``ts_ms`` of the batches
    before are left out, those without a ``ts_ms`` too, and a compaction forgets deletes that are further behind, as no
    change that is still taken could be older than them.
    """

    def __init__(self, spark: SparkSession, path: str, row: T.StructType, key: Sequence[str],
                 cluster: Sequence[str] = (), keep_deleted: bool = False, late: int | None = None):
        self.row, self.key, self.cluster = row, list(key), list(cluster)
        self.keep_deleted, self.late = keep_deleted or late is not None, late
        lead = T.StructType([T.StructField(f"_p_{p}", row[p].dataType) for p in cluster])
        schema = T.StructType(lead.fields + [T.StructField("before", row), T.StructField("after", row),
                                             T.StructField("op", T.StringType()), T.StructField("at", _PLACE)])
        self.log = BatchLog(spark, path, schema, [f"_p_{p}" for p in cluster])
        self.marks = BatchLog(spark, f"{path}/marks", T.StructType.fromDDL("ts_ms BIGINT"))

    def write(self, batch: int, changes: DataFrame, as_dealt: bool = False) -> None:
        """Changes of distinct keys; collapse a batch with ``last_changes`` first if need be.

        ``as_dealt``: see ``BatchLog.write``.
        """
        lead = [F.coalesce(F.col(f"after.{p}"), F.col(f"before.{p}")).alias(f"_p_{p}") for p in self.cluster]
        to_row = lambda c: F.col(c).cast(self.row).alias(c)
        placed = {"ts_ms", "pos"} <= set(changes.columns)
        if self.late is not None:
            if not placed:
                raise ValueError("changes of a table with a bound on lateness need ts_ms and pos")
            mark = self._mark(batch)
            changes = changes.where(F.col("ts_ms").isNotNull() if mark is None else F.col("ts_ms") >= mark)
        at = F.struct("ts_ms", "pos") if placed else F.struct(F.lit(batch).alias("ts_ms"), F.lit(0).alias("pos"))
        self.log.write(batch, changes.select(*lead, to_row("before"), to_row("after"), "op", at.cast(_PLACE).alias("at")), as_dealt)
        if self.late is not None:
            self.marks.write(batch, self.log.one(batch).agg(F.max("at.ts_ms").alias("ts_ms")))

    def _mark(self, before: int) -> int | None:
        """The earliest time that is still taken, from the batches before one."""
        latest = self.marks.read(before).agg(F.max("ts_ms")).first()[0]
        return None if latest is None else latest - self.late

    def _tasks(self, before: int | None) -> int | None:
        """As many tasks as keep each bounded that reads the table as a whole, where a shuffle has fewer."""
        tasks = -(-self.log.size(before) // TASK_BYTES)
        return tasks if tasks > int(self.log.spark.conf.get("spark.sql.shuffle.partitions")) else None

    def _by_key(self, stored: DataFrame, before: int | None) -> DataFrame:
        """Stored changes with their keys, dealt out over as many tasks as keep each bounded."""
        keyed, tasks = changed_keys(stored, self.key), self._tasks(before)
        return keyed.repartition(tasks, *[f"_k_{k}" for k in self.key]) if tasks else keyed

    def changes(self, batch: int) -> DataFrame:
        return self.log.one(batch).select("before", "after", "op")

    def current(self, before: int | None = None, keys: DataFrame | None = None, prune=None) -> DataFrame:
        """The rows now (or before a batch), all or those of some keys (a small frame of key columns).

        ``prune`` is a condition on the stored cluster columns.
        """
        stored = self.log.read(before)
        if prune is not None:
            stored = stored.where(prune)
        if keys is not None:
            stored = only_keys(changed_keys(stored, self.key), keys, {k: f"_k_{k}" for k in self.key})
            names = [f"_k_{k}" for k in self.key]
        else:
            stored, names = self._by_key(stored, before), [f"_k_{k}" for k in self.key]
        last = F.max_by("after", _order())
        return stored.groupBy(*names).agg(last.alias("row")).where("row IS NOT NULL").select("row.*")

    def compact(self, upto: int, every: int) -> bool:
        def fold(stored: DataFrame) -> DataFrame:
            names = [f"_k_{k}" for k in self.key]
            lead = [f"_p_{p}" for p in self.cluster]
            keyed = changed_keys(stored, self.key) if self.cluster else self._by_key(stored, upto + 1)
            last = keyed.groupBy(*names, *lead).agg(
                F.max_by("after", _order()).alias("after"), F.max_by("before", _order()).alias("before"), F.max("at").alias("at"))
            gone = F.col("after").isNull()
            last = last if self.keep_deleted else last.where(~gone)
            last = last if mark is None else last.where(~gone | (F.col("at.ts_ms") >= mark))
            return last.select(*lead, F.when(gone, F.col("before")).alias("before"), "after",
                               F.when(gone, "d").otherwise("c").alias("op"), "at")

        mark = self._mark(upto + 1) if self.late is not None else None
        if self.late is not None:
            self.marks.compact(upto, lambda marks: marks.agg(F.max("ts_ms").alias("ts_ms")), every)
        cut = [F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")) for k in self.key]
        return self.log.compact(upto, fold, every, cut, self._tasks(upto + 1) if self.cluster else None)


def only_keys(df: DataFrame, keys: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``; null key columns match null."""
    names = names or {k: k for k in keys.columns}
    on = None
    right = keys.select(*[F.col(k).alias(f"_w_{k}") for k in names])
    for k, column in names.items():
        same = F.col(column).eqNullSafe(F.col(f"_w_{k}"))
        on = same if on is None else on & same
    return df.join(right, on, "left_semi")


class NotNullKey:
    """A target in front of another that leaves out, or fails on, changes with a null in the key."""

    def __init__(self, target, key: Sequence[str], on_null: str = "drop"):
        self.target, self.key, self.on_null = target, list(key), on_null

    def write(self, batch: int, changes: DataFrame) -> None:
        keyed = enforce_not_null(changed_keys(changes, self.key), [f"_k_{k}" for k in self.key], self.on_null)
        self.target.write(batch, keyed.select(*changes.columns))
