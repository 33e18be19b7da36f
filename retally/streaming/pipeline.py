"""From a stream of lines to running queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from retally.operators.changelog import ORDER, as_changes, changed_keys, last_changes, signed_rows, snapshot
from retally.operators.cleanse import masked
from retally.operators.conform import conform, enforce_not_null
from retally.plans.dimensions import SECRETS
from retally.schemas import Table
from retally.sinks.keyed_table import KeyedTable
from retally.sources.envelope import decode_changes, of_table, split_corrupt

Clean = Callable[[DataFrame], DataFrame]
#: Number of the batch that holds a table's snapshot.
SNAPSHOT = -1


def run(stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str,
        every: str | None = None) -> StreamingQuery:
    """Start a query: all that is there and then stop, or every so often (``"1 minute"``)."""
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def flows_of(lines: DataFrame, flows: Mapping[str, tuple[Table, Clean]]) -> dict[str, DataFrame]:
    """Signed, cleansed rows of every flow in a batch of change text that may mix tables."""
    mixed = len({t.name for t, _ in flows.values()}) > 1
    return {name: clean(signed_rows(decode_changes(of_table(lines, table.name) if mixed else lines, table)))
            for name, (table, clean) in flows.items()}


def mirror_batch(target: KeyedTable, table: Table, prepare: Clean = lambda df: masked(df, SECRETS),
                 compact_every: int = 50, decode: Clean | None = None, tasks: int = 0) -> Callable[[DataFrame, int], None]:
    """Keep a keyed table equal to its source: each batch is collapsed to the last image per key.

    ``prepare`` shapes the image before it is stored; by default passwords are left out.  Columns
    of the target that it leaves out are stored as null.  ``decode`` makes changes of the batch where it is not
    plain change text of ``table``.  The target's key tells rows apart.  A batch with more rows than a shuffle's usual
    partitions hold is dealt out over ``tasks``.
    """
    decode = decode or (lambda lines: decode_changes(lines, table))

    def each_batch(lines: DataFrame, batch: int) -> None:
        row, conf = target.row, lines.sparkSession.conf
        if tasks > int(conf.get("spark.sql.shuffle.partitions")):
            conf.set("spark.sql.shuffle.partitions", str(tasks))
        last = last_changes(decode(lines), target.key)
        none = F.lit(None).cast(row)
        stored = prepare(last.where("NOT gone").select("image.*", "at.*"))
        image = [F.col(c) if c in stored.columns else F.lit(None).cast(row[c].dataType).alias(c) for c in row.names]
        put = stored.select(none.alias("before"), F.struct(*image).cast(row).alias("after"),
                            F.lit("u").alias("op"), "ts_ms", "pos")
        key_only = [F.col(c) if c in target.key else F.lit(None).cast(row[c].dataType).alias(c) for c in row.names]
        drop = last.where("gone").select(F.struct(*key_only).cast(row).alias("before"), none.alias("after"),
                                         F.lit("d").alias("op"), "at.*")
        target.write(batch, put.unionByName(drop))
        target.compact(batch, compact_every)

    return each_batch


def detail_batch(target: KeyedTable, prepare: Clean) -> Callable[[int, DataFrame], None]:
    """Keep a keyed table of rows, each shaped by ``prepare``, from the signed rows of batches."""
    def write(batch: int, rows: DataFrame) -> None:
        target.write(batch, _last_image(as_changes(prepare(rows)), target))

    return write


def _last_image(changes: DataFrame, target: KeyedTable) -> DataFrame:
    """The last change of every key of a batch."""
    place = F.struct(F.struct("ts_ms", "pos"), F.col("op") != "d")
    keyed = changed_keys(changes, target.key)
    last = keyed.groupBy(*[f"_k_{k}" for k in target.key]).agg(F.max_by(F.struct(*changes.columns), place).alias("c"))
    return last.select("c.*")


def take_snapshot(target: KeyedTable, rows: DataFrame, at: int) -> None:
    """Fill a table from a snapshot that was taken when the log stood at position ``at``.

    It is stored as the batch before the first one, at that position, and only if it is not there yet.
    """
    if target.log.done(SNAPSHOT):
        return
    place = F.lit(at).cast("bigint")
    target.write(SNAPSHOT, snapshot(rows).withColumn("ts_ms", place).withColumn("pos", place))


def after_snapshot(changes: DataFrame, at: int, position: str = "ts_ms") -> DataFrame:
    """The changes a snapshot at position ``at`` does not have yet.

    The stream may start anywhere before the snapshot: what lies up to it is dropped, also inserts of rows that were
    deleted again before the snapshot, which nothing in the table would hold back.
    """
    return changes.where(F.col(position) > at)


def split_batch(good: Callable[[DataFrame, int], None], broken: Callable[[DataFrame, int], None],
                decode: Clean) -> Callable[[DataFrame, int], None]:
    """One decode of a batch (with ``keep_corrupt``), its rows to one target and its broken lines to another.

    Both targets own the batch, so the two belong together however often it runs.
    """
    def each_batch(lines: DataFrame, batch: int) -> None:
        decoded = decode(lines).persist()
        try:
            rows, aside = split_corrupt(decoded)
            good(rows, batch)
            broken(aside, batch)
        finally:
            decoded.unpersist()

    return each_batch


def latest_batch(target: KeyedTable, rows: Clean, on_null: str = "drop", compact_every: int = 50) -> Callable[[DataFrame, int], None]:
    """Keep a keyed table of the latest row per key, from records of one or more topics.

    ``rows`` makes rows of the target from the records and leaves their place (ts_ms, pos) beside them: the latest place
    wins, whichever topic or batch brings it.  Rows are cast to the target's types, where a value that does not fit
    fails the batch; a null in the key is dropped or fails it, too (``on_null``).
    """
    def each_batch(records: DataFrame, batch: int) -> None:
        fit = T.StructType([*target.row, *[T.StructField(c, T.LongType()) for c in ORDER]])
        placed = enforce_not_null(conform(rows(records), fit), target.key, on_null)
        changes = placed.select(F.lit(None).cast(target.row).alias("before"),
                                F.struct(*target.row.names).cast(target.row).alias("after"), F.lit("u").alias("op"), *ORDER)
        target.write(batch, _last_image(changes, target))
        target.compact(batch, compact_every)

    return each_batch


def upsert_batch(target: KeyedTable, each: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """Write the rows of an update-mode aggregate (columns of the target and ``op``) to a keyed table."""
    def each_batch(rows: DataFrame, batch: int) -> None:
        row = target.row
        image = F.struct(*row.names).cast(row)
        gone = F.col("op") == "d"
        target.write(batch, each(rows).select(F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"), "op"))

    return each_batch
