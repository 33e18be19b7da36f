"""Reports with distinct counts and extremes over a stream, without reading values they do not touch.

One streaming aggregation keeps how often every value of a group is referenced.  In update mode it gives, for the
values a micro-batch touched, the references after the batch; what the batch itself added is summed from its rows, so
the references before it are known, too, and with them the *steps*: a value that came (0 to 1) or went (1 to 0).

* A distinct count is the sum of its steps: a group's partials hold one number per count, not a row per value.
* A minimum or maximum moves with the values that came.  Only where the extreme itself went, the next one is looked up
  among the steps stored for that group, ordered by group and value.

Several reports share the one aggregation and the rows of the batch.  Every report commits its batch by itself: a
batch that runs again after a failure repeats only the reports that had not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.storagelevel import StorageLevel

from retally.functions.measures import Measure
from retally.operators.aggregate import SIGN, Aggregate, deltas, fold, restated, settle
from retally.operators.changelog import changes_between, signed_rows
from retally.sinks.batch_log import BatchLog
from retally.sinks.keyed_table import KeyedTable, only_keys
from retally.streaming.restate import DAY, Report, nullable, on_days, run_in_order, touched_days

Flow = Callable[[DataFrame], DataFrame]

REPORT, SLOT, VALUE, STEP = "_report", "_slot", "_value", "_step"


class CountedReport:
    """One aggregate over a stream whose values are counted by ``Counted``."""

    def __init__(self, spark: SparkSession, home: str, agg: Aggregate, sample: DataFrame, compact_every: int = 50):
        self.agg, self.every = agg, compact_every
        self.keys = agg.key_names
        slotted = agg.slotted(True)
        self.sums = replace(agg, measures=tuple(m for m in agg.measures if m not in slotted))
        #: distinct (value, condition) pairs, numbered; measures that look at the same pair share its references
        self.pairs = list(dict.fromkeys((m.value, m.where) for m in slotted))
        self.heads = [m for m in slotted if m.kind == "heads"]
        self.extremes = [m for m in slotted if m.kind != "heads"]
        daily = [DAY] if DAY in self.keys else []
        empty = sample.withColumn(SIGN, F.lit(1))
        parts = deltas(empty, self.sums)
        self.key_type = T.StructType([parts.schema[k] for k in self.keys])
        self.types = {m.name: sample.select(F.expr(m.value)).schema[0].dataType for m in self.extremes}
        result = settle(parts, self.sums)
        row = {f.name: f for f in result.schema} | {m.name: T.StructField(m.name, T.LongType()) for m in self.heads}
        row |= {m.name: T.StructField(m.name, self.types[m.name]) for m in self.extremes}
        row = {n: T.StructField(n, _declared(agg, n, f.dataType)) for n, f in row.items()}
        self.parts = BatchLog(spark, f"{home}/{agg.name}/partials", nullable(parts.schema), daily)
        count = T.StructType([*self.key_type, *[T.StructField(m.name, T.LongType()) for m in self.heads]])
        self.counts = BatchLog(spark, f"{home}/{agg.name}/counts", nullable(count), daily)
        index = T.StructType([*self.key_type, T.StructField(SLOT, T.IntegerType()), T.StructField(VALUE, T.StringType()),
                              T.StructField(STEP, T.LongType())])
        self.index = BatchLog(spark, f"{home}/{agg.name}/index", nullable(index), self.keys)
        self.table = KeyedTable(spark, f"{home}/{agg.name}/table", nullable(T.StructType([row[c] for c in agg.columns])),
                                self.keys, daily)

    def slot(self, m: Measure) -> int:
        return self.pairs.index((m.value, m.where))

    def elements(self, number: int, all_keys: Mapping[str, T.DataType]) -> list[Column]:
        """For each pair: report, keys (null where the report has no such key), slot and value; null where none counts."""
        keys = dict(self.agg.keys)
        columns = [(F.expr(keys[k]).cast(t) if k in keys else F.lit(None).cast(t)).alias(k) for k, t in all_keys.items()]
        out = []
        for slot, (value, where) in enumerate(self.pairs):
            conditions = " AND ".join(f"({c})" for c in (self.agg.where, where, f"({value}) IS NOT NULL") if c)
            out.append(F.when(F.expr(conditions), F.struct(
                F.lit(number).alias(REPORT), *columns, F.lit(slot).alias(SLOT), F.expr(value).cast("string").alias(VALUE))))
        return out

    def restate(self, batch: int, rows: DataFrame, steps: DataFrame) -> DataFrame:
        """Take a batch's signed rows and steps in; returns the changes of the report."""
        if self.table.log.done(batch):
            return self.table.changes(batch)
        keys = self.keys
        self.parts.write(batch, deltas(rows, self.sums), as_dealt=True)
        step_of = lambda m: F.sum(F.when(F.col(SLOT) == self.slot(m), F.col(STEP)).otherwise(0)).alias(m.name)
        if self.heads:
            self.counts.write(batch, steps.groupBy(*keys).agg(*[step_of(m) for m in self.heads]))
        if self.extremes:
            ordered = [self.slot(m) for m in self.extremes]
            self.index.write(batch, steps.where(F.col(SLOT).isin(ordered)).select(*keys, SLOT, VALUE, F.col(STEP).cast("long").alias(STEP)))
        fresh = self.parts.one(batch).drop("batch")
        days = touched_days(fresh) if DAY in keys else None
        near = lambda df: df.where(on_days(DAY, days)) if days is not None else df
        if not self.extremes:
            stored = self._with_counts(near(self.parts.read(batch)), near(self.counts.read(batch)))
            came = self._with_counts(fresh, self.counts.one(batch))
            self.table.write(batch, restated(stored, came, self.agg, [m.name for m in self.heads]), as_dealt=True)
            return self.table.changes(batch)
        touched = fresh.select(*keys).distinct()
        of_touched = lambda log: only_keys(near(log.read(batch)).drop("batch"), touched).unionByName(log.one(batch).drop("batch"))
        after = settle(of_touched(self.parts), self.sums)
        if self.heads:
            counted = of_touched(self.counts).groupBy(*keys).agg(*[F.sum(m.name).alias(m.name) for m in self.heads])
            after = joined(after, counted, keys).fillna(0, [m.name for m in self.heads])
        before = self.table.current(batch, touched, on_days(f"_p_{DAY}", days) if days is not None else None)
        for m in self.extremes:
            after = joined(after, self._extreme(m, batch, before, near), keys)
        row = self.table.row
        after = after.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in row])
        self.table.write(batch, changes_between(before, after, keys))
        return self.table.changes(batch)

    def _with_counts(self, parts: DataFrame, counts: DataFrame) -> DataFrame:
        """Partials and the steps of the counts as rows of one frame."""
        return parts.unionByName(counts, allowMissingColumns=True).select(
            *[f.name for f in self.parts.schema], *[m.name for m in self.heads])

    def _extreme(self, m: Measure, batch: int, before: DataFrame, near: Flow) -> DataFrame:
        """The extreme of each touched group: its old one or a better one that came; looked up only where the old one went."""
        keys, slot, pick = self.keys, self.slot(m), (F.min if m.kind == "earliest" else F.max)
        better = F.least if m.kind == "earliest" else F.greatest
        typed = lambda df: df.where(F.col(SLOT) == slot).withColumn(VALUE, F.col(VALUE).cast(self.types[m.name]))
        here = typed(self.index.one(batch))
        came = here.where(F.col(STEP) > 0).groupBy(*keys).agg(pick(VALUE).alias("came"))
        old = before.select(*keys, F.col(m.name).cast(self.types[m.name]).alias(VALUE))
        lost = only_keys(old, here.where(F.col(STEP) < 0).select(*keys, VALUE)).select(*keys)
        stored = only_keys(typed(near(self.index.read(batch + 1))).drop("batch"), lost)
        alive = stored.groupBy(*keys, VALUE).agg(F.sum(STEP).alias(STEP)).where(F.col(STEP) > 0)
        following = alive.groupBy(*keys).agg(pick(VALUE).alias("next"))
        seen = joined(came, old, keys, "full_outer")
        seen = joined(joined(seen, lost.withColumn("lost", F.lit(True)), keys), following, keys)
        value = F.when(F.col("lost"), F.col("next")).otherwise(better("came", VALUE))
        return seen.select(*keys, value.alias(m.name))

    def tidy(self, batch: int) -> None:
        cut = [k for k in self.keys if k != DAY]
        self.parts.compact(batch, lambda d: fold(d.drop("batch"), self.sums), self.every, [*cut, *self.sums.partial_keys()])
        added = lambda by, names: lambda d: d.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names]).where(
            reduce(lambda a, b: a | b, [F.col(n) != 0 for n in names]))
        if self.heads:
            self.counts.compact(batch, added(self.keys, [m.name for m in self.heads]), self.every, cut)
        if self.extremes:
            self.index.compact(batch, added([*self.keys, SLOT, VALUE], [STEP]), self.every, [VALUE])
        self.table.compact(batch, self.every)


def _declared(agg: Aggregate, name: str, fallback: T.DataType) -> T.DataType:
    declared = next((m.type for m in agg.measures if m.name == name), None)
    return T.StructType.fromDDL(f"x {declared}")[0].dataType if declared else fallback


def joined(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "left") -> DataFrame:
    """Join by keys that may be null; the key columns appear once."""
    keys = list(keys)
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    both = left.join(other, on, how)
    key = (lambda k: F.coalesce(k, f"_r_{k}").alias(k)) if how == "full_outer" else F.col
    return both.select(*[key(k) for k in keys], *[c for c in both.columns if c not in keys and not c.startswith("_r_")])


class Counted:
    """Reports of one stream of signed rows, plain and counted ones, and row targets beside them.

    ``stream`` gives the frame to write in update mode, ``each_batch`` goes into its ``foreachBatch``.  ``rows`` are
    further targets of the same rows: a name and a function (batch, signed rows) that writes one; ``marks`` tell which
    of them have the batch already.
    """

    def __init__(self, spark: SparkSession, home: str, aggregates: Iterable[Aggregate], sample: DataFrame,
                 clean: Flow = lambda df: df, compact_every: int = 50, targets: Mapping[str, Callable[[int, DataFrame], None]] | None = None,
                 at_once: int = 4):
        """``sample`` has the schema of the rows before ``clean``, which shapes them for the reports."""
        self.spark, self.clean, self.at_once = spark, clean, at_once
        self.reports: dict[str, Report | CountedReport] = {}
        shapes = {None: clean(sample)}
        for agg in aggregates:
            shape = shapes.get(agg.source, shapes[None])
            if agg.slots(True) and agg.source in self.reports:
                raise ValueError(f"{agg.name} counts values of another report; count them where the rows are")
            kind = CountedReport if agg.slots(True) else Report
            report = kind(spark, home, agg, shape, compact_every)
            self.reports[agg.name] = report
            shapes[agg.name] = spark.createDataFrame([], report.table.row)
        self.counted = [r for r in self.reports.values() if isinstance(r, CountedReport)]
        self.all_keys: dict[str, T.DataType] = {}
        for report in self.counted:
            for field in report.key_type:
                if self.all_keys.setdefault(field.name, field.dataType) != field.dataType:
                    raise ValueError(f"reports disagree on the type of {field.name}")
        self.targets = dict(targets or {})
        self.marks = {name: BatchLog(spark, f"{home}/{name}/mark", T.StructType.fromDDL("done BOOLEAN")) for name in self.targets}

    def _values(self, rows: DataFrame) -> DataFrame:
        elements = [e for i, r in enumerate(self.counted) for e in r.elements(i, self.all_keys)]
        sign = F.col(SIGN).cast("long").alias(SIGN)
        return self.clean(rows).select(F.explode(F.array(*elements)).alias("e"), sign).where("e IS NOT NULL").select("e.*", SIGN)

    @property
    def _by(self) -> list[str]:
        return [REPORT, SLOT, *self.all_keys, VALUE]

    def stream(self, signed: DataFrame) -> DataFrame:
        """The rows of a stream, and beside them the references of the values they touch."""
        rows = signed.select(F.struct(*signed.columns).alias("row"))
        if not self.counted:
            return rows
        counts = self._values(signed).groupBy(*self._by).agg(F.sum(SIGN).alias("n"))
        none = lambda df: F.lit(None).cast(df.schema[0].dataType).alias(df.columns[0])
        counts = counts.select(F.struct(*counts.columns).alias("count"))
        return rows.select("row", none(counts)).unionByName(counts.select(none(rows), "count"))

    def each_batch(self, batch_rows: DataFrame, batch: int) -> None:
        held = [batch_rows.persist(StorageLevel.MEMORY_AND_DISK)]
        try:
            rows, steps = batch_rows.where("row IS NOT NULL").select("row.*"), None
            if self.counted:
                after = batch_rows.where("count IS NOT NULL").select("count.*")
                added = self._values(rows).groupBy(*self._by).agg(F.sum(SIGN).alias("d")).where("d <> 0")
                here = lambda n: (n > 0).cast("long")
                steps = joined(added, after, self._by).withColumn(STEP, here(F.col("n")) - here(F.col("n") - F.col("d"))).where(
                    F.col(STEP) != 0).select(*self._by, STEP)
                steps = steps.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(steps)
            flows = {None: self.clean(rows)}

            def one(name: str) -> DataFrame:
                report = self.reports[name]
                if isinstance(report, CountedReport):
                    own = steps.where(F.col(REPORT) == self.counted.index(report)).drop(REPORT)
                    return signed_rows(report.restate(batch, flows[None], own))
                return signed_rows(report.restate(batch, flows[source[name]]))

            def other(name: str) -> None:
                if not self.marks[name].done(batch):
                    self.targets[name](batch, rows)
                    self.marks[name].write(batch, self.spark.range(1).selectExpr("true AS done"))

            source = {n: r.agg.source if r.agg.source in self.reports else None for n, r in self.reports.items()}
            with ThreadPoolExecutor(self.at_once) as pool:
                list(pool.map(inheritable_thread_target(self.spark)(other), self.targets))
            run_in_order(self.spark, self.at_once, source, flows, one, lambda name: self.reports[name].tidy(batch))
        finally:
            for df in held:
                df.unpersist()

    def current(self, name: str) -> DataFrame:
        return self.reports[name].table.current()
