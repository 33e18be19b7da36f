"""Reports kept exact over a stream of changes.

Each micro-batch of signed rows is first reduced to partials, which are small
and addable, and stored.  The groups the batch touched are then finished from
their stored partials and compared with the rows they had: the difference is a
change batch (insert, update, delete) for the keyed target, and at the same
time the input of any report built on this one.

Nothing here looks at more than the touched groups (and, for daily reports, the
touched days); nothing expires; a batch that runs again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.storagelevel import StorageLevel

from retally.operators import joins
from retally.operators.aggregate import SIGN, Aggregate, deltas, fold, restated, settle
from retally.operators.changelog import changes_between, net_rows, signed_rows
from retally.sinks.batch_log import BatchLog
from retally.sinks.keyed_table import KeyedTable, only_keys

DAY = "statistic_time"


#: Ranges of days a scan is asked for at most; the join on the keys does the rest.
RANGES = 16


def touched_days(keys: DataFrame, column: str = DAY) -> tuple[list[tuple], bool]:
    """Ranges of days that hold the days of a batch, and whether it touched rows without a day.

    One row of last year among those of today gives two ranges, not a year: only the smallest gaps are closed.
    """
    found, without = keys.agg(F.sort_array(F.collect_set(column)), F.coalesce(F.bool_or(F.col(column).isNull()), F.lit(False))).first()
    cuts = sorted(range(1, len(found)), key=lambda i: found[i] - found[i - 1], reverse=True)[:RANGES - 1]
    edges = [0, *sorted(i for i in cuts if (found[i] - found[i - 1]).days > 1), len(found)]
    return [(found[a], found[b - 1]) for a, b in zip(edges[:-1], edges[1:]) if a < b], without


def on_days(column: str, days: tuple[list[tuple], bool]) -> Column:
    """Condition that lets the scan skip other days."""
    ranges, without = days
    within = F.col(column).isNull() if without else F.lit(False)
    for first, last in ranges:
        within = within | F.col(column).between(F.lit(first), F.lit(last))
    return within


class Report:
    """One aggregate with its stored partials and its target table."""

    def __init__(self, spark: SparkSession, home: str, agg: Aggregate, sample: DataFrame, compact_every: int = 50):
        """``sample`` is any frame with the input's schema (its rows are not read)."""
        self.agg, self.every = agg, compact_every
        daily = [DAY] if DAY in agg.key_names else []
        empty = sample.withColumn(SIGN, F.lit(1))
        parts = deltas(empty, agg)
        self.parts = BatchLog(spark, f"{home}/{agg.name}/partials", nullable(parts.schema), daily)
        self.table = KeyedTable(spark, f"{home}/{agg.name}/table", nullable(settle(parts, agg).schema), agg.key_names, daily)

    def restate(self, batch: int, signed: DataFrame) -> DataFrame:
        """Take a batch in; returns the changes of the report.  A batch it has already is not taken again."""
        if self.table.log.done(batch):
            return self.table.changes(batch)
        keys = self.agg.key_names
        self.parts.write(batch, deltas(signed, self.agg), as_dealt=True)
        fresh, stored = self.parts.one(batch).drop("batch"), self.parts.read(before=batch).drop("batch")
        days = touched_days(fresh) if DAY in keys else None
        if days is not None:
            stored = stored.where(on_days(DAY, days))
        if self.agg.slots(True):
            touched = fresh.select(*keys).distinct()
            after = settle(only_keys(stored, touched).unionByName(fresh), self.agg)
            before = self.table.current(batch, touched, on_days(f"_p_{DAY}", days) if days is not None else None)
            self.table.write(batch, changes_between(before, after, keys))
        else:
            self.table.write(batch, restated(stored, fresh, self.agg), as_dealt=True)
        return self.table.changes(batch)

    def tidy(self, batch: int) -> None:
        self.parts.compact(batch, lambda d: fold(d.drop("batch"), self.agg), self.every,
                           [k for k in self.agg.key_names + self.agg.partial_keys() if k != DAY])
        self.table.compact(batch, self.every)


class OrderPayments:
    """Changes of withdrawals joined with payments, from the changes of both sides.

    Signed rows multiply: new orders meet all payments, new payments meet the
    orders stored before.
    """

    def __init__(self, spark: SparkSession, home: str, orders: DataFrame, payments: DataFrame, compact_every: int = 50):
        self.every = compact_every
        day = lambda df: df.withColumn("_day", F.to_date("update_time"))
        self._day = day
        lean = net_rows(day(orders.withColumn(SIGN, F.lit(1))))
        self.orders = BatchLog(spark, f"{home}/withdrawals_with_payments/orders", nullable(lean.schema), ["_day"])
        tries = net_rows(day(payments.withColumn(SIGN, F.lit(1))))
        self.payments = BatchLog(spark, f"{home}/withdrawals_with_payments/payments", nullable(tries.schema), ["_day"])

    def restate(self, batch: int, orders: DataFrame, payments: DataFrame) -> DataFrame:
        self.orders.write(batch, net_rows(self._day(_bare(orders))))
        self.payments.write(batch, net_rows(self._day(_bare(payments.where(
            F.col("order_status").isin(*joins.PAYMENT_DONE))))))
        new_orders, new_payments = self.orders.one(batch), self.payments.one(batch)
        old_orders = self.orders.read(batch).where(on_days("_day", touched_days(new_payments, "_day")))
        old_payments = self.payments.read(batch).where(on_days("_day", touched_days(new_orders, "_day")))
        all_payments = old_payments.unionByName(new_payments)
        return joins.orders_with_payments(new_orders, all_payments).unionByName(
            joins.orders_with_payments(old_orders, new_payments))

    def tidy(self, batch: int) -> None:
        for log in (self.orders, self.payments):
            number = "order_no" if "order_no" in log.schema.names else "withdraw_order_no"
            log.compact(batch, lambda d: net_rows(d.drop("batch")), self.every, [number])


def _bare(signed: DataFrame) -> DataFrame:
    return signed.drop("row_kind", "_order")


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def run_in_order(spark: SparkSession, at_once: int, sources: Mapping[str, str], flows: dict, one: Callable[[str], DataFrame],
                 tidy: Callable[[str], None]) -> list[str]:
    """Run ``one`` for each name as soon as the flow it reads is there, its result being the flow of its name, then ``tidy``.

    Reports that do not build on each other are independent Spark jobs.  Returns the names whose flow never came.
    """
    threaded = lambda work: inheritable_thread_target(spark)(work)
    waiting, running = list(sources), {}
    with ThreadPoolExecutor(at_once) as pool:
        while True:
            for name in [n for n in waiting if sources[n] in flows]:
                waiting.remove(name)
                running[pool.submit(threaded(one), name)] = name
            if not running:
                return waiting
            for job in wait(running, return_when=FIRST_COMPLETED).done:
                name, result = running.pop(job), job.result()
                if name is not None:
                    flows[name] = result
                    running[pool.submit(threaded(tidy), name)] = None


class Restatement:
    """Several reports fed from the same micro-batches, in the order they build on each other."""

    def __init__(self, spark: SparkSession, home: str, aggregates: Iterable[Aggregate],
                 samples: Mapping[str, DataFrame], compact_every: int = 50, targets: Mapping[str, object] | None = None,
                 at_once: int = 4):
        """``samples`` gives a frame with the schema of each input flow.

        ``targets`` maps report names to further tables (a ``JdbcTable``, say)
        that receive the report's changes.
        """
        self.spark, self.at_once = spark, at_once
        self.reports: dict[str, Report] = {}
        self.targets = dict(targets or {})
        shapes = dict(samples)
        for agg in aggregates:
            report = Report(spark, home, agg, shapes[agg.source], compact_every)
            self.reports[agg.name] = report
            shapes[agg.name] = spark.createDataFrame([], report.table.row)

    def process(self, batch: int, inputs: Mapping[str, DataFrame]) -> None:
        """``inputs``: signed rows per input flow; a report's changes become the flow of its name."""
        flows = dict(inputs)
        held = []
        for name, df in inputs.items():
            if sum(r.agg.source == name for r in self.reports.values()) > 1:
                flows[name] = df.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(flows[name])

        def one(name: str) -> DataFrame:
            report = self.reports[name]
            changes = report.restate(batch, flows[report.agg.source])
            if name in self.targets:
                self.targets[name].write(batch, changes)
            return signed_rows(changes)

        try:
            waiting = run_in_order(self.spark, self.at_once, {n: r.agg.source for n, r in self.reports.items()}, flows, one,
                                   lambda name: self.reports[name].tidy(batch))
            if waiting:
                raise KeyError(f"no input for {waiting}")
        finally:
            for df in held:
                df.unpersist()

    def current(self, name: str) -> DataFrame:
        return self.reports[name].table.current()
