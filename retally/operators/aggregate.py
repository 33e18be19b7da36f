"""One grouped aggregate, three executions.

``summarise``         batch: group a frame of current rows.
``summarise_signed``  batch: group the signed rows of a change stream.
``deltas`` / ``fold`` / ``settle``
                      change stream in pieces: signed rows -> addable partials,
                      partials added up, partials -> finished rows.

Sums and counts are added with the sign of the row.  A distinct count, a
minimum or a maximum cannot be subtracted, so the partials hold, next to the
sums of a group, one narrow row per (group, value) with the number of
references to that value; finishing counts or compares the values still
referenced.  Distinct counts run that way in batch, too.

What this means for the shuffles: sums combine on the map side at the size of
the group key and never drag the distinct values along; the rows per value
spread a hot group over many partitions; several conditional distinct counts
of one column share one row per value.

``factors`` name the columns all conditions of an aggregate look at.  The
partials are then grouped by them and hold one sum per summed column instead of
one per measure: five sums where the report has seventy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, functions as F

from retally.functions.measures import Measure

SIGN = "_sign"
ROWS = "_rows"
SLOT = "_slot"


@dataclass(frozen=True)
class Aggregate:
    name: str
    keys: tuple[tuple[str, str], ...]       # (output column, expression)
    measures: tuple[Measure, ...]
    where: str | None = None
    source: str | None = None               # the input flow
    factors: tuple[str, ...] = ()

    @property
    def key_names(self) -> list[str]:
        return [n for n, _ in self.keys]

    @property
    def columns(self) -> list[str]:
        return self.key_names + [m.name for m in self.measures]

    @cached_property
    def summed(self) -> list[str]:
        """The columns that totals add up."""
        return list(dict.fromkeys(m.value for m in self.measures if m.kind == "total"))

    def slotted(self, signed: bool) -> list[Measure]:
        """Measures that need a row per value."""
        kinds = ("heads", "earliest", "latest") if signed else ("heads",)
        return [m for m in self.measures if m.kind in kinds]

    def slots(self, signed: bool) -> list[str]:
        return list(dict.fromkeys(m.value for m in self.slotted(signed)))

    def partial_keys(self, signed: bool = True) -> list[str]:
        """Columns that tell the partials of one group apart."""
        slots = self.slots(signed)
        names = list(self.factors) if slots or signed else []
        return names + ([SLOT] + [f"_v{i}" for i in range(len(slots))] if slots else [])


def by(*keys: str, **computed: str) -> tuple[tuple[str, str], ...]:
    """Group keys: plain column names, then ``output=expression`` pairs."""
    return tuple((k, k) for k in keys) + tuple(computed.items())


def summarise(df: DataFrame, agg: Aggregate) -> DataFrame:
    """Batch execution over current rows."""
    return _finish(_partials(df, agg, signed=False), agg, signed=False)


def summarise_signed(signed: DataFrame, agg: Aggregate) -> DataFrame:
    """The aggregate of a whole change stream in one batch."""
    part = deltas(signed, agg)
    # rows per value are already unique here, so nothing has to be folded first
    return _finish(part, agg, signed=True)


def summarise_whole(signed: DataFrame, agg: Aggregate) -> DataFrame:
    """The aggregate of a change stream that is there as a whole, from its first change on.

    Equal images are added up first: what came and went again cancels before anything is counted, and the rows
    that are left are the current table, to be summarised as any other.
    """
    used = [c for c in signed.columns if c not in (SIGN, "row_kind", "_order")]
    left = signed.groupBy(*used).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) > 0)
    return summarise(left.select(*used, F.explode(F.sequence(F.lit(1), SIGN))).select(*used), agg)


def deltas(signed: DataFrame, agg: Aggregate) -> DataFrame:
    """Addable partials of some signed rows (column ``_sign`` is +1 or -1)."""
    return _partials(signed, agg, signed=True)


def fold(parts: DataFrame, agg: Aggregate) -> DataFrame:
    """Partials added up; those that cancelled out completely are dropped."""
    keys = agg.key_names + agg.partial_keys()
    addends = [c for c in parts.columns if c not in keys]
    alive = F.lit(False)
    for c in addends:
        alive = alive | (F.col(c) != 0)
    added = [F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in addends]
    return parts.groupBy(*keys).agg(*added).where(alive)


def settle(parts: DataFrame, agg: Aggregate) -> DataFrame:
    """Finished rows from partials; a group whose rows all went away is not in the result."""
    return _finish(fold(parts, agg) if agg.slots(True) else parts, agg, signed=True)


def restated(stored: DataFrame, fresh: DataFrame, agg: Aggregate, counted: Sequence[str] = ()) -> DataFrame:
    """Stored partials and those of a batch -> the changes (before, after, op) of the groups the batch touched.

    The row a group had is finished from its stored partials, the row it has now from all of them, side by side in one
    grouping.  Of ``counted`` measures the partials are numbers of the same name, to be added.  Not for aggregates with
    rows per value.
    """
    keys, old = agg.key_names, F.col("_old")
    agg_of_parts = replace(agg, measures=tuple(m for m in agg.measures if m.name not in counted))
    parts = stored.withColumn("_old", F.lit(True)).unionByName(fresh.withColumn("_old", F.lit(False)))
    # a group has few partials, so these, narrower than sums in the making, are dealt out as they are
    parts = parts.repartition(*keys)
    sides = {"before": lambda c: F.when(old, F.col(c)), "after": F.col}
    done = [c for side, col in sides.items() for c in (*_done(agg_of_parts, True, col, f"{side}_"), F.sum(col(ROWS)).alias(f"{side}_{ROWS}"),
                                                      *[F.coalesce(F.sum(col(m)), F.lit(0)).alias(f"{side}_{m}") for m in counted])]
    groups = parts.groupBy(*keys).agg(*done, F.bool_or(~old).alias("_new")).where("_new")
    typed = {side: _measures(agg, f"{side}_") for side in sides}
    differs = reduce(lambda a, b: a | b, [~b.eqNullSafe(a) for b, a in zip(*typed.values())], F.lit(False))
    had, has = (F.col(f"{side}_{ROWS}") > 0 for side in sides)
    had, has = F.coalesce(had, F.lit(False)), F.coalesce(has, F.lit(False))
    row = {side: F.when(there, F.struct(*keys, *typed[side])).alias(side) for side, there in zip(sides, (had, has))}
    op = F.when(~had, "c").when(~has, "d").otherwise("u").alias("op")
    return groups.where((had != has) | (had & has & differs)).select(row["before"], row["after"], op)


def finished_deltas(parts: DataFrame, agg: Aggregate) -> DataFrame:
    """Partials that are whole groups already (a running aggregate) as finished rows.

    ``op`` is ``d`` where a group has no rows left, else ``u``.
    """
    done = []
    for m in agg.measures:
        if m.kind == "total":
            done.append(F.when(F.col(f"n_{m.name}") > 0, F.col(f"p_{m.name}")).alias(m.name))
        elif m.kind == "tally":
            done.append(F.col(f"p_{m.name}").alias(m.name))
    op = F.when(F.col(ROWS) > 0, "u").otherwise("d").alias("op")
    return _typed(parts.select(*agg.key_names, *done, op), agg, keep=("op",))


def _any_of(conditions: list[str | None]) -> str | None:
    if any(c is None for c in conditions):
        return None
    return " OR ".join(f"({c})" for c in dict.fromkeys(conditions))


def _partials(df: DataFrame, agg: Aggregate, signed: bool) -> DataFrame:
    if agg.where:
        df = df.where(agg.where)
    slots, slotted = agg.slots(signed), agg.slotted(signed)
    keys = [F.expr(e).alias(n) for n, e in agg.keys]
    factored = [f for f in agg.factors if f in agg.partial_keys(signed)]

    main = None                                     # true on the rows that carry the sums
    if slots:
        values = []
        for value in slots:
            cond = _any_of([m.where for m in slotted if m.value == value])
            values.append(F.expr(f"CASE WHEN {cond} THEN {value} END" if cond else value))
        types = [f.dataType for f in df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).schema]

        def row(k: int) -> Column:
            cells = [values[i] if i + 1 == k else F.lit(None).cast(types[i]) for i in range(len(slots))]
            return F.struct(F.lit(k).alias("slot"), *[c.alias(f"v{i}") for i, c in enumerate(cells)])

        df = df.withColumn("_s", F.explode(F.array(*[row(k) for k in range(len(slots) + 1)])))
        main = F.col("_s.slot") == 0
        used = main
        for i in range(len(slots)):
            used = used | F.col(f"_s.v{i}").isNotNull()
        df = df.where(used)
        keys += [(F.when(main, F.col(f))).alias(f) for f in factored]
        keys += [F.col("_s.slot").alias(SLOT)] + [F.col(f"_s.v{i}").alias(f"_v{i}") for i in range(len(slots))]
    else:
        keys += [F.col(f) for f in factored]

    one = F.col(SIGN).cast("bigint") if signed else F.lit(1).cast("bigint")

    def count(cond: Column | None) -> Column:
        if cond is None and signed:
            return F.sum(one)
        if cond is None:
            return F.count(F.lit(1))
        return F.sum(F.when(cond, one).otherwise(F.lit(0).cast("bigint"))) if signed else F.count_if(cond)

    def on_main(cond: Column | None) -> Column | None:
        return cond if main is None else (main if cond is None else main & cond)

    def add(x: Column, name: str) -> list[Column]:
        """Sum of x, and for signed rows the number of non-null summands behind it."""
        x = x if main is None else F.when(main, x)
        if not signed:
            return [F.sum(x).alias(f"p_{name}")]
        return [F.coalesce(F.sum(F.when(one > 0, x).otherwise(-x)), F.lit(0)).alias(f"p_{name}"),
                count(x.isNotNull()).alias(f"n_{name}")]

    out: list[Column] = []
    if factored:
        for i, x in enumerate(agg.summed):
            out += add(F.expr(x), f"sum{i}")
    for m in agg.measures:
        if m in slotted:
            cond = F.col(f"_s.v{slots.index(m.value)}").isNotNull()
            out.append(count(cond & F.expr(m.where) if m.where else cond).alias(f"r_{m.name}"))
        elif m.kind == "total" and not factored:
            out += add(F.expr(m.summand), m.name)
        elif m.kind == "tally" and not factored:
            out.append(count(on_main(F.expr(m.where))).alias(f"p_{m.name}"))
        elif m.kind in ("earliest", "latest"):
            pick = F.min if m.kind == "earliest" else F.max
            out.append(pick(F.expr(m.value)).alias(f"p_{m.name}"))
    if signed or factored or not out:
        out.append(count(on_main(None)).alias(ROWS))
    return df.groupBy(*keys).agg(*out)


def _done(agg: Aggregate, signed: bool, col: Callable[[str], Column] = F.col, tag: str = "") -> list[Column]:
    """The measures from partials (read by ``col``), each under ``tag`` and its name."""
    slots, slotted = agg.slots(signed), agg.slotted(signed)
    factored = bool(agg.factors) and set(agg.factors) <= set(agg.partial_keys(signed))
    # plain batch aggregates are grouped already and only need their last projection
    grouped = not slots and not signed
    add = (lambda c: col(c)) if grouped else (lambda c: F.sum(col(c)))
    done: list[Column] = []
    for m in agg.measures:
        name = f"{tag}{m.name}"
        if m in slotted:
            alive = col(f"r_{m.name}") > 0
            value = col(f"_v{slots.index(m.value)}")
            done.append({"heads": F.count_if(alive), "earliest": F.min(F.when(alive, value)),
                         "latest": F.max(F.when(alive, value))}[m.kind].alias(name))
        elif m.kind == "total" and factored:
            i = agg.summed.index(m.value)
            amount, behind = col(f"p_sum{i}"), col(f"n_sum{i}")
            if m.where:
                amount = F.when(F.expr(m.where), amount).otherwise(F.lit(0))
                behind = F.when(F.expr(m.where), behind).otherwise(col(ROWS))
            # rows per value have no sums; they must not turn a null total into zero
            amount = F.when(col(SLOT) == 0, amount) if slots else amount
            total = F.sum(amount)
            done.append((F.when(F.sum(behind) > 0, total) if signed else total).alias(name))
        elif m.kind == "total":
            total = add(f"p_{m.name}")
            done.append((F.when(add(f"n_{m.name}") > 0, total) if signed else total).alias(name))
        elif m.kind == "tally" and factored:
            done.append(F.sum(F.when(F.expr(m.where), col(ROWS)).otherwise(F.lit(0))).alias(name))
        elif m.kind == "tally":
            done.append(add(f"p_{m.name}").alias(name))
        elif m.kind in ("earliest", "latest"):
            pick = col if grouped else (lambda c, f=F.min if m.kind == "earliest" else F.max: f(col(c)))
            done.append(pick(f"p_{m.name}").alias(name))
    return done


def _finish(part: DataFrame, agg: Aggregate, signed: bool) -> DataFrame:
    done = _done(agg, signed)
    if signed:
        done.append(F.sum(ROWS).alias(ROWS))
    if not agg.slots(signed) and not signed:
        result = part.select(*agg.key_names, *done)
    else:
        result = part.groupBy(*agg.key_names).agg(*done)
    if signed:
        result = result.where(F.col(ROWS) > 0)
    return _typed(result, agg)


def _measures(agg: Aggregate, tag: str = "") -> list[Column]:
    """The measures cast to their declared types, with constants and ratios."""
    by_name = {m.name: m for m in agg.measures}

    def finished(m: Measure) -> Column:
        if m.kind == "fixed":
            return F.expr(m.value).cast(m.type)
        if m.kind == "ratio":
            top, bottom = finished(by_name[m.value]), finished(by_name[m.where])
            return F.when(bottom == 0, F.lit(0)).otherwise(-top / bottom).cast(m.type)
        return F.col(f"{tag}{m.name}").cast(m.type)

    return [finished(m).alias(m.name) for m in agg.measures]


def _typed(result: DataFrame, agg: Aggregate, keep: tuple[str, ...] = ()) -> DataFrame:
    return result.select(*agg.key_names, *_measures(agg), *keep)
