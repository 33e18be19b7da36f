"""Change streams as ordinary frames.

A *change* is a row (before, after, op, ts_ms, pos).  A *signed row* is one
image of a change: +1 for an image that came, -1 for an image that went.
Adding signed rows up gives the current table in whatever order they arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retally.operators.aggregate import SIGN

ORDER = ("ts_ms", "pos")


def signed_rows(changes: DataFrame) -> DataFrame:
    """Every change as its one or two images, with ``_sign`` and ``row_kind``.

    c, r -> +I;  u -> -U and +U;  d -> -D.  ``_order`` keeps the place of the
    change for those who need the last image.
    """
    op = F.col("op")

    def image(column: str, sign: int, kind: Column) -> Column:
        return F.struct(F.lit(sign).cast("int").alias(SIGN), kind.alias("row_kind"), F.col(column).alias("row"))

    went = image("before", -1, F.when(op == "d", F.lit("-D")).otherwise(F.lit("-U")))
    came = image("after", 1, F.when(op == "u", F.lit("+U")).otherwise(F.lit("+I")))
    images = F.array(F.when(op.isin("u", "d"), went), F.when(op.isin("c", "r", "u"), came))
    order = F.struct(*[F.col(c) for c in ORDER if c in changes.columns]) if set(ORDER) & set(changes.columns) else None
    rows = changes.select(F.explode(images).alias("i"), *([order.alias("_order")] if order is not None else []))
    rows = rows.where(F.col("i.row").isNotNull())
    return rows.select("i.row.*", f"i.{SIGN}", "i.row_kind", *(["_order"] if order is not None else []))


def as_changes(signed: DataFrame) -> DataFrame:
    """Signed rows with their place as changes again: an image that came is inserted, one that went is deleted."""
    columns = [c for c in signed.columns if c not in (SIGN, "row_kind", "_order")]
    came = F.col(SIGN) > 0
    row = F.struct(*columns)
    return signed.select(F.when(~came, row).alias("before"), F.when(came, row).alias("after"),
                         F.when(came, "c").otherwise("d").alias("op"), "_order.*")


def net_rows(signed: DataFrame) -> DataFrame:
    """Equal images added up; what came and went again is gone."""
    columns = [c for c in signed.columns if c not in (SIGN, "row_kind", "_order")]
    return (signed.groupBy(*columns).agg(F.sum(SIGN).cast("int").alias(SIGN)).where(F.col(SIGN) != 0))


def changed_keys(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key columns of each change next to it (from the new image, else the old one)."""
    return changes.select(*[F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(f"_k_{k}") for k in key], "*")


def last_changes(changes: DataFrame, key: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The last change of every key: (key..., image, gone, at); image is null when the row is gone.

    The largest position wins, not the last to arrive; of an update written as delete and
    insert at one position the insert is the later half.  ``max_by`` combines on
    the map side, so a key with very many versions does not gather in one task.
    """
    names = [f"_k_{k}" for k in key]
    at = F.struct(*order)
    last = F.max_by(F.when(F.col("op") != "d", F.col("after")), F.struct(at, F.col("op") != "d"))
    return (changed_keys(changes, key).groupBy(*names).agg(last.alias("image"), F.max(at).alias("at"))
            .select(*[F.col(n).alias(k) for n, k in zip(names, key)], "image", F.col("image").isNull().alias("gone"), "at"))


def current_rows(changes: DataFrame, key: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The table after all changes: last image per key, deleted keys left out."""
    return last_changes(changes, key, order).where(~F.col("gone")).select("image.*")


def upserts(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Plain rows read as a stream of upserts: a later row of a key replaces an earlier one."""
    columns = [c for c in rows.columns]
    return rows.select(F.lit(None).cast(rows.schema).alias("before"), F.struct(*columns).alias("after"),
                       F.lit("u").alias("op"), *[F.col(c) for c in order])


def snapshot(rows: DataFrame) -> DataFrame:
    """A table read as a whole, as changes of op ``r`` that precede every other change."""
    return rows.select(F.lit(None).cast(rows.schema).alias("before"), F.struct(*rows.columns).alias("after"),
                       F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("ts_ms"),
                       F.lit(-1).cast("bigint").alias("pos"))


def once(changes: DataFrame, identity: Sequence[str] = ("ts_ms", "pos", "op")) -> DataFrame:
    """Each change once, when the log may deliver it again (batch form).

    The op keeps the two halves of an update apart; a stream of several tables needs the table in ``identity``.
    """
    return changes.dropDuplicates(list(identity))


def changes_between(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Two states of a keyed table -> the changes that lead from one to the other.

    Key columns may be null; equal rows give no change.
    """
    data = [c for c in after.columns if c not in key]
    old = before.select(*key, F.struct(*before.columns).alias("before"))
    new = after.select(*key, F.struct(*after.columns).alias("after"))
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]
    both = old.alias("o").join(new.alias("n"), on, "full_outer").select("before", "after")
    differs = F.lit(False)
    for c in data:
        differs = differs | ~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}"))
    op = (F.when(F.col("before").isNull(), "c").when(F.col("after").isNull(), "d").otherwise("u"))
    return both.where(F.col("before").isNull() | F.col("after").isNull() | differs).select("before", "after", op.alias("op"))
