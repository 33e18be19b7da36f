"""Change and event envelopes: text in, typed columns out, and back.

Two envelopes are understood:

* change envelope ``{before, after, op, ts_ms, source: {table, pos}}`` with op
  c (insert), r (snapshot read), u (update), d (delete), as in Debezium's JSON;
* event envelope ``{key, dataSyncType, jsonData: {...}}``, insert-only.

Only the columns of the declared schema are parsed, by name.  Broken text gives
a null envelope, a badly typed field a null field; ``split_corrupt`` routes the
former aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from retally.schemas import Table

OPS = ("c", "r", "u", "d")
#: Column for the table of an image, where changes of several are read at once.
TABLE = "_table"
_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def change_schema(table: Table) -> T.StructType:
    source = T.StructType.fromDDL("table STRING, pos BIGINT")
    return (T.StructType().add("before", table.struct).add("after", table.struct)
            .add("op", T.StringType()).add("ts_ms", T.LongType()).add("source", source))


def event_schema(table: Table) -> T.StructType:
    return (T.StructType().add("key", T.StringType()).add("dataSyncType", T.StringType())
            .add("jsonData", table.struct))


def _parse(lines: DataFrame, column: str, schema: T.StructType, also: Sequence[str] = ()) -> DataFrame:
    """Text column -> struct ``e``, parsed once per line.

    The parse sits inside an explode of one element: a filter on the parsed
    fields is not pushed below it, where it would parse every line again.
    """
    return lines.select(F.explode(F.array(F.from_json(column, schema))).alias("e"), F.col(column).alias("_text"), *also)


def decode_changes(lines: DataFrame, table: Table, column: str = "value", keep_corrupt: bool = False,
                   also: Sequence[str] = ()) -> DataFrame:
    """Change text -> (before, after, op, ts_ms, pos).

    Lines without a known op (broken text) are left out, or kept with the text
    in ``_corrupt`` when ``keep_corrupt`` is set.  Columns named in ``also``
    (a topic's partition and offset, say) stay.
    """
    parsed = _parse(lines, column, change_schema(table), also)
    known = F.coalesce(F.col("e.op").isin(*OPS), F.lit(False))
    out = parsed.select("e.before", "e.after", "e.op", "e.ts_ms", F.col("e.source.pos").alias("pos"),
                        F.when(~known, F.col("_text")).alias("_corrupt"), *also)
    return out if keep_corrupt else out.where(F.col("op").isin(*OPS)).drop("_corrupt")


def decode_events(lines: DataFrame, table: Table, column: str = "value", keep_corrupt: bool = False,
                  also: Sequence[str] = ()) -> DataFrame:
    """Event text -> (key, dataSyncType, jsonData); broken text is left out or kept in ``_corrupt``."""
    parsed = _parse(lines, column, event_schema(table), also)
    out = parsed.select("e.key", "e.dataSyncType", "e.jsonData",
                        F.when(F.col("e.jsonData").isNull(), F.col("_text")).alias("_corrupt"), *also)
    return out if keep_corrupt else out.where(F.col("jsonData").isNotNull()).drop("_corrupt")


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, side output with the broken text) of a decode with ``keep_corrupt``."""
    return decoded.where(F.col("_corrupt").isNull()).drop("_corrupt"), \
        decoded.where(F.col("_corrupt").isNotNull())


def of_table(lines: DataFrame, name: str, column: str = "value") -> DataFrame:
    """The lines of one table in a stream that carries several; only the table name is parsed."""
    return lines.where(F.get_json_object(column, "$.source.table") == name)


def decode_tables(lines: DataFrame, tables: Sequence[Table], column: str = "value") -> DataFrame:
    """Change text that mixes tables -> (before, after, op, ts_ms, pos), each line parsed once, whatever its table.

    An image has the columns of all ``tables``, those of other tables null, and the name of its own in ``TABLE``.
    Lines of further tables and lines without a known op are left out.
    """
    types: dict[str, str] = {}
    for table in tables:
        for name, type in table.columns:
            if types.setdefault(name, type) != type:
                raise ValueError(f"tables disagree on the type of {name}")
    merged = Table("_merged", (), ", ".join(f"{n} {t}" for n, t in types.items()))
    e, name = F.col("e"), F.col("e.source.table")

    def image(side: str) -> Column:
        own = [F.when(name.isin(*[t.name for t in tables if c in t.names]), e[side][c]).alias(c) for c in types]
        return F.when(e[side].isNotNull(), F.struct(*own, name.alias(TABLE))).alias(side)

    known = F.col("e.op").isin(*OPS) & name.isin(*[t.name for t in tables])
    return _parse(lines, column, change_schema(merged)).where(known).select(
        image("before"), image("after"), "e.op", "e.ts_ms", F.col("e.source.pos").alias("pos"))


def encode_changes(changes: DataFrame, table: Table, replace_updates: bool = True, also: Sequence[str] = ()) -> DataFrame:
    """(before, after, op, ...) -> one text column ``value``.

    With ``replace_updates`` an update is written as a delete of the old image
    followed by an insert of the new one, which every reader of the envelope
    understands without knowing the key.  Columns named in ``also`` stay beside it.
    """
    before, after = F.col("before"), F.col("after")
    nothing = F.lit(None).cast(table.struct)

    def piece(b: Column, a: Column, op: Column) -> Column:
        return F.struct(b.cast(table.struct).alias("before"), a.cast(table.struct).alias("after"), op.alias("op"))

    whole = F.array(piece(before, after, F.col("op")))
    if replace_updates:
        pair = F.array(piece(before, nothing, F.lit("d")), piece(nothing, after, F.lit("c")))
        whole = F.when((F.col("op") == "u") & before.isNotNull(), pair).otherwise(whole)
    extra = [F.col("ts_ms")] if "ts_ms" in changes.columns else []
    if "pos" in changes.columns:
        extra.append(F.struct(F.lit(table.name).alias("table"), F.col("pos")).alias("source"))
    rows = changes.select(F.explode(whole).alias("c"), *extra, *also)
    return rows.select(F.to_json(F.struct("c.*", *[c for c in ("ts_ms", "source") if c in rows.columns]),
                                 {"timestampNTZFormat": _STAMP}).alias("value"), *also)


def encode_events(rows: DataFrame, key: str | Column, kind: str = "insert", also: Sequence[str] = ()) -> DataFrame:
    """Rows -> event text column ``value`` with the row as ``jsonData``; columns named in ``also`` stay beside it instead."""
    key = F.col(key) if isinstance(key, str) else key
    return rows.select(F.to_json(
        F.struct(key.cast("string").alias("key"), F.lit(kind).alias("dataSyncType"),
                 F.struct(*[c for c in rows.columns if c not in also]).alias("jsonData")),
        {"timestampNTZFormat": _STAMP}).alias("value"), *also)
