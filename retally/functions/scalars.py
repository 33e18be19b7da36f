"""Scalar helpers over built-in functions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PIPE = "|"


def day_of(ts: str | Column) -> Column:
    """Calendar day of a zone-less timestamp; the session zone plays no part."""
    return F.to_date(ts)


def hour_of(ts: str | Column) -> Column:
    return F.hour(ts).cast("bigint")


def iso_timestamp(text: str | Column) -> Column:
    """``2025-12-31T15:12:09[.fff]`` text as a zone-less timestamp, null on bad text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.replace(col, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")


def flag_to_int(flag: str | Column) -> Column:
    """true -> 1, anything else (null too) -> 0."""
    return F.when(F.col(flag) if isinstance(flag, str) else flag, F.lit(1)).otherwise(F.lit(0))


def text_amount(text: str | Column, type: str = "decimal(20,4)") -> Column:
    """An amount that travels as text; null when it is not a number."""
    return (F.col(text) if isinstance(text, str) else text).try_cast(type)


def piped(*parts: str | Column) -> Column:
    """Parts glued with ``|``; null as soon as one part is null."""
    cols = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    glued = [cols[0]]
    for c in cols[1:]:
        glued += [F.lit(PIPE), c]
    return F.concat(*glued)


def local_timestamp(epoch_ms: str | Column, zone: str) -> Column:
    """Epoch milliseconds as the zone-less wall-clock time of ``zone``."""
    ms = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (ms / 1000).cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
