"""What a keyed target asks of a row: its columns by name, its types, its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F, types as T


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of the target, matched by name, cast to the target types.

    Casts are strict: a value that does not fit fails the job instead of
    becoming null.
    """
    missing = [f.name for f in target if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])


def enforce_not_null(df: DataFrame, columns: Sequence[str], on_null: str = "drop",
                     seen: Observation | None = None) -> DataFrame:
    """Rows with a null in a column that may not be null: dropped, or the job fails.

    ``seen`` (a batch frame's Observation) counts the rows dropped.
    """
    if on_null not in ("drop", "fail"):
        raise ValueError("on_null is 'drop' or 'fail'")
    broken = F.lit(False)
    for c in columns:
        broken = broken | F.col(c).isNull()
    if on_null == "fail":
        alarm = F.raise_error(F.concat(F.lit("null in a not-null column of: "), F.lit(", ".join(columns))))
        return df.where(F.when(broken, alarm.cast("boolean")).otherwise(F.lit(True)))
    if seen is not None:
        df = df.observe(seen, F.count_if(broken).alias("dropped"))
    return df.na.drop(subset=list(columns))
