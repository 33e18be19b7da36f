"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text a task works on at once; only memory depends on it, never a result.
SLICE_BYTES = 4_000_000
#: An Arrow batch between Spark and a worker; both sides hold one or two of them per task.
BATCH_BYTES = 8 << 20


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.mkdtemp(prefix='run-')}/{name}"


def kept(df: DataFrame, path: str) -> DataFrame:
    """The rows written to ``path`` and read from there: a cut in the lineage that survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    longer = lambda name: name if name.lower() not in taken else longer(f"{name}_")
    return [longer(name) for name in names]


def ready(spark: SparkSession) -> None:
    """Let Python workers of a session that was started elsewhere import this package, keep Arrow batches small and free disk early.

    Every step is a written table, so the shuffle files of a finished step are not needed again.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds about ``most`` bytes in each (one long value may hold more)."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pc.fill_null(pc.binary_length(values), 0)).astype(np.int64)
        total, start = np.cumsum(size), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Values of a text column as UTF-8; null is the empty text."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [b"" if v is None else v for v in values.to_pylist()]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer: near numbers become far ones."""
    h = np.asarray(h, np.uint64)
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class HashTable:
    """Distinct 64-bit keys in an open-addressing numpy table; looks up whole arrays of keys at once."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        self._bits = max(4, int(2 * max(1, len(keys))).bit_length())
        size = 1 << self._bits
        self._keys = np.zeros(size, np.uint64)
        self._rows = np.full(size, -1, np.int32)
        todo, at = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        self._probes = 0
        while len(todo):
            self._probes += 1
            free = self._rows[at] < 0
            self._rows[at[free]] = todo[free]            # of several keys at one slot the last one stays
            self._keys[at[free]] = keys[todo[free]]
            lost = self._rows[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> np.uint64(64 - self._bits)).astype(np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """For each key its number in the list the table was made of, -1 where it is not in there."""
        keys = np.asarray(keys, np.uint64)
        at = self._slot(keys)
        out = np.where(self._keys[at] == keys, self._rows[at], -1).astype(np.int32)
        todo = np.flatnonzero((out < 0) & (self._rows[at] >= 0))
        for step in range(1, self._probes):
            if not len(todo):
                break
            slot = (at[todo] + step) & (len(self._rows) - 1)
            hit = (self._keys[slot] == keys[todo]) & (self._rows[slot] >= 0)
            out[todo[hit]] = self._rows[slot[hit]]
            todo = todo[~hit & (self._rows[slot] >= 0)]
        return out
