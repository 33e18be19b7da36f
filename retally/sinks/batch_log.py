"""A table as immutable parquet folders, one per micro-batch.

Structured Streaming may run a micro-batch again after a failure.  A batch here
owns one folder, written as a whole, and only ever reads folders of earlier
batches, so a second run writes the same folder again and nothing is added
twice.  Every so often the folders so far are added up into a base folder.

Rows are kept together by the ``cluster`` columns (the day, first of all), so
that a filter on them skips files and row groups by their statistics.  There is
no folder per day: a batch of late changes may touch thousands of days with a
few rows each.

This is the plain-file stand-in for a table format with MERGE.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, types as T

BATCH = "batch"


def workspace(spark: SparkSession, name: str) -> str:
    """A folder under the shared one the cluster names in ``spark.checkpoint.dir``.

    Only where no such folder is named (a local test) a temporary one is made.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    import tempfile

    return f"{tempfile.mkdtemp(prefix='run-')}/{name}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, cluster: Sequence[str] = ()):
        self.spark, self.path, self.schema, self.cluster = spark, path, schema, list(cluster)
        self._stored = T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())])

    def write(self, batch: int, df: DataFrame, as_dealt: bool = False) -> None:
        """The rows of one batch; a batch written before is replaced.

        Rows without cluster columns, or ``as_dealt``, are written by the tasks that make them (sorted, but not brought
        together) instead of being dealt out anew; the base brings them together.
        """
        near = df.hint("rebalance", *self.cluster) if self.cluster and not as_dealt else df
        self._save(near, f"{self.path}/part/{BATCH}={batch}")

    def read(self, before: int | None = None) -> DataFrame:
        """Rows of all batches (before one), with the column ``batch``."""
        base, parts = self._live(before)
        frames = [self._load("base", [base])] if base is not None else []
        if parts:
            frames.append(self._load("part", parts))
        if not frames:
            return self.spark.createDataFrame([], self._stored)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def size(self, before: int | None = None) -> int:
        """Bytes of the files that ``read`` reads."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        base, parts = self._live(before)
        folders = [f"{self.path}/base/{BATCH}={base}"] * (base is not None) + [f"{self.path}/part/{BATCH}={b}" for b in parts]
        return sum(path(f).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path(f)).getLength()
                   for f in folders)

    def done(self, batch: int) -> bool:
        """Whether a batch was written to its end."""
        return self._has(f"{self.path}/part/{BATCH}={batch}/_SUCCESS")

    def one(self, batch: int) -> DataFrame:
        return self._load("part", [batch])

    def compact(self, upto: int, fold: Callable[[DataFrame], DataFrame], every: int,
                cut: Sequence[Column | str] = (), tasks: int | None = None) -> bool:
        """Add the batches up to ``upto`` into a new base once ``every`` of them are waiting.

        The base is ordered by range of the cluster columns and then ``cut``,
        which splits a day that holds very many rows.  ``fold`` groups by all of these, so the stored rows are dealt
        out by range once, over ``tasks``, and folded where they are.
        """
        if len(self._live(upto + 1)[1]) < every:
            return False
        stored = self.read(upto + 1)
        if self.cluster:
            stored = stored.repartitionByRange(*([tasks] if tasks else []), *self.cluster, *cut)
        self._save(fold(stored), f"{self.path}/base/{BATCH}={upto}")
        return True

    # -- folders ------------------------------------------------------------------

    def _save(self, df: DataFrame, folder: str) -> None:
        df = df.select(*self.schema.names)
        if self.cluster:
            df = df.sortWithinPartitions(*self.cluster)
        df.write.mode("overwrite").option("compression", "zstd").parquet(folder)

    def _load(self, kind: str, batches: Sequence[int]) -> DataFrame:
        root = f"{self.path}/{kind}"
        return (self.spark.read.schema(self._stored).option("basePath", root)
                .parquet(*[f"{root}/{BATCH}={b}" for b in batches]))

    def _has(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def _finished(self, kind: str) -> list[int]:
        """Batches whose write was committed."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath() for s in fs.listStatus(root)]
        return sorted(int(p.getName().split("=")[1]) for p in names
                      if p.getName().startswith(f"{BATCH}=")
                      and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _live(self, before: int | None) -> tuple[int | None, list[int]]:
        fits = (lambda b: True) if before is None else (lambda b: b < before)
        bases = [b for b in self._finished("base") if fits(b)]
        base = bases[-1] if bases else None
        return base, [b for b in self._finished("part") if fits(b) and (base is None or b > base)]
