"""Where change and event text comes from: files or a topic, from which point on."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from retally.schemas import Table

TOPIC = "topic"
SHARD = "_shard"


def file_lines(spark: SparkSession, folder: str, since: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the text lines of a folder, column ``value``.

    All files from the beginning, or with ``since`` (a timestamp text) only
    those modified later, which is how a stream of changes alone starts.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(folder)
    if since is None:
        return lines
    return lines.where(F.col("_metadata.file_modification_time") > F.lit(since).cast("timestamp")).select("value")


def kafka_lines(spark: SparkSession, servers: str, topics: str, start: str = "earliest",
                records_per_batch: int | None = None) -> DataFrame:
    """Stream of a topic's values as text (needs the Kafka source on the class path).

    ``start`` is ``earliest``, ``latest`` or a JSON offset map; several topics
    are given separated by commas.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topics).option("startingOffsets", start))
    if records_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", records_per_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"), TOPIC, "partition", "offset",
                                F.unix_millis("timestamp").alias("ts_ms"), F.col("offset").alias("pos"))


def fan_in(streams: Mapping[str, DataFrame]) -> DataFrame:
    """Streams of several topics as one, with the topic each record came from.

    Each has the columns ``value`` and the record's place, ``ts_ms`` and ``pos``, which orders records across the topics.
    A micro-batch takes from all of them, so one checkpoint holds the offsets of all.
    """
    frames = [s.select("value", "ts_ms", "pos", F.lit(name).alias(TOPIC)) for name, s in streams.items()]
    return reduce(DataFrame.unionByName, frames)


def sharded(spark: SparkSession, table: Table, folder: str, pattern: str, format: str = "parquet") -> DataFrame:
    """All shards of a table (``game_record_*``) as one frame, with the shard each row came from."""
    rows = spark.read.schema(table.struct).format(format).load(f"{folder}/{pattern}")
    shard = F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+$", 1)
    return rows.select(*table.names, shard.alias(SHARD))


def shard_lines(spark: SparkSession, folder: str, pattern: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the lines of all shards (``game_record_*``), columns ``value`` and the shard.

    Folders are looked for in every batch, so a shard that appears while the stream runs is read from its beginning.
    Decode with ``also=[SHARD]``; columns a shard lacks come out as null.
    """
    reader = spark.readStream.schema("value STRING")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(f"{folder}/{pattern}")
    return lines.select("value", F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+$", 1).alias(SHARD))


def with_shard(changes: DataFrame) -> DataFrame:
    """Changes whose images hold the shard, which makes it part of the key: shards may use the same numbers."""
    image = lambda c: F.when(F.col(c).isNotNull(), F.struct(f"{c}.*", SHARD)).alias(c)
    return changes.select(image("before"), image("after"), *[c for c in changes.columns if c not in ("before", "after", SHARD)])


def write_once(lines: DataFrame, folder: str, batch: int) -> None:
    """The lines (column ``value``) of one batch, for another stream to read from ``folder``.

    They are written aside and appear as a whole, by a rename; a batch that runs again finds its folder there and writes
    nothing, so the reader, which knows files by name, sees every line once.  The text is compressed, quickly, as it is read
    but once.
    """
    spark = lines.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = path(f"{folder}/batch={batch}")
    files = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(done):
        return
    writer = lines.select("value").write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.text(f"{folder}/_staged/batch={batch}")
    if not files.rename(path(f"{folder}/_staged/batch={batch}"), done):
        raise OSError(f"could not move batch {batch} into {folder}")


def write_lines(lines: DataFrame, folder: str) -> None:
    """Append encoded lines (column ``value``) to a folder another stream reads."""
    lines.select("value").write.mode("append").text(folder)
