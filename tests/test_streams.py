"""Streams end where a batch over the final table ends, however the log is cut or repeated."""

import os

import pytest
from pyspark.sql import functions as F, types as T

from retally import schemas as S
from retally.operators import changelog as C
from retally.operators.aggregate import Aggregate, by, summarise
from retally.functions.measures import earliest, heads, latest, tally, total
from retally.sinks.keyed_table import KeyedTable
from retally.sources import envelope as E
from retally.sources import topics
from retally.streaming import native, pipeline
from retally.streaming.restate import Restatement

TABLE = S.Table("t", ("id",), "id BIGINT, g STRING, user BIGINT, n DECIMAL(20,4), update_time TIMESTAMP_NTZ")
DAILY = Aggregate("daily", by("g", statistic_time="CAST(update_time AS DATE)"), (
    total("n", "n"), tally("many", "TRUE"), heads("users", "user"), earliest("first", "update_time"),
    latest("last", "update_time")), source="t")
OVER = Aggregate("over", by("g"), (total("n", "n"), total("many", "many", type="BIGINT")), source="daily")


def story(spark, n=60):
    """Insert n rows; every third changes group and day, every fifth goes away."""
    a, b = F.expr(_image(0)), F.expr(_image(1))
    none = F.lit(None).cast(TABLE.struct)

    def step(i, before, after, op):
        return F.struct(before.cast(TABLE.struct).alias("before"), after.cast(TABLE.struct).alias("after"),
                        F.lit(op).alias("op"), F.col("id").alias("ts_ms"), (F.col("id") * 3 + i).alias("pos"))

    moved = F.expr("id % 3 = 0")
    steps = F.array(step(0, none, a, "c"), F.when(moved, step(1, a, b, "u")),
                    F.when(F.expr("id % 5 = 0"), step(2, F.when(moved, b).otherwise(a), none, "d")))
    return spark.range(n).select(F.explode(steps).alias("s")).where("s IS NOT NULL").select("s.*")


def _image(v):
    return (f"named_struct('id', id, 'g', concat('g', (id + {v}) % 4), 'user', (id + {v}) % 7, 'n', cast(id as decimal(20,4)),"
            f" 'update_time', cast('2024-01-01' as timestamp_ntz) + make_dt_interval(cast((id + {v}) % 5 as int)))")


def same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def expected(spark):
    current = C.current_rows(story(spark), ["id"])
    daily = summarise(current, DAILY)
    return {"daily": daily, "over": summarise(daily, OVER)}


@pytest.mark.parametrize("cuts", [1, 3])
def test_however_the_log_is_cut(spark, tmp_path, cuts):
    lines = E.encode_changes(story(spark), TABLE, replace_updates=False)
    lines.repartition(cuts).write.text(str(tmp_path / "lines"))
    state = Restatement(spark, str(tmp_path / "state"), [DAILY, OVER], {"t": spark.createDataFrame([], TABLE.struct)},
                        compact_every=2)
    flows = {"t": (TABLE, lambda df: df)}
    each = lambda df, b: state.process(b, pipeline.flows_of(df, flows))
    stream = topics.file_lines(spark, str(tmp_path / "lines"), files_per_batch=1)
    query = pipeline.run(stream, each, str(tmp_path / "checkpoint"))
    assert query.awaitTermination(90) and query.exception() is None
    for name, want in expected(spark).items():
        same(want, state.current(name))


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    signed = C.signed_rows(story(spark)).drop("row_kind", "_order")
    pieces = [signed.where(F.pmod("id", F.lit(2)) == i) for i in range(2)]
    state = Restatement(spark, str(tmp_path), [DAILY, OVER], {"t": spark.createDataFrame([], TABLE.struct)})
    report = state.reports["daily"]
    state.process(0, {"t": pieces[0]})
    # the second batch fails after its partials were stored, then runs twice
    from retally.operators.aggregate import deltas
    report.parts.write(1, deltas(pieces[1], DAILY))
    for _ in range(2):
        state.process(1, {"t": pieces[1]})
    for name, want in expected(spark).items():
        same(want, state.current(name))


def test_sums_as_one_streaming_aggregation(spark, tmp_path):

    sums = Aggregate("sums", by("g"), (total("n", "n"), tally("many", "user > 2")), factors=("user",))
    folder = str(tmp_path / "signed")
    C.signed_rows(story(spark)).drop("_order").repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = native.running(stream, sums)
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType([f for f in out.schema if f.name != "op"]), ["g"])
    query = (out.writeStream.outputMode("update").foreachBatch(pipeline.upsert_batch(table))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    assert query.awaitTermination(90)
    same(summarise(C.current_rows(story(spark), ["id"]), sums), table.current())
    with pytest.raises(ValueError):
        native.running(stream, DAILY)


def test_distinct_values_in_keyed_state(spark, tmp_path):

    folder = str(tmp_path / "signed")
    C.signed_rows(story(spark)).drop("_order").repartition(2).write.parquet(folder)
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    for ttl in (None, 3_600_000):
        pieces = native.distinct_heads(stream, ["g"], "user", salts=3, ttl_ms=ttl)
        table = KeyedTable(spark, str(tmp_path / f"t{ttl}"), pieces.schema, ["g", native.SALT])
        put = pipeline.upsert_batch(table, lambda df: df.withColumn("op", F.lit("u")))
        # with a time to live the query goes on with empty batches, so it is stopped by hand
        query = (pieces.writeStream.outputMode("update").foreachBatch(put)
                 .option("checkpointLocation", str(tmp_path / f"cp{ttl}")).trigger(availableNow=True).start())
        ended = query.awaitTermination(60 if ttl is None else 25)
        query.stop()
        assert ended or ttl
        heads_now = native.heads_of_pieces(table.current(), ["g"])
        want = C.current_rows(story(spark), ["id"]).groupBy("g").agg(F.count_distinct("user").alias("heads"))
        same(want, heads_now)


def test_start_points_of_files(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "old.txt").write_text("old\n")
    os.utime(folder / "old.txt", (1_600_000_000, 1_600_000_000))
    (folder / "new.txt").write_text("new\n")
    for since, want in ((None, {"old", "new"}), ("2023-01-01 00:00:00", {"new"})):
        got = []
        query = pipeline.run(topics.file_lines(spark, str(folder), since), lambda df, b: got.extend(r.value for r in df.collect()),
                             str(tmp_path / f"cp{since is None}"))
        assert query.awaitTermination(60)
        assert set(got) == want


def test_shards_read_as_one_table(spark, tmp_path):
    for shard in ("0001", "0002"):
        spark.createDataFrame([(int(shard), "d", 1, None, None)], S.DEVICE_USERS.struct).write.parquet(str(tmp_path / f"device_{shard}"))
    got = topics.sharded(spark, S.DEVICE_USERS, str(tmp_path), "device_*")
    assert {(r.id, r._shard) for r in got.collect()} == {(1, "device_0001"), (2, "device_0002")}


def test_lines_written_for_the_next_stage(spark, tmp_path):
    topics.write_lines(E.encode_changes(story(spark, 4), TABLE), str(tmp_path / "out"))
    topics.write_lines(E.encode_changes(story(spark, 4), TABLE), str(tmp_path / "out"))
    back = E.decode_changes(spark.read.text(str(tmp_path / "out")), TABLE)
    assert C.once(back).count() * 2 == back.count()


def test_watermark_and_windows(spark, tmp_path):
    folder = str(tmp_path / "e")
    spark.createDataFrame([(i, f"2024-01-01 00:{i // 4:02d}:{i % 4 * 10:02d}") for i in range(16)], "i INT, t STRING").select(
        "i", F.col("t").cast("timestamp_ntz").alias("update_time")).write.parquet(folder)
    assert native.per_window(spark.read.parquet(folder), "update_time", "1 minute").count() == 4
    stream = spark.readStream.schema("i INT, update_time TIMESTAMP_NTZ").parquet(folder)
    got = []
    out = native.per_window(native.bounded(stream), "update_time", "1 minute")
    query = (out.writeStream.outputMode("update").foreachBatch(lambda df, b: got.extend(df.collect()))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    assert query.awaitTermination(60)
    assert sorted((r.window_start.minute, r.rows_in_window) for r in got) == [(0, 4), (1, 4), (2, 4), (3, 4)]
    again = spark.readStream.schema("i INT, update_time TIMESTAMP_NTZ").parquet(folder)
    once = native.once_within(stream.unionByName(again), ["i"], "update_time", "5 minutes")
    seen = []
    query = (once.writeStream.foreachBatch(lambda df, b: seen.extend(r.i for r in df.collect()))
             .option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start())
    assert query.awaitTermination(60)
    assert sorted(seen) == list(range(16))


def test_the_latest_place_of_two_topics_wins(spark, tmp_path):
    row = T.StructType.fromDDL("k STRING, n DECIMAL(20,4)")
    target = KeyedTable(spark, str(tmp_path / "table"), row, ["k"])
    files = {"a": [[("x 1", 10, 0), ("y 1", 10, 1)], [("x 2", 12, 0), (" 9", 99, 0)]],
             "b": [[("x 3", 30, 0), ("y 4", 10, 2)], [("y 5", 9, 7), ("z 6", 1, 0)]]}
    streams = {}
    for name, batches in files.items():
        for records in batches:
            spark.createDataFrame(records, "value STRING, ts_ms BIGINT, pos BIGINT").coalesce(1).write.mode("append").parquet(
                f"{tmp_path}/{name}")
        streams[name] = spark.readStream.schema("value STRING, ts_ms BIGINT, pos BIGINT").option(
            "maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
    seen = []
    rows = lambda lines: lines.selectExpr("nullif(split(value, ' ')[0], '') AS k", "CAST(split(value, ' ')[1] AS INT) AS n", "ts_ms", "pos")
    each = pipeline.latest_batch(target, rows, compact_every=2)
    pipeline.run(topics.fan_in(streams), lambda lines, batch: (seen.extend(r.topic for r in lines.collect()), each(lines, batch)),
                 str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted((r.k, int(r.n)) for r in target.current().collect()) == [("x", 3), ("y", 4), ("z", 6)]
    assert sorted(seen) == ["a"] * 4 + ["b"] * 4
    with pytest.raises(Exception, match="not-null"):
        pipeline.latest_batch(target, rows, "fail")(spark.createDataFrame([(" 9", 1, 1)], "value STRING, ts_ms BIGINT, pos BIGINT"), 7)


def test_steps_have_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """A step is read by as many tasks as wrote it, is one micro-batch, and its text is compressed."""
    from checks import streams
    from retally.sources import derived

    rows = spark.range(0, 4000, 1, 6).selectExpr("'line ' || id AS value", "CAST(id % 4 AS INT) AS file")
    path, files = streams.in_files(rows, str(tmp_path / "lines"))
    assert files == 6 and len(list((tmp_path / "lines").glob("file=*/*.gz"))) == 4 * 6
    seen = []
    lines = topics.file_lines(spark, path, files_per_batch=files)
    streams.finish(lines, lambda df, batch: seen.append(sorted(int(r.value[5:]) for r in df.collect())), str(tmp_path / "ck"))
    assert seen == [list(range(step, 4000, 4)) for step in range(4)]

    monkeypatch.setattr(derived, "TASK_BYTES", 4096)
    folder = "/root/testdata/sf0.001"
    assert derived.story_tasks(spark, folder, "game_record") > 4
    assert derived.story_changes(spark, folder, "game_record").rdd.getNumPartitions() == derived.story_tasks(spark, folder, "game_record")


def test_one_step_of_change_text_lies_there_at_a_time(spark, tmp_path):
    from checks import streams

    text = spark.range(40).selectExpr("CAST(id AS STRING) AS value", "CAST(id % 4 AS INT) AS file")
    home, seen = str(tmp_path), []

    def each(lines, batch):
        there = [f.name for f in (tmp_path / "lines").iterdir() if f.name.startswith("batch=")]
        seen.append((batch, there, sorted(int(r.value) for r in lines.collect())))

    streams.run_steps(text, f"{home}/lines", streams.AS_IS, each, f"{home}/checkpoint")
    assert seen == [(step, [f"batch={step}"], list(range(step, 40, 4))) for step in range(4)]
    assert not [f for f in (tmp_path / "lines").rglob("*.gz")]


def test_shuffle_files_of_a_stream_go_with_their_jobs(spark, tmp_path):
    from checks import streams

    text = spark.range(40).selectExpr("CAST(id AS STRING) AS value", "CAST(id % 4 AS INT) AS file")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    freed = []
    each = lambda lines, batch: freed.append(lines.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
    streams.run_steps(text, f"{tmp_path}/lines", streams.AS_IS, each, f"{tmp_path}/checkpoint")
    assert freed == ["true"] * 4
