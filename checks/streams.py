"""Registered queries over streams.

Spark writes the derived changes as text to the files of several steps, dealt out by key and step: a row's moves and its
delete arrive in later steps than its insert.  A step has as many files as keep one of bounded size.  The streams read one
step per micro-batch, so every state is restated, taken back and compacted on the way; the result is the table at the end.
Change text is written step by step, each dropped when it was read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from retally import schemas as S
from retally.functions.measures import heads
from retally.operators import changelog as C
from retally.operators import cleanse as P
from retally.operators import joins
from retally.operators.aggregate import Aggregate, by
from retally.plans import reports as R
from retally.session import SETTINGS
from retally.sinks.batch_log import BatchLog, drop_folder, workspace
from retally.sinks.keyed_table import KeyedTable
from retally.sources import derived as D
from retally.sources import envelope as E
from retally.sources import topics
from retally.streaming import native, pipeline
from retally.streaming.counted import Counted
from retally.streaming.restate import OrderPayments, Restatement

Query = Callable[[SparkSession, str], DataFrame]
Flow = Callable[[DataFrame], DataFrame]
AS_IS: Flow = lambda lines: lines

FILES, COMPACT_EVERY = 4, 3
#: A change's step (0 insert to 3 delete), half of the rows one step later.
BY_STEP = f"least(pmod(pos, 4) + pmod(hash(ts_ms), 2), {FILES - 1})"


def new_home(spark: SparkSession) -> str:
    return workspace(spark, f"retally-{uuid.uuid4().hex}")


def in_files(frame: DataFrame, path: str, number: Column | None = None, kind: str = "text") -> tuple[str, int]:
    """The rows in numbered steps (column ``file``, or by ``number``), older ones first: the folder and the files of a step.

    Each task writes its rows of each step to a file, so nothing is dealt out anew, and a file is as large as the
    frame's tasks are.
    """
    frame = frame if number is None else frame.withColumn("file", number)
    frame.write.partitionBy("file").option("compression", "gzip").format(kind).save(path)
    spark = frame.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    most = 1
    for folder in system.listStatus(hadoop(path)):
        name = folder.getPath().getName()
        if name.startswith("file="):
            parts = system.listStatus(folder.getPath())
            most = max(most, len(parts))
            for part in parts:
                system.setTimes(part.getPath(), 1_700_000_000_000 + 60_000 * int(name.split("=")[1]), -1)
    return path, most


def change_text(spark: SparkSession, folder: str, *stories: str) -> Callable[[int], DataFrame]:
    """The change text of some tables (``value``), step by step: only the images of a step's changes are made."""
    def of_step(step: int) -> DataFrame:
        text = None
        for story in stories:
            changes = D.story_changes(spark, folder, story, tasks[story], f"{BY_STEP} = {step}")
            one = E.encode_changes(changes, D.STORIES[story].table, replace_updates=False)
            text = one if text is None else text.unionByName(one)
        return text

    tasks = {story: D.story_tasks(spark, folder, story) for story in stories}
    return of_step


def run_steps(text: DataFrame | Callable[[int], DataFrame], path: str, flow: Flow, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run the stream that ``flow`` makes of encoded lines, a micro-batch for each step (column ``file``, or a function of it).

    A step is written when its turn comes, appears as a whole, and is dropped once the stream is done with it, as a log
    drops what lies behind its readers; so one step lies there at a time.  Each task writes one file of a step, so a file is
    as large as the frame's tasks are.
    """
    lines_of = text if callable(text) else lambda step: text.where(F.col("file") == step)
    lines, query = lines_of(0), None
    spark = lines.sparkSession
    frees_shuffles(spark)
    keeps_state_on_disk(spark)
    try:
        for step in range(FILES):
            topics.write_once(lines if step == 0 else lines_of(step), path, step)
            if query is None:
                writer = flow(topics.file_lines(spark, f"{path}/batch=*").select("value")).writeStream.outputMode("update")
                query = writer.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start()
            query.processAllAvailable()
            drop_folder(spark, f"{path}/batch={step}")
    finally:
        if query is not None:
            query.stop()


def frees_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when their job is done instead of staying for as long as the stream runs."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def keeps_state_on_disk(spark: SparkSession) -> None:
    """State goes to RocksDB on an executor's disk, with a bounded cache, instead of a map in its heap."""
    store = "spark.sql.streaming.stateStore"
    spark.conf.set(f"{store}.providerClass", SETTINGS[f"{store}.providerClass"])
    spark.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set(f"{store}.rocksdb.boundedMemoryUsage", "true")


def step_rows(frame: DataFrame, path: str, number: Column | None = None) -> DataFrame:
    """Stream of rows, one step per micro-batch."""
    path, files = in_files(frame, path, number, kind="parquet")
    shape = frame.drop("file").schema
    return frame.sparkSession.readStream.schema(shape).option("maxFilesPerTrigger", files).parquet(path)


def finish(frame: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> None:
    """Run a stream to the end of its input; a failed query raises."""
    writer = frame.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def _signed(lines: DataFrame, table: S.Table) -> DataFrame:
    return C.signed_rows(E.decode_changes(lines, table))


def _counted(story: str, table: S.Table, clean: Callable[[DataFrame], DataFrame], agg: Aggregate) -> Query:
    """One report with distinct counts or extremes."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        home = new_home(spark)
        state = Counted(spark, f"{home}/state", [agg], spark.createDataFrame([], table.struct), clean, COMPACT_EVERY)
        run_steps(change_text(spark, folder, story), f"{home}/lines", lambda lines: state.stream(_signed(lines, table)),
                  state.each_batch, f"{home}/checkpoint")
        return state.current(agg.name)

    return query


PLAYERS = Aggregate("players", by(R.DAY, "channel_id"), (heads("user_count", "user_id"),), source="games")
GAME_REPORTS = (R.USER_GAME_DAY, R.USER_GAME_HOUR, R.CHANNEL_CATEGORY_DAY, R.CHANNEL_PROVIDER_DAY, R.CHANNEL_GAME_DAY,
                R.PLAYER_DAY, R.PLAYER_TOTAL)
_runs: dict[tuple[str, str], tuple[Counted, KeyedTable]] = {}


def _all_of_games(spark: SparkSession, folder: str) -> tuple[Counted, KeyedTable]:
    """Eight targets kept by one stream of game records; a session runs it once per folder."""
    key = spark.sparkContext.applicationId, folder
    if key not in _runs:
        home = new_home(spark)
        sample = spark.createDataFrame([], S.GAME_RECORD.struct)
        detail = KeyedTable(spark, f"{home}/detail", P.game_detail(sample).schema, S.GAME_RECORD.key, keep_deleted=True)
        state = Counted(spark, f"{home}/state", GAME_REPORTS, sample, P.clean_games, COMPACT_EVERY,
                        {"detail": pipeline.detail_batch(detail, P.game_detail)})
        run_steps(change_text(spark, folder, "game_record"), f"{home}/lines",
                  lambda lines: state.stream(_signed(lines, S.GAME_RECORD)), state.each_batch, f"{home}/checkpoint")
        _runs[key] = state, detail
    return _runs[key]


def _of_games(agg: Aggregate) -> Query:
    return lambda s, f: _all_of_games(s, f)[0].current(agg.name)


def _running(spark: SparkSession, folder: str) -> DataFrame:
    """All-time player totals as one streaming aggregation in update mode."""
    home = new_home(spark)
    totals = lambda lines: native.running(P.clean_games(_signed(lines, S.GAME_RECORD)), R.PLAYER_TOTAL_OF_GAMES)
    row = T.StructType([f for f in totals(spark.createDataFrame([], "value STRING")).schema if f.name != "op"])
    table = KeyedTable(spark, f"{home}/table", row, R.PLAYER_TOTAL.key_names)
    run_steps(change_text(spark, folder, "game_record"), f"{home}/lines", totals, pipeline.upsert_batch(table), f"{home}/checkpoint")
    return table.current()


def _mirror(spark: SparkSession, folder: str) -> DataFrame:
    """The device relation mirrored from its change stream."""
    home = new_home(spark)
    table = KeyedTable(spark, f"{home}/table", S.DEVICE_USERS.struct, S.DEVICE_USERS.key, keep_deleted=True)
    each = pipeline.mirror_batch(table, S.DEVICE_USERS, compact_every=COMPACT_EVERY)
    run_steps(change_text(spark, folder, "device_users"), f"{home}/lines", AS_IS, each, f"{home}/checkpoint")
    return table.current()


def _snapshot_mirror(spark: SparkSession, folder: str) -> DataFrame:
    """The device relation from a snapshot that has all inserts and some of the edits, then from the whole log."""
    home = new_home(spark)
    # a log in which all inserts come first, then the edits, then the deletes
    changes = D.story_changes(spark, folder, "device_users", D.story_tasks(spark, folder, "device_users"))
    size = changes.agg(F.max("ts_ms")).first()[0] + 1
    place = F.pmod("pos", F.lit(4)) * size + F.col("ts_ms")
    changes = changes.withColumns({"pos": place, "ts_ms": place})
    at = size + size // 2
    table = KeyedTable(spark, f"{home}/table", S.DEVICE_USERS.struct, S.DEVICE_USERS.key, keep_deleted=True)
    pipeline.take_snapshot(table, C.current_rows(changes.where(F.col("ts_ms") <= at), S.DEVICE_USERS.key), at)
    text = E.encode_changes(changes.withColumn("file", F.floor(F.col("ts_ms") / size).cast("int")), S.DEVICE_USERS, also=["file"])
    decode = lambda batch: pipeline.after_snapshot(E.decode_changes(batch, S.DEVICE_USERS), at)
    each = pipeline.mirror_batch(table, S.DEVICE_USERS, compact_every=COMPACT_EVERY, decode=decode)
    run_steps(text, f"{home}/lines", AS_IS, each, f"{home}/checkpoint")
    return table.current()


def _finance(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and payment tries in one stream, joined change by change."""
    home = new_home(spark)
    orders, payments = S.WITHDRAW_ORDER.only(P.WITHDRAWAL_COLUMNS), S.PAYMENT_ORDER.only(joins.PAYMENT_COLUMNS)
    flows = {"withdrawals": (orders, P.clean_withdrawals), "payments": (payments, lambda df: df)}
    shape = {n: clean(spark.createDataFrame([], t.struct)) for n, (t, clean) in flows.items()}
    pairs = OrderPayments(spark, f"{home}/state", shape["withdrawals"], shape["payments"], COMPACT_EVERY)
    joined = joins.orders_with_payments(shape["withdrawals"], shape["payments"])
    state = Restatement(spark, f"{home}/state", [R.WITHDRAW_FINANCE_DAY], {R.WITHDRAW_FINANCE_DAY.source: joined}, COMPACT_EVERY)

    def each(batch: DataFrame, number: int) -> None:
        part = pipeline.flows_of(batch, flows)
        state.process(number, {R.WITHDRAW_FINANCE_DAY.source: pairs.restate(number, part["withdrawals"], part["payments"])})
        pairs.tidy(number)

    run_steps(change_text(spark, folder, "withdraw_order", "payment_order"), f"{home}/lines", AS_IS, each, f"{home}/checkpoint")
    return state.current(R.WITHDRAW_FINANCE_DAY.name)


# --- one job's changes are the next job's input -----------------------------------

def _clean_game_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Cleansed game changes go out as text; a second job reads them and keeps the table."""
    home = new_home(spark)
    shape = P.clean_games(spark.createDataFrame([], S.GAME_RECORD.struct))
    table = S.table_of("game_record_dwd", S.GAME_RECORD.key, shape.schema)

    def cleansed(lines: DataFrame, batch: int) -> None:
        signed = P.clean_games(_signed(lines, S.GAME_RECORD)).drop("row_kind")
        topics.write_once(E.encode_changes(C.as_changes(signed), table), f"{home}/text", batch)

    run_steps(change_text(spark, folder, "game_record"), f"{home}/lines", AS_IS, cleansed, f"{home}/first")
    target = KeyedTable(spark, f"{home}/table", table.struct, table.key, keep_deleted=True)
    finish(topics.file_lines(spark, f"{home}/text").select("value"), pipeline.mirror_batch(target, table), f"{home}/second")
    return target.current()


def _player_day_of_text(spark: SparkSession, folder: str) -> DataFrame:
    """The daily user-game report sends its changes out as text; the report on players is built from that text alone."""
    home = new_home(spark)
    sample = P.clean_games(spark.createDataFrame([], S.GAME_RECORD.struct))
    first = Restatement(spark, f"{home}/games", [R.USER_GAME_DAY], {"games": sample}, COMPACT_EVERY)
    report = first.reports[R.USER_GAME_DAY.name].table
    table = S.table_of(R.USER_GAME_DAY.name, tuple(R.USER_GAME_DAY.key_names), report.row)
    flows = {"games": (S.GAME_RECORD, P.clean_games)}

    def games(lines: DataFrame, batch: int) -> None:
        first.process(batch, pipeline.flows_of(lines, flows))
        topics.write_once(E.encode_changes(report.changes(batch), table), f"{home}/text", batch)

    run_steps(change_text(spark, folder, "game_record"), f"{home}/lines", AS_IS, games, f"{home}/first")
    second = Restatement(spark, f"{home}/players", [R.PLAYER_DAY], {R.USER_GAME_DAY.name: spark.createDataFrame([], table.struct)})
    flow = {R.USER_GAME_DAY.name: (table, lambda df: df)}
    finish(topics.file_lines(spark, f"{home}/text").select("value"),
           lambda lines, batch: second.process(batch, pipeline.flows_of(lines, flow)), f"{home}/second")
    return second.current(R.PLAYER_DAY.name)


# --- shards, broken lines, windows ---------------------------------------------------

SHARDS = 3


def _sharded(spark: SparkSession, folder: str) -> DataFrame:
    """Game records of three shards with the same numbers; the last shard appears later and lacks a column."""
    home = new_home(spark)
    number = lambda c: F.col(c).getField("id")
    tasks = D.story_tasks(spark, folder, "game_record")
    changes = D.story_changes(spark, folder, "game_record", tasks)
    shard = F.pmod(F.coalesce(number("after"), number("before")), F.lit(SHARDS))
    halved = lambda c: F.when(F.col(c).isNotNull(), F.col(c).withField("id", F.floor(number(c) / SHARDS))).alias(c)
    changes = changes.select(halved("before"), halved("after"), "op", "ts_ms", "pos", shard.alias("shard"), F.expr(BY_STEP).alias("file"))
    lacking = S.GAME_RECORD.only([n for n in S.GAME_RECORD.names if n != "game_name_code"])

    def appears(n: int, table: S.Table) -> None:
        fit = lambda c: F.when(F.col(c).isNotNull(), F.struct(*[F.col(f"{c}.{f}") for f in table.names])).alias(c)
        mine = changes.where(F.col("shard") == n).select(fit("before"), fit("after"), "op", "ts_ms", "pos", "file")
        text = E.encode_changes(mine, table, also=["file"])
        for half in (0, 1):
            step = text.where(F.floor(F.col("file") * 2 / FILES) == half).select("value")
            step.write.mode("append").option("compression", "gzip").text(f"{home}/shards/game_record_{n}")

    row = T.StructType([*S.GAME_RECORD.struct, T.StructField(topics.SHARD, T.StringType())])
    table = KeyedTable(spark, f"{home}/table", row, (topics.SHARD, *S.GAME_RECORD.key), keep_deleted=True)
    decode = lambda lines: topics.with_shard(E.decode_changes(lines, S.GAME_RECORD, also=[topics.SHARD]))
    each = pipeline.mirror_batch(table, S.GAME_RECORD, compact_every=COMPACT_EVERY, decode=decode, tasks=tasks)
    for shards in ([(0, S.GAME_RECORD), (1, S.GAME_RECORD)], [(2, lacking)]):
        for n, columns in shards:
            appears(n, columns)
        finish(topics.shard_lines(spark, f"{home}/shards", "game_record_*", tasks), each, f"{home}/checkpoint")
    return table.current()


def broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Event text cut short now and then, with the number of the event."""
    rows = D.spread(D.rows(spark, folder, "online_event"), "token")
    text = E.encode_events(rows, F.regexp_extract("token", r"t(\d+)", 1))
    number = F.regexp_extract("value", r'^\{"key":"(\d+)"', 1).cast("bigint")
    ip = F.regexp_extract("value", r'"ip":"10\.0\.0\.(\d+)"', 1).cast("int")
    return text.select(number.alias("event_id"), F.when(ip % 7 == 0, F.expr("left(value, length(value) - 3)"))
                       .otherwise(F.col("value")).alias("value"))


def _corrupt(spark: SparkSession, folder: str) -> DataFrame:
    """Good rows and broken lines of each batch go to two targets from one decode."""
    home = new_home(spark)
    lines = broken_lines(spark, folder)
    stream = step_rows(lines, f"{home}/lines", F.pmod(F.hash("event_id"), F.lit(FILES)))
    good = BatchLog(spark, f"{home}/good", T.StructType.fromDDL("event_id BIGINT, user_id BIGINT"))
    broken = BatchLog(spark, f"{home}/broken", T.StructType.fromDDL("event_id BIGINT, text STRING"))
    each = pipeline.split_batch(
        lambda rows, batch: good.write(batch, rows.select("event_id", F.col("jsonData.user_id").alias("user_id"))),
        lambda rows, batch: broken.write(batch, rows.select("event_id", F.col("_corrupt").alias("text"))),
        lambda rows: E.decode_events(rows, S.ONLINE_EVENT, keep_corrupt=True, also=["event_id"]))
    finish(stream, each, f"{home}/checkpoint", "append")
    return good.read().select("event_id", "user_id", F.lit(False).alias("corrupt")).unionByName(
        broken.read().select("event_id", F.lit(None).cast("bigint").alias("user_id"), F.lit(True).alias("corrupt")))


def _online_of_two(spark: SparkSession, folder: str) -> DataFrame:
    """Online status from two topics into one table; most events are in both, either may have the later record or arrive first."""
    home = new_home(spark)
    rows = D.spread(D.rows(spark, folder, "online_event"), "token").withColumns({
        "event_id": F.regexp_extract("token", r"t(\d+)", 1).cast("bigint"), "k": F.regexp_extract("ip", r"(\d+)$", 1).cast("int")})
    kinds = {"online": ("k % 3 <> 0", "token", "event_id * 10", "pmod(k, 4)"),
             "online_again": ("k % 3 <> 1", "'again-' || token", "event_id * 10 + CASE WHEN k % 5 < 2 THEN 3 ELSE -3 END",
                              "pmod(k + 1, 4)")}
    topic: dict[str, DataFrame] = {}
    for name, (here, token, at, file) in kinds.items():
        mine = rows.where(here).withColumns({"token": F.expr(token), "ts_ms": F.expr(at), "pos": F.col("event_id"),
                                             "file": F.expr(file)}).drop("event_id", "k")
        lines = E.encode_events(mine, "token", also=["ts_ms", "pos", "file"])
        topic[name] = step_rows(lines, f"{home}/{name}")
    clean = lambda records: P.clean_online_status(E.decode_events(records, S.ONLINE_EVENT, also=C.ORDER))
    shape = P.clean_online_status(E.decode_events(spark.createDataFrame([], "value STRING"), S.ONLINE_EVENT)).schema
    table = KeyedTable(spark, f"{home}/table", shape, S.ONLINE_EVENT.key)
    finish(topics.fan_in(topic), pipeline.latest_batch(table, clean, compact_every=COMPACT_EVERY), f"{home}/checkpoint", "append")
    return table.current()


LATENESS = "10 minutes"


def _windows(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases per hour, closed windows only; a tenth of them arrives after everything else."""
    home = new_home(spark)
    rows = D.spread(spark.read.parquet(f"{folder}/events.parquet"), "event_id").where("event_type = 'purchase'").select(
        "ts", (F.get_json_object("props", "$.k").cast("int") % 10 == 3).alias("late"))
    first, last = rows.agg(F.unix_seconds(F.min("ts").cast("timestamp")), F.unix_seconds(F.max("ts").cast("timestamp"))).first()
    third = F.floor(3 * (F.unix_seconds(F.col("ts").cast("timestamp")) - F.lit(first)) / F.lit(max(1, last - first))).cast("int")
    number = F.when(F.col("late"), FILES - 1).otherwise(F.least(third, F.lit(2)))
    stream = step_rows(rows, f"{home}/rows", number).select("ts")
    windows = native.closed_windows(stream, "ts", "1 hour", LATENESS)
    log = BatchLog(spark, f"{home}/windows", windows.schema)
    finish(windows, lambda df, batch: log.write(batch, df), f"{home}/checkpoint", "append")
    return log.read().drop("batch")


def build() -> dict[str, Query]:
    return {
        "stream_user_game_day": _of_games(R.USER_GAME_DAY), "stream_user_game_hour": _of_games(R.USER_GAME_HOUR),
        "stream_channel_category": _of_games(R.CHANNEL_CATEGORY_DAY), "stream_channel_provider": _of_games(R.CHANNEL_PROVIDER_DAY),
        "stream_channel_game": _of_games(R.CHANNEL_GAME_DAY), "stream_player_day": _of_games(R.PLAYER_DAY),
        "stream_user_game_total": _of_games(R.PLAYER_TOTAL), "stream_game_detail": lambda s, f: _all_of_games(s, f)[1].current(),
        "stream_channel_distinct": _counted("game_record", S.GAME_RECORD, P.clean_games, PLAYERS),
        "stream_user_adjust": _counted("amount_operation", S.AMOUNT_OPERATION.only(P.AMOUNT_OPERATION_FEED),
                                       P.clean_amount_operations, R.USER_ADJUST_DAY),
        "stream_running_total": _running, "stream_mirror": _mirror, "stream_snapshot_mirror": _snapshot_mirror,
        "stream_withdraw_finance": _finance, "dwd_game_changes": _clean_game_changes,
        "stream_player_day_of_text": _player_day_of_text, "stream_sharded_game": _sharded,
        "stream_corrupt_events": _corrupt, "stream_window_1h": _windows, "stream_online_of_two": _online_of_two,
    }
