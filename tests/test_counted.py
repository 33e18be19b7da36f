"""Distinct counts and extremes over a stream, against the batch over the final table."""

import pytest
from pyspark.sql import functions as F

from retally.functions.measures import earliest, heads, latest, tally, total
from retally.operators import changelog as C
from retally.operators.aggregate import Aggregate, by, summarise
from retally.sources import envelope as E, topics
from retally.streaming import pipeline
from retally.streaming.counted import Counted
from retally.streaming.restate import on_days, touched_days
from tests.test_streams import DAILY, OVER, TABLE, same, story

CHANNEL = Aggregate("channel", by("g"), (
    heads("users", "user"), heads("large_users", "user", "n > 10"), earliest("first", "update_time"),
    latest("largest", "n", type="DECIMAL(20,4)"), tally("many", "TRUE")), where="user <> 6")
REPORTS = (DAILY, OVER, CHANNEL)


def expected(spark):
    current = C.current_rows(story(spark), ["id"])
    daily = summarise(current, DAILY)
    return {"daily": daily, "over": summarise(daily, OVER), "channel": summarise(current, CHANNEL)}


def lines_by_step(spark, folder, files=4):
    """Changes dealt out by key and step: moves and deletes come in later files than their inserts."""
    number = F.least(F.pmod("pos", F.lit(3)) + F.pmod(F.hash("ts_ms"), F.lit(2)), F.lit(files - 1)).alias("file")
    changes = story(spark).withColumn("file", number)
    E.encode_changes(changes, TABLE, replace_updates=False, also=["file"]).repartition(files, "file").write.partitionBy("file").text(folder)


def start(spark, tmp_path, state, name="cp", **how):
    stream = C.signed_rows(E.decode_changes(topics.file_lines(spark, str(tmp_path / "lines"), files_per_batch=1).select("value"), TABLE))
    writer = state.stream(stream).writeStream.outputMode("update").foreachBatch(how.get("each", state.each_batch))
    return writer.option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()


def new_state(spark, tmp_path, **how):
    return Counted(spark, str(tmp_path / "state"), REPORTS, spark.createDataFrame([], TABLE.struct), compact_every=2, **how)


def test_counts_and_extremes_follow_moves_and_deletes(spark, tmp_path):
    lines_by_step(spark, str(tmp_path / "lines"))
    state = new_state(spark, tmp_path)
    query = start(spark, tmp_path, state)
    assert query.awaitTermination(200) and query.exception() is None and len(query.recentProgress) >= 4
    plan = query._jsq.explainInternal(False)
    assert "Python" not in plan and "InPandas" not in plan
    for name, want in expected(spark).items():
        same(want, state.current(name))
    # a group holds a number per count, not a row per value
    assert set(state.reports["channel"].counts.read().columns) == {"g", "users", "large_users", "batch"}


def test_a_failure_between_two_targets_repeats_only_the_second(spark, tmp_path):
    lines_by_step(spark, str(tmp_path / "lines"))
    written = []

    def target(batch, rows):
        written.append(batch)
        if batch == 2 and written.count(2) == 1:
            raise RuntimeError("lost")

    def first(batch, rows):
        written.append(("first", batch))

    state = new_state(spark, tmp_path, targets={"first": first, "second": target}, at_once=1)
    query = start(spark, tmp_path, state)
    with pytest.raises(Exception):
        query.awaitTermination(200)
    query = start(spark, tmp_path, new_state(spark, tmp_path, targets={"first": first, "second": target}, at_once=1))
    assert query.awaitTermination(200)
    assert [b for b in written if isinstance(b, tuple)] == [("first", b) for b in range(len(set(written)) // 2)]
    assert written.count(2) == 2 and written.count(1) == written.count(3) == 1
    for name, want in expected(spark).items():
        same(want, state.current(name))


def test_days_far_apart_are_ranges_of_their_own(spark):
    days = spark.sql("SELECT explode(array(date'2024-06-01', date'2024-06-02', date'2023-06-01', null)) AS statistic_time")
    ranges, without = touched_days(days)
    assert [(str(a), str(b)) for a, b in ranges] == [("2023-06-01", "2023-06-01"), ("2024-06-01", "2024-06-02")] and without
    assert days.where(on_days("statistic_time", (ranges, False))).count() == 3
    every = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-12-31', interval 5 days)) AS statistic_time")
    assert len(touched_days(every)[0]) == 16 and touched_days(every.where("false")) == ([], False)


def test_reports_that_cannot_be_counted_are_refused(spark, tmp_path):
    over = Aggregate("over_heads", by("g"), (heads("days", "statistic_time"),), source="daily")
    with pytest.raises(ValueError):
        Counted(spark, str(tmp_path), [DAILY, over], spark.createDataFrame([], TABLE.struct))


def test_touched_groups_are_finished_in_one_grouping(spark):
    from retally.functions.measures import ratio
    from retally.operators.aggregate import deltas, fold, restated, settle

    plain = Aggregate("plain", by("g", "statistic_time"), (
        total("n", "n"), total("large", "n", "n > 10"), tally("many", "TRUE"), ratio("share", "large", "n")))
    factored = Aggregate("factored", by("g", "statistic_time"), (total("even", "n", "kind = 0"), tally("odd", "kind = 1")), factors=("kind",))
    rows = C.signed_rows(story(spark)).withColumns({
        "statistic_time": F.col("update_time").cast("date"), "kind": F.col("user") % 2,
        "g": F.when(F.col("g") != "g3", F.format_string("g%d", F.col("id") % 30)), "n": F.when(F.col("id") % 7 != 0, F.col("n"))})
    old, new = rows.where("_order.pos % 3 = 0 AND id < 50"), rows.where("_order.pos % 3 > 0 OR id >= 50")
    for agg in (plain, factored):
        stored, fresh = deltas(old, agg), deltas(new, agg)
        changes = restated(stored, fresh, agg)
        before, after = settle(fold(stored, agg), agg), settle(fold(stored.unionByName(fresh), agg), agg)
        want = C.changes_between(before, after, agg.key_names)
        assert {r.op for r in want.select("op").collect()} == {"c", "u", "d"}
        text = lambda df: df.select(F.to_json("before").alias("b"), F.to_json("after").alias("a"), "op")
        same(text(want), text(changes))
        changes.collect()
        plan = changes._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "SortAggregate" not in plan


def test_state_of_the_registered_streams_is_not_a_map_in_the_heap(spark, tmp_path):
    from checks import streams

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    text = spark.range(40).selectExpr("CAST(id AS STRING) AS value", "CAST(id % 4 AS INT) AS file")
    seen = []
    try:
        spark.conf.unset(provider)
        spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
        streams.run_steps(text, f"{tmp_path}/lines", lambda lines: lines.groupBy("value").count(),
                          lambda rows, batch: seen.append(rows.count()), f"{tmp_path}/checkpoint")
    finally:
        spark.conf.set(provider, before)
    assert seen == [10] * 4 and list((tmp_path / "checkpoint").rglob("*.changelog"))
