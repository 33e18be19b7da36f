"""Change streams: signed rows, latest images, filters over changes, envelopes."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retally import schemas as S
from retally.functions import scalars as X
from retally.operators import changelog as C
from retally.operators import cleanse as P
from retally.operators import conform
from retally.operators.aggregate import summarise, summarise_signed
from retally.plans import dimensions, reports as R
from retally.sources import envelope as E

T = S.Table("t", ("id",), "id BIGINT, g STRING, n DECIMAL(20,4), status STRING, update_time TIMESTAMP_NTZ")


def image(id, g="a", n="1", status="settle", day=1):
    return {"id": id, "g": g, "n": n, "status": status, "update_time": f"2024-01-0{day}T10:00:00"}


def line(op, before, after, pos, ts=None):
    return json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts or pos, "source": {"table": "t", "pos": pos}})


def decoded(spark, lines, **how):
    return E.decode_changes(spark.createDataFrame([(x,) for x in lines], "value STRING"), T, **how)


def test_kinds_of_images(spark):
    lines = [line("r", None, image(1), 1), line("c", None, image(2), 2), line("u", image(2), image(2, n="5"), 3),
             line("d", image(1), None, 4)]
    got = sorted((r.row_kind, r._sign, r.id) for r in C.signed_rows(decoded(spark, lines)).collect())
    assert got == [("+I", 1, 1), ("+I", 1, 2), ("+U", 1, 2), ("-D", -1, 1), ("-U", -1, 2)]


def test_moves_filters_and_deletes(spark):
    """A row that changes day, group or status leaves one group and enters the other."""
    from retally.functions.measures import tally, total
    from retally.operators.aggregate import Aggregate, by

    agg = Aggregate("x", by("g", day="CAST(update_time AS DATE)"), (total("n", "n"), tally("rows", "TRUE")),
                    where="status = 'settle'")
    lines = [
        line("c", None, image(1, status="bet"), 1), line("u", image(1, status="bet"), image(1), 2),      # enters
        line("c", None, image(2, n="2"), 3), line("u", image(2, n="2"), image(2, n="2", day=2), 4),     # other day
        line("c", None, image(3, n="4"), 5), line("u", image(3, n="4"), image(3, g="b", n="4"), 6),     # other group
        line("c", None, image(4, n="8"), 7), line("u", image(4, n="8"), image(4, n="8", status="bet"), 8),  # leaves
        line("c", None, image(5, g="z"), 9), line("d", image(5, g="z"), None, 10),                      # group ends
        line("d", image(99, g="q"), None, 11)]                                                          # never seen
    for order in (lines, lines[::-1]):
        got = {(r.g, r.day.day): (r.n, r.rows) for r in summarise_signed(C.signed_rows(decoded(spark, order)), agg).collect()}
        assert got == {("a", 1): (Decimal(1), 1), ("a", 2): (Decimal(2), 1), ("b", 1): (Decimal(4), 1)}


def test_latest_image_goes_by_position_not_arrival(spark):
    lines = [line("u", image(1), image(1, n="3"), 3), line("c", None, image(1), 1), line("u", image(1), image(1, n="2"), 2),
             line("c", None, image(2), 4, ts=7), line("d", image(2), None, 5, ts=7)]
    got = C.current_rows(decoded(spark, lines), ["id"]).collect()
    assert [(r.id, r.n) for r in got] == [(1, Decimal(3))]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_pairs_of_an_update_keep_their_order_however_they_are_dealt(spark, parts):
    changes = decoded(spark, [line("u", image(i), image(i, n=str(i)), i) for i in range(20)])
    text = E.encode_changes(changes, T).repartition(parts)
    back = E.decode_changes(text, T)
    assert {(r.id, int(r.n)) for r in C.current_rows(back, ["id"]).collect()} == {(i, i) for i in range(20)}
    assert C.once(back.unionAll(back)).count() == 40


def test_duplicates_are_told_by_position(spark):
    lines = [line("c", None, image(1), 1)] * 3
    assert C.signed_rows(C.once(decoded(spark, lines))).count() == 1


def test_replaced_updates_read_back_equal(spark):
    changes = decoded(spark, [line("c", None, image(1), 1), line("u", image(1), image(1, n="5"), 2)])
    text = E.encode_changes(changes, T)
    back = E.decode_changes(text, T)
    assert sorted(r.op for r in back.collect()) == ["c", "c", "d"]
    key = lambda df: sorted((r.id, r.n, r._sign) for r in C.signed_rows(df).collect())
    assert key(back) == key(changes)
    assert C.net_rows(C.signed_rows(back).drop("_order")).count() == 1


def test_snapshot_comes_before_changes(spark):
    rows = spark.createDataFrame([(1, "a", Decimal(1), "s", dt.datetime(2024, 1, 1))], T.struct)
    changes = decoded(spark, [line("u", image(1), image(1, n="7"), 0), line("c", None, image(2), 1)])
    both = dimensions.snapshot_then_changes(rows, changes)
    assert sorted((r.id, r.n) for r in C.current_rows(both, ["id"]).collect()) == [(1, Decimal(7)), (2, Decimal(1))]


def test_changes_between_states(spark):
    s = "k STRING, n INT"
    a = spark.createDataFrame([("x", 1), (None, 2), ("same", 3), ("gone", None)], s)
    b = spark.createDataFrame([("x", 5), (None, None), ("same", 3), ("new", 4)], s)
    got = sorted((r.op, (r.after or r.before).k or "") for r in C.changes_between(a, b, ["k"]).collect())
    assert got == [("c", "new"), ("d", "gone"), ("u", ""), ("u", "x")]


# --- envelopes -------------------------------------------------------------------

def test_broken_lines_and_wrong_types(spark):
    bad = image(2)
    bad["n"] = {"not": "a number"}
    lines = ["{broken", "", json.dumps({"op": "x"}), line("c", None, image(1), 1), line("c", None, bad, 2)]
    assert decoded(spark, lines).count() == 2
    good, broken = E.split_corrupt(decoded(spark, lines, keep_corrupt=True))
    assert {r._corrupt for r in broken.collect()} == {"{broken", "", '{"op": "x"}'}
    assert {r.after.id: r.after.n for r in good.collect()} == {1: Decimal(1), 2: None}


def test_events_and_missing_payload(spark):
    text = ['{"key":"1","dataSyncType":"insert","jsonData":{"user_id":7,"create_time":"2025-12-31T15:12:09","online_time":"zz"}}',
            '{"key":"2"}', "nope"]
    df = E.decode_events(spark.createDataFrame([(t,) for t in text], "value STRING"), S.ONLINE_EVENT)
    row, = P.clean_online_status(df, df.limit(0)).collect()
    assert (row.session_id, row.user_id, row.online_time) == ("N/A", 7, None)
    assert row.create_time == dt.datetime(2025, 12, 31, 15, 12, 9)


def test_reward_flags(spark):
    def event(i, flag, scope="VIP_REWARD", at='"2024-01-01T23:59:59.999"'):
        return f'{{"key":"{i}","jsonData":{{"id":{i},"draw_flag":{flag},"reward_scope":"{scope}","update_time":{at}}}}}'
    text = [event(1, "true"), event(2, "false"), event(3, "null"), event(4, "true", "OTHER"), event(5, "true", at="null")]
    df = P.clean_rewards(E.decode_events(spark.createDataFrame([(t,) for t in text], "value STRING"), S.REWARD_EVENT))
    assert {r.id: r.draw_flag for r in df.collect()} == {1: 1, 2: 0, 3: 0}


def test_several_tables_in_one_stream(spark):
    other = json.dumps({"op": "c", "after": {"id": 9}, "source": {"table": "o", "pos": 1}})
    lines = spark.createDataFrame([(line("c", None, image(1), 1),), (other,)], "value STRING")
    assert E.decode_changes(E.of_table(lines, "t"), T).count() == 1
    assert E.of_table(lines, "o").count() == 1


def test_tables_taken_apart_in_one_parse(spark):
    other = S.Table("o", ("id",), "id BIGINT, x STRING")
    of = lambda **how: json.dumps({"ts_ms": 1, **how})
    lines = [line("c", None, image(1), 1), line("u", image(1), image(1, n="5"), 2), line("d", image(1), None, 3),
             of(op="c", after={"id": 1, "x": "y", "g": "not its own"}, source={"table": "o", "pos": 4}),
             of(op="u", before={"id": 1}, after={"id": 2}, source={"table": "o", "pos": 5}),
             of(op="c", after={"id": 3}, source={"table": "further", "pos": 6}), of(op="c", after={"id": 4}),
             of(op="?", after={"id": 5}, source={"table": "o", "pos": 7}), "{cut sh"]
    text = spark.createDataFrame([(x,) for x in lines], "value STRING")
    both = E.decode_tables(text, [T, other])
    # the images of each table are those that a decode of its own lines gives
    for table in (T, other):
        own = C.signed_rows(E.decode_changes(E.of_table(text, table.name), table))
        mixed = C.signed_rows(both).where(F.col(E.TABLE) == table.name).select(*own.columns)
        assert sorted(map(str, mixed.collect())) == sorted(map(str, own.collect()))
    assert C.signed_rows(both).count() == 7 and C.signed_rows(both).where("_table = 'o' AND g IS NOT NULL").count() == 0
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object" not in plan
    with pytest.raises(ValueError):
        E.decode_tables(text, [T, S.Table("o", (), "id STRING")])


def test_lines_of_several_tables_are_made_once(spark, small):
    from checks import queries

    plan = queries.build()["changelog_split"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 2 and plan.count("from_json") == 1


# --- scalars, conform ------------------------------------------------------------

@pytest.mark.parametrize("zone", ["UTC", "Asia/Singapore"])
def test_day_does_not_move_with_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1,)], "i INT").select(F.expr(
            "explode(array(TIMESTAMP_NTZ'2024-01-01 23:59:59.999', TIMESTAMP_NTZ'2024-01-02 00:00:00'))").alias("t"))
        got = [(str(r.d), r.h) for r in df.select(X.day_of("t").alias("d"), X.hour_of("t").alias("h")).collect()]
        assert got == [("2024-01-01", 23), ("2024-01-02", 0)]
        ms = spark.createDataFrame([(1_704_067_200_123,)], "ms BIGINT")
        at = ms.select(X.local_timestamp("ms", "Asia/Bangkok").cast("string").alias("t")).first().t
        assert at == "2024-01-01 07:00:00.123"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_text_and_glue(spark):
    df = spark.createDataFrame([("1.25", "a", 1), ("abc", None, 2), (None, "b", 3)], "t STRING, a STRING, b INT")
    got = df.select(X.text_amount("t").alias("n"), X.piped("a", "b").alias("p")).collect()
    assert [r.n for r in got] == [Decimal("1.2500"), None, None]
    assert [r.p for r in got] == ["a|1", None, "b|3"]


def test_conform_is_by_name_and_strict(spark):
    df = spark.createDataFrame([(1.5, 300)], "b DOUBLE, a INT")
    from pyspark.sql import types as ST

    target = ST.StructType.fromDDL("a BIGINT, b DECIMAL(20,4)")
    row, = conform.conform(df, target).collect()
    assert (row.a, row.b) == (300, Decimal("1.5000"))
    with pytest.raises(ValueError):
        conform.conform(df, ST.StructType.fromDDL("c INT"))
    with pytest.raises(Exception):
        conform.conform(df, ST.StructType.fromDDL("a TINYINT")).collect()      # 300 does not fit


def test_null_keys_drop_or_fail(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1, None), (2, 3), (None, 4)], "a INT, b INT")
    seen = Observation("nulls")
    assert conform.enforce_not_null(df, ["a", "b"], seen=seen).count() == 1
    assert seen.get["dropped"] == 2
    with pytest.raises(Exception, match="not-null"):
        conform.enforce_not_null(df, ["a"], "fail").collect()
    assert conform.enforce_not_null(df.where("a = 2"), ["a"], "fail").count() == 1


def test_secrets_stay_out_of_a_mirror(spark):
    from retally.sources import derived as D

    changes = D.story_changes(spark, "/root/testdata/sf0.001", "dim_user")
    plain = dimensions.mirror(changes, S.USER)
    assert "password" not in plain.columns
    hashed = dimensions.mirror(changes, S.USER, hashed=["user_phone"])
    assert len(hashed.first().user_phone) == 64


def test_raw_feeds_and_their_deletes(spark):
    from retally.sources import derived as D

    for story, flow, deletes in (("recharge_order", P.recharge_feed, True), ("proxy_statistic", P.proxy_feed, True),
                                 ("withdraw_order", P.withdraw_feed, False), ("device_users", P.device_feed, False)):
        kinds = {r.row_kind for r in flow(C.signed_rows(D.story_changes(spark, "/root/testdata/sf0.001", story)))
                 .select("row_kind").distinct().collect()}
        assert ("-D" in kinds) is deletes and {"-U", "+U"} <= kinds
    strict = P.recharge_feed(C.signed_rows(D.story_changes(spark, "/root/testdata/sf0.001", "recharge_order")), drop_deletes=True)
    assert strict.where("row_kind = '-D'").count() == 0


def test_guarded_flow_is_empty_and_typed(spark):
    from retally.plans import batch

    events = spark.createDataFrame([], E.event_schema(S.BOUNTY_EVENT))
    off = batch.bounty(events, daily=True)
    assert off.columns == R.BOUNTY_DAY.columns and off.count() == 0
    assert dict(off.dtypes)["bounty_total_bet_count"] == "int"
    assert dict(off.dtypes)["bounty_total_settle_count"] == "decimal(20,4)"
    plan = off._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan


def test_groups_of_a_larger_table_go_to_more_tasks(spark, small, monkeypatch):
    from checks import queries
    from retally.sources import derived

    monkeypatch.setattr(derived, "TASK_BYTES", 2048)
    tasks = derived.story_tasks(spark, small, "game_record")
    plan = queries.build()["retract_user_game_day"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) and plan.count(", {}), REPARTITION_BY_NUM".format(tasks)) == 2
    assert plan.count("Exchange ") == 2
