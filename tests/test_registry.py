"""Every registered query against its plain SQL, row by row."""

import re

import pytest

import __spark_entry__ as entry
from checks.compare import database, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database("/root/testdata/sf0.001")


def test_each_query_has_its_sql():
    own = {n for n in QUERIES if not n.startswith("op") and n != "pipeline"}
    assert own == {n for n in SQL if not n.startswith("op")}


@pytest.mark.parametrize("name", [n for n in SQL if not n.startswith(("stream_", "op"))])
def test_equal_to_sql(spark, con, small, name):
    df = QUERIES[name](spark, small)
    assert difference(df, con, SQL[name]) is None


@pytest.mark.parametrize("name", ["stream_mirror", "stream_channel_distinct"])
def test_streams_read_a_table_of_one_or_many_files(spark, con, small, tmp_path, name):
    """One file gives one micro-batch; a folder of part files must give the same rows."""
    assert difference(QUERIES[name](spark, small), con, SQL[name]) is None
    for table in ("events", "orders", "customer"):
        spark.read.parquet(f"{small}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert difference(QUERIES[name](spark, str(tmp_path)), con, SQL[name]) is None


def test_comparison_sees_a_wrong_cell(spark, con, small):
    df = QUERIES["window_order_1h"](spark, small)
    wrong = df.withColumn("rows_in_window", df.rows_in_window + 1)
    assert difference(df, con, SQL["window_order_1h"]) is None
    assert "rows_in_window" in difference(wrong, con, SQL["window_order_1h"])
    assert "rows" in difference(df.limit(3), con, SQL["window_order_1h"])


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


# --- plans -----------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def full_plans(spark):
    settings = {"spark.sql.debug.maxToStringFields": "2000", "spark.sql.maxMetadataStringLength": "20000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", ["dws_channel_game", "dws_user_reward", "dws_withdraw_finance", "dim_device_lookup",
                                  "retract_channel_game", "latest_image", "dws_channel_game_levels"])
def test_no_cross_join_no_window_no_python(spark, small, full_plans, name):
    text = plan(QUERIES[name](spark, small))
    for bad in ("CartesianProduct", "NestedLoop", "Window [", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text


def test_text_is_parsed_once(spark, small, full_plans):
    assert plan(QUERIES["dwd_reward"](spark, small)).count("from_json(") == 1
    assert plan(QUERIES["ods_game"](spark, small)).count("from_json(") == 1


def test_scan_reads_only_what_is_used(spark, tmp_path, full_plans):
    """Filters and columns of a report reach the scan of a stored table."""
    from retally import schemas as S
    from retally.operators import cleanse as P
    from retally.operators.aggregate import summarise
    from retally.plans import reports as R

    folder = str(tmp_path / "withdraw_order")
    spark.createDataFrame([], S.WITHDRAW_ORDER.struct).write.parquet(folder)
    text = plan(summarise(P.clean_withdrawals(spark.read.parquet(folder)), R.CHANNEL_WITHDRAW_DAY))
    read = re.search(r"ReadSchema: struct<(.*?)>\n", text).group(1)
    columns = {c.split(":")[0] for c in re.sub(r"\([^)]*\)", "", read).split(",")}
    assert columns == {"user_id", "channel_id", "order_no", "order_status", "withdraw_funds_amount", "final_handling_fee",
                       "gift_amount", "decrease_handling_amount", "update_time"}
    assert "IsNotNull(order_no)" in text and "IsNotNull(update_time)" in text


def test_sums_do_not_carry_the_distinct_values(spark, small):
    """The sums of a report with distinct counts are combined at the size of its group key."""
    from retally.operators.aggregate import _partials
    from retally.plans import reports as R
    from retally.sources import derived as D
    from retally.operators import cleanse as P

    games = P.clean_games(D.rows(spark, small, "game_record"))
    part = _partials(games, R.CHANNEL_GAME_DAY, signed=False)
    groups = games.select("statistic_time", "channel_id").distinct().count()
    assert part.where("_slot = 0").count() == groups
    rewards = QUERIES["dwd_reward"](spark, small)
    part = _partials(rewards, R.CHANNEL_REWARD_DAY, signed=False)
    assert len([c for c in part.columns if c.startswith("p_")]) == 1      # one summed column behind 71 measures
