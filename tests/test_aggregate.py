"""Measure forms and the agreement of the three executions."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retally.functions.measures import (
    earliest, filled, fixed, heads, heads_of, latest, ratio, tally, total)
from retally.operators.aggregate import (
    SIGN, Aggregate, by, deltas, settle, summarise, summarise_signed)

SCHEMA = "id BIGINT, g STRING, user BIGINT, kind STRING, flag INT, amount DECIMAL(20,4), at TIMESTAMP_NTZ"
ALL = Aggregate("all", by("g"), (
    filled("rows_with_user", "user"), total("amount", "amount"), total("good", "amount", "flag = 1"),
    tally("n_good", "flag = 1", "INT"), heads("users", "user"), heads("good_users", "user", "flag = 1"),
    heads_of("pairs", ["kind", "user"]), earliest("first_at", "at"), latest("last_at", "at"),
    fixed("one", "1", "INT"), ratio("rate", "good", "amount")))
FACTORED = Aggregate("factored", by("g"), (
    total("amount", "amount"), total("good", "amount", "flag = 1"), tally("n_good", "flag = 1"),
    heads("users", "user"), heads("good_users", "user", "flag = 1")), factors=("flag", "kind"))
SUMS = Aggregate("sums", by("g"), (total("amount", "amount"), total("good", "amount", "flag = 1"),
                                   tally("n_good", "flag = 1")), factors=("flag",))


def rows(seed, n=200):
    r = random.Random(seed)
    pick = lambda *xs: r.choice(xs)
    return [(i, pick("a", "b", None), pick(1, 2, 3, None), pick("x", "y", None), pick(0, 1, None),
             pick(None, Decimal(r.randrange(-999, 999)) / 4), dt.datetime(2024, 1, r.randrange(1, 28), r.randrange(24)))
            for i in range(n)]


def expected(data):
    """The aggregates by hand."""
    out = {}
    for g in {d[1] for d in data}:
        rs = [d for d in data if d[1] == g]
        amounts = [d[5] for d in rs if d[5] is not None]
        good = [Decimal(0) if d[4] != 1 else d[5] for d in rs]
        good = [x for x in good if x is not None]
        out[g] = dict(
            rows_with_user=sum(d[2] is not None for d in rs), amount=sum(amounts) if amounts else None,
            good=sum(good) if good else None, n_good=sum(d[4] == 1 for d in rs),
            users=len({d[2] for d in rs if d[2] is not None}),
            good_users=len({d[2] for d in rs if d[2] is not None and d[4] == 1}),
            pairs=len({(d[3], d[2]) for d in rs if d[2] is not None and d[3] is not None}),
            first_at=min(d[6] for d in rs), last_at=max(d[6] for d in rs), one=1)
    return out


def check(df, data, agg):
    got = {r["g"]: r.asDict() for r in df.collect()}
    want = expected(data)
    assert set(got) == set(want)
    for g, row in want.items():
        for m in agg.measures:
            if m.kind != "ratio":
                assert got[g][m.name] == row[m.name], (g, m.name)


@pytest.mark.parametrize("agg", [ALL, FACTORED, SUMS], ids=lambda a: a.name)
def test_batch(spark, agg):
    data = rows(1)
    check(summarise(spark.createDataFrame(data, SCHEMA), agg), data, agg)


@pytest.mark.parametrize("agg", [ALL, FACTORED, SUMS], ids=lambda a: a.name)
def test_signed_rows_cancel(spark, agg):
    """Rows added and removed again, in any order, leave the aggregate of what is left."""
    data = rows(2)
    kept, gone = data[:120], data[120:]
    stream = [(*d, 1) for d in data] + [(*d, -1) for d in gone]
    random.Random(3).shuffle(stream)
    signed = spark.createDataFrame(stream, SCHEMA + f", {SIGN} INT")
    check(summarise_signed(signed, agg), kept, agg)
    pieces = [signed.where(F.col("id") % 3 == i) for i in range(3)]
    parts = deltas(pieces[0], agg).unionByName(deltas(pieces[1], agg)).unionByName(deltas(pieces[2], agg))
    check(settle(parts, agg), kept, agg)


def test_group_without_rows_is_gone(spark):
    row = (1, "a", 1, "x", 1, Decimal("2.5"), dt.datetime(2024, 1, 1))
    signed = spark.createDataFrame([(*row, 1), (*row, -1)], SCHEMA + f", {SIGN} INT")
    for agg in (ALL, FACTORED, SUMS):
        assert summarise_signed(signed, agg).count() == 0


def test_null_sums_and_guarded_ratio(spark):
    agg = Aggregate("r", by("g"), (total("top", "amount"), total("bottom", "amount", "flag = 1"), ratio("rate", "top", "bottom")))
    at = dt.datetime(2024, 1, 1)
    data = [(1, "zero", 1, "x", 0, Decimal(3), at), (2, "null", 1, "x", 1, None, at),
            (3, "third", 1, "x", 1, Decimal(3), at), (4, "third", 1, "x", 0, Decimal(-4), at)]
    for df in (summarise(spark.createDataFrame(data, SCHEMA), agg),
               summarise_signed(spark.createDataFrame([(*d, 1) for d in data], SCHEMA + f", {SIGN} INT"), agg)):
        got = {r["g"]: r for r in df.collect()}
        assert got["zero"]["rate"] == 0                       # nothing settled
        assert got["null"]["top"] is None and got["null"]["rate"] is None
        assert got["third"]["rate"] == Decimal("0.3333")      # -(-1)/3, rounded by its type
        assert got["zero"]["bottom"] == 0                     # condition never true: zero, not null


def test_numbers_of_the_declared_tables():
    from retally.plans import reports as R

    assert len(R.ALL) == 22
    sizes = {"today_user_game_statistics_dws": 26, "today_user_hour_game_ug_statistics_data": 27,
             "today_channel_game_category_statistic": 24, "today_channel_game_provider_statistic": 24,
             "today_channel_game_record_statistic": 23, "today_user_custom_amount_statistics_data": 15,
             "today_channel_custom_amount_statistic": 13, "today_user_recharge_statistic_dws": 22,
             "today_channel_recharge_statistic": 14, "today_user_reward_statistics_dws": 71,
             "today_channel_reward_statistic": 73, "today_channel_activity_statistic": 21,
             "today_channel_proxy_statistic": 17, "today_user_withdraw_statistic_dws": 18,
             "today_channel_withdraw_statistic": 10, "today_user_withdraw_statistic_finance_increment": 14,
             "today_user_game_statistic": 26, "user_game_statistic": 25, "today_user_reward_statistic": 15,
             "user_reward_statistic": 14, "today_user_bounty_statistic": 38, "user_bounty_statistic": 37}
    assert {n: len(a.columns) for n, a in R.ALL.items()} == sizes
    assert all(len(set(a.columns)) == len(a.columns) for a in R.ALL.values())
