import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from retally.operators import joins
from retally.operators.aggregate import SIGN, summarise, summarise_signed
from retally.plans import reports as R

ORDER = ("statistic_time DATE, user_id BIGINT, channel_id BIGINT, apply_bank_id BIGINT, withdrawal_mode_id BIGINT,"
         " order_no BIGINT, order_status STRING, withdraw_funds_amount DECIMAL(20,4), update_time TIMESTAMP_NTZ")
PAY = ("withdraw_order_no BIGINT, payment_order_no STRING, amount STRING, withdrawal_channel_id BIGINT,"
       " pay_provider_id BIGINT, order_status STRING, update_time TIMESTAMP_NTZ")
DAY, AT, NEXT = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 2, 9)


def orders(*rows):
    return [(DAY, 1, 2, 3, 4, no, status, Decimal(amount), AT) for no, status, amount in rows]


ORDERS = orders((10, "COMPLETED", 100), (11, "REJECTED", 50), (12, "COMPLETED", 7))
PAYMENTS = [(10, "p1", "60.5", None, 5, "WITHDRAW_FAIL", AT), (10, "p2", "39.5", None, 5, "COMPLETED", AT),
            (10, "p3", "1", None, 5, "PENDING", AT), (11, "p4", "abc", 8, None, "COMPLETED", AT),
            (12, "p5", "7", None, 5, "COMPLETED", NEXT), (99, "p6", "1", None, 5, "COMPLETED", AT)]


def test_orders_with_several_no_and_strange_payments(spark):
    joined = joins.orders_with_payments(spark.createDataFrame(ORDERS, ORDER), spark.createDataFrame(PAYMENTS, PAY))
    got = {(r.pay_channel_id, r.pay_provider_id): r for r in summarise(joined, R.WITHDRAW_FINANCE_DAY).collect()}
    assert set(got) == {(0, 5), (8, 0)}            # order 12 was paid on another day, 99 has no order
    one = got[(0, 5)]
    assert one.withdraw_amount == Decimal(100) and one.success_withdraw_amount == Decimal(200)   # once per try
    assert (one.user_count, one.withdraw_order_count, one.withdraw_success_order_count) == (1, 2, 2)
    assert got[(8, 0)].withdraw_amount is None and got[(8, 0)].success_withdraw_amount == 0
    assert one.create_time == one.update_time == AT


def test_join_of_changes_is_the_change_of_the_join(spark):
    more = orders((13, "COMPLETED", 9))
    o = spark.createDataFrame([(*r, 1) for r in ORDERS + more] + [(*r, -1) for r in more], ORDER + f", {SIGN} INT")
    extra = (11, "p7", "3", None, 5, "COMPLETED", AT)
    p = spark.createDataFrame([(*r, 1) for r in PAYMENTS + [extra]] + [(*extra, -1)], PAY + f", {SIGN} INT")
    got = summarise_signed(joins.orders_with_payments(o, p), R.WITHDRAW_FINANCE_DAY)
    want = summarise(joins.orders_with_payments(spark.createDataFrame(ORDERS, ORDER), spark.createDataFrame(PAYMENTS, PAY)),
                     R.WITHDRAW_FINANCE_DAY)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_join_is_a_plain_inner_equi_join(spark):
    plan = joins.orders_with_payments(spark.createDataFrame(ORDERS, ORDER), spark.createDataFrame(PAYMENTS, PAY))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in text and "Cartesian" not in plan._jdf.queryExecution().executedPlan().toString()


def test_device_lookup(spark):
    devices = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "z")], "user_id BIGINT, device_id STRING")
    asks = spark.createDataFrame([(i, u) for i, u in enumerate([1, 2, 3, None, None, 1])], "i INT, user_id BIGINT")
    got = {r.i: r.dimensionInfo for r in joins.lookup_device(asks, devices).collect()}
    assert got == {0: "device_id: a", 1: "device_id: null", 2: "no_device", 3: "unknown", 4: "unknown", 5: "device_id: a"}


def test_device_lookup_as_shuffle_join_keeps_every_row(spark):
    """Without a broadcast, one user and the missing users each holding a third of the rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asks = spark.range(3000).select("id", F.expr("CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE id END").alias("user_id"))
        devices = spark.range(1, 3000, 2).select(F.col("id").alias("user_id"), F.concat(F.lit("d"), "id").alias("device_id"))
        got = dict(joins.lookup_device(asks, devices).groupBy(F.substring_index("dimensionInfo", ":", 1)).count().collect())
        assert got == {"device_id": 1500, "unknown": 1000, "no_device": 500}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
