"""The two joins: orders with their payment tries, and the device lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retally.functions import scalars as X
from retally.operators.aggregate import SIGN

PAYMENT_DONE = ("COMPLETED", "WITHDRAW_FAIL")
PAYMENT_COLUMNS = ["id", "withdraw_order_no", "payment_order_no", "amount", "withdrawal_channel_id",
                   "pay_provider_id", "order_status", "update_time"]
NULL_SPREAD = 64


def finished_payments(payments: DataFrame) -> DataFrame:
    """The payment columns the join needs, only tries that came to an end."""
    keep = payments.where(F.col("order_status").isin(*PAYMENT_DONE))
    return keep.select(
        F.col("withdraw_order_no"), X.day_of("update_time").alias("payment_day"),
        X.text_amount("amount").alias("payment_amount"), "payment_order_no",
        F.col("withdrawal_channel_id").alias("payment_channel_id"),
        F.col("pay_provider_id").alias("payment_provider_id"),
        *([F.col(SIGN).alias("_payment_sign")] if SIGN in payments.columns else []))


def orders_with_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Withdrawals joined with their finished payment tries of the same day.

    The source writes a left join and then asks for a payment status, which
    leaves the inner equi-join on (order, day); written as such here, so the
    status filter and the narrow projection run before the shuffle.  One order
    may have very many tries: both sides meet in a plain equi-join whose skewed
    partitions adaptive execution splits (``retally.session`` switches it on).

    Signed inputs give signed output (the product of the signs), so the join of
    two change streams is the change stream of the join.
    """
    lean = ["statistic_time", "user_id", "channel_id", "apply_bank_id", "withdrawal_mode_id",
            "order_no", "order_status", "withdraw_funds_amount", "update_time"]
    signed = SIGN in orders.columns
    left = orders.select(*lean, *([SIGN] if signed else []))
    right = finished_payments(payments)
    joined = left.join(right, (F.col("withdraw_order_no") == F.col("order_no"))
                       & (F.col("payment_day") == F.col("statistic_time")))
    if not signed:
        return joined
    return joined.withColumn(SIGN, F.col(SIGN) * F.col("_payment_sign")).drop("_payment_sign")


def device_by_user(devices: DataFrame) -> DataFrame:
    """The device dimension with one row per user: the smallest device id."""
    return devices.where("user_id IS NOT NULL").groupBy("user_id").agg(F.min("device_id").alias("device_id"),
                                                                      F.lit(True).alias("found"))


def lookup_device(rows: DataFrame, devices: DataFrame, user: str = "user_id") -> DataFrame:
    """``dimensionInfo`` for the user of each row; all columns of the row stay.

    No user gives ``unknown``, a user without a device ``no_device``.  Rows
    without a user can never match, so they are spread over many join keys
    instead of meeting in the partition of the null key.  Whether the dimension
    is broadcast is left to its measured size.
    """
    dim = device_by_user(devices).select(F.col("user_id").alias("_user"), "device_id", "found",
                                         F.lit(0).alias("_spread"))
    spread = F.when(F.col(user).isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(NULL_SPREAD)).cast("int")).otherwise(0)
    left = rows.withColumn("_side", spread)
    joined = left.join(dim, (F.col(user) == F.col("_user")) & (F.col("_side") == F.col("_spread")), "left")
    info = (F.when(F.col(user).isNull(), F.lit("unknown"))
            .when(F.col("found"), F.concat(F.lit("device_id: "), F.coalesce(F.col("device_id"), F.lit("null"))))
            .otherwise(F.lit("no_device")))
    return joined.select(*[F.col(c) for c in rows.columns], info.alias("dimensionInfo"))
