"""Row-level flows: project, filter, derive the day and hour, flatten payloads.

Every flow is DataFrame -> DataFrame and looks at one row at a time, so it runs
unchanged on current rows, on signed rows and on a stream.  Columns that carry
the change (``row_kind``, ``_sign``, ``_order``) ride along when present; a
predicate is therefore tested on each image of a change by itself, and an
update that starts or stops to satisfy it becomes an insert or a delete.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from retally import schemas as S
from retally.functions import scalars as X
from retally.operators.changelog import ORDER

CHANGE_COLUMNS = ("row_kind", "_sign", "_order")

# fixed values: the words the business tables use
REWARD_SCOPES = {
    "VIP_REWARD": "vip",
    "REBATE_REWARD": "rebate",
    "ACTIVITY_REWARD": "activity",
    "BONUS_TASK": "bonus_task",
    "TOURIST_TRIAL_BONUS": "tourist",
}
AMOUNT_OPERATION_FEED = ["id", "user_id", "type", "amount_type", "amount", "balance", "status",
                         "create_by", "update_by", "create_time", "update_time", "channel_id"]


def _keep(df: DataFrame, columns: Iterable[str | Column]) -> DataFrame:
    return df.select(*columns, *[c for c in CHANGE_COLUMNS if c in df.columns])


def without_deletes(df: DataFrame) -> DataFrame:
    """Drop delete rows; both halves of an update stay."""
    return df.where(F.col("row_kind") != "-D")


# --- raw layer ---------------------------------------------------------------

def feed(df: DataFrame, columns: list[str], drop_deletes: bool) -> DataFrame:
    """Project a captured table, with or without its deletes."""
    return _keep(without_deletes(df) if drop_deletes else df, columns)


def game_feed(df: DataFrame) -> DataFrame:
    return feed(df, S.GAME_RECORD.names, drop_deletes=True)


def recharge_feed(df: DataFrame, drop_deletes: bool = False) -> DataFrame:
    """Deletes pass by default: the original filter compares with a kind that never occurs."""
    return feed(df, S.RECHARGE_ORDER.names, drop_deletes)


def withdraw_feed(df: DataFrame) -> DataFrame:
    return feed(df, S.WITHDRAW_ORDER.names, drop_deletes=True)


def payment_feed(df: DataFrame) -> DataFrame:
    return feed(df, S.PAYMENT_ORDER.names, drop_deletes=True)


def amount_operation_feed(df: DataFrame, drop_deletes: bool = False) -> DataFrame:
    """31 columns narrowed to the 12 used later; deletes pass, see ``recharge_feed``."""
    return feed(df, AMOUNT_OPERATION_FEED, drop_deletes)


def proxy_feed(df: DataFrame) -> DataFrame:
    return feed(df, S.USER_PROXY_STATISTIC.names, drop_deletes=False)


def device_feed(df: DataFrame) -> DataFrame:
    """Feeds the device dimension."""
    return feed(df, S.DEVICE_USERS.names, drop_deletes=True)


# --- cleansed layer ----------------------------------------------------------


def _dated(df: DataFrame, columns: list[str], condition: str) -> DataFrame:
    return _keep(df.where(condition), [X.day_of("update_time").alias("statistic_time"), *columns])


_SPLITS = ["deposit", "withdrawal", "bonus"]


GAME_COLUMNS = [
    "user_id", "channel_id", "game_id", "game_category_id", "third_platform_provider_type", "id", "order_no",
    "bet_amount", "settle_amount", "transfer_amount", *[f"bet_{s}_amount" for s in _SPLITS],
    "effective_bet_flag", *[f"settle_{s}_amount" for s in _SPLITS], *[f"transfer_{s}_amount" for s in _SPLITS],
    "valid_bet_amount", *[f"valid_bet_{s}_amount" for s in _SPLITS], "status", "update_time"]


def clean_games(df: DataFrame) -> DataFrame:
    """Settled games; parse change text with ``GAME_RECORD.only(GAME_COLUMNS)``."""
    return _dated(
        df, [X.hour_of("update_time").alias("statistic_hour"), *GAME_COLUMNS],
        "status = 'settle' AND order_no IS NOT NULL AND update_time IS NOT NULL")


def clean_recharges(df: DataFrame) -> DataFrame:
    dims = ["user_id", "channel_id", "pay_category_id", "pay_method_id", "pay_channel_id", "pay_provider_id"]
    late = ["first_recharge", "pay_status", "order_status", "recharge_success_time", "create_time", "update_time"]
    facts = [c for c in S.RECHARGE_ORDER.names if c not in dims + late + ["update_by"]]
    return _dated(df, dims + facts + late, "order_no IS NOT NULL AND update_time IS NOT NULL")


WITHDRAWAL_COLUMNS = [
    "user_id", "channel_id", "apply_bank_id", "withdrawal_mode_id", "withdrawal_channel_id",
    "pay_provider_id", "id", "order_no", "withdraw_funds_amount", "final_handling_fee", "gift_amount",
    "decrease_handling_amount", "first_withdrawal_flag", "order_status", "create_time", "update_time"]


def clean_withdrawals(df: DataFrame) -> DataFrame:
    """16 of the 58 columns; parse change text with ``WITHDRAW_ORDER.only(WITHDRAWAL_COLUMNS)``."""
    return _dated(df, WITHDRAWAL_COLUMNS, "order_no IS NOT NULL AND update_time IS NOT NULL")


def clean_amount_operations(df: DataFrame) -> DataFrame:
    return _dated(df, ["user_id", "channel_id", "id", "type", "amount_type", "amount", "balance", "status",
                       "create_time", "update_time"], "status = 'COMPLETE' AND update_time IS NOT NULL")


def clean_proxies(df: DataFrame) -> DataFrame:
    """Keeps the day the source computed."""
    lead = ["statistic_time", "user_id", "channel_id", "id"]
    rest = [c for c in S.USER_PROXY_STATISTIC.names if c not in lead]
    return _keep(df.where("update_time IS NOT NULL"), lead + rest)


def clean_rewards(events: DataFrame) -> DataFrame:
    """Flatten the reward payload, keep the five scopes, turn the draw flag into 0/1."""
    data = events.select("jsonData.*", *[c for c in CHANGE_COLUMNS if c in events.columns])
    known = data.where(F.col("update_time").isNotNull() & F.col("reward_scope").isin(*REWARD_SCOPES))
    return _keep(known, [
        X.day_of("update_time").alias("statistic_time"), "user_id", "channel_id", "unique_id", "reward_scope",
        "reward_type", "activity_type", "id", "bonus_amount", X.flag_to_int("draw_flag").alias("draw_flag"),
        "not_receive_time", "receive_time", "time_out_time", "create_time", "update_time"])


def clean_online_status(*topics: DataFrame) -> DataFrame:
    """Online events of any number of topics as rows keyed by (user_id, create_time); a record's place stays beside them."""
    events = topics[0]
    for more in topics[1:]:
        events = events.unionByName(more)
    data = F.col("jsonData")
    return events.select(
        F.coalesce(data["session_id"], F.lit("N/A")).alias("session_id"), data["user_id"].alias("user_id"),
        data["token"].alias("token"), X.iso_timestamp(data["online_time"]).alias("online_time"),
        data["ip"].alias("ip"), data["device_id"].alias("device_id"),
        X.iso_timestamp(data["create_time"]).alias("create_time"), *[c for c in ORDER if c in events.columns])


# --- detail copies -----------------------------------------------------------

def game_detail(df: DataFrame) -> DataFrame:
    """Every game record with an order number, amounts widened, the opaque list left out."""
    def column(name: str, type: str) -> Column:
        return F.col(name).cast("decimal(20,4)").alias(name) if type == "DECIMAL(19,2)" else F.col(name)

    columns = [column(n, t) for n, t in S.GAME_RECORD.columns if n != "game_record_expand_list"]
    return _keep(df.where("order_no IS NOT NULL"), columns)


def reward_detail(df: DataFrame) -> DataFrame:
    return _keep(df.where("id IS NOT NULL"), S.REWARD_EVENT.names)


def guarded(df: DataFrame, enabled: bool) -> DataFrame:
    """A flow that is declared but switched off: same schema, no rows, no scan."""
    return df if enabled else df.where(F.lit(False))


# --- dimension mirrors -------------------------------------------------------

def masked(df: DataFrame, exclude: Iterable[str] = (), hashed: Iterable[str] = ()) -> DataFrame:
    """Leave secrets out of a mirror, or keep only their digest."""
    out = df.drop(*[c for c in exclude if c in df.columns])
    return out.withColumns({c: F.sha2(F.col(c), 256) for c in hashed if c in out.columns}) if hashed else out
