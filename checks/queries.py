"""Registered queries: the library run over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import streams
from retally import schemas as S
from retally.operators import changelog as C
from retally.operators import cleanse as P
from retally.operators import conform, joins
from retally.operators.aggregate import Aggregate, summarise, summarise_signed, summarise_whole
from retally.plans import batch, dimensions, reports as R
from retally.sources import derived as D
from retally.sources import envelope as E
from retally.streaming import native

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs --------------------------------------------------------------------

def _events(spark: SparkSession, folder: str, name: str, table: S.Table, key: str) -> DataFrame:
    """Application events: written to text and parsed back, as they arrive on a topic."""
    return E.decode_events(E.encode_events(D.spread(D.rows(spark, folder, name), key), key), table)


def _signed(spark: SparkSession, folder: str, story: str, columns: list[str] | None = None) -> DataFrame:
    """Signed rows of a captured table (all columns or some), through its change text."""
    table = D.STORIES[story].table
    text = E.encode_changes(D.story_changes(spark, folder, story), table, replace_updates=False)
    return C.signed_rows(E.decode_changes(text, table.only(columns) if columns else table))


CLEAN: dict[str, Query] = {
    "games": lambda s, f: P.clean_games(D.rows(s, f, "game_record")),
    "recharges": lambda s, f: P.clean_recharges(D.rows(s, f, "recharge_order")),
    "withdrawals": lambda s, f: P.clean_withdrawals(D.rows(s, f, "withdraw_order")),
    "amount_operations": lambda s, f: P.clean_amount_operations(D.rows(s, f, "amount_operation")),
    "proxies": lambda s, f: P.clean_proxies(D.rows(s, f, "proxy_statistic")),
    "rewards": lambda s, f: P.clean_rewards(_events(s, f, "reward_event", S.REWARD_EVENT, "id")),
    "bounties": lambda s, f: _events(s, f, "bounty_event", S.BOUNTY_EVENT, "id"),
    "withdrawals_with_payments": lambda s, f: joins.orders_with_payments(
        P.clean_withdrawals(D.rows(s, f, "withdraw_order")), D.rows(s, f, "payment_order")),
    R.USER_GAME_DAY.name: lambda s, f: summarise(P.clean_games(D.rows(s, f, "game_record")), R.USER_GAME_DAY),
}


def _report(agg: Aggregate) -> Query:
    return lambda s, f: summarise(CLEAN[agg.source](s, f), agg)


def _feed(story: str, flow: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, f: flow(_signed(s, f, story)).drop("_sign", "_order")


def _retract(story: str, clean: Callable[[DataFrame], DataFrame], agg: Aggregate,
             columns: list[str] | None = None, small_groups: bool = False) -> Query:
    """``small_groups``: no group is large, so the rows go straight to the tasks of their groups, as many as keep each bounded."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        signed = clean(_signed(spark, folder, story, columns))
        if small_groups:
            tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), D.story_tasks(spark, folder, story))
            signed = signed.repartition(tasks, *[F.expr(e) for _, e in agg.keys])
        return summarise_signed(signed, agg)

    return query


# --- change streams --------------------------------------------------------------

def _changelog_signed(spark: SparkSession, folder: str) -> DataFrame:
    return _signed(spark, folder, "game_record").drop("_order")


def _changelog_filter(spark: SparkSession, folder: str) -> DataFrame:
    return P.clean_games(_signed(spark, folder, "game_record")).drop("_order")


def _changelog_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Updates written as delete + insert pairs, then read again."""
    text = E.encode_changes(D.story_changes(spark, folder, "game_record"), S.GAME_RECORD)
    row = E.decode_changes(text, S.GAME_RECORD).select("op", F.coalesce("after", "before").alias("r"))
    return row.select("op", "r.id", "r.user_id", "r.status", "r.bet_amount", "r.update_time")


def _changelog_split(spark: SparkSession, folder: str) -> DataFrame:
    """One stream of several tables, taken apart by table; each line is made and read once."""
    stories = ("amount_operation", "device_users")
    lines = None
    for story in stories:
        text = E.encode_changes(D.story_changes(spark, folder, story), D.STORIES[story].table, replace_updates=False)
        lines = text if lines is None else lines.unionByName(text)
    images = C.signed_rows(E.decode_tables(lines, [D.STORIES[story].table.only(["id"]) for story in stories]))
    return images.groupBy(F.col(E.TABLE).alias("table_name"), "row_kind").agg(
        F.count("*").alias("images"), F.count_distinct("id").alias("ids"))


def _latest_image(spark: SparkSession, folder: str) -> DataFrame:
    return C.current_rows(D.story_changes(spark, folder, "game_record"), S.GAME_RECORD.key)


def _latest_image_of_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The same from change text in which an update is a delete and an insert, dealt out anew."""
    text = E.encode_changes(D.story_changes(spark, folder, "game_record"), S.GAME_RECORD)
    anew = text.repartition(D.story_tasks(spark, folder, "game_record") + 1)
    return C.current_rows(E.decode_changes(anew, S.GAME_RECORD), S.GAME_RECORD.key)


def _latest_version(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated keys read as upserts: the largest version of each key stays."""
    games = D.rows(spark, folder, "game_record").select(
        "id", "user_id", "bet_amount", "update_time", "game_id", "bet_deposit_amount", "bet_no",
        "settle_withdrawal_amount")
    order = ["update_time", "game_id", "bet_amount", "bet_deposit_amount", "bet_no", "settle_withdrawal_amount"]
    return C.current_rows(C.upserts(games, order), ["id"], order).select("id", "user_id", "bet_amount", "update_time")


def _retract_finance(spark: SparkSession, folder: str) -> DataFrame:
    orders = P.clean_withdrawals(_signed(spark, folder, "withdraw_order", P.WITHDRAWAL_COLUMNS))
    payments = _signed(spark, folder, "payment_order", joins.PAYMENT_COLUMNS)
    return summarise_whole(joins.orders_with_payments(orders, payments), R.WITHDRAW_FINANCE_DAY)


def _windows(event_type: str, width: str) -> Query:
    return lambda s, f: native.per_window(
        s.read.parquet(f"{f}/events.parquet").where(F.col("event_type") == event_type), "ts", width)


# --- lookups, checks ---------------------------------------------------------------

def _device_lookup(spark: SparkSession, folder: str) -> DataFrame:
    asks = spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    return joins.lookup_device(asks, D.rows(spark, folder, "device_users"))


def _corrupt_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event text cut short now and then: the broken lines are told apart, the rest is read."""
    lines = streams.broken_lines(spark, folder)
    good, broken = E.split_corrupt(E.decode_events(lines, S.ONLINE_EVENT, keep_corrupt=True, also=["event_id"]))
    return good.select("event_id", F.col("jsonData.user_id").alias("user_id"), F.lit(False).alias("corrupt")).unionByName(
        broken.select("event_id", F.lit(None).cast("bigint").alias("user_id"), F.lit(True).alias("corrupt")))


def _not_null_key(spark: SparkSession, folder: str) -> DataFrame:
    games = D.rows(spark, folder, "game_record").select("id", "order_no", "create_time", "bet_amount")
    return conform.enforce_not_null(games, ["order_no", "create_time"])


def _online(spark: SparkSession, folder: str) -> DataFrame:
    return P.clean_online_status(_events(spark, folder, "online_event", S.ONLINE_EVENT, "token"))


def _dimension(name: str) -> Query:
    return lambda s, f: dimensions.mirror(D.story_changes(s, f, f"dim_{name}"), S.DIMENSIONS[name])


def build() -> dict[str, Query]:
    return {
        "dwd_game": CLEAN["games"], "dwd_recharge": CLEAN["recharges"], "dwd_withdraw": CLEAN["withdrawals"],
        "dwd_amount_operation": CLEAN["amount_operations"], "dwd_proxy": CLEAN["proxies"],
        "dwd_reward": CLEAN["rewards"], "user_online": _online,
        "game_detail": lambda s, f: P.game_detail(D.rows(s, f, "game_record")),
        "reward_detail": lambda s, f: P.reward_detail(CLEAN["rewards"](s, f)),
        "dws_user_game_day": _report(R.USER_GAME_DAY), "dws_user_game_hour": _report(R.USER_GAME_HOUR),
        "dws_channel_category": _report(R.CHANNEL_CATEGORY_DAY),
        "dws_channel_provider": _report(R.CHANNEL_PROVIDER_DAY), "dws_channel_game": _report(R.CHANNEL_GAME_DAY),
        "dws_channel_game_levels": lambda s, f: batch.channel_game_levels(CLEAN["games"](s, f)),
        "ads_user_game_day": _report(R.PLAYER_DAY), "ads_user_game_total": _report(R.PLAYER_TOTAL),
        "dws_user_adjust": _report(R.USER_ADJUST_DAY), "dws_channel_adjust": _report(R.CHANNEL_ADJUST_DAY),
        "dws_user_recharge": _report(R.USER_RECHARGE_DAY), "dws_channel_recharge": _report(R.CHANNEL_RECHARGE_DAY),
        "dws_user_reward": _report(R.USER_REWARD_DAY), "dws_channel_reward": _report(R.CHANNEL_REWARD_DAY),
        "dws_channel_activity": _report(R.CHANNEL_ACTIVITY_DAY),
        "ads_user_reward_day": _report(R.REWARD_DAY), "ads_user_reward_total": _report(R.REWARD_TOTAL),
        "dws_channel_proxy": _report(R.CHANNEL_PROXY_DAY),
        "dws_user_withdraw": _report(R.USER_WITHDRAW_DAY), "dws_channel_withdraw": _report(R.CHANNEL_WITHDRAW_DAY),
        "dws_withdraw_finance": _report(R.WITHDRAW_FINANCE_DAY),
        "ads_user_bounty_day": lambda s, f: batch.bounty(CLEAN["bounties"](s, f), daily=True, live=True),
        "ads_user_bounty_total": lambda s, f: batch.bounty(CLEAN["bounties"](s, f), daily=False, live=True),
        "dim_device_lookup": _device_lookup,
        "ods_game": _feed("game_record", P.game_feed), "ods_recharge": _feed("recharge_order", P.recharge_feed),
        "ods_withdraw": _feed("withdraw_order", P.withdraw_feed),
        "ods_third_payment": _feed("payment_order", P.payment_feed),
        "ods_amount_operation": _feed("amount_operation", P.amount_operation_feed),
        "ods_proxy": _feed("proxy_statistic", P.proxy_feed), "ods_device_users": _feed("device_users", P.device_feed),
        "changelog_signed": _changelog_signed, "changelog_filter": _changelog_filter,
        "changelog_replace": _changelog_replace, "changelog_split": _changelog_split,
        "latest_image": _latest_image, "latest_image_of_pairs": _latest_image_of_pairs, "latest_version": _latest_version,
        "retract_user_game_day": _retract("game_record", P.clean_games, R.USER_GAME_DAY, P.GAME_COLUMNS, small_groups=True),
        "retract_channel_game": _retract("game_record", P.clean_games, R.CHANNEL_GAME_DAY, P.GAME_COLUMNS),
        "retract_user_adjust": _retract("amount_operation", P.clean_amount_operations, R.USER_ADJUST_DAY,
                                        P.AMOUNT_OPERATION_FEED),
        "retract_user_withdraw": _retract("withdraw_order", P.clean_withdrawals, R.USER_WITHDRAW_DAY,
                                          P.WITHDRAWAL_COLUMNS),
        "retract_withdraw_finance": _retract_finance,
        "ads_user_game_total_of_games": _report(R.PLAYER_TOTAL_OF_GAMES),
        **streams.build(),
        "window_login_1m": _windows("signup", "1 minute"), "window_order_1h": _windows("purchase", "1 hour"),
        "corrupt_events": _corrupt_events, "not_null_key": _not_null_key,
        **{f"dim_{name}": _dimension(name) for name in S.DIMENSIONS},
    }
