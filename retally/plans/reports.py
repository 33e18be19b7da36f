"""The reporting tables, declared as data: group keys, measures, source flow.

Names and types are fixed values (they equal the target tables); the families
are generated from the rules that shape them.
"""

from __future__ import annotations

from dataclasses import replace

from retally.functions.measures import (
    MONEY, Measure, earliest, filled, fixed, heads, heads_of, latest, ratio, tally, total)
from retally.operators.aggregate import Aggregate, by
from retally.operators.cleanse import REWARD_SCOPES

SPLITS = ("deposit", "withdrawal", "bonus")
DAY = "statistic_time"


# --- games -------------------------------------------------------------------

_GOOD = "effective_bet_flag = 1"

GAME_MEASURES: tuple[Measure, ...] = (
    filled("bet_count", "order_no"),
    total("effective_bet_count", "CAST(effective_bet_flag AS BIGINT)", type="BIGINT"),
    tally("settle_count", "status = 'settle'"),
    total("settle_bet_amount", "bet_amount"),
    total("bet_amount", "bet_amount"),
    total("settle_amount", "settle_amount"),
    total("win_lose_amount", "transfer_amount"),
    total("effective_bet_amount", "valid_bet_amount", _GOOD),
    *[total(f"bet_{s}_amount", f"bet_{s}_amount") for s in SPLITS],
    *[total(f"settle_{s}_amount", f"settle_{s}_amount") for s in SPLITS],
    *[total(f"win_lose_{s}_amount", f"transfer_{s}_amount") for s in SPLITS],
    *[total(f"effective_bet_{s}_amount", f"valid_bet_{s}_amount", _GOOD) for s in SPLITS],
)
_PLAYERS = (heads("user_count", "user_id"),)
_PROVIDER = "third_platform_provider_type"

USER_GAME_DAY = Aggregate(
    "today_user_game_statistics_dws",
    by(DAY, "user_id", "channel_id", "game_id", "game_category_id", _PROVIDER), GAME_MEASURES, source="games")

# The category is left out of the grouping: it is not part of the target key, and
# keeping it would give several rows per key of which the last one wins.
USER_GAME_HOUR = Aggregate(
    "today_user_hour_game_ug_statistics_data",
    by(DAY, "statistic_hour", "user_id", "channel_id", "game_id", _PROVIDER),
    GAME_MEASURES + (total("profit_and_loss_amount", "-transfer_amount"),), source="games")

CHANNEL_CATEGORY_DAY = Aggregate(
    "today_channel_game_category_statistic", by(DAY, "channel_id", "game_category_id"),
    _PLAYERS + GAME_MEASURES, source="games")
CHANNEL_PROVIDER_DAY = Aggregate(
    "today_channel_game_provider_statistic", by(DAY, "channel_id", _PROVIDER),
    _PLAYERS + GAME_MEASURES, source="games")
CHANNEL_GAME_DAY = Aggregate(
    "today_channel_game_record_statistic", by(DAY, "channel_id"),
    _PLAYERS + GAME_MEASURES, source="games")

# (reported name, measure of the daily user table, type)
_PLAYER_TOTALS = (
    ("effective_bet_amount", "effective_bet_amount", MONEY),
    ("effective_bet_count", "effective_bet_count", "INT"),
    ("effective_bet_deposit_amount", "effective_bet_deposit_amount", MONEY),
    ("effective_bet_withdrawal_amount", "effective_bet_withdrawal_amount", MONEY),
    ("effective_bet_bonus_amount", "effective_bet_bonus_amount", MONEY),
    ("win_loss_amount", "win_lose_amount", MONEY),
    ("win_loss_withdraw_amount", "win_lose_withdrawal_amount", MONEY),
    ("win_loss_deposit_amount", "win_lose_deposit_amount", MONEY),
    ("win_loss_bonus_amount", "win_lose_bonus_amount", MONEY),
    ("settle_bet_amount", "settle_bet_amount", MONEY),
    ("bet_amount", "bet_amount", MONEY),
    ("bet_count", "bet_count", "INT"),
    ("bet_deposit_amount", "bet_deposit_amount", MONEY),
    ("bet_withdrawal_amount", "bet_withdrawal_amount", MONEY),
    ("bet_bonus_amount", "bet_bonus_amount", MONEY),
    ("settle_amount", "settle_amount", MONEY),
    ("settle_count", "settle_count", MONEY),
    ("settle_deposit_amount", "settle_deposit_amount", MONEY),
    ("settle_withdrawal_amount", "settle_withdrawal_amount", MONEY),
    ("settle_bonus_amount", "settle_bonus_amount", MONEY),
)


def _player(measure) -> tuple[Measure, ...]:
    """The player totals, each made by ``measure(name, daily measure, type)``."""
    return (
        *[measure(f"total_{n}", m, t) for n, m, t in _PLAYER_TOTALS[:2]],
        *[measure(f"third_party_total_{n}", m, t) for n, m, t in _PLAYER_TOTALS],
        ratio("third_party_total_kill_rate", "third_party_total_win_loss_amount",
              "third_party_total_settle_bet_amount"))


def _from_daily(name: str, column: str, type: str) -> Measure:
    counted = column.endswith("_count")
    return total(name, f"CAST({column} AS {type})" if counted else column, type=type)


def _from_games(name: str, column: str, type: str) -> Measure:
    return replace(next(m for m in GAME_MEASURES if m.name == column), name=name, type=type)


PLAYER_DAY = Aggregate("today_user_game_statistic", by(DAY, "user_id", "channel_id"),
                       _player(_from_daily), source=USER_GAME_DAY.name)
PLAYER_TOTAL = Aggregate("user_game_statistic", by("user_id", "channel_id"),
                         _player(_from_daily), source=USER_GAME_DAY.name)
# the same two straight from the games: sums of sums are sums
PLAYER_DAY_OF_GAMES = replace(PLAYER_DAY, measures=_player(_from_games), source="games")
PLAYER_TOTAL_OF_GAMES = replace(PLAYER_TOTAL, measures=_player(_from_games), source="games")


# --- manual adjustments ------------------------------------------------------

def _adjustments(word: str, label: str) -> list[Measure]:
    return [total(f"custom_{label}_amount", "amount", f"type = '{word}'")] + [
        total(f"custom_{label}_{kind.lower()}_amount", "amount", f"type = '{word}' AND amount_type = '{kind}'")
        for kind in ("WITHDRAW", "DEPOSIT", "BONUS")]


ADJUST_MEASURES: tuple[Measure, ...] = (
    tally("custom_increase_count", "type = 'INCREASE'"),
    tally("custom_reduction_count", "type = 'REDUCE'"),
    *_adjustments("INCREASE", "increase"),
    *_adjustments("REDUCE", "reduction"),
)
# The channel is part of the key: without it the last channel of a user would win.
USER_ADJUST_DAY = Aggregate(
    "today_user_custom_amount_statistics_data", by("user_id", "channel_id", DAY),
    ADJUST_MEASURES + (earliest("create_time", "create_time"), latest("update_time", "update_time")),
    source="amount_operations")
CHANNEL_ADJUST_DAY = Aggregate(
    "today_channel_custom_amount_statistic", by("channel_id", DAY),
    (heads("user_count", "user_id"),) + ADJUST_MEASURES, source="amount_operations", factors=("type", "amount_type"))


# --- recharges ---------------------------------------------------------------

_PAID = "order_status = 'complete'"
_UNPAID = tuple(tally(f"{s}_order_count", f"pay_status = '{s}'", "INT")
                for s in ("pending_payment", "payment_failed", "payment_timeout"))
_RECHARGE_FEES = (
    total("handling_fee", "actual_handling_fee", _PAID),
    total("gift_amount", "actual_gift_amount", _PAID),
    total("decrease_handling_fee", "actual_decrease_handling_fee", _PAID),
)
_FIRST_PAID = f"{_PAID} AND first_recharge = 1"
_AGAIN_PAID = f"{_PAID} AND first_recharge = 0"

USER_RECHARGE_DAY = Aggregate(
    "today_user_recharge_statistic_dws",
    by(DAY, "user_id", "channel_id", "pay_category_id", "pay_method_id", "pay_channel_id", "pay_provider_id"), (
        fixed("abs_id", "-1", "BIGINT"),
        *_UNPAID,
        filled("total_recharge_count", "id", "INT"),
        tally("recharge_success_order_count", _PAID, "INT"),
        tally("recharge_failed_order_count", "order_status = 'cancel' OR order_status = 'failed'", "INT"),
        fixed("recharge_user_count", "1", "INT"),
        total("total_recharge_amount", "order_amount"),
        total("success_recharge_amount", "actual_recharge_amount", _PAID),
        total("first_recharge_amount", "order_amount", _FIRST_PAID),
        total("repeat_recharge_amount", "order_amount", _AGAIN_PAID),
        *_RECHARGE_FEES,
    ), source="recharges")

CHANNEL_RECHARGE_DAY = Aggregate(
    "today_channel_recharge_statistic", by("channel_id", DAY), (
        heads("first_user_count", "user_id", _FIRST_PAID, "INT"),
        total("first_recharge_amount", "order_amount", _FIRST_PAID),
        heads("recharge_user_count", "user_id", _PAID, "INT"),
        total("repeat_recharge_amount", "order_amount", _AGAIN_PAID),
        heads("user_count", "user_id", type="INT"),
        *_UNPAID,
        tally("recharge_success_order_count", _PAID, "INT"),
        *_RECHARGE_FEES,
    ), source="recharges", factors=("order_status", "pay_status", "first_recharge"))


# --- rewards -----------------------------------------------------------------

_TYPES = {"withdrawal": "WITHDRAW", "deposit": "DEPOSIT", "bonus": "BONUS"}
_REWARD_FACTORS = ("reward_scope", "reward_type", "draw_flag")
_DRAWN = {"draw": "draw_flag = 1", "no_draw": "draw_flag = 0"}
_TRIPLE = ("activity_type", "user_id", "unique_id")


def _all_of(*conditions: str | None) -> str | None:
    return " AND ".join(c for c in conditions if c) or None


def _reward_amounts(prefix: str, scope: str | None) -> list[Measure]:
    """Amounts of one scope: drawn or not, by reward type, drawn or not by type."""
    whole = prefix if prefix in ("activity", "bonus_task") else f"{prefix}_draw"
    return [
        *[total(f"{prefix}_{d}_amount", "bonus_amount", _all_of(scope, c)) for d, c in _DRAWN.items()],
        *[total(f"{whole}_total_{t}_amount", "bonus_amount", _all_of(scope, f"reward_type = '{w}'"))
          for t, w in _TYPES.items()],
        *[total(f"{prefix}_{d}_{t}_amount", "bonus_amount", _all_of(scope, c, f"reward_type = '{w}'"))
          for d, c in _DRAWN.items() for t, w in _TYPES.items()],
    ]


def _scope_measures(word: str, prefix: str, per_user: bool) -> list[Measure]:
    scope = f"reward_scope = '{word}'"
    out: list[Measure] = []
    if prefix == "activity":
        if per_user:
            out.append(heads_of("activity_total_count", _TRIPLE, scope))
            out += [heads_of(f"activity_{d}_count", _TRIPLE, f"{scope} AND {c}") for d, c in _DRAWN.items()]
        else:
            out += [tally(f"activity_{d}_count", f"{scope} AND {c}") for d, c in _DRAWN.items()]
        out.append(total("activity_total_amount", "bonus_amount", scope))
    else:
        out += [tally(f"{prefix}_{d}_count", f"{scope} AND {c}") for d, c in _DRAWN.items()]
    if not per_user and prefix != "tourist":
        out.append(heads(f"{prefix}_user_count", "user_id", scope))
    return out + _reward_amounts(prefix, scope)


USER_REWARD_DAY = Aggregate(
    "today_user_reward_statistics_dws",
    by(DAY, "user_id", "channel_id", activity_type="COALESCE(activity_type, '')"),
    tuple(m for word, prefix in REWARD_SCOPES.items() for m in _scope_measures(word, prefix, True)),
    source="rewards", factors=_REWARD_FACTORS)

CHANNEL_REWARD_DAY = Aggregate(
    "today_channel_reward_statistic", by(DAY, "channel_id"),
    (heads("user_count", "user_id"),
     *[m for word, prefix in REWARD_SCOPES.items() for m in _scope_measures(word, prefix, False)]),
    source="rewards", factors=_REWARD_FACTORS)

CHANNEL_ACTIVITY_DAY = Aggregate(
    "today_channel_activity_statistic", by(DAY, "channel_id", "activity_type"), (
        heads("user_count", "user_id"),
        fixed("view_activity_count", "0", "BIGINT"),
        heads_of("activity_reward_count", _TRIPLE),
        total("activity_total_amount", "bonus_amount"),
        heads("activity_user_count", "user_id"),
        *[heads_of(f"activity_{d}_count", _TRIPLE, c) for d, c in _DRAWN.items()],
        *_reward_amounts("activity", None),
    ), where="activity_type IS NOT NULL AND reward_scope = 'ACTIVITY_REWARD'", source="rewards",
    factors=("reward_type", "draw_flag"))

_TASK = "reward_scope = 'BONUS_TASK'"
REWARD_TOTALS: tuple[Measure, ...] = (
    # of a drawn bonus task only the withdrawable kind counts towards the total
    total("total_reward_amount", "bonus_amount",
          f"{_DRAWN['draw']} AND (NOT ({_TASK}) OR reward_type = 'WITHDRAW')"),
    tally("total_reward_count", _DRAWN["draw"], "INT"),
    *[m for t, w in _TYPES.items() for m in (
        total(f"total_reward_{t}_amount", "bonus_amount", f"reward_type = '{w}' AND draw_flag = 1"),
        tally(f"total_reward_{t}_count", f"reward_type = '{w}' AND draw_flag = 1", "INT"))],
    *[m for label, d in (("task", "no_draw"), ("task_draw", "draw")) for m in (
        total(f"total_reward_{label}_amount", "bonus_amount", f"{_TASK} AND {_DRAWN[d]}"),
        tally(f"total_reward_{label}_count", f"{_TASK} AND {_DRAWN[d]}", "INT"))],
)
REWARD_DAY = Aggregate("today_user_reward_statistic", by(DAY, "user_id", "channel_id"), REWARD_TOTALS, source="rewards",
                       factors=_REWARD_FACTORS)
REWARD_TOTAL = Aggregate("user_reward_statistic", by("user_id", "channel_id"), REWARD_TOTALS, source="rewards",
                         factors=_REWARD_FACTORS)


# --- agents ------------------------------------------------------------------

_REBATES = ("direct_bet", "direct_recharge", "teams_bet", "teams_recharge")
_PAID_REBATE = " + ".join(f"{r}_rebate_amount" for r in _REBATES)


def _rows_of_users(name: str, where: str) -> Measure:
    """Rows with a user for which the condition holds (a head count that is not distinct)."""
    return tally(name, f"({where}) AND user_id IS NOT NULL")


CHANNEL_PROXY_DAY = Aggregate(
    "today_channel_proxy_statistic", by("channel_id", DAY), (
        *[total(f"{r}_rebate_amount", f"{r}_rebate_amount") for r in _REBATES],
        total("invitation_amount", "invitation_amount"),
        total("achievement_amount", "achievement_amount"),
        total("total_effective_bet_amount", "effective_bet_amount"),
        _rows_of_users("commissions_number", f"{_PAID_REBATE} <> 0"),
        total("valid_direct_member", "valid_direct_member", type="BIGINT"),
        total("betting_rebate_count", "betting_rebate_count", type="BIGINT"),
        total("recharge_rebate_count", "recharge_rebate_count", type="BIGINT"),
        _rows_of_users("betting_rebate_number", "betting_rebate_count <> 0"),
        _rows_of_users("recharge_rebate_number", "recharge_rebate_count <> 0"),
        _rows_of_users("rebates_number", "betting_rebate_count <> 0 OR recharge_rebate_count <> 0"),
        total("total_transfer_amount", "transfer_amount"),
    ), source="proxies")


# --- withdrawals -------------------------------------------------------------

_DONE, _REFUSED = "order_status = 'COMPLETED'", "order_status = 'REJECTED'"
_WITHDRAW_FEES = (
    total("handling_fee", "final_handling_fee", _DONE),
    total("gift_amount", "gift_amount", _DONE),
    total("decrease_handling_fee", "decrease_handling_amount", _DONE),
)
USER_WITHDRAW_DAY = Aggregate(
    "today_user_withdraw_statistic_dws",
    by(DAY, "user_id", "channel_id", pay_category_id="apply_bank_id", pay_method_id="withdrawal_mode_id",
       pay_channel_id="withdrawal_channel_id", pay_provider_id="pay_provider_id"), (
        total("completed_withdraw_amount", "withdraw_funds_amount", _DONE),
        total("rejected_withdraw_amount", "withdraw_funds_amount", _REFUSED),
        total("success_withdraw_amount", "withdraw_funds_amount", _DONE),
        total("first_withdraw_amount", "withdraw_funds_amount", f"{_DONE} AND first_withdrawal_flag = 1"),
        *_WITHDRAW_FEES,
        filled("withdraw_order_count", "id", "INT"),
        heads("withdraw_success_order_count", "order_no", _DONE, "INT"),
        heads("rejected_order_count", "order_no", _REFUSED, "INT"),
        heads("completed_order_count", "order_no", _DONE, "INT"),
    ), source="withdrawals")

CHANNEL_WITHDRAW_DAY = Aggregate(
    "today_channel_withdraw_statistic", by(DAY, "channel_id"), (
        heads("user_count", "user_id", type="INT"),
        total("withdraw_amount", "withdraw_funds_amount"),
        *_WITHDRAW_FEES,
        heads("rejected_order_count", "order_no", _REFUSED, "INT"),
        heads("completed_order_count", "order_no", _DONE, "INT"),
        # counts every user with a completed order; the first-withdrawal flag plays no part
        heads("first_user_count", "user_id", _DONE, "INT"),
    ), source="withdrawals", factors=("order_status",))

# over the orders joined with their payment tries (retally.operators.joins.orders_with_payments);
# an order's own amount repeats for each of its payment rows
WITHDRAW_FINANCE_DAY = Aggregate(
    "today_user_withdraw_statistic_finance_increment",
    by("user_id", "channel_id", statistic_time="payment_day", pay_category_id="apply_bank_id",
       pay_method_id="withdrawal_mode_id", pay_channel_id="COALESCE(payment_channel_id, 0)",
       pay_provider_id="COALESCE(payment_provider_id, 0)"), (
        total("withdraw_amount", "payment_amount"),
        total("success_withdraw_amount", "withdraw_funds_amount", _DONE),
        heads("user_count", "user_id"),
        heads("withdraw_order_count", "payment_order_no"),
        tally("withdraw_success_order_count", _DONE),
        latest("create_time", "update_time"),
        latest("update_time", "update_time"),
    ), source="withdrawals_with_payments")


# --- bounty (placeholder) ----------------------------------------------------

def _bounty_measures() -> tuple[Measure, ...]:
    """All zero until the source exists; counts of the first two groups are INT, the rest money."""
    out: list[Measure] = []
    for group in ("effective_bet", "bet", "punish", "pumped", "profit_loss", "win_loss", "settle"):
        amount = fixed(f"bounty_total_{group}_amount", "0", MONEY)
        count = fixed(f"bounty_total_{group}_count", "0", "INT" if group.endswith("bet") else MONEY)
        out += [count, amount] if group == "effective_bet" else [amount, count]
        out += [fixed(f"bounty_total_{group}_{s}_amount", "0", MONEY) for s in SPLITS]
    return tuple(out)


_BOUNTY_DAY = "CAST(jsonData.update_time AS DATE)"
BOUNTY_DAY = Aggregate(
    "today_user_bounty_statistic",
    by(statistic_time=_BOUNTY_DAY, user_id="jsonData.user_id", channel_id="jsonData.channel_id"),
    _bounty_measures(), where="jsonData.update_time IS NOT NULL", source="bounties")
BOUNTY_TOTAL = Aggregate(
    "user_bounty_statistic", by(user_id="jsonData.user_id", channel_id="jsonData.channel_id"),
    _bounty_measures(), where="jsonData.update_time IS NOT NULL", source="bounties")


ALL = {a.name: a for a in (
    USER_GAME_DAY, USER_GAME_HOUR, CHANNEL_CATEGORY_DAY, CHANNEL_PROVIDER_DAY, CHANNEL_GAME_DAY,
    PLAYER_DAY, PLAYER_TOTAL, USER_ADJUST_DAY, CHANNEL_ADJUST_DAY, USER_RECHARGE_DAY, CHANNEL_RECHARGE_DAY,
    USER_REWARD_DAY, CHANNEL_REWARD_DAY, CHANNEL_ACTIVITY_DAY, REWARD_DAY, REWARD_TOTAL, CHANNEL_PROXY_DAY,
    USER_WITHDRAW_DAY, CHANNEL_WITHDRAW_DAY, WITHDRAW_FINANCE_DAY, BOUNTY_DAY, BOUNTY_TOTAL)}
