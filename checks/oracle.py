"""Plain SQL for every registered query, written apart from the library.

Only the derivation of the input rows (``retally.sources.derived``) is shared;
the filters, groupings and measures below are spelled out again in SQL.
"""

from __future__ import annotations

from retally import schemas as S
from retally.sources import derived as D

M = "DECIMAL(20,4)"
SCOPES = [("VIP_REWARD", "vip"), ("REBATE_REWARD", "rebate"), ("ACTIVITY_REWARD", "activity"),
          ("BONUS_TASK", "bonus_task"), ("TOURIST_TRIAL_BONUS", "tourist")]
TYPES = [("WITHDRAW", "withdrawal"), ("DEPOSIT", "deposit"), ("BONUS", "bonus")]


def with_(body: str, **ctes: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({D.dialect(s, D.PLAIN)})" for n, s in ctes.items()) + "\n" + body


def money(x: str, name: str) -> str:
    return f"CAST({x} AS {M}) AS {name}"


def summed(x: str, name: str, cond: str | None = None) -> str:
    return money(f"SUM({x})" if cond is None else f"SUM(CASE WHEN {cond} THEN {x} ELSE 0 END)", name)


def counted(cond: str, name: str, type: str = "BIGINT") -> str:
    return f"CAST(COUNT(CASE WHEN {cond} THEN 1 END) AS {type}) AS {name}"


def distinct(x: str, name: str, cond: str | None = None, type: str = "BIGINT") -> str:
    inner = x if cond is None else f"CASE WHEN {cond} THEN {x} END"
    return f"CAST(COUNT(DISTINCT {inner}) AS {type}) AS {name}"


def group(keys: list[str], measures: list[str], source: str, where: str = "TRUE", by: list[str] | None = None) -> str:
    return f"SELECT {', '.join(keys + measures)} FROM {source} WHERE {where} GROUP BY {', '.join(by or keys)}"


# --- cleansed layer ------------------------------------------------------------

DAY = "CAST(update_time AS DATE) AS statistic_time"
_GAME_DIMS = "user_id, channel_id, game_id, game_category_id, third_platform_provider_type"
_SPLIT = ["deposit", "withdrawal", "bonus"]
_GAME_FACTS = ", ".join(
    ["id", "order_no", "bet_amount", "settle_amount", "transfer_amount", *[f"bet_{s}_amount" for s in _SPLIT],
     "effective_bet_flag", *[f"settle_{s}_amount" for s in _SPLIT], *[f"transfer_{s}_amount" for s in _SPLIT],
     "valid_bet_amount", *[f"valid_bet_{s}_amount" for s in _SPLIT]])
_SETTLED = "status = 'settle' AND order_no IS NOT NULL AND update_time IS NOT NULL"


def clean_games(src: str, lead: str = "") -> str:
    return (f"SELECT {lead}{DAY}, CAST(EXTRACT(HOUR FROM update_time) AS BIGINT) AS statistic_hour, {_GAME_DIMS},"
            f" {_GAME_FACTS}, status, update_time FROM {src} WHERE {_SETTLED}")


_LIVE = "order_no IS NOT NULL AND update_time IS NOT NULL"
CLEAN_RECHARGE = (
    f"SELECT {DAY}, user_id, channel_id, pay_category_id, pay_method_id, pay_channel_id, pay_provider_id, id, order_no,"
    " currency_code, rate_scale, order_amount, pay_amount, decrease_handling_fee, handling_fee, gift_amount,"
    " recharge_amount, actual_handling_fee, actual_decrease_handling_fee, actual_gift_amount, actual_recharge_amount,"
    " first_recharge, pay_status, order_status, recharge_success_time, create_time, update_time"
    f" FROM recharge_order WHERE {_LIVE}")


def clean_withdraw(src: str, lead: str = "") -> str:
    return (f"SELECT {lead}{DAY}, user_id, channel_id, apply_bank_id, withdrawal_mode_id, withdrawal_channel_id,"
            " pay_provider_id, id, order_no, withdraw_funds_amount, final_handling_fee, gift_amount,"
            " decrease_handling_amount, first_withdrawal_flag, order_status, create_time, update_time"
            f" FROM {src} WHERE {_LIVE}")


def clean_amount(src: str) -> str:
    return (f"SELECT {DAY}, user_id, channel_id, id, type, amount_type, amount, balance, status, create_time, update_time"
            f" FROM {src} WHERE status = 'COMPLETE' AND update_time IS NOT NULL")


CLEAN_PROXY = "SELECT * FROM proxy_statistic WHERE update_time IS NOT NULL"
CLEAN_REWARD = (
    f"SELECT {DAY}, user_id, channel_id, unique_id, reward_scope, reward_type, activity_type, id, bonus_amount,"
    " CASE WHEN draw_flag THEN 1 ELSE 0 END AS draw_flag, not_receive_time, receive_time, time_out_time, create_time,"
    " update_time FROM reward_event WHERE update_time IS NOT NULL AND reward_scope IN ("
    + ", ".join(f"'{w}'" for w, _ in SCOPES) + ")")


def online(src: str) -> str:
    return ("SELECT COALESCE(session_id, 'N/A') AS session_id, user_id, token,"
            " TRY_CAST(REPLACE(online_time, 'T', ' ') AS TIMESTAMP) AS online_time, ip, device_id,"
            f" TRY_CAST(REPLACE(create_time, 'T', ' ') AS TIMESTAMP) AS create_time FROM {src}")


# --- reports ---------------------------------------------------------------------

_GOOD = "effective_bet_flag = 1"
GAME = [
    "COUNT(order_no) AS bet_count", "CAST(SUM(CAST(effective_bet_flag AS BIGINT)) AS BIGINT) AS effective_bet_count",
    "CAST(COUNT(*) AS BIGINT) AS settle_count", summed("bet_amount", "settle_bet_amount"),
    summed("bet_amount", "bet_amount"), summed("settle_amount", "settle_amount"),
    summed("transfer_amount", "win_lose_amount"), summed("valid_bet_amount", "effective_bet_amount", _GOOD),
    *[summed(f"bet_{s}_amount", f"bet_{s}_amount") for s in _SPLIT],
    *[summed(f"settle_{s}_amount", f"settle_{s}_amount") for s in _SPLIT],
    *[summed(f"transfer_{s}_amount", f"win_lose_{s}_amount") for s in _SPLIT],
    *[summed(f"valid_bet_{s}_amount", f"effective_bet_{s}_amount", _GOOD) for s in _SPLIT]]
USERS = distinct("user_id", "user_count")
P = "third_platform_provider_type"


def user_game_day(src: str) -> str:
    return group(["statistic_time", "user_id", "channel_id", "game_id", "game_category_id", P], GAME, src)


def channel_game(src: str, *more: str) -> str:
    return group(["statistic_time", "channel_id", *more], [USERS, *GAME], src)


def _player_measures() -> list[str]:
    amounts = {
        "effective_bet_deposit_amount": "effective_bet_deposit_amount",
        "effective_bet_withdrawal_amount": "effective_bet_withdrawal_amount",
        "effective_bet_bonus_amount": "effective_bet_bonus_amount",
        "win_loss_amount": "win_lose_amount", "win_loss_withdraw_amount": "win_lose_withdrawal_amount",
        "win_loss_deposit_amount": "win_lose_deposit_amount", "win_loss_bonus_amount": "win_lose_bonus_amount",
        "settle_bet_amount": "settle_bet_amount", "bet_amount": "bet_amount",
        "bet_deposit_amount": "bet_deposit_amount", "bet_withdrawal_amount": "bet_withdrawal_amount",
        "bet_bonus_amount": "bet_bonus_amount", "settle_amount": "settle_amount", "settle_count": "settle_count",
        "settle_deposit_amount": "settle_deposit_amount", "settle_withdrawal_amount": "settle_withdrawal_amount",
        "settle_bonus_amount": "settle_bonus_amount"}
    out = []
    for prefix in ("total", "third_party_total"):
        out += [summed("effective_bet_amount", f"{prefix}_effective_bet_amount"),
                f"CAST(SUM(effective_bet_count) AS INT) AS {prefix}_effective_bet_count"]
    out += [summed(c, f"third_party_total_{n}") for n, c in amounts.items()]
    out.append("CAST(SUM(bet_count) AS INT) AS third_party_total_bet_count")
    out.append("CAST(CASE WHEN SUM(settle_bet_amount) = 0 THEN 0 ELSE ROUND(-CAST(SUM(win_lose_amount) AS DOUBLE)"
               f" / CAST(SUM(settle_bet_amount) AS DOUBLE), 4) END AS {M}) AS third_party_total_kill_rate")
    return out


def player(src: str, daily: bool) -> str:
    return group((["statistic_time"] if daily else []) + ["user_id", "channel_id"], _player_measures(), src)


ADJUST = [counted("type = 'INCREASE'", "custom_increase_count"), counted("type = 'REDUCE'", "custom_reduction_count")]
for _w, _l in (("INCREASE", "increase"), ("REDUCE", "reduction")):
    ADJUST.append(summed("amount", f"custom_{_l}_amount", f"type = '{_w}'"))
    ADJUST += [summed("amount", f"custom_{_l}_{k.lower()}_amount", f"type = '{_w}' AND amount_type = '{k}'")
               for k in ("WITHDRAW", "DEPOSIT", "BONUS")]


def user_adjust(src: str) -> str:
    return group(["user_id", "channel_id", "statistic_time"],
                 [*ADJUST, "MIN(create_time) AS create_time", "MAX(update_time) AS update_time"], src)


def channel_adjust(src: str) -> str:
    return group(["channel_id", "statistic_time"], [USERS, *ADJUST], src)


_PAID = "order_status = 'complete'"
_STATES = [counted(f"pay_status = '{s}'", f"{s}_order_count", "INT")
           for s in ("pending_payment", "payment_failed", "payment_timeout")]
_FEES = [summed("actual_handling_fee", "handling_fee", _PAID), summed("actual_gift_amount", "gift_amount", _PAID),
         summed("actual_decrease_handling_fee", "decrease_handling_fee", _PAID)]
USER_RECHARGE = group(
    ["statistic_time", "user_id", "channel_id", "pay_category_id", "pay_method_id", "pay_channel_id", "pay_provider_id"],
    ["CAST(-1 AS BIGINT) AS abs_id", *_STATES, "CAST(COUNT(id) AS INT) AS total_recharge_count",
     counted(_PAID, "recharge_success_order_count", "INT"),
     counted("order_status IN ('cancel', 'failed')", "recharge_failed_order_count", "INT"),
     "CAST(1 AS INT) AS recharge_user_count", summed("order_amount", "total_recharge_amount"),
     summed("actual_recharge_amount", "success_recharge_amount", _PAID),
     summed("order_amount", "first_recharge_amount", f"{_PAID} AND first_recharge = 1"),
     summed("order_amount", "repeat_recharge_amount", f"{_PAID} AND first_recharge = 0"), *_FEES], "clean")
CHANNEL_RECHARGE = group(
    ["channel_id", "statistic_time"],
    [distinct("user_id", "first_user_count", f"{_PAID} AND first_recharge = 1", "INT"),
     summed("order_amount", "first_recharge_amount", f"{_PAID} AND first_recharge = 1"),
     distinct("user_id", "recharge_user_count", _PAID, "INT"),
     summed("order_amount", "repeat_recharge_amount", f"{_PAID} AND first_recharge = 0"),
     distinct("user_id", "user_count", None, "INT"), *_STATES,
     counted(_PAID, "recharge_success_order_count", "INT"), *_FEES], "clean")

_TRIPLE = "(activity_type || '|' || CAST(user_id AS VARCHAR) || '|' || CAST(unique_id AS VARCHAR))"
_DRAW = [("draw", "draw_flag = 1"), ("no_draw", "draw_flag = 0")]


def _scope(word: str, p: str, per_user: bool) -> list[str]:
    s = f"reward_scope = '{word}'"
    b = "bonus_amount"
    lead = p if p in ("activity", "bonus_task") else f"{p}_draw"
    out = []
    if p == "activity":
        out.append(summed(b, "activity_total_amount", s))
    if p == "activity" and per_user:
        out.append(distinct(_TRIPLE, "activity_total_count", s))
        out += [distinct(_TRIPLE, f"activity_{d}_count", f"{s} AND {c}") for d, c in _DRAW]
    else:
        out += [counted(f"{s} AND {c}", f"{p}_{d}_count") for d, c in _DRAW]
    if not per_user and p != "tourist":
        out.append(distinct("user_id", f"{p}_user_count", s))
    out += [summed(b, f"{p}_{d}_amount", f"{s} AND {c}") for d, c in _DRAW]
    out += [summed(b, f"{lead}_total_{n}_amount", f"{s} AND reward_type = '{w}'") for w, n in TYPES]
    out += [summed(b, f"{p}_{d}_{n}_amount", f"{s} AND {c} AND reward_type = '{w}'") for d, c in _DRAW for w, n in TYPES]
    return out


USER_REWARD = group(
    ["statistic_time", "user_id", "channel_id", "COALESCE(activity_type, '') AS activity_type"],
    [m for w, p in SCOPES for m in _scope(w, p, True)], "clean",
    by=["statistic_time", "user_id", "channel_id", "COALESCE(activity_type, '')"])
CHANNEL_REWARD = group(["statistic_time", "channel_id"],
                       [USERS, *[m for w, p in SCOPES for m in _scope(w, p, False)]], "clean")
CHANNEL_ACTIVITY = group(
    ["statistic_time", "channel_id", "activity_type"],
    [USERS, "CAST(0 AS BIGINT) AS view_activity_count", distinct(_TRIPLE, "activity_reward_count"),
     summed("bonus_amount", "activity_total_amount"), distinct("user_id", "activity_user_count"),
     *[distinct(_TRIPLE, f"activity_{d}_count", c) for d, c in _DRAW],
     *[summed("bonus_amount", f"activity_{d}_amount", c) for d, c in _DRAW],
     *[summed("bonus_amount", f"activity_total_{n}_amount", f"reward_type = '{w}'") for w, n in TYPES],
     *[summed("bonus_amount", f"activity_{d}_{n}_amount", f"{c} AND reward_type = '{w}'")
       for d, c in _DRAW for w, n in TYPES]],
    "clean", "activity_type IS NOT NULL AND reward_scope = 'ACTIVITY_REWARD'")


def _reward_totals() -> list[str]:
    task = "reward_scope = 'BONUS_TASK'"
    out = [money(f"SUM(CASE WHEN draw_flag = 1 THEN CASE WHEN {task} THEN CASE WHEN reward_type = 'WITHDRAW' THEN"
                 " bonus_amount ELSE 0 END ELSE bonus_amount END ELSE 0 END)", "total_reward_amount"),
           counted("draw_flag = 1", "total_reward_count", "INT")]
    for w, n in TYPES:
        c = f"reward_type = '{w}' AND draw_flag = 1"
        out += [summed("bonus_amount", f"total_reward_{n}_amount", c), counted(c, f"total_reward_{n}_count", "INT")]
    for n, f in (("task", 0), ("task_draw", 1)):
        c = f"{task} AND draw_flag = {f}"
        out += [summed("bonus_amount", f"total_reward_{n}_amount", c), counted(c, f"total_reward_{n}_count", "INT")]
    return out


def reward_totals(daily: bool) -> str:
    return group((["statistic_time"] if daily else []) + ["user_id", "channel_id"], _reward_totals(), "clean")


_REB = ["direct_bet", "direct_recharge", "teams_bet", "teams_recharge"]


def channel_proxy(src: str) -> str:
    return group(
        ["channel_id", "statistic_time"],
        [*[summed(f"{r}_rebate_amount", f"{r}_rebate_amount") for r in _REB],
         summed("invitation_amount", "invitation_amount"), summed("achievement_amount", "achievement_amount"),
         summed("effective_bet_amount", "total_effective_bet_amount"),
         "COUNT(CASE WHEN (" + " + ".join(f"{r}_rebate_amount" for r in _REB) + ") <> 0 THEN user_id END) AS commissions_number",
         *[f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in ("valid_direct_member", "betting_rebate_count", "recharge_rebate_count")],
         "COUNT(CASE WHEN betting_rebate_count <> 0 THEN user_id END) AS betting_rebate_number",
         "COUNT(CASE WHEN recharge_rebate_count <> 0 THEN user_id END) AS recharge_rebate_number",
         "COUNT(CASE WHEN betting_rebate_count <> 0 OR recharge_rebate_count <> 0 THEN user_id END) AS rebates_number",
         summed("transfer_amount", "total_transfer_amount")], src)


_DONE = "order_status = 'COMPLETED'"
_REF = "order_status = 'REJECTED'"
_WFEES = [summed("final_handling_fee", "handling_fee", _DONE), summed("gift_amount", "gift_amount", _DONE),
          summed("decrease_handling_amount", "decrease_handling_fee", _DONE)]
_PAY_KEYS = ["statistic_time", "user_id", "channel_id", "apply_bank_id AS pay_category_id",
             "withdrawal_mode_id AS pay_method_id", "withdrawal_channel_id AS pay_channel_id", "pay_provider_id"]


def user_withdraw(src: str) -> str:
    return group(_PAY_KEYS, [
        summed("withdraw_funds_amount", "completed_withdraw_amount", _DONE),
        summed("withdraw_funds_amount", "rejected_withdraw_amount", _REF),
        summed("withdraw_funds_amount", "success_withdraw_amount", _DONE),
        summed("withdraw_funds_amount", "first_withdraw_amount", f"{_DONE} AND first_withdrawal_flag = 1"), *_WFEES,
        "CAST(COUNT(id) AS INT) AS withdraw_order_count", distinct("order_no", "withdraw_success_order_count", _DONE, "INT"),
        distinct("order_no", "rejected_order_count", _REF, "INT"),
        distinct("order_no", "completed_order_count", _DONE, "INT")], src, by=[k.split(" AS ")[0] for k in _PAY_KEYS])


def channel_withdraw(src: str) -> str:
    return group(["statistic_time", "channel_id"], [
        distinct("user_id", "user_count", None, "INT"), summed("withdraw_funds_amount", "withdraw_amount"), *_WFEES,
        distinct("order_no", "rejected_order_count", _REF, "INT"),
        distinct("order_no", "completed_order_count", _DONE, "INT"),
        distinct("user_id", "first_user_count", _DONE, "INT")], src)


def finance(orders: str, payments: str) -> str:
    keys = ["CAST(t2.update_time AS DATE)", "t1.user_id", "t1.channel_id", "t1.apply_bank_id", "t1.withdrawal_mode_id",
            "COALESCE(t2.withdrawal_channel_id, 0)", "COALESCE(t2.pay_provider_id, 0)"]
    names = ["statistic_time", "user_id", "channel_id", "pay_category_id", "pay_method_id", "pay_channel_id", "pay_provider_id"]
    done = "t1.order_status = 'COMPLETED'"
    return group(
        [f"{k} AS {n}" for k, n in zip(keys, names)],
        [money(f"SUM(TRY_CAST(t2.amount AS {M}))", "withdraw_amount"),
         summed("t1.withdraw_funds_amount", "success_withdraw_amount", done), distinct("t1.user_id", "user_count"),
         distinct("t2.payment_order_no", "withdraw_order_count"), counted(done, "withdraw_success_order_count"),
         "MAX(t1.update_time) AS create_time", "MAX(t1.update_time) AS update_time"],
        f"{orders} t1 LEFT JOIN {payments} t2 ON t2.withdraw_order_no = t1.order_no"
        " AND CAST(t2.update_time AS DATE) = t1.statistic_time",
        "t2.order_status IN ('COMPLETED', 'WITHDRAW_FAIL')", by=keys)


def bounty(daily: bool) -> str:
    keys = ([DAY] if daily else []) + ["user_id", "channel_id"]
    zeros = []
    for g in ("effective_bet", "bet", "punish", "pumped", "profit_loss", "win_loss", "settle"):
        zeros.append(money("0", f"bounty_total_{g}_amount"))
        zeros.append(f"CAST(0 AS {'INT' if g in ('effective_bet', 'bet') else M}) AS bounty_total_{g}_count")
        zeros += [money("0", f"bounty_total_{g}_{s}_amount") for s in _SPLIT]
    return group(keys, zeros, "bounty_event", "update_time IS NOT NULL",
                 by=(["CAST(update_time AS DATE)"] if daily else []) + ["user_id", "channel_id"])


def _window(event_type: str, unit: str) -> str:
    return (f"SELECT date_trunc('{unit}', ts) AS window_start, date_trunc('{unit}', ts) + INTERVAL '1' {unit} AS window_end,"
            f" COUNT(*) AS rows_in_window FROM events WHERE event_type = '{event_type}' GROUP BY 1, 2")


# --- assembly --------------------------------------------------------------------

def _feed(story: str, columns: list[str], drop_deletes: bool) -> str:
    where = " WHERE row_kind <> '-D'" if drop_deletes else ""
    return with_(f"SELECT {', '.join(columns)}, row_kind FROM images{where}", images=D.STORIES[story].images_sql())


def build() -> dict[str, str]:
    R, ST = D.ROWS, D.STORIES
    games = dict(game_record=R["game_record"], clean=clean_games("game_record"))
    daily = dict(**games, daily=user_game_day("clean"))
    recharges = dict(recharge_order=R["recharge_order"], clean=CLEAN_RECHARGE)
    withdrawals = dict(withdraw_order=R["withdraw_order"], clean=clean_withdraw("withdraw_order"))
    amounts = dict(amount_operation=R["amount_operation"], clean=clean_amount("amount_operation"))
    rewards = dict(reward_event=R["reward_event"], clean=CLEAN_REWARD)
    proxies = dict(proxy_statistic=R["proxy_statistic"], clean=CLEAN_PROXY)
    now = lambda story: dict(current=ST[story].current_sql())
    game_now = dict(**now("game_record"), clean=clean_games("current"))
    every = "SELECT * FROM clean"
    out = {
        # cleansed rows
        "dwd_game": with_(every, **games), "dwd_recharge": with_(every, **recharges),
        "dwd_withdraw": with_(every, **withdrawals), "dwd_amount_operation": with_(every, **amounts),
        "dwd_proxy": with_(every, **proxies), "dwd_reward": with_(every, **rewards),
        "user_online": with_(online("online_event"), online_event=R["online_event"]),
        "game_detail": with_(
            "SELECT " + ", ".join(money(n, n) if t == "DECIMAL(19,2)" else n for n, t in S.GAME_RECORD.columns
                                  if n != "game_record_expand_list") + " FROM game_record WHERE order_no IS NOT NULL",
            game_record=R["game_record"]),
        "reward_detail": with_("SELECT id, user_id, channel_id, unique_id, reward_scope, reward_type, activity_type,"
                               " bonus_amount, draw_flag, not_receive_time, receive_time, time_out_time, create_time,"
                               " update_time FROM clean WHERE id IS NOT NULL", **rewards),
        # games
        "dws_user_game_day": with_(user_game_day("clean"), **games),
        "dws_user_game_hour": with_(
            group(["statistic_time", "statistic_hour", "user_id", "channel_id", "game_id", P],
                  [*GAME, summed("-transfer_amount", "profit_and_loss_amount")], "clean"), **games),
        "dws_channel_category": with_(channel_game("clean", "game_category_id"), **games),
        "dws_channel_provider": with_(channel_game("clean", P), **games),
        "dws_channel_game": with_(channel_game("clean"), **games),
        "dws_channel_game_levels": with_(
            " UNION ALL ".join(
                f"SELECT '{level}' AS level, statistic_time, channel_id, {cat} AS game_category_id, {prov} AS {P},"
                f" * EXCLUDE (statistic_time, channel_id{ex}) FROM ({channel_game('clean', *more)})"
                for level, cat, prov, ex, more in (
                    ("category", "game_category_id", "NULL", ", game_category_id", ["game_category_id"]),
                    ("provider", "NULL", P, f", {P}", [P]), ("channel", "NULL", "NULL", "", []))), **games),
        "ads_user_game_day": with_(player("daily", True), **daily),
        "ads_user_game_total": with_(player("daily", False), **daily),
        # adjustments, recharges, rewards, agents, withdrawals
        "dws_user_adjust": with_(user_adjust("clean"), **amounts),
        "dws_channel_adjust": with_(channel_adjust("clean"), **amounts),
        "dws_user_recharge": with_(USER_RECHARGE, **recharges),
        "dws_channel_recharge": with_(CHANNEL_RECHARGE, **recharges),
        "dws_user_reward": with_(USER_REWARD, **rewards),
        "dws_channel_reward": with_(CHANNEL_REWARD, **rewards),
        "dws_channel_activity": with_(CHANNEL_ACTIVITY, **rewards),
        "ads_user_reward_day": with_(reward_totals(True), **rewards),
        "ads_user_reward_total": with_(reward_totals(False), **rewards),
        "dws_channel_proxy": with_(channel_proxy("clean"), **proxies),
        "dws_user_withdraw": with_(user_withdraw("clean"), **withdrawals),
        "dws_channel_withdraw": with_(channel_withdraw("clean"), **withdrawals),
        "dws_withdraw_finance": with_(finance("clean", "payment_order"), **withdrawals, payment_order=R["payment_order"]),
        "ads_user_bounty_day": with_(bounty(True), bounty_event=R["bounty_event"]),
        "ads_user_bounty_total": with_(bounty(False), bounty_event=R["bounty_event"]),
        # lookup
        "dim_device_lookup": with_(
            "SELECT e.event_id, e.uid AS user_id, CASE WHEN e.uid IS NULL THEN 'unknown' WHEN d.user_id IS NULL THEN"
            " 'no_device' ELSE 'device_id: ' || d.device_id END AS \"dimensionInfo\" FROM (SELECT event_id, CASE WHEN"
            " event_type = 'error' THEN NULL ELSE user_id END AS uid FROM events) e LEFT JOIN (SELECT user_id,"
            " MIN(device_id) AS device_id FROM devices GROUP BY user_id) d ON d.user_id = e.uid",
            devices=R["device_users"]),
        # raw feeds over change streams
        "ods_game": _feed("game_record", S.GAME_RECORD.names, True),
        "ods_recharge": _feed("recharge_order", S.RECHARGE_ORDER.names, False),
        "ods_withdraw": _feed("withdraw_order", S.WITHDRAW_ORDER.names, True),
        "ods_third_payment": _feed("payment_order", S.PAYMENT_ORDER.names, True),
        "ods_amount_operation": _feed("amount_operation", [
            "id", "user_id", "type", "amount_type", "amount", "balance", "status", "create_by", "update_by",
            "create_time", "update_time", "channel_id"], False),
        "ods_proxy": _feed("proxy_statistic", S.USER_PROXY_STATISTIC.names, False),
        "ods_device_users": _feed("device_users", S.DEVICE_USERS.names, True),
        # change streams
        "changelog_signed": with_("SELECT * FROM images", images=ST["game_record"].images_sql()),
        "changelog_filter": with_(clean_games("images", "row_kind, _sign, "), images=ST["game_record"].images_sql()),
        "changelog_replace": with_(
            "SELECT CASE WHEN _sign = 1 THEN 'c' ELSE 'd' END AS op, id, user_id, status, bet_amount, update_time FROM images",
            images=ST["game_record"].images_sql()),
        "changelog_split": with_(
            "SELECT 'amount_operation_record' AS table_name, row_kind, COUNT(*) AS images, COUNT(DISTINCT id) AS ids FROM a GROUP BY row_kind"
            " UNION ALL SELECT 'device_users_relations_flat', row_kind, COUNT(*), COUNT(DISTINCT id) FROM b GROUP BY row_kind",
            a=ST["amount_operation"].images_sql(), b=ST["device_users"].images_sql()),
        "latest_image": with_("SELECT * FROM current", **now("game_record")),
        "latest_image_of_pairs": with_("SELECT * FROM current", **now("game_record")),
        "latest_version": with_(
            "SELECT id, user_id, bet_amount, update_time FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY"
            " update_time DESC, game_id DESC, bet_amount DESC, bet_deposit_amount DESC, bet_no DESC, settle_withdrawal_amount DESC) AS n FROM game_record) WHERE n = 1",
            game_record=R["game_record"]),
        "retract_user_game_day": with_(user_game_day("clean"), **game_now),
        "retract_channel_game": with_(channel_game("clean"), **game_now),
        "retract_user_adjust": with_(user_adjust("clean"), **now("amount_operation"), clean=clean_amount("current")),
        "retract_user_withdraw": with_(user_withdraw("clean"), **now("withdraw_order"), clean=clean_withdraw("current")),
        "retract_withdraw_finance": with_(
            finance("clean", "payments"), **now("withdraw_order"), clean=clean_withdraw("current"),
            payments=ST["payment_order"].current_sql()),
        "ads_user_game_total_of_games": with_(player("daily", False), **daily),
        # streams
        "stream_user_game_day": with_(user_game_day("clean"), **game_now),
        "stream_user_game_hour": with_(
            group(["statistic_time", "statistic_hour", "user_id", "channel_id", "game_id", P],
                  [*GAME, summed("-transfer_amount", "profit_and_loss_amount")], "clean"), **game_now),
        "stream_channel_category": with_(channel_game("clean", "game_category_id"), **game_now),
        "stream_channel_provider": with_(channel_game("clean", P), **game_now),
        "stream_channel_game": with_(channel_game("clean"), **game_now),
        "stream_player_day": with_(player("daily", True), **game_now, daily=user_game_day("clean")),
        "stream_player_day_of_text": with_(player("daily", True), **game_now, daily=user_game_day("clean")),
        "stream_user_game_total": with_(player("daily", False), **game_now, daily=user_game_day("clean")),
        "stream_game_detail": with_(
            "SELECT " + ", ".join(money(n, n) if t == "DECIMAL(19,2)" else n for n, t in S.GAME_RECORD.columns
                                  if n != "game_record_expand_list") + " FROM current WHERE order_no IS NOT NULL",
            **now("game_record")),
        "stream_running_total": with_(player("daily", False), **game_now, daily=user_game_day("clean")),
        "stream_channel_distinct": with_(
            "SELECT statistic_time, channel_id, COUNT(DISTINCT user_id) AS user_count FROM clean GROUP BY 1, 2", **game_now),
        "stream_user_adjust": with_(user_adjust("clean"), **now("amount_operation"), clean=clean_amount("current")),
        "stream_mirror": with_("SELECT * FROM current", **now("device_users")),
        "stream_snapshot_mirror": with_("SELECT * FROM current", **now("device_users")),
        "dwd_game_changes": with_(every, **game_now),
        "stream_sharded_game": with_(
            "SELECT * REPLACE (id // 3 AS id, CASE WHEN id % 3 <> 2 THEN game_name_code END AS game_name_code),"
            " 'game_record_' || CAST(id % 3 AS VARCHAR) AS _shard FROM current", **now("game_record")),
        "stream_corrupt_events": with_(
            "SELECT event_id, CASE WHEN k % 7 = 0 THEN NULL ELSE user_id END AS user_id, k % 7 = 0 AS corrupt FROM e",
            e="SELECT event_id, user_id, {K} AS k FROM events"),
        "stream_online_of_two": with_(
            "SELECT * EXCLUDE (place, pos) FROM o WHERE user_id IS NOT NULL AND create_time IS NOT NULL"
            " QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, create_time ORDER BY place DESC, pos DESC) = 1",
            online_event=R["online_event"],
            e="SELECT *, CAST(substr(token, 2) AS BIGINT) AS id, CAST(split_part(ip, '.', 4) AS INT) AS n FROM online_event",
            records="SELECT * REPLACE ('again-' || token AS token), id * 10 + CASE WHEN n % 5 < 2 THEN 3 ELSE -3 END AS place"
                 " FROM e WHERE n % 3 <> 1 UNION ALL SELECT *, id * 10 AS place FROM e WHERE n % 3 <> 0",
            o=online("records").replace(" FROM", ", place, id AS pos FROM")),
        "stream_window_1h": with_(
            "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL '1' HOUR AS window_end,"
            " COUNT(*) AS rows_in_window FROM p, m WHERE NOT late OR date_trunc('hour', ts) + INTERVAL '1' HOUR > mark"
            " GROUP BY 1, 2, closed HAVING date_trunc('hour', ts) + INTERVAL '1' HOUR <= closed",
            e="SELECT ts, {K} % 10 = 3 AS late, epoch(ts) // 1 AS s FROM events WHERE event_type = 'purchase'",
            # the watermark that drops rows lags one batch behind: late rows come in the fourth file, it has seen two
            p="SELECT *, CAST(least(2, floor(3 * (s - (SELECT min(s) FROM e)) / greatest(1, (SELECT max(s) - min(s) FROM e)))) AS INT) AS f FROM e",
            m="SELECT max(ts) FILTER (NOT late AND f < 2) - INTERVAL '10' MINUTE AS mark,"
              " max(ts) - INTERVAL '10' MINUTE AS closed FROM p"),
        "window_login_1m": _window("signup", "minute"), "window_order_1h": _window("purchase", "hour"),
        "stream_withdraw_finance": with_(
            finance("clean", "payments"), **now("withdraw_order"), clean=clean_withdraw("current"),
            payments=ST["payment_order"].current_sql()),
        "corrupt_events": with_(
            "SELECT event_id, CASE WHEN k % 7 = 0 THEN NULL ELSE user_id END AS user_id, k % 7 = 0 AS corrupt FROM e",
            e="SELECT event_id, user_id, {K} AS k FROM events"),
        "not_null_key": with_(
            "SELECT id, order_no, create_time, bet_amount FROM game_record WHERE order_no IS NOT NULL AND create_time IS NOT NULL",
            game_record=R["game_record"]),
    }
    for name in S.DIMENSIONS:
        story = ST[f"dim_{name}"]
        columns = [c for c in story.table.names if c != "password"]
        out[f"dim_{name}"] = with_(f"SELECT {', '.join(columns)} FROM current", **now(f"dim_{name}"))
    return out
