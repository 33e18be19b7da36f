"""Table definitions, one place for every layer.

A ``Table`` is a name, the key that identifies a row, and a DDL string.  The
column lists are fixed values: they have to equal the business tables whose
change streams are read, so they are written out plainly.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    ddl: str

    @cached_property
    def columns(self) -> tuple[tuple[str, str], ...]:
        """(name, type) pairs in declared order."""
        parts, depth, start = [], 0, 0
        for i, ch in enumerate(self.ddl):
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 0:
                parts.append(self.ddl[start:i])
                start = i + 1
        parts.append(self.ddl[start:])
        return tuple(tuple(p.split(None, 1)) for p in (q.strip() for q in parts))

    def only(self, names: list[str]) -> Table:
        """The table cut down to some columns, so that text is parsed for those alone."""
        kept = [f"{n} {t}" for n, t in self.columns if n in names]
        return Table(self.name, tuple(k for k in self.key if k in names), ", ".join(kept))

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.columns]

    @cached_property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


def table_of(name: str, key: tuple[str, ...], struct: T.StructType) -> Table:
    """The table of a frame's rows, so that they can be written as change text and read back."""
    return Table(name, key, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in struct))


# --- fixed values: column lists of the source tables -------------------------

GAME_RECORD = Table("game_record", ("id",), """
    id BIGINT, user_id BIGINT, game_id BIGINT, game_category_id BIGINT,
    bet_amount DECIMAL(19,2), settle_amount DECIMAL(19,2), transfer_amount DECIMAL(19,2),
    bet_deposit_amount DECIMAL(19,2), bet_withdrawal_amount DECIMAL(19,2), bet_bonus_amount DECIMAL(19,2),
    effective_bet_flag TINYINT,
    settle_deposit_amount DECIMAL(19,2), settle_withdrawal_amount DECIMAL(19,2), settle_bonus_amount DECIMAL(19,2),
    transfer_deposit_amount DECIMAL(19,2), transfer_withdrawal_amount DECIMAL(19,2), transfer_bonus_amount DECIMAL(19,2),
    third_platform_provider_type STRING, bet_time TIMESTAMP_NTZ, settle_time TIMESTAMP_NTZ,
    status STRING, bet_no STRING, create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ,
    game_name_code STRING, order_no BIGINT, channel_id BIGINT, game_record_expand_list STRING,
    valid_bet_amount DECIMAL(19,2), valid_bet_deposit_amount DECIMAL(19,2),
    valid_bet_withdrawal_amount DECIMAL(19,2), valid_bet_bonus_amount DECIMAL(19,2),
    third_provider_game_code STRING, parent_game_category_id BIGINT, third_provider_game_type BIGINT""")

RECHARGE_ORDER = Table("recharge_order", ("id",), """
    id BIGINT, order_no BIGINT, user_id BIGINT, currency_code STRING, rate_scale DECIMAL(20,4),
    order_amount DECIMAL(20,4), pay_amount DECIMAL(20,4), decrease_handling_fee DECIMAL(20,4),
    handling_fee DECIMAL(20,4), gift_amount DECIMAL(20,4), recharge_amount DECIMAL(20,4),
    actual_handling_fee DECIMAL(20,4), actual_decrease_handling_fee DECIMAL(20,4),
    actual_gift_amount DECIMAL(20,4), actual_recharge_amount DECIMAL(20,4),
    pay_status STRING, order_status STRING, first_recharge TINYINT,
    pay_method_id BIGINT, pay_category_id BIGINT, pay_channel_id BIGINT, pay_provider_id BIGINT,
    recharge_success_time TIMESTAMP_NTZ, create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ,
    update_by STRING, channel_id BIGINT""")

WITHDRAW_ORDER = Table("withdraw_order", ("id",), """
    id BIGINT, order_no BIGINT, user_id BIGINT, channel_id BIGINT, channel STRING,
    withdraw_funds_amount DECIMAL(20,4), balance DECIMAL(20,4), withdrawal_amount DECIMAL(20,4),
    projected_amount DECIMAL(20,4), platform_handling_fee DECIMAL(20,4), final_handling_fee DECIMAL(20,4),
    final_withdraw_funds_amount DECIMAL(20,4), actual_amount DECIMAL(20,4),
    handling_type STRING, handling_mode STRING, handling_detail STRING,
    gift_mode STRING, gift_value DECIMAL(20,4), gift_amount DECIMAL(20,4),
    decrease_handling_mode STRING, decrease_handling_value DECIMAL(20,4), decrease_handling_amount DECIMAL(20,4),
    apply_ip STRING, user_bank_id BIGINT, apply_name STRING, apply_bank_name STRING, apply_bank_id BIGINT,
    apply_bank_card STRING, apply_email STRING, apply_phone STRING,
    order_status STRING, order_status_event STRING, remark STRING, reasons STRING,
    front_remarks STRING, back_remarks STRING, pay_provider_id BIGINT,
    withdrawal_mode_id BIGINT, withdrawal_mode_name STRING,
    withdrawal_channel_id BIGINT, withdrawal_channel_name STRING, withdrawal_channel_bank_code STRING,
    pay_provider_type STRING, payment_order_no STRING, third_party_order_no STRING,
    third_party_handling_fee DECIMAL(20,4), payments_number INT, first_withdrawal_flag TINYINT,
    create_by BIGINT, create_time TIMESTAMP_NTZ, update_by BIGINT, update_time TIMESTAMP_NTZ,
    request_time TIMESTAMP_NTZ, fallback_time TIMESTAMP_NTZ, payout_successful_time TIMESTAMP_NTZ,
    locked_user_id BIGINT, last_audit_user BIGINT, last_audit_time TIMESTAMP_NTZ""")

PAYMENT_ORDER = Table("third_withdraw_payment_order", ("id",), """
    id BIGINT, withdraw_order_no BIGINT, payments_number INT, payment_order_no STRING,
    amount STRING, actual_amount STRING, apply_name STRING, apply_bank_card STRING,
    apply_email STRING, apply_phone STRING, pay_provider_type STRING, third_party_order_no STRING,
    third_party_handling_fee STRING, withdrawal_channel_id BIGINT, withdrawal_channel_bank_code STRING,
    status STRING, trade_status STRING, notify_url STRING, request_param STRING, response_param STRING,
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ, pay_provider_id BIGINT,
    withdrawal_channel_name STRING, order_status STRING, status_reason STRING""")

AMOUNT_OPERATION = Table("amount_operation_record", ("id",), """
    id BIGINT, user_id BIGINT, user_phone STRING, user_email STRING, nick_name STRING,
    type STRING, receive_type STRING, amount_type STRING, reward_title STRING,
    amount DECIMAL(19,4), flow_amount DECIMAL(19,4), balance DECIMAL(19,4), withdraw_balance DECIMAL(19,4),
    deposit_balance DECIMAL(19,4), bonus_balance DECIMAL(19,4), bonus_balance_expire_time TIMESTAMP_NTZ,
    flow_balance DECIMAL(19,4), deposit_flow_balance DECIMAL(19,4), bonus_flow_balance DECIMAL(19,4),
    status STRING, remark STRING, create_by STRING, update_by STRING,
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ, channel_id BIGINT,
    auditor STRING, audit_remark STRING, audit_time TIMESTAMP_NTZ, import_id BIGINT, show_flag TINYINT""")

USER_PROXY_STATISTIC = Table("user_proxy_statistic", ("id",), """
    id BIGINT, user_id BIGINT, channel_id BIGINT, statistic_time DATE,
    direct_bet_rebate_amount DECIMAL(20,4), direct_recharge_rebate_amount DECIMAL(20,4),
    teams_bet_rebate_amount DECIMAL(20,4), teams_recharge_rebate_amount DECIMAL(20,4),
    team_size INT, direct_member INT, valid_direct_member INT,
    transfer_amount DECIMAL(20,4), transfer_count INT, invitation_amount DECIMAL(20,4),
    achievement_amount DECIMAL(20,4), rebate_settlement DECIMAL(20,4),
    betting_rebate_count INT, recharge_rebate_count INT,
    effective_bet_amount DECIMAL(20,4), team_effective_bet_amount DECIMAL(20,4),
    direct_effective_bet_amount DECIMAL(20,4), teams_rebate_amount DECIMAL(20,4),
    obtain_betting_rebate_count INT, obtain_recharge_rebate_count INT,
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ""")

DEVICE_USERS = Table("device_users_relations_flat", ("id",), """
    id BIGINT, device_id STRING, user_id BIGINT,
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ""")

USER_CASH_ACCOUNT = Table("user_cash_account", ("id",), """
    id BIGINT, user_id BIGINT, currency_type STRING,
    freeze_deposit_amount DECIMAL(19,4), freeze_withdrawal_amount DECIMAL(19,4), account_status STRING,
    first_recharge_time TIMESTAMP_NTZ, last_recharge_time TIMESTAMP_NTZ,
    first_withdrawal_time TIMESTAMP_NTZ, last_withdrawal_time TIMESTAMP_NTZ, withdraw_flag TINYINT,
    deposit_amount DECIMAL(19,4), withdrawal_amount DECIMAL(19,4), total_recharge_amount DECIMAL(19,4),
    total_bet_amount DECIMAL(19,4), total_withdrawal_amount DECIMAL(19,4),
    first_recharge_amount DECIMAL(19,4), first_withdrawal_amount DECIMAL(19,4),
    bonus_amount DECIMAL(19,4), freeze_bonus_amount DECIMAL(19,4), bonus_amount_expire_time TIMESTAMP_NTZ,
    deposit_flow_target_amount DECIMAL(19,4), deposit_flow_amount DECIMAL(19,4),
    bonus_flow_target_amount DECIMAL(19,4), bonus_flow_amount DECIMAL(19,4),
    recharge_count INT, withdrawal_count INT,
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ, channel_id BIGINT""")

# global_currency_num is kept at four decimals; an unscaled DECIMAL would lose the fraction.
USER_GLOBAL_CURRENCY_ACCOUNT = Table("user_global_currency_account", ("id",), """
    id BIGINT, channel_id BIGINT, user_id BIGINT, global_currency_num DECIMAL(20,4),
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ, version BIGINT, global_currency_status STRING""")

USER_INFO = Table("user_info", ("id",), """
    id BIGINT, user_id BIGINT, nick_name STRING, user_avatar STRING, user_gender INT, user_age INT,
    vip_level INT, user_education STRING, user_brief STRING, user_date_birth STRING, user_location STRING,
    user_current_ip STRING, remark STRING, create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ,
    invite_code STRING, email_checked INT, update_nick_name_time DATE, update_nick_name_num INT,
    update_sign_num INT, update_sign_time DATE, current_level_recharge_amount DECIMAL(20,4),
    current_level_effective_bet DECIMAL(20,4), hidden_score INT, second_return INT, signature STRING,
    channel_id BIGINT, real_name STRING, bounty_arena_disabled_flag INT, game_valid_bet_calculate_id BIGINT""")

USER_PROXY_ACCOUNT = Table("user_proxy_account", ("id", "create_time"), """
    id BIGINT, user_id BIGINT, channel_id BIGINT, account_status STRING,
    extracted_amount DECIMAL(20,4), withdrawal_amount DECIMAL(20,4), pending_settlement_amount DECIMAL(20,4),
    user_proxy_level BIGINT, total_user_proxy_effective_bet_amount DECIMAL(20,4),
    total_transfer_amount DECIMAL(20,4), total_effective_bet_amount DECIMAL(20,4),
    total_team_effective_bet_amount DECIMAL(20,4), total_direct_effective_bet_amount DECIMAL(20,4),
    total_direct_bet_rebate_amount DECIMAL(20,4), total_direct_recharge_rebate_amount DECIMAL(20,4),
    total_teams_bet_rebate_amount DECIMAL(20,4), total_teams_recharge_rebate_amount DECIMAL(20,4),
    transfer_count BIGINT, betting_rebate_count BIGINT, recharge_rebate_count BIGINT,
    total_user_invitations_amount DECIMAL(20,4), total_user_achievement_amount DECIMAL(20,4),
    affiliation BIGINT, agent_activation_time TIMESTAMP_NTZ, version BIGINT,
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ""")

USER_RELATIONS = Table("user_relations", ("id", "create_time"), """
    id BIGINT, distance INT, ancestor_user_id BIGINT, ancestor_channel_id BIGINT,
    descendant_user_id BIGINT, descendant_channel_id BIGINT, invite_Code STRING,
    recharge_rebate_amount DECIMAL(20,4), bet_rebate_amount DECIMAL(20,4), rebate_amount DECIMAL(20,4),
    effective_time TIMESTAMP_NTZ, betting_rebate_count INT, recharge_rebate_count INT,
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ""")

USER = Table("user", ("user_id", "register_time"), """
    id BIGINT, user_id BIGINT, user_phone STRING, password STRING, register_ip STRING,
    register_device_id STRING, user_country STRING, user_status INT, register_time TIMESTAMP_NTZ,
    update_time TIMESTAMP_NTZ, user_email STRING, phone_area_code STRING, freeze_time TIMESTAMP_NTZ,
    test_flag INT, app_channel STRING, register_source_value STRING, register_source_type STRING,
    abs_id BIGINT, channel_id BIGINT, register_method STRING, last_login_ip STRING,
    last_login_time TIMESTAMP_NTZ, last_login_device_id STRING, user_type INT, tourist_name STRING,
    tourist_must_bind_user INT""")

# payloads of the application's own JSON events (envelope: key, dataSyncType, jsonData)
REWARD_EVENT = Table("reward_record", ("unique_id", "update_time"), """
    id BIGINT, user_id BIGINT, channel_id BIGINT, unique_id BIGINT, reward_scope STRING, reward_type STRING,
    activity_type STRING, bonus_amount DECIMAL(20,4), draw_flag BOOLEAN,
    not_receive_time TIMESTAMP_NTZ, receive_time TIMESTAMP_NTZ, time_out_time TIMESTAMP_NTZ,
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ""")

ONLINE_EVENT = Table("user_online_status_record", ("user_id", "create_time"), """
    user_id BIGINT, ip STRING, device_id STRING, online_time STRING, create_time STRING,
    token STRING, session_id STRING""")

BOUNTY_EVENT = Table("bounty_record", ("key",), """
    id BIGINT, user_id BIGINT, channel_id BIGINT, bounty_order_no STRING,
    bet_amount DECIMAL(20,4), settle_amount DECIMAL(20,4), win_loss_amount DECIMAL(20,4),
    punish_amount DECIMAL(20,4), pumped_amount DECIMAL(20,4), profit_loss_amount DECIMAL(20,4),
    bet_deposit_amount DECIMAL(20,4), bet_withdrawal_amount DECIMAL(20,4), bet_bonus_amount DECIMAL(20,4),
    settle_deposit_amount DECIMAL(20,4), settle_withdrawal_amount DECIMAL(20,4), settle_bonus_amount DECIMAL(20,4),
    create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ""")

# --- end of fixed values ------------------------------------------------------

DIMENSIONS = {t.name: t for t in (
    USER_CASH_ACCOUNT, USER_GLOBAL_CURRENCY_ACCOUNT, USER_INFO, USER_PROXY_ACCOUNT,
    USER_PROXY_STATISTIC, USER_RELATIONS, USER)}

CDC_TABLES = {t.name: t for t in (
    GAME_RECORD, RECHARGE_ORDER, WITHDRAW_ORDER, PAYMENT_ORDER, AMOUNT_OPERATION,
    DEVICE_USERS, *DIMENSIONS.values())}
