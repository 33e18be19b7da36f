"""Business tables derived from generic order, item and event tables.

The library's own inputs (games, recharges, withdrawals, rewards, ...) are not
part of the given data, so the checks derive them, row for row, from the given
tables.  Each derivation is one SELECT that both Spark and a plain SQL engine
can run; the few functions the two spell differently are filled in by
``dialect``.  Columns no report reads get a value by a rule on their type.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from retally import schemas as S
from retally.schemas import Table

SPARK = {
    "K": "CAST(get_json_object(props, '$.k') AS INT)",
    "ISO": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "T0": "CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ)",
    "D0": "CAST('2024-01-01' AS DATE)",
}
PLAIN = {
    "K": "CAST(json_extract_string(props, '$.k') AS INTEGER)",
    "ISO": "strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    "T0": "TIMESTAMP '2024-01-01 00:00:00'",
    "D0": "DATE '2024-01-01'",
}
TABLES = ("customer", "orders", "lineitem", "part", "events")


def dialect(sql: str, words: dict[str, str]) -> str:
    for name, text in words.items():
        sql = sql.replace("{" + name + "}", text)
    return sql


def projection(table: Table, base: str, stamp: str, **given: str) -> str:
    """Select list for all columns of ``table``: the given expressions, else a rule by type."""
    cells = []
    for i, (name, type) in enumerate(table.columns):
        if name in given:
            cell = given[name]
        elif type == "BIGINT":
            cell = f"CAST(({base}) + {i} AS BIGINT)"
        elif type in ("INT", "TINYINT"):
            cell = f"CAST(({base}) % {2 if type == 'TINYINT' else i + 3} AS {type})"
        elif type.startswith("DECIMAL"):
            cell = f"CAST(CAST((({base}) % 1000) + {i} AS DECIMAL(12,2)) * CAST(0.25 AS DECIMAL(3,2)) AS {type})"
        elif type == "STRING":
            cell = f"'{name}-' || CAST(({base}) % 97 AS STRING)"
        elif type == "DATE":
            cell = f"CAST({stamp} AS DATE)"
        elif type == "TIMESTAMP_NTZ":
            cell = f"({stamp}) + {i} * INTERVAL '1' MINUTE"
        else:
            raise ValueError(type)
        cells.append(f"{cell} AS {name}")
    return ",\n  ".join(cells)


_EVENTS = "(SELECT event_id, ts, user_id, event_type, value, {K} AS k, {ISO} AS iso FROM events) e"
_ORDERS = "orders JOIN customer ON o_custkey = c_custkey"


def _money(x: str, t: str = "DECIMAL(19,2)") -> str:
    return f"CAST({x} AS {t})"


_PRICE, _RETAIL = _money("l_extendedprice"), _money("p_retailprice")
_TAX100 = f"CAST({_money('l_tax')} * 100 AS DECIMAL(19,2))"
_ITEM_TIME = "l_shipdate + (CAST(l_quantity AS INT) % 24) * INTERVAL '1' HOUR"

_GAME = projection(
    S.GAME_RECORD, "l_orderkey", "l_shipdate",
    id="l_orderkey * 10 + l_linenumber", user_id="o_custkey", channel_id="CAST(c_nationkey AS BIGINT)",
    game_id="l_partkey", game_category_id="CAST(p_size AS BIGINT)", third_platform_provider_type="p_brand",
    order_no="CASE WHEN l_quantity = 50 AND l_linenumber = 7 THEN NULL ELSE l_orderkey * 10 + l_linenumber END",
    status="CASE WHEN l_linestatus = 'F' THEN 'settle' ELSE 'bet' END",
    effective_bet_flag="CAST(CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE CASE WHEN l_linenumber = 1 THEN NULL ELSE 1 END END AS TINYINT)",
    bet_amount=_PRICE, settle_amount=_RETAIL, transfer_amount=f"CAST({_RETAIL} - {_PRICE} AS DECIMAL(19,2))",
    bet_deposit_amount=_money("l_quantity"), bet_withdrawal_amount=_money("l_linenumber"),
    bet_bonus_amount=f"CASE WHEN l_tax = 0 THEN NULL ELSE {_TAX100} END",
    settle_deposit_amount=_money("l_quantity * 2"), settle_withdrawal_amount=_TAX100,
    settle_bonus_amount=_money("l_linenumber"),
    transfer_deposit_amount=_money("l_quantity"),
    transfer_withdrawal_amount=f"CAST({_TAX100} - {_money('l_linenumber')} AS DECIMAL(19,2))",
    transfer_bonus_amount="CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(0 AS DECIMAL(19,2)) END",
    valid_bet_amount=_PRICE, valid_bet_deposit_amount=_money("l_quantity"),
    valid_bet_withdrawal_amount=_money("l_linenumber"), valid_bet_bonus_amount=_TAX100,
    create_time="o_orderdate", update_time=_ITEM_TIME)

_TOTAL = _money("o_totalprice", "DECIMAL(20,4)")
_RECHARGE = dict(
    id="o_orderkey", order_no="o_orderkey", user_id="o_custkey", channel_id="CAST(c_nationkey AS BIGINT)",
    order_status="CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'cancel' ELSE 'failed' END",
    pay_status="CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending_payment' ELSE"
               " CASE WHEN o_orderkey % 2 = 0 THEN 'payment_failed' ELSE 'payment_timeout' END END",
    pay_category_id="CAST(SUBSTR(o_orderpriority, 1, 1) AS BIGINT)", pay_method_id="CAST(o_orderkey % 4 AS BIGINT)",
    pay_channel_id="CAST(o_orderkey % 3 AS BIGINT)", pay_provider_id="CAST(o_orderkey % 2 AS BIGINT)",
    first_recharge="CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS TINYINT)",
    order_amount=_TOTAL, actual_recharge_amount=_TOTAL,
    actual_handling_fee="CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS DECIMAL(20,4)) END",
    create_time="o_orderdate", update_time="o_orderdate")
_WITHDRAW = dict(
    id="o_orderkey", order_no="o_orderkey", user_id="o_custkey", channel_id="CAST(c_nationkey AS BIGINT)",
    order_status="CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'REJECTED' ELSE 'PENDING' END",
    withdraw_funds_amount=_TOTAL, apply_bank_id="CAST(o_orderkey % 6 AS BIGINT)",
    withdrawal_mode_id="CAST(o_orderkey % 3 AS BIGINT)", withdrawal_channel_id="CAST(o_orderkey % 4 AS BIGINT)",
    pay_provider_id="CAST(o_orderkey % 2 AS BIGINT)",
    first_withdrawal_flag="CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS TINYINT)",
    create_time="o_orderdate", update_time="o_orderdate")
_PAYMENT = projection(
    S.PAYMENT_ORDER, "l_orderkey", "o_orderdate",
    id="l_orderkey * 10 + l_linenumber", withdraw_order_no="l_orderkey", payments_number="l_linenumber",
    payment_order_no="CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    amount=f"CASE WHEN l_discount = 0.1 AND l_tax = 0 THEN 'n/a' ELSE CAST({_money('l_extendedprice', 'DECIMAL(20,4)')} AS STRING) END",
    withdrawal_channel_id="CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END",
    pay_provider_id="CASE WHEN l_linenumber = 2 THEN NULL ELSE l_suppkey % 3 END",
    order_status="CASE l_returnflag WHEN 'A' THEN 'COMPLETED' WHEN 'R' THEN 'WITHDRAW_FAIL' ELSE 'PENDING' END",
    update_time="o_orderdate + (l_linenumber % 2) * INTERVAL '1' DAY")
_AMOUNT = dict(
    id="event_id", user_id="user_id", channel_id="user_id % 7",
    type="CASE WHEN k % 2 = 0 THEN 'INCREASE' ELSE 'REDUCE' END",
    amount_type="CASE k % 3 WHEN 0 THEN 'WITHDRAW' WHEN 1 THEN 'DEPOSIT' ELSE 'BONUS' END",
    amount="CAST(value AS DECIMAL(19,4))", status="CASE WHEN event_type = 'error' THEN 'PENDING' ELSE 'COMPLETE' END",
    create_time="ts", update_time="ts + (k % 2) * INTERVAL '1' DAY")
_PROXY = dict(
    id="o_orderkey", user_id="o_custkey", channel_id="CAST(c_nationkey AS BIGINT)",
    statistic_time="CAST(o_orderdate AS DATE)",
    direct_bet_rebate_amount="CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 3 AS DECIMAL(20,4)) END",
    direct_recharge_rebate_amount="CAST(o_orderkey % 2 AS DECIMAL(20,4))",
    teams_bet_rebate_amount="CAST(0 AS DECIMAL(20,4))", teams_recharge_rebate_amount="CAST(0 AS DECIMAL(20,4))",
    betting_rebate_count="CAST(o_orderkey % 3 AS INT)", recharge_rebate_count="CAST(o_orderkey % 2 AS INT)",
    effective_bet_amount=_TOTAL, create_time="o_orderdate", update_time="o_orderdate")

_REWARD = projection(
    S.REWARD_EVENT, "event_id", "ts",
    id="event_id", user_id="user_id", channel_id="user_id % 7", unique_id="event_id % 2000",
    reward_scope="CASE event_type WHEN 'click' THEN 'VIP_REWARD' WHEN 'view' THEN 'REBATE_REWARD' WHEN 'purchase'"
                 " THEN 'ACTIVITY_REWARD' WHEN 'signup' THEN 'BONUS_TASK' ELSE"
                 " CASE WHEN k % 10 = 9 THEN 'OTHER' ELSE 'TOURIST_TRIAL_BONUS' END END",
    reward_type="CASE k % 3 WHEN 0 THEN 'WITHDRAW' WHEN 1 THEN 'DEPOSIT' ELSE 'BONUS' END",
    activity_type="CASE WHEN k % 11 = 0 THEN NULL ELSE 'ACT' || CAST(k % 4 AS STRING) END",
    draw_flag="CASE WHEN k % 13 = 0 THEN NULL ELSE k % 2 = 1 END",
    bonus_amount="CAST(value AS DECIMAL(20,4))", create_time="ts", update_time="ts")
_DEVICE = dict(id="event_id", device_id="'D' || CAST(k AS STRING)", user_id="user_id * 2",
               create_time="ts", update_time="ts")
_ONLINE = projection(
    S.ONLINE_EVENT, "event_id", "ts", user_id="user_id", ip="'10.0.0.' || CAST(k AS STRING)",
    device_id="'D' || CAST(k AS STRING)",
    online_time="CASE WHEN event_type = 'error' THEN 'not a time' ELSE iso END", create_time="iso",
    token="'t' || CAST(event_id AS STRING)",
    session_id="CASE WHEN k < 20 THEN NULL ELSE 's' || CAST(event_id AS STRING) END")
_BOUNTY = projection(S.BOUNTY_EVENT, "event_id", "ts", id="event_id", user_id="user_id", channel_id="user_id % 7",
                     create_time="ts", update_time="CASE WHEN k = 0 THEN NULL ELSE ts END")

ROWS: dict[str, str] = {
    "game_record": f"SELECT {_GAME} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
                   " JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey",
    "recharge_order": f"SELECT {projection(S.RECHARGE_ORDER, 'o_orderkey', 'o_orderdate', **_RECHARGE)} FROM {_ORDERS}",
    "withdraw_order": f"SELECT {projection(S.WITHDRAW_ORDER, 'o_orderkey', 'o_orderdate', **_WITHDRAW)} FROM {_ORDERS}",
    "payment_order": f"SELECT {_PAYMENT} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "amount_operation": f"SELECT {projection(S.AMOUNT_OPERATION, 'event_id', 'ts', **_AMOUNT)} FROM {_EVENTS}",
    "proxy_statistic": f"SELECT {projection(S.USER_PROXY_STATISTIC, 'o_orderkey', 'o_orderdate', **_PROXY)} FROM {_ORDERS}",
    "reward_event": f"SELECT {_REWARD} FROM {_EVENTS}",
    "online_event": f"SELECT {_ONLINE} FROM {_EVENTS}",
    "bounty_event": f"SELECT {_BOUNTY} FROM {_EVENTS}",
    "device_users": f"SELECT {projection(S.DEVICE_USERS, 'event_id', 'ts', **_DEVICE)} FROM {_EVENTS}",
}


@dataclass(frozen=True)
class Story:
    """Changes of a table, each made from one source row alone.

    A row is created with the first projection; where ``edited`` holds it is
    updated to the second, where ``edited_again`` holds to the third, and where
    ``removed`` holds it is deleted at the end.
    """

    table: Table
    source: str                 # FROM clause
    versions: tuple[str, str, str]
    ident: str                  # number of the source row, gives positions
    edited: str = "TRUE"
    edited_again: str = "FALSE"
    removed: str = "FALSE"
    first_op: str = "c"
    extra: dict = field(default_factory=dict)

    # plain SQL, for checking -------------------------------------------------

    def _final(self, version: int) -> str:
        conditions = {0: f"NOT ({self.edited}) AND NOT ({self.edited_again})",
                      1: f"({self.edited}) AND NOT ({self.edited_again})", 2: f"({self.edited_again})"}
        return conditions[version]

    def current_sql(self) -> str:
        """The table after all changes."""
        return " UNION ALL ".join(
            f"SELECT {self.versions[v]} FROM {self.source} WHERE {self._final(v)} AND NOT ({self.removed})"
            for v in range(3))

    def images_sql(self) -> str:
        """All images: row_kind, _sign and the columns."""
        part = lambda v, kind, sign, cond: (
            f"SELECT '{kind}' AS row_kind, {sign} AS _sign, {self.versions[v]} FROM {self.source} WHERE {cond}")
        again_from = f"({self.edited_again}) AND ({self.edited})", f"({self.edited_again}) AND NOT ({self.edited})"
        pieces = [part(0, "+I", 1, "TRUE"), part(0, "-U", -1, self.edited), part(1, "+U", 1, self.edited),
                  part(1, "-U", -1, again_from[0]), part(0, "-U", -1, again_from[1]),
                  part(2, "+U", 1, self.edited_again)]
        pieces += [part(v, "-D", -1, f"({self.removed}) AND {self._final(v)}") for v in range(3)]
        return " UNION ALL ".join(pieces)

    # Spark -------------------------------------------------------------------

    def changes(self, source: DataFrame, where: str = "TRUE") -> DataFrame:
        """Changes (before, after, op, ts_ms, pos) of the rows of ``source``; row by row, so it runs on a stream.

        Only those whose place (``ts_ms``, ``pos``) fulfils ``where``: images of others are not made.
        """
        edited, again, removed = (F.expr(dialect(c, SPARK)) for c in (self.edited, self.edited_again, self.removed))
        at = lambda i: F.expr(re.sub(r"\b(ts_ms|pos)\b", lambda m: f"CAST({self.ident} AS BIGINT)" if m[1] == "ts_ms"
                                     else f"CAST(({self.ident}) * 4 + {i} AS BIGINT)", where))
        created, moved, moved_again, gone = at(0), edited & at(1), again & at(2), removed & at(3)
        # a version is worked out only for the rows that come to it, and where a change here shows it
        shown = (created | moved | ~edited & (moved_again | ~again & gone), moved | edited & (moved_again | ~again & gone),
                 moved_again | again & gone)
        v = [F.when(here, F.expr(f"struct({dialect(p, SPARK)})").cast(self.table.struct))
             for here, p in zip(shown, self.versions)]
        none = F.lit(None).cast(self.table.struct)
        mid = F.when(edited, F.col("v1")).otherwise(F.col("v0"))
        last = F.when(again, F.col("v2")).otherwise(mid)
        ident = F.expr(self.ident)

        def change(i, before, after, op):
            return F.struct(before.alias("before"), after.alias("after"), F.lit(op).alias("op"),
                            ident.cast("bigint").alias("ts_ms"), (ident * 4 + i).cast("bigint").alias("pos"))

        rows = source.withColumns({f"v{i}": c for i, c in enumerate(v)})
        steps = F.array(
            F.when(created, change(0, none, F.col("v0"), self.first_op)),
            F.when(moved, change(1, F.col("v0"), F.col("v1"), "u")),
            F.when(moved_again, change(2, mid, F.col("v2"), "u")),
            F.when(gone, change(3, last, none, "d")))
        return rows.select(F.explode(steps).alias("s")).where(F.col("s").isNotNull()).select("s.*")


def _event_story(table: Table, edits: list[dict], **how) -> Story:
    versions = tuple(projection(table, f"event_id + {7 * i}", "ts", **given) for i, given in enumerate(edits))
    return Story(table, _EVENTS, versions, "event_id", **how)


def _order_story(table: Table, edits: list[dict], **how) -> Story:
    versions = tuple(projection(table, f"o_orderkey + {7 * i}", "o_orderdate", **given) for i, given in enumerate(edits))
    return Story(table, _ORDERS, versions, "o_orderkey", **how)


_BET = dict(
    id="event_id", user_id="user_id", channel_id="user_id % 7", game_id="CAST(k AS BIGINT)",
    game_category_id="CAST(k % 10 AS BIGINT)", third_platform_provider_type="'P' || CAST(k % 5 AS STRING)",
    order_no="event_id", status="'bet'", effective_bet_flag="CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END AS TINYINT)",
    bet_amount=_money("value"), valid_bet_amount=_money("value"), create_time="ts", update_time="ts",
    bet_bonus_amount=f"CASE WHEN k % 4 = 0 THEN NULL ELSE {_money('value')} END")
_SETTLED = {**_BET, "status": "CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'settle' ELSE 'bet' END",
            "update_time": "ts + (k % 3) * INTERVAL '1' DAY"}
# the correction moves a fifth of the bets to another user, channel and day; some go back to unsettled
_CORRECTED = {**_SETTLED, "user_id": "user_id + 1", "channel_id": "(user_id + 1) % 7",
              "status": "CASE WHEN k % 2 = 0 THEN 'settle' ELSE 'bet' END",
              "bet_amount": _money("value + 1"), "update_time": "ts + 4 * INTERVAL '1' DAY"}

_PAID_TRY = dict(
    id="o_orderkey", withdraw_order_no="o_orderkey", payment_order_no="'W' || CAST(o_orderkey AS STRING)",
    amount=f"CAST({_TOTAL} AS STRING)", order_status="'PENDING'", create_time="o_orderdate", update_time="o_orderdate")

_FIXED_DIM_TIME = "{T0} + (c_custkey % 30) * INTERVAL '1' DAY"


def _dimension_story(table: Table) -> Story:
    keys = {k: (_FIXED_DIM_TIME if k.endswith("_time") else "c_custkey") for k in table.key}
    versions = tuple(projection(table, f"c_custkey + {7 * i}", "{T0}", **keys) for i in range(3))
    return Story(table, "customer", versions, "c_custkey", edited="c_nationkey < 8", removed="c_acctbal < 0",
                 first_op="r")


STORIES: dict[str, Story] = {
    "game_record": _event_story(S.GAME_RECORD, [_BET, _SETTLED, _CORRECTED],
                                edited="TRUE", edited_again="k % 5 = 0", removed="k < 10"),
    "amount_operation": _event_story(S.AMOUNT_OPERATION, [{**_AMOUNT, "status": "'PENDING'"}, _AMOUNT,
                                                          {**_AMOUNT, "amount": "CAST(value + 5 AS DECIMAL(19,4))"}],
                                     edited_again="k % 6 = 0", removed="k < 5"),
    "device_users": _event_story(S.DEVICE_USERS, [_DEVICE, {**_DEVICE, "device_id": "'N' || CAST(k AS STRING)"}, _DEVICE],
                                 edited="k % 4 = 0", removed="k < 5"),
    "recharge_order": _order_story(S.RECHARGE_ORDER,
                                   [{**_RECHARGE, "order_status": "'created'", "pay_status": "'pending_payment'"},
                                    _RECHARGE, _RECHARGE], removed="o_orderstatus = 'P'"),
    "withdraw_order": _order_story(S.WITHDRAW_ORDER, [{**_WITHDRAW, "order_status": "'PENDING'"}, _WITHDRAW,
                                                      {**_WITHDRAW, "user_id": "o_custkey + 1"}],
                                   edited_again="o_orderkey % 9 = 0", removed="o_orderstatus = 'P'"),
    "payment_order": _order_story(S.PAYMENT_ORDER, [
        _PAID_TRY, {**_PAID_TRY, "order_status": "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' ELSE 'WITHDRAW_FAIL' END"},
        {**_PAID_TRY, "order_status": "'COMPLETED'", "update_time": "o_orderdate + 1 * INTERVAL '1' DAY"}],
        edited_again="o_orderkey % 13 = 0"),
    "proxy_statistic": _order_story(S.USER_PROXY_STATISTIC, [
        _PROXY, {**_PROXY, "betting_rebate_count": "CAST(o_orderkey % 4 AS INT)"}, _PROXY],
        edited="o_orderkey % 3 = 0", removed="o_orderstatus = 'P'"),
    **{f"dim_{name}": _dimension_story(t) for name, t in S.DIMENSIONS.items()},
}


# --- Spark entry points --------------------------------------------------------

def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in TABLES}


def select(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Run a derivation over the tables of ``folder`` without leaving views behind."""
    text = dialect(sql, SPARK)
    used = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in TABLES if f" {t}" in text}
    for t in used:
        text = text.replace(f"FROM {t}", "FROM {" + t + "}").replace(f"JOIN {t}", "JOIN {" + t + "}")
    return spark.sql(text, **used)


#: The orders meet their customers before the items meet the orders, so the many items are dealt out once less.
ITEMS_OF_ORDERS = ("lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey",
                   "lineitem JOIN (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey) ON l_orderkey = o_orderkey")


def rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return select(spark, folder, ROWS[name].replace(*ITEMS_OF_ORDERS))


#: Bytes of the given files behind one task of a derivation (events: some 25,000 rows, 95 MB of change text).
TASK_BYTES = 1 << 19


def tasks_for(rows: DataFrame) -> int:
    """How many tasks keep their share of ``rows`` bounded, from the size of the files they are read from."""
    spark = rows.sparkSession
    path, hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    size = sum(path(f).getFileSystem(hadoop).getFileStatus(path(f)).getLen() for f in rows.inputFiles())
    return max(1, -(-size // TASK_BYTES))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a key over as many tasks as keep each of them bounded, however few splits their files have."""
    return rows.repartition(tasks_for(rows), key)


def story_changes(spark: SparkSession, folder: str, name: str, tasks: int | None = None, where: str = "TRUE") -> DataFrame:
    """Changes of a table (those ``where`` holds for their place), dealt out by key as a topic with as many partitions as a shuffle has.

    A table with more rows than these hold gets more partitions; ``tasks`` sets their number.
    """
    story = STORIES[name]
    rows = select(spark, folder, f"SELECT * FROM {story.source}")
    tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks_for(rows))
    return story.changes(rows.repartition(tasks, F.expr(story.ident)), where)


def story_tasks(spark: SparkSession, folder: str, name: str) -> int:
    """How many tasks keep the changes of one bounded."""
    return tasks_for(select(spark, folder, f"SELECT * FROM {STORIES[name].source}"))
