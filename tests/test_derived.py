"""Derived tables scale with their source: tasks of bounded size, items dealt out no more often than needed."""

from pyspark.sql import functions as F

from retally.sources import derived as D

SMALL = "/root/testdata/sf0.001"


def test_orders_meet_their_customers_before_the_items_meet_them(spark):
    """the joined items are not dealt out again by customer."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.rows(spark, SMALL, "game_record")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        by_customer = plan[plan.index("hashpartitioning(o_custkey"):]
        # below the exchange by customer there are orders alone
        assert "l_orderkey" not in by_customer.split("hashpartitioning(c_custkey")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_events_of_one_split_are_spread(spark, monkeypatch):
    """the rows of one file split are encoded and grouped by as many tasks as keep each bounded."""
    from checks import queries

    monkeypatch.setattr(D, "TASK_BYTES", 4096)
    assert D.rows(spark, SMALL, "reward_event").rdd.getNumPartitions() == 1
    assert queries.CLEAN["rewards"](spark, SMALL).rdd.getNumPartitions() == D.tasks_for(D.rows(spark, SMALL, "reward_event")) > 4


def test_change_text_is_dealt_anew_by_size(spark, monkeypatch):
    """the number of tasks that read change text grows with the table."""
    from checks import queries

    monkeypatch.setattr(D, "TASK_BYTES", 4096)
    tasks = D.story_tasks(spark, SMALL, "game_record") + 1
    plan = queries.build()["latest_image_of_pairs"](spark, SMALL)._jdf.queryExecution().toString()
    assert tasks > 5 and f"RoundRobinPartitioning({tasks})" in plan


def test_a_step_of_change_text_has_its_changes_alone(spark, small):
    from checks import streams
    from retally.sources import derived, envelope

    for story in ("game_record", "withdraw_order"):
        changes = derived.story_changes(spark, small, story).withColumn("file", F.expr(streams.BY_STEP))
        text = envelope.encode_changes(changes, derived.STORIES[story].table, replace_updates=False, also=["file"])
        of_step = streams.change_text(spark, small, story)
        for step in range(streams.FILES):
            want, got = text.where(F.col("file") == step).select("value"), of_step(step)
            assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
