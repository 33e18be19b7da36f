import pytest
from pyspark.sql import functions as F, types as T

from retally.sinks import jdbc
from retally.sinks.batch_log import BatchLog, workspace
from retally.sinks.keyed_table import KeyedTable, NotNullKey

ROW = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
CHANGE = T.StructType([T.StructField("before", ROW), T.StructField("after", ROW), T.StructField("op", T.StringType())])
PLACED = T.StructType(CHANGE.fields + [T.StructField("ts_ms", T.LongType()), T.StructField("pos", T.LongType())])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_batch_again_replaces_itself(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), ROW)
    assert log.read().count() == 0
    df = spark.createDataFrame([("a", 1), ("b", 2)], ROW)
    log.write(0, df)
    log.write(1, df)
    log.write(1, df.limit(1))
    assert log.read().count() == 3 and log.read(before=1).count() == 2 and log.one(1).count() == 1


def test_unfinished_batch_is_not_read(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), ROW)
    log.write(0, spark.createDataFrame([("a", 1)], ROW))
    (tmp_path / "log" / "part" / "batch=1").mkdir()
    assert log.read().count() == 1


def test_base_takes_the_place_of_its_batches(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), ROW, cluster=["k"])
    add = lambda d: d.groupBy("k").agg(F.sum("n").cast("int").alias("n"))
    for b in range(4):
        log.write(b, spark.createDataFrame([("a", 1), ("b", b)], ROW))
        log.compact(b, add, every=3)
    assert log.read().count() == 4              # a base of batches 0-2, then batch 3
    assert rows(add(log.read())) == [("a", 4), ("b", 6)]
    assert rows(add(log.read(before=2))) == [("a", 2), ("b", 1)]      # still there for a batch that runs again


def test_keyed_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ROW, ["k"])
    frame = lambda *c: spark.createDataFrame(list(c), CHANGE)
    table.write(0, frame((None, ("a", 1), "c"), (None, (None, 5), "c"), (None, ("b", 2), "c")))
    table.write(1, frame((("a", 1), ("a", 9), "u"), (("b", 2), None, "d")))
    table.write(1, frame((("a", 1), ("a", 9), "u"), (("b", 2), None, "d")))
    table.write(2, frame(((None, 5), (None, 6), "u")))
    key = lambda df: {r.k: r.n for r in df.collect()}
    assert key(table.current()) == {"a": 9, None: 6}
    assert key(table.current(before=1)) == {"a": 1, None: 5, "b": 2}
    some = spark.createDataFrame([(None,), ("b",)], "k STRING")
    assert key(table.current(keys=some)) == {None: 6}
    assert table.compact(2, every=3)
    assert key(table.current()) == {"a": 9, None: 6}


def test_late_change_does_not_win_nor_bring_a_row_back(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ROW, ["k"], keep_deleted=True)
    frame = lambda *c: spark.createDataFrame(list(c), PLACED)
    table.write(0, frame((None, ("a", 2), "u", 5, 2), (("b", None), None, "d", 5, 9)))
    assert table.compact(0, every=1)
    table.write(1, frame((None, ("a", 1), "u", 5, 1), (None, ("b", 1), "u", 5, 3)))
    assert [tuple(r) for r in table.current().collect()] == [("a", 2)]


def test_deletes_are_forgotten_when_no_older_change_can_come(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ROW, ["k"], late=10)
    frame = lambda *c: spark.createDataFrame(list(c), PLACED)
    put = lambda k, n, at: (None, (k, n), "u", at, 0)
    drop = lambda k, at: ((k, None), None, "d", at, 0)
    stored = lambda: sorted((r.k, r.n) for r in table.current().collect())
    table.write(0, frame(put("a", 1, 100), put("b", 1, 100), put("c", 1, 100), drop("x", 90)))
    table.write(1, frame(drop("a", 104), drop("b", 120)))
    assert table.compact(1, every=2)
    # the watermark stands at 110: the deletes of a and x cannot be undone any more, that of b can
    assert table.log.read().where("op = 'd'").selectExpr("before.k").collect() == [("b",)]
    table.write(2, frame(put("a", 2, 103), put("b", 2, 115), put("x", 2, 89), put("d", 5, 111), put("c", 7, 109)))
    assert stored() == [("c", 1), ("d", 5)]
    again = table.log.one(2).count()
    table.write(2, frame(put("a", 2, 103), put("b", 2, 115), put("x", 2, 89), put("d", 5, 111), put("c", 7, 109)))
    assert table.log.one(2).count() == again == 2 and stored() == [("c", 1), ("d", 5)]
    table.write(3, frame(put("e", 1, 200)))
    assert table.compact(3, every=2)
    assert table.log.read().where("op = 'd'").count() == 0 and stored() == [("c", 1), ("d", 5), ("e", 1)]
    table.write(4, frame(put("b", 3, 119)))                  # older than the forgotten delete: behind the bound, too
    table.write(5, frame(put("a", 9, 195), (None, ("b", 1), "u", None, 0)))
    assert stored() == [("a", 9), ("c", 1), ("d", 5), ("e", 1)]
    with pytest.raises(ValueError, match="ts_ms"):
        table.write(6, spark.createDataFrame([(None, ("a", 1), "c")], CHANGE))


def test_null_keys_at_a_target(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ROW, ["k"])
    changes = spark.createDataFrame([(None, (None, 1), "c"), (None, ("a", 1), "c")], CHANGE)
    NotNullKey(table, ["k"]).write(0, changes)
    assert table.current().count() == 1
    with pytest.raises(Exception, match="not-null"):
        NotNullKey(table, ["k"], "fail").write(1, changes)


def test_workspace_is_the_shared_folder(spark, tmp_path):
    from types import SimpleNamespace

    def session(master, **conf):
        context = SimpleNamespace(master=master, getConf=lambda: conf)
        return SimpleNamespace(sparkContext=context)

    named = {"spark.checkpoint.dir": "/shared/folder/"}
    assert workspace(session("yarn", **named), "x") == "/shared/folder/x"
    assert workspace(session("local[2]", **named), "x") == "/shared/folder/x"
    with pytest.raises(ValueError):
        workspace(session("yarn"), "x")


def test_statements_and_staging_rows(spark):
    assert jdbc.upsert_sql("t", "s", ["k", "n"], ["k"]) == (
        "INSERT INTO `t` (`k`, `n`) SELECT `k`, `n` FROM `s` WHERE `_gone` = 0 ON DUPLICATE KEY UPDATE `n` = VALUES(`n`)")
    assert jdbc.delete_sql("t", "s", ["k", "d"]) == (
        "DELETE t FROM `t` t JOIN `s` s ON t.`k` = s.`k` AND t.`d` = s.`d` WHERE s.`_gone` = 1")
    changes = spark.createDataFrame([(("a", 1), ("a", 2), "u"), (("b", 1), None, "d")], CHANGE)
    assert rows(jdbc.staged(changes, ["k"])) == [("a", 2, 0), ("b", 1, 1)]


def test_a_keyed_table_is_read_by_as_many_tasks_as_its_size_needs(spark, tmp_path, monkeypatch):
    from retally.sinks import keyed_table

    monkeypatch.setattr(keyed_table, "TASK_BYTES", 2_000)
    row = T.StructType.fromDDL("id BIGINT, v STRING")
    table = KeyedTable(spark, str(tmp_path / "table"), row, ["id"])
    images = lambda first, last, word: spark.range(first, last).selectExpr(
        "CAST(NULL AS STRUCT<id: BIGINT, v: STRING>) AS before",
        f"named_struct('id', id, 'v', sha2(concat('{word}', id), 256)) AS after", "'c' AS op")
    table.write(0, images(0, 2000, "a"))
    table.write(1, images(1000, 3000, "b"))
    tasks = -(-table.log.size() // 2_000)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert table.current().rdd.getNumPartitions() == tasks
    now = lambda: table.current().selectExpr("id", f"v = sha2(concat(IF(id < 1000, 'a', 'b'), id), 256) AS same").collect()
    assert sorted(r.id for r in now()) == list(range(3000)) and all(r.same for r in now())
    assert table.compact(1, 2) and sorted(r.id for r in now()) == list(range(3000)) and all(r.same for r in now())
