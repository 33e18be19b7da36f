"""Keyed targets in a database: a staging table, then two statements.

A batch of changes is written to a staging table by the executors, then applied
inside the database in one transaction.  Both statements give the same table
when they run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

GONE = "_gone"


def upsert_sql(table: str, staging: str, columns: Sequence[str], key: Sequence[str]) -> str:
    names = ", ".join(f"`{c}`" for c in columns)
    sets = ", ".join(f"`{c}` = VALUES(`{c}`)" for c in columns if c not in key) or f"`{key[0]}` = VALUES(`{key[0]}`)"
    return (f"INSERT INTO `{table}` ({names}) SELECT {names} FROM `{staging}` WHERE `{GONE}` = 0 "
            f"ON DUPLICATE KEY UPDATE {sets}")


def delete_sql(table: str, staging: str, key: Sequence[str]) -> str:
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in key)
    return f"DELETE t FROM `{table}` t JOIN `{staging}` s ON {on} WHERE s.`{GONE}` = 1"


def staged(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Changes as staging rows: the new row, or the key of a deleted one with ``_gone`` = 1."""
    columns = changes.schema["after"].dataType.names
    gone = F.col("op") == "d"
    return changes.select(
        *[F.when(gone, F.col(f"before.{c}")).otherwise(F.col(f"after.{c}")).alias(c) for c in columns],
        gone.cast("int").alias(GONE))


class JdbcTable:
    """``write`` has the form of the file table's, so either can be a pipeline's target."""

    def __init__(self, url: str, table: str, key: Sequence[str], properties: dict[str, str],
                 batch_rows: int = 5000):
        self.url, self.table, self.key = url, table, list(key)
        self.properties, self.batch_rows = dict(properties), batch_rows

    def write(self, batch: int, changes: DataFrame) -> None:
        rows = staged(changes, self.key)
        staging = f"{self.table}__staging"
        (rows.write.mode("overwrite").option("batchsize", self.batch_rows)
         .option("truncate", "true").jdbc(self.url, staging, properties=self.properties))
        columns = [c for c in rows.columns if c != GONE]
        self._run(changes.sparkSession, [delete_sql(self.table, staging, self.key),
                                         upsert_sql(self.table, staging, columns, self.key)])

    def _run(self, spark, statements: Sequence[str]) -> None:
        jvm = spark.sparkContext._jvm
        given = jvm.java.util.Properties()
        for k, v in self.properties.items():
            given.setProperty(k, v)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, given)
        try:
            connection.setAutoCommit(False)
            for sql in statements:
                connection.createStatement().executeUpdate(sql)
            connection.commit()
        finally:
            connection.close()
