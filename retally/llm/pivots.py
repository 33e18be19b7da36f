"""Exact top-k search by inner product with a pivot table.

``PIVOTS`` rows of a bounded sample, far from each other, are the pivots of their vector length.  The table holds the distance of
every row to every pivot.  By the triangle inequality a row x is at least max |d(q, p) - d(x, p)| from a query q, and
since 2 q.x = |q|^2 + |x|^2 - d(q, x)^2 that lower bound of the distance is an upper bound of the score.  Only rows with
a bound that reaches the k-th score known of a query are evaluated, for several queries at once: the result is exact.

Rows are laid out by nearest pivot.  A cell's least and largest distances to the pivots bound all its rows at once, so a query
first goes to one block of its own cell, takes the k-th score there along, and then only to the cells that can still beat it.
Cells are cut into blocks of bounded size, and so are the queries: no group grows with the data, nothing is capped, and copies
of one vector, however many, spread over the blocks of their cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retally.llm.common import kept, ready, workspace
from retally.llm.whole import ASKS, ROWS, exact, matrix, scaled, splits, table_products

PIVOTS, SAMPLE = 32, 2048
#: Cells are broadcast up to this number (64 distances each), else joined by a shuffle.
FEW_CELLS = 4096
#: Queries that are evaluated side by side; only memory depends on it.
SIDE = 64

_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample, each the one farthest from those before it."""
    x = sample.astype(np.float64)
    chosen = [int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax())]
    away = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    away = [np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots]
    return np.stack(away, axis=1) if away else np.zeros((len(x), 0))


def _tabled(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = np.asarray(lists.value_lengths())
            cell, norm, far = np.zeros(len(size), np.int32), np.zeros(len(size), np.float64), [[]] * len(size)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                x = np.asarray(lists.take(pa.array(at)).flatten(), np.float64).reshape(len(at), dim)
                norm[at] = (x ** 2).sum(axis=1)
                away = distances(x, pivots.get(int(dim), np.zeros((0, dim)))).astype(np.float32)
                if away.shape[1]:
                    cell[at] = away.argmin(axis=1)
                for i, row in zip(at, away):
                    far[i] = row
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(size.astype(np.int32)), pa.array(cell), pa.array(norm),
                pa.array(far, pa.list_(pa.float32())), lists], names=["vec_id", "dim", "cell", "norm", "far", "v"])

    return run


def bounds(q_far: np.ndarray, q_norm: np.ndarray, far: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of queries (lines) and rows (columns); roundings only make them larger."""
    least = np.zeros((len(q_far), len(far)), np.float32)
    for q, x in zip(q_far.T, np.ascontiguousarray(far.T)):
        np.maximum(least, np.abs(q[:, None] - x), out=least)
    if far.size:
        least -= np.float32(2.0 ** -20) * (q_far.max() + far.max())
    top = (q_norm[:, None] + norm - np.maximum(least, 0).astype(np.float64) ** 2) / 2
    return top + np.abs(top) * 1e-12 + 1


def search(q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray, doubles: bool):
    """Queries, ids and scores of the k best rows that reach ``floor``, for queries (lines of ``bound``) side by side.

    Only rows with a bound that reaches some query's floor are evaluated, and only for queries that they can reach do they count.
    """
    reach = bound >= floor[:, None]
    some = np.flatnonzero(reach.any(axis=0))
    if not len(some):
        return q_ids[:0], ids[:0], np.zeros(0, np.int64)
    score, reach, ids = table_products(q, x[some], doubles), reach[:, some], ids[some]
    reach &= score >= floor[:, None]
    for i in np.flatnonzero(reach.sum(axis=1) > k):
        at = np.flatnonzero(reach[i])
        reach[i, at] = score[i, at] >= np.partition(score[i, at], len(at) - k)[len(at) - k]
    line, at = np.nonzero(reach)
    score = score[line, at].astype(np.int64)
    # of equal scores at the k-th place the smaller ids stay
    order = np.lexsort((ids[at], -score, line))
    line, at, score = line[order], at[order], score[order]
    place = np.arange(len(line)) - np.searchsorted(line, line)
    return q_ids[line[place < k]], ids[at[place < k]], score[place < k]


def _searched(k: int, doubles: bool):
    def run(key: tuple[pa.Scalar, ...], asks: pa.Table, rows: pa.Table) -> pa.Table:
        if not asks.num_rows or not rows.num_rows:
            return _FOUND.empty_table()
        kind = np.float64 if doubles else np.int64
        ids, x, norm = np.asarray(rows["vec_id"]), matrix(rows["v"], kind), np.asarray(rows["norm"])
        q_ids, q, q_norm = np.asarray(asks["query_id"]), matrix(asks["v"], kind), np.asarray(asks["norm"])
        far, q_far = matrix(rows["far"], np.float32), matrix(asks["far"], np.float32)
        floor = np.array([np.finfo(np.float64).min if f is None else f for f in asks["floor"].to_pylist()])
        found = []
        for start in range(0, len(q), SIDE):
            part = slice(start, start + SIDE)
            bound = bounds(q_far[part], q_norm[part], far, norm)
            bound[q_ids[part, None] == ids] = -np.inf
            found.append(search(q_ids[part], q[part], bound, x, ids, k, floor[part], doubles))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], schema=_FOUND)

    return run


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """Pivots of every vector length in a sample of ``SAMPLE`` rows, drawn by a hash of the id."""
    drawn = [r.v for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()]
    return {dim: far_apart(np.array([v for v in drawn if len(v) == dim]), PIVOTS) for dim in {len(v) for v in drawn} if dim}


def top_scores(vectors: DataFrame, asked: DataFrame, k: int = 20, scale: int = 64) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``asked`` the k rows of ``vectors`` with the highest scores.

    Both are ``(vec_id, embedding)``.  Components count as floor(scale * x); the score is their integer inner product, ties go to
    the smaller vec_id, and a query's own id is no candidate.  With fewer than k candidates all are returned.  Vectors that are
    null, empty or hold null or non-finite components, and rows with a null id, take no part; repeated rows of one id count
    once.  Only vectors of the query's length are candidates.  Products that may not fit 64 bits are an error.  Other
    columns are not read; empty tables give no rows.
    """
    spark = vectors.sparkSession
    ready(spark)
    home = workspace(spark, "pivots")
    rows = kept(scaled(vectors, scale), f"{home}/rows")
    queries = kept(scaled(asked, scale), f"{home}/queries")
    doubles = exact(rows.unionAll(queries))
    table = _tabled(_pivots(rows))
    shape = "vec_id long, dim int, cell int, norm double, far array<float>, v array<long>"
    rows = kept(rows.mapInArrow(table, shape), f"{home}/table")
    asks = kept(queries.mapInArrow(table, shape).withColumnRenamed("vec_id", "query_id"), f"{home}/asks")
    asking = splits(asks.count(), ASKS)

    span = lambda pick: F.array_compact(F.array(*[pick(F.get("far", F.lit(i))) for i in range(PIVOTS)]))
    cells = kept(rows.groupBy("dim", "cell").agg(
        F.ceil(F.count("*") / ROWS).cast("int").alias("parts"), F.max("norm").alias("most"),
        span(F.min).alias("lo"), span(F.max).alias("hi")), f"{home}/cells")
    cells = F.broadcast(cells) if cells.count() <= FEW_CELLS else cells
    rows = rows.join(cells.select("dim", "cell", "parts"), ["dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int")).withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(asking - 1))))
    asks = asks.withColumn("ask", F.pmod(F.xxhash64("query_id"), F.lit(asking)).cast("int"))

    block = ["dim", "cell", "part", "ask"]
    evaluated = lambda sent, path: kept(sent.select(*block, "query_id", "v", "norm", "far", "floor").groupBy(*block).cogroup(
        rows.select(*block, "vec_id", "v", "norm", "far").groupBy(*block)).applyInArrow(
            _searched(k, doubles), "query_id long, vec_id long, score long"), path)

    # one block of the own cell (where there is one) gives a first k-th score
    own = F.pmod(F.xxhash64("query_id", F.lit("own")), "parts").cast("int")
    first = evaluated(asks.join(cells.select("dim", "cell", "parts"), ["dim", "cell"]).withColumn("part", own).withColumn(
        "floor", F.lit(None).cast("double")), f"{home}/first")
    floor = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
    away = F.aggregate(F.zip_with(F.arrays_zip(F.col("lo"), F.col("hi")), "far", lambda s, f: F.greatest(s["lo"] - f, f - s["hi"])),
                       F.lit(0.0).cast("float"), lambda a, b: F.greatest(a, b)).cast("double")
    rounding = (F.coalesce(F.array_max("hi"), F.lit(0.0)) + F.coalesce(F.array_max("far"), F.lit(0.0))) * 1e-6
    away = F.greatest(away - rounding, F.lit(0.0))
    bound = (F.col("norm") + F.col("most") - away * away) / 2 * (1 + 1e-12) + 1
    reach = asks.withColumnRenamed("cell", "home").join(cells, "dim").join(floor, "query_id", "left").where(
        F.col("floor").isNull() | (bound >= F.col("floor"))).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rest = evaluated(reach.where((F.col("home") != F.col("cell")) | (F.col("part") != own)), f"{home}/rest")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return first.unionAll(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
