"""Hard negatives of anchors, found through rotated one-bit codes.

A vector x of length |x| is turned by a random rotation into ``BITS`` numbers per dimension of which only the signs stay.  The
signs, turned back, are a direction u; the stored alignment is a = cos(x, u).  For an anchor q with g = cos(u, q),
estimated from popcounts of x's code with the bit planes of q's rotated and rounded components,

    cos(x, q) = a g + <r, q>,   r orthogonal to u,   |<r, q>| <= sqrt(1 - a^2) sqrt(1 - g^2)

by Cauchy and Schwarz.  That interval, widened by the anchor's rounding, holds the score for certain: rows whose interval misses
the wanted scores, or stays below enough rows that are surely better, are dropped; the rest is scored in whole numbers.  The
result is exact.

Rows are dealt to blocks by a hash of their id whatever their label, and anchors likewise; every pair of blocks is one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retally.llm.common import kept, ready, workspace
from retally.llm.whole import ASKS, ROWS, best, exact, matrix, products, scaled, splits

#: Bits of a code per dimension, and of an anchor's rounded components.
BITS, PLANES = 8, 6


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """Bits x dim, columns of length one at right angles; the bits fill words of 64."""
    bits = -(-dim * BITS // 64) * 64
    return np.linalg.qr(np.random.Generator(np.random.PCG64(dim)).standard_normal((bits, dim)))[0]


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (words of 64 bits), alignments with the code's direction, lengths of the codes turned back, lengths of the vectors."""
    turn, length = rotation(x.shape[1]), np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    unit = x / np.where(length > 0, length, 1)[:, None]
    signs = unit @ turn.T >= 0
    back = np.where(signs, 1.0, -1.0) @ turn / np.sqrt(len(turn))
    size = np.sqrt((back ** 2).sum(axis=1))
    align = np.where(length > 0, (back * unit).sum(axis=1) / size, 1.0)
    return np.packbits(signs, axis=1, bitorder="little").view(np.uint64), align, size, length


def planes(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of rotated unit anchors; for each also the least component, the step and the length of the rounding."""
    turn, length = rotation(q.shape[1]), np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    z = q / np.where(length > 0, length, 1)[:, None] @ turn.T
    low = z.min(axis=1)
    step = np.maximum((z.max(axis=1) - low) / (2 ** PLANES - 1), 1e-300)
    whole = np.rint((z - low[:, None]) / step[:, None]).astype(np.uint8)
    off = np.sqrt(((z - low[:, None] - step[:, None] * whole) ** 2).sum(axis=1))
    bits = np.unpackbits(whole[:, None, :], axis=1, bitorder="little").reshape(len(q), 8, -1)[:, :PLANES]
    return np.packbits(bits, axis=2, bitorder="little").view(np.uint64), low, step, off


def intervals(q: np.ndarray, x_coded: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors (lines) with coded rows (columns)."""
    code, align, size, length = x_coded
    plane, low, step, off = planes(q)
    ones = np.zeros((len(q), len(code)), np.int64)
    for b in range(PLANES):
        for w in range(code.shape[1]):
            ones += np.bitwise_count(code[:, w] & plane[:, b, w, None]).astype(np.int64) << b
    set_bits = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
    bits = 64 * code.shape[1]
    total = low * bits + step * sum(np.bitwise_count(plane[:, b]).sum(axis=1, dtype=np.int64) << b for b in range(PLANES))
    signed = 2 * (low[:, None] * set_bits + step[:, None] * ones) - total[:, None]
    reach = np.where(size > 0, size, 1)
    g = signed / np.sqrt(bits) / reach
    error = off[:, None] / reach + 1e-9
    apart = np.sqrt(1 - np.clip(np.abs(g) - error, 0, 1) ** 2) * np.sqrt(np.clip(1 - align ** 2, 0, 1))
    scale = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))[:, None] * length
    middle, wide = align * g * scale, (apart + align * error + 1e-9) * scale + 1e-6
    return np.maximum(middle - wide, -scale - 1), np.minimum(middle + wide, scale + 1)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        size = np.asarray(lists.value_lengths())
        code, facts = [b""] * len(size), np.zeros((3, len(size)))
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            words, *numbers = coded(np.asarray(lists.take(pa.array(at)).flatten(), np.int64).reshape(len(at), dim))
            for i, word in zip(at, words):
                code[i] = word.tobytes()
            facts[:, at] = numbers
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(size.astype(np.int32)), pa.array(code, pa.binary()),
                                          *map(pa.array, facts), lists], names=["vec_id", "label", "dim", "code", "align", "size", "length", "v"])


class _Block:
    """Coded rows of a block, and what its anchors ask of it."""

    def __init__(self, asks: pa.Table, rows: pa.Table, doubles: bool):
        self.ids, self.label, self.x, self.doubles = np.asarray(rows["vec_id"]), np.asarray(rows["label"]), matrix(rows["v"]), doubles
        raw = rows["code"].to_pylist()
        code = np.frombuffer(b"".join(raw), np.uint64).reshape(len(raw), -1)
        self.coded = (code, *(np.asarray(rows[c]) for c in ("align", "size", "length")))
        self.anchors, self.of, self.q = np.asarray(asks["anchor_id"]), np.asarray(asks["label"]), matrix(asks["v"])

    def lines(self):
        """For each anchor its number and the bounds of all rows."""
        for start in range(0, len(self.q), 32):
            low, high = intervals(self.q[start:start + 32], self.coded)
            yield from ((start + i, low[i], high[i]) for i in range(len(low)))

    def scores(self, at: np.ndarray, line: int) -> np.ndarray:
        return products(self.x[at], self.q[line], self.doubles)


def surely(low: np.ndarray, high: np.ndarray, may: np.ndarray, sure: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the k best: not below the k-th of the lower bounds of rows that surely count."""
    floors = low[sure]
    return may & (high >= np.partition(floors, len(floors) - k)[len(floors) - k]) if len(floors) >= k else may


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
_NEGATIVE = pa.schema([*_POSITIVE, ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _table(parts: list, schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema) if parts else schema.empty_table()


def _positives(k: int, doubles: bool):
    def run(key: tuple[pa.Scalar, ...], asks: pa.Table, rows: pa.Table) -> pa.Table:
        if not asks.num_rows or not rows.num_rows:
            return _POSITIVE.empty_table()
        here, found = _Block(asks, rows, doubles), []
        for line, low, high in here.lines():
            may = (here.label == here.of[line]) & (here.ids != here.anchors[line])
            at = np.flatnonzero(surely(low, high, may, may, k))
            score = here.scores(at, line)
            first = best(score, here.ids[at], k)
            found.append((np.full(len(first), here.anchors[line]), here.ids[at[first]], score[first]))
        return _table(found, _POSITIVE)

    return run


def _negatives(k: int, doubles: bool, least: int, most: int):
    def run(key: tuple[pa.Scalar, ...], asks: pa.Table, rows: pa.Table) -> pa.Table:
        if not asks.num_rows or not rows.num_rows:
            return _NEGATIVE.empty_table()
        here, found = _Block(asks, rows, doubles), []
        wanted = asks["positives"].to_pylist()
        for line, low, high in here.lines():
            other = here.label != here.of[line]
            windows = [(p["positive_id"], p["positive_score"]) for p in wanted[line]]
            ask = []
            for _, score in windows:
                floor, top = least * score / 100, most * score / 100
                ask.append(surely(low, high, other & (high >= floor - 1) & (low <= top + 1), other & (low >= floor) & (high <= top), k))
            at = np.flatnonzero(np.any(ask, axis=0))
            score = here.scores(at, line)
            for positive, bar in windows:
                # whole numbers: 100 * score may not fit 64 bits, the bounds of the score do
                inside = np.flatnonzero((score >= -(-least * bar // 100)) & (score <= most * bar // 100))
                first = inside[best(score[inside], here.ids[at[inside]], k)]
                same = lambda value: np.full(len(first), value)
                found.append((same(here.anchors[line]), same(positive), same(bar), here.ids[at[first]], score[first]))
        return _table(found, _NEGATIVE)

    return run


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, scale: int = 256,
                   least: int = 80, most: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` is ``(vec_id, embedding, label)``, ``anchors`` some of its rows, by ``vec_id``.  Components count as
    floor(scale * x), a score is the integer inner product with the anchor; higher scores come first, ties by smaller vec_id.  An
    anchor's positives are its first other rows of its label; for each positive the first rows of another label whose
    score is between ``least`` and ``most`` hundredths of the positive's are returned, all where there are fewer.

    Rows with a null id or label, a null or empty vector, or a null or non-finite component take no part, neither as anchors;
    repeated rows of one id count once (where they differ, the least row).  Only vectors of the anchor's length are looked at.
    Products that may not fit 64 bits are an error.  Other columns are not read; empty tables give no rows.
    """
    spark = vectors.sparkSession
    ready(spark)
    home = workspace(spark, "negatives")
    vectors = vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    rows = kept(scaled(vectors, scale, "label"), f"{home}/rows")
    doubles = exact(rows)
    rows = kept(rows.select("vec_id", "label", "v").mapInArrow(
        _coded, "vec_id long, label long, dim int, code binary, align double, size double, length double, v array<long>"), f"{home}/codes")
    asked = anchors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    asks = kept(rows.join(asked, "vec_id", "left_semi").select(F.col("vec_id").alias("anchor_id"), "label", "dim", "v"), f"{home}/anchors")
    parts, asking = splits(rows.count(), ROWS), splits(asks.count(), ASKS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = ["dim", "part", "ask"]
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")).withColumn("ask", every(asking))

    def meet(sent: DataFrame, work, schema: str) -> DataFrame:
        sent = sent.withColumn("ask", F.pmod(F.xxhash64("anchor_id"), F.lit(asking)).cast("int")).withColumn("part", every(parts))
        return sent.groupBy(*block).cogroup(dealt.groupBy(*block)).applyInArrow(work, schema)

    scored = "anchor_id long, positive_id long, positive_score long"
    near = meet(asks, _positives(positives, doubles), scored)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    near = kept(near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")), f"{home}/positives")
    found = meet(asks.join(near, "anchor_id"), _negatives(negatives, doubles, least, most),
                 f"{scored}, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
