"""Near-duplicate vectors by hashing to the E8 lattice.

A table projects unit vectors at random to ``BLOCKS`` blocks of eight dimensions; each block is decoded to the
nearest point of the E8 lattice, and the points are the vector's cell.  Vectors that are near each other mostly share
the cell, or one's cell is next to the other's: besides its own cell a vector probes the cells that lie next
nearest (the lattice's 240 shortest vectors from the decoded point).  Pairs that meet in a cell of any table are
verified by cosine in double precision.

Equal vectors of one label are one class with a count, so copies never meet as pairs.  Cells without a partner send
no vectors.  A crowded cell is split into blocks, and each pair of blocks is one matrix product;
links are counted and joined on the spot, each in the first table where the two meet, so a crowd of n near vectors gives
n rows, not n squared.  Nothing is capped.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retally.llm.common import kept, mixed, ready, workspace
from retally.llm.components import components

TABLES, BLOCKS, PROBES, SCALE = 10, 2, 6, 0.30
#: Rows of one block of a crowded cell.
BLOCK_ROWS = 1024


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = [v for i, j in itertools.combinations(range(8), 2) for v in (
        np.eye(8)[i] * a + np.eye(8)[j] * b for a in (1, -1) for b in (1, -1))]
    halves = [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(pairs + halves)


ROOTS = _roots()


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and turn the worst coordinate the other way if odd."""
    near = np.round(x)
    worst = np.abs(x - near).argmax(axis=1)
    line = np.arange(len(x))
    other = near.copy()
    other[line, worst] += np.where(x[line, worst] >= near[line, worst], 1, -1)
    return np.where((near.sum(axis=1) % 2 != 0)[:, None], other, near)


def e8(x: np.ndarray) -> np.ndarray:
    """Nearest lattice points: E8 is D8 and D8 shifted by one half."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@lru_cache(maxsize=8)
def _projection(dim: int) -> np.ndarray:
    """Tables x dim x (blocks of eight), scaled so that a distance of ``SCALE`` is one unit of the lattice."""
    g = np.random.Generator(np.random.PCG64(8)).standard_normal((TABLES, dim, 8 * BLOCKS))
    return g / np.sqrt(8) / SCALE


def _name(points: list[np.ndarray], seed: np.ndarray) -> np.ndarray:
    """64-bit name of a cell from the doubled coordinates of its points."""
    with np.errstate(over="ignore"):
        h = seed
        for block in points:
            for column in (2 * block).astype(np.int64).view(np.uint64).T:
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + column)
    return h


def cells(unit: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (rows x tables) and probed cells (rows x tables x probes) of unit vectors of one length."""
    n, dim = unit.shape
    home, probe = np.zeros((n, TABLES), np.uint64), np.zeros((n, TABLES, PROBES), np.uint64)
    for t, g in enumerate(_projection(dim)):
        seed = mixed(label.astype(np.int64).view(np.uint64) * np.uint64(1000003) + np.uint64(t * 65537 + dim))
        y = unit @ g
        parts = [y[:, 8 * b:8 * b + 8] for b in range(BLOCKS)]
        points = [e8(p) for p in parts]
        home[:, t] = _name(points, seed)
        # farther by this much when one block goes to a neighbouring point
        gain = np.concatenate([2 - 2 * (p - q) @ ROOTS.T for p, q in zip(parts, points)], axis=1)
        best = np.argpartition(gain, PROBES - 1, axis=1)[:, :PROBES]
        for k in range(PROBES):
            block, root = best[:, k] // len(ROOTS), best[:, k] % len(ROOTS)
            moved = [q + np.where((block == b)[:, None], ROOTS[root], 0) for b, q in enumerate(points)]
            probe[:, t, k] = _name(moved, seed)
    return home.view(np.int64), probe.view(np.int64)


_HASHED = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("same", pa.binary()), ("unit", pa.binary())])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can link, as unit vectors of doubles, and a digest of vector and label."""
    for batch in batches:
        rows = []
        for vec, label, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if not values.is_valid or label is None:
                continue
            if values.values.null_count:
                continue
            x = np.asarray(values.values.to_numpy(zero_copy_only=False), np.float64)
            if not len(x) or not np.isfinite(x).all() or not x.any():
                continue
            x = x / np.abs(x).max()
            x = x / np.sqrt(x @ x)
            rows.append((vec, label, hashlib.blake2b(x.tobytes() + str(label).encode(), digest_size=16).digest(), x.tobytes()))
        columns = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _HASHED)], schema=_HASHED)


def _celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors with their cells."""
    for batch in batches:
        column = lambda c: batch.column(batch.schema.get_field_index(c))
        raw, label = column("unit").to_pylist(), np.asarray(column("label"), np.int64)
        size = np.array([len(r) // 8 for r in raw])
        home, probe = np.zeros((len(raw), TABLES), np.int64), np.zeros((len(raw), TABLES, PROBES), np.int64)
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            for part in np.array_split(at, max(1, len(at) // 2048)):
                home[part], probe[part] = cells(np.frombuffer(b"".join([raw[i] for i in part])).reshape(-1, dim), label[part])
        yield pa.RecordBatch.from_arrays([
            *(column(c) for c in ("cls", "copies", "label", "unit")),
            pa.array(list(home), pa.list_(pa.int64())), pa.array(list(probe.reshape(len(raw), -1)), pa.list_(pa.int64()))],
            names=["cls", "copies", "label", "unit", "home", "probe"])


def _first_meeting(a_home, a_probe, b_home, b_probe) -> tuple[np.ndarray, np.ndarray]:
    """First table where two vectors meet, and the cell: a common home, else b's home probed by a, else the other way."""
    k = len(a_home)
    both = a_home == b_home
    a_asks = (a_probe.reshape(k, TABLES, PROBES) == b_home[:, :, None]).any(axis=2)
    b_asks = (b_probe.reshape(k, TABLES, PROBES) == a_home[:, :, None]).any(axis=2)
    table = (both | a_asks | b_asks).argmax(axis=1)
    line = np.arange(k)
    return table, np.where(both[line, table] | a_asks[line, table], b_home[line, table], a_home[line, table])


_LINKED = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("tied", pa.int64())])


def _links(percent: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        cell = key[0].as_py()
        cls, copies = table["cls"].to_numpy(), table["copies"].to_numpy()
        label, row_home = table["label"].to_numpy(), table["is_home"].to_numpy(zero_copy_only=False)
        left, right = table["left"].to_numpy(zero_copy_only=False), table["right"].to_numpy(zero_copy_only=False)
        raw = table["unit"].to_pylist()
        home = np.array(table["home"].to_pylist(), np.int64).reshape(-1, TABLES)
        probe = np.array(table["probe"].to_pylist(), np.int64).reshape(-1, TABLES * PROBES)
        size = np.array([len(r) for r in raw])
        counts, ties = np.zeros(len(cls), np.int64), np.arange(len(cls))
        for dim in np.unique(size):
            unit = np.zeros((len(raw), dim // 8))
            same = np.flatnonzero(size == dim)
            unit[same] = np.frombuffer(b"".join([raw[i] for i in same])).reshape(-1, dim // 8)
            at_home, all_here = np.flatnonzero(left & row_home & (size == dim)), np.flatnonzero(right & (size == dim))
            for part in np.array_split(at_home, max(1, len(at_home) // 256)):
                if not len(part) or not len(all_here):
                    continue
                i, j = np.nonzero(unit[part] @ unit[all_here].T >= percent)
                b, a = part[i], all_here[j]                 # b is at home here; a is at home too or asks
                mine = (label[a] == label[b]) & (cls[a] != cls[b]) & (~row_home[a] | (cls[a] < cls[b]))
                a, b = a[mine], b[mine]
                lo, hi = np.where(cls[a] < cls[b], a, b), np.where(cls[a] < cls[b], b, a)
                _, where = _first_meeting(home[lo], probe[lo], home[hi], probe[hi])
                a, b = a[where == cell], b[where == cell]
                np.add.at(counts, a, copies[b])
                np.add.at(counts, b, copies[a])
                while len(a):                                # least row reached inside this task
                    least = np.minimum(ties[a], ties[b])
                    before = ties.copy()
                    np.minimum.at(ties, a, least)
                    np.minimum.at(ties, b, least)
                    ties = ties[ties]
                    if (ties == before).all():
                        break
        some = np.flatnonzero(counts)
        return pa.table([pa.array(cls[some]), pa.array(counts[some]), pa.array(cls[ties[some]])], schema=_LINKED)

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding, label)``.

    Only vectors of one label and one length are compared.  A null label, a null, empty or zero vector and a vector with
    null or non-finite components link with nothing.  Rows with a null id are left out; repeated rows
    with one id are expected to be equal and count once.  Other columns are not read.
    """
    spark = vectors.sparkSession
    ready(spark)
    home = workspace(spark, "lattice")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null")
    # ids and digests of all vectors; the vectors themselves once per class
    unit = vectors.mapInArrow(_units, "vec_id long, label long, same binary, unit binary")
    known = kept(unit, f"{home}/unit")
    same = known.select("same", "vec_id").distinct().groupBy("same").agg(F.min("vec_id").alias("cls"), F.count("*").alias("copies"))
    same = kept(same, f"{home}/classes")
    heads = known.join(same.select(F.col("cls").alias("vec_id"), "copies"), "vec_id").dropDuplicates(["vec_id"])
    celled = kept(heads.select(F.col("vec_id").alias("cls"), "copies", "label", "unit").mapInArrow(
        _celled, "cls long, copies long, label long, unit binary, home array<long>, probe array<long>"), f"{home}/cells")
    member = celled.select("cls", F.explode("home").alias("cell"), F.lit(True).alias("is_home")).unionAll(
        celled.select("cls", F.explode(F.array_distinct("probe")).alias("cell"), F.lit(False).alias("is_home")))
    crowd = member.groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.col("is_home").cast("long")).alias("homes")).where(
        "homes > 0 and n > 1")
    parts = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("long")
    member = member.join(crowd, "cell").select("cell", "cls", "is_home", parts("homes").alias("hp"), parts("n").alias("np"))
    # block of the homes x block of all members; a row goes to its line and to its column of blocks
    salt = F.xxhash64("cls")
    as_home = member.where("is_home").select("cell", "cls", "is_home", F.pmod(salt, "hp").alias("p"),
                                             F.explode(F.expr("sequence(0L, np - 1)")).alias("q"), F.lit(True).alias("left"), F.lit(False).alias("right"))
    as_any = member.select("cell", "cls", "is_home", F.explode(F.expr("sequence(0L, hp - 1)")).alias("p"),
                           F.pmod(salt, "np").alias("q"), F.lit(False).alias("left"), F.lit(True).alias("right"))
    placed = as_home.unionAll(as_any).groupBy("cell", "p", "q", "cls", "is_home").agg(
        F.max("left").alias("left"), F.max("right").alias("right"))
    sent = placed.join(celled, "cls")
    found = kept(sent.groupBy("cell", "p", "q").applyInArrow(_links(cosine), "cls long, n long, tied long"), f"{home}/links")
    joined = components(found.select(F.col("cls").alias("a"), F.col("tied").alias("b")), f"{home}/components")
    counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
    classes = same.join(counts, "cls", "left").join(joined.withColumnRenamed("id", "cls"), "cls", "left").select(
        "same", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cls").alias("c"))
    of_vector = known.select("vec_id", "same").distinct().join(classes, "same").select("vec_id", "n_links", "c")
    return vectors.select("vec_id").join(of_vector, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id")
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
