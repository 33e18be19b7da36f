"""Near-duplicate documents by circulant MinHash.

One permutation scatters the hashed shingles over a circle, the other one gives
the value at each place of the circle; coordinate k of a signature is the least
value when the circle is turned by k places.  Two permutations thus give all
coordinates.  Coordinates are banded; documents that share a band are compared
on their full shingle sets before they are linked.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case.  A document's
set is its distinct k-word shingles; with fewer words the whole sequence is one
shingle; without words (or with a null text) the set is empty and links with
nothing.  Equal sets are one class throughout, so copies never meet as pairs.

Links inside a bucket are found without pairing all its members.  In each of a
few rounds one random member of every bucket (the pivot) is compared with the
members it is not yet connected to; what is linked is connected before the next
round.  After them, all pairs of a bucket that are still unconnected are looked at, in
blocks within a task: signatures that agree in too few coordinates for a link (by
``SIGMAS`` standard deviations) exclude a pair, and clusters of the others are compared on their full
sets, again in blocks.  A task gives the edges that connect its rows, not all pairs.  Nothing is capped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from retally.llm.common import kept, mixed, ready, slices, texts, workspace
from retally.llm.components import components

#: Places on the circle.  Shingles that share one only make two signatures look more alike.
CIRCLE = 1 << 20
ROWS = 5
#: A pair at the threshold is missed with less than this probability.
MISS = 1e-8
PIVOT_ROUNDS = 2
#: Signatures exclude a pair that agrees in so many standard deviations fewer coordinates than a link would.
SIGMAS = 6
#: Members in one block of a bucket.
BLOCK = 512


def bands(percent: int) -> int:
    """Bands of ``ROWS`` coordinates for a threshold in percent."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))


@lru_cache(maxsize=2)
def _turns(coordinates: int) -> np.ndarray:
    """Row s: the values that place s of the circle takes under the first ``coordinates`` turns."""
    value = np.random.Generator(np.random.PCG64(11)).permutation(CIRCLE).astype(np.int32)
    return sliding_window_view(np.concatenate([value, value[:coordinates]]), coordinates)


def _place(h: np.ndarray) -> np.ndarray:
    """The first permutation: hashed shingle -> place (an odd factor modulo a power of two is a bijection)."""
    low = h & np.uint64(CIRCLE - 1)
    with np.errstate(over="ignore"):
        return ((low * np.uint64(0x9E3D1)) & np.uint64(CIRCLE - 1)).astype(np.int64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_sets(docs: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    known, hashes, counts = _Words(), [], []
    for text in docs:
        words = text.lower().split()                     # of bytes: A-Z only, and the six ASCII spaces
        counts.append(len(words))
        hashes.extend(map(known.__getitem__, words))
    flat = np.array(hashes, np.uint64)
    with np.errstate(over="ignore"):
        rolled = np.full(max(0, len(flat) - k + 1), k, np.uint64)
        for i in range(k if len(rolled) else 0):
            rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + flat[i:len(flat) - k + 1 + i])
        out, at = [], 0
        for n in counts:
            if n >= k:
                out.append(np.unique(rolled[at:at + n - k + 1]))
            elif n:
                h = np.array([n], np.uint64)
                for i in range(n):
                    h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + flat[at + i:at + i + 1])
                out.append(h)
            else:
                out.append(np.empty(0, np.uint64))
            at += n
    return out


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """All coordinates of a non-empty set."""
    turns, place, least = _turns(coordinates), _place(shingles), None
    for start in range(0, len(place), 2048):
        part = turns[place[start:start + 2048]].min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    n, width = signatures.shape[0], signatures.shape[1] // ROWS
    parts = signatures.reshape(n, width, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, width + 1, dtype=np.uint64), (n, width)).copy()
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def _profile(k: int, width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("signs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(texts(batch), k)
            full = [s for s in sets if len(s)]
            signs = np.stack([signature(s, width * ROWS) for s in full]) if full else np.empty((0, width * ROWS), np.int32)
            rows, low = iter(band_keys(signs)), iter(mixed(signs.astype(np.uint64)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("doc_id")),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                         pa.binary()),
                pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([next(low).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], schema=schema)

    return run


def _sets(k: int):
    schema = pa.schema([("cls", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("doc_id")),
                pa.array([s.tobytes() for s in shingle_sets(texts(batch), k)], pa.binary())], schema=schema)

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of intersection and union of full sets.  Rows come sorted by ``b``, so its set is mostly at hand."""
    for batch in batches:
        a, b = (batch.column(batch.schema.get_field_index(c)) for c in ("sa", "sb"))
        both, either = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        last, right = None, None
        for i in range(len(a)):
            left, raw = np.frombuffer(a[i].as_buffer(), np.uint64), b[i].as_buffer()
            if last is None or not raw.equals(last):
                last, right = raw, np.frombuffer(raw, np.uint64)
            at = np.searchsorted(right, left)
            both[i] = int((right[np.minimum(at, len(right) - 1)] == left).sum())
            either[i] = len(left) + len(right) - both[i]
        yield pa.RecordBatch.from_arrays([
            batch.column(batch.schema.get_field_index("a")), batch.column(batch.schema.get_field_index("b")),
            pa.array(both), pa.array(either)], names=["a", "b", "both", "either"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) with the exact sizes of their sets' intersection and union."""
    with_a = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")).hint("shuffle_merge"), "a")
    with_b = with_a.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")).hint("shuffle_merge"), "b")
    return with_b.select("a", "b", "sa", "sb").mapInArrow(_compare, "a long, b long, both long, either long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Linked: 100 * |intersection| >= percent * |union|.  Other columns of ``docs`` are not
    read.  Rows with a null id are left out; repeated rows with one id are repeated in the
    result (an id is expected to have one text); an empty table gives no rows.
    """
    spark = docs.sparkSession
    ready(spark)
    home, width = workspace(spark, "minhash"), bands(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    profile = kept(docs.mapInArrow(_profile(k, width), "doc_id long, n long, set_key binary, bands array<long>, signs binary"),
                   f"{home}/profile")
    classes = kept(profile.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("cls")), f"{home}/classes")
    # one row per class and band; buckets with one class hold no pair
    head = profile.join(classes.select(F.col("cls").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    member = head.select(F.explode("bands").alias("key"), F.col("doc_id").alias("cls"), "n").distinct()
    shared = member.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    member = kept(member.join(shared.hint("merge"), "key"), f"{home}/member")
    signs = head.select(F.col("doc_id").alias("cls"), "signs").dropDuplicates(["cls"])
    wanted = member.select(F.col("cls").alias("doc_id")).distinct()
    sets = kept(docs.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
                .mapInArrow(_sets(k), "cls long, shingles binary"), f"{home}/sets")

    link = F.expr(f"100 * both >= {percent} * either")
    sized = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    group = member.select("cls").distinct().withColumn("component", F.col("cls"))
    links, seen = None, None
    for number in range(PIVOT_ROUNDS):
        placed = member.join(group.hint("merge"), "cls")
        pivot = placed.groupBy("key").agg(F.min(F.struct(
            F.xxhash64("key", "cls", F.lit(number)), F.col("cls").alias("b"), F.col("n").alias("nb"),
            F.col("component").alias("cb"))).alias("p")).select("key", "p.b", "p.nb", "p.cb")
        pairs = placed.join(pivot.hint("merge"), "key").where("component <> cb").select(
            F.least("cls", "b").alias("a"), F.greatest("cls", "b").alias("b"), F.col("n").alias("na"), "nb").where(sized)
        pairs = pairs.select("a", "b").distinct()
        if seen is not None:
            pairs = pairs.join(seen.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
        found = kept(_verified(pairs, sets), f"{home}/round-{number}")
        seen = found if seen is None else seen.unionAll(found)
        links = seen.where(link).select("a", "b")
        joined = components(links, f"{home}/components-{number}")
        group = member.select(F.col("cls").alias("id")).distinct().join(joined.hint("merge"), "id", "left").select(
            F.col("id").alias("cls"), F.coalesce("component", "id").alias("component"))
        group = kept(group, f"{home}/group-{number}")

    links = links.unionAll(kept(_rest(member, group, signs, sets, width, percent, home), f"{home}/rest"))
    joined = components(links, f"{home}/components")
    of_class = classes.join(joined.select(F.col("id").alias("cls"), "component").hint("merge"), "cls", "left").select(
        "set_key", F.coalesce("component", "cls").alias("component"))
    # documents without a set link with nothing; their null keys stay out of the join
    told = profile.where("set_key is not null").select("doc_id", "n", "set_key").join(of_class.hint("merge"), "set_key").select(
        "doc_id", "n", "component").unionAll(profile.where("set_key is null").select("doc_id", "n", "doc_id"))
    return told.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id"))


def _limit(coordinates: int, percent: int) -> int:
    """Coordinates that a link's signatures agree in, but for chances of ``SIGMAS`` standard deviations."""
    share = percent / 100
    return int(coordinates * (share - SIGMAS * math.sqrt(share * (1 - share) / coordinates)))


def _forest(group: dict[str, np.ndarray], least: int, percent: int) -> list[tuple[int, int]]:
    """Edges that join the rows of a group: a pair in different components that agrees in ``least`` coordinates and,
    where the group has full sets, is a link.  Pairs that earlier edges connect are passed over."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    edges, sets = [], group.get("shingles")
    right = np.flatnonzero(group["right"])
    signs, cls, n, component = group["signs"][right], group["cls"][right], group["n"][right], group["component"][right]
    for i in np.flatnonzero(group["left"]):
        mine, size = int(group["cls"][i]), int(group["n"][i])
        alike = (signs == group["signs"][i]).sum(axis=1) >= least
        fits = 100 * np.minimum(n, size) >= percent * np.maximum(n, size)
        own = np.frombuffer(sets[i], np.uint64) if sets is not None else None
        for j in np.flatnonzero(alike & fits & (component != group["component"][i])):
            a, b = find(mine), find(int(cls[j]))
            if a == b:
                continue
            if own is not None:
                other = np.frombuffer(sets[right[j]], np.uint64)
                at = np.minimum(np.searchsorted(other, own), len(other) - 1)
                both = int((other[at] == own).sum())
                if 100 * both < percent * (len(own) + len(other) - both):
                    continue
            root[max(a, b)] = min(a, b)
            edges.append((mine, int(cls[j])))
    return edges


def _blocks(coordinates: int, percent: int):
    """Forests of the groups (key, p, q).  Rows come sorted by group; only the rows of one group are held."""
    least = _limit(coordinates, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def joined(cuts: np.ndarray) -> pa.RecordBatch:
            edges = [e for a, b in zip(cuts[:-1], cuts[1:])
                     for e in _forest({k: v[a:b] for k, v in held.items()}, least, percent)]
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            rows = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}
            rows["signs"] = np.frombuffer(b"".join(rows["signs"]), np.uint8).reshape(-1, coordinates)
            held = {k: np.concatenate([held[k], rows[k]]) for k in rows} if held else rows
            if len(held["key"]):
                new = np.any([held[c][1:] != held[c][:-1] for c in ("key", "p", "q")], axis=0)
                cuts = np.concatenate([[0], np.flatnonzero(new) + 1])
                yield joined(cuts)
                held = {k: v[cuts[-1]:] for k, v in held.items()}
        if held and len(held["key"]):
            yield joined(np.array([0, len(held["key"])]))

    return run


def _paired(placed: DataFrame, payload: DataFrame, width: int, percent: int) -> DataFrame:
    """Forests over ``placed(key, cls, n, component)``: members outside a key's first component against all its members,
    in blocks of both, so a crowded key is spread over many tasks."""
    stats = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                      F.count("*").alias("all")).where("lo < hi")
    placed = placed.join(stats.hint("merge"), "key")
    others = placed.groupBy("key").agg(F.sum((F.col("component") != F.col("lo")).cast("long")).alias("others"))
    placed = placed.join(others.hint("merge"), "key").select(
        "key", "cls", "n", "component", (F.col("component") != F.col("lo")).alias("is_other"),
        F.ceil(F.col("others") / BLOCK).cast("long").alias("ps"), F.ceil(F.col("all") / BLOCK).cast("long").alias("qs"))
    salt, columns = F.xxhash64("cls", "key"), ("key", "cls", "n", "component")
    left = placed.where("is_other").select(*columns, F.pmod(salt, "ps").alias("p"), F.explode(F.expr("sequence(0L, qs - 1)")).alias("q"),
                                           F.lit(True).alias("left"), F.lit(False).alias("right"))
    right = placed.select(*columns, F.explode(F.expr("sequence(0L, ps - 1)")).alias("p"), F.pmod(salt, "qs").alias("q"),
                          F.lit(False).alias("left"), F.lit(True).alias("right"))
    rows = left.unionAll(right).join(payload.hint("merge"), "cls").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return rows.mapInArrow(_blocks(width * ROWS, percent), "a long, b long")


def _rest(member: DataFrame, group: DataFrame, signs: DataFrame, sets: DataFrame, width: int, percent: int,
          home: str) -> DataFrame:
    """Links between components that share a bucket (enough of them to connect whatever is linked).

    Buckets overlap a lot, so signatures first tell which members may be linked at all; clusters of these are then compared on
    their full sets, which travel once per block of a cluster.
    """
    placed = member.join(group.hint("merge"), "cls")
    maybe = kept(_paired(placed, signs, width, percent).distinct(), f"{home}/maybe")
    cluster = components(maybe, f"{home}/clusters").select(F.col("id").alias("cls"), F.col("component").alias("key"))
    sizes = member.select("cls", "n").distinct()
    placed = cluster.join(sizes.hint("merge"), "cls").join(group.hint("merge"), "cls").select("key", "cls", "n", "component")
    return _paired(placed, signs.join(sets.hint("merge"), "cls"), width, percent)
