"""Byte-level BPE encoding and decoding by numpy matrices.

A text is split by the vocabulary's pattern; each match is encoded by itself.  New
matches of a batch are put into matrices by length (rows padded to the longest of
their bucket).  Every round each row merges its leftmost pair of least rank: pairs
are looked up in a hash table over (left id, right id), the row is compacted by one
place and only the two pairs next to the merge are looked up again; rows without
a mergeable pair leave the matrix.  A match longer than ``LONG`` bytes (a run
without spaces) merges in the same order through a heap, since rounds over one
long row would take quadratic time.

Results are those of the tiktoken library's ``encode_ordinary``.  Null is the empty
text; the empty text has no ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from retally.llm.common import HashTable, ready, slices, texts

LONG = 512
#: Known matches a worker keeps at hand; beyond it starts afresh.  Only speed depends on it.
KNOWN = 300_000
_NONE = np.int32(2 ** 31 - 1)
_AMBIGUOUS = regex.compile(r"\s\s\s|\s\Z")


class ByteBPE:
    """One vocabulary: ``ranks`` maps the bytes of a token to its id, lower ids merging first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {i: t for t, i in ranks.items()}
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        self._pairs, self._merged = HashTable(np.array(keys, np.uint64)), np.array([*merged, _NONE], np.int32)
        self._known: dict[str, bytes] = {}

    @classmethod
    def from_file(cls, data: bytes, pattern: str) -> ByteBPE:
        lines = (line.split() for line in data.splitlines() if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the merged pair, or ``_NONE``."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        return self._merged[self._pairs.rows(key.ravel())].reshape(key.shape)

    def _matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of two bytes or more, of about one length."""
        width = max(map(len, pieces))
        length = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        pad = np.arange(width) >= length[:, None]
        ids = np.where(pad, _NONE, self._byte[raw])
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        row, out = np.arange(len(pieces)), [None] * len(pieces)
        while True:
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            least = rank[np.arange(len(row)), at] if rank.shape[1] else np.full(len(row), _NONE)
            done = least == _NONE
            if done.any():
                for r, i in zip(row[done], np.flatnonzero(done)):
                    out[r] = ids[i][ids[i] != _NONE]
                row, ids, rank, at, least = row[~done], ids[~done], rank[~done], at[~done], least[~done]
            if not len(row):
                return out
            n, line = len(row), np.arange(len(row))
            ids[line, at] = least
            keep = np.ones(ids.shape, bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(n, -1)
            keep = np.ones(rank.shape, bool)
            keep[line, at] = False
            rank = rank[keep].reshape(n, -1)
            before = line[at > 0]
            rank[before, at[before] - 1] = self._rank(ids[before, at[before] - 1], ids[before, at[before]])
            after = line[at < rank.shape[1]]
            rank[after, at[after]] = self._rank(ids[after, at[after]], ids[after, at[after] + 1])

    def _long(self, piece: bytes) -> np.ndarray:
        ids = self._byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self._rank(np.array(ids[:-1]), np.array(ids[1:])).tolist() + [int(_NONE)]
        heap = [(r, i) for i, r in enumerate(pair) if r != _NONE]
        heapq.heapify(heap)

        def look(i: int) -> None:
            j = following[i]
            both = self.ranks.get(self.token[ids[i]] + self.token[ids[j]]) if j < n else None
            pair[i] = int(_NONE) if both is None else both
            if both is not None:
                heapq.heappush(heap, (both, i))

        while heap:
            rank, i = heapq.heappop(heap)
            if pair[i] != rank:
                continue
            j = following[i]
            ids[i], ids[j], pair[j] = rank, -1, int(_NONE)
            following[i] = following[j]
            if following[i] < n:
                previous[following[i]] = i
            look(i)
            if previous[i] >= 0:
                look(previous[i])
        return np.array([i for i in ids if i >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONG:
                out[i] = self._long(piece).astype("<u4").tobytes()
            else:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for which in buckets.values():
            for start in range(0, len(which), 8192):
                part = which[start:start + 8192]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part])):
                    out[i] = ids.astype("<u4").tobytes()
        return out

    def _chunks(self, text: str) -> list[str]:
        """Parts of a text whose matches do not depend on each other: a space begins a part.

        A run of three white spaces or white space at the end may be split differently in parts.
        """
        if _AMBIGUOUS.search(text):
            return self.pattern.findall(text)
        first, *rest = text.split(" ")
        return [first, *(" " + part for part in rest)]

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        known = self._known
        if len(known) > KNOWN:
            known.clear()
        parts = [self._chunks(text) for text in batch]
        new = list({part for one in parts for part in one if part not in known})
        matches = [self.pattern.findall(part) for part in new]
        distinct = list({m for one in matches for m in one})
        ids = dict(zip(distinct, self.encode_pieces([m.encode() for m in distinct])))
        for part, one in zip(new, matches):
            known[part] = b"".join([ids[m] for m in one])
        return [b"".join([known[part] for part in one]) for one in parts]

    def decode(self, ids: bytes) -> bytes:
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def loaded(name: str, data, pattern: str) -> ByteBPE:
    """The vocabulary a worker has at hand, made from the broadcast file once."""
    if (name, pattern) not in _LOADED:
        _LOADED.clear()
        _LOADED[name, pattern] = ByteBPE.from_file(data.value, pattern)
    return _LOADED[name, pattern]


def encode(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """``docs(doc_id, text)`` with ``ids`` (little-endian unsigned 32-bit) and ``decoded`` (their bytes).

    One row per row, whatever the ids; other columns are not read.  ``ranks_file`` is a
    vocabulary of fixed size, read by the driver and sent to the workers.
    """
    spark = docs.sparkSession
    ready(spark)
    with open(ranks_file, "rb") as file:
        raw = file.read()
    name, data = hashlib.sha256(raw).hexdigest(), spark.sparkContext.broadcast(raw)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(name, data, pattern)
        for batch in slices(batches):
            ids = bpe.encode_batch([t.decode() for t in texts(batch)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(ids, pa.binary()),
                 pa.array(list(map(bpe.decode, ids)), pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of encoded documents."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

