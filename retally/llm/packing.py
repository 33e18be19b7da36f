"""Packing of tokenized documents into sequences of one width.

Bounded-space online packing: a task keeps a fixed number of open windows.  Whole
widths of a document are sequences of their own; its rest goes into the open window
that it fits best.  If it fits none, the fullest window is emitted; should that one still
have more than ``SLACK`` places, the head of the rest fills them and the tail is placed
anew.  What is open at the end of a task is merged with the open windows of a few
other tasks, best fit in falling size; windows that stay part-filled are joined and
cut, which leaves one per group; groups of groups follow until one is left.  So padding is
at most ``SLACK`` places per sequence and one part-filled sequence in all, and no
task ever holds more than the open windows of ``FAN_IN`` others.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from retally.llm.common import ready, slices, texts, workspace

OPEN = 64
SLACK = 8
FAN_IN = 16
#: Known words after which a worker sets them aside and drops those set aside before.  Only speed depends on it.
KNOWN = 500_000
#: New words tokenized in one call, and the rare word between them.  Only speed depends on them.
TOGETHER, MARK = 128, "^"
#: A step of a normalizer without effect where white space is dropped.
BLANKS = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
#: First byte of the marks (U+0300 to U+033F) that can join with an ASCII letter to one character.
ACCENT = b"\xcc"

COLUMNS = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long, open boolean, part long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_()), ("part", pa.int64())])


class Words:
    """Ids of texts by the words between ASCII white space, each tokenized once.

    The tokenizer must drop white space and never join across it.  An added token in a text is its one id, as in
    the tokenizer itself; with ``literal`` it is text like any other.
    """

    def __init__(self, file: str, literal: bool = True):
        model = json.loads(file)
        added = [] if literal else model["added_tokens"]
        plain = not any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized"))
        self._added = {t["content"].encode(): np.array([t["id"]], "<u4").tobytes() for t in added} if plain else {}
        longest = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")")
        # added tokens that look beside them, or at lower case, are left to the whole tokenizer
        self._whole = None if plain else Tokenizer.from_str(file)
        if not literal:
            model["added_tokens"] = []
        normalizer = model["normalizer"] or {}
        steps = [s for s in normalizer.get("normalizers", [normalizer]) if s and s != BLANKS]
        model["normalizer"] = {"type": "Sequence", "normalizers": steps}
        self._tokenizer = Tokenizer.from_str(json.dumps(model))
        self._tokenizer.encode_special_tokens = True
        self._lower = {"type": "Lowercase"} in steps
        self._known: dict[bytes, bytes] = {}
        self._aside: dict[bytes, bytes] = {}
        mark = self._tokenizer.encode(MARK, add_special_tokens=False).ids
        self._mark, self._between = mark[0] if len(mark) == 1 else -1, f" {MARK} "

    def _single(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _several(self, words: list[str]) -> list[bytes]:
        """Words in one text with marks between them; where a word has the id of a mark itself, each word alone."""
        ids = np.array(self._tokenizer.encode_batch_fast([self._between.join(words)], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(ids == self._mark)
        if len(at) != len(words) - 1:
            return self._single(words)
        data, at = ids.tobytes(), (4 * at).tolist()
        return [data[start:end] for start, end in zip([0, *(x + 4 for x in at)], [*at, len(data)])]

    def encode(self, batch: list[bytes]) -> list[bytes]:
        if self._whole is not None:
            return [np.array(self._whole.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes() for text in batch]
        # added tokens are cut out of the text as it is, before anything is lower-cased or split
        cut = [self._cut.split(text) if any(t in text for t in self._added) else [text] for text in batch]
        ids = iter(self._encode([piece for pieces in cut for piece in pieces[::2]]))
        return [b"".join([self._added[x] if i % 2 else next(ids) for i, x in enumerate(pieces)]) for pieces in cut]

    def _encode(self, batch: list[bytes]) -> list[bytes]:
        if len(self._known) > KNOWN:
            self._aside, self._known = self._known, {}
        known, aside = self._known, self._aside
        # a word has the ids of its lower case, unless an accent joins with one of the two cases only
        split = [(text.lower() if self._lower and ACCENT not in text else text).split() for text in batch]
        words = set().union(*split).difference(known)
        again = [word for word in words if word in aside]
        known.update(zip(again, map(aside.__getitem__, again)))
        new = list(words.difference(again))
        for start in range(0, len(new), TOGETHER):
            some = new[start:start + TOGETHER]
            known.update(zip(some, self._several([word.decode() for word in some])))
        return [b"".join(map(known.__getitem__, words)) for words in split]


_LOADED: dict[str, Words] = {}


def _loaded(name: str, data) -> Words:
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Words(data.value, literal=False)
    return _LOADED[name]


class Windows:
    """The open windows of one task, by free places."""

    def __init__(self, width: int, most: int):
        self.width, self.most = width, most
        self._free: list[tuple[int, int]] = []
        self._held: dict[int, list[tuple]] = {}
        self._next = 0

    def new(self) -> int:
        self._next += 1
        return self._next - 1

    def place(self, doc: int | None, start: int, ids: bytes, doc_tokens: int) -> Iterator[tuple[int, list[tuple]]]:
        """Puts a piece of less than a width; yields the windows that this closes."""
        while ids:
            size = len(ids) // 4
            at = bisect_left(self._free, (size, -1))
            if at == len(self._free):
                if len(self._free) < self.most:
                    number = self.new()
                    self._held[number] = []
                    insort(self._free, (self.width, number))
                    continue
                free, number = self._free.pop(0)
                if free > SLACK:
                    head, ids = ids[:4 * free], ids[4 * free:]
                    self._held[number].append((doc, start, head, doc_tokens, self.width - free))
                    start += free
                yield number, self._held.pop(number)
                continue
            free, number = self._free.pop(at)
            self._held[number].append((doc, start, ids, doc_tokens, self.width - free))
            if free - size <= SLACK:
                yield number, self._held.pop(number)
            else:
                insort(self._free, (free - size, number))
            return

    def rest(self) -> Iterator[tuple[int, list[tuple]]]:
        yield from self._held.items()


def _rows(found: list[tuple], part: int) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [()] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip([*columns, [part] * len(found)], _SCHEMA)], schema=_SCHEMA)


def _first(name: str, data, width: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, windows, part = _loaded(name, data), Windows(width, OPEN), TaskContext.get().partitionId()
        closing = np.array([end], "<u4").tobytes()
        number = lambda n: part << 24 | n
        for batch in slices(batches):
            found = []
            for doc, ids in zip(batch.column(batch.schema.get_field_index("doc_id")).to_pylist(),
                                words.encode(texts(batch))):
                ids += closing
                total = len(ids) // 4
                whole = total - total % width
                for start in range(0, whole, width):
                    found.append((doc, start, ids[4 * start:4 * (start + width)], total, number(windows.new()), 0, False))
                for n, pieces in windows.place(doc, whole, ids[4 * whole:], total):
                    found += [(*p[:4], number(n), p[4], False) for p in pieces]
            yield _rows(found, part)
        yield _rows([(*p[:4], number(n), p[4], True) for n, pieces in windows.rest() for p in pieces], part)

    return run


def merge_windows(pdf: pd.DataFrame, width: int, level: int, group: int, last: bool) -> pd.DataFrame:
    """Open windows of several tasks (or groups) put together; at most one stays open, none at the last level."""
    windows = [w.sort_values("offset") for _, w in pdf.groupby("sequence_id", sort=True)]
    windows = [[tuple(r) for r in w[["doc_id", "start", "ids", "doc_tokens"]].itertuples(index=False)] for w in windows]
    size = lambda w: sum(len(p[2]) for p in w) // 4
    bins, free = [], []
    for w in sorted(windows, key=size, reverse=True):
        n = size(w)
        at = bisect_left(free, (n, -1))
        if at == len(free):
            bins.append(list(w))
            insort(free, (width - n, len(bins) - 1))
        else:
            room, number = free.pop(at)
            bins[number] += w
            insort(free, (room - n, number))
    room = dict((number, f) for f, number in free)
    done = [b for i, b in enumerate(bins) if room[i] <= SLACK]
    current, filled = [], 0
    for i, b in enumerate(bins):
        if room[i] <= SLACK:
            continue
        for doc, start, ids, total in b:
            while ids:
                take = min(len(ids) // 4, width - filled)
                current.append((doc, start, ids[:4 * take], total))
                start, ids, filled = start + take, ids[4 * take:], filled + take
                if filled == width:
                    done.append(current)
                    current, filled = [], 0
    out = [(b, False) for b in done] + ([(current, not last)] if current else [])
    rows = []
    for n, (pieces, is_open) in enumerate(out):
        offset = 0
        for doc, start, ids, total in pieces:
            rows.append((doc, start, ids, total, level << 56 | group << 24 | n, offset, is_open, group))
            offset += len(ids) // 4
    return pd.DataFrame(rows, columns=[f.name for f in _SCHEMA]).astype({"doc_id": "Int64"})


def _merging(width: int, level: int, last: bool):
    return lambda key, pdf: merge_windows(pdf, width, level, int(key[0]), last)


def pack(docs: DataFrame, tokenizer_file: str, width: int = 2048, end: int = 1) -> DataFrame:
    """Pieces ``(doc_id, start, ids, doc_tokens, sequence_id, offset)`` of all ``docs(doc_id, text)``.

    ``ids`` are little-endian unsigned 32-bit.  Null text is empty, and an empty text is its closing id
    alone.  Repeated rows are packed once each, null ids are kept; other columns are not read.
    An empty table gives no pieces.
    """
    spark = docs.sparkSession
    ready(spark)
    with open(tokenizer_file, encoding="utf-8") as file:
        raw = file.read()
    name, data = hashlib.sha256(raw.encode()).hexdigest(), spark.sparkContext.broadcast(raw)
    home = workspace(spark, "packing")

    def stored(df: DataFrame, folder: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    level = 0
    table = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _first(name, data, width, end), COLUMNS), f"{home}/0")
    closed, parts = table.where("not open"), table.agg(F.max("part")).first()[0]
    while parts is not None:
        level, parts = level + 1, parts // FAN_IN
        last = parts == 0

        group = F.floor(F.col("part") / FAN_IN).cast("long").alias("part")
        left = table.where("open").withColumn("part", group)
        table = stored(left.groupBy("part").applyInPandas(_merging(width, level, last), COLUMNS), f"{home}/{level}")
        closed = closed.unionAll(table.where("not open"))
        if last:
            break
    return closed.select("doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset")


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
