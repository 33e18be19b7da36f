"""Language of a text by prediction with partial matching (PPM).

For each language the counts of bytes after every context of up to ``ORDER`` bytes form a
context tree.  A byte's probability is that of the longest context seen: with counts c over d distinct
bytes that sum to t, a seen byte has c / (t + d) and the escape to the next shorter context
d / (t + d); bytes that a longer context already offers are excluded in shorter ones.  Below order 0 all
bytes left are equally likely.  The statistics are frozen after training, so the cost of a byte depends on
its ``ORDER`` predecessors only, and the exact code length of a text is a sum over its byte
(ORDER + 1)-grams.  The language with the shortest code wins; the score is its
probability when all languages, and that the text is in none of them, are equally likely beforehand.
A text in no language has ``PLAIN`` bits a byte, all bytes being equally likely: a text that the
best language makes longer than it is as it stands is not one of that language.

Training counts n-grams in Spark over a sample of the labelled texts: blocks of ``BLOCK`` bytes, drawn
by a hash of the id and the block's number, so a long text neither fills the sample nor is missed as a whole.
``SAMPLE_BYTES`` is the expected size of the sample over all
languages together, equally shared (a language with less than its share gives all it has); with it the model's
size is bounded, whatever the corpus.  Scoring covers all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retally.llm.common import HashTable, ready, slices, texts

ORDER = 3
SAMPLE_BYTES = 4_000_000
BLOCK = 2000
#: Text a task works on at once; only memory depends on it.
SLICE_BYTES = 1_000_000
PLAIN = 8
UNKNOWN = "und"
#: A document whose best language is less likely than this has no clear one.
CLEAR = 0.5
_START = b"\n" * ORDER


def folded(text: bytes) -> bytes:
    return text.decode().lower().encode()


def grams(text: bytes, n: int, before: bytes = _START) -> np.ndarray:
    """Keys of the byte n-grams at each place of a text that begins after line feeds; n is part of the key."""
    raw = np.frombuffer(before + text, np.uint8).astype(np.uint64)
    key = np.full(len(text), n, np.uint64)
    for i in range(n):
        at = ORDER + 1 - n + i
        key = key << np.uint64(8) | raw[at:at + len(text)]
    return key


class Model:
    """Frozen context trees of all languages, and the cost in bits of any (ORDER + 1)-gram.

    Every place of a training text is counted at all orders, so what was seen after a context was seen
    after its shorter forms too: excluding a longer context's bytes takes its kinds (and their counts
    in the shorter context) off the shorter one's.
    """

    def __init__(self, langs: list[str], keys: np.ndarray, lang: np.ndarray, count: np.ndarray):
        self.langs = langs
        distinct, row = np.unique(np.asarray(keys, np.uint64), return_inverse=True)
        self._grams = HashTable(distinct)
        self._count = np.zeros((len(distinct) + 1, len(langs)))          # last row: never seen
        np.add.at(self._count, (row, lang), count)
        contexts, at = np.unique(distinct >> np.uint64(8), return_inverse=True)
        self._contexts = HashTable(contexts)
        own = self._count[:-1]
        shorter = self._count[self._grams.rows(_shorter(distinct))]
        self._total, self._kinds, self._below = (np.zeros((len(contexts) + 1, len(langs))) for _ in range(3))
        np.add.at(self._total, at, own)
        np.add.at(self._kinds, at, own > 0)
        np.add.at(self._below, at, np.where(own > 0, shorter, 0))
        known = distinct[_length(distinct) == ORDER + 1]
        self._known, self._cost = HashTable(known), self.bits(known)

    def bits(self, full: np.ndarray) -> np.ndarray:
        """Cost of each (ORDER + 1)-gram (rows) for each language (columns), with exclusion."""
        shape = (len(full), len(self.langs))
        bits, todo, kinds, below = np.zeros(shape), np.ones(shape, bool), np.zeros(shape), np.zeros(shape)
        key = full
        for _ in range(ORDER + 1):
            count, context = self._count[self._grams.rows(key)], self._contexts.rows(key >> np.uint64(8))
            total, offered = self._total[context] - below, self._kinds[context] - kinds
            some = todo & (offered > 0)
            hit = some & (count > 0)
            share = np.where(hit, count, np.where(some, offered, 1)) / np.where(some, total + offered, 1)
            bits -= np.log2(share)
            todo &= ~hit
            seen = self._total[context] > 0
            kinds, below = np.where(seen, self._kinds[context], kinds), np.where(seen, self._below[context], below)
            key = _shorter(key)
        return bits + np.where(todo, np.log2(np.maximum(256 - kinds, 1)), 0)

    def lengths(self, batch: list[bytes]) -> np.ndarray:
        """Code length in bits of each text (rows) for each language (columns)."""
        out = np.zeros((len(batch), len(self.langs)))
        size = np.array([len(t) for t in batch])
        if not size.sum():
            return out
        raw = np.frombuffer(b"".join([_START + t for t in batch]), np.uint8).astype(np.uint64)
        key = np.full(len(raw) - ORDER, ORDER + 1, np.uint64)
        for i in range(ORDER + 1):
            key = key << np.uint64(8) | raw[i:len(raw) - ORDER + i]
        # the places of the line feeds between texts are no places of a text
        inside = np.ones(len(key), bool)
        starts = np.cumsum(size + ORDER)[:-1]
        inside[(starts[:, None] - ORDER + np.arange(ORDER)).ravel()] = False
        key = key[inside]
        row = self._known.rows(key)
        new, where = np.unique(key[row < 0], return_inverse=True)
        row[row < 0] = len(self._cost) + where
        cost = np.concatenate([self._cost, self.bits(new)])
        full, first = np.flatnonzero(size), np.cumsum(size) - size
        for at in range(len(self.langs)):
            out[full, at] = np.add.reduceat(cost[row, at], first[full])
        return out


def _length(key: np.ndarray) -> np.ndarray:
    return ((np.frexp(key.astype(np.float64))[1] - 1) // 8).astype(np.int64)


def _shorter(key: np.ndarray) -> np.ndarray:
    """The n-gram without its first byte."""
    out = np.zeros_like(key)
    for n in range(ORDER + 1, 0, -1):
        mine = (key >> np.uint64(8 * n)) == n
        bits = np.uint64(8 * (n - 1))
        out[mine] = (key[mine] & np.uint64((1 << (8 * (n - 1))) - 1)) | np.uint64(n - 1) << bits
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=SLICE_BYTES):
        found: dict[str, list[np.ndarray]] = {}
        column = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
        for lang, blocks, text in zip(column("lang"), column("blocks"), texts(batch)):
            text = folded(text)
            for at in (i * BLOCK for i in blocks):
                before = _START if at == 0 else text[max(0, at - ORDER):at].rjust(ORDER, b"\n")
                found.setdefault(lang, []).extend(grams(text[at:at + BLOCK], n, before) for n in range(1, ORDER + 2))
        for lang, parts in found.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())],
                names=["lang", "gram", "n"])


def train(labelled: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Context trees from ``labelled(doc_id, text, lang)``; rows with a null text or lang are left out."""
    ready(labelled.sparkSession)
    labelled = labelled.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    sizes = labelled.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return Model([], np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0))
    share = {r["lang"]: min(1.0, sample_bytes / len(langs) / max(1, r["bytes"])) for r in sizes}
    rate = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    blocks = F.filter(F.sequence(F.lit(0), F.floor((F.octet_length("text") - 1) / BLOCK).cast("int")),
                      lambda i: F.pmod(F.xxhash64(F.col("doc_id"), i), F.lit(1 << 30)) < rate * (1 << 30))
    drawn = labelled.where("octet_length(text) > 0").select("text", "lang", blocks.alias("blocks")).where("size(blocks) > 0")
    table = drawn.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")).toArrow()
    number = {lang: i for i, lang in enumerate(langs)}
    lang = np.array([number[x] for x in table["lang"].to_pylist()], np.int64)
    return Model(langs, table["gram"].to_numpy().view(np.uint64), lang, table["n"].to_numpy())


def _judged(batch: pa.RecordBatch, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of a batch."""
    folds = [folded(t) for t in texts(batch)]
    letters = np.array([any(map(str.isalpha, t.decode())) for t in folds], bool)
    if not model.langs:
        return [UNKNOWN] * len(folds), np.zeros(len(folds))
    bits = model.lengths(folds)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(bits)), best]
    plain = PLAIN * np.array([len(t) for t in folds], float)
    gap = np.column_stack([bits, plain]) - least[:, None]
    score = np.where(letters, 1 / np.exp2(np.clip(-gap, -1000, 1000)).sum(axis=1), 0.0)
    return [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)], score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs(doc_id, text)``; nothing else is read.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.  A text in no known language
    still gets the nearest one, with a score next to 0.  Of equally
    short codes the first language in alphabetical order is taken.  Rows are independent of each other,
    so repeated rows get the same answer.
    """
    spark = docs.sparkSession
    ready(spark)
    data = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = data.value
        for batch in slices(batches, most=SLICE_BYTES):
            lang, score = _judged(batch, model)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")),
                                              pa.array(lang, pa.string()), pa.array(score)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def clear(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` (all columns) with a language that scores ``CLEAR`` or more."""
    ready(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            lang, score = _judged(batch, data.value)
            yield batch.filter(pa.array([x != UNKNOWN and p >= CLEAR for x, p in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out() -> Column:
    """Every third document by the checksum of its id is never trained on."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def identified(docs: DataFrame) -> DataFrame:
    """Predictions for all documents by a model of those not held out."""
    model = train(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
