"""Quality rules by the divergence of a document from its language.

Every document is reduced to two histograms: its code points by character class and its
words by the most common words of a language (all other words are one bin).  They are compared
with the histograms of each language by the Jensen-Shannon distance (base 2, so 0 to 1); the language
that is closest counts.  A document with too few characters or words for a histogram
is not judged by it.  Language histograms are counted over all documents with a language.

The fewer words a document has, the further it is by chance.  So the limit for words is what chance alone explains: the
mean and ``SPREADS`` standard deviations of the distance between as many words drawn from the language's histogram and as
many as the histogram was counted from, drawn anew, beside which ``TOPIC`` is allowed for the subject (added in squares).
It follows from the histogram and the number of words, not from how many other documents are judged.  A document without
any common word is only about 0.5 away, which chance reaches too with fewer than about a hundred words.

Beside them stand plain counts of words, symbols, repeated lines and repeated word
triples.  Words are ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retally.llm.common import kept, ready, slices, texts, workspace

#: Words of a language's histogram; its size does not grow with the corpus.
COMMON = 200
#: Shorter documents are not judged by their histograms.
LEAST_CHARS, LEAST_WORDS = 200, 50
#: A document whose characters are further than this from every language is not kept.
FAR_CHARS = 0.3
#: Limits for words: standard deviations above the mean, what a subject adds, and draws for each length.
SPREADS, TOPIC, DRAWS = 4, 0.15, 200
#: Lengths drawn for each doubling, and how many; the last one is 2^20 words, where chance is nothing.
PER_OCTAVE, LENGTHS = 2, 41
#: Entries a task of the census folds before it gives them out, and cells of a matrix of documents by words.
FOLD, CELLS = 400_000, 4_000_000
CLASSES = ("lower", "upper", "digit", "stop", "symbol", "space", "other_letter", "other", "mark", "other_space")

_CLASS = np.full(128, 7, np.uint8)
for _c in range(128):
    _ch = chr(_c)
    _CLASS[_c] = (0 if _ch.islower() else 1 if _ch.isupper() else 2 if _ch.isdigit() else 3 if _ch in ".,;:!?'\"-()"
                  else 5 if _ch in " \t\n\r\x0b\x0c" else 4 if _ch.isprintable() else 7)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@cache
def _classes() -> np.ndarray:
    """Class of every code point: ASCII as above, others by their general category."""
    of = {"Ll": 0, "Lu": 1, "Lt": 1, "N": 2, "P": 3, "S": 4, "L": 6, "M": 8, "Z": 9}
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)]
    table = np.array([of.get(k, of.get(k[0], 7)) for k in kinds], np.uint8)
    table[:128] = _CLASS
    return table


def char_histogram(text: bytes) -> np.ndarray:
    """Code points by class."""
    if text.isascii():
        return np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=len(CLASSES))
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
    return np.bincount(_classes()[points], minlength=len(CLASSES))


def folded(word: bytes) -> bytes:
    return word.lower() if word.isascii() else word.decode("utf-8", "replace").lower().encode()


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance between rows of ``p`` and of ``q`` (counts; broadcast against each other)."""
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1e-300)
    q = q / np.maximum(q.sum(axis=-1, keepdims=True), 1e-300)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda x: np.where(x > 0, x * np.log2(x / m), 0).sum(axis=-1)
        return np.sqrt(np.maximum(0, (part(p) + part(q)) / 2))


def _census(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language: code points by class (kind 0, the class's number) and words in lower case (kind 1) with their counts."""
    chars: dict[str, np.ndarray] = {}
    words: dict[str, dict[bytes, int]] = {}

    def out() -> pa.RecordBatch:
        langs, kinds, keys, counts = [], [], [], []
        for lang, histogram in chars.items():
            small: dict[bytes, int] = {}
            for word, n in words[lang].items():
                word = folded(word)
                small[word] = small.get(word, 0) + n
            langs += [lang] * (len(histogram) + len(small))
            kinds += [0] * len(histogram) + [1] * len(small)
            keys += [str(i).encode() for i in range(len(histogram))] + list(small)
            counts += histogram.tolist() + list(small.values())
        chars.clear()
        words.clear()
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(kinds, pa.int32()),
                                           pa.array(keys, pa.binary()), pa.array(counts, pa.int64())],
                                          names=["lang", "kind", "item", "n"])

    for batch in slices(batches):
        for lang, text in zip(batch.column(batch.schema.get_field_index("lang")).to_pylist(), texts(batch)):
            chars[lang] = chars.get(lang, 0) + char_histogram(text)
            own = words.setdefault(lang, {})
            for word in text.split():
                own[word] = own.get(word, 0) + 1
        if sum(map(len, words.values())) > FOLD:
            yield out()
    yield out()


class References:
    """Histograms of all languages, the distance of documents to the closest one, and its limits."""

    def __init__(self, chars: dict[str, np.ndarray], words: dict[str, dict[bytes, int]], totals: dict[str, int]):
        self.langs = sorted(chars)
        self.chars = np.array([chars[x] for x in self.langs], float).reshape(len(self.langs), len(CLASSES))
        self.words = {w: i for i, w in enumerate(sorted({w for x in words.values() for w in x}))}
        # bins of a language are its own common words; the others' words are its rest
        self.own = [np.array(sorted(self.words[w] for w in words.get(lang, {})), np.int64) for lang in self.langs]
        at = sorted(self.words)
        self.table = []
        for lang, own in zip(self.langs, self.own):
            counts = np.array([words[lang][at[i]] for i in own], float)
            self.table.append(np.append(counts, totals.get(lang, 0) - counts.sum()))
        self.limits = np.array([_limits(histogram) for histogram in self.table]).reshape(len(self.langs), LENGTHS)

    def of_chars(self, histogram: np.ndarray) -> float:
        return float(distance(histogram[None, :], self.chars).min())

    def of_words(self, words: np.ndarray, document: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
        """Per document: distance to the closest language, and which it is.

        ``words`` are numbers in ``self.words``, or one more than the last for all others, of the documents ``document``.
        """
        width = len(self.words) + 1
        far, closest = np.full(documents, np.inf), np.zeros(documents, np.int64)
        step = max(1, CELLS // width)
        for first in range(0, documents, step):
            here = (document >= first) & (document < first + step)
            rows = min(step, documents - first)
            known = np.bincount((document[here] - first) * width + words[here], minlength=rows * width).reshape(rows, width)
            total = known.sum(axis=1, keepdims=True)
            part = slice(first, first + rows)
            for i, (own, reference) in enumerate(zip(self.own, self.table)):
                mine = known[:, own]
                # rows in one piece, so that a row's sums do not depend on the rows beside it
                mine = np.ascontiguousarray(np.append(mine, total - mine.sum(axis=1, keepdims=True), axis=1))
                away = distance(mine, reference[None, :])
                nearer = away < far[part]
                far[part] = np.where(nearer, away, far[part])
                closest[part] = np.where(nearer, i, closest[part])
        return far, closest

    def word_limits(self, words: np.ndarray, closest: np.ndarray) -> np.ndarray:
        """How far documents of so many words may be, between the lengths that were drawn by the logarithm."""
        place = np.minimum(PER_OCTAVE * np.log2(np.maximum(words, 1)), LENGTHS - 1)
        least = np.minimum(np.floor(place).astype(np.int64), LENGTHS - 2)
        low, high = self.limits[closest, least], self.limits[closest, least + 1]
        return low + (high - low) * (place - least)


def _limits(histogram: np.ndarray) -> list[float]:
    """By length: how far documents of the language are taken by chance and subject."""
    total = int(histogram.sum())
    draw = np.random.default_rng(1)
    out = []
    for length in range(LENGTHS):
        least = int(np.ceil(2 ** (length / PER_OCTAVE)))
        if not total:
            drawn = again = np.ones((1, 1))
        else:
            drawn, again = (draw.multinomial(n, histogram / total, DRAWS).astype(float) for n in (least, total))
        away = distance(drawn, again)
        out.append(float(np.hypot(away.mean() + SPREADS * away.std(), TOPIC)))
    return out


def learn(docs: DataFrame) -> References:
    """Histograms over all ``docs(text, lang)`` with both."""
    spark = docs.sparkSession
    ready(spark)
    counts = docs.select("lang", "text").where("lang is not null and text is not null").mapInArrow(
        _census, "lang string, kind int, item binary, n long").groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    counts = kept(counts, f"{workspace(spark, 'census')}/counts")
    total = counts.where("kind = 1").groupBy("lang").agg(F.sum("n").alias("n")).collect()
    # every task keeps its most common words before they meet
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item"))
    top = counts.withColumn("place", rank).where(F.col("place") <= COMMON).collect()
    chars, words = {}, {}
    for lang, kind, item, n, _ in top:
        if kind == 0:
            chars.setdefault(lang, np.zeros(len(CLASSES)))[int(bytes(item))] = n
        else:
            words.setdefault(lang, {})[bytes(item)] = n
    return References(chars, words, dict(map(tuple, total)))


def repeated_words(words: np.ndarray, document: np.ndarray, documents: int) -> np.ndarray:
    """Per document: words in windows of three that occur twice or more in it.

    ``words`` are the words of all documents one after the other, as numbers; ``document`` tells whose each is.
    """
    n = len(words)
    if n < 3:
        return np.zeros(documents, np.int64)
    _, word = np.unique(words, return_inverse=True)
    pair = word[:-1].astype(np.int64) * (word.max() + 1) + word[1:]
    _, pair = np.unique(pair, return_inverse=True)
    _, triple = np.unique(pair[:-1].astype(np.int64) * (word.max() + 1) + word[2:], return_inverse=True)
    inside = np.flatnonzero(document[:-2] == document[2:])
    _, which, times = np.unique(triple[inside].astype(np.int64) * documents + document[inside],
                                return_inverse=True, return_counts=True)
    start = inside[times[which] > 1]
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[start + i] = True
    return np.bincount(document[covered], minlength=documents)


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()] if b"\n" in text else ()
    return len(lines) - len(set(lines))


COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "char_distance double, word_distance double, word_limit double")
_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    *[(c, pa.float64()) for c in ("char_distance", "word_distance", "word_limit")]])


def judge(docs: DataFrame, references: References) -> DataFrame:
    """Counts, distances, limits and verdict for every row of ``docs(doc_id, text)``.

    Null text has no words.  ``char_distance``, the distance by words and its limit are null for a document that is too
    short for them, or if no language is known.  Repeated rows are judged alike, and a row's verdict depends
    on its own text and the references only.  Other columns are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    data = spark.sparkContext.broadcast(references)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = data.value
        for batch in slices(batches):
            number: dict[bytes, int] = {}
            flat, sizes, rows = [], [], []
            for text in texts(batch):
                words = text.split()
                flat.extend([number.setdefault(w, len(number)) for w in words])
                sizes.append(len(words))
                histogram = char_histogram(text)
                points = int(histogram.sum())
                chars = known.of_chars(histogram) if known.langs and points >= LEAST_CHARS else None
                symbols = int(_SYMBOL[np.frombuffer(text, np.uint8)].sum())
                rows.append((points - int(histogram[5]), symbols, repeated_lines(text), chars))
            flat, sizes = np.array(flat, np.int64), np.array(sizes, np.int64)
            document = np.repeat(np.arange(len(sizes)), sizes)
            repeats = repeated_words(flat, document, len(sizes))
            unjudged = sizes < LEAST_WORDS if known.langs else np.ones(len(sizes), bool)
            common = np.array([known.words.get(folded(w), len(known.words)) for w in number], np.int64)
            away, closest = known.of_words(common[flat] if len(flat) else flat, document, len(sizes))
            limit = known.word_limits(sizes, closest) if known.langs else away
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("doc_id")), pa.array(sizes), pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(repeats, pa.int64()),
                pa.array(columns[3], pa.float64()),
                *[pa.array(x, pa.float64(), mask=unjudged) for x in (away, limit)],
            ], schema=_SCHEMA)

    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, COLUMNS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    past = lambda value, limit: F.coalesce(F.col(value) > limit, F.lit(False))
    far = past("char_distance", F.lit(FAR_CHARS)) | past("word_distance", F.col("word_limit"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


def quality(docs: DataFrame) -> DataFrame:
    """Rows of ``docs(doc_id, text, lang)`` judged by references counted over those with a text and a language."""
    return judge(docs, learn(docs))
