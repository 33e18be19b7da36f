"""How far sources of a language diverge in their words, by in-mapper stripes.

A task folds whole documents into a hash table, term by term: the number of documents and of occurrences per source.  A table
that grows past ``MOST_CELLS`` is spilled as rows and started anew, so memory is bounded by a single document.  Spilled stripes
are merged by (language, term); a merged stripe, cut into ``SOURCES`` sources apiece, emits the divergences of its
term directly: per pair of sources it adds to the pair's sum, per source to the report of terms.

With count c of a term in a group, N the group's occurrences of kept terms and V kept terms in the language,

    p = 1 + floor(PARTS * (c + ADDED) / (N + ADDED * V))

in whole numbers.  A pair's divergence is the sum of |p - q| over all kept terms.  Terms that neither source has differ by the
same amount each, so a task adds ``V`` times that amount once, and for the terms of its stripes only what they differ from it:
the work follows the stripes, not vocabulary times sources.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retally.llm.common import kept, ready, texts, workspace

PARTS, ADDED = 1_000_000_000, 5
#: Cells (source, term) a task holds before it spills; sources of a piece of a stripe; terms a task emits for at once.
MOST_CELLS, SOURCES, TERMS = 300_000, 256, 4096

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CELL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("docs", pa.int64()), ("n", pa.int64())])


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of the documents of a partition, spilled as cells."""
    stripes: dict[tuple[str, str], dict[bytes, list[int]]] = {}
    cells = 0

    def spilled() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in stripes.items():
            counts = np.array(list(terms.values()), np.int64).reshape(-1, 2)
            names = [pa.array([name] * len(terms), pa.string()) for name in (lang, source)]
            yield pa.RecordBatch.from_arrays([*names, pa.array(list(terms), pa.binary()), *map(pa.array, counts.T)], schema=_CELL)
        stripes.clear()

    for batch in batches:
        names = lambda c: ["" if v is None else v for v in batch.column(batch.schema.get_field_index(c)).to_pylist()]
        for text, lang, source in zip(texts(batch), names("lang"), names("source")):
            terms = stripes.setdefault((lang, source), {})
            before = len(terms)
            for term, n in Counter(TERM.findall(text.translate(_LOWER))).items():
                cell = terms.get(term)
                if cell is None:
                    terms[term] = [1, n]
                else:
                    cell[0] += 1
                    cell[1] += n
            cells += len(terms) - before
            if cells > MOST_CELLS:
                yield from spilled()
                cells = 0
    yield from spilled()


def share(count, total) -> np.ndarray:
    """1 + floor(PARTS * (count + ADDED) / total) exactly, for counts up to 2.9e14: PARTS goes in as 31250 * 32000."""
    count, total = np.broadcast_arrays(np.asarray(count, np.int64) + ADDED, np.maximum(np.asarray(total, np.int64), 1))
    if total.size and total.max() > (1 << 63) // 32_000:
        raise OverflowError("more occurrences than 64 bits can divide exactly")
    high, rest = np.divmod(count * 31_250, total)
    return 1 + high * 32_000 + rest * 32_000 // total


_OUT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def emitted(key: tuple[pa.Scalar, ...], heads: pa.Table, stripes: pa.Table) -> pa.Table:
    """Divergences of some terms between the sources of two pieces (``left`` <= ``right``), and the terms of the sources."""
    split, left, right = (k.as_py() for k in key[1:4])
    if not heads.num_rows:
        return _OUT.empty_table()
    names, side = heads["source"].to_pylist(), np.asarray(heads["piece"])
    total, terms, whole = np.asarray(heads["total"]), heads["terms"][0].as_py(), heads["whole"][0].as_py()
    place = {name: i for i, name in enumerate(names)}
    word = stripes["term"].to_pylist()
    distinct = {t: i for i, t in enumerate(dict.fromkeys(word))}
    row = np.array([distinct[t] for t in word], np.int64)
    count, everywhere = np.zeros((len(distinct), len(names)), np.int64), np.zeros(len(distinct), np.int64)
    everywhere[row] = np.asarray(stripes["everywhere"])
    for line, stripe in zip(row, stripes["stripe"].to_pylist()):
        for cell in stripe:
            count[line, place[cell["source"]]] = cell["n"]
    none = share(np.zeros(len(names), np.int64), total)
    p = share(count, total)
    a, b = np.flatnonzero(side == left), np.flatnonzero(side == right)
    lang, out = heads["lang"][0].as_py(), []
    for i in a:
        base = np.abs(none[i] - none[b])
        sums = (np.abs(p[:, i, None] - p[:, b]) - base).sum(axis=0) + (terms * base if split == 0 else 0)
        for j, value in zip(b, sums.tolist()):
            if i != j:
                out.append((names[i], "pair", names[j], value))
                if left != right:
                    out.append((names[j], "pair", names[i], value))
    if left == right and len(distinct):
        word, q = list(distinct), share(everywhere, whole)
        more = (count > 0) & (p > q[:, None])
        for i in range(len(names)):
            out += [(names[i], "term", word[t], int(p[t, i] - q[t])) for t in np.flatnonzero(more[:, i])]
    columns = list(zip(*out)) if out else [()] * 4
    return pa.table([pa.array([lang] * len(out), pa.string()), *(pa.array(c, f.type) for c, f in zip(columns, list(_OUT)[1:]))], schema=_OUT)


def divergences(docs: DataFrame, least_docs: int = 30, most_terms: int = 50) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every (lang, source) of ``docs(text, lang, source)``.

    Part ``pair``: every other source of the language with the summed difference over all kept terms, all ranks (0 where
    nothing is kept).  Part ``term``: the ``most_terms`` terms the source has relatively more of than its language.  A
    term is a run of letters A-Z, in lower case, and characters beyond ASCII; a language keeps those in at least
    ``least_docs`` of its documents.  Null texts, languages and sources count as ''.  Every row is a document, repeated ones too.
    Groups without terms are groups; an empty table gives no rows.  Ties go to the item that is first in UTF-8.  Other columns are
    not read.
    """
    spark = docs.sparkSession
    ready(spark)
    home = workspace(spark, "stripes")
    docs = docs.select("text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    cells = docs.mapInArrow(folded, "lang string, source string, term binary, docs long, n long")
    # spilled stripes of one key meet in one place and are added up there, in bounded memory
    cells = cells.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    of_term = Window.partitionBy("lang", "term")
    merged = kept(cells.withColumn("known", F.sum("docs").over(of_term)).withColumn("everywhere", F.sum("n").over(of_term)).where(
        F.col("known") >= least_docs).select("lang", F.col("term").cast("string").alias("term"), "source", "n", "everywhere"), f"{home}/merged")

    groups = docs.select("lang", "source").distinct()
    counts = merged.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = kept(groups.join(counts, ["lang", "source"], "left").fillna(0, ["n"]), f"{home}/groups")
    vocabulary = merged.groupBy("lang", "term").agg(F.first("everywhere").alias("n")).groupBy("lang").agg(F.count("*").alias("terms"))
    langs = groups.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("int").alias("pieces"), F.sum("n").alias("n")).join(
        vocabulary, "lang", "left").fillna(0, ["terms"]).withColumn("whole", F.col("n") + ADDED * F.col("terms")).withColumn(
        "splits", F.greatest(F.ceil(F.col("terms") / TERMS), F.lit(1)).cast("int")).drop("n")
    langs = kept(langs, f"{home}/langs")

    piece = F.pmod(F.xxhash64("source"), "pieces").cast("int")
    # a piece meets itself and every other piece once; the smaller number is on the left
    others = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    pairs = lambda df: df.withColumn("other", others).withColumn("left", F.least("piece", "other")).withColumn("right", F.greatest("piece", "other"))
    block = ["lang", "split", "left", "right"]
    heads = groups.join(langs, "lang").withColumn("piece", piece).withColumn("total", F.col("n") + ADDED * F.col("terms")).withColumn(
        "split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    heads = pairs(heads).select(*block, "piece", "source", "total", "terms", "whole")
    stripes = merged.join(langs, "lang").withColumn("piece", piece).withColumn("split", F.pmod(F.xxhash64("term"), "splits").cast("int"))
    stripes = stripes.groupBy("lang", "term", "split", "piece", "pieces").agg(
        F.first("everywhere").alias("everywhere"), F.collect_list(F.struct("source", "n")).alias("stripe"))
    stripes = pairs(stripes).select(*block, "term", "everywhere", "stripe")
    out = kept(heads.groupBy(*block).cogroup(stripes.groupBy(*block)).applyInArrow(
        emitted, "lang string, source string, part string, item string, value long"), f"{home}/emitted")

    sums = out.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    terms = out.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= most_terms)
    return sums.withColumn("rank", rank).unionByName(terms)
