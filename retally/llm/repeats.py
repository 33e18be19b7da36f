"""Removal of long repeated passages with a run-length index.

A text's bytes are removed where they are covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller id; overlaps count and all is judged on the input.

Equal strings are brought together by content.  The minimizer of a string (the least hash of its
``GRAM``-byte grams) is the same wherever the string stands, so a text falls into segments of neighbouring strings
that share a minimizer, and equal strings meet under one minimizer.

1. Copies of a whole text are told by digest; only the one with the smallest id goes on.
2. Documents lie in chunks by a hash of the id.  Each chunk sends its minimizers, as sorted short integers, to
   buckets by value and gets back those that two documents share.  Nothing else can hold a repeat.
3. The segments under shared minimizers become one row per distinct segment, with the smallest document id
   (combined on the map side, so a passage in a third of all documents is a row per task), and are gathered by
   minimizer.  A minimizer with more than twice ``INDEX_BYTES`` is split by a longer second one; what is still
   crowded then (runs of a short period) is told string by string, by a map-side combined aggregate.
4. In every bucket the earlier half of the owners under a minimizer is indexed (run-compressed Burrows-Wheeler
   transform with sampled run ends, ``run_index``) and the segments of the later half are streamed through it for
   matching statistics; so again within each half.  A match of ``LENGTH`` bytes is a repeat.
5. Marked places go back to all places of a segment and are united per document.

Everything between the steps is a written table.  No step holds more than a chunk, a bucket or one document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from retally.llm.common import kept, mixed, ready, texts, unused, workspace
from retally.llm.run_index import LENGTH, earlier

GRAM, LONG_GRAM = 20, 44
CHUNK_BYTES = 2_000_000
INDEX_BYTES = 500_000
#: Strings whose minimizers are taken at once: eight bytes each, a few times over, fit a core's cache.
_BLOCK = 1 << 16


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        h, size = np.minimum(h[:-size], h[size:]), size * 2
    rest = width - size
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def minimizers(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """For each string of ``LENGTH`` bytes the least hash of its grams (``gram`` is a multiple of four)."""
    n = len(raw)
    word = np.zeros(max(0, n - 3), np.uint64)
    for i in range(4):
        word |= raw[i:n - 3 + i].astype(np.uint64) << np.uint64(8 * i)
    size = n - gram + 1
    with np.errstate(over="ignore"):
        h = np.full(size, gram, np.uint64)
        for i in range(0, gram, 4):
            h = (h ^ word[i:i + size]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return _least(mixed(h), LENGTH - gram + 1)


def runs(raw: np.ndarray, owner: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of joined texts: minimizer, number of the text, first byte and end in ``raw``."""
    found = []
    for at in range(0, max(0, len(raw) - LENGTH + 1), _BLOCK):
        part, mine = raw[at:at + _BLOCK + LENGTH - 1], owner[at:at + _BLOCK + LENGTH - 1]
        least = minimizers(part, gram)
        whole = mine[:len(least)] == mine[LENGTH - 1:]
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | ~whole[:-1] | (mine[1:len(least)] != mine[:len(least) - 1])
        first = np.flatnonzero(new & whole)
        ends = np.append(np.flatnonzero(new | ~whole), len(least))
        stop = ends[np.searchsorted(ends, first, "right")]
        found.append((least[first], mine[first], at + first, at + stop + LENGTH - 1))
    if not found:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)
    return tuple(np.concatenate(x) for x in zip(*found))


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, number of the text at each byte, ids and first bytes."""
    ids = table["doc_id"].to_numpy()
    values = [v or b"" for v in table["text"].to_pylist()]
    size = np.array([len(v) for v in values], np.int64)
    raw = np.frombuffer(b"".join(values), np.uint8)
    return raw, np.repeat(np.arange(len(values), dtype=np.int32), size), ids, np.cumsum(size) - size


def _without_copies(table: pa.Table) -> pa.Table:
    copies = table.filter(pc.is_null(table["text"]))["doc_id"]
    alone = pc.invert(pc.is_in(table["doc_id"], value_set=copies.combine_chunks()))
    return table.filter(pc.and_(alone, pc.is_valid(table["text"])))


def _short(h: np.ndarray, width: int) -> np.ndarray:
    return h >> np.uint64(64 - 8 * width)


def _packed(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of short minimizers.  These are least values and so mostly small: mixed, they fall evenly."""
    return (mixed(values) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _send(width: int, buckets: int):
    """A chunk's minimizers, and those that two of its documents share, by bucket."""
    schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("all", pa.binary()), ("shared", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        raw, owner, _, _ = _joined(_without_copies(table))
        least, doc, _, _ = runs(raw, owner)
        values = _short(least, width)
        order = np.lexsort((doc, values))
        values, doc = values[order], doc[order]
        new = np.append(True, (values[1:] != values[:-1]) | (doc[1:] != doc[:-1]))[:len(values)]
        values, times = np.unique(values[new], return_counts=True)
        bucket = bucket_of(values, buckets)
        order = np.argsort(bucket, kind="stable")
        values, times = values[order], times[order]
        numbers, first = np.unique(bucket[order], return_index=True)
        parts = list(zip(np.split(values, first[1:]), np.split(times, first[1:]))) if len(numbers) else []
        return pa.table([pa.array(numbers.astype(np.int64)), pa.array([key[0].as_py()] * len(numbers), pa.int64()),
                         pa.array([_packed(v, width) for v, _ in parts], pa.binary()),
                         pa.array([_packed(v[t > 1], width) for v, t in parts], pa.binary())], schema=schema)

    return run


def _answer(width: int):
    """Per chunk the minimizers of a bucket that two documents share."""
    schema = pa.schema([("chunk", pa.int64()), ("hits", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        lists = [_unpacked(v, width) for v in table["all"].to_pylist()]
        values, times = np.unique(np.concatenate(lists), return_counts=True)
        wanted = times > 1
        for v in table["shared"].to_pylist():
            wanted[np.searchsorted(values, _unpacked(v, width))] = True
        hits = [v[wanted[np.searchsorted(values, v)]] for v in lists]
        return pa.table([table["chunk"], pa.array([_packed(h, width) for h in hits], pa.binary())], schema=schema)

    return run


_OCCURRENCE = pa.schema([("segment", pa.binary()), ("minimizer", pa.int64()), ("doc_id", pa.int64()),
                         ("start", pa.int64()), ("size", pa.int64())])


def _cut(width: int):
    """Segments under shared minimizers; of equal ones in a chunk all but the smallest id's are known repeats (no segment)."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        raw, owner, ids, first = _joined(_without_copies(table))
        least, doc, start, end = runs(raw, owner)
        hits = np.concatenate([_unpacked(v, width) for v in answers["hits"].to_pylist()] or [np.empty(0, np.uint64)])
        here = np.flatnonzero(np.isin(_short(least, width), hits))
        here = here[np.argsort(ids[doc[here]], kind="stable")]
        data, seen, segments = raw.tobytes(), {}, []
        doc, start, end = doc[here], start[here], end[here]
        of = ids[doc]
        for d, s, e in zip(of.tolist(), start.tolist(), end.tolist()):
            segment = data[s:e]
            segments.append(segment if seen.setdefault(segment, d) == d else None)
        columns = segments, least[here].view(np.int64), of, start - first[doc], end - start
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _OCCURRENCE)], schema=_OCCURRENCE)

    return run


_MARKED = pa.schema([("sid", pa.binary()), ("owner", pa.int64()), ("times", pa.int64()), ("marks", pa.list_(pa.int64()))])


def _index(table: pa.Table) -> pa.Table:
    """Marks of a bucket's segments.  A segment alone under its minimizer has nothing to be searched for in."""
    minimizer = table["minimizer"].to_numpy()
    _, which, count = np.unique(minimizer, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[which] > 1)
    segments, owner = table["segment"].to_pylist(), table["owner"].to_numpy()
    marks: list = [[]] * len(segments)
    for i, places in zip(several.tolist(), earlier([segments[i] for i in several], minimizer[several], owner[several])):
        marks[i] = [x for span in united([(p, p + LENGTH) for p in places.tolist()]) for x in span]
    return pa.table([pa.array([hashlib.md5(s).digest() for s in segments], pa.binary()), table["owner"], table["times"],
                     pa.array(marks, pa.list_(pa.int64()))], schema=_MARKED)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a crowded minimizer cut by the longer one; ``at`` is the place in the segment."""
    for batch in batches:
        rows = []
        for owner, segment in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("owner", "segment"))):
            sid = hashlib.md5(segment).digest()
            raw = np.frombuffer(segment, np.uint8)
            for least, _, s, e in zip(*(x.tolist() for x in runs(raw, np.zeros(len(raw), np.int64), LONG_GRAM))):
                rows.append((sid, owner, segment[s:e], int(np.uint64(least).view(np.int64)), s))
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
            pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=["outer", "owner", "segment", "minimizer", "at"])


def _marked(distinct: DataFrame, home: str, level: int = 0) -> DataFrame:
    """``(sid, owner, times, marks)`` of distinct segments ``(segment, minimizer, owner, times)``; ``sid`` is their digest."""
    size = F.octet_length("segment")
    total = distinct.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, math.ceil(total / INDEX_BYTES))
    crowded = distinct.groupBy("minimizer").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > 2 * INDEX_BYTES)
    crowded = kept(crowded.select("minimizer"), f"{home}/crowded-{level}")
    split = not crowded.isEmpty()
    ordinary = distinct.join(crowded, "minimizer", "left_anti") if split else distinct
    bucket = F.pmod(F.xxhash64("minimizer"), F.lit(buckets)).alias("bucket")
    done = kept(ordinary.select(bucket, "segment", "minimizer", "owner", "times").groupBy("bucket").applyInArrow(
        _index, "sid binary, owner long, times long, marks array<long>"), f"{home}/marked-{level}")
    if not split:
        return done
    outer = distinct.join(crowded, "minimizer", "left_semi")
    back = _by_pieces(outer, home) if level == 0 else _by_strings(outer)
    back = back.groupBy("sid").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    return done.unionAll(outer.select(_sid().alias("sid"), "owner", "times").join(back, "sid", "left").select(
        "sid", "owner", "times", "marks"))


def _by_pieces(outer: DataFrame, home: str) -> DataFrame:
    """``(sid, marks)``, some rows a segment, of segments cut by the longer minimizer."""
    inner = kept(outer.select("owner", "segment").mapInArrow(
        _pieces, "outer binary, owner long, segment binary, minimizer long, at long"), f"{home}/pieces")
    again = inner.groupBy("segment", "minimizer").agg(F.min("owner").alias("owner"), F.count("*").alias("times"))
    found = _marked(kept(again, f"{home}/inner"), home, 1).select("sid", F.col("owner").alias("earliest"), "marks")
    # a piece of a later owner than the piece's earliest is a repeat as a whole
    return inner.withColumn("sid", _sid()).join(found, "sid").select(
        F.col("outer").alias("sid"),
        F.when(F.col("owner") > F.col("earliest"), F.array("at", F.col("at") + F.octet_length("segment"))).otherwise(
            F.transform("marks", lambda m: m + F.col("at"))).alias("marks"))


def _by_strings(outer: DataFrame) -> DataFrame:
    """``(sid, marks)``, a row for each repeated string of ``LENGTH`` bytes of a segment."""
    strings = outer.select(_sid().alias("sid"), "owner", "segment", F.explode(
        F.sequence(F.lit(0), F.octet_length("segment") - LENGTH)).alias("at")).select(
        "sid", "owner", F.expr(f"substring(segment, at + 1, {LENGTH})").alias("string"), F.col("at").cast("long").alias("at"))
    # a string that a segment of a short period holds many times is one row, with its places
    strings = strings.groupBy("sid", "owner", "string").agg(F.collect_list("at").alias("places"))
    first = strings.groupBy("string").agg(F.min("owner").alias("earliest"), F.max("owner").alias("latest")).where("earliest < latest")
    return strings.join(first, "string").where("owner > earliest").select(
        "sid", F.flatten(F.transform("places", lambda p: F.array(p, p + LENGTH))).alias("marks"))


def _sid():
    return F.unhex(F.md5("segment"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = lambda c: batch.column(batch.schema.get_field_index(c))
        rest, removed, number, flat = [], [], [], []
        for text, copy, starts, ends in zip(texts(batch), column("copy").to_pylist(), column("starts").to_pylist(),
                                            column("ends").to_pylist()):
            spans = united(list(zip(starts or [], ends or [])))
            if copy and len(text) >= LENGTH:
                spans = [(0, len(text))]
            at, left = 0, []
            for s, e in spans:
                left.append(text[at:s])
                at = e
            rest.append(b"".join([*left, text[at:]]))
            removed.append(sum(e - s for s, e in spans))
            number.append(len(spans))
            flat.append([x for span in spans for x in span])
        yield pa.RecordBatch.from_arrays([
            column("doc_id"), pa.array([r + n for r, n in zip(map(len, rest), removed)], pa.int64()),
            pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(flat, pa.list_(pa.int64())),
            pa.array(rest, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])


def _whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without the characters that they cover in part."""
    inner = lambda at: at < len(text) and 0x80 <= text[at] < 0xC0
    out = []
    for start, end in spans:
        while inner(start):
            start += 1
        while inner(end):
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def _shortened(schema: pa.Schema, notes: list[str]):
    """Texts without their repeats (``notes``: columns copy, starts, ends), and ``n_chars`` to match; documents that lose all their bytes go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            old, new, stay = batch.column(at["text"]).to_pylist(), [], []
            for text, raw, copy, starts, ends in zip(old, texts(batch), *(batch.column(at[c]).to_pylist() for c in notes)):
                spans = [(0, len(raw))] if copy and len(raw) >= LENGTH else united(list(zip(starts or [], ends or [])))
                spans, last, left = _whole_characters(raw, spans), 0, []
                for s, e in spans:
                    left.append(raw[last:s])
                    last = e
                rest = b"".join([*left, raw[last:]])
                stay.append(bool(rest) or not raw)
                new.append(rest.decode() if spans else text)
            columns = []
            for field in schema:
                value = batch.column(at[field.name])
                if field.name == "text":
                    value = pa.array(new, pa.string())
                elif field.name == "n_chars":
                    value = pa.array([n if a == b else len(b) for n, a, b in zip(value.to_pylist(), old, new)], field.type)
                columns.append(value)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(stay, pa.bool_()))

    return run


def shortened(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with repeats cut out of ``text``; only whole characters are cut."""
    number, *names = unused(docs, "_id", "_copy", "_starts", "_ends")
    notes = repeats(docs).select(F.col("doc_id").alias(number), *[F.col(c).alias(n) for c, n in zip(("copy", "starts", "ends"), names)])
    joined = docs.join(notes.hint("shuffle_hash"), docs.doc_id == notes[number], "left").drop(number)
    return joined.mapInArrow(_shortened(to_arrow_schema(docs.schema), names), docs.schema)


def repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, starts, ends, copy)`` of the documents with something to remove, one row each.

    ``starts`` and ``ends`` are places in bytes, in no order and with overlaps; a ``copy`` goes as a whole.

    Null is the empty text.  A row with a null id neither loses nor causes anything.  Repeated rows with one id (an
    id is expected to have one text) stand for one document.  Other columns are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    home = workspace(spark, "repeats")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    long_enough = f"doc_id is not null and octet_length(text) >= {LENGTH}"
    digest = kept(docs.where(long_enough).select(
        "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").alias("size")), f"{home}/digest")
    first = digest.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = kept(digest.join(first, "digest").where("doc_id > first").select("doc_id").distinct(), f"{home}/copies")
    total = digest.agg(F.sum("size")).first()[0] or 0
    chunks = max(1, math.ceil(total / CHUNK_BYTES))
    # eight bits more than tell all strings apart, so that hardly any are shared by chance
    width = min(8, max(4, math.ceil((math.log2(total + 2) + 8) / 8)))
    buckets = max(1, math.ceil(total / (10 * CHUNK_BYTES)))

    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")
    laid = docs.where(long_enough).select(chunk, "doc_id", "text").unionAll(copies.select(chunk, "doc_id", F.lit(None).cast("binary")))
    laid = laid.repartition(max(chunks, 1), "chunk")
    sent = laid.groupBy("chunk").applyInArrow(_send(width, buckets), "bucket long, chunk long, all binary, shared binary")
    answers = sent.groupBy("bucket").applyInArrow(_answer(width), "chunk long, hits binary")
    occurrences = laid.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _cut(width), "segment binary, minimizer long, doc_id long, start long, size long")
    occurrences.write.option("compression", "zstd").parquet(f"{home}/occurrences")
    occurrences = spark.read.schema(occurrences.schema).parquet(f"{home}/occurrences")

    told, local = occurrences.where("segment is not null"), occurrences.where("segment is null")
    distinct = told.groupBy("segment", "minimizer").agg(F.min("doc_id").alias("owner"), F.count("*").alias("times"))
    marked = _marked(kept(distinct, f"{home}/distinct"), home).where("times > 1 or size(marks) > 0")
    end = F.col("start") + F.col("size")
    found = told.select(_sid().alias("sid"), "doc_id", "start", "size").join(marked, "sid").select(
        "doc_id", F.when(F.col("doc_id") > F.col("owner"), F.array("start", end)).otherwise(
            F.transform("marks", lambda m: m + F.col("start"))).alias("marks"))
    places = found.unionAll(local.select("doc_id", F.array("start", end))).where("size(marks) > 0")
    spans = places.groupBy("doc_id").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    every = lambda first: F.expr(f"transform(sequence({first}, size(marks) - 1, 2), i -> marks[i])")
    copies = copies.select("doc_id", F.lit(True).alias("copy"))
    notes = spans.select("doc_id", every(0).alias("starts"), every(1).alias("ends")).join(copies, "doc_id", "full").select(
        "doc_id", "starts", "ends", F.coalesce("copy", F.lit(False)).alias("copy"))
    return kept(notes, f"{home}/notes")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, spans, kept)`` for every row of ``docs(doc_id, text)``.

    ``spans`` are the removed runs as start, end, start, end, ... in bytes, ``kept`` the bytes left.
    For nulls and repeated rows see ``repeats``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return docs.join(repeats(docs).hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "copy", "starts", "ends") \
        .mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary")


def digests(done: DataFrame) -> DataFrame:
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
