"""The run-length index of op10: matching statistics against a plain search, and what they rest on."""

import random

import numpy as np
import pytest

from retally.llm import repeats
from retally.llm.run_index import LENGTH, Collection, RunLengthIndex, earlier, suffix_order
from tests.llm.test_operators import brute_repeats


def segments(seed):
    """Passages and their changed, cut and lengthened forms, over alphabets of several sizes; short periods among them."""
    rnd = random.Random(seed)
    letters = rnd.choice([b"ab", b"abcdefgh", bytes(range(256)), b"\0\1"])
    base = [bytes(rnd.choice(letters) for _ in range(rnd.randint(50, 140))) for _ in range(6)] + [b"ab " * 40]
    out = []
    for _ in range(rnd.randint(2, 60)):
        text = rnd.choice(base)
        text = text[rnd.randint(0, max(0, len(text) - 50)):][:rnd.randint(50, 130)]
        if rnd.random() < .5:
            at = rnd.randrange(len(text))
            text = text[:at] + bytes([rnd.choice(letters)]) + text[at + 1:]
        if rnd.random() < .3:
            text += rnd.choice(base)[:30]
        out.append(text)
    return out, np.array([rnd.randint(0, 20) for _ in out])


def brute(texts, owner):
    return [[p for p in range(len(t) - LENGTH + 1) if any(o < mine and t[p:p + LENGTH] in u for u, o in zip(texts, owner))]
            for t, mine in zip(texts, owner)]


@pytest.mark.parametrize("seed", range(30))
def test_earlier_equals_plain_search(seed):
    texts, owner = segments(seed)
    assert [x.tolist() for x in earlier(texts, np.zeros(len(texts), np.int64), owner)] == brute(texts, owner)


def test_suffixes_in_order():
    text = np.array([1, 2, 1, 2, 1, 0, 2, 1, 2, 1, 0], np.int64)
    assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_tags_keep_texts_apart():
    text = b"a passage of more than fifty bytes, which all of these texts have in common"
    texts = Collection([text, b"x" * 60, text, text, b"x" * 70])
    tag = np.array([0, 1, 0, 1, 1])
    found = RunLengthIndex(texts, np.array([0, 1]), tag).found(texts.first[2:], texts.first[2:] + texts.size[2:], tag[2:])
    assert np.bincount(texts.which[found], minlength=5).tolist() == [0, 0, len(text) - 49, 0, 21]


@pytest.mark.parametrize("samples", ["first", "last"])
def test_matches_rest_on_the_samples(samples):
    """With wrong positions at the ends of runs the matches are wrong."""
    rnd, wrong = random.Random(1), 0
    for seed in range(10):
        texts = Collection(segments(seed)[0])
        tag = np.zeros(len(texts.size), int)
        index = RunLengthIndex(texts, np.arange(0, len(tag), 2), tag)
        found = lambda: set(index.found(texts.first[1::2], texts.first[1::2] + texts.size[1::2], tag[1::2]).tolist())
        right = found()
        setattr(index, samples, np.array(rnd.sample(getattr(index, samples).tolist(), len(index.first))))
        wrong += right != found()
    assert wrong


def test_repetitive_texts_have_few_runs():
    passage = bytes(random.Random(2).choices(b"abcdefghijklmnop", k=200))
    runs = lambda copies: len(RunLengthIndex(Collection([passage] * copies), np.arange(copies), np.zeros(copies, int)).first)
    assert runs(64) < runs(1) + 64


def test_crowded_short_periods(spark, monkeypatch):
    """Runs of one word crowd their minimizer at both lengths; they are told string by string."""
    monkeypatch.setattr(repeats, "INDEX_BYTES", 300)
    used = []
    monkeypatch.setattr(repeats, "_by_strings", lambda outer, do=repeats._by_strings: used.append(1) or do(outer))
    rnd = random.Random(4)
    rows = [(i, f"{rnd.random()} " + "the " * rnd.randint(10, 60) + f"end {i % 7} " + "de" * rnd.randint(0, 80)) for i in range(60)]
    got = repeats.digests(repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert used and {r.doc_id: tuple(r)[1:] for r in got} == brute_repeats(rows)


def test_minimizers_need_little_memory():
    import tracemalloc

    from retally.llm import repeats

    raw = np.random.default_rng(1).integers(97, 123, 1_000_000).astype(np.uint8)
    owner = np.repeat(np.arange(100, dtype=np.int32), 10_000)
    tracemalloc.start()
    found = repeats.runs(raw, owner)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) > 50_000 and peak < 12_000_000


def test_minimizers_fall_evenly_into_buckets():
    import pyarrow as pa

    from retally.llm import repeats

    raw = np.random.default_rng(2).integers(97, 123, 400_000).astype(np.uint8).tobytes()
    texts = pa.table([pa.array(range(100), pa.int64()), pa.array([raw[i:i + 4_000] for i in range(0, len(raw), 4_000)], pa.binary())],
                     names=["doc_id", "text"])
    sent = repeats._send(5, 16)((pa.scalar(0),), texts)
    size = dict(zip(sent["bucket"].to_pylist(), map(len, sent["all"].to_pylist())))
    # least values are mostly small: cut by range, the first bucket would hold five in six of them
    assert sorted(size) == list(range(16)) and max(size.values()) < 1.3 * sum(size.values()) / 16
    # every bucket answers with exactly the values that two chunks or two documents of one have
    again = pa.table([pa.array([7, 8], pa.int64()), pa.array([raw[:4_000], raw[:4_000]], pa.binary())], names=["doc_id", "text"])
    both = pa.concat_tables([sent, repeats._send(5, 16)((pa.scalar(1),), again)])
    hits = {0: set(), 1: set()}
    for bucket in range(16):
        answer = repeats._answer(5)(both.filter(pa.array([b == bucket for b in both["bucket"].to_pylist()])))
        for chunk, data in zip(answer["chunk"].to_pylist(), answer["hits"].to_pylist()):
            hits[chunk].update(repeats._unpacked(data, 5).tolist())
    least = repeats.runs(np.frombuffer(raw[:4_000], np.uint8), np.zeros(4_000, np.int32))[0]
    assert hits[0] == hits[1] == set(repeats._short(least, 5).tolist())


def test_run_of_a_row_and_shared_bytes_are_looked_up():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, 120).astype(np.uint8)) for _ in range(20)] + [b"ab" * 60, b"ab" * 55]
    joined = Collection(texts)
    index = RunLengthIndex(joined, np.arange(len(texts)), np.zeros(len(texts), np.int64))
    rows = np.arange(len(joined.order))
    assert (index._run == np.searchsorted(index._start, rows, "right") - 1).all()
    raw = b"".join(t + b"\0" for t in texts)
    p, q = rng.integers(0, len(raw), (2, 3000))
    for a, b, n in zip(p, q, joined.common(p, q, np.full(len(p), LENGTH))):
        most = min(LENGTH, joined.left[a], joined.left[b])
        assert n == next((i for i in range(most) if raw[a + i] != raw[b + i]), most)
