"""Pivot search, hard negatives and stripes against brute force, and on odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from retally.llm import negatives, pivots, stripes, whole

VECTORS = "vec_id long, embedding array<double>, label int, score long, v string, rank int, cell int"


def vectors(n=400, dim=16, seed=1, copies=60):
    """Clusters, a third of near copies of one vector, ties, repeated rows and odd ones."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(9, dim))
    x = base[rng.integers(0, 9, n)] + 0.4 * rng.normal(size=(n, dim))
    x[10:10 + copies] = x[10]
    rows = [(int(i) * 5, x[i].tolist(), int(i) % 3) for i in range(n)]
    rows += [rows[3], rows[4]]                                            # repeated rows
    rows += [(9001, None, 1), (9002, [None, *x[0].tolist()[1:]], 1), (9003, [float("inf")] * dim, 1), (9004, [], 1),
             (9005, [float("nan")] * dim, 2), (9100, x[5].tolist(), None), (None, x[0].tolist(), 1), (9200, [0.0] * dim, 0),
             (9300, [1.0, 2.0], 0), (9305, [2.0, 1.0], 1), (9310, [3.0, 1.0], 0)]
    return [(*r, 1, "x", 2, 3) for r in rows]


def taking_part(rows, scale, labelled):
    out = {}
    for r in rows:
        i, x, label = r[:3]
        if i is None or not x or any(c is None or not np.isfinite(c) for c in x) or (labelled and label is None):
            continue
        out[i] = (np.floor(scale * np.array(x)).astype(int), label)
    return out


def brute_top(rows, asked, k, scale):
    part = taking_part(rows, scale, False)
    out = set()
    for q in asked & set(part):
        scored = sorted((-int(v @ part[q][0]), i) for i, (v, _) in part.items() if i != q and len(v) == len(part[q][0]))[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)}
    return out


@pytest.mark.parametrize("rows_of_block, k", [(8192, 20), (16, 4)])
def test_pivot_search_is_exact(spark, monkeypatch, rows_of_block, k):
    monkeypatch.setattr(pivots, "ROWS", rows_of_block)                    # the small ones cut cells and queries into blocks
    monkeypatch.setattr(pivots, "ASKS", rows_of_block)
    monkeypatch.setattr(pivots, "FEW_CELLS", 4096 if k == 20 else 0)       # 0: cells are joined by a shuffle
    rows = vectors(300)
    table = spark.createDataFrame(rows, VECTORS)
    got = pivots.top_scores(table, table.where("vec_id % 20 = 0"), k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    expected = brute_top(rows, {r[0] for r in rows if r[0] is not None and r[0] % 20 == 0}, k, 64)
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 60 * k
    assert pivots.top_scores(table.where("false"), table, k).count() == pivots.top_scores(table, table.where("false"), k).count() == 0


def test_pivot_bounds_hold_and_drop_rows():
    rng = np.random.default_rng(3)
    x = np.floor(64 * (rng.normal(size=(12, 4))[rng.integers(0, 12, 3000)] * 3 + 0.1 * rng.normal(size=(3000, 4))))
    p = pivots.far_apart(x[:500], 12)
    far, norm = pivots.distances(x, p).astype(np.float32), (x ** 2).sum(axis=1)
    bound, score = pivots.bounds(far[:50], norm[:50], far, norm), x[:50] @ x.T
    assert (bound >= score).all()
    twentieth = -np.sort(-score, axis=1)[:, 19:20]
    assert (bound >= twentieth).mean() < 0.5                              # most rows are never evaluated


def test_products_beyond_64_bits_are_an_error(spark):
    table = spark.createDataFrame([(0, [1e12] * 4), (20, [2.0] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        pivots.top_scores(table, table)
    large = spark.createDataFrame([(0, [3e6] * 4), (20, [3e6, 1.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    rows = large.transform(lambda d: whole.scaled(d, 64))
    assert not whole.exact(rows)                                          # whole numbers instead of doubles
    assert {r.query_id: r.score for r in pivots.top_scores(large, large).collect()} == {i: 192_000_000 ** 2 + 192_000_000 * 64 for i in (0, 20)}


def brute_negatives(rows, anchors, scale=256):
    part = taking_part(rows, scale, True)
    out = set()
    for a in anchors & set(part):
        q, label = part[a]
        scored = sorted((-int(v @ q), i) for i, (v, _) in part.items() if i != a and len(v) == len(q))
        for ps, p in [s for s in scored if part[s[1]][1] == label][:5]:
            fits = [s for s in scored if part[s[1]][1] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:5]
            out |= {(a, p, rank, i, -ps, -s) for rank, (s, i) in enumerate(fits, 1)}
    return out


@pytest.mark.parametrize("rows_of_block", [8192, 32])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, rows_of_block):
    monkeypatch.setattr(negatives, "ROWS", rows_of_block)
    monkeypatch.setattr(negatives, "ASKS", rows_of_block)
    rows = vectors(300, seed=2)
    table = spark.createDataFrame(rows, VECTORS)
    got = negatives.hard_negatives(table, table.where("vec_id % 25 = 0"))
    expected = brute_negatives(rows, {r[0] for r in rows if r[0] is not None and r[0] % 25 == 0})
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 500
    assert {r[2] for r in expected} == {1, 2, 3, 4, 5}
    assert negatives.hard_negatives(table.where("false"), table).count() == 0


def test_intervals_hold_every_score():
    rng = np.random.default_rng(5)
    for dim in (3, 16, 64, 100):
        x = rng.integers(-300, 300, (400, dim))
        x[7] = 0
        x[8] = x[9]
        low, high = negatives.intervals(x[:40], negatives.coded(x))
        score = x[:40] @ x.T
        assert (low <= score).all() and (score <= high).all()
        length = np.sqrt((x ** 2).sum(axis=1))
        assert ((high - low) / np.maximum(length[:40, None] * length, 1)).mean() < 0.8
        code, align, *_ = negatives.coded(x)
        assert code.shape[1] * 64 >= dim * negatives.BITS and 0.9 < np.median(align) <= 1


WORDS = ["the", "of", "Über", "日本", "é", "cat", "dog", "naïve", "a", "zebra", "É"]


def brute_divergences(rows, least_docs, most_terms):
    rows = [(t or "", la or "", s or "") for t, la, s in rows]
    df, count, groups = defaultdict(Counter), defaultdict(Counter), sorted({r[1:] for r in rows})
    for text, lang, source in rows:
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        df[lang].update(set(terms))
        count[lang, source].update(terms)
    out = set()
    ranked = lambda items: sorted(items, key=lambda x: (-x[1], x[0].encode()))
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        peers = [s for la, s in groups if la == lang]
        whole_lang = sum((count[lang, s] for s in peers), Counter())
        p = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        mine, theirs = p(count[lang, source]), p(whole_lang)
        pairs = []
        for s in peers:
            if s != source:
                other = p(count[lang, s])
                pairs.append((s, sum(abs(mine[t] - other[t]) for t in kept)))
        terms = [(t, mine[t] - theirs[t]) for t in kept if count[lang, source][t] and mine[t] > theirs[t]]
        out |= {(lang, source, "pair", i, v, r) for r, (i, v) in enumerate(ranked(pairs), 1)}
        out |= {(lang, source, "term", i, v, r) for r, (i, v) in enumerate(ranked(terms)[:most_terms], 1)}
    return out


@pytest.mark.parametrize("cells, sources, terms", [(300_000, 256, 4096), (7, 3, 2)])
def test_divergences_equal_brute_force(spark, monkeypatch, cells, sources, terms):
    rnd = random.Random(4)
    rows = []
    for _ in range(400):
        lang = rnd.choice(["en", "en", "de", None])
        source = rnd.choice(["hot", "hot", "s1", "s2", "s3", "é", None])
        text = " ".join(rnd.choices(WORDS, [1 / (i + 1 + (source == "s1") * 3) for i in range(len(WORDS))], k=rnd.randint(0, 9)))
        rows.append((rnd.choice([text, text.upper(), text + "-12 the_THE", None]), lang, source))
    rows += [rows[0]] * 20 + [("", "empty", "x"), (None, "empty", "y"), ("rare words", "rare", "x"), ("rare words", "rare", "y"), ("x" * 200_000, "de", "hot")]
    table = spark.createDataFrame([(i, *r, "c", 1) for i, r in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, term string, piece int").repartition(5)
    monkeypatch.setattr(stripes, "SOURCES", sources)
    monkeypatch.setattr(stripes, "TERMS", terms)
    folded = stripes.folded

    def spilling(batches):                                                # the limit is read where the task runs
        stripes.MOST_CELLS = cells
        return folded(batches)

    monkeypatch.setattr(stripes, "folded", spilling)
    got = stripes.divergences(table, 20, 4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in got.collect()} == brute_divergences(rows, 20, 4)
    assert stripes.divergences(table.where("false")).count() == 0


def test_a_partition_that_spills_keeps_every_count(monkeypatch):
    batch = pa.RecordBatch.from_pylist([{"text": f"a b{chr(97 + i % 20)} c", "lang": None, "source": f"s{i % 3}"} for i in range(100)])
    monkeypatch.setattr(stripes, "MOST_CELLS", 5)
    total, parts = Counter(), 0
    for out in stripes.folded(iter([batch])):
        parts += 1
        total.update({(r["source"], r["term"]): r["n"] for r in out.to_pylist()})
    assert parts > 10 and sum(total.values()) == 300 and total["s0", b"a"] == 34


def test_shares_are_exact_for_large_counts():
    for count, total in ((0, 5), (10 ** 13, 2 * 10 ** 14), (2 * 10 ** 14, 2 * 10 ** 14 + 77), (123_456_789_012_345, 234_567_890_123_456)):
        assert int(stripes.share(count, total)) == 1 + 10 ** 9 * (count + 5) // total
    with pytest.raises(OverflowError):
        stripes.share(1, 10 ** 15)


def test_pivot_search_evaluates_queries_side_by_side(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (700, 6))                       # few scores, so many ties at the last place
    p = pivots.far_apart(x, 5)
    far, norm = pivots.distances(x, p).astype(np.float32), (x ** 2).sum(axis=1).astype(np.float64)
    ids, rank = rng.permutation(700), 20
    floors = [None if i % 3 else float(np.sort(np.delete(x @ x[i], i))[-rank]) for i in range(200)]
    table = lambda name, n: {name: ids[:n], "v": list(x[:n]), "norm": norm[:n], "far": list(far[:n])}
    calls, one = [], pivots.table_products
    monkeypatch.setattr(pivots, "table_products", lambda q, rows, doubles: calls.append(len(q)) or one(q, rows, doubles))
    for doubles in (True, False):
        calls.clear()
        asks = pa.table({**table("query_id", 200), "floor": pa.array(floors, pa.float64())})
        got = pivots._searched(rank, doubles)((), asks, pa.table(table("vec_id", 700))).to_pylist()
        assert len(calls) <= -(-200 // pivots.SIDE) and sum(calls) == 200
        for i in range(200):
            score = x @ x[i]
            want = sorted(((int(-score[j]), int(ids[j])) for j in range(700) if j != i))[:rank]
            assert sorted((-r["score"], r["vec_id"]) for r in got if r["query_id"] == ids[i]) == want
