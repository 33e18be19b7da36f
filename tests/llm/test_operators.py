"""Each operator against a brute-force version, and on odd input: nulls, empty texts, ties, repeats, extra columns."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from retally.llm import blob_ledger, bpe, divergence, langid, lattice, minhash, packing, repeats, surrogates, warc

ODD = "doc_id long, text string, lang string, source string, n_chars long, spans string, _x int, digest string"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with extra columns of clashing names."""
    texts = [None, "", " \n\t", "a", "password=abcdefgh1 x", "é日 " * 40, "same text here and on " * 30, "same text here and on " * 30,
             "x" * 3000, "#$% " * 20, "Mr. John Smith met Mrs. Anna Smith"]
    rows = [(i, t, "en" if i % 2 else None, None, len(t or ""), "s", 1, "d") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[6], (None, "no id", "en", None, 5, "s", 1, "d")], ODD)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def documents(seed=5, n=150):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé日") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    passages = [" ".join(rnd.choice(words) for _ in range(rnd.randint(9, 40))) for _ in range(10)]
    out = []
    for i in range(n):
        text = " ".join(rnd.choice(passages) if rnd.random() < .3 else rnd.choice(words) for _ in range(rnd.randint(0, 50)))
        if out and rnd.random() < .2:
            text = rnd.choice(out)[1]
            if rnd.random() < .6:
                text += " " + rnd.choice(words)
        out.append((i * 7 % 151, text))
    return out


def test_bpe_equals_the_library(spark, odd, none):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours = bpe.ByteBPE(ranks, P.PATTERN)
    rnd = random.Random(1)
    pool = [" ", "  ", "\n", "\t", "a", " the", "é", "日本", "'s", "!!", "123", " ", "😀", "ing ", "x" * 700, "ab" * 400]
    for _ in range(150):
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25)))
        ids = ours.encode_batch([text])[0]
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)
        assert ours.decode(ids) == text.encode()
    got = bpe.encode(odd, path, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in got) == sorted((r.text or "").encode() for r in odd.collect())
    assert bpe.encode(none, path, P.PATTERN).count() == 0


def test_packing_keeps_every_id_once(spark, odd, none):
    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    docs = spark.createDataFrame(documents(), "doc_id long, text string").repartition(20)
    got = packing.digests(packing.pack(docs, path, width=64)).toPandas()
    ids = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in docs.collect()}
    for r in got.itertuples():
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    assert got.groupby("doc_id").length.sum().to_dict() == {i: len(v) for i, v in ids.items()}
    rows = got.sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id").length.cumsum() - rows.length == rows.offset).all()
    total = got.groupby("sequence_id").length.sum()
    assert total.max() <= 64 and (total < 64 - packing.SLACK).sum() <= 1
    assert packing.pack(odd, path).where("octet_length(ids) = 4").count() == 3 and packing.pack(none, path).count() == 0


def test_words_equal_the_tokenizer(monkeypatch):
    """Cases, accents that join with one case only, odd white space, marks in the text; also when known words are dropped."""
    path = P.path("word_bpe_49k.json")
    theirs = Tokenizer.from_file(path)
    theirs.encode_special_tokens = True
    ours = packing.Words(open(path, encoding="utf-8").read())
    monkeypatch.setattr(packing, "KNOWN", 20)
    rnd = random.Random(4)
    pool = ["A", "b", "J\u030c", "j\u030c", "K\u0301", "\u212a", "\u0130", "I", "\u03a3", "'S", "'s", "^", " ^ ", "\u00a0", "\u3000",
            "\x1c", "\x85", "\t", "\n", " ", "  ", "12", "<|endoftext|>", "\u0301", "\u0345", "\u1e9e", "日", "😀", "...", "É", "ing"]
    for _ in range(400):
        batch = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30))) for _ in range(3)]
        got = [np.frombuffer(ids, "<u4").tolist() for ids in ours.encode([t.encode() for t in batch])]
        assert got == [theirs.encode(t, add_special_tokens=False).ids for t in batch], batch


def test_language_model_and_held_out_accuracy(spark, odd, none, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got[got.held_out].lang == got[got.held_out].lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    rows = langid.predict(odd, langid.train(docs)).collect()
    assert len(rows) == 13 and sum(r.lang_pred == "und" and r.score == 0 for r in rows) == 4
    assert langid.predict(odd, langid.train(none)).where("lang_pred <> 'und'").count() == 0
    assert langid.clear(none, langid.train(docs)).count() == 0 and langid.clear(odd, langid.train(docs)).columns == odd.columns


def brute_bits(trained, text):
    """Code length by escapes and exclusion, byte by byte, from the text the model was trained on."""
    import math
    before, total = b"\n" * langid.ORDER, 0.0
    trained, whole = before + trained, before + text
    for at in range(len(before), len(whole)):
        excluded = set()
        for n in range(langid.ORDER, -1, -1):
            context, seen = whole[at - n:at], {}
            for p in range(len(before), len(trained)):
                if trained[p - n:p] == context and trained[p] not in excluded:
                    seen[trained[p]] = seen.get(trained[p], 0) + 1
            if not seen:
                continue
            if whole[at] in seen:
                total -= math.log2(seen[whole[at]] / (sum(seen.values()) + len(seen)))
                break
            total -= math.log2(len(seen) / (sum(seen.values()) + len(seen)))
            excluded |= set(seen)
        else:
            total += math.log2(256 - len(excluded))
    return total


def test_code_lengths_equal_brute_force(spark):
    trained = {"en": "the cat sat on the mat and the rat sat on the cat", "de": "die katze sitzt auf der matte und der hund bellt"}
    model = langid.train(spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(trained.items())], "doc_id long, text string, lang string"))
    batch = ["the mat sat", "der hund sitzt", "", "é 日 zzz", "the cat the cat the cat"]
    got = model.lengths([t.encode() for t in batch])
    for t, row in zip(batch, got):
        assert row.tolist() == pytest.approx([brute_bits(trained[x].encode(), t.encode()) for x in model.langs])


def test_only_texts_in_a_language_are_clear(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model, rnd = langid.train(docs.where(~langid.held_out())), random.Random(1)
    junk = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz   ", k=3000)), "".join(rnd.choices("0123456789#$%&*x", k=3000)),
            "Это обычный русский текст, какого модель не видела. " * 5, "これは日本語の文章です。" * 5]
    schema = "doc_id long, text string"
    assert langid.clear(spark.createDataFrame(list(enumerate(junk)), schema), model).count() == 0
    assert langid.predict(spark.createDataFrame(list(enumerate(junk)), schema), model).where("score > 0.01").count() == 0
    lost = docs.where("lang is not null").count() - langid.clear(docs.where("lang is not null"), model).count()
    assert lost <= 0.002 * docs.count()


def test_a_language_of_few_long_texts_is_learned(spark):
    """Blocks are drawn, so a language in a few long texts is in the sample, in its share."""
    long_ = lambda word, n: (word + " ") * n
    rows = [(i, long_("alpha beta", 20), "a") for i in range(200)] + [(1000 + i, long_("gamma delta", 60_000), "b") for i in range(2)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 40_000)
    got = langid.predict(spark.createDataFrame([(0, "gamma delta gamma"), (1, "beta alpha beta")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {0: "b", 1: "a"}


def test_costs_are_a_code():
    """The bytes after any context have probabilities that add up to one."""
    text = b"the cat sat on the mat; the rat sat"
    keys, counts = np.unique(np.concatenate([langid.grams(text, n) for n in range(1, langid.ORDER + 2)]), return_counts=True)
    model = langid.Model(["en"], keys, np.zeros(len(keys), int), counts)
    for context in (b"the", b"sat", b"zzz", b"e c"):
        full = np.array([int.from_bytes(bytes([langid.ORDER + 1]) + context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert np.exp2(-model.bits(full)).sum() == pytest.approx(1)


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_minhash_finds_all_links(spark, k, percent):
    rows = documents(9, 120)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()
    sets = {i: set(minhash.shingle_sets([t.encode()], k)[0].tolist()) for i, t in rows}
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    least[b] = min(least[a], least[b])
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(s), least[i], least[i] == i) for i, s in sets.items()}


def test_minhash_on_odd_rows(odd, none):
    got = {r.doc_id: r for r in minhash.near_duplicates(odd).collect()}
    assert set(got) == set(range(11)) and got[7].component_id == 6 and got[0].n_shingles == got[1].n_shingles == 0
    assert got[1].component_id == 1 and minhash.near_duplicates(none).count() == 0


def brute_repeats(rows):
    first, out = {}, {}
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    for i, t in texts:
        for p in range(len(t) - 49):
            first.setdefault(t[p:p + 50], i)
    for i, t in texts:
        mark = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p:p + 50]] < i:
                mark[p:p + 50] = b"\1" * 50
        runs = sum(bool(mark[p]) and not (p and mark[p - 1]) for p in range(len(t)))
        out[i] = (len(t), sum(mark), runs, hashlib.sha256(bytes(c for c, m in zip(t, mark) if not m)).hexdigest())
    return out


@pytest.mark.parametrize("chunk, index", [(20_000, 400), (2_000_000, 500_000)])
def test_repeats_equal_brute_force(spark, monkeypatch, chunk, index):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(repeats, "INDEX_BYTES", index)             # the small one splits crowded minimizers
    rows = documents(3, 120)
    rows += [(1000 + i, f"the quick brown fox jumps over the lazy dog and more {t[:60]}") for i, t in rows[:60]]
    got = repeats.digests(repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_repeats(rows)


def test_repeats_on_odd_rows(odd, none):
    got = repeats.without_repeats(odd).collect()
    assert len(got) == 13 and all(r.n_removed == (r.n_bytes if r.doc_id == 7 else 0) for r in got)
    short = repeats.shortened(odd)
    assert short.columns == odd.columns and short.where("doc_id = 7").count() == 0 and repeats.shortened(none).count() == 0


def test_secrets_and_the_ledger(spark, odd, none, tmp_path):
    got = {r.doc_id: r for r in blob_ledger.digests(odd).collect()}
    assert got[4].spans == "assign:0:18" and got[4].n_assign == 1 and got[0].spans == "" and blob_ledger.digests(none).count() == 0
    clean = blob_ledger.without_secrets(odd)
    assert clean.columns == odd.columns and clean.where("doc_id = 4").first().text == "[secret] x"
    ledger = blob_ledger.Ledger(spark, str(tmp_path / "ledger"))
    versions = spark.createDataFrame([("a", "AKIA" + "A" * 16), ("b", "AKIA" + "A" * 16), ("c", "nothing")], "path string, text string")
    ledger.scan(versions)
    ledger.scan(versions)                                          # nothing unseen
    assert [ledger.rows().where(f"batch = {i}").count() for i in (1, 2)] == [2, 0]
    newer = [*blob_ledger.RULES[1:], blob_ledger.Rule("assign", 2, blob_ledger.RULES[0].pattern, 2, 8)]
    ledger.scan(versions, newer)                                   # one rule has a new version
    assert {tuple(r.rules) for r in ledger.rows().where("batch = 3").collect()} == {("assign@2",)}
    assert ledger.findings().count() == 1


def test_surrogates_are_distinct_and_coreferent(spark, odd, none):
    rows = [(1, "mail ab@x.org or AB@X.ORG, call +1 (988) 555-2485 or +1 988 555 2485"), (2, "ab@x.org, cd@x.org 4539578763621486 10.1.2.3"),
            (3, "Mr. John Smith and Mrs. Anna Smith; Frau Anna Weber"), (4, "order 4539578763621487 of 3 items")]
    got = {r.doc_id: r for r in surrogates.replaced(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert got[4].text == rows[3][1] and got[4].n_entities == 0
    mails = re.findall(r"\S+@[\w.-]+", got[1].text + " " + got[2].text)
    assert len({m.lower().strip(",") for m in mails}) == 2 and "x.org" not in got[1].text + got[2].text
    phones = [re.sub(r"\D", "", p) for p in re.findall(r"\+1[ (\d)-]{10,}\d", got[1].text)]
    assert len(phones) == 2 and phones[0] == phones[1] != "19885552485" and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[1].text)
    card = re.search(r"\b4\d{15}\b", got[2].text).group(0)
    assert card != "4539578763621486" and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(card[::-1])) % 10 == 0
    names = re.fullmatch(r"Mr\. (\w+rdo) (\w+) and Mrs\. (\w+lia) (\w+); Frau (\w+lia) (\w+)", got[3].text).groups()
    assert names[1] == names[3] != names[5] and names[2] == names[4]
    many = spark.createDataFrame([(i, f"a{i}@x.org") for i in range(300)], "doc_id long, text string")
    assert surrogates.replaced(many, "k").select("text").distinct().count() == 300     # two letters: collisions are drawn again
    assert surrogates.replaced(odd, "k").count() == 13 and surrogates.replaced(none, "k").count() == 0


def test_archives_round_trip(spark):
    html = ["", "<p>é</p>", "long " * 9000, "long " * 9000, "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n", None, "0\r\n\r\n", "x"]
    rows = [(i, f"http://x/{i} y", t, "extra") for i, t in enumerate(html)] + [(None, None, "x", "extra")]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, digest string")).collect()}
    for i, t in enumerate(html):
        raw = (t or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.refers_to is not None} == {0: ("revisit", 5), 2: ("revisit", 3)}
    assert len(got) == 9 and got[None].record_type == "response"


def test_damaged_segments_are_told():
    records = [list(warc.parsed(r + b"\r\n\r\n"))[0] for r in warc.records(1, "u", b"z" * 50_000, base64.b32encode(
        hashlib.sha1(b"z" * 50_000).digest()).decode(), None, "n")]
    rows = [dict(zip([f.name for f in warc._PARSED], r)) for r in records]
    assert warc.whole(rows)[4:] == (b"z" * 50_000, True)
    assert warc.whole(rows[:-1])[5] is False and warc.whole(rows[1:])[5] is False and warc.whole([rows[0], *rows[2:]])[5] is False


def test_lattice_points_are_nearest():
    x = np.random.default_rng(0).normal(size=(200, 8)) * 2
    p = lattice.e8(x)
    assert len(lattice.ROOTS) == 240 and np.allclose((lattice.ROOTS ** 2).sum(axis=1), 2)
    assert (((x - p) ** 2).sum(axis=1)[:, None] <= ((x[:, None] - p[:, None] - lattice.ROOTS) ** 2).sum(axis=2) + 1e-9).all()


def test_lattice_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK_ROWS", 16)                # crowded cells are split
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 32))
    v = np.concatenate([base[i % 12] + 0.08 * rng.normal(size=32) for i in range(300)]).reshape(300, 32)
    v[50:60] = v[50]
    rows = [(i, v[i].tolist(), i % 3) for i in range(300)] + [(400, [0.0] * 32, 0), (401, None, 0), (402, v[0].tolist(), None),
                                                          (403, [float("nan")] * 32, 0), (404, [], 0), (405, v[0].tolist()[:8], 0)]
    got = {r.vec_id: r for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (np.arange(300)[:, None] % 3 == np.arange(300) % 3) & ~np.eye(300, dtype=bool)
    assert sum(got[i].n_links for i in range(300)) >= 0.98 * near.sum() and near.sum() > 500
    assert all(got[i].n_links <= near[i].sum() for i in range(300)) and all(got[i].n_links == 0 and got[i].kept for i in range(400, 406))


def test_quality_counts(spark, odd, none, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r for r in divergence.quality(docs).collect()}
    for doc, text in docs.select("doc_id", "text").collect():
        words, seen, again, covered = re.findall(r"[^\x20\x09-\x0D]+", text or ""), set(), 0, set()
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        times = {t: 0 for t in triples}
        for t in triples:
            times[t] += 1
        for i, t in enumerate(triples):
            if times[t] > 1:
                covered |= {i, i + 1, i + 2}
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").collect()
    assert all(got[r.doc_id].kept or got[r.doc_id].base_failed for r in labels)
    assert divergence.quality(odd).count() == 13 and divergence.quality(none).count() == 0
