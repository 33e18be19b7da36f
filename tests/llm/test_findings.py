"""Cases in which an operator once did less than its whole job."""

import hmac
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from retally.llm import blob_ledger, divergence, packing, repeats, surrogates


def test_documents_without_common_words_are_not_kept(spark):
    rnd = random.Random(7)
    rows, good, junk = [], set(), set()
    for lang, letters in (("xx", "aeioulmnrst"), ("yy", "bcdfgouyhkp")):
        words = list({"".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(3000)})
        weights = [1 / (i + 12) for i in range(len(words))]
        for _ in range(300):
            good.add(len(rows))
            rows.append((len(rows), " ".join(rnd.choices(words, weights, k=int(50 * 2 ** rnd.uniform(0, 4)))), lang))
    for n in (120, 200, 300, 500, 1000, 2000):
        for _ in range(3):
            junk.add(len(rows))
            rows.append((len(rows), " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 7))) for _ in range(n)),
                         None))
    rows += [(10_000 + i, rows[0][1], None) for i in range(2000)]         # copies do not move a limit
    got = {r.doc_id: r for r in divergence.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert max(got[i].word_distance for i in junk) < 0.6 and not any(got[i].base_failed for i in junk)
    assert not [i for i in junk if got[i].kept] and not [i for i in good if not got[i].kept]


def test_added_tokens_in_a_text_are_one_id(spark):
    path = P.path("word_bpe_49k.json")
    theirs = Tokenizer.from_file(path)
    ours = packing.Words(open(path, encoding="utf-8").read(), literal=False)
    rnd = random.Random(6)
    pool = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", "|>", "A", "b", "J\u030c", "\u030c", "^", " ^ ", "'S",
            "\u00a0", "\t", "\n", " ", "12", "\u0301", "\u212a", "É", "ing"]
    batches = [["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 20))) for _ in range(3)] for _ in range(300)]
    for batch in batches:
        got = [np.frombuffer(ids, "<u4").tolist() for ids in ours.encode([t.encode() for t in batch])]
        assert got == [theirs.encode(t, add_special_tokens=False).ids for t in batch], batch
    rows = [(0, "end <|endoftext|> start"), (1, "END<|endoftext|><|startoftext|>START"), (2, "plain")]
    for r in packing.digests(packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), path, width=64)).collect():
        ids = np.array(theirs.encode(rows[r.doc_id][1], add_special_tokens=False).ids + [1], "<u4")
        assert (r.start, r.length, r.doc_tokens, r.ids_crc32) == (0, len(ids), len(ids), zlib.crc32(ids.tobytes()))


def test_more_names_and_numbers_than_short_surrogates(spark):
    rows = spark.range(70_000).selectExpr("'family' kind", "concat('name', id) value", "'latin:n' trait").unionAll(
        spark.range(9_000).selectExpr("'phone' kind", "concat('+123', lpad(id, 4, '0')) value", "'123' trait"))
    home = surrogates.workspace(spark, "many")
    got = surrogates.surrogates(rows, "k", home)
    assert got.select("kind", "surrogate").distinct().count() == got.count() == 79_000
    assert got.join(rows.select("kind", rows.value.alias("surrogate")), ["kind", "surrogate"]).count() == 0
    longer = spark.range(1).select(surrogates._rendered(*map(surrogates.F.lit, ("+123 45 67", "phone", "+12398765")))).first()[0]
    assert longer == "+123 98 765"


def test_whole_names_behind_titles_are_replaced(spark):
    texts = ["Mr. John Ronald Smith met Mr. Smith", "Mr. John McDonald slept", "Mrs. Anne-Marie Weber ran", "Mr. O'Brien and Mr. O’Brien sat",
             "Dr. J. Smith sat", "MR. SMITH, SAID", "Mr. J.-P. Smith's car", "MS Word and MR. SMITH's word", "Prof. J R Smith"]
    got = [r.text for r in surrogates.replaced(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k")
           .orderBy("doc_id").collect()]
    name = r"[A-Z][a-z]+"
    forms = [rf"Mr\. {name}rdo {name}rdo ({name}ren) met Mr\. ({name}ren)", rf"Mr\. {name}rdo ({name}ren) slept", rf"Mrs\. {name}lia {name}ren ran",
             rf"Mr\. ({name}ren) and Mr\. ({name}ren) sat", rf"Dr\. {name}ren ({name}ren) sat", r"MR\. ([A-Z]+REN), SAID",
             rf"Mr\. {name}rdo ({name}ren)'s car", r"MS Word and MR\. ([A-Z]+REN)'s word", rf"Prof\. {name}ren {name}ren ({name}ren)"]
    found = [re.fullmatch(form, text) for form, text in zip(forms, got)]
    assert all(found), got
    smith = found[0].group(1)
    assert {smith} == {found[0].group(2), found[4].group(1), found[6].group(1), found[7].group(1).capitalize(), found[8].group(1)}
    assert found[3].group(1) == found[3].group(2) != smith


def test_a_name_under_both_titles_is_two_people(spark):
    texts = ["Mr. Robin Smith", "Mrs. Robin Weber", "Dr. Robin Jones", "Mrs. Anna Weber", "Dr. Anna Weber"]
    got = [r.text.split() for r in surrogates.replaced(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k")
           .orderBy("doc_id").collect()]
    assert got[0][1].endswith("rdo") and got[1][1].endswith("lia") and got[2][1].endswith("ren")
    assert len({got[i][1] for i in range(3)}) == 3 and got[3][1] == got[4][1] and got[3][1].endswith("lia")
    assert got[1][2] == got[3][2] == got[4][2]                             # one family


def test_account_numbers_are_checked_and_stay_valid(spark):
    rows = [(0, "IBAN DE89 3704 0044 0532 0130 00."), (1, "order DE89 3704 0044 0532 0130 01 stays"), (2, "GB29NWBK60161331926819")]
    got = {r.doc_id: r for r in surrogates.replaced(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert got[1].text == rows[1][1] and got[1].n_entities == 0
    for i, form in ((0, r"IBAN (DE\d\d(?: \d{4}){4} \d\d)\."), (2, r"(GB\d\d[A-Z]{4}\d{14})")):
        account = re.fullmatch(form, got[i].text).group(1).replace(" ", "")
        assert account not in rows[i][1].replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def test_keyed_digests_are_an_hmac(spark):
    from pyspark.sql import functions as F

    for key in ("k", "a long key " * 9):
        got = spark.range(1).select(surrogates.keyed(key, F.lit("é|"), F.lit("b"))).first()[0]
        assert got == hmac.new(key.encode(), "2:é|1:b".encode(), "sha256").hexdigest()


def test_a_ledger_goes_on_after_a_scan_that_failed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    ledger = blob_ledger.Ledger(spark, path)
    versions = spark.createDataFrame([("a", "AKIA" + "A" * 16), ("b", "nothing")], "path string, text string")
    spans_of = blob_ledger.spans_of
    monkeypatch.setattr(blob_ledger, "spans_of", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ledger.scan(versions)
    monkeypatch.setattr(blob_ledger, "spans_of", spans_of)
    again = blob_ledger.Ledger(spark, path, new=False)
    again.scan(versions)
    more = versions.unionAll(spark.createDataFrame([("c", "AKIA" + "B" * 16)], versions.schema))
    again.scan(more)                                               # meets old blobs, scans the new one
    assert [again.rows().where(f"batch = {i}").count() for i in (1, 2)] == [2, 1] and again.findings().count() == 2


def test_helper_columns_never_clash(spark):
    same = "a passage that is long enough to be found again in another document of this table"
    names = ["_blob", "_spans", "_id", "_copy", "_starts", "_ends", "blob", "spans", "_BLOB_", "copy"]
    rows = [(0, same + " first token=abcdefgh12", *range(10)), (1, "now " + same, *range(10)), (2, None, *range(10)), (2, None, *range(10))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    clean = blob_ledger.without_secrets(docs)
    assert clean.columns == docs.columns and [r.text for r in clean.orderBy("doc_id").collect()][0] == same + " first [secret]"
    short = repeats.shortened(docs)
    assert short.columns == docs.columns
    got = {r.doc_id: r for r in short.collect()}
    assert got[1].text == "now " and got[1]["_starts"] == 4 and got[2].text is None


def test_very_long_texts(spark):
    rnd = random.Random(3)
    words = " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(700_000))          # 5 MB
    docs = spark.createDataFrame([(0, words), (1, words + " password=longsecret"), (2, "short")], "doc_id long, text string")
    assert {r.doc_id: r.spans for r in blob_ledger.digests(docs).collect()} == {
        0: "", 1: f"assign:{len(words) + 1}:{len(words) + 20}", 2: ""}
    got = {r.doc_id: r for r in repeats.without_repeats(docs).select("doc_id", "n_bytes", "n_removed").collect()}
    assert got[0].n_removed == 0 and got[1].n_removed == len(words)


def test_divergence_against_brute_force(spark):
    """Histograms, distances and verdicts by plain counting; a document's verdict is its own, whatever else is judged."""
    rnd = random.Random(11)
    kinds = {"Ll": 0, "Lu": 1, "Lt": 1, "N": 2, "P": 3, "S": 4, "L": 6, "M": 8, "Z": 9}

    def kind(c):
        if ord(c) >= 128:
            category = unicodedata.category(c)
            return kinds.get(category, kinds.get(category[0], 7))
        return (0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in ".,;:!?'\"-()" else
                5 if c in " \t\n\r\x0b\x0c" else 4 if c.isprintable() else 7)

    rows = []
    for lang, letters in (("en", "etaoinshr"), ("ru", "оеаинтсрл"), ("hi", "कखगघङच")):
        words = list({"".join(rnd.choices(letters, k=rnd.randint(1, 5))) for _ in range(700)})
        weights = [1 / (i + 3) for i in range(len(words))]
        for _ in range(60):
            drawn = rnd.choices(words, weights, k=rnd.choice([3, 49, 50, 80, 200, 900]))
            drawn = [w.capitalize() + rnd.choice(["", ".", "—", "\u0301", "\u00a0", "😀", "7"]) if rnd.random() < 0.2 else w for w in drawn]
            rows.append((len(rows), rnd.choice([" ", " ", "\n"]).join(drawn), lang))
    rows += [(900, " ".join("".join(rnd.choices("qwxzvk", k=6)) for _ in range(400)), None), (901, "漢字" * 300, None),
             (902, None, "en"), (903, "", "ru"), (904, "12 34 56 " * 80, None), (905, "no language", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = divergence.learn(docs)
    fold = lambda w: w.lower()
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    chars = {lang: Counter() for lang in refs.langs}
    words = {lang: Counter() for lang in refs.langs}
    for _, text, lang in rows:
        if lang and text is not None:
            chars[lang].update(map(kind, text))
            words[lang].update(map(fold, split(text)))
    top = {lang: {w for w, _ in sorted(words[lang].items(), key=lambda x: (-x[1], x[0].encode()))[:divergence.COMMON]} for lang in words}

    def js(p, q):
        n, m, total = sum(p.values()), sum(q.values()), 0
        for key in set(p) | set(q):
            a, b = p[key] / n, q[key] / m
            total += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x) / 2
        return math.sqrt(max(0, total))

    own = lambda counts, lang: Counter({None: sum(n for w, n in counts.items() if w not in top[lang])}) + Counter(
        {w: n for w, n in counts.items() if w in top[lang]})
    got = {r.doc_id: r for r in divergence.judge(docs, refs).collect()}
    for doc, text, _ in rows:
        r, found = got[doc], split(text)
        char = min(js(Counter(map(kind, text)), chars[lang]) for lang in chars) if len(text or "") >= divergence.LEAST_CHARS else None
        word = min((js(own(Counter(map(fold, found)), lang), own(words[lang], lang)), lang) for lang in words) if len(found) >= 50 else None
        assert r.char_distance == (char if char is None else pytest.approx(char, abs=1e-9)), doc
        assert r.word_distance == (word if word is None else pytest.approx(word[0], abs=1e-9)), doc
        far = (char or 0) > divergence.FAR_CHARS or (word is not None and word[0] > r.word_limit)
        assert r.kept == (not r.base_failed and not far), doc
    assert not got[900].kept and not got[901].kept and not got[904].kept
    assert all(r.kept for r in got.values() if r.doc_id < 900 and not r.base_failed)
    limits = [refs.word_limits(np.array([n]), np.array([0]))[0] for n in (50, 64, 100, 1000, 10**6, 10**9)]
    assert limits == sorted(limits, reverse=True) and limits[-1] >= divergence.TOPIC
    few = divergence.judge(docs.where("doc_id in (4, 7, 900)"), refs).collect()
    assert few and all(got[r.doc_id] == r for r in few)


def test_a_census_of_many_words_is_given_out_in_parts(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i * 50 + k}" for k in range(50)) + " the The", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = divergence.learn(docs)
    batches = [pa.RecordBatch.from_pylist([dict(zip(("doc_id", "text", "lang"), r))]) for r in rows]
    monkeypatch.setattr(divergence, "FOLD", 120)
    parts = list(divergence._census(iter(batches)))
    assert len(parts) > 5 and sum(sum(p["n"].to_pylist()) for p in parts) == sum(len(t) + 52 for _, t, _ in rows)
    assert whole.table[0].sum() == 40 * 52 and whole.table[0].max() == 40 * 52 - 199 - 80
