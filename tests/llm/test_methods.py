"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import collections
import hashlib
import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SMALL
from lumen.llm import (decontam, neardup, pagetext, pseudonyms, quality, secretscan, sentencepieces, spanhash,
                       tokenrollup, warc)
from tools.oracle_check import compare, duck

KEY = b"test-key-test-key"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.mark.parametrize("key", ["op1_warc", "op10_decontamination"])
def test_oracles(spark, key):
    assert compare(E.queries()[key](spark, SMALL).toPandas(), duck(SMALL).execute(E.oracle_sql()[key]).df()) is None


def test_warc_ties_and_exact_records(spark, tmp_path):
    big, other = "x" * 100, "y" * 99
    pages = spark.createDataFrame([(3, "u3", big), (1, "u 1", big), (1, "u1", big), (2, None, other), (4, "u4", other),
                                   (None, "u", big)], "page_id long, url string, html string")
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.archive_pages(pages).collect())
    assert got == [(0, "revisit", 1), (1, "response", None), (1, "response", None), (2, "response", None),
                   (3, "revisit", 1), (4, "response", None)]
    warc.write_archive(pages, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 2
    for r in warc.read_archive(spark, str(tmp_path / "a")).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and r["verified"]
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head).group(1))
        assert len(rest) == length + 4 and rest.endswith(b"\r\n\r\n")


def shingle_bag(t):
    w = t.split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def likeness(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def brute_classes(texts):
    bags, root = {i: shingle_bag(t or "") for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if (bags[i].keys() & bags[j].keys() and likeness(bags[i], bags[j]) >= 0.8) or texts[i] == texts[j]:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    base = [rnd.choices(vocab, k=120) for _ in range(6)]
    made = {}
    for b in base:  # chains of edited copies around the threshold, and repeated shingles
        for _ in range(25):
            w = list(b)
            for _ in range(rnd.choice((0, 1, 2, 3, 5, 9))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            made[len(made)] = " ".join(w + w[:rnd.choice((0, 0, 40))])
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(df).collect()}
    assert got == brute_classes(made)


def test_bagminhash_is_unbiased():
    a = (np.arange(1, 41, dtype=np.uint64), np.array([1, 5] * 20))
    b = (np.arange(11, 51, dtype=np.uint64), np.array([3, 2] * 20))
    a, b = [(neardup.mix(x), n) for x, n in (a, b)]
    a, b = [(x[np.argsort(x)], n[np.argsort(x)]) for x, n in (a, b)]
    least, most = neardup.overlap(a, b)
    s = neardup.signatures([a, b], 4000)
    assert abs((s[0] == s[1]).mean() - least / most) < 0.03


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.score(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert len(got) > 100 and sum(r["keep"] == (r["quality"] == 1) for r in got) / len(got) > 0.97


def test_site_posteriors_shrink(spark):
    rows = [("h1", "a", 1.0)] * 50 + [("h1", "b", 0.0)] + [("h2", "a", 0.0)] * 50 + [("h2", "b", 1.0)] + [(None, None, 1.0)]
    df = spark.createDataFrame(rows, "source string, lang string, _p double")
    got = {(r["host"], r["path"]): r for r in quality.site_posteriors(df, "source", "lang").collect()}
    assert len(got) == 5 and got["h1", "a"]["path_rate"] > 0.9 > 0.1 > got["h2", "a"]["path_rate"]
    assert 0 < got["h1", "b"]["path_rate"] < got["h1", "b"]["host_rate"]  # one row moves a sparse path part of the way


def base_by_hand(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
        r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if m.end() - m.start() >= 24]
    return sorted(out)


ODD_SECRETS = ["token=token: abcdef", "PassWord : 'abc' secret=\"abcdef", "api_key==x12345 apikey:abcdefg", "ſecret=abcdefg",
               "toKen=abcdefgh", "AKIA" + "B" * 15 + " AKIA" + "C" * 16, "a" * 23 + " " + "0" * 24, "tokentoken=secret=abcdef"]


def test_secret_base_spans_equal_brute_force(texts):
    for t in [*texts.values(), *ODD_SECRETS]:
        assert secretscan.base_spans(t) == base_by_hand(t), t[:80]


def test_secret_query_columns(spark, docs, texts):
    for r in E.queries()["op4_secrets"](spark, SMALL).collect():
        spans = base_by_hand(texts[r["doc_id"]])
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_labelled_pairs_equal_brute_force(spark, docs, texts):
    want = collections.Counter()
    for text in texts.values():
        spans = secretscan.base_spans(text or "")
        for m in secretscan.WORD.finditer(text or ""):
            inside = any(a <= m.start() < e for a, _, e in spans)
            word = m.group().rpartition("=")[2] if inside else m.group()
            want.update((int(inside), (ord(x) - 33) * secretscan.CLASSES + ord(y) - 33) for x, y in zip(word, word[1:]))
    assert {(r["label"], r["pair"]): r["n"] for r in secretscan.labelled_pairs(docs).collect()} == want


def test_markov_models_separate(spark):
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratio = secretscan.train(sf.where("doc_id % 2 = 0"))
    keys = secretscan.random_samples(300, seed=99)
    found = sum(bool(secretscan.scan_text(f"see {k} here", ratio)) for k in keys)  # long hex runs are base spans
    words = [w for r in sf.where("doc_id % 2 = 1").collect() for w in secretscan.RUN.findall(r["text"])
             if not secretscan.base_spans(f"password={w}")[1:]]
    plain = [w for w in words if w.isalpha()]
    wrong = sum(any(k == 3 for _, k, _ in secretscan.scan_text(w, ratio)) for w in plain)
    assert found / len(keys) > 0.95 and wrong <= 0.005 * len(plain)


def test_secrets_beside_base_spans_in_one_run():
    ratio = np.zeros((secretscan.CLASSES, secretscan.CLASSES))
    ratio[:] = 1.0  # every part of 16 or more counts as random
    key, hexa, aws = "Zk9QmT4xWvR7bLp2NcYs8HgJd5FuEa3oKiXw6VtB", "0123456789abcdef01234567", "AKIA" + "QWERTYUIOPASDFGH"
    for text in (f"{aws}/{key}", f"{key}/{aws}/{key}", f"{key}{hexa}{key}", f"{key}_{hexa}_{key[:9]}", f"secret={key} {key}",
                 f"{key}_token={key}/x {aws}"):
        covered = [False] * len(text)
        for s, _, e in secretscan.base_spans(text):
            covered[s:e] = [True] * (e - s)
        free = "".join(" " if c else t for t, c in zip(text, covered))
        want = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", free)]
        assert [(s, e) for s, k, e in secretscan.scan_text(text, ratio) if k == 3] == want
        assert key not in secretscan.masked(text, ratio)


def test_fingerprint_query_equals_brute_force(spark, texts):
    got = {r["doc_id"]: r for r in E.queries()["op5_fingerprints"](spark, SMALL).collect()}
    ids = sorted(texts, reverse=True)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        t, cut = texts[i], len(texts[i]) // 3
        new = t[:len(t) - cut] + texts[j][:cut]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert r["fingerprint"] == str(spanhash.Prefix(t)) and r["edited_fingerprint"] == str(spanhash.Prefix(new))
        assert r["near_edited"] >= 0.6 and 0 <= r["near_next"] <= 1
    by_print = collections.defaultdict(set)
    for i in ids:
        by_print[got[i]["fingerprint"]].add(texts[i])
    assert all(len(s) == 1 for s in by_print.values())


def test_extensions_equal_brute_force():
    rnd = random.Random(5)
    for _ in range(200):
        s, t = ["".join(rnd.choices("ab", k=rnd.randint(0, 30))) for _ in range(2)]
        i, j = rnd.randint(0, len(s)), rnd.randint(0, len(t))
        a, b = spanhash.Prefix(s), spanhash.Prefix(t)
        want = next((k for k in range(min(len(s) - i, len(t) - j)) if s[i + k] != t[j + k]), min(len(s) - i, len(t) - j))
        assert a.extension(i, b, j) == want
        length = rnd.randint(0, min(len(s) - i, len(t) - j))
        assert a.equal(i, b, j, length) == (s[i:i + length] == t[j:j + length])
        if s != t:
            assert spanhash.likeness(a, b) < 1


def test_likeness_around_the_sampling_length():
    """Pairs on either side of it, with several edits, against the Jaccard share of all spans."""
    rnd = random.Random(8)

    def spans(t):
        return {t[i:i + spanhash.SPAN] for i in range(len(t) - spanhash.SPAN + 1)}

    for n, m in [(630, 650), (650, 630), (639, 640), (640, 639), (500, 700), (630, 630)]:
        for _ in range(20):
            words = "".join(rnd.choices("abcdefgh    ", k=n)).split(" ")
            for at in (5, len(words) // 2, len(words) - 5):
                words[at] += "x"
            s = " ".join(words)[:n].ljust(n, "y")
            words[2] += "q"
            words[len(words) // 3] += "w"
            words[-3] += "z"
            t = (" ".join(words) + " " + "".join(rnd.choices("klmnop", k=m)))[:m]
            want = len(spans(s) & spans(t)) / len(spans(s) | spans(t))
            got = spanhash.likeness(spanhash.Prefix(s), spanhash.Prefix(t))
            assert want > 0.5 and abs(got - want) < 1e-9, (n, m)


def test_sentencepiece_parity(spark, docs):
    rows = sentencepieces.encode_decode(docs, threads=2).collect()
    assert rows and all(r["round_trip"] and r["parity"] for r in rows)
    odd = [" " * k + "word" + " " * (20 - k) + "x\n\n  y  " for k in range(20)] + ["▁a ▁", "a▁b", "<s> x </s>", "\r\n\t", "😀é"]
    own, reference = sentencepieces._backends(sentencepieces.MODEL_PATH, None)
    odd += ["", " ", "▁" * 4000, "a" * 4000, "x ▁ " * 1500, ("word " * 299 + " ▁b") * 4, "é😀 " * 2000, "a  " * 1400 + "▁"]
    ids = own.encode(odd)
    assert ids == reference.encode(odd) and own.decode(ids) == [reference.decode(i) for i in ids]
    assert own.divisible and len(own.parts(own.model.normalise(odd[-2]))) > 1
    whole = own.model.tokenizer()  # uncut, with its own normaliser and decoder
    assert [e.ids if t else [] for t, e in zip(odd, whole.encode_batch(odd, add_special_tokens=False))] == ids


class Counting:
    """A tokenizer that counts the characters it is given to encode."""

    def __init__(self, tokenizer):
        self.tokenizer, self.chars = tokenizer, 0

    def encode_batch_fast(self, texts, **how):
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_sentencepiece_words_are_encoded_once(spark):
    with open(sentencepieces.MODEL_PATH, "rb") as f:
        own = sentencepieces.Backend(sentencepieces.Model(f.read()))
    reference = sentencepieces._backends(sentencepieces.MODEL_PATH, None)[1]
    count = own.tokenizer = Counting(own.tokenizer)
    rnd = random.Random(7)
    words = ["".join(rnd.choices("abcde\né中", k=rnd.randrange(1, 9))) for _ in range(2000)]
    texts = [" ".join(rnd.choices(words, k=400)) for _ in range(50)]
    assert own.encode(texts) == reference.encode(texts)
    assert count.chars <= sum(len(w) + 1 for w in set(words))
    odd = ["".join(rnd.choices("▁▁  ab\n<0x4>é😀中", k=rnd.randrange(40))) for _ in range(2000)]
    odd += [t for x in odd if (t := " ".join(x.replace("▁", " ").split()))] + ["a▁b c", "x" * 5000, ""]
    rnd.shuffle(odd)
    assert own.encode(odd) == reference.encode(odd) and own.encode([]) == []
    rows = sentencepieces.encode_decode(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").coalesce(1),
                                        batch_chars=300).collect()
    assert len(rows) == len(odd)
    for r in rows:
        text = odd[r["doc_id"]]  # a marker in a text comes back as a space
        assert r["ids"] == reference.encode(text) and r["parity"] and r["round_trip"] == ("▁" not in text)
        assert r["n_tokens"] == len(r["ids"]) and r["decoded_n_chars"] == len(text)


def test_threads_are_the_cores_of_a_task(spark, docs):
    allow = "spark.sql.legacy.setCommandRejectsSparkCoreConfs"
    assert sentencepieces.task_threads(spark) == 1
    session = spark.newSession()
    session.conf.set(allow, "false")
    session.conf.set("spark.task.cpus", "3")
    assert sentencepieces.task_threads(session) == 3
    rows = sentencepieces.encode_decode(session.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert rows and all(r["round_trip"] and r["parity"] for r in rows)


def test_unigram_models_are_rebuilt():
    model = sentencepieces.Model.__new__(sentencepieces.Model)
    model.pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("▁ab", -1.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("ba", -2.0, 1)]
    model.kind, model.byte_fallback, model.dummy_prefix, model.remove_spaces = sentencepieces.UNIGRAM, False, True, True
    t = model.tokenizer()
    assert t.encode("ab  ba", add_special_tokens=False).ids == [2, 1, 5] and t.decode([2, 1, 5]) == "ab ba"


VALUES = {"card": "4539 1488 0343 6467", "iban": "DE89 3704 0044 0532 0130 00", "ssn": "123-45-6789",
          "phone": "+1 (626) 555-5759", "ip": "42.144.35.254", "date": "29.02.2000", "email": "jo.doe7@mail8.example.com"}


@pytest.mark.parametrize("kind", VALUES)
def test_pseudonyms_are_valid_linked_and_keyed(kind):
    v = VALUES[kind]
    (s, e, k, new), = pseudonyms.find(f"see {v} twice", KEY)
    assert (k, f"see {v} twice"[s:e]) == (kind, v) and new != v
    assert pseudonyms.find(f"x {v}", KEY)[0][3] == new != pseudonyms.find(f"x {v}", KEY[::-1])[0][3]
    if kind not in ("ip", "email"):
        assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", v)
    assert pseudonyms.find(f"x {new}", KEY)[0][2] == kind  # a valid value of its kind


@pytest.mark.parametrize("text", ["4539 1488 0343 6468", "31.02.2000", "300.1.1.1", "000-12-3456", "DE88 3704 0044 0532 0130 00",
                                  "version 1.2.3", "in 1998 there were 12", "a@b"])
def test_invalid_values_stay(text):
    assert pseudonyms.find(text, KEY) == []


BESIDE = [  # the values of a text with other numbers beside them
    ("4539 1488 0343 6467 12/25", ["4539 1488 0343 6467"]), ("4539 1488 0343 6467 123", ["4539 1488 0343 6467"]),
    ("42 4539148803436467", ["4539148803436467"]), ("12 2024-05-01 4539 1488 0343 6467", ["2024-05-01", "4539 1488 0343 6467"]),
    ("4539148803436467 2024-05-01", ["4539148803436467", "2024-05-01"]), ("7 45391488 03436467 12", ["45391488 03436467"]),
    ("4539-1488-0343-6467 4539148803436467 9", ["4539-1488-0343-6467", "4539148803436467"]),
    ("DE89370400440532013000 15 Mai", ["DE89370400440532013000"]),
    ("DE89 3704 0044 0532 0130 00 2024-05-01", ["DE89 3704 0044 0532 0130 00", "2024-05-01"]),
    ("NO12 4539 1488 0343 6467", ["4539 1488 0343 6467"]), ("CH93 0076 2011 6238 5295 7 20", ["CH93 0076 2011 6238 5295 7"]),
    ("+1 (626) 555-5759 24 hours", ["+1 (626) 555-5759"]), ("12 +1 626 555 5759 2024-05-01", ["+1 626 555 5759", "2024-05-01"]),
    ("+49 30 123 4567 2024-05-01", ["+49 30 123 4567", "2024-05-01"]), ("+49 30 1234 5678 1234", ["+49 30 1234 5678"]),
    ("+49 30 1234 567 190.137.223.204", ["+49 30 1234 567", "190.137.223.204"]),
    ("+49 30 1234 567 123-45-6789", ["+49 30 1234 567", "123-45-6789"]),
    ("+1 (626) 555-5759 24@mail.org", ["+1 (626) 555-5759", "24@mail.org"]), ("20 123-45-6789 7", ["123-45-6789"])]


@pytest.mark.parametrize("text, values", BESIDE)
def test_values_beside_other_numbers(text, values):
    assert [text[s:e] for s, e, _, _ in pseudonyms.find(text, KEY)] == values
    alone = [pseudonyms.find(v, KEY)[0][2:] for v in values]
    assert [f[2:] for f in pseudonyms.find(text, KEY)] == alone


@pytest.mark.parametrize("v", [
    "GB82 WEST 1234 5698 7654 32", "NL91ABNA0417164300", "NL91 ABNA 0417 1643 00", "FR14 2004 1010 0505 0001 3M02 606",
    "IT60X0542811101000000123456", "IE29 AIBK 9311 5212 3456 78", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"])
def test_ibans_with_letters(v):
    for text in (f"from {v}.", f"from {v} 12 May", f"from {v} THE BANK"):
        (s, e, kind, new), = pseudonyms.find(text, KEY)
        assert (kind, text[s:e]) == ("iban", v) and new != v and new[:2] == v[:2]
        assert re.sub("[A-Z]", "A", re.sub(r"\d", "9", new)) == re.sub("[A-Z]", "A", re.sub(r"\d", "9", v))
        assert pseudonyms.find(f"x {new}", KEY)[0][2] == "iban"
        assert int("".join(str(int(c, 36)) for c in (new[4:] + new[:4]).replace(" ", ""))) % 97 == 1


def test_feistel_is_a_permutation():
    for n in (1, 2, 10, 97, 1000):
        assert sorted(pseudonyms.permute(x, n, KEY, "t") for x in range(n)) == list(range(n))


def test_rollup_equals_recount_and_is_idempotent(spark, tmp_path):
    rows = [(1, "s", "en", "one two"), (2, "s", "de", "drei"), (3, None, None, "x y z"), (3, None, None, "x y z"), (4, "t", "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    count = tokenrollup.count_tokens(docs, "v1")
    n = {r["doc_id"]: r["n_tokens"] for r in count.collect()}
    r = tokenrollup.TokenRollup(spark, f"file://{tmp_path}/roll")
    assert r.commit("1", inserts=count) and not r.commit("1", inserts=count)
    gone = spark.createDataFrame([(1,), (1,), (77,)], "doc_id long")
    new = spark.createDataFrame([(3, "v1", 10), (3, "v1", 9), (1, "v1", 5), (2, "v2", 4)], "doc_id long, tokenizer string, n_tokens long")
    assert r.commit("2", deletes=gone) and r.commit("3", revisions=new) and not r.commit("2", deletes=gone)
    got = {(x["source"], x["lang"]): (x["n_docs"], x["n_tokens"]) for x in r.totals().collect()}
    assert got == {("s", "de"): (1, n[2]), (None, None): (2, 20), ("t", "en"): (1, 0)}
    # a batch that died before its deltas were written is delivered again
    (count.withColumn("d_docs", F.lit(1).cast("long")).withColumnRenamed("n_tokens", "d_tokens")
     .write.parquet(f"{tmp_path}/roll/ledger/batch=4"))
    assert r.commit("4", deletes=spark.createDataFrame([(2,)], "doc_id long"))
    assert ("s", "de") not in {(x["source"], x["lang"]) for x in r.totals().collect()}


def test_page_text_held_out(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    chain = pagetext.fit([(pagetext.active(b), y) for b, y in pagetext.training_set(pages[:100], made=400)])
    for page in pages[100:]:
        body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
        body = re.sub(r"<[^>]*(>|\Z)", "", re.sub(r"<(/?(p|h1)|br)>", " ", body))
        assert pagetext.main_text(page, chain) == " ".join(html.unescape(body).split())
    lines = [b.text for p in pages[100:] for b in pagetext.blocks(p)]
    rnd, right, total = random.Random(2), 0, 0
    for _ in range(150):
        found, labels = pagetext.marked(pagetext.made_page([x for x in lines if len(x) > 60], [x for x in lines if len(x) < 90], rnd))
        right += sum(a == b for a, b in zip(labels, chain.decode(pagetext.active(found))))
        total += len(labels)
    assert right / total > 0.96


def test_viterbi_equals_brute_force():
    rnd = np.random.default_rng(1)
    chain = pagetext.Chain(rnd.normal(size=len(pagetext.NUMBERS)), rnd.normal(size=(2, 2)), rnd.normal(size=2))
    for n in (1, 2, 5, 8):
        feats = [rnd.choice(len(pagetext.NUMBERS), 4, replace=False).tolist() for _ in range(n)]

        def total(y):
            s = chain.start[y[0]] + sum(chain.weights[f].sum() for f, v in zip(feats, y) if v)
            return s + sum(chain.step[a, b] for a, b in zip(y, y[1:]))

        every = [[(k >> i) & 1 for i in range(n)] for k in range(1 << n)]
        assert abs(total(chain.decode(feats)) - max(map(total, every))) < 1e-9


def test_blocks_decode_and_join():
    got = [b.text for b in pagetext.blocks("<p>a &lt;b&gt;&nbsp; c<br>d<b>e</b>f<script>x<y</script><!-- n --><p>&am <i>g")]
    assert got == ["a <b> c def", "&am g"]


def test_pipeline_against_brute_force(spark, texts):
    """Every stage, on its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.STAGES[0][1](spark, docs, SMALL).collect()}
    scored = {r["doc_id"] for r in quality.score(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect() if r["keep"]}
    assert set(kept) == scored
    classes = brute_classes(kept)
    left = {i: t for i, t in kept.items() if classes[i] == i}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}

    def grams(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    sets = [grams(t) for t in items.values()]
    clean = {i: t for i, t in left.items() if not any(len(s & grams(t)) >= 0.8 * len(s) for s in sets)}
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(out) == set(clean) and len(out) < len(texts)
    assert all(r["round_trip"] for r in out.values())
    for i, t in clean.items():
        if not secretscan.base_spans(t):
            assert out[i]["decoded_n_chars"] == len(t)
