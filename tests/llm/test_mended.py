"""Cases that once went wrong, and registered queries against plain Python versions."""

import collections
import datetime as dt
import hashlib
import math
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from lumen.llm import decontam, neardup, pagetext, pseudonyms, quality, secretscan, spanhash, tokenrollup

KEY = b"test-key-test-key"
PASSAGE = "the quick brown fox jumps over the lazy dog near the old river bank today"
NAMES = ["_p", "_h", "_post", "_row", "_rid", "_gone", "_again", "_key", "_id", "_seen", "_host", "_sub", "__p"]


@pytest.mark.parametrize("page, texts", [
    ("<article><p>it's <a href=x title=it's>link</a> and more</p><p>next don't</p></article>", ["it's link and more", "next don't"]),
    ('<p class=a">hello', ["hello"]), ('<a title="x>y">z</a>', ["z"]), ("<p a = 'x>y'>q<p b=\"1>2\" c>r", ["q", "r"]),
    ('<p a="b>hello</p> tail', ["hello", "tail"]), ("<p it's>one</p><p isn't>two</p>", ["one", "two"])])
def test_quotes_in_tags(page, texts):
    assert [b.text for b in pagetext.blocks(page)] == texts


def spans(t):
    return {t[i:i + spanhash.SPAN] for i in range(len(t) - spanhash.SPAN + 1)} if len(t) >= spanhash.SPAN else {t}


@pytest.mark.parametrize("n", [30, 200, 639, 641, 800, 3000, 20_000])
def test_likeness_is_one_measure_at_every_length(n):
    rnd = random.Random(n)
    for _ in range(4):
        words = "".join(rnd.choices("abcdefgh    ", k=n)).split(" ")
        s = " ".join(words)
        for at in rnd.sample(range(len(words)), min(len(words), 3)):
            words[at] += "x"
        rnd.shuffle(words[:len(words) // 3])
        t = " ".join(words[len(words) // 3:] + words[:len(words) // 3])
        share = len(spans(s) & spans(t)) / len(spans(s) | spans(t))
        ends = len(common_start(s, t)) + len(common_start(s[len(common_start(s, t)):][::-1], t[len(common_start(s, t)):][::-1]))
        want = min(max(share, ends / max(len(s), len(t))), 1 - 1 / (max(len(s), len(t)) + 1))
        assert abs(spanhash.likeness(spanhash.Prefix(s), spanhash.Prefix(t)) - want) < 1e-9


def common_start(a, b):
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:k]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_fingerprints_of_repeated_and_null_ids(spark, kind):
    rnd = random.Random(2)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, "".join(rnd.choices("abc ", k=rnd.randrange(60)))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = spanhash.fingerprint_beside_next(df).collect()
    h = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = [(r["doc_id"], r["text"]) for r in df.collect() if r["doc_id"] is not None]
    order.sort(key=lambda r: (h[r[1]], r[1]))
    order.sort(key=lambda r: r[0], reverse=True)
    order += sorted([(None, r["text"]) for r in df.collect() if r["doc_id"] is None], key=lambda r: (h[r[1]], r[1]))
    want = collections.Counter()
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        new = t[:len(t) - len(t) // 3] + u[:len(t) // 3]
        want[i, len(t), hashlib.sha256(new.encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want


def test_null_ids_are_no_licence(spark):
    near = PASSAGE + " " + " ".join(f"w{i}" for i in range(60))
    rows = [(1, near), (None, near), (None, near + " end"), (None, "alone " * 3), (None, "alone " * 3), (None, PASSAGE), (2, "other text here")]
    docs = spark.createDataFrame([(*r, *range(len(NAMES))) for r in rows],
                                 "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in NAMES))
    classes = {(r["doc_id"], r["text"]): r["class_id"] for r in
               neardup.near_duplicate_classes(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect()}
    assert classes[1, near] == 1
    found = neardup.near_duplicate_classes(docs).collect()
    assert sorted(str(r["class_id"]) for r in found) == ["1", "1", "1", "2", "None", "None", "None"]
    assert sum(r["kept"] for r in found) == 4
    left = neardup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in left.collect()) == sorted(
        [("1", near), ("None", "alone " * 3), ("None", PASSAGE), ("2", "other text here")])
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contained_items(docs, items).collect()} == {(1, 1), (None, 1)}
    clean = decontam.remove_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"], r["_row"]) for r in clean.collect()) == [
        ("2", "other text here", 3), ("None", "alone " * 3, 3), ("None", "alone " * 3, 3)]
    renamed = decontam.remove_contaminated(docs.withColumnRenamed("text", "body"), items, text_col="body")
    assert renamed.count() == 3 and "body" in renamed.columns


def test_quality_keeps_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    odd = docs.withColumns({n: F.lit(7) for n in NAMES})
    kept = quality.drop_low_quality(odd, labels).collect()
    assert all(r[n] == 7 for r in kept for n in NAMES)
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in quality.score(docs, labels).collect() if r["keep"]}


def test_quality_query_equals_plain_posteriors(spark):
    """The posteriors recomputed from p_document, labels and sites in plain Python."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = E.queries()["op3_quality"](spark, SMALL).collect()
    sites = collections.defaultdict(list)
    for r in got:
        d = docs[r["doc_id"]]
        sites[d["source"], d["lang"]].append(float(label.get(r["doc_id"], r["p_document"])))
    hosts = collections.defaultdict(list)
    for (h, _), v in sites.items():
        hosts[h] += v
    g = sum(map(sum, hosts.values())) / sum(map(len, hosts.values()))

    def strength(groups):  # (n, rate, prior)
        n = sum(x[0] for x in groups)
        noise = sum(x[2] * (1 - x[2]) for x in groups) / n
        spread = sum(x[0] * (x[1] - x[2]) ** 2 for x in groups) / n - noise
        return max(1.0, min(1e4, sum(x[0] * x[2] * (1 - x[2]) for x in groups) / n / max(spread, 1e-6) - 1))

    kh = strength([(len(v), sum(v) / len(v), g) for v in hosts.values()])
    host_rate = {h: (sum(v) + kh * g) / (len(v) + kh) for h, v in hosts.items()}
    kp = strength([(len(v), sum(v) / len(v), host_rate[h]) for (h, _), v in sites.items()])
    path_rate = {s: (sum(v) + kp * host_rate[s[0]]) / (len(v) + kp) for s, v in sites.items()}
    logit = lambda x: math.log(min(max(x, 1e-4), 1 - 1e-4) / (1 - min(max(x, 1e-4), 1 - 1e-4)))
    for r in got:
        d = docs[r["doc_id"]]
        z = logit(r["p_document"]) + logit(path_rate[d["source"], d["lang"]]) - logit(g)
        assert abs(1 / (1 + math.exp(-z)) - r["p_good"]) < 2e-3
        assert r["keep"] == (r["p_good"] >= 0.5) or abs(r["p_good"] - 0.5) < 1e-5


def test_labels_move_their_site(spark):
    rows = [(i, f"some words of text number {i}", "h1" if i < 40 else "h2", "en") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, 0) for i in range(40)], "doc_id long, quality int")  # one kind: no classifier
    got = {r["doc_id"]: r for r in quality.score(docs, labels).collect()}
    assert all(got[i]["p_document"] == 0.5 for i in got)
    assert all(got[i]["p_good"] < 0.5 < got[60]["p_good"] for i in range(40))


def test_secret_models_by_form(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratio = secretscan.train(docs)
    plain = collections.Counter({(r["label"], r["pair"]): r["n"] for r in secretscan.labelled_pairs(docs).collect()})
    counts = np.zeros(secretscan.CLASSES ** 2)
    for (label, pair), n in plain.items():
        counts[pair] += n * (label == 0)
    words = secretscan.chain_words(counts, 500, seed=77) + ["tenant", "kafka", "repository", "springframework", "webhook"] * 30
    for form, made in secretscan.identifier_samples(words, 1000, seed=99).items():  # other words, another seed
        made = [m for m in made if len(m) >= secretscan.MIN_RUN and not secretscan.base_spans(m)]
        wrong = sum(any(k == 3 for _, k, _ in secretscan.scan_text(m, ratio)) for m in made)
        assert wrong < 0.012 * len(made), (form, wrong)
    rnd = random.Random(41)
    for alphabet in (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
                     string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits):
        for size in (20, 32, 43):
            keys = ["".join(rnd.choices(alphabet, k=size)) for _ in range(200)]
            assert sum(any(k == 3 for _, k, _ in secretscan.scan_text(f"use {x} now", ratio)) for x in keys) >= 0.95 * 200
    for s in ("src/main/java/com/example/MyServiceImpl", "getUserAccountByIdAndTenantName", "MAX_CONNECTION_POOL_SIZE_DEFAULT",
              "-" * 24, "A" * 24, "550e8400-e29b-41d4-a716-446655440000"):
        assert secretscan.masked(f"x {s} y", ratio) == f"x {s} y"


def test_planted_secrets_are_found_in_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 60")
    rnd = random.Random(9)
    keys = {i: "".join(rnd.choices(string.ascii_letters + string.digits, k=36)) for i in range(60)}
    planted = spark.createDataFrame([(r["doc_id"], f"{r['text']} {keys[r['doc_id']]} end") for r in docs.collect()],
                                    "doc_id long, text string")
    found = {r["doc_id"]: r for r in secretscan.scan(planted, secretscan.train(planted)).collect()}
    assert sum(r["n_markov"] >= 1 for r in found.values()) >= 0.95 * len(found)
    masked = {r["doc_id"]: r["text"] for r in secretscan.mask_secrets(planted).collect()}
    assert sum(keys[i] not in t for i, t in masked.items()) >= 0.95 * len(masked)


def test_phone_numbers_are_linked_whatever_their_spacing():
    digits = lambda v: re.sub(r"\D", "", v)
    for group in (["+442079460958", "+44 2079460958", "+44 20 7946 0958", "+44 (20) 7946 0958"],
                  ["+16265555759", "+1 (626) 555-5759", "+1-626-555-5759"], ["+380441234567", "+380 44 123 4567"]):
        new = [pseudonyms.find(f"call {v} now", KEY)[0][3] for v in group]
        assert len({digits(n) for n in new}) == 1 and digits(new[0]) != digits(group[0])
    assert pseudonyms.find("+442079460958", KEY)[0][3].startswith("+44")
    assert pseudonyms.find("version 1.2.3.4 and v10.0.0.1", KEY) == []
    assert [f[2] for f in pseudonyms.find("from 10.0.0.1", KEY)] == ["ip"]


def plain_values(text):
    """An independent finder of the plainest values: ISO dates, SSNs, single card numbers, octets."""
    out = []
    for m in re.finditer(r"(?<![\w./-])\d{4}-\d{2}-\d{2}(?![\w./-])", text):
        try:
            if 1900 <= dt.date.fromisoformat(m.group()).year <= 2099:
                out.append(("date", m.group()))
        except ValueError:
            pass
    for m in re.finditer(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", text):
        a, g, n = m.group().split("-")
        if a not in ("000", "666") and a < "900" and g != "00" and n != "0000":
            out.append(("ssn", m.group()))
    for m in re.finditer(r"(?<![\w.+-])(?<!\d )\d{16}(?![\w.-])(?! \d)", text):
        odd = [int(c) for c in m.group()[-1::-2]] + [int(c) * 2 // 10 + int(c) * 2 % 10 for c in m.group()[-2::-2]]
        if sum(odd) % 10 == 0 and len(set(m.group())) > 1:
            out.append(("card", m.group()))
    return out


def test_pseudonym_query_against_an_independent_finder(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    seen, total = {}, 0
    for r in E.queries()["op7_pseudonyms"](spark, sf).collect():
        old, new, at, out = texts[r["doc_id"]], r["text"], 0, 0
        taken = collections.Counter()
        for span in filter(None, r["spans"].split(",")):
            kind, s, e = span.split(":")
            s, e = int(s), int(e)
            out += s - at
            assert old[at:s] == new[out - (s - at):out]
            value = new[out:out + e - s]
            if kind in ("card", "ssn"):
                assert seen.setdefault((kind, old[s:e]), value) == value
            if kind in ("ip", "date"):  # these may change their length
                break
            out, at = out + e - s, e
        for span in filter(None, r["spans"].split(",")):
            kind, s, e = span.split(":")
            taken[kind, old[int(s):int(e)]] += 1
        want = collections.Counter(plain_values(old))
        total += sum(want.values())
        assert not want - taken, (r["doc_id"], want - taken)
    assert total > 10


def test_rollup_moves_revised_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "en", "one two"), (2, "a", "en", "x"), (2, "a", "en", "x"), (3, None, None, "y")],
                                 "doc_id long, source string, lang string, text string")
    count = tokenrollup.count_tokens(docs, "v1")
    n = {r["doc_id"]: r["n_tokens"] for r in count.collect()}
    r = tokenrollup.TokenRollup(spark, f"file://{tmp_path}/roll")
    r.commit("1", inserts=count)
    r.commit("2", revisions=spark.createDataFrame([(1, "b", "de", "v1", 9), (2, "c", None, "v1", 4), (3, None, None, "v1", 5)],
                                                  "doc_id long, source string, lang string, tokenizer string, n_tokens long"))
    got = {(x["source"], x["lang"]): (x["n_docs"], x["n_tokens"]) for x in r.totals().collect()}
    assert got == {("b", "de"): (1, 9), ("c", None): (2, 8), (None, None): (1, 5)} and n[1] == 2
    r.commit("3", deletes=spark.createDataFrame([(1,), (2,)], "doc_id long"))
    assert [tuple(x) for x in r.totals().collect()] == [(None, None, "v1", 1, 5)]


def test_rollup_query_equals_recount(spark):
    import tiktoken  # noqa: F401
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    enc = tokenrollup._encoder(tokenrollup.RANKS_PATH)
    want = collections.defaultdict(lambda: [0, 0])
    for d in docs:
        lab = labels.get(d["doc_id"])
        if lab and lab["quality"] == 0:
            continue
        text = re.sub(r"[ \t\n\x0b\f\r]+", " ", d["text"] or "") if lab and lab["toxic"] == 1 else d["text"] or ""
        w = want[d["source"], d["lang"]]
        w[0] += 1
        w[1] += len(enc.encode_ordinary(text))
    got = {(r["source"], r["lang"]): [r["n_docs"], r["n_tokens"]] for r in E.queries()["op8_token_rollup"](spark, SMALL).collect()}
    assert got == {k: v for k, v in want.items() if v[0]}
