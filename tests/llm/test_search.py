"""Hard negatives, language identification and spelling variants, against brute force."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from lumen.llm import hardnegatives, langid, spellings
from tools.oracle_check import compare, duck

VECTORS = "vec_id long, label long, embedding array<double>, q string, cid int, floor double"


def test_hard_negatives_equal_sql(spark):
    got = E.queries()["op11_hard_negatives"](spark, SMALL).toPandas()
    assert len(got) and compare(got, duck(SMALL).execute(E.oracle_sql()["op11_hard_negatives"]).df()) is None


def brute_negatives(rows, every):
    rows = [(i, y, [math.floor(256 * c) for c in v]) for i, y, v, *_ in rows
            if i is not None and y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = set()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, (i, y, v) in enumerate(rows):
        if i % every:
            continue
        scored = sorted(((-dot(v, w), j, z == y) for b, (j, z, w) in enumerate(rows) if b != a and not (j == i)))
        for s, j, _ in [t for t in scored if t[2]][:5]:
            inside = [(t, k) for t, k, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out |= {(i, j, n + 1, k, -s, -t) for n, (t, k) in enumerate(inside)}
    return out


def got_negatives(spark, rows, every):
    df = spark.createDataFrame(rows, VECTORS)
    return {tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
            for r in hardnegatives.mine(df, F.col("vec_id") % every == 0).collect()}


def test_hard_negatives_of_clusters_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(hardnegatives, "SEED_ROWS", 40)
    monkeypatch.setattr(hardnegatives, "BLOCK", 100)
    monkeypatch.setattr(hardnegatives, "ROWS_PER_CELL", 4)
    r = np.random.default_rng(1)
    centres = r.normal(size=(8, 7))
    vectors = [(centres[r.integers(8)] + 0.1 * r.normal(size=7)).round(2).tolist() for _ in range(420)]
    vectors += [vectors[0]] * 210  # a third of all rows are one vector
    rows = [(int(i), int(r.integers(3)) if i % 5 else 1, v, "x", 1, 0.0) for i, v in enumerate(vectors)]
    want = brute_negatives(rows, 10)
    assert len(want) > 200 and got_negatives(spark, rows, 10) == want


def test_hard_negatives_visit_fewer_cells(spark):
    """Far cells of separate clusters are never visited."""
    r = np.random.default_rng(2)
    x = np.repeat(r.normal(size=(30, 8)) * 900, 200, axis=0) + r.normal(size=(6000, 8))
    multi = hardnegatives.MultiIndex([hardnegatives.fit_codebook(h, 30) for h in (x[:, :4], x[:, 4:])], None, None, 8)
    at = [hardnegatives.nearest(h, c) for h, c in zip(multi.halves(x), multi.books)]
    multi.sizes = np.zeros((len(multi.books[0]), len(multi.books[1])), int)
    np.add.at(multi.sizes, (at[0][0], at[1][0]), 1)
    multi.radii = [np.array([d[i == k].max(initial=0) for k in range(len(c))]) for (i, d), c in zip(at, multi.books)]
    first, second = multi.bounds(x[:1])
    scores = x @ x[0]
    wanted = multi.visits(first[0], second[0], float(np.sort(scores)[-6]))
    seen = np.array([j in wanted.get(i, []) for i, j in zip(at[0][0], at[1][0])])
    seeds = multi.visits(first[0], second[0], None)
    seen |= np.array([j in seeds.get(i, []) for i, j in zip(at[0][0], at[1][0])])
    assert seen[np.argsort(-scores)[:6]].all() and seen.mean() < 0.6
    bounds = [b for b, _, _ in hardnegatives.multi_sequence(first[0], second[0])]
    assert bounds == sorted(bounds, reverse=True) and len(bounds) == first.size * second.size


def test_hard_negatives_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 2, [0.5 + i / 100, -0.25], "x", i, 0.5) for i in range(1, 30)]
    odd = [(None, 1, [1.0, 1.0], "", 1, 0.0), (100, None, [1.0, 1.0], "", 1, 0.0), (110, 1, None, "", 1, 0.0),
           (120, 1, [1.0, None], "", 1, 0.0), (130, 1, [nan, 1.0], "", 1, 0.0), (140, 0, [1.0, inf], "", 1, 0.0),
           (150, 0, [0.75], "", 1, 0.0), (160, 0, [], "", 1, 0.0), (170, 9, [1.0, 1.0], "", 1, 0.0), (-10, 1, [-3.0, 2.0], "", 1, 0.0)]
    assert got_negatives(spark, good + odd, 5) == brute_negatives(good + [o for o in odd if o[2] is not None], 5)
    assert got_negatives(spark, [], 5) == set()
    assert got_negatives(spark, [(5, 1, [1.0], "", 1, 0.0)], 5) == set()


@pytest.fixture(scope="module")
def found_languages(spark):
    sf = "/root/testdata/sf0.01"
    return E.queries()["op12_language"](spark, sf).collect(), {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_language_held_out_accuracy(found_languages):
    got, docs = found_languages
    assert len(got) == len(docs)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert len(held) > 200 and sum(docs[r["doc_id"]]["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def brute_language(train, text):
    """The model in plain Python: no pruning, as nothing here is rare enough to be unknown by share."""
    langs = sorted({y for y, _ in train})
    level = [defaultdict(lambda: dict.fromkeys(langs, 0)) for _ in range(6)]
    for y, t in train:
        for w in langid.words_of(t):
            level[0][w][y] += 1
            for n in range(1, 6):
                m = w if n == 1 else f"<{w}>"
                for i in range(len(m) - n + 1):
                    level[n][m[i:i + n]][y] += 1
    total = [{y: sum(c[y] for c in x.values()) for y in langs} for x in level]
    level = [{k: c for k, c in x.items() if sum(c.values()) >= 3} for x in level]
    log = lambda n, k, y: math.log((level[n][k][y] + 0.5) / (total[n][y] + 0.5 * (len(level[n]) + 1)))
    z = {y: math.log(sum(a == y for a, _ in train) / len(train)) for y in langs}
    for w in langid.words_of(text):
        if w in level[0]:
            for y in langs:
                z[y] += log(0, w, y)
            continue
        for n in range(5, 0, -1):
            m = w if n == 1 else f"<{w}>"
            known = [m[i:i + n] for i in range(len(m) - n + 1) if m[i:i + n] in level[n]]
            if known:
                for y in langs:
                    z[y] += sum(log(n, k, y) for k in known) / len(known)
                break
    best = max(langs, key=lambda y: z[y])
    return best, 1 / sum(math.exp(z[y] - z[best]) for y in langs)


def test_language_equals_brute_force(spark):
    rnd = random.Random(5)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sche", "ung", "ra", "ei"], "cc": ["eau", "ou", "mi", "ra"]}
    make = lambda y, n: " ".join("".join(rnd.choices(parts[y], k=rnd.choice((1, 2, 2, 3)))) for _ in range(n))
    train = [(y, make(y, 30)) for y in "aa bb cc aa bb".split() for _ in range(4)]
    docs = spark.createDataFrame([(y, t) for y, t in train] + [(None, "ka ka"), ("zz", None)], "lang string, text string")
    model = langid.train(docs)
    for text in [make(y, n) for y in parts for n in (1, 2, 5)] + ["Karau, MIschEAU!", "qqq ka", "x1y2"]:
        lang, score = langid.Reader(model).predict(text)
        want = brute_language(train, text)
        assert lang == want[0] and abs(score - want[1]) < 1e-4, text


def test_language_defined_results(spark):
    docs = spark.createDataFrame(
        [(1, "der die das", "de", "p"), (2, "der die das", "de", "q"), (3, "the a an", "en", "r"), (4, None, "en", "s"),
         (5, "", "en", "t"), (6, "1234 _ ½", None, "u"), (7, "漢字", None, "v"), (None, "der", "en", None), (2, "der die das", "de", "w")],
        "doc_id long, text string, lang string, score string")
    model = langid.train(docs)
    got = langid.with_language(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    by = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in got.collect()}
    assert by[4, None] == by[5, ""] == by[6, "1234 _ ½"] == ("und", 0.0)
    assert by[7, "漢字"][0] in ("de", "en") and by[None, "der"][0] == "de" and len(by) == 8
    held = {r["doc_id"]: r["held_out"] for r in langid.predict_held_out(docs).collect()}
    assert held[None] is False and held[1] == (zlib.crc32(b"1") % 3 == 1)
    empty = docs.where("false")
    assert langid.predict_held_out(empty).collect() == []
    nothing = langid.with_language(docs.limit(1), langid.train(empty)).collect()[0]
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)
    long = spark.createDataFrame([("the a an " * 200_000,)], "text string")
    assert langid.with_language(long, model).first()["lang_pred"] == "en"


def edits_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:k] + t[k + 1:] == s for k in range(len(t)))


def brute_variants(counts):
    near = {w: [v for v in counts if edits_one(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def got_variants(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spellings.group_variants(df).collect()
    assert len(rows) == len(counts)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("chunk", [32_768, 60])
def test_spelling_variants_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(spellings, "CHUNK", chunk)  # the small one cuts every block into parts
    rnd = random.Random(7)
    counts = {}
    for _ in range(60):
        w = "".join(rnd.choices("aaabcéÉ", k=rnd.randrange(5, 10)))
        for _ in range(8):
            counts[w] = 10 ** rnd.randrange(0, 6)
            k = rnd.randrange(len(w) + 1)
            w = rnd.choice((w[:k] + rnd.choice("abcé") + w[k:], w[:k] + w[k + 1:], w[:k] + "b" + w[k + 1:])) or "a"
    counts |= {"": 3, "x": 50, "z": 7, "a" * 300: 9, "a" * 301: 100, "a" * 299 + "b": 2, "ba" * 70: 1, "ba" * 69 + "a": 5,
               "ba" * 69 + "bb": 70, "\U0001F600abc": 4, "abc": 90}
    assert got_variants(spark, counts) == brute_variants(counts)


def test_spelling_chain_of_forms(spark):
    chain = {"aaaaaaa"[:7 - k] + "b" * k: 10 ** k for k in range(8)}
    got = got_variants(spark, chain)
    assert got == brute_variants(chain) and got["aaaaaaa"][1] == "bbbbbbb"


def test_spelling_words_of_documents(spark):
    rows = [(i, t) for i, t in enumerate(["Straße straße strasse Ünique ÜNIQUE×÷abc", None, "", "zweimal zweimal kurz", "ZWEIMAL nur-einmal"] * 9)]
    rows += [(None, "zweimal"), (3, rows[3][1])]
    want = defaultdict(int)
    import re
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            want[w] += len(w) >= 7
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["word"]: r["n"] for r in spellings.noisy_words(docs).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}
    assert spellings.group_variants(spellings.noisy_words(docs.where("false"))).collect() == []


def test_spelling_query_equals_brute_force(spark):
    words = {r["word"]: r["n"] for r in spellings.noisy_words(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in E.queries()["op13_spellings"](spark, SMALL).collect()}
    holes = defaultdict(set)  # words that are equal but for one code point
    for w in words:
        for k in range(len(w)):
            holes[w[:k] + "\0" + w[k + 1:]].add(w)
    near = {w: {v for k in range(len(w)) for v in holes[w[:k] + "\0" + w[k + 1:]]} - {w} for w in words}
    for w in words:
        for k in range(len(w)):
            if (v := w[:k] + w[k + 1:]) in words:
                near[w].add(v), near[v].add(w)
    form = {w: (b if (b := min(near[w], key=lambda v: (-words[v], v), default=None)) and words[b] >= 10 * words[w] else None) for w in words}

    def root(w):
        return root(form[w]) if form[w] else w

    assert got == {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}
