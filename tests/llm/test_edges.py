"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns with clashing names: every operator, against the result its docstring defines."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumen.llm import (decontam, neardup, pagetext, pseudonyms, quality, secretscan, sentencepieces, spanhash,
                       tokenrollup, warc)

KEY = b"k" * 16
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
PASSAGE = "the quick brown fox jumps over the lazy dog near the old river bank today"
TEXTS = [None, "", "  \n ", "one", PASSAGE, PASSAGE, f"before {PASSAGE} after", LONG, "naïve 東京 😀\x00 text"]
DDL = "doc_id long, text string, lang string, source string, n_chars long, id string, h string, label int, bucket int, w double"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", None, "x", "y", 1, 2, 0.5) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, PASSAGE, None, None, 3, None, None, None, None, None)]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1), (5, 0), (None, 1), (99, 1), (6, None), (4, 1)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, "naïve 東京"), (1, PASSAGE)],
                                 "item_id long, text string")


def operators(labels, items):
    def rollup(d):
        r = tokenrollup.TokenRollup(d.sparkSession, tokenrollup_path(d.sparkSession))
        r.commit("a", inserts=tokenrollup.count_tokens(d, "v1"))
        return r.totals()

    return {
        "neardup": lambda d: neardup.near_duplicate_classes(d),
        "quality": lambda d: quality.score(d, labels),
        "secrets": lambda d: secretscan.scan(d, secretscan.train(d)),
        "spanhash": lambda d: spanhash.fingerprint_beside_next(d),
        "sentencepieces": lambda d: sentencepieces.encode_decode(d),
        "pseudonyms": lambda d: pseudonyms.pseudonymise(d, KEY),
        "rollup": rollup,
        "decontam": lambda d: decontam.contained_items(d, items),
        "warc": lambda d: warc.archive_pages(d.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"),
                                                      F.col("text").alias("html"), "id", "h")),
        "pagetext": lambda d: pagetext.extract(
            d.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html"), "id"),
            CHAIN),
    }


def tokenrollup_path(spark):
    from lumen.session import scratch_dir
    return scratch_dir(spark, "rollup-test")


CHAIN = pagetext.fit([(pagetext.active(b), y) for b, y in pagetext.training_set([], made=60)], steps=60)
NAMES = ["neardup", "quality", "secrets", "spanhash", "sentencepieces", "pseudonyms", "rollup", "decontam", "warc", "pagetext"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(empty, labels, items, name):
    assert operators(labels, items)[name](empty).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(docs, labels, items, name):
    got = operators(labels, items)[name](docs).collect()
    if name in ("rollup", "decontam"):
        assert got
    else:
        assert len(got) == len(TEXTS) + 2


def by_id(rows, key="doc_id"):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out


def test_neardup_defined_results(docs, labels, items):
    got = by_id(neardup.near_duplicate_classes(docs).collect())
    assert {r["class_id"] for i in (0, 1, 2) for r in got[i]} == {0}  # texts without words
    assert {r["class_id"] for i in (4, 5, None) for r in got[i]} == {4}
    assert got[3][0]["class_id"] == 3 and got[7][0]["class_id"] == 7
    kept = [r["doc_id"] for r in neardup.drop_near_duplicates(docs).collect()]
    assert kept.count(4) == 1 and 5 not in kept and None not in kept and 7 in kept  # a null id is no licence
    assert neardup.drop_near_duplicates(docs).columns == docs.columns


def test_decontam_defined_results(docs, labels, items):
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contained_items(docs, items).collect()}
    assert got == {(4, 1), (5, 1), (6, 1), (8, 4), (None, 1)}
    left = [r["doc_id"] for r in decontam.remove_contaminated(docs, items).collect()]
    assert sorted(left) == [0, 1, 2, 3, 7]
    none = decontam.contained_items(docs, items.limit(0))
    assert none.collect() == []


def test_decontam_repeated_items_with_different_texts(spark):
    short, long = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("s", 14), ("l", 104)))
    items = spark.createDataFrame([(1, short), (1, long), (2, long), (3, "two words"), (3, short)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {short} y"), (2, f"x {long} y"), (3, long[:len(long) // 2]), (4, "so two words"),
                                  (5, f"{short} {long}")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_item"], r["n_shared"]) for r in decontam.contained_items(docs, items).collect()}
    assert got == {(1, 1): (10, 10), (1, 3): (10, 10), (2, 1): (100, 100), (2, 2): (100, 100), (4, 3): (1, 1),
                   (5, 1): (100, 100), (5, 2): (100, 100), (5, 3): (10, 10)}
    assert [r["doc_id"] for r in decontam.remove_contaminated(docs, items).collect()] == [3]


def test_rows_that_share_an_id_are_told_apart(spark):
    clean, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "cd")
    docs = spark.createDataFrame([(1, PASSAGE), (5, PASSAGE), (5, clean), (5, clean), (7, other), (8, other)],
                                 "doc_id long, text string")
    left = sorted(tuple(r) for r in neardup.drop_near_duplicates(docs).collect())
    assert left == [(1, PASSAGE), (5, clean), (7, other)]
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    left = sorted(tuple(r) for r in decontam.remove_contaminated(docs, items).collect())
    assert left == [(5, clean), (5, clean), (7, other), (8, other)]


def test_spanhash_defined_results(docs):
    got = by_id(spanhash.fingerprint_beside_next(docs).collect())
    assert got[0][0]["n_chars"] == 0 and got[1][0]["near_edited"] == 1.0
    assert got[4][0]["fingerprint"] == got[5][0]["fingerprint"] == got[None][0]["fingerprint"]
    assert got[5][0]["near_next"] == 1.0
    assert got[7][0]["n_chars"] == len(LONG)
    one = spanhash.fingerprint_beside_next(docs.where("doc_id = 6")).collect()
    assert one[0]["near_next"] == 1.0


def test_sentencepiece_defined_results(docs):
    for r in sentencepieces.encode_decode(docs).collect():
        assert r["round_trip"] and r["parity"], r["doc_id"]


def test_secrets_and_pseudonyms_leave_plain_texts(docs):
    ratio = secretscan.train(docs)
    assert {r["spans"] for r in secretscan.scan(docs, ratio).collect()} == {""}
    same = {(r["doc_id"], r["text"]) for r in secretscan.mask_secrets(docs).collect()}
    assert same == {(r["doc_id"], r["text"]) for r in docs.collect()}
    new = {(r["doc_id"], r["text"]) for r in pseudonyms.pseudonymise(docs, KEY).collect()}
    assert new == {(r["doc_id"], r["text"] or "") for r in docs.collect()}


def test_quality_without_usable_labels(docs, labels):
    got = quality.score(docs, labels.limit(0)).collect()
    assert all(r["keep"] and r["p_document"] == 0.5 for r in got)


def test_stages_keep_the_columns(spark, docs, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, str(tmp_path))
            assert out.columns == docs.columns, name
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            out.collect()
