"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.llm import (decontam, hardnegatives, langid, neardup, pagetext, pseudonyms, quality, secretscan, sentencepieces,
                       spanhash, spellings, tokenrollup, warc)
from lumen.llm.common import hint_small, write_once
from lumen.session import scratch_dir

# A deployment sets its own key in the session under this name; the default is for the given tables.
PSEUDONYM_KEY = ("spark.lumen.pseudonymKey", "lumen-demo-key-0001")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir):
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op2_near_dedup(spark, sf_dir):
    found = neardup.near_duplicate_classes(_table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "class_id", "doc_id <=> class_id AS is_kept")


def op3_quality(spark, sf_dir):
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_secrets(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return secretscan.scan(docs, secretscan.train(docs))


def op5_fingerprints(spark, sf_dir):
    return spanhash.fingerprint_beside_next(_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark, sf_dir):
    return sentencepieces.encode_decode(_table(spark, sf_dir, "documents"))


def op7_pseudonyms(spark, sf_dir):
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents"), spark.conf.get(*PSEUDONYM_KEY).encode())


def op8_token_rollup(spark, sf_dir):
    """Four deliveries: all documents; the documents labelled low quality are
    deleted; the documents labelled toxic are recounted without their line
    breaks; and the second delivery comes again."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    rollup = tokenrollup.TokenRollup(spark, scratch_dir(spark, "rollup"))
    rollup.commit("0001", inserts=tokenrollup.count_tokens(docs, "byte_bpe_50k"))
    low = labels.where("quality = 0").select("doc_id")
    rollup.commit("0002", deletes=low)
    toxic = hint_small(write_once(labels.where("toxic = 1").select("doc_id").distinct(), "recounted"))
    flat = docs.join(toxic, "doc_id", "left_semi").selectExpr(
        "doc_id", "source", "lang", "regexp_replace(text, '\\\\s+', ' ') AS text")
    rollup.commit("0003", revisions=tokenrollup.count_tokens(flat, "byte_bpe_50k"))
    rollup.commit("0002", deletes=low)
    return rollup.totals()


def op9_html_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return pagetext.extract(pages, pagetext.train(pages))


def op10_decontamination(spark, sf_dir):
    return decontam.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark, sf_dir):
    vectors = hardnegatives.relabelled(_table(spark, sf_dir, "embeddings"))
    return hardnegatives.mine(vectors, F.col("vec_id") % 50 == 0)


def op12_language(spark, sf_dir):
    return langid.predict_held_out(_table(spark, sf_dir, "documents"))


def op13_spellings(spark, sf_dir):
    return spellings.group_variants(spellings.noisy_words(_table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_near_dedup, op3_quality, op4_secrets, op5_fingerprints, op6_sentencepiece, op7_pseudonyms,
    op8_token_rollup, op9_html_text, op10_decontamination, op11_hard_negatives, op12_language,
    op13_spellings)}

ORACLE = {"op1_warc": warc.ORACLE_SQL, "op10_decontamination": decontam.ORACLE_SQL,
          "op11_hard_negatives": hardnegatives.ORACLE_SQL}
