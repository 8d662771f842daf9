"""Benchmark decontamination by size-partitioned MinHash containment search.

A document contains a test item when it has at least ``threshold`` of the
item's distinct five-word shingles.  Words are maximal runs of letters and
digits, lower case.  An item of fewer than five words is one shingle of all its
words, searched at that width.

Search.  Items fall into partitions by size (powers of two of their shingle
count).  For each item the partition's number of hash functions picks that many
MinHash minima; items up to ``EXACT_SIZE`` shingles use all their shingles.  The
j-th minimum of an item lies in a document exactly when the item and its part
inside the document have the same j-th MinHash value, which happens with the
probability of the containment, whatever the document's length.  So documents
need no signature: a document that has any minimum of an item is a candidate,
and one with containment 0.8 is missed with probability 0.2 to the power of the
number of functions (2.6e-6 for eight).

Verification.  Candidates are joined back to their documents and the share of
the item's shingles found there is counted exactly.

Documents are searched by (id, text digest), so rows with a null id and rows that
share an id are searched like all others.

Only DataFrame functions are used.  Item tables are broadcast after a measure of
their bytes or shingles; larger ones are joined by shuffle.  Defined results: null
or empty texts and items match nothing; repeated document or item rows, and rows
with a null id, give one row per (document id, item), that of the pair of texts with
the largest containment (then the largest item text); very long texts are searched
whole; empty tables match nothing; extra columns are ignored by
``contained_items`` and stay, whatever their names, in ``remove_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import hint_small, write_once
from lumen.operators.ordered import free_prefix

WIDTH = 5
THRESHOLD = 0.8
EXACT_SIZE = 8
BROADCAST_SHINGLES = 2_000_000  # of all items together: 16 MB of longs
# Hash functions by size partition: 8 for 9-16 shingles, 12 for 17-32, 16 beyond.
FUNCTIONS = ((16, 8), (32, 12), (None, 16))


def words(text):
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w, width: int):
    """64-bit hashes of all runs of ``width`` words of the array ``w``."""
    n = F.size(w)
    return F.when(n >= width, F.transform(
        F.sequence(F.lit(1), F.greatest(n - (width - 1), F.lit(1))),
        lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(width)])))


def text_shingles(text, width: int):
    """Shingles of a text column.  The outer one-element ``transform`` binds the
    words to a variable; else the split could be repeated for every shingle."""
    return F.get(F.transform(F.array(words(text)), lambda w: shingles(w, width)), F.lit(0))


def item_shingles(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, width, size, sh): distinct shingle hashes of every item with words."""
    base = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"),
                        words(F.col(text_col)).alias("w")).where("size(w) > 0")
    by_width = F.lit(None)
    for k in range(1, WIDTH + 1):
        fits = (F.size("w") >= k) if k == WIDTH else (F.size("w") == k)
        by_width = F.when(fits, text_shingles(F.col("text"), k)).otherwise(by_width)
    return (base.select("item", F.least(F.size("w"), F.lit(WIDTH)).alias("width"),
                        F.array_distinct(by_width).alias("sh"))
            .withColumn("size", F.size("sh")))


def minima(items_sh: DataFrame) -> DataFrame:
    """(width, sig, item): the MinHash minima that stand for each item."""
    n_fns = F.lit(FUNCTIONS[-1][1])
    for upto, k in reversed(FUNCTIONS[:-1]):
        n_fns = F.when(F.col("size") <= upto, F.lit(k)).otherwise(n_fns)
    picked = F.transform(F.sequence(F.lit(1), n_fns), lambda j: F.array_min(
        F.transform("sh", lambda s: F.struct(F.xxhash64(s, j).alias("h"), s.alias("s"))))["s"])
    sigs = F.when(F.col("size") <= EXACT_SIZE, F.col("sh")).otherwise(F.array_distinct(picked))
    return items_sh.select("width", F.explode(sigs).alias("sig"), "item")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document, item) with containment of at least ``threshold``:
    the document id, the item id, n_item, n_shared, containment."""
    found = _found(docs, items, id_col, text_col, item_col, item_text, threshold)
    return (found.groupBy("doc", "item").agg(F.max("best").alias("best"))
            .select(F.col("doc").alias(id_col), F.col("item").alias(item_col), F.col("best.size").alias("n_item"),
                    F.col("best.n").alias("n_shared"), (F.col("best.n") / F.col("best.size")).alias("containment")))


def _found(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str,
           threshold: float) -> DataFrame:
    """(doc, digest, item, best) with ``best`` = (containment, size, n) of the texts that contain an item."""
    its = write_once(item_shingles(items, item_col, item_text), "items")
    sigs = hint_small(write_once(minima(its), "minima"))
    widths = [r["width"] for r in its.select("width").distinct().collect()]  # at most five numbers
    base = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where("text IS NOT NULL").withColumn(
        "digest", F.xxhash64("text"))
    key = ["doc", "digest"]

    def per_width(frame, cols):
        parts = [frame.select(*cols, F.lit(k).alias("width"), text_shingles(F.col("text"), k).alias("dsh"))
                 for k in sorted(widths)] or [frame.limit(0).select(*cols, F.lit(WIDTH).alias("width"),
                                                                    F.array(F.lit(0).cast("long")).alias("dsh"))]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    cands = (per_width(base, key).select(*key, "width", F.explode("dsh").alias("sig"))
             .join(sigs, ["width", "sig"]).select(*key, "item", "width").distinct())
    cands = hint_small(write_once(cands, "candidates"))
    sets = its.select("item", "width", "size", "sh")
    if (its.agg(F.sum("size")).first()[0] or 0) <= BROADCAST_SHINGLES:
        sets = F.broadcast(sets)
    near = cands.withColumnsRenamed({"doc": "d", "digest": "g"}).join(
        base, F.col("d").eqNullSafe(F.col("doc")) & (F.col("g") == F.col("digest"))).drop("d", "g")
    shared = None
    for k in sorted(widths):
        part = (near.where(F.col("width") == k)
                .select(*key, "item", "width", text_shingles(F.col("text"), k).alias("dsh"))
                .join(sets, ["item", "width"])
                .select(*key, "item", "size", F.size(F.array_intersect("sh", "dsh")).alias("n")))
        shared = part if shared is None else shared.unionByName(part)
    if shared is None:
        shared = near.select(*key, "item", F.lit(1).alias("size"), F.lit(0).alias("n"))
    return (shared.where(F.col("n") >= F.lit(threshold) * F.col("size")).groupBy(*key, "item")
            .agg(F.max(F.struct((F.col("n") / F.col("size")).alias("c"), "size", "n")).alias("best")))


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the documents that contain a test item; all columns stay.
    A row goes by its own text, whatever other rows share its id."""
    p = free_prefix(docs.columns)
    found = _found(docs, items, id_col, text_col, item_col, item_text, THRESHOLD)
    gone = write_once(found.select(F.col("doc").alias(f"{p}doc"), F.col("digest").alias(f"{p}digest")).distinct(), "contaminated")
    same = F.col(id_col).eqNullSafe(F.col(f"{p}doc")) & (F.xxhash64(text_col) == F.col(f"{p}digest"))
    return docs.join(hint_small(gone), same, "left_anti")


ORACLE_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS row, doc_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark
), ish AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest([array_to_string(w[i:i + least(len(w), 5) - 1], ' ')
         FOR i IN range(1, len(w) - least(len(w), 5) + 2)]) AS s
  FROM iw WHERE len(w) > 0
), isz AS (
  SELECT item_id, count(*) AS n FROM ish GROUP BY item_id
), dsh AS (
  SELECT DISTINCT row, doc_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS s
  FROM dw, (SELECT DISTINCT k FROM ish) ks WHERE len(w) >= k
)
SELECT doc_id, item_id, CAST(any_value(n) AS INTEGER) AS n_item, CAST(max(n_shared) AS INTEGER) AS n_shared,
       max(n_shared) / any_value(n) AS containment
FROM (SELECT row, doc_id, item_id, any_value(n) AS n, count(*) AS n_shared
      FROM dsh JOIN ish USING (k, s) JOIN isz USING (item_id) GROUP BY row, doc_id, item_id)
WHERE n_shared >= 0.8 * n GROUP BY doc_id, item_id
"""
