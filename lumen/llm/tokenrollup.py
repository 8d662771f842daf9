"""Token counts kept in delta-maintained rollups.

A ``TokenRollup`` keeps two tables under a shared folder, partitioned by batch:
* ``ledger``  signed entries (document, source, lang, tokenizer, d_docs, d_tokens)
* ``deltas``  their sums by (source, lang, tokenizer)

Totals are sums of deltas, so a batch costs its own size plus a look-up of the
documents that it deletes or revises.  Three kinds of batch:
* ``insert``  +1 document and +n tokens an entry
* ``delete``  minus the document's present sums
* ``revise``  minus the document's present sums under its present source and
  lang, plus the new count under those of the revision; where the revision has no
  such columns they stay as they are (documents not counted at present are ignored)

A batch is named by an id; it is committed when its ``deltas`` folder has the
writer's ``_SUCCESS`` marker.  Committing an id again does nothing; a batch that
died half-way is overwritten, so retries and repeated deliveries count once.

Counts: ``count_tokens`` counts a byte-level BPE's tokens (tiktoken, a vocabulary
file of ranks) over whole texts.  The vocabulary's path is a parameter and must
exist on every executor.

Defined results: null text has 0 tokens; null source, lang or id is a key of its
own; rows repeated within a batch of inserts count each; a delete or revision
repeated within a batch counts once (largest count, then last source and lang);
an empty batch commits empty deltas; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, schema_of, texts_of

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that the vocabulary was made for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ("source", "lang", "tokenizer")

_ENCODERS: dict = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, ranks_path: str = RANKS_PATH, id_col: str = "doc_id",
                 text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(cols):
        enc = _encoder(ranks_path)
        n = [len(enc.encode_ordinary(t)) if t else 0 for t in texts_of(cols["text"])]
        return {"doc_id": cols["id"], "source": cols["source"], "lang": cols["lang"],
                "tokenizer": [tokenizer] * len(n), "n_tokens": n}

    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                 F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")), run,
                     schema_of(f"doc_id {kind}, source string, lang string, tokenizer string, n_tokens long"))


class TokenRollup:
    """The rollup stored under ``path`` (a folder that all executors share)."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint"):
        self.spark, self.path = spark, path.rstrip("/")
        self.ledger_ddl = f"doc_id {id_type}, source string, lang string, tokenizer string, d_docs long, d_tokens long"
        self.delta_ddl = "source string, lang string, tokenizer string, d_docs long, d_tokens long"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def committed(self) -> list[str]:
        """Ids of the committed batches (one folder each)."""
        fs, p = self._fs(f"{self.path}/deltas")
        if not fs.exists(p):
            return []
        found = [s.getPath() for s in fs.listStatus(p)]
        marker = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(q.getName().partition("=")[2] for q in found if fs.exists(marker(q, "_SUCCESS")))

    def _table(self, name: str, ddl: str) -> DataFrame:
        paths = [f"{self.path}/{name}/batch={b}" for b in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], schema_of(ddl))
        return self.spark.read.schema(schema_of(ddl)).parquet(*paths)

    def _present(self, ids: DataFrame) -> DataFrame:
        """Present sums of the counted documents of ``ids`` (one column); the
        ledger is cut to them before it is grouped."""
        wanted = ids.toDF("_wanted").distinct()
        ledger = self._table("ledger", self.ledger_ddl)
        return (ledger.join(wanted, F.col("doc_id").eqNullSafe(F.col("_wanted")), "left_semi").groupBy("doc_id", *KEYS)
                .agg(F.sum("d_docs").alias("docs"), F.sum("d_tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0"))

    def commit(self, batch: str, inserts: DataFrame | None = None, deletes: DataFrame | None = None,
               revisions: DataFrame | None = None) -> bool:
        """Commit one batch; False if the id is committed already.

        ``inserts`` and ``revisions``: columns of ``count_tokens``; ``deletes``: doc_id.
        """
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError("a batch id has letters, digits, '_', '.' and '-'")
        if batch in self.committed():
            return False
        entries = self.spark.createDataFrame([], schema_of(self.ledger_ddl))
        if inserts is not None:
            entries = entries.unionByName(inserts.select(
                "doc_id", *KEYS, F.lit(1).cast("long").alias("d_docs"), F.col("n_tokens").alias("d_tokens")))
        if deletes is not None:
            entries = entries.unionByName(
                self._present(deletes.select("doc_id"))
                .select("doc_id", *KEYS, (-F.col("docs")).alias("d_docs"), (-F.col("tokens")).alias("d_tokens")))
        if revisions is not None:
            moved = [k for k in ("source", "lang") if k in revisions.columns]
            new = (revisions.groupBy(F.col("doc_id").alias("_id"), F.col("tokenizer").alias("_tok"))
                   .agg(F.max(F.struct("n_tokens", *moved)).alias("_new")))
            present = self._present(revisions.select("doc_id")).where("docs <> 0").join(
                new, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("tokenizer").eqNullSafe(F.col("_tok")))
            # a document counted several times keeps its multiplicity
            minus = F.struct("source", "lang", (-F.col("docs")).alias("d_docs"), (-F.col("tokens")).alias("d_tokens"))
            plus = F.struct(*[F.col(f"_new.{k}") if k in moved else F.col(k) for k in ("source", "lang")],
                            F.col("docs").alias("d_docs"), (F.col("_new.n_tokens") * F.col("docs")).alias("d_tokens"))
            entries = entries.unionByName(present.select("doc_id", "tokenizer", F.explode(F.array(minus, plus)).alias("e"))
                                          .select("doc_id", "e.source", "e.lang", "tokenizer", "e.d_docs", "e.d_tokens"))
        at = f"{self.path}/ledger/batch={batch}"
        entries.write.mode("overwrite").option("compression", "zstd").parquet(at)
        (self.spark.read.schema(schema_of(self.ledger_ddl)).parquet(at).groupBy(*KEYS)
         .agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
         .write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}"))
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens): sums of all committed deltas."""
        return (self._table("deltas", self.delta_ddl).groupBy(*KEYS)
                .agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
                .where("n_docs <> 0 OR n_tokens <> 0"))
