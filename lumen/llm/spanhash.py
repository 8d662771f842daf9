"""Document fingerprints from prefix polynomial hashes.

A text's fingerprint is its two modular prefix arrays H with
H[i] = sum of c[j] * B^j for j < i (mod p), for two primes of 31 bits.  The hash
of any span is a difference of two entries, so span equality takes constant
time (powers of B align the offsets) and the longest common extension of two
positions a binary search.  The string form of a fingerprint is the length and
the whole text's two hashes: equal texts have equal strings.

Likeness of two fingerprints (0 to 1, 1 for equal texts) is the larger of
* the share of the longer text covered by the longest common extension from the
  start and, beyond it, the one from the end;
* the Jaccard share of the 24-character spans, which also sees moved passages:
  of all spans of both texts, at every length.

``fingerprint_beside_next`` walks documents in descending id.  The rows are cut
into ranges of (id, text digest) at the bounds that a bounded sample gives, one
range a partition, so one id on many rows is cut as well; the first document of each range
is also sent to the range before, so every document meets its next one in a single shuffle of
the texts and each task streams its rows with two texts in memory.

Defined results: null text is empty; two empty texts are alike 1; rows of equal
id are ordered by the digest of their texts; null ids come last; a single document's
next one is itself; ids of any type that Spark sorts; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import schema_of
from lumen.operators.ordered import comes_before

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
SPAN = 24
SAMPLE = 32  # sampled rows a range
_POWERS: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """B^0 .. B^n for both moduli, grown by doubling and kept."""
    if not _POWERS:
        _POWERS.extend(np.ones(1, np.uint64) for _ in PRIMES)
    while _POWERS[0].size <= n:
        for k, (p, b) in enumerate(zip(PRIMES, BASES)):
            old = _POWERS[k]
            step = np.uint64(pow(b, old.size, p))
            _POWERS[k] = np.concatenate([old, old * step % np.uint64(p)])
    return [a[:n + 1] for a in _POWERS]


class Prefix:
    """The prefix arrays of one text."""

    def __init__(self, text: str):
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = code.size
        self.h = []
        for p, b in zip(PRIMES, powers(self.n)):
            h = np.zeros(self.n + 1, np.uint64)
            np.cumsum(code * b[:self.n] % np.uint64(p), out=h[1:])
            self.h.append(h % np.uint64(p))

    def __str__(self) -> str:
        return f"{self.n:x}-{int(self.h[0][-1]):08x}{int(self.h[1][-1]):08x}"

    def _raw(self, k: int, i: int, j: int) -> int:
        return (int(self.h[k][j]) - int(self.h[k][i])) % PRIMES[k]

    def equal(self, i: int, other: Prefix, j: int, length: int) -> bool:
        """Whether the spans of ``length`` at i here and at j in ``other`` are equal."""
        pw = powers(max(self.n, other.n))
        return all(self._raw(k, i, i + length) * int(pw[k][max(0, j - i)]) % p
                   == other._raw(k, j, j + length) * int(pw[k][max(0, i - j)]) % p for k, p in enumerate(PRIMES))

    def extension(self, i: int, other: Prefix, j: int) -> int:
        """Length of the longest common extension from i here and j in ``other``."""
        lo, hi = 0, min(self.n - i, other.n - j)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.equal(i, other, j, mid) else (lo, mid - 1)
        return lo

    def back_extension(self, i: int, other: Prefix, j: int, most: int) -> int:
        """Length, up to ``most``, of the longest common run ending at i here and j in ``other``."""
        lo, hi = 0, most
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.equal(i - mid, other, j - mid, mid) else (lo, mid - 1)
        return lo

    def _hashes(self) -> np.ndarray:
        """Position-free hashes of all spans, in order."""
        if not hasattr(self, "_all"):
            k = min(SPAN, self.n)
            at = np.arange(self.n - k + 1)
            norm = []
            for p, h in zip(PRIMES, self.h):
                p64 = np.uint64(p)
                raw = (h[k:] + p64 - h[:self.n - k + 1]) % p64
                # B^-i instead of B^(n-i): the same for every text
                norm.append(raw * _inverse(p, self.n)[at] % p64)
            self._all = (norm[0] << np.uint64(31)) | norm[1]
        return self._all

    def spans(self) -> np.ndarray:
        """Sorted distinct hashes of all spans."""
        if not hasattr(self, "_spans"):
            a = np.sort(self._hashes())
            self._spans = a[np.concatenate([[True], a[1:] != a[:-1]])]
        return self._spans


_INVERSES: dict[int, np.ndarray] = {}


def _inverse(p: int, n: int) -> np.ndarray:
    """B^0, B^-1 .. B^-n mod p, grown by doubling and kept."""
    a = _INVERSES.get(p, np.ones(1, np.uint64))
    inv = pow(BASES[PRIMES.index(p)], p - 2, p)
    while a.size <= n:
        a = np.concatenate([a, a * np.uint64(pow(inv, a.size, p)) % np.uint64(p)])
    _INVERSES[p] = a
    return a


def likeness(a: Prefix, b: Prefix) -> float:
    """0 to 1; 1 exactly for equal fingerprints."""
    if str(a) == str(b):
        return 1.0
    longest, shortest = max(a.n, b.n), min(a.n, b.n)
    front = a.extension(0, b, 0)
    back = a.back_extension(a.n, b, b.n, shortest - front)
    ends = (front + back) / longest
    x, y = a.spans(), b.spans()
    merged = np.sort(np.concatenate([x, y]))
    both = int((merged[1:] == merged[:-1]).sum())
    union = x.size + y.size - both
    return float(min(max(ends, both / union if union else 0.0), 1.0 - 1.0 / (longest + 1)))


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the following text's start."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


OUT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def fingerprint_beside_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_chars, the edited text's SHA-256, both fingerprints, and the
    likeness to the edited text and to the next document (descending id)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = base.withColumn("bucket", _range_of(base, parts, kind))
    # the first row of each range: at most one a partition
    place = F.struct(F.col("id").isNotNull().alias("named"), "id", F.bitwise_not("h").alias("rank"))
    tops = {r["bucket"]: (r["top"]["id"], ~r["top"]["rank"])
            for r in base.groupBy("bucket").agg(F.max(place).alias("top")).collect()}
    order = sorted(tops)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    row = F.struct("id", "h")
    first = F.element_at(F.array(*[_pair(*tops.get(b, (None, None)), kind) for b in range(parts)]), F.col("bucket") + 1)
    back = F.element_at(F.array(*[F.lit(before.get(b, 0)) for b in range(parts)]), F.col("bucket") + 1)
    home = F.struct(F.col("bucket").alias("b"), F.lit(0).alias("g"))
    sent = F.when(row.eqNullSafe(first), F.array(home, F.struct(back.alias("b"), F.lit(1).alias("g")))).otherwise(F.array(home))
    rows = (base.withColumn("s", F.explode(sent))
            .select("id", "text", F.col("s.b").alias("bucket"), F.col("s.g").alias("guest"), "h")
            .repartitionById(parts, "bucket")
            .sortWithinPartitions("bucket", "guest", F.col("id").desc_nulls_last(), "h", "text").drop("h"))
    schema = schema_of(f"`{id_col}` {kind}, {OUT}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        want = to_arrow_schema(schema)
        held, bucket, out = None, None, []

        def result(now, nxt):
            i, text, own = now
            _, next_text, next_own = nxt
            new = edited(text, next_text)
            new_own = Prefix(new)
            return (i, own.n, hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), str(own), str(new_own),
                    likeness(own, new_own), likeness(own, next_own))

        for batch in batches:
            for i, text, b, guest in zip(*[c.to_pylist() for c in batch.columns]):
                if b != bucket:
                    bucket, held = b, None
                if guest and held is None:
                    continue
                text = text or ""
                here = (i, text, Prefix(text))
                if held is not None:
                    out.append(result(held, here))
                held = None if guest else here
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), want)], schema=want)
                out = []
        gc.collect()  # a reused worker else keeps the arrays of earlier tasks for long

    return rows.mapInArrow(run, schema)


def _pair(i, h, kind: str):
    return F.struct(F.lit(i).cast(kind).alias("id"), F.lit(h).cast("long").alias("h"))


def _range_of(base: DataFrame, parts: int, kind: str):
    """Number of the range of each row, 0 to ``parts`` - 1, in descending order of id.

    Bounds are every ``SAMPLE``-th of about ``SAMPLE`` x ``parts`` rows, those whose
    hash lies below a limit.  They sit in a two-level array, so a row compares
    with about 2 x sqrt(parts) of them.
    """
    share = min(1.0, SAMPLE * parts / max(1, base.count()))
    drawn = F.pmod(F.xxhash64("h", "id"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    keys = [("id", False), ("h", True)]
    sample = base.where(drawn).select("id", "h").distinct().orderBy(F.col("id").desc_nulls_last(), "h").collect()
    every = max(SAMPLE, -(-len(sample) // parts))
    bounds = [(r["id"], r["h"]) for r in sample[every::every]][:parts - 1]
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]

    def key(i, h):
        return F.struct(F.lit(i).cast(kind).alias("k0"), F.lit(h).alias("k1"))

    def passed(array):
        return F.size(F.filter(array, lambda b: comes_before(b, keys)))

    g = passed(F.array(*[key(*x[-1]) for x in groups]))  # groups wholly before the row
    fine = F.array(*[F.array(*[key(*x) for x in part]) for part in groups])
    place = g * step + F.coalesce(F.when(g < len(groups), passed(F.get(fine, g))), F.lit(0))
    return F.least(place, F.lit(len(bounds))).cast("int")  # the last group may be shorter
