"""Near-duplicate classes by BagMinHash.

A document is the multiset of its five-word shingles (words: runs of
non-white-space; fewer than five words make one shingle).  Documents are linked
when the weighted Jaccard likeness of their multisets (sum of minima over sum of
maxima of the counts) is at least ``THRESHOLD``; classes are the connected
components of the links.

Signatures.  Each shingle's weight axis is cut into dyadic ranges (0,1], (1,2],
(2,4], (4,8] ...  A range is a Poisson process seeded by shingle and range whose
points carry a signature component and a level within the range; a point counts
for a document when its level is at most the shingle's count there.  Each
component keeps its smallest point, and a process stops when its next point lies
beyond the largest component, so most shingles cost one or two points.  Equal
components have the probability of the weighted Jaccard likeness.

Candidates and verification.  Equal word sequences are one text.  Signatures are
cut into ``BANDS`` bands of ``ROWS`` (a pair at 0.8 is missed with probability
0.0007).  In each bucket the text that is in the largest buckets overall stands
for the bucket: all others are verified against it, with exact counts of the
whole texts.  What that leaves unlinked in a bucket is compared across classes
inside tasks (in blocks): by signature first, and pairs whose estimate is at
least ``ESTIMATE`` (three standard deviations under the threshold) exactly.  So a group of copies costs one comparison a member, and no
link between different texts is given up because a bucket is large.

Classes spread over the links by rounds of smallest-neighbour labels with
pointer jumping, each round a written table.

Every row has a number of its own while it is worked on (``rid``, fixed by
writing the rows once), so rows with a null id and rows that share an id are
compared, linked and dropped like all others.

Defined results: null text is empty; texts without words are one class of exact
copies; the class id is the smallest id of the class, null if no row has one; of
each class one row is kept, that of the smallest id (null last; of repeated rows
any one); very long texts are compared whole; an empty table gives an empty
result; extra columns are ignored by ``near_duplicate_classes`` and stay, whatever
their names, in ``drop_near_duplicates``.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, hint_small, schema_of, texts_of, write_once
from lumen.operators.ordered import free_prefix

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 6
SIZE = BANDS * ROWS
ESTIMATE = 0.70
BLOCK = 1500
CHUNK_CHARS = 1_000_000
VOCABULARY = 200_000  # word hashes that a task keeps

_U = np.uint64
_WORDS: dict[str, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), by element."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hashes(words: list[str]) -> np.ndarray:
    if len(_WORDS) > VOCABULARY:
        _WORDS.clear()
    for w in set(words).difference(_WORDS):
        _WORDS[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def bag(words: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and their counts."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = _word_hashes(words)
    k = min(width, h.size)
    acc = mix(h[:h.size - k + 1] ^ _U(k))
    for j in range(1, k):
        acc = mix(acc * _U(31) + h[j:h.size - k + 1 + j])
    return np.unique(acc, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int = SIZE) -> np.ndarray:
    """BagMinHash signatures (documents x components) as float64 points; a document
    without shingles has infinite ones."""
    sig = np.full(len(bags) * size, np.inf)
    doc = np.repeat(np.arange(len(bags)), [b[0].size for b in bags])
    if not doc.size:
        return sig.reshape(len(bags), size)
    elem, count = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]).astype(np.uint64)
    keys, docs, counts, lows, widths = [], [], [], [], []
    low, width, k = 0, 1, 0
    while True:  # the dyadic ranges that some count reaches
        at = count > _U(low)
        if not at.any():
            break
        keys.append(mix(elem[at] ^ _U(0x5851F42D4C957F2D * (k + 1) & 0xFFFFFFFFFFFFFFFF)))
        docs.append(doc[at])
        counts.append(count[at])
        lows.append(np.full(at.sum(), low, np.uint64))
        widths.append(np.full(at.sum(), width, np.uint64))
        low, width, k = low + width, width if k == 0 else width * 2, k + 1
    key, doc, count, low, width = map(np.concatenate, (keys, docs, counts, lows, widths))
    x, bound, step = np.zeros(key.size), np.full(len(bags), np.inf), 0
    while key.size:
        r = mix(key + _U(2 * step + 1))
        x = x - np.log(((r >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / (width * float(size))
        live = x < bound[doc]
        if not live.all():
            key, doc, count, low, width, x = (a[live] for a in (key, doc, count, low, width, x))
        r = mix(key ^ mix(key + _U(2 * step + 2)))
        part = ((r >> _U(32)) * _U(size)) >> _U(32)
        level = low + (((r & _U(0xFFFFFFFF)) * width) >> _U(32))
        ok = level < count
        np.minimum.at(sig, doc[ok] * size + part[ok].astype(np.int64), x[ok])
        bound = sig.reshape(len(bags), size).max(axis=1)
        step += 1
    return sig.reshape(len(bags), size)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """(sum of minima, sum of maxima) of two multisets' counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared, int(a[1].sum() + b[1].sum()) - shared


def text_key(words: list[str]) -> bytes:
    """128-bit digest of a word sequence."""
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def signed(base: DataFrame) -> DataFrame:
    """(id, rid, h, sig, bands): text digest, 16 bits of each component, band hashes
    (null for texts without words) of every row of ``base`` (id, rid, text)."""
    kind = base.schema["id"].dataType.simpleString()

    def run(cols):
        out = {"h": [], "sig": [], "bands": []}
        words, held = [], 0

        def flush():
            nonlocal held
            bits = signatures([bag(w) for w in words]).view(np.uint64)
            short = (mix(bits) >> _U(48)).astype(np.uint16)
            acc = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(words), 1))
            rows = bits.reshape(len(words), BANDS, ROWS)
            for j in range(ROWS):
                acc = mix(acc * _U(31) ^ rows[:, :, j])
            for w, s, b in zip(words, short, acc.view(np.int64)):
                out["h"].append(text_key(w))
                out["sig"].append(s.tobytes())
                out["bands"].append(b.tolist() if w else None)
            words.clear()
            held = 0

        for t in texts_of(cols["text"]):
            words.append(t.split())
            held += len(t)
            if held > CHUNK_CHARS or len(words) >= 512:
                flush()
        if words:
            flush()
        _WORDS.clear()
        return out | {"id": cols["id"], "rid": cols["rid"]}

    return arrow_map(base.select("id", "rid", "text"), run,
                     schema_of(f"id {kind}, rid long, h binary, sig binary, bands array<long>"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose exact weighted Jaccard reaches the threshold."""
    left = texts.select(F.col("h").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("h").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def run(cols):
        last, out = (None, None), {"a": [], "b": []}
        for a, b, ta, tb in zip(*[cols[n].to_pylist() for n in ("a", "b", "ta", "tb")]):
            if last[0] != b:  # rows arrive sorted by b
                last = (b, bag((tb or "").split()))
            least, most = overlap(bag((ta or "").split()), last[1])
            if least >= THRESHOLD * most:
                out["a"].append(a)
                out["b"].append(b)
        _WORDS.clear()
        return out

    return arrow_map(both, run, schema_of("a binary, b binary"))


def components(links: DataFrame, labels: DataFrame | None = None, tag: str = "labels") -> DataFrame:
    """(h, label): the smallest ``h`` of the component of every text with a link.
    ``links`` (a, b) is a written table; ``labels`` are those of an earlier call
    whose links are part of ``links``."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("h"), F.least("a", "m").alias("label"))
    if labels is not None:
        now = now.join(labels.withColumnRenamed("label", "old"), "h", "left").select(
            "h", F.least("label", F.coalesce("old", "label")).alias("label"))
    now = write_once(now, tag)
    while True:
        near = (both.join(now.select(F.col("h").alias("b"), F.col("label").alias("l")), "b")
                .groupBy(F.col("a").alias("h")).agg(F.min("l").alias("l")))
        spread = now.join(near, "h").select("h", F.col("label").alias("was"), F.least("label", "l").alias("label"))
        jump = now.select(F.col("h").alias("label"), F.col("label").alias("root"))
        after = write_once(spread.join(jump, "label", "left").select(
            "h", "was", F.least("label", F.coalesce("root", "label")).alias("label")), tag)
        changed = after.where("was <> label").limit(1).count()
        now = after.select("h", "label")
        if not changed:
            return now


def _leftover_links(members: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links between texts of one bucket that are in different classes,
    neither of them the bucket's representative.

    Tasks compare the signatures of a bucket (in blocks of about ``BLOCK``) and
    verify exactly each pair that agrees on ``ESTIMATE`` or more.  A link that
    joins two classes makes further pairs of the two needless, so a task emits
    fewer links than its buckets have texts.
    """
    rest = (members.where("h <> rep").join(labels, "h", "left")
            .withColumn("label", F.coalesce("label", "h")))
    split = (rest.groupBy("band", "key").agg(F.count(F.lit(1)).alias("m"), F.min("label").alias("lo"),
                                             F.max("label").alias("hi")).where("lo <> hi")
             .select("band", "key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    rows = (rest.join(split, ["band", "key"]).join(nodes.select("h", "sig"), "h").join(texts, "h")
            .withColumn("own", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("band", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                    "own", "h", "label", "sig", "text")
            .repartition("band", "key", "p", "q").sortWithinPartitions("band", "key", "p", "q"))

    def compare(group):
        sig = np.frombuffer(b"".join(g[7] for g in group), np.uint16).reshape(len(group), SIZE)
        own = np.array([g[4] for g in group])
        _, label = np.unique(np.array([g[6].hex() for g in group]), return_inverse=True)
        p, q = group[0][2], group[0][3]
        bags: dict[int, tuple] = {}

        def bag_of(i):
            if i not in bags:
                bags[i] = bag(group[i][8].split())
            return bags[i]

        for i in np.flatnonzero(own == p).tolist():
            other = (label != label[i]) & ((own == q) if p != q else (np.arange(len(group)) > i))
            at = np.flatnonzero(other)
            for j in at[(sig[at] == sig[i]).sum(axis=1) >= ESTIMATE * SIZE].tolist():
                if label[j] == label[i]:
                    continue
                least, most = overlap(bag_of(i), bag_of(j))
                if least >= THRESHOLD * most:
                    label[label == label[j]] = label[i]
                    yield group[i][5], group[j][5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, found = [], []

        def close():
            if len(group) > 1:
                found.extend(compare(group))
            group.clear()

        def links():
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.binary()) for k in (0, 1)],
                                             names=["a", "b"])
            found.clear()
            return out

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if group and group[0][:4] != row[:4]:
                    close()
                group.append(row)
            yield links()
        close()
        yield links()
        _WORDS.clear()
        gc.collect()

    return rows.mapInArrow(run, schema_of("a binary, b binary"))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``class_id`` (the smallest id of its class), ``h`` (the
    digest of its word sequence) and ``kept`` (true for one row of each class)."""
    base = write_once(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                  F.monotonically_increasing_id().alias("rid")), "rows")
    return _classes(base).select(F.col("id").alias(id_col), "class_id", "h", "kept")


def _classes(base: DataFrame) -> DataFrame:
    """(id, rid, class_id, h, kept) of every row of the written table ``base`` (id, rid, text)."""
    rows = write_once(signed(base), "signed")
    head = F.struct(F.col("id").isNull().alias("unnamed"), "id", "rid")
    nodes = write_once(rows.groupBy("h").agg(F.min("id").alias("rep"), F.min(head).alias("head"), F.first("sig").alias("sig"),
                                             F.first("bands").alias("bands")), "texts")
    flat = nodes.where("bands IS NOT NULL").select("h", F.posexplode("bands").alias("band", "key"))
    sizes = flat.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = write_once(flat.join(sizes, ["band", "key"]), "members")
    weight = members.groupBy("h").agg(F.sum("n").alias("w"))
    reps = (members.join(weight, "h").groupBy("band", "key")
            .agg(F.max(F.struct("w", "h"))["h"].alias("rep")))
    members = write_once(members.join(reps, ["band", "key"]), "stars")

    stars = members.where("h <> rep").select(F.col("h").alias("a"), F.col("rep").alias("b")).distinct()
    wanted = hint_small(write_once(members.select("h").distinct().join(nodes.select("h", "head.rid"), "h"), "wanted"))
    texts = write_once(base.select("rid", "text").join(wanted, "rid").select("h", "text"), "bodies")  # each text once
    links = write_once(_verified(stars, texts), "links")
    labels = components(links)
    more = write_once(_leftover_links(members, labels, nodes, texts), "leftover")
    if more.limit(1).count():
        labels = components(write_once(links.unionByName(more), "links"), labels)
    named = nodes.select("h", "rep", "head").join(labels, "h", "left").withColumn("label", F.coalesce("label", "h"))
    named = write_once(named, "named")
    heads = named.groupBy("label").agg(F.min("rep").alias("class_id"), F.min("head").alias("first"))
    classes = write_once(named.join(heads, "label").select("h", "class_id", F.col("first.rid").alias("kept_rid")), "classes")
    return rows.select("id", "rid", "h").join(classes, "h").select(
        "id", "rid", "class_id", "h", (F.col("rid") == F.col("kept_rid")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one of the smallest id (null last;
    of repeated rows one stays).  All columns stay."""
    p = free_prefix(docs.columns)
    base = write_once(docs.withColumn(f"{p}rid", F.monotonically_increasing_id()), "rows")
    found = _classes(base.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(f"{p}rid").alias("rid")))
    gone = write_once(found.where("NOT kept").select(F.col("rid").alias(f"{p}gone")), "gone")
    return base.join(hint_small(gone), F.col(f"{p}rid") == F.col(f"{p}gone"), "left_anti").select(*docs.columns)
