"""Hard negatives by an inverted multi-index.

Vectors are cut into two halves, each with its own codebook (k-means on a
bounded sample); a row lies in the cell (i, j) of its two nearest codewords.
For an anchor a, no row of codeword i can score more than <a1, c_i> + |a1| r_i
in the first half (r_i: largest distance of a row of i from c_i), and likewise
in the second, so the sum bounds the scores of a cell.  A multi-sequence heap
visits the cells by falling bound.  Four passes are always enough:

1. the first cells, until they hold ``SEED_ROWS`` rows: the scores found give a
   lower bound of the last positive's score;
2. all further cells whose bound reaches it: the positives are certain;
3. and 4. the same for the negatives in every positive's window.

What a pass leaves out cannot enter the result, so results are exact whatever
the codebooks are (their quality only decides how many cells are visited).

In Spark a pass is one co-group: visits carry the cells wanted of one first
codeword, rows are grouped by first codeword, and both sides are dealt in
blocks of bounded size.  A task multiplies block by block and returns at most a
few rows an anchor.  Anchors with equal vector and label are searched once;
of equal rows with equal labels only the smallest ids, as many as can appear,
are indexed.

Scores are integer inner products of floor(``SCALE`` * x).

Defined results: rows with a null id, label or vector, a null or non-finite
component, or a scaled norm of 2**24 or more take no part; a shorter vector
counts as padded with zeros; a repeated id counts as a further row; ties go to
the smaller id; an anchor without positives, or a positive without negatives,
gives no row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, schema_of, write_once

SCALE = 256
SAMPLE_ROWS = 20_000  # of the index, to fit the codebooks
MAX_CODEWORDS = 256  # of a half
ROWS_PER_CELL = 64
SEED_ROWS = 2_048
BLOCK = 8_192  # rows, and anchors, that one group of a pass holds
LOW, HIGH = 50, 95  # percent of the positive's score


def fit_codebook(x: np.ndarray, k: int, steps: int = 8) -> np.ndarray:
    """``k`` (at most) means of the rows by Lloyd's steps from the first distinct rows."""
    c = np.unique(x, axis=0)
    c = c[np.linspace(0, len(c) - 1, min(k, len(c))).astype(int)].copy()
    for _ in range(steps):
        at = nearest(x, c)[0]
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each row and the distance to it."""
    at = np.argmin((c * c).sum(1)[None, :] - 2 * x @ c.T, axis=1)
    return at, np.sqrt(((x - c[at]) ** 2).sum(1))


def multi_sequence(first: np.ndarray, second: np.ndarray):
    """(bound, i, j) of all pairs by falling sum, each next one from a heap."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    f, s = first.tolist(), second.tolist()
    if not a or not b:
        return
    heap = [(-(f[a[0]] + s[b[0]]), 0, 0)]
    while heap:
        bound, p, q = heapq.heappop(heap)
        yield -bound, a[p], b[q]
        if q + 1 < len(b):
            heapq.heappush(heap, (-(f[a[p]] + s[b[q + 1]]), p, q + 1))
        if q == 0 and p + 1 < len(a):
            heapq.heappush(heap, (-(f[a[p + 1]] + s[b[0]]), p + 1, 0))


class MultiIndex:
    """Codebooks, radii and cell sizes (all bounded by the number of codewords)."""

    def __init__(self, books, radii, sizes, dim):
        self.books, self.radii, self.sizes, self.dim = books, radii, sizes, dim

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = (self.dim + 1) // 2
        return x[:, :cut], x[:, cut:]

    def bounds(self, x: np.ndarray) -> list[np.ndarray]:
        """Per half: anchors by codewords, the most that a row of the codeword can score."""
        out = []
        for h, c, r in zip(self.halves(x), self.books, self.radii):
            b = h @ c.T + np.linalg.norm(h, axis=1)[:, None] * r[None, :]
            out.append(b + 1e-9 * np.abs(b) + 1e-6)  # above rounding errors
        return out

    def visits(self, first: np.ndarray, second: np.ndarray, floor: float | None) -> dict[int, list[int]]:
        """Cells to visit as {i: [j, ...]}: the seed cells (``floor`` None), or those
        after them down to a bound of ``floor``."""
        out: dict[int, list[int]] = {}
        seen = 0
        for bound, i, j in multi_sequence(first, second):
            if floor is None and seen >= SEED_ROWS or floor is not None and bound < floor:
                break
            if self.sizes[i, j]:
                if floor is None or seen >= SEED_ROWS:
                    out.setdefault(i, []).append(j)
                seen += self.sizes[i, j]
        return out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of integers, zeros after the end of a shorter one."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy())
    if len(flat) == len(column) * dim and (size == dim).all():
        return flat.reshape(-1, dim).astype(np.float64)
    out = np.zeros((len(column), dim))
    out[np.arange(dim)[None, :] < size[:, None]] = flat
    return out


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    most = math.sqrt((a * a).sum(1).max(initial=0) * (x * x).sum(1).max(initial=0))
    kind = np.float32 if most < 1 << 24 else np.float64  # sums below the mantissa are exact
    return (a.astype(kind) @ x.T.astype(kind)).astype(np.int64)


NONE = np.iinfo(np.int64).min


def best(score: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``n`` best allowed scores of each row; columns are in
    the order that breaks ties."""
    m, width = score.shape
    key = np.where(allowed, score * width + np.arange(width - 1, -1, -1), NONE)
    if width > n:
        at = np.argpartition(key, width - n, axis=1)[:, width - n:]
    else:
        at = np.broadcast_to(np.arange(width), (m, width))
    row = np.broadcast_to(np.arange(m)[:, None], at.shape)
    ok = key[row, at] != NONE
    return row[ok], at[ok]


def combined(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name).combine_chunks()
    return c.chunk(0) if isinstance(c, pa.ChunkedArray) else c


def positives_in(visits: pa.Table, rows: pa.Table, dim: int, k: int) -> dict:
    """The best ``k`` rows of the anchor's label in the wanted cells."""
    label, lab = np.array(combined(visits, "label")), np.array(combined(rows, "label"))
    a, x = matrix(combined(visits, "q"), dim), matrix(combined(rows, "q"), dim)
    wanted, j, ids = wanted_cells(visits), np.array(combined(rows, "j")), np.array(combined(rows, "id"))
    found: list[tuple] = []
    for one in np.unique(label):
        p, r = np.flatnonzero(label == one), np.flatnonzero(lab == one)
        for s in range(0, len(p), 1024) if len(r) else ():
            part = p[s:s + 1024]
            score = products(a[part], x[r])
            row, at = best(score, wanted[part][:, j[r]], k)
            found.append((part[row], ids[r[at]], score[row, at]))
    v, i, sc = (np.concatenate([f[n] for f in found]) if found else np.zeros(0, np.int64) for n in range(3))
    return {"cid": combined(visits, "cid").take(pa.array(v)), "id": i, "score": sc}


def negatives_in(visits: pa.Table, rows: pa.Table, dim: int, k: int) -> dict:
    """The best ``k`` rows of other labels in each window of the anchor."""
    label, lab = np.array(combined(visits, "label")), np.array(combined(rows, "label"))
    a, x = matrix(combined(visits, "q"), dim), matrix(combined(rows, "q"), dim)
    wanted, j, ids = wanted_cells(visits), np.array(combined(rows, "j")), np.array(combined(rows, "id"))
    windows = [np.array(w, np.int64).reshape(-1, 2) for w in combined(visits, "windows").to_pylist()]
    depth = max(map(len, windows), default=0)
    low = np.full((len(windows), depth), 1, np.int64)
    high = np.zeros((len(windows), depth), np.int64)  # low > high: no window
    for n, w in enumerate(windows):
        low[n, :len(w)], high[n, :len(w)] = w[:, 0], w[:, 1]
    found: list[tuple] = []
    for s in range(0, len(a), 512):
        part = np.arange(s, min(s + 512, len(a)))
        score = products(a[part], x)
        other = wanted[part][:, j] & (label[part][:, None] != lab[None, :])
        for d in range(depth):
            inside = other & (score >= low[part, d][:, None]) & (score <= high[part, d][:, None])
            row, at = best(score, inside, k)
            found.append((part[row], np.full(len(row), d), ids[at], score[row, at]))
    v, d, i, sc = (np.concatenate([f[n] for f in found]) if found else np.zeros(0, np.int64) for n in range(4))
    return {"cid": combined(visits, "cid").take(pa.array(v)), "window": d, "id": i, "score": sc}


def wanted_cells(visits: pa.Table) -> np.ndarray:
    """Anchors by second codeword: whether the cell is to be visited."""
    cells = combined(visits, "js")
    size, flat = np.diff(cells.offsets.to_numpy()), np.array(cells.flatten())
    out = np.zeros((len(size), MAX_CODEWORDS), bool)
    out[np.repeat(np.arange(len(size)), size), flat] = True
    return out


def _search(index: DataFrame, wanted: DataFrame, multi: MultiIndex, anchors: int, fn, keys: list[str], k: int) -> DataFrame:
    """One pass: the best ``k`` rows by ``keys`` among the wanted cells."""
    dim = multi.dim
    row_blocks = F.lit([max(1, -(-int(n) // BLOCK)) for n in multi.sizes.sum(1)])
    visit_blocks = max(1, -(-anchors // BLOCK))
    rows = index.select("id", "label", "q", "i", "j", F.pmod(F.xxhash64("id"), row_blocks[F.col("i")]).alias("rb"),
                        F.explode(F.sequence(F.lit(0), F.lit(visit_blocks - 1))).alias("vb"))
    visits = wanted.withColumns({
        "vb": F.pmod(F.xxhash64("cid"), F.lit(visit_blocks)).cast("int"),
        "rb": F.explode(F.sequence(F.lit(0), row_blocks[F.col("i")] - 1))})
    schema = schema_of("cid string, " + "window int, " * ("window" in keys) + "id long, score long")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        want = to_arrow_schema(schema)
        if not left.num_rows or not right.num_rows:
            return want.empty_table()
        right = right.sort_by("id")  # ties go to the smaller id
        got = fn(left, right, dim, k)
        return pa.table([pa.array(got[f.name], f.type) if not isinstance(got[f.name], pa.Array) else got[f.name].cast(f.type)
                         for f in want], schema=want)

    by = [F.col("i").cast("int"), F.col("rb").cast("long"), F.col("vb").cast("int")]
    return best_rows(visits.groupBy(*by).cogroup(rows.groupBy(*by)).applyInArrow(run, schema), keys, k)


def best_rows(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _visits(classes: DataFrame, multi: MultiIndex, seed: bool, extra: str = "") -> DataFrame:
    """Rows (cid, label, q, i, js): the cells that each class wants of codeword i.
    ``classes`` has ``floor`` (null: nothing more is wanted) where not ``seed``."""
    schema = schema_of(f"cid string, label long, q array<int>, i int, js array<int>{extra}")

    def run(cols):
        x = matrix(cols["q"], multi.dim)
        first, second = multi.bounds(x)
        floors = [None] * len(x) if seed else cols["floor"].to_pylist()
        at, i, js = [], [], []
        for n, floor in enumerate(floors):
            if seed or floor is not None:
                for c, cells in multi.visits(first[n], second[n], None if seed else floor).items():
                    at.append(n), i.append(c), js.append(cells)
        take = pa.array(at, pa.int64())
        return {c: cols[c].take(take) for c in cols if c in schema.fieldNames()} | {"i": i, "js": js}

    return arrow_map(classes, run, schema)


def build_index(rows: DataFrame) -> tuple[DataFrame, MultiIndex]:
    """``rows`` (id, label, q) with their cell (i, j), and the index over them."""
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("q")), F.lit(0)).alias("dim")).first()
    n, dim = facts["n"], max(1, facts["dim"])
    share = min(1.0, SAMPLE_ROWS / max(1, n))
    picked = rows.where(F.pmod(F.xxhash64("q", "label"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    sample = picked.select("q").toArrow().column("q").combine_chunks()
    if isinstance(sample, pa.ChunkedArray):
        sample = sample.chunk(0) if sample.num_chunks else pa.array([], pa.list_(pa.int32()))
    k = max(1, min(MAX_CODEWORDS, math.isqrt(n // ROWS_PER_CELL)))
    multi = MultiIndex(None, None, None, dim)
    x = matrix(sample, dim)
    multi.books = [fit_codebook(h, k) if len(h) else np.zeros((1, h.shape[1])) for h in multi.halves(x)]

    def run(cols):
        (i, far1), (j, far2) = (nearest(h, c) for h, c in zip(multi.halves(matrix(cols["q"], dim)), multi.books))
        return {"id": cols["id"], "label": cols["label"], "q": cols["q"], "i": i, "j": j, "far1": far1, "far2": far2}

    index = write_once(arrow_map(rows, run, schema_of(
        "id long, label long, q array<int>, i int, j int, far1 double, far2 double")), "multi-index")
    cells = index.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.max("far1").alias("r1"),
                                        F.max("far2").alias("r2")).collect()  # at most MAX_CODEWORDS ** 2
    multi.sizes = np.zeros(tuple(len(c) for c in multi.books), np.int64)
    multi.radii = [np.zeros(len(c)) for c in multi.books]
    for c in cells:
        multi.sizes[c["i"], c["j"]] = c["n"]
        multi.radii[0][c["i"]] = max(multi.radii[0][c["i"]], c["r1"])
        multi.radii[1][c["j"]] = max(multi.radii[1][c["j"]], c["r2"])
    return index, multi


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", positives: int = 5, negatives: int = 3) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for
    the rows of ``vectors`` where ``anchors`` holds: the anchor's first ``positives``
    other rows of its label, and for each the first ``negatives`` rows of other labels
    that score from ``LOW`` to ``HIGH`` percent of the positive's score."""
    v = F.col(vector_col)
    scaled = F.transform(v, lambda e: F.floor(F.lit(SCALE) * e.cast("double")).cast("double"))
    norm = F.aggregate(scaled, F.lit(0.0), lambda s, e: s + e * e)
    ok = (F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull()
          & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < 1 << 24)))
    valid = (vectors.where(ok).where(norm < float(1 << 48))
             .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                     F.transform(scaled, lambda e: e.cast("int")).alias("q"),
                     F.coalesce(anchors, F.lit(False)).alias("anchor")))
    valid = write_once(valid.withColumn("cid", F.sha2(F.concat_ws(",", F.col("q").cast("array<string>"), F.lit("|"), "label"), 256)), "vectors")

    copies = Window.partitionBy("cid").orderBy("id")  # a partial limit runs before the shuffle
    rows = (valid.select("id", "label", "q", "cid").withColumn("copy", F.row_number().over(copies))
            .where(F.col("copy") <= max(positives + 1, negatives)).select("id", "label", "q"))
    index, multi = build_index(rows)

    asked = valid.where("anchor").select("id", "cid")
    classes = write_once(valid.where("anchor").groupBy("cid").agg(F.first("label").alias("label"), F.first("q").alias("q")), "classes")
    n = classes.count()
    k = positives + 1  # one may be the anchor itself

    seed = _search(index, _visits(classes, multi, True), multi, n, positives_in, ["cid"], k)
    seed = write_once(seed, "positives-seed")
    reached = seed.where(F.col("place") == k).select("cid", F.col("score").cast("double").alias("floor"))
    further = classes.join(reached, "cid", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    more = _search(index, _visits(further, multi, False), multi, n, positives_in, ["cid"], k)
    found = write_once(best_rows(seed.drop("place").unionByName(more.drop("place")), ["cid"], k), "positives")

    # LOW * p <= 100 * n <= HIGH * p in whole numbers; null where nothing can satisfy it
    low = F.expr(f"-((-score * {LOW} - pmod(-score * {LOW}, 100)) div 100)")
    high = F.expr(f"(score * {HIGH} - pmod(score * {HIGH}, 100)) div 100")
    spans = found.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("place", low.alias("low"), high.alias("high")))).alias("w"))
    wide = write_once(classes.join(spans, "cid").withColumn(
        "windows", F.transform("w", lambda s: F.array(s["low"], s["high"]))).drop("w"), "windows")
    keys = ["cid", "window"]
    seed = write_once(_search(index, _visits(wide, multi, True, ", windows array<array<long>>"), multi, n, negatives_in,
                              keys, negatives), "negatives-seed")
    reached = (seed.where(F.col("place") == negatives)
               .groupBy("cid").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("third")))
    third = lambda d, w: F.coalesce(F.try_element_at("third", d), w[0])
    floors = F.transform("windows", lambda w, d: F.when(w[0] <= w[1], third(d, w)))
    further = wide.join(reached, "cid", "left").withColumn("floor", F.array_min(floors).cast("double")).drop("third")
    more = _search(index, _visits(further, multi, False, ", windows array<array<long>>"), multi, n, negatives_in, keys, negatives)
    lost = best_rows(seed.drop("place").unionByName(more.drop("place")), keys, negatives)

    per_window = lost.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("negs"))
    pos = found.select("cid", (F.col("place") - 1).alias("window"), F.col("id").alias("pid"), F.col("score").alias("pscore"))
    per_class = (pos.join(per_window, keys, "left").groupBy("cid")
                 .agg(F.sort_array(F.collect_list(F.struct("window", "pid", "pscore", "negs"))).alias("all")))
    chosen = asked.join(per_class, "cid").select(
        F.col("id").alias("anchor_id"),
        F.explode(F.slice(F.filter("all", lambda s: s["pid"] != F.col("id")), 1, positives)).alias("s"))
    return chosen.select("anchor_id", F.col("s.pid").alias("positive_id"), F.col("s.pscore").alias("positive_score"),
                         F.explode("s.negs").alias("n")).select(
        "anchor_id", "positive_id", F.col("n.place").cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        "positive_score", F.col("n.score").alias("negative_score"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """The labels of every seventh row moved on, as the mining task defines them."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""
