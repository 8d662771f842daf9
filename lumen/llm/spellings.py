"""Spelling variants: words one edit apart, found by blocked Gram matrices.

A word is a vector of letter counts.  One replaced letter changes two counts by
one (squared distance 2), one inserted or deleted letter changes one count
(squared distance 1), so pairs one edit apart lie at most 2 apart, in the same
or the next length.  |x|^2 + |y|^2 - 2 <x, y> gives the distances of all words
of two blocks by one matrix product.

Blocks are words of one length with the same sums of counts over ``groups`` of
letters (the most frequent letters alone, all others together).  An edit moves
at most one unit from one group to another, so a block meets only blocks that
differ so; each such pair of blocks meets once.  The number of groups follows
the number of words, so that blocks stay small; a block of more than ``CHUNK``
characters is cut, and its parts meet part by part.  The candidates of a product
are checked letter by letter, and a task returns sums for its words, never pairs.

A word's form is its most frequent near word, if that is ``FACTOR`` times as
frequent; roots follow forms by pointer doubling (a form is ten times as
frequent as its word, so five doublings reach the end of any chain).

Defined results: null texts have no words; empty texts neither; ties between
forms go to the first in code point order; repeated rows count each; a null id
counts as the text "None" in the deletion rule of ``noisy_words``; very long texts
and words are taken whole; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, schema_of, write_once

SHORTEST = 7
LEAST = 2
FACTOR = 10
DELETED = 31
CHUNK = 32_768  # characters of the words that one side of a product holds
FLUSH = 300_000
TOP = (1 << 6) - 1  # sums and lengths beyond their bits fall together, which only makes a block larger
TOP_LENGTH = (1 << 8) - 1

_LOWER = {c: c + 32 for c in range(65, 91)}


def runs_of(text: str, shortest: int) -> list[str]:
    """Maximal runs of letters with at least ``shortest`` code points, A-Z lower-cased."""
    found = re.findall("[A-Za-zÀ-ÿ]{%d,}" % max(1, shortest), text)
    return [w if w.islower() else w.translate(_LOWER) for w in found]


def spelled(doc_id, run: str) -> str:
    """The run as the noisy corpus spells it: of one in ``DELETED``, a code point is missing."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DELETED == 0:
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return run


def noisy_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
                least: int = LEAST) -> DataFrame:
    """(word, n): the words of all texts, in the noisy spelling, with at least
    ``shortest`` code points and ``least`` occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())],
                                               names=["word", "n"])
            sums.clear()
            return batch

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w, n in Counter(runs_of(text, shortest)).items():
                    w = spelled(doc_id, w)
                    if len(w) >= shortest:
                        sums[w] += n
                if len(sums) > FLUSH:
                    yield out()
        yield out()

    texts = docs.select(F.col(id_col).cast("string"), F.col(text_col)).where(F.col(text_col).isNotNull())
    return (texts.mapInArrow(run, schema_of("word string, n long"))
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def letter_groups(words: DataFrame) -> list[str]:
    """The letters that are a group of their own, the rarest first.  Their number
    follows the number of words; nine fit a block's key."""
    def run(batches):
        sums: Counter = Counter()
        n = 0
        for b in batches:
            for w in b.column(0).to_pylist():
                sums.update(w)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([*sums, ""], pa.string()), pa.array([*sums.values(), n], pa.int64())],
                                         names=["letter", "n"])

    got = {r["letter"]: r["n"] for r in words.select("word").mapInArrow(run, schema_of("letter string, n long"))
           .groupBy("letter").agg(F.sum("n").alias("n")).collect()}  # one row a letter
    n = got.pop("", 0)
    wanted = min(9, max(1, math.ceil(math.log2(max(1, n)) - 9)))
    # a word visits a block for each group it has and each later one: common letters come last
    return sorted(got, key=lambda c: (-got[c], c))[:wanted][::-1]


def keys_of(words: list[str], letters: list[str]) -> np.ndarray:
    """Block keys: length (8 bits) and the sums of the groups (6 bits each)."""
    key = np.minimum(np.array([len(w) for w in words], np.int64), TOP_LENGTH)
    for c in letters:
        key = key << 6 | np.minimum(np.array([w.count(c) for w in words], np.int64), TOP)
    return key


def visited(key: int, n_letters: int) -> list[int]:
    """The other blocks in which words of block ``key`` meet their near words: one
    unit moved from a group to a later one, or one letter less."""
    sums = [key >> 6 * (n_letters - 1 - g) & TOP for g in range(n_letters)]
    length = key >> 6 * n_letters
    rest = length - sum(sums)

    def packed(length, sums):
        out = length
        for s in sums:
            out = out << 6 | s
        return out

    found = set()
    for g in range(n_letters + 1):
        if g < n_letters and not sums[g] or g == n_letters and rest <= 0 and length < TOP_LENGTH and TOP not in sums:
            continue
        # a sum at its top may also stand for more than it says
        less = [[*sums[:g], s, *sums[g + 1:]] for s in ({sums[g] - 1, sums[g]} if sums[g] == TOP else {sums[g] - 1})] \
            if g < n_letters else [sums]
        for base in less:
            for size in {length - 1, length} if length == TOP_LENGTH else {length - 1}:
                found.add(packed(size, base))
            for h in range(g + 1, n_letters):
                found.add(packed(length, [*base[:h], min(TOP, base[h] + 1), *base[h + 1:]]))
            if g < n_letters:
                found.add(packed(length, base))  # into the group of all other letters
    found.discard(key)
    return sorted(found)


def padded(words: list[str], width: int) -> np.ndarray:
    """Code points, zeros after the end."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


def letter_counts(codes: np.ndarray, length: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Words by letters of the (sorted) alphabet: how often each occurs."""
    row, at = np.nonzero(np.arange(codes.shape[1])[None, :] < length[:, None])
    letter = np.searchsorted(alphabet, codes[row, at])
    return np.bincount(row * len(alphabet) + letter, minlength=len(codes) * len(alphabet)).reshape(len(codes), -1).astype(float)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Rows where ``long`` is ``short`` (of that length) with one code point inserted."""
    width = short.shape[1]
    at = np.arange(width)[None, :]
    inside = at < length[:, None]
    ahead = np.where(inside, short == long, False)
    start = np.where(ahead.all(axis=1), width, np.argmin(ahead, axis=1))  # equal code points from the start
    behind = np.zeros_like(inside)
    behind[:, :-1] = short[:, :-1] == long[:, 1:]
    return (behind | ~inside | (at < start[:, None])).all(axis=1)


def near_pairs(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): all ``left[i]`` and ``right[j]`` that are one edit apart."""
    la, lb = (np.array([len(w) for w in x]) for x in (left, right))
    width = int(max(la.max(), lb.max())) + 1
    codes, others = padded(left, width), padded(right, width)
    alphabet = np.union1d(codes, others)
    x, y = letter_counts(codes, la, alphabet), letter_counts(others, lb, alphabet)
    # |x|^2 + |y|^2 - 2 <x, y> as one product; counts are small, else 64-bit floats hold them
    kind = np.float32 if width < 1 << 10 else np.float64
    x = np.column_stack([-2 * x, (x * x).sum(1), np.ones(len(x))]).astype(kind)
    y = np.column_stack([y, np.ones(len(y)), (y * y).sum(1)]).astype(kind)
    out = [np.zeros(0, int)], [np.zeros(0, int)]
    step = max(1, (1 << 22) // len(right))
    for s in range(0, len(left), step):
        near = np.flatnonzero(x[s:s + step] @ y.T < 2.5)
        i, j = near // len(right) + s, near % len(right)
        for t in range(0, len(i), at := max(1, (1 << 22) // width)):
            p, q = i[t:t + at], j[t:t + at]
            d = la[p] - lb[q]
            ok = np.zeros(len(p), bool)
            same, shorter, longer = d == 0, d == -1, d == 1
            ok[same] = one_replaced(codes[p[same]], others[q[same]])
            ok[shorter] = one_inserted(codes[p[shorter]], others[q[shorter]], la[p[shorter]])
            ok[longer] = one_inserted(others[q[longer]], codes[p[longer]], lb[q[longer]])
            out[0].append(p[ok])
            out[1].append(q[ok])
    return np.concatenate(out[0]), np.concatenate(out[1])


def _meet(t: pa.Table) -> dict:
    """Per word of one meeting: its near words, and the best of them."""
    words, n = t.column("word").to_pylist(), t.column("n").to_numpy()
    side = t.column("home").to_numpy(zero_copy_only=False).astype(bool)
    left = np.flatnonzero(side)
    right = np.flatnonzero(~side)
    if not len(left) or not len(right):
        return {"word": [], "n_near": [], "form_n": [], "form": []}
    length, found = np.array([len(w) for w in words]), []
    for one in np.unique(length[left]):  # several only beyond the lengths that keys tell apart
        p, q = left[length[left] == one], right[abs(length[right] - one) <= 1]
        if len(q):
            i, j = near_pairs([words[k] for k in p], [words[k] for k in q])
            found.append((p[i], q[j]))
    i, j = (np.concatenate([f[s] for f in found]) if found else np.zeros(0, int) for s in (0, 1))
    own = t.column("own").to_numpy(zero_copy_only=False).astype(bool)[j]  # both ways: their mirrored pair is here or in another part
    a, b = np.concatenate([i, j[~own]]), np.concatenate([j, i[~own]])
    order = np.argsort(np.array(words, object)[b], kind="stable") if len(b) else np.zeros(0, int)
    a, b = a[order], b[order]
    by = np.lexsort((np.arange(len(a)), -n[b], a))
    a, b = a[by], b[by]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    count = np.diff(first, append=len(a))
    return {"word": [words[k] for k in a[first]], "n_near": count, "form_n": n[b[first]], "form": [words[k] for k in b[first]]}


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of the words that have a near word: their number
    and the most frequent of them.  ``words`` (word, n) should be a written table."""
    letters = letter_groups(words)
    n_letters = len(letters)

    def placed(cols):
        w = cols["word"].to_pylist()
        return {"word": cols["word"], "n": cols["n"], "chars": [len(x) + 1 for x in w], "block": keys_of(w, letters)}

    homes = write_once(arrow_map(words, placed, schema_of("word string, n long, chars long, block long")), "spelling-blocks")
    blocks = write_once(homes.groupBy("block").agg(F.sum("chars").alias("chars")), "spelling-sizes")

    def met(cols):
        keys = cols["block"].to_pylist()
        to = [visited(k, n_letters) for k in keys]
        at = pa.array(np.repeat(np.arange(len(to)), [len(x) for x in to]))
        return {"source": cols["block"].take(at), "chars": cols["chars"].take(at), "block": [k for x in to for k in x]}

    there = blocks.select("block")
    links = arrow_map(blocks, met, schema_of("source long, chars long, block long")).join(there, "block", "left_semi")
    links = write_once(links.withColumn("own", F.lit(False)).unionByName(
        blocks.select(F.col("block").alias("source"), "chars", "block", F.lit(True).alias("own"))), "spelling-links")
    parts = write_once(links.groupBy("block").agg(
        F.ceil(F.sum("chars") / CHUNK).cast("int").alias("rights"),
        F.ceil(F.sum(F.when(F.col("own"), F.col("chars"))) / CHUNK).cast("int").alias("lefts")), "spelling-parts")

    def dealt(word, count):
        return F.pmod(F.xxhash64(word), count).cast("int")

    all_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    lefts = homes.join(parts, "block").select(
        "block", dealt("word", F.col("lefts")).alias("l"), all_of("rights").alias("r"), "word", "n",
        F.lit(True).alias("home"), F.lit(True).alias("own"))
    rights = homes.select("word", "n", F.col("block").alias("source")).join(
        links.join(parts, "block").select("source", "block", "own", "lefts", "rights"), "source").select(
        "block", all_of("lefts").alias("l"), dealt("word", F.col("rights")).alias("r"), "word", "n",
        F.lit(False).alias("home"), "own")
    schema = schema_of("word string, n_near long, form_n long, form string")

    def run(t: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        got, want = _meet(t), to_arrow_schema(schema)
        return pa.table([pa.array(got[f.name], f.type) for f in want], schema=want)

    met = lefts.unionByName(rights).groupBy("block", "l", "r").applyInArrow(run, schema)
    return met.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n)."""
    words = write_once(words.select("word", "n"), "spellings")
    forms = write_once(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("form_n") >= factor * F.col("n"), F.col("form")).alias("form"),
        F.when(F.col("form_n") >= factor * F.col("n"), F.col("form_n")).alias("form_n")), "spelling-forms")
    links = forms.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    for _ in range(5):  # counts are below 2 ** 63, so a chain has at most 18 steps of a factor of ten
        ends = links.select(F.col("word").alias("to"), F.col("to").alias("further"))
        links = write_once(links.join(ends, "to", "left").select("word", F.coalesce("further", "to").alias("to")), "spelling-roots")
    return forms.join(links, "word", "left").select(
        "word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")
