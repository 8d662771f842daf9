"""Language identification by known words, backing off to character n-grams.

Training counts the words (runs of letters, lower-cased) of every labelled text
by language, and from the counted words the character n-grams of 1 to
``LONGEST`` letters (word ends marked).  A word or n-gram is known if it makes
up at least one part in ``ONE_IN`` of all words, or of all n-grams of its
length, and occurs ``LEAST`` times: so at most ``ONE_IN`` of each can be known,
whatever the size of the corpus, and the model has a proven bound.  It holds
the log frequency of each per language (add-``ALPHA`` smoothed).

A word of a text counts with its own log frequencies if it is known.  Else its
longest n-grams of which any is known count, with the mean of their log
frequencies: first those of ``LONGEST`` letters, then shorter ones.  The sum over all
words of the text plus the log share of the language among the training texts
gives the posterior of each language.

Words are counted and languages predicted in tasks over whole texts, batch by
batch; n-grams are counted from the counted words.  Counts are summed in each task before the shuffle, so a word or language that holds a
third of all rows costs no more than any other.  The model goes to the tasks
with the function (its size is bounded as above).

Defined results: a null text or one without letters is ``und`` with score 0;
rows without a language or text are not learned from; without anything learned
every text is ``und`` with score 0; a text whose letters are all unknown gets
the most frequent language and its share; ties go to the first language in code
point order; very long texts are counted whole; repeated rows count each; an
empty table gives an empty result; all columns stay in ``with_language`` but
for those of the result's names, which are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, schema_of, write_once

ONE_IN = 1_000_000
LEAST = 3
LONGEST = 5
ALPHA = 0.5
UNKNOWN = "und"
FLUSH = 300_000  # entries a task holds before it sends its sums on

_RUNS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The runs of letters, lower-cased."""
    found = _RUNS.findall(text.lower())
    if not found or "".join(found).isalpha():
        return found
    found = ["".join(filter(str.isalpha, w)) for w in found]  # other numerals count as word characters, not as letters
    return [w for w in found if w]


def _summed(df: DataFrame, count, key: str) -> DataFrame:
    """(lang, ``key``, n): sums of what ``count`` adds to the counters of the languages from each batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: defaultdict = defaultdict(Counter)

        def out():
            langs = [lang for lang, c in sums.items() for _ in range(len(c))]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array([k for c in sums.values() for k in c], pa.string()),
                 pa.array([n for c in sums.values() for n in c.values()], pa.int64())], names=["lang", key, "n"])
            sums.clear()
            return batch

        for b in batches:
            count(sums, {c: b.column(i).to_pylist() for i, c in enumerate(b.schema.names)})
            if sum(map(len, sums.values())) > FLUSH:
                yield out()
        yield out()

    return (df.mapInArrow(run, schema_of(f"lang string, {key} string, n long"))
            .groupBy("lang", key).agg(F.sum("n").alias("n")))


def _words(sums, cols):
    for lang, text in zip(cols["lang"], cols["text"]):
        sums[lang].update(words_of(text))


def grams(word: str) -> list[str]:
    """All n-grams of a word between its end marks; a single mark is none."""
    marked = f"<{word}>"
    return [*word, *[marked[i:i + n] for n in range(2, LONGEST + 1) for i in range(len(marked) - n + 1)]]


def _grams(sums, cols):
    for lang, word, n in zip(cols["lang"], cols["word"], cols["n"]):
        c, found = sums[lang], grams(word)
        if n <= 3:  # most words are rare, and the counter is faster than a loop
            c.update(found * n)
        else:
            for g in found:
                c[g] = c.get(g, 0) + n


def _known(counts: DataFrame, key: str, level: Column) -> tuple[DataFrame, DataFrame]:
    """(level, ``key``, by): the counts by language of the known entries; and
    (level, lang, n): the sums over all entries."""
    counts = counts.withColumn("level", level)
    sums = counts.groupBy("level", "lang").agg(F.sum("n").alias("n"))  # languages x levels
    per_key = counts.groupBy("level", key).agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by"))  # languages only
    whole = sums.groupBy("level").agg(F.sum("n").alias("total"))  # at most LONGEST rows
    known = (per_key.join(F.broadcast(whole), "level")
             .where((F.col("all") >= LEAST) & (F.col("all") * ONE_IN >= F.col("total"))).select("level", key, "by"))
    return known, sums


class Model:
    """Languages, log priors, and tables of log frequencies: (row number by entry,
    rows by language) for words (level 0) and n-grams (levels 1 to ``LONGEST``)."""

    def __init__(self, langs: list[str], prior: np.ndarray, tables: dict[int, tuple[dict, np.ndarray]]):
        self.langs, self.prior, self.tables = langs, prior, tables


class _Rows(dict):
    """Row numbers by word; a word that is not there gets the next one and is noted."""

    def __init__(self, known: dict):
        super().__init__(known)
        self.used, self.pending = len(known), []

    def __missing__(self, word):
        self[word] = row = self.used
        self.used += 1
        self.pending.append(word)
        return row


class Reader:
    """A task's view of the model: keeps the rows of the unknown words that it has met."""

    def __init__(self, model: Model):
        self.model = model
        known = model.tables[0][1]
        self.rows = _Rows(model.tables[0][0])
        self.table = np.zeros((len(known) + 1024, len(model.langs)))
        self.table[:len(known)] = known
        self.gram_rows: dict[str, int] = {}
        parts = [np.zeros((1, len(model.langs)))]
        for n in range(1, LONGEST + 1):  # entries of different lengths differ, so one index holds all
            index, table = model.tables[n]
            base = sum(map(len, parts))
            self.gram_rows.update((g, base + i) for g, i in index.items())
            parts.append(table)
        self.grams = np.concatenate(parts)

    def back_off(self) -> None:
        """Fill the rows of the noted words: each the mean of the word's longest known n-grams."""
        get, words, flat, size = self.gram_rows.get, self.rows.pending, [], []
        for w in words:
            marked = f"<{w}>"
            for n in range(min(LONGEST, len(marked)), 0, -1):
                m = marked if n > 1 else w
                at = [i for k in range(len(m) - n + 1) if (i := get(m[k:k + n])) is not None]
                if at:
                    flat += at
                    size.append(len(at))
                    break
            else:
                flat.append(0)  # a row of zeros: nothing is known of it
                size.append(1)
        end = self.rows.used
        while end > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        at = np.cumsum([0, *size[:-1]])
        self.table[end - len(words):end] = np.add.reduceat(self.grams[flat], at, axis=0) / np.array(size)[:, None]
        words.clear()

    def predict(self, text: str | None) -> tuple[str, float]:
        found = words_of(text or "")
        if not found:
            return UNKNOWN, 0.0
        counts = Counter(found)
        words, n = list(counts), np.array(list(counts.values()), float)
        z = self.model.prior.copy()
        for s in range(0, len(words), 100_000):  # a part's rows stay in place while it is summed
            if self.rows.used > len(self.model.tables[0][0]) + FLUSH:  # words met long ago go
                self.rows = _Rows(self.model.tables[0][0])
            part = words[s:s + 100_000]
            at = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
            if self.rows.pending:
                self.back_off()
            z += n[s:s + 100_000] @ self.table[at]
        best = int(np.argmax(z))
        return self.model.langs[best], float(1 / np.exp(z - z[best]).sum())


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of the labelled texts of ``docs``, counted over all of them."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    share = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(share)
    if not langs:
        return Model([], np.zeros(0), {})
    words = write_once(_summed(rows, _words, "word"), "language-words")
    counted = write_once(_summed(words, _grams, "gram"), "language-grams")
    tables = {}
    found: dict[int, tuple[list, list]] = {n: ([], []) for n in range(LONGEST + 1)}
    total = np.zeros((LONGEST + 1, len(langs)))
    for counts, key, level in ((words, "word", F.lit(0)), (counted, "gram", F.length("gram"))):
        known, sums = _known(counts, key, level)
        for r in sums.collect():  # languages x levels
            total[r["level"], langs.index(r["lang"])] = r["n"]
        for r in known.toLocalIterator():  # at most ONE_IN entries a level
            n = np.zeros(len(langs))
            for e in r["by"]:
                n[langs.index(e["lang"])] = e["n"]
            found[r["level"]][0].append(r[key])
            found[r["level"]][1].append(n)
    for level, (keys, counts) in found.items():
        n = np.array(counts).reshape(-1, len(langs))
        logs = np.log((n + ALPHA) / (total[level] + ALPHA * (len(keys) + 1)))
        tables[level] = ({k: i for i, k in enumerate(keys)}, logs.astype(np.float32))
    prior = np.log(np.array([share[x] for x in langs], float) / sum(share.values()))
    return Model(langs, prior, tables)


def with_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the language's posterior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by ONE_IN
    rest = docs.drop("lang_pred", "score") if text_col not in ("lang_pred", "score") else docs.select(
        *[c for c in docs.columns if c not in {"lang_pred", "score"} - {text_col}])
    schema = rest.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    readers: list[Reader] = []  # one a task

    def run(cols):
        if not readers and shared.value.langs:
            readers.append(Reader(shared.value))
        got = [readers[0].predict(t) if readers else (UNKNOWN, 0.0) for t in cols[text_col].to_pylist()]
        return dict(cols) | {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return arrow_map(rest, run, schema)


def predict_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; the rows whose crc32(id) mod 3
    is 1 are held out, and the others that have an id train the model."""
    part = F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")) % 3
    model = train(docs.where(part != 1), text_col, lang_col)
    rows = docs.select(F.col(id_col), F.coalesce(part == 1, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return with_language(rows, model, "text").select(id_col, "held_out", "lang_pred", "score")
