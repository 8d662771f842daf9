"""Quality classifier with hierarchical empirical Bayes site evidence.

1. Document evidence.  A logistic regression over 18 text features (shares of
   letters, digits, symbols and capitals, repetition, word and line shape) is
   trained on labelled documents and gives each document p(good).
2. Site evidence.  Grouped aggregation sums n and the evidence of each row - its
   label where it has one, else p - by path within host.  A host's rate is shrunk
   towards the global rate, a path's towards its host's:
   posterior = (sum of evidence + k * prior) / (n + k).  The strengths k are fitted by
   moments from the spread of the rates (empirical Bayes), so a sparse site
   stays near its prior.
3. Both are combined in log-odds: logit p(doc) + logit posterior(path) -
   logit global rate.  A document is kept at 0.5 or more.

For ``documents`` the host is ``source`` and the path ``lang`` within it.

Training reads a bounded sample of at most about ``TRAIN_ROWS`` labelled rows
(chosen by a hash of the id); only its features and labels reach the driver.
Everything else covers all rows.

Defined results: null text is empty; null host or path is a site of its own;
labels that are null or whose document is missing are left out, repeated ones
count once for each value in training and as their mean in the site evidence; without labels of
both kinds p(doc) is 0.5 (documents are kept unless the labels of their site tip
the balance); very long texts are read whole; an empty table gives an empty
result; extra columns stay, whatever their names, in ``drop_low_quality`` and are
ignored in ``score``.
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, hint_small, schema_of, texts_of, write_once
from lumen.operators.ordered import free_prefix

TRAIN_ROWS = 20_000
N_FEATURES = 18
FLOOR = 1e-4

_KIND = np.zeros(256, np.int64)  # of UTF-8 bytes: 0 other control, 1 lower, 2 upper, 3 digit, 4 space, 5 stop marks, 6 symbols, 7 beyond ASCII
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (7 if _b > 127 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit()
                 else 4 if _c.isspace() else 5 if _c in ".,;:?'\"()-" else 6 if _b > 32 else 0)


def features(text: str) -> list[float]:
    """The document's features, all between 0 and about 2."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, raw.size)
    by = np.bincount(_KIND[raw], minlength=8) / n
    words = text.split()
    m = max(1, len(words))
    kinds = set(words)
    lines = text.split("\n")
    ends = sum(not w[-1].isalnum() and w[-1] not in ".,;:?'\")" for w in words) / m
    bare = sum(not any(c.isalnum() for c in w) for w in words) / m
    loud = sum(len(w) > 1 and w.isupper() for w in words) / m
    repeats = sum(map(eq, words, words[1:])) / m
    filled = [ln for ln in lines if ln.strip()]
    return [by[1], by[2], by[3], by[4], by[5], by[6], by[7],
            np.log1p(m) / 8, sum(map(len, words)) / m / 10, len(kinds) / m, ends, bare, loud, repeats,
            len(lines) / m, 1 - len(set(filled)) / max(1, len(filled)),
            text.count("!") / n * 10, text.count("|") / n * 10]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights (scaled features, then bias) of a ridge logistic regression by
    damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge * len(x))
    pull[-1] = 1e-6

    def loss(v):
        z = x @ v
        return np.logaddexp(0, -np.where(y > 0, z, -z)).sum() + (pull * v * v).sum() / 2

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        grad = x.T @ (p - y) + pull * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), grad)
        t = 1.0
        while (new := loss(w - t * step)) > now and t > 1e-6:
            t /= 2
        if now - new < 1e-9 * max(1.0, now):
            break
        w, now = w - t * step, new
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(mean, scale, weights), or None without labels of both kinds."""
    lab = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    share = min(1.0, rows / max(1, lab.count()))
    lab = lab.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    # an id that is labelled many times trains once for each of its labels
    lab = hint_small(write_once(lab.groupBy("id", (F.col("y") > 0).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")), "sample"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(lab, "id")  # about ``rows`` rows

    def run(cols):
        return {"x": [features(t) for t in texts_of(cols["text"])], "y": cols["y"]}

    got = arrow_map(texts, run, schema_of("x array<double>, y int")).toPandas()
    y = (got["y"].to_numpy() > 0).astype(float)
    if not len(got) or y.min() == y.max():
        return None
    x = np.array(got["x"].tolist())
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return mean, scale, fit((x - mean) / scale, y)


def with_document_score(docs: DataFrame, model, text_col: str = "text", name: str = "_p") -> DataFrame:
    """``docs`` with the classifier's p(good) as a further column."""
    def run(cols):
        texts = texts_of(cols[text_col])
        if model is None or not texts:
            p = np.full(len(texts), 0.5)
        else:
            mean, scale, w = model
            x = (np.array([features(t) for t in texts]) - mean) / scale
            p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        return dict(cols) | {name: p.tolist()}

    return arrow_map(docs, run, docs.select("*", F.lit(0.5).alias(name)).schema)


def site_posteriors(scored: DataFrame, host: str, path: str, p: str = "_p") -> DataFrame:
    """(host, path, n, host_rate, path_rate, global_rate): shrunk rates of every site.

    One partial aggregation over the rows; all else works on the sites.
    """
    sites = write_once(scored.groupBy(F.col(host).alias("host"), F.col(path).alias("path"))
                       .agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("s")), "sites")
    hosts = sites.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))

    def strength(n, rate, prior, groups):
        """k of a Beta prior from the weighted spread of ``rate`` around ``prior``."""
        noise = F.sum(prior * (1 - prior)) / F.sum(n)  # binomial variance of the rates, by rows
        spread = F.sum(n * (rate - prior) ** 2) / F.sum(n) - noise
        level = F.sum(n * prior * (1 - prior)) / F.sum(n)
        return F.greatest(F.lit(1.0), F.least(F.lit(1e4), level / F.greatest(spread, F.lit(1e-6)) - 1)).alias(groups)

    whole = sites.agg((F.sum("s") / F.sum("n")).alias("g"))
    with_g = hosts.crossJoin(F.broadcast(whole))  # one row
    k_host = with_g.agg(strength(F.col("hn"), F.col("hs") / F.col("hn"), F.col("g"), "kh"))
    host_rates = with_g.crossJoin(F.broadcast(k_host)).select(
        F.col("host").alias("h"), "g", ((F.col("hs") + F.col("kh") * F.col("g")) / (F.col("hn") + F.col("kh"))).alias("hr"))
    paths = sites.join(host_rates, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    k_path = paths.agg(strength(F.col("n"), F.col("s") / F.col("n"), F.col("hr"), "kp"))
    return paths.crossJoin(F.broadcast(k_path)).select(
        "host", "path", "n", F.col("hr").alias("host_rate"),
        ((F.col("s") + F.col("kp") * F.col("hr")) / (F.col("n") + F.col("kp"))).alias("path_rate"),
        F.col("g").alias("global_rate"))


def _logit(c):
    c = F.greatest(F.lit(FLOOR), F.least(F.lit(1 - FLOOR), c))
    return F.log(c / (1 - c))


def with_evidence(scored: DataFrame, labels: DataFrame, id_col: str, labelled_id: str, label_col: str, p: str, name: str) -> DataFrame:
    """``scored`` with ``name``: the mean label of the row's id where there is one, else ``p``."""
    f = free_prefix(scored.columns, [name])
    known = labels.where(F.col(labelled_id).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(labelled_id).alias(f"{f}id")).agg(F.avg((F.col(label_col) > 0).cast("double")).alias(f"{f}y"))
    known = hint_small(write_once(known, "known-labels"))
    return scored.join(known, F.col(id_col) == F.col(f"{f}id"), "left").withColumn(
        name, F.coalesce(f"{f}y", p)).drop(f"{f}id", f"{f}y")


def with_posterior(scored: DataFrame, sites: DataFrame, host: str, path: str, p: str = "_p", name: str = "_post") -> DataFrame:
    """``scored`` with ``name``, the combined probability of the document and its site
    (``sites``: of ``site_posteriors``)."""
    f = free_prefix(scored.columns, [name])
    sites = hint_small(write_once(sites.select(
        F.col("host").alias(f"{f}h"), F.col("path").alias(f"{f}l"),
        (_logit(F.col("path_rate")) - _logit(F.col("global_rate"))).alias(f"{f}shift")), "posteriors"))
    rows = scored.join(sites, F.col(host).eqNullSafe(F.col(f"{f}h")) & F.col(path).eqNullSafe(F.col(f"{f}l")), "left")
    z = _logit(F.col(p)) + F.coalesce(f"{f}shift", F.lit(0.0))
    return rows.withColumn(name, 1 / (1 + F.exp(-z))).drop(f"{f}h", f"{f}l", f"{f}shift")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host: str = "source", path: str = "lang", label_col: str = "quality") -> DataFrame:
    """Per row: the id, ``p_document``, ``p_good`` (combined) and ``keep``."""
    model = train(docs, labels, id_col, text_col, label_col)
    scored = with_document_score(docs.select(F.col(id_col).alias("_id"), F.col(host).alias("_host"),
                                             F.col(path).alias("_path"), F.col(text_col).alias("_text")), model, "_text")
    scored = write_once(scored.drop("_text"), "scores")
    sites = site_posteriors(with_evidence(scored, labels, "_id", id_col, label_col, "_p", "_seen"), "_host", "_path", "_seen")
    return with_posterior(scored, sites, "_host", "_path").select(
        F.col("_id").alias(id_col), F.round("_p", 6).alias("p_document"), F.round("_post", 6).alias("p_good"),
        (F.col("_post") >= 0.5).alias("keep"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     host: str = "source", path: str = "lang", label_col: str = "quality") -> DataFrame:
    """``docs`` without the documents that the classifier rejects; all columns stay."""
    model, f = train(docs, labels, id_col, text_col, label_col), free_prefix(docs.columns)
    scored = write_once(with_document_score(docs, model, text_col, f"{f}p"), "scored")
    seen = with_evidence(scored.select(F.col(id_col).alias("_id"), F.col(host).alias("_host"), F.col(path).alias("_path"),
                                       F.col(f"{f}p").alias("_p")), labels, "_id", id_col, label_col, "_p", "_seen")
    sites = site_posteriors(seen, "_host", "_path", "_seen")
    return with_posterior(scored, sites, host, path, f"{f}p", f"{f}post").where(F.col(f"{f}post") >= 0.5).select(*docs.columns)
