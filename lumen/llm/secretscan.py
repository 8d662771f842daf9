"""Secret scans with character Markov models.

Base rules find three kinds of span (``assign``, ``access``, ``hex``).  Two
first-order character models, one of random strings and one of ordinary
identifiers, are trained from labelled samples; a run of 16 or more token
characters outside the base spans (what lies before, between and after them, if
they cover a part of it) is a further span of kind ``markov`` if its log-likelihood
ratio reaches ``MIN_RATIO`` nats in all and ``MIN_MEAN`` nats a character.

Labelled samples.  Random: seeded random strings over the usual alphabets, and the
values of base spans found in the documents.  Ordinary: seeded identifiers in
every usual form (snake, kebab, constant, camel and Pascal case, paths, URLs,
UUIDs, rule lines, numbers) made of program words and of words that the
documents' own character pairs give, and all other words of eight or more token
characters of the documents.  The documents' counts weigh ``DOCUMENT_SHARE`` of the
made ones, so that neither the prose of a large corpus nor its few secrets
outweigh the forms.  Pairs not seen back off to the frequency of the character
alone.  Training counts the character pairs of every whole text and moves only
these counts; the scan reads every whole text as well.  Lower-case hex of fewer
than 24 digits reads like parts of a UUID and is left alone.

Spans are code points with an exclusive end.  Defined results: null text is
empty and has no span; documents without ordinary words train no model and get
base spans only; repeated rows give repeated results; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, schema_of, texts_of

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need not be matched first
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
WORD = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CHUNK_CHARS = 2_000_000  # of words that are counted at once
MIN_RATIO, MIN_MEAN = 12.0, 0.5
MIN_RUN = 16
DOCUMENT_SHARE = 0.3
BACK_OFF = 4.0  # pseudo-counts of a character's own frequency after each character
# Words that program identifiers are made of.
PROGRAM_WORDS = (
    "account action add address admin agent alert api app apply archive array async auth backup base batch before block "
    "body buffer build button bytes cache call cancel card cart chart check child class clean click client close cloud "
    "code color column command commit common component config connect console content context control cookie copy core "
    "count create current custom data database date debug default delete deploy detail device dialog display domain "
    "download edit element email enable engine entry error event example execute expect export factory feature fetch "
    "field file filter find first flag flow folder form format frame from function global grid group guide handler hash "
    "header health help history home host icon image import index info input insert install instance interface invoice "
    "item java job join key label last layout library license limit line link list listener load local lock log main "
    "manager map mask master member memory menu message method mobile mode model module month mouse name network next "
    "node note number object offset open option order owner package page panel param parent parse path payment pool port "
    "position prefix price private process product profile project property provider proxy public query queue random "
    "range rate read record reference region register release remote remove render report request reset resource "
    "response result return review role root route row rule run save scan schema scope score script search section "
    "select send server service session set settings setup share shell size sort source start state status step stop "
    "storage store stream string style submit support switch sync system table target task team template test text "
    "theme thread time title toggle total trace track transaction tree trigger type unit update upload user util value "
    "vector version view visible wait web width window word work wrapper write year zone").split()
CLASSES = 96  # printable ASCII and one class for the rest
MASK = "[secret]"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every base span, by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _ends(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts of sorted spans and the largest end up to each of them."""
    return [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))


def _codes(token: str) -> np.ndarray:
    a = np.frombuffer(token.encode("latin-1", "replace"), np.uint8).astype(np.int64) - 33
    return np.where((a >= 0) & (a < CLASSES - 1), a, CLASSES - 1)


def _count(tokens: list[str]) -> np.ndarray:
    """Counts of character pairs (row: the character before)."""
    c = _codes("\n".join(tokens))  # the line break is in the last class, which no token has
    a, b = c[:-1], c[1:]
    ok = (a < CLASSES - 1) & (b < CLASSES - 1)
    return np.bincount(a[ok] * CLASSES + b[ok], minlength=CLASSES * CLASSES)


def random_samples(n: int = 2000, seed: int = 7) -> list[str]:
    """Seeded random strings over the alphabets that keys are written in."""
    rnd = random.Random(seed)
    alphabets = ("0123456789abcdef", string.ascii_uppercase + "234567", string.ascii_letters + string.digits,
                 string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_")
    return ["".join(rnd.choices(alphabets[i % len(alphabets)], k=rnd.randint(20, 44))) for i in range(n)]


def labelled_pairs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(label, pair, n): character-pair counts of the labelled samples of ``docs``
    (1: values of base spans, 0: the other words), summed over all documents."""
    def count(cols):
        sums = np.zeros((2, CLASSES * CLASSES), np.int64)
        words: tuple[list[str], list[str]] = ([], [])
        held = 0

        def flush():
            for label in (0, 1):
                sums[label] += _count(words[label])
                words[label].clear()

        for text in texts_of(cols["text"]):
            if spans := base_spans(text):
                starts, ends = _ends(spans)
                for m in WORD.finditer(text):
                    k = bisect_right(starts, m.start())
                    inside = k > 0 and ends[k - 1] > m.start()
                    words[inside].append(m.group().rpartition("=")[2] if inside else m.group())
            else:
                words[0].extend(WORD.findall(text))
            held += len(text)
            if held > CHUNK_CHARS:
                flush()
                held = 0
        flush()
        rows = [(label, p, n) for label in (0, 1) for p, n in enumerate(sums[label].tolist()) if n]
        return {"label": [r[0] for r in rows], "pair": [r[1] for r in rows], "n": [r[2] for r in rows]}

    pairs = arrow_map(docs.select(F.col(text_col).alias("text")), count, schema_of("label int, pair int, n long"))
    return pairs.groupBy("label", "pair").agg(F.sum("n").alias("n"))


def chain_words(pairs: np.ndarray, n: int, seed: int) -> list[str]:
    """Seeded lower-case words drawn from character-pair counts."""
    rnd = random.Random(seed)
    letters = [ord(c) - 33 for c in string.ascii_lowercase]
    weights = pairs.reshape(CLASSES, CLASSES)[np.ix_(letters, letters)] + 1e-9
    first = weights.sum(axis=1)
    out = []
    for _ in range(n):
        w = rnd.choices(range(26), weights=first)
        for _ in range(rnd.randint(2, 8)):
            w += rnd.choices(range(26), weights=weights[w[-1]])
        out.append("".join(string.ascii_lowercase[i] for i in w))
    return out


def identifier_samples(words: list[str], n: int = 1500, seed: int = 5) -> dict[str, list[str]]:
    """Seeded ordinary identifiers by form, ``n`` of each."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(words)
    cap = lambda w: w[:1].upper() + w[1:]
    digits = lambda k: "".join(rnd.choices("0123456789abcdef", k=k))
    marks = string.ascii_letters + string.digits

    def uuid():
        u = "-".join(digits(k) for k in (8, 4, 4, 4, 12))
        return u.upper() if rnd.random() < 0.2 else u

    def rule():
        if rnd.random() < 0.7:
            return rnd.choice("-=_+/" + marks) * rnd.randint(16, 60)
        return "".join(rnd.sample("-=+/_", 2)) * rnd.randint(8, 30)

    forms = {
        "snake": lambda ws: "_".join(ws) + rnd.choice(("", "", f"_{rnd.randint(0, 9999)}")),
        "kebab": lambda ws: "-".join(ws) + rnd.choice(("", "", f"-{rnd.randint(0, 99)}")),
        "constant": lambda ws: "_".join(ws).upper(),
        "camel": lambda ws: ws[0] + "".join(map(cap, ws[1:])) + rnd.choice(("", "", str(rnd.randint(0, 99)))),
        "pascal": lambda ws: "".join(map(cap, ws)),
        "path": lambda ws: rnd.choice(("", "/")) + "/".join(
            rnd.choice((w, w, f"{w}_{word()}", cap(w) + cap(word()), f"{w}-{word()}")) for w in ws)
        + "/" + "".join(cap(word()) for _ in range(rnd.randint(1, 3))),
        "url": lambda ws: "//www/" + "/".join(
            rnd.choice((w, f"{w}-{word()}", str(rnd.randint(1990, 2030)), f"{w}={word()}")) for w in ws),
        "uuid": lambda ws: uuid(),
        "rule": lambda ws: rule(),
        "number": lambda ws: "".join(rnd.choices(string.digits, k=rnd.randint(16, 24))),
    }
    return {name: [make([word() for _ in range(rnd.randint(3, 6))]) for _ in range(n)] for name, make in forms.items()}


def _logs(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of the next character, backing off to its own frequency."""
    c = counts.reshape(CLASSES, CLASSES)
    alone = c.sum(axis=0) + 0.5
    alone[-1] = 0
    alone /= alone.sum()
    return np.log((c + BACK_OFF * alone[None, :] + 1e-3) / (c.sum(axis=1, keepdims=True) + BACK_OFF + CLASSES * 1e-3))


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-likelihood ratio of every character pair (random over ordinary).

    Trains on all documents; at most 2 x 96 x 96 counts reach the driver.
    """
    counts = np.zeros((2, CLASSES * CLASSES))
    for r in labelled_pairs(docs, text_col).collect():
        counts[r["label"], r["pair"]] = r["n"]
    if not counts[0].any():
        return np.zeros((CLASSES, CLASSES))
    words = chain_words(counts[0], 600, seed=5) + 2 * PROGRAM_WORDS
    made = (sum(_count(v) for v in identifier_samples(words).values()), _count(random_samples(6000)))
    plain, secret = (m + c * (DOCUMENT_SHARE * m.sum() / max(1, c.sum())) for m, c in zip(made, counts))
    return _logs(secret) - _logs(plain)


def _outside(at: int, end: int, starts: list[int], ends: list[int]) -> Iterator[tuple[int, int]]:
    """The parts of at least ``MIN_RUN`` characters of a run that no base span covers."""
    for k in range(bisect_right(ends, at), bisect_left(starts, end)):
        if starts[k] - at >= MIN_RUN:
            yield at, starts[k]
        at = max(at, ends[k])
    if end - at >= MIN_RUN:
        yield at, end


def scan_text(text: str, ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """Base spans and ``markov`` spans of a text, by start, then kind."""
    spans = base_spans(text)
    starts, ends = _ends(spans)
    extra = []
    for m in RUN.finditer(text):
        for at, end in _outside(m.start(), m.end(), starts, ends):
            c = _codes(text[at:end])
            total = ratio[c[:-1], c[1:]].sum()
            if total >= MIN_RATIO and total >= MIN_MEAN * (end - at):
                extra.append((at, 3, end))
    return sorted(spans + extra)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, counts of the base kinds, ``base_sha256``, ``spans`` and ``n_markov``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(cols):
        found = [scan_text(t, ratio) for t in texts_of(cols["text"])]
        n = [[sum(k == i for _, k, _ in f) for f in found] for i in range(len(KINDS))]
        base = [_joined(x for x in f if x[1] < 3) for f in found]
        return {id_col: cols["id"], "n_assign": n[0], "n_access": n[1], "n_hex": n[2],
                "base_sha256": [hashlib.sha256(b.encode()).hexdigest() for b in base],
                "spans": [_joined(f) for f in found], "n_markov": n[3]}

    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema_of(
        f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"))


def masked(text: str, ratio: np.ndarray) -> str:
    """The text with every span (overlapping ones as one) replaced by ``MASK``."""
    out, at = [], 0
    for s, _, e in scan_text(text, ratio):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the secrets of its texts masked and their lengths renewed;
    rows and other columns stay, null texts stay null."""
    ratio = train(docs, text_col)

    def run(cols):
        texts = [None if t is None else masked(t, ratio) for t in cols[text_col].to_pylist()]
        out = dict(cols) | {text_col: texts}
        if length_col in cols:
            old = cols[length_col].to_pylist()
            out[length_col] = [o if t is None else len(t) for o, t in zip(old, texts)]
        return out

    return arrow_map(docs, run, docs.schema)
