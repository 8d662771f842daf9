"""Main-text extraction by a linear-chain conditional random field.

A page is cut into leaf blocks of its DOM: runs of text between block-level
tags.  Scripts, styles and markup are never text; inline tags do not split a
block; character references are decoded and white space becomes one space.
Each block has ancestor-tag features (tags and the meaning of class, id and role
names above it) and text features (length, link share, punctuation, place).  A
two-label chain (main text, other) scores blocks and neighbouring labels; it is
trained by maximum likelihood and decoded by Viterbi over the whole page.

Labelled pages for training: a bounded sample of at most ``TRAIN_PAGES``
different pages of up to ``TRAIN_CHARS`` characters (the smallest hashes, so the
same ones at every run) whose own article element names the main text, and
``MADE_PAGES`` pages that set up to ``TRAIN_TEXTS`` of the sample's paragraphs and
short texts in other layouts (content divisions, sidebars, notices, adverts,
forms, reader comments) with known labels; pages of more than ``TRAIN_BLOCKS``
blocks do not train.  Only the sample reaches the driver.  These bounds hold for
training alone: extraction reads every page whole.

A quote opens an attribute's value only after an equals sign; any other quote in
a tag, and one that never closes, is a character like others.

Defined results: null html is empty; a page without main text gives an empty
string; unclosed tags, comments and scripts end with the page; repeated rows
give repeated results; an empty table gives an empty result (the layouts then
train on made words); extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, schema_of, texts_of

TRAIN_PAGES, MADE_PAGES, TRAIN_BLOCKS, TRAIN_TEXTS, TRAIN_CHARS = 400, 900, 250, 4000, 200_000

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)", re.I | re.S)
NAMES = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Start tags that end an open element of the same set.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = frozenset("ul ol dl table body html article section div main aside nav header footer form td th".split())
TAGS = ("article main section nav header footer aside form ul ol li table td blockquote figure figcaption pre p "
        "h1 h2 h3 h4 h5 h6 button select option fieldset legend dialog address head title dd dt menu details").split()
MEANINGS = {
    "nav": "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toc skip topnav tabs",
    "header": "header masthead banner topbar logo brand tagline top",
    "footer": "footer copyright legal colophon contentinfo imprint bottom foot",
    "sidebar": "sidebar aside rail widget widgets related recommended trending popular tags complementary more links secondary",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay newsletter subscribe paywall message "
              "warning banner toast privacy",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted commercial adsense",
    "form": "form search login signup register contact",
    "comment": "comment comments reply replies discussion disqus respond reader response feedback thread reviews",
    "social": "share sharing social follow tweet facebook",
    "content": "article content post entry story main body text articlebody maincontent prose",
    "meta": "byline author meta date published caption credit",
}
_MEANING: dict[str, set[str]] = {}
for _name, _words in MEANINGS.items():
    for _w in _words.split():
        _MEANING.setdefault(_w, set()).add(_name)


def meanings(attrs: str) -> frozenset[str]:
    """What the class, id and role names of a tag say."""
    out = set()
    for m in NAMES.finditer(attrs):
        value = m.group(1) or m.group(2) or m.group(3) or ""
        for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value):
            out |= _MEANING.get(w.lower(), set())
    if HIDDEN.search(attrs):
        out.add("hidden")
    return frozenset(out)


class Block:
    """A leaf block: its text, the tags and meanings above it, and its link share."""

    __slots__ = ("text", "tags", "means", "links", "last")

    def __init__(self, text, tags, means, links, last):
        self.text, self.tags, self.means, self.links, self.last = text, tags, means, links, last


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; empty ones are left out."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset]] = []  # block-level tags and meanings
    inline: list[str] = []  # open inline tags of the present block
    parts: list[str] = []
    linked = at = 0

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            means: set[str] = set()
            for _, m in stack:
                means |= m
            out.append(Block(text, frozenset(t for t, _ in stack), frozenset(means),
                             min(1.0, linked / len(text)), stack[-1][0] if stack else ""))
        parts.clear()
        linked = 0

    def take(upto: int):
        nonlocal linked
        if upto > at:
            piece = html.unescape(page[at:upto]) if "&" in page[at:upto] else page[at:upto]
            parts.append(piece)
            if "a" in inline:
                linked += len(piece.strip())

    for m in MARKUP.finditer(page):
        take(m.start())
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            if m.group("raw"):
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag in INLINE:
            if m.group("end"):
                if tag in inline:
                    inline.remove(tag)
            elif tag not in VOID:
                inline.append(tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if m.group("end"):
            names = [t for t, _ in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag):]
                inline.clear()
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
            inline.clear()
        closes = IMPLIED.get(tag, ())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in closes:
                del stack[k:]
                break
            if stack[k][0] in SCOPES:
                break
        if tag not in VOID:
            stack.append((tag, meanings(m.group("attrs")) if m.group("attrs") else frozenset()))
    take(len(page))
    flush()
    return out


NUMBERS = [f"tag:{t}" for t in TAGS] + [f"mean:{m}" for m in (*MEANINGS, "hidden")] + [
    f"last:{t}" for t in ("p", "li", "div", "td", "h1", "h2", "h3", "section", "article", "")] + [
    f"len:{k}" for k in range(6)] + [f"link:{k}" for k in range(3)] + [
    "stop", "rights", "few_stops", "first", "final", "after_heading", "bias"]
INDEX = {name: k for k, name in enumerate(NUMBERS)}
RIGHTS = re.compile(r"©|copyright|all rights reserved", re.I)


def active(page_blocks: list[Block]) -> list[list[int]]:
    """Numbers of the features that each block has."""
    out, n = [], len(page_blocks)
    for k, b in enumerate(page_blocks):
        size = len(b.text)
        on = [INDEX[f"tag:{t}"] for t in b.tags if f"tag:{t}" in INDEX]
        on += [INDEX[f"mean:{m}"] for m in b.means]
        if f"last:{b.last}" in INDEX:
            on.append(INDEX[f"last:{b.last}"])
        on.append(INDEX[f"len:{0 if size < 15 else 1 if size < 40 else 2 if size < 100 else 3 if size < 250 else 4 if size < 800 else 5}"])
        on.append(INDEX[f"link:{0 if b.links < 0.1 else 1 if b.links < 0.6 else 2}"])
        if b.text[-1] in ".!?:;\"')":
            on.append(INDEX["stop"])
        if size < 300 and RIGHTS.search(b.text):
            on.append(INDEX["rights"])
        if b.text.count(". ") + b.text.count(", ") < size / 200:
            on.append(INDEX["few_stops"])
        if k == 0:
            on.append(INDEX["first"])
        if k == n - 1:
            on.append(INDEX["final"])
        if k and page_blocks[k - 1].last in ("h1", "h2", "h3"):
            on.append(INDEX["after_heading"])
        on.append(INDEX["bias"])
        out.append(on)
    return out


class Chain:
    """Weights of label 1 by feature, scores of (label before, label) and of the first label."""

    def __init__(self, weights: np.ndarray, step: np.ndarray, start: np.ndarray):
        self.weights, self.step, self.start = weights, step, start

    def decode(self, feats: list[list[int]]) -> list[int]:
        """The best label sequence (Viterbi)."""
        if not feats:
            return []
        w = self.weights
        (s00, s01), (s10, s11) = self.step.tolist()
        unary = [float(w[f].sum()) for f in feats]
        off, on = float(self.start[0]), float(self.start[1]) + unary[0]
        back = []
        for u in unary[1:]:
            to_off, to_on = (0, 0) if off + s00 >= on + s10 else (1, 0), (0, 0) if off + s01 >= on + s11 else (1, 0)
            back.append((to_off[0], to_on[0]))
            off, on = max(off + s00, on + s10), max(off + s01, on + s11) + u
        label = int(on > off)
        out = [label]
        for b in reversed(back):
            label = b[label]
            out.append(label)
        return out[::-1]


def fit(pages: list[tuple[list[list[int]], list[int]]], steps: int = 250, ridge: float = 1e-4) -> Chain:
    """Maximum-likelihood weights by Adam on forward-backward gradients."""
    pages = [p for p in pages if 0 < len(p[0]) <= TRAIN_BLOCKS]
    n, t_max, dim = len(pages), max(len(p[0]) for p in pages), len(NUMBERS)
    x = np.zeros((n, t_max, dim), np.float32)
    y = np.zeros((n, t_max), np.int64)
    length = np.array([len(p[0]) for p in pages])
    for k, (feats, labels) in enumerate(pages):
        for t, f in enumerate(feats):
            x[k, t, f] = 1
        y[k, :len(labels)] = labels
    mask = np.arange(t_max)[None, :] < length[:, None]
    pair = mask[:, 1:]
    gold_x = x[mask & (y == 1)].sum(axis=0)
    gold_step = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & pair).sum() for b in (0, 1)] for a in (0, 1)], float)
    gold_start = np.array([(y[:, 0] == a).sum() for a in (0, 1)], float)
    theta, m, v = np.zeros(dim + 6), np.zeros(dim + 6), np.zeros(dim + 6)
    total = mask.sum()
    rows = np.arange(n)
    for it in range(1, steps + 1):
        w, step, start = theta[:dim], theta[dim:dim + 4].reshape(2, 2), theta[dim + 4:]
        unary = np.zeros((n, t_max, 2))
        unary[:, :, 1] = x @ w.astype(np.float32)
        alpha, beta = np.zeros((n, t_max, 2)), np.zeros((n, t_max, 2))
        alpha[:, 0] = start + unary[:, 0]
        for t in range(1, t_max):
            alpha[:, t] = np.logaddexp(alpha[:, t - 1, :1] + step[0], alpha[:, t - 1, 1:] + step[1]) + unary[:, t]
        for t in range(t_max - 2, -1, -1):
            z = unary[:, t + 1] + beta[:, t + 1]
            new = np.logaddexp(z[:, :1] + step[:, 0], z[:, 1:] + step[:, 1])
            beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
        log_z = np.logaddexp(alpha[rows, length - 1, 0], alpha[rows, length - 1, 1])
        post = np.exp(alpha + beta - log_z[:, None, None]) * mask[:, :, None]
        e_x = np.tensordot(post[:, :, 1].astype(np.float32), x, axes=([0, 1], [0, 1]))
        z = (unary + beta)[:, 1:]
        e_step = np.array([[(np.exp(alpha[:, :-1, a] + step[a, b] + z[:, :, b] - log_z[:, None]) * pair).sum()
                            for b in (0, 1)] for a in (0, 1)])
        grad = np.concatenate([gold_x - e_x, (gold_step - e_step).ravel(), gold_start - post[:, 0].sum(axis=0)]) / total
        grad -= ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.999 ** it)) + 1e-9)
    return Chain(theta[:dim], theta[dim:dim + 4].reshape(2, 2), theta[dim + 4:])


OTHER_TAGS = frozenset("nav header footer aside form head title button select dialog".split())
OTHER_MEANINGS = frozenset("nav header footer sidebar notice ad form comment social hidden".split())


def own_labels(page_blocks: list[Block]) -> list[int] | None:
    """Labels that a page's article element gives; None for pages without one."""
    if not any("article" in b.tags for b in page_blocks):
        return None
    return [int("article" in b.tags and not (b.tags & OTHER_TAGS) and not (b.means & OTHER_MEANINGS))
            for b in page_blocks]


MAIN_MARK, OTHER_MARK = "\ue000", "\ue001"  # private-use characters


def made_page(paragraphs: list[str], shorts: list[str], rnd: random.Random) -> str:
    """A page that sets the texts in a random layout; each block's text begins with its label's mark."""
    pick = rnd.choice

    def esc(t):
        return html.escape(t)

    def other(tag, n=1, long=False, attrs=""):
        texts = [pick(paragraphs if long or rnd.random() < 0.3 else shorts) for _ in range(n)]
        if tag in ("ul", "ol"):
            inner = "".join(f'<li><a href="#">{OTHER_MARK}{esc(" ".join(t.split()[:3]))}</a></li>' for t in texts)
        else:
            inner = "".join(pick((f"<p>{OTHER_MARK}{esc(t)}</p>", f"<div>{OTHER_MARK}{esc(t)}</div>",
                                  f"<p><a href='#'>{OTHER_MARK}{esc(t)}</a></p>")) for t in texts)
        if n == 1 and rnd.random() < 0.5 and tag not in ("ul", "ol"):
            inner = OTHER_MARK + esc(texts[0])
        return f"<{tag}{' ' + attrs if attrs else ''}>{inner}</{tag}>"

    def named(kind):
        return f'{pick(("class", "id"))}="{pick(MEANINGS[kind].split())}{pick(("", "-box", "-1", " block"))}"'

    def boiler(kind):
        n = rnd.randint(1, 6)
        if kind == "nav":
            return pick((f"<nav>{other('ul', n)}</nav>", other("ul", n, attrs=named("nav")),
                         f"<div {named('nav')}>{other('ul', n)}</div>"))
        tag = {"header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "comment": "section"}.get(kind, "div")
        if kind == "form":
            return f"<form><label>{OTHER_MARK}{esc(pick(shorts))}</label><button>{OTHER_MARK}{esc(pick(shorts).split()[0])}</button></form>"
        plain = tag != "div" and tag != "section" and rnd.random() < 0.4
        return other(pick((tag, "div")) if not plain else tag, n if kind in ("sidebar", "comment") else rnd.randint(1, 2),
                     long=kind in ("comment", "sidebar") and rnd.random() < 0.6, attrs="" if plain else named(kind))

    body = [f"<{pick(('h1', 'h1', 'h2'))}>{MAIN_MARK}{esc(pick(shorts))}</h1>"] if rnd.random() < 0.8 else []
    inner = pick(("p", "p", "p", "div", "mixed"))
    for _ in range(rnd.randint(1, 14)):
        t = MAIN_MARK + esc(pick(paragraphs))
        tag = pick(("p", "p", "p", "blockquote", "h2", "li")) if inner == "mixed" else inner
        body.append(f"<ul><li>{t}</li></ul>" if tag == "li" else f"<{tag}>{t}</{tag}>")
        if rnd.random() < 0.08:
            body.append(boiler(pick(("ad", "notice", "social", "sidebar", "form"))))
    if rnd.random() < 0.25:
        body.append(boiler("comment"))
    box = pick(("article", "article", "main", "div", "div", "section"))
    attrs = "" if box in ("article", "main") or rnd.random() < 0.1 else " " + named("content")
    before = [boiler(k) for k in ("notice", "header", "nav", "ad", "form") if rnd.random() < 0.5]
    after = [boiler(k) for k in ("social", "comment", "sidebar", "form", "ad", "notice", "footer") if rnd.random() < 0.4]
    rnd.shuffle(before)
    title = f"<head><title>{OTHER_MARK}{esc(pick(shorts))}</title></head>" if rnd.random() < 0.8 else ""
    return f"<html>{title}<body>{''.join(before)}<{box}{attrs}>{''.join(body)}</{box}>{''.join(after)}</body></html>"


def marked(page: str) -> tuple[list[Block], list[int]]:
    """Blocks and labels of a made page, marks removed."""
    found, labels = blocks(page), []
    for b in found:
        labels.append(int(MAIN_MARK in b.text))
        b.text = b.text.replace(MAIN_MARK, "").replace(OTHER_MARK, "").strip() or "-"
    return found, labels


def training_set(sample: list[str], made: int = MADE_PAGES, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: the sample's own and the made ones."""
    rnd, own = random.Random(seed), []
    for page in sample:
        found = blocks(page)
        labels = own_labels(found)
        if labels is not None:
            own.append((found, labels))
    words = ["".join(rnd.choices("aeioulnrst", k=rnd.randint(2, 9))) for _ in range(300)]
    lines = [" ".join(rnd.choices(words, k=rnd.randint(4, 90))).capitalize() + "." for _ in range(200)]
    texts = [b.text for found, _ in own for b in found]
    paragraphs = [t for t in texts if len(t) >= 60][:TRAIN_TEXTS] or lines
    shorts = [t for t in texts if 3 <= len(t) < 90][:TRAIN_TEXTS] or [ln[:40] for ln in lines]
    return own + [marked(made_page(paragraphs, shorts, rnd)) for _ in range(made)]


def train(pages: DataFrame, html_col: str = "html", rows: int = TRAIN_PAGES) -> Chain:
    """The chain trained on labelled pages; at most ``rows`` pages reach the driver."""
    share = min(1.0, 4 * rows / max(1, pages.count()))  # four times as many, as copies fall together
    near = pages.select(F.col(html_col).alias("html"), F.xxhash64(html_col).alias("h")).where(F.length("html") <= TRAIN_CHARS).where(
        F.pmod("h", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    sample = near.groupBy("h").agg(F.min("html").alias("html")).orderBy(F.pmod("h", F.lit(1 << 20)), "h").limit(rows)
    texts = sorted(r["html"] for r in sample.collect())
    return fit([(active(b), y) for b, y in training_set(texts)])


def main_text(page: str, chain: Chain) -> str:
    """The main text of a page: its main blocks joined by one space."""
    found = blocks(page)
    return " ".join(b.text for b, y in zip(found, chain.decode(active(found))) if y)


def extract(pages: DataFrame, chain: Chain, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Per row: the id, the url, ``text`` and ``n_chars`` (code points)."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(cols):
        texts = [main_text(p, chain) for p in texts_of(cols["html"])]
        return {id_col: cols["id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return arrow_map(pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                                  F.col(html_col).alias("html")), run,
                     schema_of(f"`{id_col}` {kind}, url string, text string, n_chars long"))
