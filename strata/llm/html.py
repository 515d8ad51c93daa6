"""Main text of web pages: a linear-chain CRF over DOM leaf blocks.

A page is read into leaf blocks, the runs of text between borders of block
elements, each with its ancestors.  Features are ancestor tags, words of
ancestor classes and ids, and shape of the text; the two labels are main text
and the rest.  Weights are fitted by maximum likelihood (forward-backward) on
labelled pages, and pages are decoded by Viterbi.

Labelled pages: a bounded sample of the pages whose HTML5 landmarks say what
is main text, and for each of them ``variants`` pages made of its own blocks
under other layouts (classes instead of landmarks; menus, notices, adverts,
forms, side columns and reader comments around and inside the article), each
block labelled where it is made.

A null page is empty; a page without main blocks gives the empty text; null
ids and urls are kept; repeated rows are read each; unclosed or unbalanced
markup is read as browsers do in the main cases (implied ends, also of a head
by the first tag or text that can't stand in it; ignored stray ends).  A page of
any length is read whole, in time that grows with its length.  An empty table
gives no rows; extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.store import hashed_sample

SAMPLE_PAGES = 160
VARIANTS = 6

_RAW = "script|style|noscript|template|svg|textarea|select|iframe|object|canvas"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>|<title\b[^>]*>(?:(?!<title\b).)*?</title\s*>"
    rf"|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    # a quote delimits a value only behind an equals sign
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9-]*)(?P<attrs>(?:[^>=]|=(?!\s*[\"'])|=\s*\"[^\"]*\"|=\s*'[^']*')*)>"
    r"|<[!?/a-zA-Z][^>]*>", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
#: A start tag on the left ends an open element on the right, within the nearest list, table or section.
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table body html div section article aside nav form main".split())
#: What may stand in a head; any other start tag ends it.
_IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes script style template".split())
_UNSEEN = frozenset("head title button option".split())
#: Elements nested deeper than this don't open a further one, as in browsers; so time grows with the page alone.
MAX_DEPTH = 512
_LANDMARK_OUT = frozenset("nav footer aside form header menu dialog".split())


class Block:
    """A leaf block: text, ancestors (tag, class words) and characters in links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; text is decoded, white space single."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple, str]] = []  # tag, words of class, id and role, annotation
    parts: list[str] = []
    linked = 0
    links = hidden = 0
    path: tuple | None = None
    opened: Counter[str] = Counter()
    skipped: Counter[str] = Counter()  # elements beyond the depth, whose ends are no one else's

    def flush() -> None:
        nonlocal linked, path
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, path if path is not None else tuple(stack), linked))
            parts.clear()
        linked, path = 0, None

    def pop() -> str:
        nonlocal links, hidden
        tag = stack.pop()[0]
        opened[tag] -= 1
        links -= tag == "a"
        hidden -= tag in _UNSEEN
        return tag

    at = 0
    # nothing behind the last '>' is a tag, and looking for its end from every '<' would take long
    for m in [*_TOKEN.finditer(page, 0, page.rfind(">") + 1), None]:
        end = m.start() if m else len(page)
        if hidden and end > at and stack[-1][0] == "head" and page[at:end].strip():
            pop()
        if end > at and not hidden:
            run = page[at:end]
            if "&" in run:
                run = entities.unescape(run)
            if path is None and run.strip():
                path = tuple(stack)
            parts.append(run)
            if links:
                linked += len(run.strip())
        if m is None:
            break
        at = m.end()
        tag = (m.group("tag") or "").lower()
        if not tag:
            continue
        if m.group("end"):
            if skipped[tag]:
                skipped[tag] -= 1
            elif opened[tag]:
                if tag not in INLINE:
                    flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag == "p":
                flush()
            continue
        if hidden and tag not in _IN_HEAD and opened["head"]:
            while pop() != "head":
                pass
        if tag == "br":
            parts.append(" ")
        if tag not in INLINE:
            flush()
            if opened["p"]:  # a block element ends an open paragraph
                k = max(i for i, s in enumerate(stack) if s[0] == "p")
                if not any(s[0] in _SCOPE for s in stack[k + 1 :]):
                    while len(stack) > k:
                        pop()
            for other in [t for t in IMPLIED.get(tag, ()) if opened[t]]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == other:
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i][0] in _SCOPE:
                        break
        if tag in VOID:
            continue
        words: tuple = ()
        note = ""
        attrs = m.group("attrs")
        if "=" in attrs:
            for name, *value in _ATTR.findall(attrs):
                name = name.lower()
                if name in ("class", "id", "role"):
                    words += tuple(_WORD.findall("".join(value).lower()))
                elif name == "data-y":
                    note = "".join(value)
        if len(stack) >= MAX_DEPTH:
            skipped[tag] += 1
        elif not attrs.rstrip().endswith("/") or tag not in ("path", "circle"):
            opened[tag] += 1
            stack.append((tag, words, note))
            links += tag == "a"
            hidden += tag in _UNSEEN
    flush()
    return blocks


def _bucket(n: float, edges: tuple) -> int:
    return sum(n >= e for e in edges)


def features(blocks: list[Block]) -> list[tuple[str, ...]]:
    """Feature names of each block."""
    out = []
    paths: dict[tuple, tuple] = {}
    n = len(blocks)
    for k, b in enumerate(blocks):
        of_path = paths.get(b.path)
        if of_path is None:
            tags = [s[0] for s in b.path if s[0] not in ("html", "body")]
            blocky = [t for t in tags if t not in INLINE]
            of_path = paths[b.path] = (
                "bias", *{f"t:{t}" for t in tags}, *{f"c:{w}" for s in b.path if s[0] not in ("html", "body") for w in s[1]},
                f"leaf:{blocky[-1] if blocky else 'none'}", f"depth:{min(6, len(blocky))}")
        t = b.text
        length = len(t)
        letters = sum(map(str.isalpha, t))
        out.append(of_path + (
            f"len:{_bucket(length, (12, 25, 50, 100, 200, 400))}",
            f"link:{_bucket(b.linked / length, (0.05, 0.33, 0.8))}",
            f"stop:{t[-1] in '.!?:;…'}",
            f"alpha:{_bucket(letters / length, (0.3, 0.6, 0.8))}",
            f"copy:{'©' in t}", f"bars:{'|' in t or '»' in t or '·' in t}",
            f"place:{_bucket(k / n, (0.1, 0.3, 0.7, 0.9))}", f"first:{k == 0}", f"last:{k == n - 1}"))
    return out


class Model:
    """Weights of features for "main", and of label changes."""

    def __init__(self, weights: dict[str, float], change: list[list[float]], start: list[float]):
        self.weights, self.change, self.start = weights, change, start

    def decode(self, rows: list[tuple[str, ...]]) -> list[int]:
        """The likeliest labels of a page's blocks (Viterbi)."""
        w, c = self.weights, self.change
        get = w.get
        a, b = self.start
        back = []
        for k, row in enumerate(rows):
            e = sum([get(f, 0.0) for f in row])
            if k:
                a0, a1, b0, b1 = a + c[0][0], b + c[1][0], a + c[0][1], b + c[1][1]
                back.append((int(a1 > a0), int(b1 > b0)))
                a, b = max(a0, a1), max(b0, b1)
            b += e
        if not rows:
            return []
        y = [int(b > a)]
        for p in reversed(back):
            y.append(p[y[-1]])
        return y[::-1]


def fit(pages: list[tuple[list[tuple[str, ...]], list[int]]], epochs: int = 25, l2: float = 1e-4, seed: int = 3) -> Model:
    """Maximum likelihood by Adagrad over pages, gradients by forward-backward."""
    pages = [p for p in pages if p[0]]
    index = {f: i for i, f in enumerate(sorted({f for rows, _ in pages for r in rows for f in r}))}
    data = [([np.array([index[f] for f in r]) for r in rows], np.array(y)) for rows, y in pages]
    w, change, start = np.zeros(len(index)), np.zeros((2, 2)), np.zeros(2)
    hw, hc, hs = np.full_like(w, 1e-3), np.full_like(change, 1e-3), np.full_like(start, 1e-3)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for p in rng.permutation(len(data)):
            rows, y = data[p]
            n = len(rows)
            emit = np.array([w[r].sum() for r in rows])
            fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
            fwd[0] = start + (0, emit[0])
            for k in range(1, n):
                s = fwd[k - 1][:, None] + change
                top = s.max(axis=0)
                fwd[k] = top + np.log(np.exp(s - top).sum(axis=0)) + (0, emit[k])
            for k in range(n - 2, -1, -1):
                s = change + (bwd[k + 1] + (0, emit[k + 1]))[None]
                top = s.max(axis=1)
                bwd[k] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
            z = np.logaddexp(*fwd[-1])
            q = np.exp(fwd + bwd - z)
            gw = l2 * w
            for k, r in enumerate(rows):
                gw[r] += q[k, 1] - y[k]
            gc = l2 * change
            if n > 1:
                into = bwd[1:] + np.stack([np.zeros(n - 1), emit[1:]], axis=1)
                gc = gc + np.exp(fwd[:-1, :, None] + change[None] + into[:, None, :] - z).sum(axis=0)
                np.add.at(gc, (y[:-1], y[1:]), -1)
            gs = q[0].copy()
            gs[y[0]] -= 1
            for v, g, h in ((w, gw, hw), (change, gc, hc), (start, gs, hs)):
                h += g * g
                v -= 0.3 * g / np.sqrt(h)
    return Model({f: float(w[i]) for f, i in index.items()}, change.tolist(), start.tolist())


def landmark_labels(blocks: list[Block]) -> list[int] | None:
    """Labels that HTML5 landmarks give; None for a page without an article or main."""
    if not any(s[0] in ("article", "main") for b in blocks for s in b.path):
        return None
    out = []
    for b in blocks:
        tags = [s[0] for s in b.path]
        inside = [i for i, t in enumerate(tags) if t in ("article", "main")]
        outer = any(t in _LANDMARK_OUT - {"header"} for t in tags) or any(_BOILERPLATE & set(s[1]) for s in b.path if s[0] not in ("html", "body"))
        out.append(int(bool(inside) and not outer))
    return out


_BOILERPLATE = frozenset("ad ads advert sidebar comments comment notice cookie promo related newsletter share".split())
_LAYOUTS = {  # what stands around and inside an article, with the names that pages commonly give it
    "menu": ('<nav>{}</nav>', '<div class="menu">{}</div>', '<div id="navigation">{}</div>', '<ul class="nav">{}</ul>', '<div class="breadcrumb">{}</div>', '<div role="navigation">{}</div>'),
    "header": ('<header>{}</header>', '<div class="header">{}</div>', '<div id="masthead">{}</div>', '<div class="site-header"><h2>{}</h2></div>', '<div role="banner">{}</div>'),
    "notice": ('<div class="cookie-notice"><p>{}</p></div>', '<div class="notice">{}</div>', '<div id="consent"><p>{}</p></div>', '<div class="alert"><p>{}</p></div>', '<div class="banner">{}</div>', '<div class="disclaimer"><p>{}</p></div>'),
    "advert": ('<div class="ad">{}</div>', '<div class="advertisement"><p>{}</p></div>', '<div class="promo"><p>{}</p></div>', '<div class="sponsored">{}</div>', '<aside class="ads"><p>{}</p></aside>', '<div id="ad-top"><p>{}</p></div>', '<section class="advert"><p>{}</p></section>'),
    "side": ('<aside>{}</aside>', '<aside><p>{}</p></aside>', '<div class="sidebar"><p>{}</p></div>', '<div id="sidebar"><ul><li>{}</li></ul></div>', '<div class="related"><h3>{}</h3></div>', '<div class="widget"><p>{}</p></div>', '<div role="complementary"><p>{}</p></div>'),
    "form": ('<form><label>{}</label><input></form>', '<form class="search"><p>{}</p></form>', '<div class="newsletter"><p>{}</p></div>', '<div class="subscribe"><p>{}</p></div>', '<form><fieldset><legend>{}</legend></fieldset></form>', '<div class="login">{}</div>'),
    "comments": ('<section class="comments"><h3>{}</h3><p>{}</p></section>', '<div id="comments"><div class="comment"><p>{}</p></div></div>', '<ul class="comment-list"><li><p>{}</p></li></ul>', '<div class="replies"><p>{}</p></div>', '<ol class="comments"><li>{}</li></ol>', '<section id="reader-comments"><article class="comment"><p>{}</p></article></section>'),
    "footer": ('<footer>{}</footer>', '<footer><p>{}</p></footer>', '<div class="footer">{}</div>', '<div id="footer"><p>{}</p></div>', '<div class="copyright">{}</div>', '<div role="contentinfo">{}</div>'),
    "share": ('<div class="share">{}</div>', '<ul class="social"><li>{}</li></ul>', '<div class="tags">{}</div>', '<div class="author-bio"><p>{}</p></div>'),
}
_HOSTS = ('<article>{}</article>', '<main>{}</main>', '<main><article>{}</article></main>', '<div class="content">{}</div>', '<div id="content">{}</div>', '<div class="post">{}</div>', '<div class="entry-content">{}</div>', '<div class="article-body">{}</div>', '<section class="story">{}</section>', '<div id="main"><div class="text">{}</div></div>', '<div>{}</div>', '<article class="post"><div class="body">{}</div></article>')


def inset(text: str, rng: random.Random) -> str:
    """What an article holds beside paragraphs: a table, a list of links, code, a figure, terms or a short line."""
    words = [entities.escape(w) for w in text.split()] or ["x"]
    few = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    cell = lambda: few() if rng.random() < 0.6 else str(rng.randint(0, 99_999))
    kind = rng.randrange(6)
    if kind == 0:
        rows = ["<tr>" + "".join(f"<{c}>{cell()}</{c}>" for c in (rng.choice(("td", "th")), "td", "td")) + "</tr>" for _ in range(rng.randint(1, 4))]
        return f"<table>{''.join(rows)}</table>"
    if kind == 1:
        tag = rng.choice(("ul", "ol"))
        return f"<{tag}>" + "".join(f'<li><a href="/x">{few()}</a></li>' if rng.random() < 0.6 else f"<li>{few()}</li>" for _ in range(rng.randint(1, 4))) + f"</{tag}>"
    if kind == 2:
        return f"<pre>{few()}</pre>" if rng.random() < 0.5 else f"<pre><code>{few()} = {cell()}</code></pre>"
    if kind == 3:
        return f'<figure><img src="/x"><figcaption>{few()}</figcaption></figure>'
    if kind == 4:
        return "<dl>" + "".join(f"<dt>{few()}</dt><dd>{cell()}</dd>" for _ in range(rng.randint(1, 3))) + "</dl>"
    return rng.choice(("<p>{}</p>", "<h3>{}</h3>", "<p><a href='/x'>{}</a></p>", "<blockquote>{}</blockquote>")).format(few())


def variant(main: list[str], other: list[str], rng: random.Random) -> str:
    """A labelled page of main blocks and other texts; data-y holds the labels."""
    esc = entities.escape

    def piece(kind: str) -> str:
        form = rng.choice(_LAYOUTS[kind])
        texts = [rng.choice(other + main[:1] if kind != "comments" else other + main) for _ in range(form.count("{}"))]
        if kind in ("menu", "share"):
            texts = ["".join(f'<a href="#">{esc(w)}</a> ' if rng.random() < 0.9 else f"<li><a href='/x'>{esc(w)}</a></li>" for w in texts[0].split()[: rng.randint(2, 7)])]
        elif kind == "comments":
            texts = [esc(t) for t in texts]
        else:
            texts = [esc(" ".join(t.split()[: rng.randint(3, 40)])) for t in texts]
            if kind == "footer" and rng.random() < 0.6:
                texts[0] = "&copy; " + texts[0]
        return f'<div data-y="0">{form.format(*texts)}</div>' if rng.random() < 0.5 else form.format(*texts).replace(">", ' data-y="0">', 1)

    body = []
    for k, t in enumerate(main):
        tag = ("h1" if k == 0 and rng.random() < 0.6 else rng.choice(("p", "p", "p", "p", "p", "p", "div", "li", "h2", "blockquote")))
        text = esc(t)
        if rng.random() < 0.15:
            text = f"<b>{text}</b>"
        if rng.random() < 0.15:
            words = text.split(" ")
            i = rng.randrange(len(words))
            words[i] = f'<a href="/x">{words[i]}</a>'
            text = " ".join(words)
        body.append(f"<{tag}>{text}</{tag}>")
        if rng.random() < 0.2:
            body.append(inset(t, rng))
    inner = []
    for b in body:
        inner.append(b)
        if rng.random() < 0.15:
            inner.append(piece(rng.choice(("advert", "side", "notice", "form", "share"))))
    if rng.random() < 0.2:
        inner.append(piece("comments"))
    host = rng.choice(_HOSTS).replace(">", ' data-y="1">', 1).format("".join(inner))
    before = [piece(k) for k in ("notice", "header", "menu", "advert", "form") if rng.random() < 0.55]
    after = [piece(k) for k in ("share", "side", "comments", "advert", "menu", "form") if rng.random() < 0.4]
    return "<html><body>" + "".join(before) + host + "".join(after) + (piece("footer") if rng.random() < 0.8 else "") + "</body></html>"


def _noted(blocks: list[Block]) -> list[int]:
    return [int(next((s[2] for s in reversed(b.path) if s[2]), "0")) for b in blocks]


def training_pages(pages: list[str], variants: int = VARIANTS, seed: int = 17) -> list[tuple[list[tuple[str, ...]], list[int]]]:
    """Labelled pages: those with landmarks as they are, and their variants."""
    rng = random.Random(seed)
    out, mains, others = [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        labels = landmark_labels(blocks)
        if labels is None:
            continue
        out.append((features(blocks), labels))
        main = [b.text for b, y in zip(blocks, labels) if y][:12]
        if main:
            mains.append(main)
        others += [b.text for b, y in zip(blocks, labels) if not y]
    others = others or [t for m in mains for t in m]
    for main in mains:
        for _ in range(variants):
            near = rng.sample(others, min(len(others), 12)) + [t for m in rng.sample(mains, min(3, len(mains))) for t in m[:3]]
            blocks = leaf_blocks(variant(main, near, rng))
            out.append((features(blocks), _noted(blocks)))
    return out


def main_text(page: str, model: Model) -> str:
    """The main blocks of a page, joined by blank lines."""
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, y in zip(blocks, model.decode(features(blocks))) if y)


#: Texts for pages of our own, for tables none of whose pages says what its main text is.
OWN_MAIN = (
    "The river rose overnight and took the lower bridge with it.", "People in the valley had been told to expect rain, but not this much of it.",
    "By noon the water stood at the doors of the mill.", "Three boats were sent out; two of them came back before dark.", "What the flood left",
    "Nobody was hurt, though many lost a good part of their harvest, and the school will stay closed until the end of the month.",
    "The council met in the church and agreed on a plan for a new bridge, higher and of stone.", "Work begins in spring.")
OWN_OTHER = (
    "Home News Weather Sport Archive Contact", "Sign up for our letter", "All rights reserved", "We use cookies to make this site better. Accept or change your settings.",
    "Buy two and get the third for free until Sunday", "Most read today", "Leave a reply", "Share this page with your friends", "Log in or register to comment", "Terms and privacy")


def train(pages: DataFrame, sample: int = SAMPLE_PAGES, max_chars: int = 200_000, own: bool = False) -> Model:
    """Fit on a bounded sample: ``sample`` pages with landmark tags, of at most ``max_chars`` characters, by a hash of the page id.

    Without a labelled page a table that holds pages raises, or with ``own`` the
    model is fitted on layouts of texts of this module.  For an empty table the
    model holds nothing.
    """
    fit_for = pages.where(F.length("html").between(1, max_chars) & F.col("html").rlike(r"(?i)<(article|main)[\s/>]")).select("page_id", "html")
    rows = hashed_sample(fit_for, "page_id", sample, fit_for.count(), 1).collect()
    labelled = training_pages([r["html"] for r in rows])
    if not labelled and not pages.where(F.length("html") > 0).isEmpty():
        if not own:
            raise ValueError("no sampled page has an article or main element to learn from")
        around = "".join(f"<p>{t}</p>" for t in OWN_OTHER)
        bodies = ["".join(f"<p>{t}</p>" for t in OWN_MAIN[k:] + OWN_MAIN[:k][: 8 - 2 * k]) for k in range(4)]
        labelled = training_pages([f"<html><body><aside>{around}</aside><article>{body}</article></body></html>" for body in bodies], variants=80)
    return fit(labelled)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", shared.value) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, train(pages, own=True))
