"""Main text of web pages by a linear-chain conditional random field over the DOM's leaf blocks.

A page becomes the sequence of its text blocks, each with the tags and name tokens of its
ancestors. The field is trained on labelled pages: layouts put together from the texts of a bounded
draw of the pages, with every block's label known from where it was put. Viterbi labels new pages.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.operators.rows import hash_order, smallest
from corpusmap.session import cut_lineage, discard

#: Bound of the pages whose texts make up the training pages, and how many of those are made.
DRAWN, MADE = 200, 400
#: Bytes of the largest page that may be among them.
PAGE_BYTES = 1 << 18

#: Tags that begin and end a block of text; others leave the text running.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose content is never text of the page.
HIDDEN = frozenset("script style head title noscript template textarea svg math iframe object select button canvas audio video".split())
#: Of these, those whose content holds no tags; without an end tag they run to the end of the page.
RAW = frozenset("script style title textarea iframe".split())
#: Block tags that end drawings and formulas.
BREAKOUT = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 hr li menu ol p pre table ul".split())
#: Open tags that a tag closes by itself, up to the nearest listed parent.
CLOSES = {"p": ("p",), "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}
SCOPE = frozenset("ul ol dl table menu article section div body".split())
# a quoted value may hold any character; a quote that never closes counts as a plain one
TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>=\s*+(?:"[^"]*"|'[^']*')|[^<>])*+|[^<>]*+)>|[!?][^>]*>)""", re.DOTALL
)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
KEEP = re.compile(r'data-keep="([01])"')


@dataclass
class Block:
    """Text of a block, how many of its characters stand in links, its innermost tag, the tags and name tokens it stands in."""

    text: str
    linked: int
    own: str
    tags: frozenset[str]
    names: frozenset[str]
    keep: int | None = None


class Ancestors:
    """Open tags from the outermost on, with counts of their tags and names, so that a block costs no walk over them."""

    def __init__(self):
        self.open: list[tuple[str, list[str], int | None]] = []
        self.count: dict[str, int] = {}
        self.named: dict[str, int] = {}
        self.sets: tuple[frozenset[str], frozenset[str]] | None = None

    def add(self, tag: str, names: list[str], keep: int | None) -> None:
        self.open.append((tag, names, keep if keep is not None or not self.open else self.open[-1][2]))
        self.count[tag] = self.count.get(tag, 0) + 1
        for n in names:
            self.named[n] = self.named.get(n, 0) + 1
        self.sets = None

    def cut(self, at: int) -> None:
        """Close all tags from place ``at`` on."""
        for tag, names, _ in self.open[at:]:
            for counts, gone in ((self.count, [tag]), (self.named, names)):
                for key in gone:
                    counts[key] -= 1
                    if not counts[key]:
                        del counts[key]
        del self.open[at:]
        self.sets = None

    def end(self, tag: str) -> None:
        if tag in self.count:
            self.cut(next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag))

    def block(self, text: str, linked: int) -> Block:
        if self.sets is None:
            self.sets = frozenset(self.count), frozenset(self.named)
        own, _, keep = self.open[-1] if self.open else ("", [], None)
        return Block(text, linked, own, *self.sets, keep)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. White space within one is a single space.

    A hidden tag without its end tag ends with the block it stands in; a head also at the body or the first block.
    """
    out: list[Block] = []
    around = Ancestors()
    text: list[str] = []
    links, linked = 0, 0
    hidden: list[tuple[str, list[str]]] = []  # open hidden tags, each with the open tags within it

    def close_block() -> None:
        nonlocal text, linked
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                out.append(around.block(joined, linked))
        text, linked = [], 0

    def still_hidden(name: str, ends: bool, empty: bool) -> bool:
        """Whether a tag stands within hidden ones, which it may open or end."""
        if ends:
            for i in range(len(hidden) - 1, -1, -1):
                if hidden[i][0] == name:
                    del hidden[i:]
                    return True
                if name in hidden[i][1]:
                    del hidden[i + 1 :], hidden[i][1][len(hidden[i][1]) - 1 - hidden[i][1][::-1].index(name) :]
                    return True
            if name in BLOCK and name in around.count:
                hidden.clear()
            return bool(hidden)
        if name == "body" and hidden[0][0] == "head":
            hidden.clear()
        while hidden and (hidden[-1][0] == "head" and name in BLOCK or hidden[-1][0] in ("svg", "math") and name in BREAKOUT and "foreignobject" not in hidden[-1][1]):
            hidden.pop()
        if not hidden:
            return False
        if name in HIDDEN:
            if not empty and not (name == hidden[-1][0] and name in ("button", "select")):
                hidden.append((name, []))
        elif (name in BLOCK or name == "foreignobject") and name not in VOID and not empty:
            hidden[-1][1].append(name)
        return True

    at = 0
    while True:
        m = TAG.search(page, at)
        piece = page[at : m.start() if m else len(page)]
        if piece and not hidden:
            text.append(piece)
            if links:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            continue
        empty = m[0].endswith("/>")
        if name in RAW and not m[1]:
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at) if not empty else None
            at = end.end() if end else (at if empty else len(page))
            continue
        if hidden and still_hidden(name, bool(m[1]), empty):
            continue
        if m[1]:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCK:
                close_block()
                around.end(name)
        elif name in HIDDEN:
            if not empty:
                hidden.append((name, []))
        elif name == "br":
            text.append(" ")
        elif name == "a":
            links = 1
        elif name in BLOCK:
            close_block()
            links = 0
            closes = CLOSES.get(name, ())
            for i in range(len(around.open) - 1, -1, -1) if any(c in around.count for c in closes) else ():
                if around.open[i][0] in closes:
                    around.cut(i)
                    break
                if around.open[i][0] in SCOPE:
                    break
            if name not in VOID:
                keep = KEEP.search(m[3])
                found = [t.lower() for parts in NAMES.findall(m[3]) for t in TOKEN.findall(" ".join(parts))] if m[3] else []
                around.add(name, found, int(keep[1]) if keep else None)
    close_block()
    return out


def _bucket(x: float, steps: tuple[float, ...]) -> int:
    return sum(x >= s for s in steps)


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block."""
    out = []
    for b in page:
        words = b.text.split()
        f = ["bias", f"own={b.own}", f"len={_bucket(len(words), (2, 4, 8, 15, 30, 60))}"]
        f.append(f"links={_bucket(b.linked / len(b.text), (0.1, 0.3, 0.6, 0.9))}")
        f.append(f"mark={b.text[0] in '©®'}")
        f += [f"in={t}" for t in sorted(b.tags) if t not in ("html", "body", "div", "p", "section")]
        f += [f"name={n}" for n in sorted(b.names)]
        out.append(f)
    return out


@dataclass
class Field:
    """Weights of features for the label "main text", and of label pairs."""

    weights: dict[str, float]
    pairs: np.ndarray

    def decode(self, page: list[Block]) -> np.ndarray:
        """The likeliest labels of a page's blocks."""
        get = self.weights.get
        unary = [sum(get(name, 0.0) for name in names) for names in features(page)]
        best, back = (0.0, unary[0]) if unary else (0.0, 0.0), []
        (p00, p01), (p10, p11) = self.pairs.tolist()
        for u in unary[1:]:
            a0, b0, a1, b1 = best[0] + p00, best[1] + p10, best[0] + p01, best[1] + p11
            back.append((a0 < b0, a1 < b1))
            best = (max(a0, b0), max(a1, b1) + u)
        label = np.zeros(len(unary), "?")
        now = best[0] < best[1]
        for i in range(len(unary) - 1, -1, -1):
            label[i] = now
            if i:
                now = back[i - 1][now]
        return label

    def main_text(self, page: str | None) -> str:
        found = blocks(page) if page else []
        return "\n".join(b.text for b, keep in zip(found, self.decode(found)) if keep)


def fit(pages: list[list[Block]], least: int = 2, steps: int = 200, rate: float = 0.1, decay: float = 2e-3) -> Field:
    """Maximise the likelihood of the blocks' labels by forward-backward and Adam, all pages side by side."""
    named = [features(page) for page in pages if page]
    pages = [page for page in pages if page]
    seen: dict[str, int] = {}
    for page in named:
        for name in {n for names in page for n in names}:
            seen[name] = seen.get(name, 0) + 1
    index = {n: i for i, n in enumerate(sorted(n for n, c in seen.items() if c >= least))}
    size, longest = len(pages), max(map(len, pages), default=0)
    rows, columns, owner = [], [], []
    gold, live = np.zeros((size, longest), "i8"), np.zeros((size, longest), "?")
    for p, (page, lists) in enumerate(zip(pages, named)):
        for t, (b, names) in enumerate(zip(page, lists)):
            gold[p, t], live[p, t] = b.keep or 0, True
            at = [index[n] for n in names if n in index]
            columns += at
            owner += [p * longest + t] * len(at)
    columns, owner = np.array(columns, "i8"), np.array(owner, "i8")
    theta = np.zeros(len(index) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    both = live[:, 1:] & live[:, :-1]
    for step in range(1, steps + 1):
        unary = np.bincount(owner, theta[columns], size * longest).reshape(size, longest)
        pairs = theta[-4:].reshape(2, 2)
        score = np.stack([np.zeros_like(unary), unary], axis=2)
        ahead, behind = np.zeros((size, longest, 2)), np.zeros((size, longest, 2))
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            into = np.logaddexp(ahead[:, t - 1, 0, None] + pairs[0], ahead[:, t - 1, 1, None] + pairs[1])
            ahead[:, t] = np.where(live[:, t, None], into + score[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            onward = behind[:, t + 1] + score[:, t + 1]
            out = np.logaddexp(onward[:, 0, None] + pairs[:, 0], onward[:, 1, None] + pairs[:, 1])
            behind[:, t] = np.where(live[:, t + 1, None], out, behind[:, t + 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        one = np.where(live, np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]), 0.0)
        error = np.where(live, gold - one, 0.0)
        gradient = np.zeros_like(theta)
        gradient[:-4] = np.bincount(columns, error.ravel()[owner], len(index))
        for a in (0, 1):
            for b in (0, 1):
                expected = np.exp(ahead[:, :-1, a] + pairs[a, b] + score[:, 1:, b] + behind[:, 1:, b] - total[:, None])
                gradient[len(index) + 2 * a + b] = ((gold[:, :-1] == a) & (gold[:, 1:] == b) & both).sum() - expected[both].sum()
        gradient = gradient / max(size, 1) - decay * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field({n: float(theta[i]) for n, i in index.items()}, theta[-4:].reshape(2, 2).copy())


def labelled_pages(texts: list[str], count: int = MADE, seed: int = 0) -> list[str]:
    """Pages in varied layouts, every part marked as main text or not.

    ``texts`` are paragraphs; headings, menus and notices are made of their words.
    """
    random = np.random.default_rng(seed)
    texts = texts or ["One sentence of a page, with some more words to fill it.", "Another one that is longer, and goes on for a little while before it ends."]
    pick = lambda *options: options[random.integers(len(options))]
    para = lambda: texts[random.integers(len(texts))]
    words = lambda n: " ".join(para().split()[:n]) or "more"
    esc = entities.escape

    def some(low: int, high: int, make) -> str:
        return "".join(make() for _ in range(random.integers(low, high + 1)))

    def paragraphs(low: int, high: int) -> str:
        p = lambda: pick(f"<p>{esc(para())}</p>", f"<p>{esc(para())}</p>", f"<p><b>{esc(para())}<br>", f"<div>{esc(para())}</div>", f"<p>{esc(words(random.integers(1, 6)))}.</p>")
        return some(low, high, p)

    def links(low: int, high: int) -> str:
        return "<ul>" + some(low, high, lambda: f'<li><a href="/{random.integers(99)}">{esc(words(random.integers(1, 4)))}</a></li>') + "</ul>"

    def menu() -> str:
        tag, name = pick(("nav", ""), ("nav", "main-nav"), ("div", "menu"), ("div", "navbar top-navigation"), ("ul", "breadcrumb"), ("div", "toolbar"))
        return f'<{tag} data-keep="0" class="{name}">{links(3, 8)}</{tag}>'

    def header() -> str:
        tag, name = pick(("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("div", "banner"))
        return f'<{tag} data-keep="0" id="{name}">{pick("<h1>", "<p>", "<div>")}{esc(words(4))}{pick(menu(), "", "")}</{tag}>'

    def advert() -> str:
        name = pick("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad")
        tag = pick("div", "aside", "section")
        return f'<{tag} data-keep="0" class="{name}">{pick(esc(para()), f"<p>{esc(words(9))}</p>", esc(words(5)))}</{tag}>'

    def notice() -> str:
        name = pick("cookie-notice", "cookie-banner", "consent", "notice", "popup modal", "newsletter", "alert", "gdpr", "subscribe", "disclaimer")
        return f'<div data-keep="0" {pick("id", "class")}="{name}"><p>{esc(para())}</p>{pick("<button>OK</button>", "")}</div>'

    def sidebar() -> str:
        tag, name = pick(("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget related"), ("section", "recommended"), ("div", "share social"), ("div", "related-posts"))
        return f'<{tag} data-keep="0" class="{name}"><h3>{esc(words(3))}</h3>{pick(links(2, 6), paragraphs(1, 2))}</{tag}>'

    def form() -> str:
        return f'<form data-keep="0" class="{pick("", "search", "login", "contact-form")}"><label>{esc(words(3))}</label><input><p>{esc(words(8))}</p></form>'

    def comments() -> str:
        tag, name = pick(("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("div", "respond replies"), ("ol", "commentlist"), ("div", "disqus-thread discussion"))
        one = lambda: pick(f'<div class="comment"><p>{esc(words(2))}</p><p>{esc(para())}</p></div>', f"<p>{esc(para())}</p>", f'<li class="comment">{esc(para())}</li>', f'<article class="comment"><p>{esc(para())}</p></article>')
        return f'<{tag} data-keep="0" {pick("id", "class")}="{name}">{pick(f"<h3>{esc(words(2))}</h3>", "")}{some(1, 4, one)}</{tag}>'

    def footer() -> str:
        tag, name = pick(("footer", ""), ("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright"))
        return f'<{tag} data-keep="0" class="{name}">{pick("&copy; ", "")}{esc(words(2))} {pick("&middot; ", "")}{esc(pick(words(6), para()))}{pick("", links(2, 4))}</{tag}>'

    def main() -> str:
        tag, name = pick(("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "post-content"), ("div", "entry-content"), ("div", "story"), ("section", "main-content"), ("td", "content"))
        inside = lambda: pick("", "", advert(), sidebar(), notice())
        more = lambda: pick("", "", "", f"<ul>{some(1, 4, lambda: f'<li>{esc(para())}</li>')}</ul>", f"<blockquote>{esc(para())}</blockquote>", f"<h2>{esc(words(5))}</h2>", f"<table><tr><td>{esc(words(3))}</td><td>{esc(words(4))}</td></tr></table>", f"<pre>{esc(para())}</pre>")
        head = pick(f"<h1>{esc(words(8))}</h1>", f"<h1>{esc(words(8))}</h1>", f"<header><h1>{esc(words(8))}</h1></header>", "")
        return f'<{tag} data-keep="1" class="{name}">{head}{paragraphs(1, 6)}{inside()}{more()}{paragraphs(0, 6)}{pick("", "", comments())}</{tag}>'

    made = []
    for _ in range(count):
        before = [f for f in (notice, header, menu, advert, form) if random.random() < 0.45]
        after = [f for f in (advert, sidebar, comments, form, notice) if random.random() < 0.4]
        random.shuffle(before)
        random.shuffle(after)
        wrap = pick(("", ""), ("", ""), ("<div class='wrapper'>", "</div>"), ("<div id='page'><div class='container'>", "</div></div>"))
        made.append("<html><body>" + wrap[0] + "".join(f() for f in before) + main() + "".join(f() for f in after) + footer() + wrap[1] + "</body></html>")
    return made


def train(pages: DataFrame, html_col: str = "html", drawn: int = DRAWN, made: int = MADE) -> Field:
    """A field trained on layouts with the texts of at most ``drawn`` different pages, drawn by hash of the page.

    Pages of over ``PAGE_BYTES`` are not drawn, so what the driver gets has a bound; copies count once.
    """
    rows = pages.select(F.col(html_col).cast("string").alias("html")).filter(F.octet_length("html") <= PAGE_BYTES).withColumn("k", F.xxhash64("html"))
    keys = cut_lineage(rows.select("k").distinct())
    chosen = [r.k for r in smallest(keys, drawn, hash_order("k")).collect()]
    discard(keys)
    sample = [r.html for r in rows.filter(F.col("k").isin(chosen)).dropDuplicates(["k"]).collect()] if chosen else []
    texts = sorted({b.text for page in sample for b in blocks(page) if len(b.text) >= 20 and b.linked < len(b.text) / 2})
    return fit([blocks(page) for page in labelled_pages(texts, made)])


def extract_text(spark, field: Field, html: Column) -> Column:
    """Main text of each whole page: its blocks joined by line feeds, character references decoded.

    Null and empty pages and pages without text give the empty string. Rows are judged alone.
    """
    held = spark.sparkContext.broadcast(field)

    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([held.value.main_text(page.as_py()) for page in batch], pa.string())

    return run(html.cast("string"))
