"""Main text of web pages: a recurrent network labels the blocks of a page in their order."""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailscope.llm.tokens import small_groups

#: Pages the network is fitted on at most, the longest that are taken (in characters), and the units of each direction.
TRAIN_PAGES, TRAIN_CHARS, UNITS = 240, 200_000, 16
PATH, WORDS, MORE = 160, 16, 6
WIDTH = PATH + WORDS + MORE

# Element names of the HTML standard.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea svg math iframe object".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}}
SELF_CLOSING |= {"td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^<>]*>|<\?[^<>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
PARTS = re.compile(r"[a-z0-9]+")


# Names of elements and classes within an article that are not its text, for the labels of the fit.
ASIDE = frozenset(
    "form nav aside footer .comment .comments .disqus .ad .ads .advert .banner .sponsored .promo .share .social "
    ".related .newsletter .subscribe .sidebar .widget .menu".split()
)


@dataclass
class Block:
    path: np.ndarray  # which hashed names are around it
    leaf: str  # last name of its own element
    main: bool  # in an article, and not in something aside there
    text: str
    linked: int


class _Around:
    """The open elements: what each adds is taken away when it closes, so no block looks at all of them."""

    def __init__(self):
        self.stack: list[tuple[str, list[str]]] = []
        self.open: Counter[str] = Counter()
        self.slots = np.zeros(PATH, np.int64)
        self.articles = self.asides = 0

    def _count(self, tag: str, names: list[str], by: int) -> None:
        self.open[tag] += by
        for name in names:
            self.slots[crc32(name.encode()) % PATH] += by
        self.articles += by * (tag == "article")
        self.asides += by * any(n in ASIDE for n in names)

    def push(self, tag: str, names: list[str]) -> None:
        self.stack.append((tag, names))
        self._count(tag, names, 1)

    def pop(self) -> str:
        tag, names = self.stack.pop()
        self._count(tag, names, -1)
        return tag

    def end(self, tag: str) -> None:
        """Close up to the last element of this name, if there is one."""
        if self.open[tag]:
            while self.pop() != tag:
                pass

    def block(self, text: str, linked: int) -> Block:
        leaf = self.stack[-1][1][-1] if self.stack else ""
        return Block(self.slots > 0, leaf, self.articles > 0 and not self.asides, text, linked)


def blocks_of(page: str) -> list[Block]:
    """The page's runs of text between block-level tags, with names of the elements around them.

    Scripts, styles and the like give no block; white space becomes one space and
    references are decoded. Broken markup is taken as it comes, in one pass: an end tag
    closes up to its start tag, or nothing, and a tag that is broken off by another is text.
    """
    out: list[Block] = []
    around = _Around()
    held: list[str] = []
    linked = at = links = 0

    def close() -> None:
        nonlocal linked
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                out.append(around.block(text, linked))
            held.clear()
        linked = 0

    while True:
        found = TOKEN.search(page, at)
        piece = page[at : found.start()] if found else page[at:]
        if piece:
            held.append(piece)
            linked += len(piece) if links else 0
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in RAW:
            if not found[1] and not found[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in INLINE:
            held.append(" " if tag == "br" else "")
            links = max(0, links + (-1 if found[1] else 1)) if tag == "a" else links
            continue
        close()
        links = 0
        if found[1]:
            around.end(tag)
        elif tag in VOID or found[3].endswith("/"):
            continue
        else:
            while around.stack and around.stack[-1][0] in SELF_CLOSING.get(tag, ()):
                around.pop()
            names = [tag]
            for value in NAMED.findall(found[3]):
                names += ["." + n for n in PARTS.findall("".join(value).lower())]
            around.push(tag, names)
    close()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: hashed names of its path, hashed words (all of them), and shape."""
    x = np.zeros((len(blocks), WIDTH))
    for i, b in enumerate(blocks):
        x[i, :PATH] = b.path
        if b.leaf:
            x[i, crc32(b"leaf " + b.leaf.encode()) % PATH] += 1
        words = b.text.lower().encode().split(b" ")
        kinds = np.bincount([crc32(w) % WORDS for w in words], minlength=WORDS)
        x[i, PATH : PATH + WORDS] = kinds / len(words)
        n = len(b.text)
        stops = sum(b.text.count(c) for c in ".,;:!?")
        x[i, -MORE:] = np.log1p(n) / 5, np.log1p(len(words)) / 4, min(1, b.linked / n), stops / n, i == 0, 1
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _reverse(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each lane's first ``size`` steps in reverse order, padding left where it is; x is [step, lane, ...]."""
    step = np.arange(len(x))[:, None]
    at = np.where(step < sizes, sizes - 1 - step, step)
    return x[at, np.arange(x.shape[1])[None, :]]


class Network:
    """A bidirectional LSTM with a logistic output per step; plain numpy."""

    def __init__(self, units: int = UNITS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.units = units
        self.p = {}
        for d in "fb":
            self.p[d + "x"] = rng.normal(0, 0.1, (WIDTH, 4 * units))
            self.p[d + "h"] = rng.normal(0, 0.1, (units, 4 * units))
            bias = np.zeros(4 * units)
            bias[units : 2 * units] = 1  # remember at first
            self.p[d + "c"] = bias
        self.p["out"] = rng.normal(0, 0.1, 2 * units)
        self.p["bias"] = np.zeros(1)

    def _run(self, d: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        u, steps, lanes = self.units, len(x), x.shape[1]
        given = x @ self.p[d + "x"] + self.p[d + "c"]
        h = c = np.zeros((lanes, u))
        out = np.empty((steps, lanes, u))
        for t in range(steps):
            z = given[t] + h @ self.p[d + "h"]
            gates = _sigmoid(z[:, : 3 * u])
            i, f, o, g = gates[:, :u], gates[:, u : 2 * u], gates[:, 2 * u :], np.tanh(z[:, 3 * u :])
            before, last = c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            out[t] = h
            if keep is not None:
                keep.append((i, f, o, g, before, last, c))
        return out

    def odds(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log-odds of main text; x is [step, lane, feature]."""
        forth = self._run("f", x)
        back = _reverse(self._run("b", _reverse(x, sizes)), sizes)
        return np.concatenate([forth, back], axis=2) @ self.p["out"] + self.p["bias"][0]

    def _back(self, d: str, x: np.ndarray, kept: list, slope: np.ndarray, grad: dict) -> None:
        u = self.units
        dh, dc = np.zeros_like(slope[0]), np.zeros_like(slope[0])
        dz = np.empty((*slope.shape[:2], 4 * u))
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, before, last, c = kept[t]
            dh = dh + slope[t]
            tc = np.tanh(c)
            dc = dc + dh * o * (1 - tc * tc)
            dz[t, :, :u] = dc * g * i * (1 - i)
            dz[t, :, u : 2 * u] = dc * before * f * (1 - f)
            dz[t, :, 2 * u : 3 * u] = dh * tc * o * (1 - o)
            dz[t, :, 3 * u :] = dc * i * (1 - g * g)
            grad[d + "h"] += last.T @ dz[t]
            dc = dc * f
            dh = dz[t] @ self.p[d + "h"].T
        grad[d + "x"] += np.tensordot(x, dz, ((0, 1), (0, 1)))
        grad[d + "c"] += dz.sum(axis=(0, 1))

    def gradient(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> dict:
        real = np.arange(len(x))[:, None] < sizes
        kf, kb = [], []
        xb = _reverse(x, sizes)
        forth = self._run("f", x, kf)
        back = _reverse(self._run("b", xb, kb), sizes)
        both = np.concatenate([forth, back], axis=2)
        miss = (y - _sigmoid(both @ self.p["out"] + self.p["bias"][0])) * real / real.sum()
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["out"] = np.tensordot(miss, both, ((0, 1), (0, 1)))
        grad["bias"] = np.array([miss.sum()])
        slope = miss[:, :, None] * self.p["out"]
        u = self.units
        self._back("f", x, kf, slope[:, :, :u], grad)
        self._back("b", xb, kb, _reverse(slope[:, :, u:], sizes), grad)
        return grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.02, lanes: int = 32):
        rng = np.random.default_rng(11)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        k = 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for start in range(0, len(order), lanes):
                x, sizes = _lanes([pages[i][0] for i in order[start : start + lanes]])
                y, _ = _lanes([pages[i][1][:, None] for i in order[start : start + lanes]])
                k += 1
                for name, g in self.gradient(x, y[:, :, 0], sizes).items():
                    m, v = moment[name]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    self.p[name] += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text; pages of like size run side by side."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        sizes = np.array([len(p) for p in pages])
        order = np.argsort(sizes, kind="stable")
        order = order[np.searchsorted(sizes[order], 1) :]
        while len(order):
            n = int(np.searchsorted(sizes[order], 2 * sizes[order[0]] + 8, "right"))
            n = max(1, min(n, 200_000 // int(sizes[order[n - 1]])))
            x, own = _lanes([pages[i] for i in order[:n]])
            good = self.odds(x, own) > 0
            for lane, i in enumerate(order[:n]):
                out[i] = good[: sizes[i], lane]
            order = order[n:]
        return out


def _lanes(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in pages])
    x = np.zeros((sizes.max(), len(pages), pages[0].shape[1]))
    for lane, p in enumerate(pages):
        x[: len(p), lane] = p
    return x, sizes


# Usual names of what surrounds an article, for the pages that the training pages are rebuilt into.
FRAMES = [
    '<header class="{n}">{t}</header>:site-header header top masthead',
    '<div class="{n}">{t}</div>:sidebar widget related-posts breadcrumb menu navigation share-buttons social promo sponsored '
    "ad ads advert banner cookie-notice notice alert popup newsletter subscribe footer copyright tags author-box login",
    '<aside class="{n}">{t}</aside>:sidebar related widget',
    '<div id="{n}"><p>{t}</p><p>{t}</p></div>:comments disqus footer sidebar header nav',
    '<section class="{n}"><h3>{t}</h3><div class="comment"><p>{t}</p></div></section>:comments comment-list responses',
    '<form class="{n}"><label>{t}</label><p>{t}</p></form>:search signup contact comment-form',
    '<nav class="{n}"><ul><li><a href="#">{t}</a></li></ul></nav>:menu main-nav breadcrumbs pagination',
    '<footer class="{n}"><p>{t}</p></footer>:site-footer bottom',
]
BODIES = [
    "<article>{}</article>", "<main>{}</main>", '<div class="post-content">{}</div>', '<div id="content">{}</div>',
    '<article class="post"><div class="entry-content">{}</div></article>', '<main role="main"><article>{}</article></main>',
    '<div class="article-body">{}</div>', "<article><section>{}</section></article>", '<div class="story text">{}</div>',
]
INNER = ["<p>{}</p>", "<h2>{}</h2>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>", "<div>{}</div>"]
INNER += ["<table><tr><td>{}</td></tr></table>", "<pre>{}</pre>", "<figure><figcaption>{}</figcaption></figure>"]


def rebuilt(main: list[str], other: list[str], rng: random.Random) -> tuple[list[Block], np.ndarray]:
    """A page of the same texts in another frame, and which blocks are main text."""
    escape = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")

    def frame() -> str:
        shape, names = rng.choice(FRAMES).split(":")
        return shape.format(n=rng.choice(names.split()), t=escape(rng.choice(other or main)))

    shapes = [rng.choices(INNER, [12, 2, 1, 1, 1, 1, 1, 1])[0] for _ in main]
    inner = ["<h1>{}</h1>".format("\x01" + escape(main[0])), *(s.format("\x01" + escape(t)) for s, t in zip(shapes[1:], main[1:], strict=True))]
    for _ in range(rng.choice((0, 0, 1, 2))):
        inner.insert(rng.randrange(1, len(inner) + 1), frame())
    body = rng.choice(BODIES).format("".join(inner))
    page = "".join(frame() for _ in range(rng.randrange(4))) + body + "".join(frame() for _ in range(rng.randrange(4)))
    blocks = blocks_of(f"<html><head><title>{escape(main[0])}</title></head><body>{page}</body></html>")
    y = np.array([b.text.startswith("\x01") for b in blocks])
    for b in blocks:
        b.text = b.text.removeprefix("\x01")
    return blocks, y


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> Network:
    """A network fitted on at most ``train_pages`` pages that mark their article.

    These are the pages with an ``article`` element, of ``TRAIN_CHARS`` at most, whose hashes are
    smallest. Blocks inside that element are main text, but for those in forms, comments,
    adverts and the like there (``ASIDE``). Each page is also rebuilt twice into
    frames of other kinds (other elements, names, notices, forms and comments), so
    that the network does not hang on one template.
    """
    marked = pages.filter(F.contains(F.lower("html"), F.lit("<article")) & (F.length("html") <= TRAIN_CHARS))
    # The hashes come first, so no task sends pages that another one outranks.
    mark = F.xxhash64("html").alias("mark")
    lowest = marked.select(mark).distinct().orderBy("mark").limit(train_pages)
    chosen = marked.select("html", mark).join(F.broadcast(lowest), "mark")
    sample = chosen.dropDuplicates(["mark"]).sort("mark").select("html").collect()
    rng, data = random.Random(3), []
    for row in sample:
        blocks = blocks_of(row["html"])
        y = np.array([b.main for b in blocks])
        if not y.any():
            continue
        main = [b.text for b, k in zip(blocks, y, strict=True) if k]
        other = [b.text for b, k in zip(blocks, y, strict=True) if not k]
        data.append((features(blocks), y.astype(float)))
        for _ in range(2):
            blocks, y = rebuilt(main, other, rng)
            data.append((features(blocks), y.astype(float)))
    network = Network()
    if data:
        network.fit(data)
    return network


def extract(pages: DataFrame, network: Network) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page.

    A page is cut into its leaf blocks; each is read as its tag path (hashed names of
    the elements around it, their classes and ids), hashed words and shape. The
    network reads the page forward and backward, and labels every block from both.
    Main blocks are joined by newlines in page order. One pass, no shuffle; the
    network is a few thousand numbers.

    NULL and empty pages, and pages without main blocks, give an empty text. Repeated
    rows are read each, NULL ids and urls stay, an empty table gives no rows, and other
    columns are not read.
    """

    def run(batches):
        for batch in batches:
            pages, texts = batch.column(2).to_pylist(), []
            for i, j in small_groups(pages):
                blocks = [blocks_of(p) for p in pages[i:j]]
                labels = network.label([features(b) for b in blocks])
                for own, good in zip(blocks, labels, strict=True):
                    texts.append("\n".join(b.text for b, k in zip(own, good, strict=True) if k))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    plain = pages.select(F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    return plain.mapInArrow(run, "page_id long, url string, text string, n_chars long")
