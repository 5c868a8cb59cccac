"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks. Each block is described by hashed vectors of its tag
path (tags, class and id words) and of its words, and by a few ratios; a bidirectional LSTM in numpy
reads the whole sequence and labels every block as main text or not.

The labeller is fitted here: pages laid out in many ways, with known labels, are filled with the
texts of a bounded sample of the given pages. So it learns from structure, and words that the sample
happens to hold tell it nothing.
"""

from __future__ import annotations

import html
import pickle
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowatch.llm.common import bounded_sample

SAMPLE_PAGES = 200  # given pages whose texts fill the training pages, at most
TRAINING_PAGES = 1500
PATHS, WORDS, RATIOS = 2048, 256, 5  # sizes of the hashed vectors, number of ratios
WIDTH, HIDDEN = 24, 16

# Names of HTML elements.
RAW = "script style title textarea iframe noscript noembed noframes template xmp".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "html body head article section main div p h1 h2 h3 h4 h5 h6 header footer nav aside ul ol li dl dt dd table"
    " caption thead tbody tfoot tr td th blockquote pre form fieldset legend figure figcaption address details"
    " summary dialog hr center menu button select option search hgroup".split()
)
# An open element of the second kind ends where one of the first kind begins.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCK - {"html", "body", "head", "button", "select", "option", "td", "th", "tr", "caption", "thead", "tbody", "tfoot", "legend"}
# In svg and math: HTML begins inside the first; outside of those, a start tag of the second ends the svg or math.
HOLDS_HTML = set("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = BLOCK | set(
    "b big br code em embed i img listing meta nobr ruby s small span strong strike sub sup tt u var".split()
)
SCOPE = BLOCK - {"p", "h1", "h2", "h3", "h4", "h5", "h6"}

TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>|</[^a-zA-Z][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>",
    re.S,
)
NAMES = re.compile(r"(?:^|\s)(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks in page order, with character references decoded and white space made single.

    Inline elements and line breaks stay inside a block. Unclosed and stray tags are taken as a
    browser would. Formulas (math) are text; the text of drawings (svg) is not, except foreignObject.
    """
    page, out = page or "", []
    stack: list[tuple[str, tuple[str, ...]]] = []
    open_tags: dict[str, int] = {}
    modes = [(-1, False)]  # below each element of the stack: place of the svg or math that is open, and if text is drawn
    parts: list[str] = []
    linked, path = 0, ()

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, path, linked))
            parts, linked = [], 0

    def pop_to(at: int) -> None:
        for name, _ in stack[at:]:
            open_tags[name] -= 1
        del stack[at:], modes[at + 1 :]

    def say(raw: str) -> None:
        nonlocal linked, path
        if not raw or modes[-1][1]:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not text.isspace():
            if not any(parts) or all(p.isspace() for p in parts):
                path = tuple(token for _, tokens in stack for token in tokens)
            if open_tags.get("a"):
                linked += len(text)
        parts.append(text)

    at = 0
    while True:
        tag = TAG.search(page, at)
        if not tag:
            say(page[at:])
            break
        say(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            if (modes[-1][0] >= 0 or stack and stack[-1][0] in HOLDS_HTML) and page.startswith("<![CDATA[", tag.start()):
                end = page.find("]]>", tag.start())
                say(html.escape(page[tag.start() + 9 : end if end >= 0 else len(page)]))
                at = end + 3 if end >= 0 else len(page)
            continue
        if tag[1]:
            if name in BLOCK:
                flush()
            if name in ("p", "br") and modes[-1][0] >= 0:
                pop_to(modes[-1][0])
            if open_tags.get(name):
                pop_to(_last(stack, name))
            continue
        if modes[-1][0] >= 0 and name in ENDS_FOREIGN:
            pop_to(modes[-1][0])
        if (modes[-1][0] >= 0 or name in ("svg", "math")) and tag[3].endswith("/"):
            continue
        if name in RAW_END and not (modes[-1][0] >= 0 and modes[-1][1]):
            end = RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name in ENDS_P and open_tags.get("p"):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        pop_to(i)
                    elif stack[i][0] not in SCOPE:
                        continue
                    break
            for i in range(len(stack) - 1, -1, -1) if name in CLOSES else ():
                if stack[i][0] in CLOSES[name]:
                    pop_to(i)
                    if name != "tr":
                        break
                elif stack[i][0] in ("ul", "ol", "dl", "table", "select") or stack[i][0] in SCOPE - {"li", "dd", "dt", "td", "th", "tr"}:
                    break
        if name not in VOID:
            stack.append((name, _tokens(name, tag[3])))
            open_tags[name] = open_tags.get(name, 0) + 1
            root, drawn = modes[-1]
            if name in ("svg", "math"):
                modes.append((root if root >= 0 else len(stack) - 1, drawn or name == "svg"))
            else:
                modes.append((-1, drawn and name != "foreignobject") if name in HOLDS_HTML else modes[-1])
    flush()
    return out


def _last(stack: list, name: str) -> int:
    i = len(stack) - 1
    while stack[i][0] != name:
        i -= 1
    return i


def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    if name in ("html", "body"):
        return ()
    out = [f"<{name}"]
    if attributes and "=" in attributes:
        for m in NAMES.finditer(attributes):
            out += [p.lower() for p in PART.findall(m[2] or m[3] or m[4] or "")]
    return tuple(out)


def _bucket(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        bucket = self[word] = _bucket(word, WORDS)
        return bucket


class Vectors:
    """Blocks to numbers: bucket lists of the tag path, word histogram, ratios."""

    def __init__(self):
        self.paths: dict[tuple, np.ndarray] = {}
        self.words = _Buckets()

    def of(self, blocks: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids, owner, words, ratios = [], [], np.zeros((len(blocks), WORDS), np.float32), np.zeros((len(blocks), RATIOS), np.float32)
        if len(self.paths) > 20_000:
            self.paths.clear()
        if len(self.words) > 300_000:
            self.words.clear()
        for i, b in enumerate(blocks):
            found = self.paths.get(b.path)
            if found is None:
                pairs = [f"{x}>{y}" for x, y in zip(b.path, b.path[1:])]
                found = self.paths[b.path] = np.unique([_bucket(t, PATHS) for t in (*b.path, *pairs)]).astype(np.int64)
            ids.append(found)
            owner.append(len(found))
            split = b.text.lower().split()
            at = np.fromiter(map(self.words.__getitem__, split), np.int64, len(split))
            words[i] = np.bincount(at, minlength=WORDS) / len(split)
            ratios[i] = (
                np.log1p(len(split)) / 5, min(1.0, b.linked / len(b.text)), b.text[-1] in ".!?…:;\"'»", len(b.path) / 20, 1.0,
            )
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        return flat, np.repeat(np.arange(len(blocks)), owner), words, ratios


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Embeddings, an LSTM per direction, and a logistic layer over both and the block itself."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.w = {"path": normal(PATHS, WIDTH, scale=0.1), "words": normal(WORDS, WIDTH, scale=0.1), "ratios": normal(RATIOS, WIDTH, scale=0.3)}
        for side in ("ahead", "back"):
            self.w[f"{side}.x"] = normal(WIDTH, 4 * HIDDEN, scale=0.2)
            self.w[f"{side}.h"] = normal(HIDDEN, 4 * HIDDEN, scale=0.2)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
            self.w[f"{side}.b"] = bias
        self.w["out"] = normal(2 * HIDDEN + WIDTH, scale=0.2)
        self.w["out.b"] = np.zeros(1, np.float32)

    def embed(self, vectors) -> np.ndarray:
        flat, owner, words, ratios = vectors
        x = words @ self.w["words"] + ratios @ self.w["ratios"]
        np.add.at(x, owner, self.w["path"][flat])
        return x

    def _run(self, side: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states [time, page, HIDDEN] of padded sequences [time, page, WIDTH]."""
        steps, pages, _ = x.shape
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        given = x @ self.w[f"{side}.x"] + self.w[f"{side}.b"]
        for t in range(steps):
            z = given[t] + h @ self.w[f"{side}.h"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            tc = np.tanh(new)
            if keep is not None:
                keep.append((h, c, i, f, o, g, tc))
            h, c = o * tc, new
            out[t] = h
        return out

    @staticmethod
    def _padded(x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded sequences, and for every block its time step forwards and its page."""
        page = np.repeat(np.arange(len(lengths)), lengths)
        time = np.arange(len(page)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out = np.zeros((int(lengths.max()), len(lengths), x.shape[1]), np.float32)
        out[time, page] = x
        return out, time, page

    def _states(self, x: np.ndarray, lengths: np.ndarray, keep: dict | None = None):
        ahead, time, page = self._padded(x, lengths)
        reverse = lengths[page] - 1 - time
        back = np.zeros_like(ahead)
        back[reverse, page] = x
        kept = ([], []) if keep is not None else (None, None)
        left = self._run("ahead", ahead, kept[0])[time, page]
        right = self._run("back", back, kept[1])[reverse, page]
        if keep is not None:
            keep.update(ahead=(ahead, kept[0], time), back=(back, kept[1], reverse), page=page)
        return np.concatenate([left, right, x], axis=1)

    def scores(self, vectors, lengths: np.ndarray) -> np.ndarray:
        """Log odds of main text for every block; ``lengths`` are the blocks of each page."""
        x, out = self.embed(vectors), np.zeros(int(lengths.sum()), np.float32)
        ends = np.cumsum(lengths)
        order = [p for p in np.argsort(lengths, kind="stable") if lengths[p]]
        while order:
            # Pages of like length together; few if they are long.
            some = order[-max(1, min(len(order), 100_000 // int(lengths[order[-1]]))) :]
            order = order[: -len(some)]
            at = np.concatenate([np.arange(ends[p] - lengths[p], ends[p]) for p in some])
            out[at] = self._states(x[at], lengths[some]) @ self.w["out"] + self.w["out.b"]
        return out

    def gradients(self, vectors, lengths: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        flat, owner, words, ratios = vectors
        x, keep = self.embed(vectors), {}
        states = self._states(x, lengths, keep)
        d = (_sigmoid(states @ self.w["out"] + self.w["out.b"]) - labels).astype(np.float32) / len(labels)
        g = {"out": states.T @ d, "out.b": d.sum(keepdims=True)}
        dstates = d[:, None] * self.w["out"]
        dx = dstates[:, 2 * HIDDEN :].copy()
        for side, lo in (("ahead", 0), ("back", HIDDEN)):
            inputs, steps, at = keep[side]
            dh_out = np.zeros((len(inputs), inputs.shape[1], HIDDEN), np.float32)
            dh_out[at, keep["page"]] = dstates[:, lo : lo + HIDDEN]
            dz_all = np.zeros((*inputs.shape[:2], 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((inputs.shape[1], HIDDEN), np.float32)
            g[f"{side}.h"] = np.zeros_like(self.w[f"{side}.h"])
            for t in range(len(inputs) - 1, -1, -1):
                h, c, i, f, o, cand, tc = steps[t]
                dh = dh + dh_out[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * cand * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - cand * cand)], axis=1)
                dz_all[t] = dz
                g[f"{side}.h"] += h.T @ dz
                dh, dc = dz @ self.w[f"{side}.h"].T, dc * f
            g[f"{side}.x"] = np.tensordot(inputs, dz_all, ([0, 1], [0, 1]))
            g[f"{side}.b"] = dz_all.sum((0, 1))
            dx += (dz_all @ self.w[f"{side}.x"].T)[at, keep["page"]]
        g["words"], g["ratios"] = words.T @ dx, ratios.T @ dx
        g["path"] = np.zeros_like(self.w["path"])
        np.add.at(g["path"], flat, dx[owner])
        return g


# Layouts of the training pages: names that sites give to the parts of a page.
MAIN = ["content", "post", "entry-content", "article-body", "story", "post-content", "main-text", "articleBody", "text", "page-content", "body-text", "entry", "blog-post"]
ASIDE = {
    "nav": ["nav", "menu", "main-menu", "navbar", "navigation", "breadcrumbs", "breadcrumb", "topnav", "site-nav", "toc", "pagination", "pager"],
    "header": ["header", "site-header", "masthead", "top-bar", "branding", "logo", "page-header"],
    "footer": ["footer", "site-footer", "colophon", "copyright", "bottom", "legal", "credits"],
    "aside": ["sidebar", "side-bar", "widget", "secondary", "right-column", "related", "recommended", "more-stories", "read-next", "trending", "popular", "infobox-links", "rail"],
    "notice": ["notice", "cookie-notice", "cookies", "cookie-banner", "consent", "gdpr", "banner", "alert", "popup", "modal", "overlay", "message", "announcement", "paywall", "warning", "toast", "disclaimer"],
    "ad": ["ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsored", "sponsor", "promo", "promotion", "adbox", "ad-slot", "banner-ad", "commercial", "teaser"],
    "form": ["form", "newsletter", "subscribe", "signup", "search-form", "searchbox", "login", "contact-form", "register", "feedback"],
    "comments": ["comments", "comment", "comment-list", "commentlist", "reader-comments", "responses", "replies", "reply", "discussion", "disqus", "user-comments", "comment-section", "reviews", "guestbook"],
    "share": ["share", "social", "share-buttons", "tags", "tag-list", "social-links", "follow", "toolbar"],
}
OWN_TAG = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}
YES, NO = "", ""  # private characters that carry a block's label through the parser


class Layouts:
    def __init__(self, texts: list[str], seed: int):
        self.rng, self.texts = random.Random(seed), texts or ["Lorem ipsum."]

    def text(self, label: str, short: bool = False) -> str:
        words = self.rng.choice(self.texts).split()
        if short:
            at = self.rng.randrange(len(words))
            words = words[at : at + self.rng.choice((1, 1, 2, 3, 4))]
        return label + html.escape(" ".join(words))

    def attributes(self, names: list[str]) -> str:
        r = self.rng
        name = r.choice(names)
        if r.random() < 0.3:
            name = name + " " + r.choice(["clearfix", "row", "box", "wide", "left", "inner", f"x{r.randrange(999)}", r.choice(names)])
        return f' {r.choice(("class", "class", "class", "id"))}="{name}"'

    def paragraphs(self, label: str, n: int, tags=("p",)) -> str:
        r, out = self.rng, []
        for _ in range(n):
            tag, body = r.choice(tags), self.text(label, r.random() < 0.15)
            if r.random() < 0.1:
                out.append(f"<p><b>{body}<br>")  # as sloppy pages have it
            elif tag == "ul":
                items = "".join(f"<li>{self.text(label, r.random() < 0.5)}</li>" for _ in range(r.randint(1, 5)))
                out.append(f"<ul>{items}</ul>")
            elif tag == "table":
                cells = "".join(f"<tr><td>{self.text(label, True)}</td><td>{self.text(label, True)}</td></tr>" for _ in range(r.randint(1, 3)))
                out.append(f"<table>{cells}</table>")
            else:
                if r.random() < 0.15:
                    body = body + f' <a href="/x">{html.escape(r.choice(self.texts).split()[0])}</a>'
                out.append(f"<{tag}>{body}</{tag}>")
        return "".join(out)

    def links(self, n: int) -> str:
        r = self.rng
        inside = [f'<a href="/{i}">{self.text(NO, True)}</a>' for i in range(n)]
        if r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in inside) + "</ul>"
        return "".join(f"<div>{x}</div>" for x in inside)

    def boilerplate(self, kind: str) -> str:
        r = self.rng
        tag = OWN_TAG.get(kind, "div")
        named = r.random() < (0.6 if kind in OWN_TAG else 1.0)
        if named and r.random() < 0.5:
            tag = r.choice(("div", "div", "section", "aside" if kind in ("aside", "ad", "notice", "share", "comments") else "div"))
        attributes = self.attributes(ASIDE[kind]) if named else ""
        if kind in ("nav", "share") and r.random() < 0.6:
            body = self.links(r.randint(1, 9))
        elif kind == "header":
            body = r.choice((self.text(NO, True), f"<div>{self.text(NO, True)}</div><p>{self.text(NO, True)}</p>", f"<h1>{self.text(NO, True)}</h1>" if named else self.text(NO, True)))
        elif kind == "form":
            body = f"<label>{self.text(NO, True)}</label><input><p>{self.text(NO, r.random() < 0.5)}</p><button>{self.text(NO, True)}</button>"
        elif kind == "comments":
            item = r.choice(("div", "li", "article", "p"))
            inner = self.attributes(["comment", "comment-body", "reply"]) if r.random() < 0.6 else ""
            many = "".join(f"<{item}{inner}>{self.paragraphs(NO, r.randint(1, 2))}</{item}>" for _ in range(r.randint(1, 5)))
            body = (f"<h2>{self.text(NO, True)}</h2>" if r.random() < 0.5 else "") + many
        elif r.random() < 0.4:
            body = self.links(r.randint(1, 6))
        else:
            body = r.choice((self.text(NO), self.text(NO, True), self.paragraphs(NO, r.randint(1, 3)), f"<h3>{self.text(NO, True)}</h3><p>{self.text(NO)}</p>"))
        return f"<{tag}{attributes}>{body}</{tag}>"

    def page(self) -> str:
        r = self.rng
        inner = [self.paragraphs(YES, 1, r.choice((("p",), ("p", "p", "p", "h2", "ul", "blockquote", "div", "pre", "table"))) ) for _ in range(r.randint(1, 14))]
        for _ in range(r.choice((0, 0, 1, 1, 2, 3))):
            kind = r.choice(("ad", "ad", "ad", "share", "aside", "form", "notice", "notice", "comments", "nav", "header", "footer"))
            inner.insert(r.randint(0, len(inner)), self.boilerplate(kind))
        title = r.choice(("", f"<h1>{self.text(YES, r.random() < 0.5)}</h1>", f"<h1>{self.text(YES, True)}</h1>", f"<h1{self.attributes(['title', 'headline', 'entry-title'])}>{self.text(YES, True)}</h1>"))
        body = title + "".join(inner)
        holder = r.choice(("article", "article", "article", "main", "div", "section"))
        attributes = self.attributes(MAIN) if holder in ("div", "section") or r.random() < 0.4 else ""
        main = f"<{holder}{attributes}>{body}</{holder}>"
        if r.random() < 0.3:
            main = f"<main{self.attributes(['main', 'content']) if r.random() < 0.5 else ''}>{main}</main>"
        before = [self.boilerplate(k) for k in ("header", "nav", "notice", "ad", "aside", "form") if r.random() < 0.35]
        after = [self.boilerplate(k) for k in ("comments", "share", "aside", "ad", "form", "nav", "notice", "footer") if r.random() < 0.35]
        r.shuffle(before)
        if r.random() < 0.3:
            main = f"<div{self.attributes(['wrapper', 'container', 'page', 'layout', 'site', 'columns'])}>{''.join(before)}{main}{''.join(after)}</div>"
            before, after = [], []
        return f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def training_pages(texts: list[str], n: int, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    layouts, out = Layouts(texts, seed), []
    for _ in range(n):
        blocks = blocks_of(layouts.page())
        labels = np.array([YES in b.text for b in blocks], np.float32)
        for b in blocks:
            b.text = b.text.replace(YES, "").replace(NO, "") or "-"
        if blocks:
            out.append((blocks, labels))
    return out


def fit(texts: list[str], pages: int = TRAINING_PAGES, epochs: int = 10, batch: int = 32, rate: float = 0.01, seed: int = 5) -> Labeller:
    """A labeller fitted by Adam; the same texts and seed give the same weights."""
    rng, vectors, model = np.random.default_rng(seed), Vectors(), Labeller(seed)
    ready = [(vectors.of(blocks), len(blocks), labels) for blocks, labels in training_pages(texts, pages, seed)]
    mean = {k: np.zeros_like(v) for k, v in model.w.items()}
    square = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(ready))
        for lo in range(0, len(order), batch):
            some = [ready[i] for i in order[lo : lo + batch]]
            shifts = np.cumsum([0] + [n for _, n, _ in some])
            joined = (
                np.concatenate([v[0] for v, _, _ in some]), np.concatenate([v[1] + s for (v, _, _), s in zip(some, shifts)]),
                np.concatenate([v[2] for v, _, _ in some]), np.concatenate([v[3] for v, _, _ in some]),
            )
            grads = model.gradients(joined, np.array([n for _, n, _ in some]), np.concatenate([y for _, _, y in some]))
            step += 1
            pace = rate * (0.3 ** (epoch / epochs * 2)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                model.w[k] -= (pace * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
    return model


class Extractor:
    def __init__(self, model: Labeller):
        self.model, self.vectors = model, Vectors()

    def texts(self, pages: list[str | None]) -> list[str]:
        """Main text of each page: its main blocks in page order, one per line."""
        parsed = [blocks_of(p) for p in pages]
        lengths = np.array([len(b) for b in parsed], np.int64)
        flat = [b for blocks in parsed for b in blocks]
        if not flat:
            return [""] * len(pages)
        main = self.model.scores(self.vectors.of(flat), lengths) > 0
        starts = np.cumsum(lengths) - lengths
        return ["\n".join(b.text for b, m in zip(blocks, main[s:]) if m) for blocks, s in zip(parsed, starts)]


def train(pages: DataFrame, most: int = SAMPLE_PAGES) -> Labeller:
    """A labeller fitted in one task with the texts of at most ``most`` given pages.

    These are the first in the order of a hash of their id; an empty table gives a labeller that knows
    layouts only. ``pages`` has page_id and html.
    """
    ids = bounded_sample(pages.where("html is not null and page_id is not null").select("page_id").distinct(), most, ["page_id"])
    picked = pages.where(F.col("page_id").isin([r[0] for r in ids.collect()])).select("page_id", "html")
    picked = picked.dropDuplicates(["page_id"]).orderBy("page_id").coalesce(1)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [b.text for batch in batches for page in batch.column("html").to_pylist() for b in blocks_of(page)]
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit(texts).w)]})

    model = Labeller()
    rows = picked.mapInArrow(fitted, "model binary").collect()
    model.w = pickle.loads(rows[0]["model"]) if rows else fit([]).w
    return model


def main_text(pages: DataFrame, model: Labeller) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars (code points).

    ``pages`` has page_id, url and html; other columns are not read. Null and empty pages, and pages
    without a main block, give the empty text. Nothing is cut off: a page of any length is read whole.
    Repeated rows are extracted each.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(sent.value)
        for batch in batches:
            texts = extractor.texts(batch.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return slim.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
