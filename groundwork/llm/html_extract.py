"""Main-text extraction with a tree-structured graphical model (operator 5).

Every element of a page's tree has a hidden label, content or boilerplate. Parent-child potentials tie a node to its
parent, node potentials come from its tag, its class, id and role words, the share of link text, the length and the
punctuation of its text. Sum-product messages go up and then down the tree and give each node's exact marginal.
Potentials are smoothed counts over labelled pages (`labelled_pages`). Text blocks whose element has a content marginal
of at least one half are the main text.

Defined results: null or empty html, and pages without content, give an empty text and 0 characters. Markup may be
broken: unclosed and crossed tags are closed as browsers do in the common cases; a head without an end tag ends where an
element or text of the body begins, any other unclosed hidden element with its parent. Character references are decoded;
white space inside a block becomes one space; blocks are trimmed and joined by one space in page order. Every row
gives one row, repeated rows included; extra columns are not read; an empty table gives an empty result. Pages of any
size are read whole; work is linear in the page but for end tags that close far up a deep nesting.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import table

# Element names of HTML, by what the parser does with them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title select option datalist button textarea svg math canvas object iframe audio video map".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_CLOSING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "tbody": ("table",), "thead": ("table",)}
SIBLINGS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead"), "thead": ("tbody", "thead")}
TAGS = "article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure figcaption nav header footer aside form fieldset address details dialog menu a body html label".split()
WORD_GROUPS = {
    "content": "content article post entry story main text body prose markdown lead",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc pagination pager tabs topbar toolbar skip",
    "head": "header masthead banner logo branding hero",
    "foot": "footer foot copyright legal colophon",
    "side": "sidebar side aside widget rail related recommended popular trending more",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion adslot dfp teaser",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay newsletter subscribe signup paywall message warning",
    "talk": "comment comments reply replies respond disqus discussion thread reader feedback review reviews",
    "form": "form search login register share sharing social contact field",
}
GROUP_OF = {w: g for g, words in WORD_GROUPS.items() for w in words.split()}
NAME_PARTS = re.compile(r"[a-z]+")
LABEL = "data-label"  # the attribute that labelled pages carry: 1 content, 0 boilerplate


class Tree(HTMLParser):
    """Elements (parent, tag, word group) and text blocks of a page, tolerant of broken markup."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.group, self.label = [-1], ["html"], ["none"], [None]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters of it inside links
        self.stack = [0]
        self.pieces: list[str] = []
        self.linked = self.links = 0
        self.hidden: list[str] = []
        self.inside: Counter[str] = Counter()  # elements opened since the text is hidden
        self.open: Counter[str] = Counter()  # elements of the stack by tag

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((self.owner, text, self.linked))
            self.pieces, self.linked = [], 0

    def up_to(self, k: int) -> None:
        """Close all elements from place k of the stack on."""
        for node in self.stack[k:]:
            self.open[self.tag[node]] -= 1
            self.links -= self.tag[node] == "a"
            if self.tag[node] not in INLINE:
                self.flush()
        del self.stack[k:]

    def place_of(self, tags: tuple[str, ...], until: tuple[str, ...] = ()) -> int | None:
        if not any(self.open[t] for t in tags):
            return None
        for k in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[k]] in tags:
                return k
            if self.tag[self.stack[k]] in until:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        if self.hidden == ["head"] and (tag == "body" or tag not in IN_HEAD and not self.inside.total()):
            self.unhide()  # a head ends where an element of the body begins
        if self.hidden:
            if tag == self.hidden[-1]:
                self.hidden.append(tag)
            elif tag not in VOID:
                self.inside[tag] += 1
            return
        if tag in HIDDEN:
            if tag not in VOID:
                self.hidden.append(tag)
            self.flush()
            return
        if tag in ("html", "body") and len(self.stack) <= 2 and (tag == "html" or "body" in self.tag):
            return
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_P and (k := self.place_of(("p",), ("td", "th", "li", "div", "article", "section", "aside", "table"))):
            self.up_to(k)
        if tag in SELF_CLOSING and (k := self.place_of(SIBLINGS.get(tag, (tag,)), SELF_CLOSING[tag])):
            self.up_to(k)
        names, label = [], None
        for key, value in attrs:
            if key in ("class", "id", "role", "aria-label", "itemprop"):
                names.append((value or "").lower())
            elif key == LABEL:
                label = value == "1"
            elif key in ("hidden",) or key == "aria-hidden" and value == "true":
                names.append("hidden")
        self.parent.append(self.stack[-1])
        self.tag.append(tag)
        self.group.append(group_of(" ".join(names)))
        self.label.append(self.label[self.stack[-1]] if label is None else label)
        self.stack.append(len(self.tag) - 1)
        self.open[tag] += 1
        self.links += tag == "a"

    def handle_endtag(self, tag):
        if self.hidden:
            if tag == self.hidden[-1]:
                self.hidden.pop()
                if not self.hidden:
                    self.unhide()
                return
            if self.inside[tag]:
                self.inside[tag] -= 1
                return
            if tag not in ("head", "body", "html") and not self.open[tag]:
                return
            self.unhide()  # an unclosed hidden element ends with its parent
        if tag in ("p", "br") and self.place_of((tag,)) is None:
            self.flush()
            return
        until = ("article", "aside", "body", "div", "footer", "form", "header", "main", "nav", "section", "table", "td") if tag in INLINE or tag == "p" else ()
        if k := self.place_of((tag,), until):
            self.up_to(k)

    def unhide(self) -> None:
        self.hidden.clear()
        self.inside.clear()

    def handle_data(self, data):
        if self.hidden == ["head"] and not self.inside.total() and not data.isspace():
            self.unhide()
        if self.hidden:
            return
        if not self.pieces:
            for k in range(len(self.stack) - 1, -1, -1):
                self.owner = self.stack[k]
                if self.tag[self.owner] not in INLINE:
                    break
        self.pieces.append(data)
        if self.links > 0:
            self.linked += len(data)

    def close(self):
        super().close()
        self.flush()


@lru_cache(maxsize=20_000)
def group_of(names: str) -> str:
    """The word group that an element's names speak for; boilerplate words outweigh content words."""
    found = [GROUP_OF[w] for w in NAME_PARTS.findall(names) if w in GROUP_OF]
    if "hidden" in names.split():
        return "notice"
    return next((g for g in found if g != "content"), found[0] if found else "none")


def parse(html: str) -> Tree:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree


def bucket(value: float, edges: tuple[float, ...]) -> int:
    return sum(value >= e for e in edges)


FEATURES = (("tag", len(TAGS) + 1), ("group", len(WORD_GROUPS) + 1), ("links", 4), ("length", 5), ("stops", 3))
TAG_NO = {t: i for i, t in enumerate(TAGS)}
GROUP_NO = {g: i + 1 for i, g in enumerate(WORD_GROUPS)}


def features(tree: Tree) -> np.ndarray:
    """A row of feature values per element; text measures count the whole subtree."""
    n = len(tree.tag)
    chars, linked, stops, blocks = ([0] * n for _ in range(4))
    for node, text, own in tree.blocks:
        chars[node] += len(text)
        linked[node] += min(own, len(text))
        stops[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
        blocks[node] += 1
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        stops[p] += stops[i]
    return np.array(
        [
            (
                TAG_NO.get(tree.tag[i], len(TAGS)),
                GROUP_NO.get(tree.group[i], 0),
                bucket(linked[i] / chars[i], (0.05, 0.3, 0.7)) if chars[i] else 0,
                bucket(chars[i], (1, 40, 160, 800)),
                bucket(stops[i] / chars[i], (0.004, 0.012)) if chars[i] else 0,
            )
            for i in range(n)
        ],
        np.int64,
    ).reshape(n, len(FEATURES))


class Model:
    """Log potentials: a node's features given its label, and its label given its parent's."""

    def __init__(self, pages: list[str], smoothing: float = 0.5):
        node = [np.full((2, k), smoothing) for _, k in FEATURES]
        edge, root = np.full((2, 2), smoothing), np.full(2, smoothing)
        for html in pages:
            tree = parse(html)
            labels = [int(bool(x)) for x in tree.label]
            for i, row in enumerate(features(tree)):
                if tree.label[i] is None:
                    continue
                for f, v in enumerate(row):
                    node[f][labels[i], v] += 1
                if i and tree.label[tree.parent[i]] is not None:
                    edge[labels[tree.parent[i]], labels[i]] += 1
                else:
                    root[labels[i]] += 1
        self.node = [np.log(x / x.sum(1, keepdims=True)) for x in node]
        self.edge = np.log(edge / edge.sum(1, keepdims=True))
        self.root = np.log(root / root.sum())

    def marginals(self, tree: Tree) -> np.ndarray:
        """P(content) of each element by sum-product: messages from the leaves up, then from the root down."""
        rows = features(tree)
        own = sum(self.node[f][:, rows[:, f]].T for f in range(len(FEATURES)))
        up = own.tolist()
        n, parent = len(rows), tree.parent
        sent = [(0.0, 0.0)] * n
        (e00, e01), (e10, e11) = self.edge.tolist()
        free = [self.starts(tree, i) for i in range(n)]
        r0, r1 = self.root.tolist()
        for i in range(n - 1, 0, -1):
            a, b = up[i]
            m = (log_add(r0 + a, r1 + b),) * 2 if free[i] else (log_add(e00 + a, e01 + b), log_add(e10 + a, e11 + b))
            sent[i] = m
            up[parent[i]][0] += m[0]
            up[parent[i]][1] += m[1]
        belief = [None] * n
        belief[0] = (up[0][0] + r0, up[0][1] + r1)
        for i in range(1, n):
            p = belief[parent[i]]
            a, b = p[0] - sent[i][0], p[1] - sent[i][1]
            d0, d1 = (r0, r1) if free[i] else (log_add(a + e00, b + e10), log_add(a + e01, b + e11))
            x, y = up[i][0] + d0, up[i][1] + d1
            z = log_add(x, y)
            belief[i] = (x - z, y - z)
        out = np.exp([b[1] - log_add(*b) for b in belief])
        return out

    @staticmethod
    def starts(tree: Tree, i: int) -> bool:
        """Children of the page's mixed frame (html, body) begin trees of their own."""
        return tree.tag[tree.parent[i]] in ("html", "body") if i else True


def log_add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def extract(model: Model, html: str) -> str:
    tree = parse(html)
    if not tree.blocks:
        return ""
    content = model.marginals(tree) >= 0.5
    return " ".join(text for node, text, _ in tree.blocks if content[node])


def labelled_pages(n: int = 400, seed: int = 7) -> list[str]:
    """Pages in common layouts with a label on each part: the training set of the model."""
    rng = random.Random(seed)
    words = "ba de lo mi ra sen tor ul ving ost er an ter qua shi pel mon dar ine".split()

    def sentence(low: int, high: int) -> str:
        own = ["".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(rng.randint(low, high))]
        return (" ".join(w + ("," if rng.random() < 0.08 else "") for w in own)).capitalize() + "."

    def para(low: int = 1, high: int = 6) -> str:
        text = " ".join(sentence(3, 18) for _ in range(rng.randint(low, high)))
        if rng.random() < 0.25:
            text = f'{text} <a href="/x">{sentence(1, 4)}</a> {sentence(2, 10)}'
        return f"<p>{'<b>' + text + '</b>' if rng.random() < 0.1 else text}</p>"

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{" ".join(rng.choices(words, k=rng.randint(1, 3)))}</a></li>' for i in range(k)) + "</ul>"

    def pick(*choices: str) -> str:
        return rng.choice(choices)

    def boiler(kind: str) -> str:
        text, short = para(1, 2), sentence(2, 9)
        made = {
            "menu": lambda: pick(f"<nav 0>{links(rng.randint(2, 9))}</nav>", f'<div class="{pick("navbar", "menu", "breadcrumb", "pagination")}" 0>{links(rng.randint(2, 9))}</div>', f'<ul class="nav" 0>{links(4)}</ul>'),
            "head": lambda: pick(f"<header 0><h1>{short}</h1>{links(3)}</header>", f'<div id="header" 0>{short}</div>', f"<header 0><p>{short}</p></header>"),
            "foot": lambda: pick(f"<footer 0>&copy; {short}</footer>", f"<footer 0><p>{short}</p>{links(3)}</footer>", f'<div class="footer" 0>{text}</div>'),
            "side": lambda: pick(f"<aside 0><h3>{short}</h3>{links(5)}</aside>", f"<aside 0>{text}</aside>", f'<div class="{pick("sidebar", "related", "widget")}" 0><h2>{short}</h2>{pick(text, links(4))}</div>'),
            "advert": lambda: f'<{(t := pick("div", "div", "section", "aside", "p"))} class="{pick("ad", "ads", "advert", "sponsored", "promo", "ad-slot")}" 0>{pick(short, short, text if t != "p" else short)}</{t}>',
            "notice": lambda: f'<div {pick("class", "id")}="{pick("cookie-banner", "notice", "newsletter", "alert", "consent popup", "modal")}" 0>{pick(short, text)}</div>',
            "form": lambda: f"<form 0><label>{short}</label><input name=q><p>{short}</p></form>",
            "talk": lambda: f'<{(t := pick("section", "div"))} {pick("class", "id")}="{pick("comments", "comment-list", "replies", "reader-comments")}" 0><h3>{short}</h3>' + "".join(f'<div class="comment">{para(1, 2)}</div>' for _ in range(rng.randint(1, 4))) + f"</{t}>",
        }[kind]()
        return made

    def body_part() -> str:
        return rng.choices(
            [para(), f"<h2>{sentence(2, 8)}</h2>", f"<ul>{''.join(f'<li>{sentence(2, 12)}</li>' for _ in range(3))}</ul>", f"<blockquote>{para(1, 2)}</blockquote>", f"<pre>{sentence(4, 12)}</pre>", f"<table><tr><td>{sentence(1, 5)}</td><td>{sentence(1, 5)}</td></tr></table>", f"<figure><figcaption>{sentence(3, 9)}</figcaption></figure>", f"<div>{para()}</div>", f"<section><h3>{sentence(2, 6)}</h3>{para()}</section>", f"<p>{sentence(1, 2)}</p>", f"<h1>{sentence(2, 9)}</h1>"],
            [14, 3, 2, 1, 0.5, 0.7, 0.5, 1.5, 1.5, 2, 1],
        )[0]

    pages = []
    for _ in range(n):
        main = [f"<h1>{sentence(2, 10)}</h1>"] * (rng.random() < 0.8) + [body_part() for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.35:  # boilerplate between the paragraphs
            main.insert(rng.randint(0, len(main)), boiler(pick("advert", "side", "form", "notice", "talk", "menu")))
        inner = "".join(main)
        article = rng.choices([f"<article 1>{inner}</article>", f"<main 1><article>{inner}</article></main>", f"<main 1>{inner}</main>", f'<div class="{pick("content", "post", "entry-content", "article-body")}" 1>{inner}</div>', f'<div id="main" 1><div>{inner}</div></div>'], [6, 2, 2, 2, 1])[0]
        before = [boiler(pick("menu", "head", "advert", "notice", "form")) for _ in range(rng.randint(1, 4))]
        after = [boiler(pick("foot", "side", "talk", "advert", "menu", "notice")) for _ in range(rng.randint(1, 4))]
        page = f"<!DOCTYPE html><html><head><title>{sentence(2, 6)}</title></head><body>{''.join(before)}{article}{''.join(after)}</body></html>"
        pages.append(re.sub(r" ([01])>", rf' {LABEL}="\1">', page))
    return pages


_model: list[Model] = []


def trained() -> Model:
    if not _model:
        _model.append(Model(labelled_pages()))
    return _model[0]


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of every page; see the module's docstring for the defined cases."""
    model = trained()  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(model, html.as_py() or "") for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
