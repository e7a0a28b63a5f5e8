"""Main text of web pages: boosted trees over the nodes of a page, decoded as a hierarchy.

A page is read into a tree of its block elements (sections, paragraphs, list items, ...);
text with its inline markup is a leaf of the innermost block. Every element and leaf gets
features: its tag, words of its class, id and role, those of its ancestors, depth, place
among its siblings and in the page, and of its subtree the length, the share of links, the
density of text and signs. Boosted trees give the log odds that a node belongs to the main
text. A leaf may stay only if all its ancestors do, and an element only if something in it
does; the choice with the largest sum of log odds is found from the leaves up.

The trees are fitted by the driver on at most FIT_PAGES pages (a fixed choice by digest, of
up to FIT_CHARS characters each): on pages with an article or main element, where what lies
outside of it, or in a menu, footer, advert and the like, is not main text; and on pages
composed of their paragraphs in many layouts, so that tags, names, place and density all
count. Every page is then read whole, in the tasks, without a shuffle.

Cases: a null or empty html gives an empty text; so does a page without main text. Unclosed
and unmatched tags are closed or passed over as browsers do. Repeated rows get a row each.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgrain.llm.boosting import Boosted

FIT_PAGES = 300
FIT_CHARS = 200_000
BATCH_NODES = 50_000  # nodes scored together

# Elements that break lines, those without an end, those whose content is no
# text, and which open elements a start tag closes (up to one of the bounds).
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl "
    "dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend "
    "li main menu nav ol optgroup option p pre section select summary table tbody td textarea "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style template".split())
RAW = frozenset("script style textarea title".split())
CLOSES_P = BLOCKS - frozenset("body button caption head html option optgroup select td th tr tbody thead tfoot".split())
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}
_P_BOUNDS = ("td", "th", "table", "button", "caption", "html")
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
_HEAD = frozenset("title base link meta style script noscript template head html".split())

# Tags and words of names that go together as one feature each.
TAG_GROUPS = {
    "nav": "nav menu dir",
    "header": "header hgroup",
    "footer": "footer address",
    "aside": "aside dialog",
    "form": "form fieldset legend select option optgroup textarea button",
    "article": "article main",
    "section": "section",
    "div": "div center",
    "p": "p",
    "heading": "h1 h2 h3 h4 h5 h6",
    "list": "ul ol dl",
    "item": "li dt dd",
    "table": "table thead tbody tfoot tr td th caption",
    "quote": "blockquote pre figure figcaption details summary",
    "head": "head title",
}
NAME_GROUPS = {
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs toc pager pagination tabs skip",
    "top": "header masthead banner topbar logo branding hero",
    "bottom": "footer foot copyright legal colophon contentinfo bottom",
    "side": "sidebar side aside widget widgets rail complementary related recommended "
    "recommendations more trending popular tags",
    "notice": "notice notices cookie cookies consent gdpr alert alerts popup modal overlay "
    "newsletter subscribe subscription signup paywall message toast disclaimer",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo "
    "promotion promoted banner dfp adsense outbrain taboola",
    "comments": "comment comments commentlist reply replies respond discussion disqus reader "
    "readers responses review reviews feedback thread",
    "form": "form login search searchbox register contact input",
    "share": "share sharing social follow facebook twitter byline author meta date",
    "main": "article content post entry story main body text page copy prose blog",
}
_TAG_OF = {t: k for k, tags in enumerate(TAG_GROUPS.values()) for t in tags.split()}
_NAMES_OF: dict[str, list[int]] = {}
for _k, _names in enumerate(NAME_GROUPS.values()):
    for _name in _names.split():
        _NAMES_OF.setdefault(_name, []).append(_k)
_N_TAGS, _N_NAMES = len(TAG_GROUPS), len(NAME_GROUPS)
_KEPT_TAGS = [list(TAG_GROUPS).index(t) for t in ("nav", "header", "footer", "aside", "form", "head")]
_KEPT_NAMES = [k for k, n in enumerate(NAME_GROUPS) if n not in ("main", "share", "top")]

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[A-Za-z][^<>]*>|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|\bhidden\b|aria-hidden\s*=\s*\"?true", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SIGNS = re.compile(r"[.,;:!?]")
_MARK = "data-kept"  # on composed pages


class Page:
    """Block elements in page order: tag, parent, named word groups, hidden, marked; and
    leaves: element, text, characters inside links."""

    def __init__(self, source: str):
        self.tags, self.parents, self.names = ["html"], [-1], [[]]
        self.hidden, self.marked = [False], [False]
        self.leaves: list[tuple[int, str, int]] = []
        self._read(source)

    def _read(self, source: str):
        stack, buffer, links = [0], [], 0
        in_link, skip, at = 0, "", 0
        open_at: dict[str, list[int]] = {}  # places in the stack of the open elements of a tag

        def flush():
            nonlocal links
            if buffer:
                text = " ".join(entities.unescape("".join(buffer)).split())
                buffer.clear()
                if text:
                    self.leaves.append((stack[-1], text, min(links, len(text))))
            links = 0

        def cut(k):
            flush()
            for node in stack[k:]:
                open_at[self.tags[node]].pop()
            del stack[k:]

        def close(wanted, bounds):
            """Close the innermost open element of the wanted tags, and what is in it,
            unless one of the bounds is inside of it."""
            inner = max((open_at[tag][-1] for tag in wanted if open_at.get(tag)), default=0)
            if inner and all(open_at[tag][-1] < inner for tag in bounds if open_at.get(tag)):
                cut(inner)

        depth_skip, inside = 0, {}
        for match in iter(lambda: _TAG.search(source, at), None):
            if not skip and match.start() > at:
                text = source[at : match.start()]
                buffer.append(text)
                if in_link:
                    links += len(text)
            at = match.end()
            tag = match[2]
            if tag is None:
                continue
            tag = tag.lower()
            if skip:  # inside an element without text
                if tag == skip:
                    depth_skip += -1 if match[1] else 1
                    if not depth_skip:
                        skip = ""
                    continue
                if tag not in BLOCKS:
                    continue
                if not match[1] or inside.get(tag):
                    inside[tag] = inside.get(tag, 0) + (-1 if match[1] else 1)
                    continue
                if not open_at.get(tag):
                    continue
                skip = ""  # never closed: the end of a block around it ends it
            if match[1]:
                if tag == "a":
                    in_link = max(0, in_link - 1)
                elif tag in BLOCKS:
                    close((tag,), ())
                continue
            attributes = match[3] or ""
            if tag == "br":
                buffer.append(" ")
                continue
            if tag == "hr":
                close(("p",), _P_BOUNDS)
                flush()
                continue
            if tag in VOID:
                continue
            if tag == "a":
                in_link = 1
                continue
            if tag in RAW:
                end = _RAW_END[tag].search(source, at)
                end = end.start() if end else len(source)
                content, at = source[at:end], end
                if tag in NO_TEXT:
                    stop = source.find(">", at)
                    at = len(source) if stop < 0 else stop + 1
                    continue
            else:
                content = None
                if tag in NO_TEXT:
                    if not attributes.endswith("/"):
                        skip, depth_skip, inside = tag, 1, {}
                    continue
            if tag not in BLOCKS:
                continue
            if self.tags[stack[-1]] == "head" and tag not in _HEAD:
                cut(len(stack) - 1)
            if tag in CLOSES_P:
                close(("p",), _P_BOUNDS)
            if tag in CLOSES:
                close(*CLOSES[tag])
            if tag in ("html", "body") and tag in self.tags:
                continue
            flush()
            self.parents.append(stack[-1])
            open_at.setdefault(tag, []).append(len(stack))
            stack.append(len(self.tags))
            self.tags.append(tag)
            groups: list[int] = []
            if attributes:
                for named in _NAMED.finditer(attributes):
                    for word in _WORD.findall(named[1] or named[2] or named[3] or ""):
                        groups += _NAMES_OF.get(word.lower(), ())
            self.names.append(groups)
            self.hidden.append(bool(attributes and _HIDDEN.search(attributes)))
            self.marked.append(_MARK in attributes)
            if content is not None:  # a title or text area
                buffer.append(content)
                flush()
        if not skip:
            buffer.append(source[at:])
        flush()


_BASIC = 14
N_FEATURES = _BASIC + _N_TAGS + _N_NAMES + len(_KEPT_TAGS) + len(_KEPT_NAMES) + 2


def features(page: Page) -> np.ndarray:
    """Rows for the elements, then the leaves."""
    n, m = len(page.tags), len(page.leaves)
    parents = page.parents
    chars, links, signs, blocks, inner = (np.zeros(n) for _ in range(5))
    before = np.zeros(n)
    children = [0] * n
    place, twins = [0] * n, {}
    depth = [0] * n
    tag_rows, name_rows = np.zeros((n, _N_TAGS)), np.zeros((n, _N_NAMES))
    above_tags, above_names = np.zeros((n, _N_TAGS)), np.zeros((n, _N_NAMES))
    hidden = np.zeros(n)
    twin = [None] * n
    for k in range(n):
        group = _TAG_OF.get(page.tags[k])
        if group is not None:
            tag_rows[k, group] = 1
        for name in page.names[k]:
            name_rows[k, name] = 1
        hidden[k] = page.hidden[k]
        up = parents[k]
        if up >= 0:
            depth[k] = depth[up] + 1
            place[k] = children[up]
            children[up] += 1
            twin[k] = (up, page.tags[k])
            twins[twin[k]] = twins.get(twin[k], 0) + 1
            above_tags[k] = np.maximum(above_tags[up], tag_rows[up])
            above_names[k] = np.maximum(above_names[up], name_rows[up])
            hidden[k] = max(hidden[k], hidden[up])
    leaf = np.zeros((m, 4))
    first_leaf = np.full(n, -1)
    total = 0
    for j, (k, text, linked) in enumerate(page.leaves):
        leaf[j] = len(text), linked, len(_SIGNS.findall(text)), total
        total += len(text)
        chars[k] += len(text)
        links[k] += linked
        signs[k] += leaf[j, 2]
        blocks[k] += 1
        while k >= 0 and first_leaf[k] < 0:
            first_leaf[k] = j
            k = parents[k]
    for k in range(n - 1, 0, -1):
        up = parents[k]
        chars[up] += chars[k]
        links[up] += links[k]
        signs[up] += signs[k]
        blocks[up] += blocks[k]
        inner[up] += inner[k] + 1
    has = first_leaf >= 0
    before[has] = leaf[first_leaf[has], 3] if m else 0
    total = max(total, 1)
    depth, children_, place = np.array(depth), np.array(children), np.array(place)
    siblings = np.array([children[p] if p >= 0 else 1 for p in parents])
    same = np.array([twins.get(t, 1) for t in twin])
    out = np.zeros((n + m, N_FEATURES))
    own = np.array([k for k, _, _ in page.leaves], dtype=int)
    size = np.concatenate((chars, leaf[:, 0]))
    at = np.concatenate((np.arange(n), own))
    out[:, 0] = depth[at]
    out[:, 1] = np.log1p(size)
    out[:, 2] = np.concatenate((links, leaf[:, 1])) / np.maximum(size, 1)
    out[:, 3] = size / total
    out[:, 4] = np.log1p(size / np.concatenate((inner + 1, np.ones(m))))
    out[:, 5] = np.concatenate((signs, leaf[:, 2])) / np.maximum(size, 1)
    out[:, 6] = np.log1p(children_[at])
    out[:, 7] = place[at] / np.maximum(siblings[at], 1)
    out[:, 8] = np.log1p(same[at])
    out[:, 9] = np.concatenate((before, leaf[:, 3])) / total
    out[:, 10] = np.log1p(size / np.maximum(np.concatenate((blocks, np.ones(m))), 1))
    out[n:, 11] = 1
    up = np.array(parents)[at]
    out[:, 12] = np.where(up >= 0, np.log1p(chars[up]), 0)
    out[:, 13] = np.where(up >= 0, links[up] / np.maximum(chars[up], 1), 0)
    c = _BASIC
    for rows in (tag_rows, name_rows, above_tags[:, _KEPT_TAGS], above_names[:, _KEPT_NAMES]):
        out[:, c : c + rows.shape[1]] = rows[at]
        c += rows.shape[1]
    out[:, c] = hidden[at]
    article = list(TAG_GROUPS).index("article")
    out[:, c + 1] = np.maximum(above_tags, tag_rows)[at, article]
    return out


def decode(page: Page, margins: np.ndarray) -> list[str]:
    """Texts of the leaves that stay, in page order."""
    n = len(page.tags)
    margins = np.clip(margins, -6, 6).tolist()
    gain = [0.0] * n  # of what stays inside
    inside = [False] * n
    for j, (k, _, _) in enumerate(page.leaves):
        if margins[n + j] > 0:
            gain[k] += margins[n + j]
            inside[k] = True
    stays = [False] * n
    for k in range(n - 1, 0, -1):
        if inside[k] and gain[k] + margins[k] > 0:
            stays[k] = True
            up = page.parents[k]
            gain[up] += gain[k] + margins[k]
            inside[up] = True
    stays[0] = True
    for k in range(1, n):
        stays[k] = stays[k] and stays[page.parents[k]]
    return [text for j, (k, text, _) in enumerate(page.leaves) if stays[k] and margins[n + j] > 0]


# --- fitting -----------------------------------------------------------------------------------


def _labels(page: Page, leaf_kept: list[bool]) -> np.ndarray:
    """Leaves as given; an element is kept if a leaf inside it is."""
    kept = [False] * len(page.tags)
    for (k, _, _), yes in zip(page.leaves, leaf_kept):
        while yes and k >= 0 and not kept[k]:
            kept[k] = True
            k = page.parents[k]
    return np.array(kept + list(leaf_kept), dtype=float)


def _by_article(page: Page) -> list[bool] | None:
    """Leaves of an article or main element outside of its menus, adverts and the like."""
    groups = list(TAG_GROUPS)
    bad_tags = {groups.index(g) for g in ("nav", "header", "footer", "aside", "form", "head")}
    main = list(NAME_GROUPS).index("main")
    state = []  # 1 in the article, 0 before it, -1 in something else
    for tag, up, names in zip(page.tags, page.parents, page.names):
        now = state[up] if up >= 0 else 0
        if _TAG_OF.get(tag) in bad_tags or any(k != main for k in names):
            now = -1
        elif tag in ("article", "main") and now == 0:
            now = 1
        state.append(now)
    if 1 not in state:
        return None
    return [state[k] == 1 for k, _, _ in page.leaves]


class _Composer:
    """Pages of given paragraphs in random layouts, main text marked."""

    def __init__(self, paragraphs: list[str], seed: int):
        self.random, self.paragraphs = random.Random(seed), paragraphs

    def words(self, least: int, most: int) -> str:
        words = self.random.choice(self.paragraphs).split()
        n = self.random.randint(least, most)
        at = self.random.randrange(max(1, len(words) - n))
        return entities.escape(" ".join(words[at : at + n]), quote=False)

    def long(self) -> str:
        return entities.escape(self.random.choice(self.paragraphs), quote=False)

    def named(self, tag: str, groups: list[str], inner: str, plain: float = 0.0) -> str:
        if self.random.random() < plain:
            return f"<{tag}>{inner}</{tag}>"
        name = self.random.choice(NAME_GROUPS[self.random.choice(groups)].split())
        name += self.random.choice(["", "", "-box", "-wrap", "_1", " inner"])
        return f'<{tag} {self.random.choice(["class", "class", "id"])}="{name}">{inner}</{tag}>'

    def links(self, n: int) -> str:
        item = self.random.choice(["<li><a href='#'>{}</a></li>", "<li><a href='#'>{}</a> </li>"])
        return "<ul>" + "".join(item.format(self.words(1, 3)) for _ in range(n)) + "</ul>"

    def prose(self, n: int) -> str:
        return "".join(f"<p>{self.long()}</p>" for _ in range(n))

    def other(self) -> str:
        """Something that is not main text."""
        r = self.random
        kind = r.randrange(9)
        if kind == 0:
            return self.named(r.choice(["nav", "nav", "div"]), ["menu"], self.links(r.randint(3, 9)), 0.0) if r.random() < 0.5 else f"<nav>{self.links(r.randint(2, 8))}</nav>"
        if kind == 1:
            body = f"<p>{self.words(2, 8)}</p>" if r.random() < 0.5 else self.words(1, 6)
            return f"<header>{body}</header>" if r.random() < 0.6 else self.named("div", ["top"], body)
        if kind == 2:
            body = r.choice(["&copy; ", "", "<p>"]) + self.words(2, 25)
            return f"<footer>{body}</footer>" if r.random() < 0.7 else self.named("div", ["bottom"], body)
        if kind == 3:
            body = r.choice([self.links(r.randint(2, 8)), self.prose(r.randint(1, 3)), f"<h3>{self.words(1, 4)}</h3>" + self.links(3)])
            return f"<aside>{body}</aside>" if r.random() < 0.5 else self.named(r.choice(["div", "section"]), ["side"], body)
        if kind == 4:
            return self.named(r.choice(["div", "section", "p"]), ["notice"], r.choice([self.words(4, 25), f"<p>{self.words(4, 40)}</p>"]) if r.random() < 0.9 else self.words(3, 9))
        if kind == 5:
            return self.named(r.choice(["div", "div", "section", "p"]), ["advert"], r.choice([self.words(3, 30), self.words(20, 60)]))
        if kind == 6:
            body = f"<label>{self.words(1, 3)}</label><input type=text>" * r.randint(1, 3) + f"<p>{self.words(2, 12)}</p><button>{self.words(1, 2)}</button>"
            return f"<form>{body}</form>" if r.random() < 0.7 else self.named("div", ["form"], f"<form>{body}</form>")
        if kind == 7:
            one = r.choice(["<div class='comment'><p>{}</p></div>", "<li><p>{}</p></li>", "<p>{}</p>", "<article><p>{}</p></article>"])
            body = "".join(one.format(self.long() if r.random() < 0.6 else self.words(3, 30)) for _ in range(r.randint(1, 6)))
            return self.named(r.choice(["section", "div", "ol"]), ["comments"], r.choice(["", f"<h2>{self.words(1, 3)}</h2>"]) + body)
        return self.named("div", ["share"], self.links(r.randint(2, 5)))

    def part(self) -> str:
        """Something that is main text."""
        r = self.random
        kind = r.randrange(14)
        if kind < 8:
            return f"<p {_MARK}>{self.long()}"  + r.choice(["</p>", "</p>", ""])
        if kind == 8:
            return f"<p {_MARK}><b>{self.words(3, 15)}<br></p>"
        if kind == 9:
            return f"<p {_MARK}>{self.words(1, 6)}</p>"
        if kind == 10:
            return f"<h{r.randint(2, 4)} {_MARK}>{self.words(1, 8)}</h2>"
        if kind == 11:
            return "<ul>" + "".join(f"<li {_MARK}>{self.words(2, 25)}</li>" for _ in range(r.randint(2, 6))) + "</ul>"
        if kind == 12:
            return f"<blockquote><p {_MARK}>{self.long()}</p></blockquote>"
        return f"<div {_MARK}>{self.long()}</div>"

    def page(self) -> str:
        r = self.random
        body = f"<h1 {_MARK}>{self.words(2, 12)}</h1>" if r.random() < 0.9 else ""
        for _ in range(r.choice([1, 2, 3, 5, 8, 13, 20])):
            body += self.part()
            if r.random() < 0.08:
                body += self.other()
        shape = r.random()
        if shape < 0.4:
            body = f"<article>{body}</article>"
        elif shape < 0.5:
            body = f"<main>{body}</main>"
        elif shape < 0.85:
            body = self.named(r.choice(["div", "div", "section"]), ["main"], body)
        else:
            body = f"<div>{body}</div>"
        if r.random() < 0.3:
            body = self.named("div", ["main"], body + (self.other() if r.random() < 0.5 else ""), 0.5)
        before = "".join(self.other() for _ in range(r.choice([0, 1, 2, 2, 3])))
        after = "".join(self.other() for _ in range(r.choice([0, 1, 1, 2, 3])))
        return (
            f"<html><head><title>{self.words(1, 9)}</title></head><body>{before}{body}{after}</body></html>"
        )


def fit(pages: list[str], seed: int = 7) -> Boosted:
    """Trees from sample pages and pages composed of their paragraphs."""
    x, y, paragraphs = [], [], []
    for source in pages:
        page = Page(source)
        paragraphs += [text for _, text, links in page.leaves if len(text) > 80 and not links]
        kept = _by_article(page)
        if kept is not None:
            x.append(features(page))
            y.append(_labels(page, kept))
    paragraphs = paragraphs or ["some words of a paragraph, in a page without any text. " * 3]
    composer = _Composer(paragraphs, seed)
    for _ in range(4 * FIT_PAGES):
        page = Page(composer.page())
        x.append(features(page))
        y.append(_labels(page, [page.marked[k] for k, _, _ in page.leaves]))
    return Boosted.fit(np.concatenate(x), np.concatenate(y))


def extract(sources: list[str | None], trees: Boosted) -> list[str]:
    """Main texts; the nodes of several pages are scored together."""
    out: list[str] = []
    held: list[tuple[Page, np.ndarray]] = []

    def score():
        margins = trees.margin(np.concatenate([x for _, x in held]))
        low = 0
        for page, x in held:
            out.append("\n".join(decode(page, margins[low : low + len(x)])))
            low += len(x)
        held.clear()

    nodes = 0
    for source in sources:
        page = Page(source or "")
        held.append((page, features(page)))
        nodes += len(held[-1][1])
        if nodes > BATCH_NODES:
            score()
            nodes = 0
    if held:
        score()
    return out


def train(pages: DataFrame, html: str = "html", rows: int = FIT_PAGES) -> Boosted:
    """Trees fitted on a bounded sample of the pages: those of the smallest digests. Only
    about four times as many as are asked for leave the tasks that read them."""
    found = pages.select(F.col(html).alias("html")).filter(F.length("html").between(1, FIT_CHARS))
    found = found.withColumn("digest", F.xxhash64("html"))
    share = 4 * rows / max(1, pages.count())
    if share < 1:
        few = found.filter(F.pmod("digest", F.lit(1 << 30)) < int(share * (1 << 30)))
        sample = few.distinct().orderBy(F.pmod("digest", F.lit(1 << 30)), "html").limit(rows)
    else:
        sample = found.distinct().orderBy(F.pmod("digest", F.lit(1 << 30)), "html").limit(rows)
    return fit([row.html for row in sample.collect()])


def extract_main_text(pages: DataFrame, trees: Boosted, html: str = "html", into: str = "text") -> DataFrame:
    """Add the main text of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(tuple(vars(trees).values()))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trees = Boosted(*shared.value)
        for sources in batches:
            yield pa.array(extract(sources.to_pylist(), trees), pa.string())

    return pages.withColumn(into, F.arrow_udf(run, "string").asNondeterministic()(F.col(html)))
