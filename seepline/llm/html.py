"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

A tolerant parser builds the tree of block elements (inline elements belong to their block).
Two classifiers look at every node: does it hold article text at all, and is all of its text
article text? Decoding picks for each node *in*, *out* or *mixed* with the largest joint
likelihood, where everything below an *in* node is in and everything below an *out* node is
out; no descendant can contradict its ancestor.

The classifiers are fitted on ``TRAINING_PAGES`` pages that ``sample_page`` writes with known
labels: many layouts, with speaking and with meaningless attribute names. No page of the
input is learned from; every page is extracted whole.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.llm import boosting
from seepline.llm.common import slices

TRAINING_PAGES = 700

#: quotes open a value only after "="; a tag whose quote never closes ends at its first ">"
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>|<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)|=)*+)>""", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
#: content that is never shown as text
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noframes"}
_HIDDEN = {"svg", "select", "option", "button", "object", "canvas", "math", "audio", "video", "datalist"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: what leaves an open head open
_HEAD = {"html", "head", "base", "basefont", "bgsound", "link", "meta", "title", "noscript", "noframes", "style", "script", "template"}
_BLOCK = {
    "html", "body", "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "legend", "li", "main", "menu", "nav",
    "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption",
}
#: a start tag ends an open element of these names, up to the given boundary
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: any block ends an open paragraph, up to these
_P_ENDS = ({"p"}, {"td", "th", "li", "div", "section", "article", "table"})
_TAGS = ("p", "h1", "h", "li", "list", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "table", "quote", "figure", "text", "other")
_TAG_GROUP = {t: t for t in _TAGS} | {
    **{f"h{i}": "h" for i in range(2, 7)}, "ul": "list", "ol": "list", "dl": "list", "menu": "list", "dt": "li", "dd": "li", "blockquote": "quote", "pre": "quote",
    "fieldset": "form", "td": "table", "th": "table", "tr": "table", "tbody": "table", "thead": "table", "figcaption": "figure", "#text": "text",
}
#: attribute tokens, by what they say about a node
_TOKENS = {
    "content": "article content main post entry story body text page single prose markdown hentry",
    "menu": "nav navigation menu breadcrumb breadcrumbs topbar navbar toc pagination pager tabs links toolbar",
    "head": "header masthead banner logo brand hero top",
    "foot": "footer foot bottom copyright colophon legal contentinfo imprint",
    "side": "sidebar side aside widget rail secondary complementary related recommended trending popular",
    "notice": "cookie cookies consent notice gdpr alert message popup modal overlay privacy warning dialog toast banner",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsbygoogle commercial dfp",
    "comment": "comment comments reply replies discussion disqus respond thread reader feedback",
    "social": "share social follow sharing tweet facebook newsletter subscribe signup login search form meta byline author tags",
}
_TOKEN_GROUP = {w: g for g, words in _TOKENS.items() for w in words.split()}
_GROUPS = tuple(_TOKENS)


@dataclass(eq=False)
class Node:
    tag: str
    parent: Node | None
    groups: frozenset[str] = frozenset()
    depth: int = 0
    parts: list = field(default_factory=list)  # text, or nodes
    links: int = 0
    label: str = ""


def _groups(attributes: str) -> frozenset[str]:
    if not attributes:
        return frozenset()
    words = (w for m in _ATTRIBUTE.finditer(attributes) for w in _NAME.findall(m.group(2).lower()))
    return frozenset(_TOKEN_GROUP[w] for w in words if w in _TOKEN_GROUP)


def parse(source: str) -> Node:
    """The tree of block elements. Unclosed and misnested tags end where a browser would end
    them, near enough for text: a block ends an open paragraph, items and cells end their
    like, an end tag without start is skipped, and the end of the source ends everything. Text, or
    a tag that a head cannot hold, ends an open head; a later head tag is skipped."""
    root = Node("body", None)
    stack: list[tuple[str, Node]] = [("body", root)]
    # where in the stack each name stands, and where blocks do
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    now, link, hidden, at = root, 0, 0, 0
    lower = None
    head = begun = False

    def text(value: str) -> None:
        nonlocal head, begun
        if not value.strip():
            if head:
                return
        else:
            head, begun = False, True
        if value and not hidden:
            value = entities.unescape(value)
            now.parts.append(value)
            if link:
                now.links += len(value)

    def close(depth: int) -> None:
        nonlocal now, link, hidden
        while len(stack) > depth:
            tag, _ = stack.pop()
            link -= tag == "a"
            hidden -= tag in _HIDDEN
            if tag:
                places[tag].pop()
                if tag in _BLOCK:
                    blocks.pop()
        now = stack[-1][1]

    def opened(tag: str, node: Node) -> None:
        places.setdefault(tag, []).append(len(stack))
        if tag in _BLOCK:
            blocks.append(len(stack))
        stack.append((tag, node))

    def innermost(names: Iterable[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    size, last = len(source), source.rfind(">")
    while at < size:
        # beyond the last ">" no tag ends
        m = _TOKEN.search(source, at) if at <= last else None
        if not m:
            text(source[at:] if "<" not in source[at:] else re.sub(r"<[a-zA-Z/!][^>]*\Z", "", source[at:]))
            break
        text(source[at : m.start()])
        at = m.end()
        if m.group(1):
            tag = m.group(1).lower()
            if head and tag in ("head", "body", "html", "br"):
                head, begun = False, True
            depth = innermost((tag,))
            if depth and (tag in _BLOCK or not blocks or blocks[-1] < depth):
                close(depth)
            elif depth:  # an inline element that blocks have split: only its own name ends
                link -= tag == "a"
                hidden -= tag in _HIDDEN
                stack[depth] = ("", stack[depth][1])
                places[tag].pop()
            continue
        if not m.group(2):
            continue
        tag, attributes = m.group(2).lower(), m.group(3) or ""
        if tag == "head":
            head = not begun
            continue
        if tag not in _HEAD:
            head, begun = False, True
        if tag in _RAW and not attributes.endswith("/"):
            lower = lower or source.lower()
            end = lower.find(f"</{tag}", at)
            end = size if end < 0 else end
            at = size if end == size else (source.find(">", end) + 1 or size)
            continue
        if tag in ("html", "body"):
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                text(" ")
            continue
        if tag in _BLOCK:
            for ends, until in (*([_ENDS[tag]] if tag in _ENDS else []), _P_ENDS):
                ended = innermost(ends)
                if ended > innermost(until):
                    close(ended)
            child = Node(tag, now, _groups(attributes), now.depth + 1)
            if not hidden:
                now.parts.append(child)
            opened(tag, child)
            now = child
        elif not attributes.endswith("/"):
            opened(tag, now)
            link += tag == "a"
            hidden += tag in _HIDDEN
    return root


def _nodes(root: Node) -> list[Node]:
    """Nodes in page order, parents first; text beside child blocks becomes a node of its own,
    and nodes without text go."""
    out: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        out.append(node)
        if any(isinstance(p, Node) for p in node.parts):
            parts: list = []
            for p in node.parts:
                if isinstance(p, Node):
                    parts.append(p)
                elif parts and isinstance(parts[-1], Node) and parts[-1].tag == "#text":
                    parts[-1].parts.append(p)
                else:
                    parts.append(Node("#text", node, depth=node.depth + 1, parts=[p]))
            loose = sum(len(x) for p in parts if p.tag == "#text" for x in p.parts)
            for p in parts:
                if p.tag == "#text" and loose:
                    p.links = node.links * sum(map(len, p.parts)) // loose
            node.parts = parts
            stack.extend(reversed(parts))
    filled: set[int] = set()
    for node in reversed(out):
        own = any(id(p) in filled if isinstance(p, Node) else p.strip() for p in node.parts)
        if own:
            filled.add(id(node))
    for node in out:
        if node.parts and isinstance(node.parts[0], Node):
            node.parts = [p for p in node.parts if id(p) in filled]
    return [n for n in out if id(n) in filled]


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node: its own subtree, its place among its siblings, and its parent's row."""
    own: dict[int, tuple] = {}
    for node in reversed(nodes):
        if node.parts and isinstance(node.parts[0], Node):
            below = [own[id(p)] for p in node.parts]
            chars, words, links, stops, tags, paragraphs, longest, items = (
                [sum(b[k] for b in below) for k in range(6)] + [max(b[6] for b in below), sum(b[7] for b in below)]
            )
        else:
            value = "".join(node.parts)
            n = value.split()
            chars, words, links = sum(map(len, n)), len(n), min(node.links, len(value))
            stops = value.count(".") + value.count(",") + value.count("!") + value.count("?")
            tags, paragraphs, longest, items = 0, 0, words, 0
        own[id(node)] = (chars, words, links, stops, tags + 1, paragraphs + (node.tag == "p"), longest, items + (node.tag == "li"))
    total = max(1, own[id(nodes[0])][0])
    rows: dict[int, list[float]] = {}
    # of each node's children: how many, how many of each tag, the most characters; places come in order
    families: dict[int, tuple[int, Counter, int]] = {}
    placed: Counter = Counter()
    before = 0
    out = []
    for node in nodes:
        chars, words, links, stops, tags, paragraphs, longest, items = own[id(node)]
        parent = node.parent if node.parent is not None and id(node.parent) in rows else None
        family = id(parent) if parent else id(node)
        if not parent:
            around, same, largest, place = 1, Counter([node.tag]), chars, 0
        else:
            if family not in families:
                children = [p for p in parent.parts if isinstance(p, Node)]
                families[family] = (len(children), Counter(p.tag for p in children), max(own[id(p)][0] for p in children if id(p) in own))
            (around, same, largest), place = families[family], placed[family]
            placed[family] += 1
        alike = same[node.tag]
        group = _TAG_GROUP.get(node.tag, "other")
        row = [float(group == t) for t in _TAGS] + [float(g in node.groups) for g in _GROUPS]
        row += [
            float(node.depth), np.log1p(chars), np.log1p(words), links / max(1, chars), stops / max(1, words), chars / tags, float(paragraphs), float(longest),
            items / tags, chars / total, before / total, float(around), place / around, float(alike), float(len(node.parts)),
            float(chars >= largest),
        ]
        rows[id(node)] = row
        if parent:
            inherited = rows[id(parent)]
            row = row + inherited[: len(_TAGS) + len(_GROUPS) + 16] + [max(a, b) for a, b in zip(inherited[-len(_GROUPS) :], row[len(_TAGS) : len(_TAGS) + len(_GROUPS)], strict=True)]
        else:
            row = row + [0.0] * (len(_TAGS) + len(_GROUPS) + 16) + row[len(_TAGS) : len(_TAGS) + len(_GROUPS)]
        rows[id(node)] = row
        out.append(row)
        if not (node.parts and isinstance(node.parts[0], Node)):
            before += chars
    return np.array(out, np.float32)


def decode(nodes: list[Node], some: np.ndarray, every: np.ndarray) -> list[Node]:
    """The nodes without child blocks that are *in*, in page order."""
    some, every = np.clip(some, 1e-6, 1 - 1e-6), np.clip(every, 1e-6, 1 - 1e-6)
    is_in = np.log(some) + np.log(every)
    is_out = np.log(1 - some)
    is_mixed = np.log(some) + np.log(1 - every)
    number = {id(n): i for i, n in enumerate(nodes)}
    total = np.zeros((len(nodes), 3))
    for i in range(len(nodes) - 1, -1, -1):
        below = [number[id(p)] for p in nodes[i].parts if isinstance(p, Node)]
        total[i, 0] = is_in[i] + sum(total[b, 0] for b in below)
        total[i, 1] = is_out[i] + sum(total[b, 1] for b in below)
        total[i, 2] = is_mixed[i] + sum(total[b].max() for b in below) if below else -np.inf
    state = np.full(len(nodes), -1)
    kept = []
    for i, node in enumerate(nodes):
        if state[i] < 0:
            state[i] = int(total[i].argmax())
        below = [number[id(p)] for p in node.parts if isinstance(p, Node)]
        if state[i] < 2:
            for b in below:
                state[b] = state[i]
        if not below and state[i] == 0:
            kept.append(node)
    return kept


# Pages with known labels


def _words(rng: random.Random, n: int) -> str:
    made = ["".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for i in range(0, n, rng.randint(4, 14)):
        made[i] = made[i].capitalize()
        if i:
            made[i - 1] += rng.choice([".", ".", ",", "!", "?"])
    return " ".join(made) + (rng.choice([".", ".", ".", "", "!"]))


_SYLLABLES = [a + b for a in ("", "b", "d", "f", "g", "k", "l", "m", "n", "p", "r", "s", "t", "v", "st", "tr", "ch") for b in ("a", "e", "i", "o", "u", "en", "er", "on")]


def _attributes(rng: random.Random, group: str | None) -> str:
    """A class or id of the group, of no meaning, or none."""
    how = rng.random()
    if group and how < 0.72:
        word = rng.choice(_TOKENS[group].split())
        word = rng.choice([word, word, f"{word}-{rng.choice(_SYLLABLES)}x", f"{rng.choice(_SYLLABLES)}q {word}", word.capitalize()])
        return f' {rng.choice(["class", "class", "id"])}="{word}"'
    return f' class="{rng.choice(_SYLLABLES)}{rng.choice(_SYLLABLES)}z"' if how < 0.86 else ""


def _links(rng: random.Random, n: int) -> str:
    return "".join(f'<li><a href="/{rng.randint(1, 999)}">{_words(rng, rng.randint(1, 3))}</a></li>' for _ in range(n))


def sample_page(seed: int) -> str:
    """A page whose article text alone is wrapped in private-use signs."""
    rng = random.Random(seed)

    def said(n: int) -> str:
        return f"\ue000{_words(rng, n)}\ue001"

    def paragraph() -> str:
        n = rng.choice([1, 2, 4, 8, 15, 30, 60, 120])
        end = rng.choice(["</p>", "</p>", "</p>", ""])
        if rng.random() < 0.15:
            return f"<p><b>{said(n)}<br>"
        if rng.random() < 0.2:
            return f'<p>{said(n)} <a href="/x">{said(2)}</a> <em>{said(3)}</em>{end}'
        return f"<p>{said(n)}{end}"

    def piece() -> str:
        kind = rng.random()
        if kind < 0.75:
            return paragraph()
        if kind < 0.83:
            return f"<h{(h := rng.randint(2, 4))}>{said(rng.randint(1, 6))}</h{h}>"
        if kind < 0.89:
            return "<ul>" + "".join(f"<li>{said(rng.randint(2, 14))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.93:
            return f"<blockquote><p>{said(rng.randint(5, 40))}</p></blockquote>"
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{said(2)}</td><td>{said(3)}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>"
        return f"<section>{paragraph()}{paragraph()}</section>"

    def boiler(kind: str) -> str:
        words = _words(rng, rng.choice([2, 4, 8, 16, 30]))
        tag = rng.choice(["div", "div", "section", "aside", "p"])
        if kind == "menu":
            inner = f"<ul>{_links(rng, rng.randint(2, 9))}</ul>"
            tag = rng.choice(["nav", "nav", "div", "ul"])
            return f"<{tag}{_attributes(rng, 'menu')}>{inner if tag != 'ul' else _links(rng, rng.randint(2, 9))}</{tag}>"
        if kind == "head":
            tag = rng.choice(["header", "header", "div"])
            return f'<{tag}{_attributes(rng, "head") if tag == "div" else ""}><a href="/">{_words(rng, 2)}</a>{rng.choice(["", f"<p>{words}</p>"])}</{tag}>'
        if kind == "foot":
            tag = rng.choice(["footer", "footer", "div"])
            body = rng.choice([f"&copy; {words}", f"<p>&copy; 2{rng.randint(0, 999):03d} {words}</p>", f"<ul>{_links(rng, 4)}</ul><p>{words}</p>", words])
            return f'<{tag}{_attributes(rng, "foot") if tag == "div" else ""}>{body}</{tag}>'
        if kind == "side":
            tag = rng.choice(["aside", "aside", "div"])
            return f"<{tag}{_attributes(rng, 'side')}><h3>{_words(rng, 2)}</h3>{rng.choice([f'<ul>{_links(rng, 5)}</ul>', f'<p>{words}</p>'])}</{tag}>"
        if kind == "comment":
            body = "".join(f"<{(t := rng.choice(['p', 'li', 'div', 'article']))}{rng.choice(['', ' class=comment'])}>{_words(rng, rng.choice([3, 12, 40]))}</{t}>" for _ in range(rng.randint(1, 5)))
            return f'<{(t := rng.choice(["div", "section", "ol"]))} {rng.choice(["class", "id"])}="{rng.choice(_TOKENS["comment"].split())}">{rng.choice(["", "<h3>" + _words(rng, 2) + "</h3>"])}{body}</{t}>'
        if kind == "form":
            return f'<form action="/s"><label>{_words(rng, 2)}</label><input name="q"><button>{_words(rng, 1)}</button><p>{words}</p></form>'
        group = {"advert": "advert", "notice": "notice", "social": "social"}[kind]
        if tag == "aside" or rng.random() < 0.9:
            word = rng.choice(_TOKENS[group].split())
            return f'<{tag} {rng.choice(["class", "id"])}="{word}">{rng.choice([words, f"<p>{words}</p>", f"<p>{words}</p><a href=/x>{_words(rng, 2)}</a>"])}</{tag}>'
        return f'<{tag}{_attributes(rng, group)}>{words}</{tag}>'

    body = [piece() for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13]))]
    title = f"<h1>{said(rng.randint(1, 12))}</h1>"
    title = rng.choice([title, title, title, f"<header>{title}</header>"])
    if rng.random() < 0.25:
        body = [f"<p><b>{said(rng.randint(3, 20))}<br>"] + (body if rng.random() < 0.6 else [])
    inside = rng.choice([[], [], [], ["advert"], ["social"], ["comment"], ["notice"], ["form"], ["side"]])
    for kind in inside:
        body.insert(rng.randint(0, len(body)), boiler(kind)) if kind != "comment" else body.append(boiler(kind))
    wrap = rng.choice(["article", "article", "article", "main", "div", "section"])
    attributes = _attributes(rng, "content") if wrap in ("div", "section") or rng.random() < 0.4 else ""
    article = f"<{wrap}{attributes}>{title}{''.join(body)}</{wrap}>"
    for _ in range(rng.choice([0, 0, 1, 2])):
        tag = rng.choice(["div", "main", "section"])
        article = f"<{tag}{_attributes(rng, 'content') if rng.random() < 0.5 else ''}>{article}{rng.choice(['', boiler('side'), boiler('advert')])}</{tag}>"
    before = [boiler(k) for k in rng.sample(["menu", "head", "advert", "notice", "social", "form", "side"], rng.randint(0, 4))]
    after = [boiler(k) for k in rng.sample(["foot", "comment", "side", "advert", "menu", "notice", "social", "form"], rng.randint(0, 4))]
    page = f'<html><head><title>{_words(rng, 4)}</title></head><body>{"".join(before)}{article}{"".join(after)}</body></html>'
    return page if rng.random() < 0.9 else page[: int(len(page) * rng.uniform(0.6, 1))]


@dataclass(frozen=True)
class Model:
    some: boosting.Trees
    every: boosting.Trees

    def texts(self, sources: list[str]) -> list[str]:
        """The main text of each page."""
        pages = [_nodes(parse(s)) for s in sources]
        filled = [p for p in pages if p]
        if not filled:
            return [""] * len(sources)
        x = np.concatenate([features(p) for p in filled])
        some, every = self.some.probability(x), self.every.probability(x)
        out, at = [], 0
        for nodes in pages:
            kept = decode(nodes, some[at : at + len(nodes)], every[at : at + len(nodes)]) if nodes else []
            at += len(nodes)
            blocks = (" ".join("".join(n.parts).split()) for n in kept)
            out.append(" ".join(b for b in blocks if b))
        return out


def labelled(source: str) -> tuple[list[Node], np.ndarray, np.ndarray]:
    """The nodes of a sample page, and whether some or every text of each is the article's."""
    nodes = _nodes(parse(source))
    state: dict[int, tuple[int, int]] = {}
    for node in reversed(nodes):
        if node.parts and isinstance(node.parts[0], Node):
            state[id(node)] = tuple(sum(state[id(p)][k] for p in node.parts) for k in (0, 1))
            continue
        value = "".join(node.parts)
        inside = sum(len(s.split("\ue001")[0]) for s in value.split("\ue000")[1:])
        outside = len(re.sub("\ue000[^\ue001]*\ue001?|\\s", "", value))
        state[id(node)] = (inside, outside)
        node.parts = [p.replace("\ue000", "").replace("\ue001", "") for p in node.parts]
    some = np.array([state[id(n)][0] > 0 for n in nodes], float)
    every = np.array([state[id(n)][0] > 0 and state[id(n)][1] == 0 for n in nodes], float)
    return nodes, some, every


def train(pages: int = TRAINING_PAGES) -> Model:
    made = [labelled(sample_page(seed)) for seed in range(pages)]
    made = [m for m in made if m[0]]
    x = np.concatenate([features(m[0]) for m in made])
    some, every = (np.concatenate([m[k] for m in made]) for k in (1, 2))
    held = some > 0
    return Model(boosting.fit(x, some), boosting.fit(x[held], every[held]))


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; NULL or empty pages give an empty text,
    repeated rows the same text each."""

    def made(batches):
        for part in slices(batches, "html"):
            rows = model.texts(part["html"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part["page_id"], pa.int64()), pa.array(part["url"], pa.string()), pa.array(rows, pa.string()), pa.array([len(t) for t in rows], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(made, "page_id long, url string, text string, n_chars long")
