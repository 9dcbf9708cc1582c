"""Main text of web pages: boosted trees over DOM nodes and hierarchical decoding.

A tolerant parser builds the tree of block elements with their texts (character references decoded, scripts, styles,
comments and other unseen content left out). Every block node gets features: its tag, subtree density, attribute tokens of
itself and its ancestors, depth and sibling statistics. Gradient-boosted trees give each node the probability that its
subtree holds main text. Decoding picks the most probable labelling in which a node with main text has only ancestors with
main text, so no descendant of a dropped node is kept; it is exact, by one pass up and one down the tree.

The trees learn from TRAINING_PAGES generated pages of many layouts, fitted once a process on the driver.

Cases: null or empty html gives an empty text; broken markup is read as far as it goes; pages count whole; text outside
any block belongs to the node around it; equal rows get equal results; empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Trees, fit

TRAINING_PAGES, TREES, DEPTH = 600, 70, 4
#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style title template noscript svg math iframe object audio video canvas textarea select option button noembed noframes datalist map".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "legend li main menu nav ol p pre section summary table caption tbody thead tfoot tr td th ul".split()
)
#: A start tag ends an open element of these, up to the boundary.
ENDS = {
    **{t: ({"p"}, {"button", "table", "td", "th", "caption", "object"}) for t in BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"}},
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}), "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "p"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th", "p"}, {"table"}), "thead": ({"tr", "td", "th", "p"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: Comments, declarations and tags. A quote that never ends is a character like others, and a tag that never ends takes what
#: is left. Nothing is tried twice, so pages take linear time.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++)")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Attribute tokens, by what they suggest.
GROUPS = {
    "main": "content article post entry main body story text blog read page prose single hentry",
    "menu": "nav navbar menu navigation breadcrumb breadcrumbs tabs topbar toolbar pager pagination skip links link",
    "advert": "ad ads adv advert advertisement banner sponsor sponsored promo promoted promotion adbox dfp outbrain taboola",
    "side": "sidebar side aside widget rail related recommended recommend popular trending more also tags tag archive",
    "edge": "header head masthead footer foot copyright legal colophon site logo brand",
    "comment": "comment comments reply replies respond disqus discussion feedback reviews review reader",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup paywall privacy",
    "form": "form search login signin register contact input field",
    "share": "share sharing social follow facebook twitter author bio meta byline",
}
SUGGESTS = {token: k for k, words in enumerate(GROUPS.values()) for token in words.split()}
TAGS = ("p", "h", "ul", "li", "div", "section", "article", "main", "nav", "aside", "header", "footer", "form", "table", "cell", "quote", "body")
_CLASS_OF = {f"h{k}": "h" for k in range(1, 7)} | {"ol": "ul", "dl": "ul", "menu": "ul", "dd": "li", "dt": "li", "td": "cell", "th": "cell", "tr": "cell", "tbody": "table", "thead": "table", "blockquote": "quote", "pre": "quote", "figure": "quote", "html": "body"}
NAMES = (
    *(f"is_{t}" for t in TAGS), *(f"own_{g}" for g in GROUPS), *(f"above_{g}" for g in GROUPS), *(f"under_{t}" for t in ("article", "main", "nav", "aside", "header", "footer", "form", "li")),
    "depth", "own_chars", "chars", "share", "link_share", "blocks", "density", "siblings", "place", "sibling_chars", "prose", "stops", "before", "holds_h1", "holds_article", "copyright", "words_a_block",
)


class Node:
    __slots__ = ("tag", "tokens", "parent", "children", "parts", "order", "at", "link_chars", "own_chars", "chars", "links", "blocks", "stops", "prose", "h1", "article", "sign", "before", "label")

    def __init__(self, tag: str, tokens: list[str], parent: Node | None, order: int):
        self.tag, self.tokens, self.parent, self.order = tag, tokens, parent, order
        self.children: list[Node] = []
        self.at = len(parent.children) if parent is not None else 0
        self.parts: list[tuple[int, str]] = []  # (place, text of one block)
        self.link_chars = 0
        self.label: int | None = None


def parse(page: str | None) -> list[Node]:
    """The block nodes of a page in order, the root first; parts hold each block's text, white space collapsed."""
    root = Node("html", [], None, 0)
    nodes, stack = [root], [root]
    opened: list[str] = []  # every open element, inline ones too
    count: Counter[str] = Counter()  # of them, by tag
    place, unseen, links = 0, 0, 0
    buffer: list[str] = []
    link_buffer = 0

    def flush() -> None:
        nonlocal place, link_buffer
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            stack[-1].parts.append((place, text))
            stack[-1].link_chars += min(link_buffer, len(text))
            place += 1
        link_buffer = 0

    def text_of(raw: str) -> None:
        nonlocal link_buffer
        if raw and not unseen:
            text = html.unescape(raw) if "&" in raw else raw
            buffer.append(text)
            if links:
                link_buffer += len(text.strip())

    def close_to(depth: int) -> None:
        nonlocal unseen, links
        while len(opened) > depth:
            tag = opened.pop()
            count[tag] -= 1
            if tag in UNSEEN:
                unseen -= 1
            elif tag == "a":
                links -= 1
            elif tag in BLOCKS and not unseen:
                flush()
                if len(stack) > 1:
                    stack.pop()

    page, at = page or "", 0
    lowered = ""
    while match := TAG.search(page, at):
        text_of(page[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            if count[tag]:
                close_to(len(opened) - 1 - opened[::-1].index(tag))
            elif tag == "p":
                flush()
            continue
        ends, bounds = ENDS.get(tag, ((), ()))
        if left := sum(map(count.__getitem__, ends)):
            k = len(opened)
            for depth in range(len(opened) - 1, -1, -1):
                if opened[depth] in bounds:
                    break
                if opened[depth] in ends:
                    k, left = depth, left - 1
                    if not left:
                        break
                elif opened[depth] in BLOCKS and opened[depth] != "p":
                    break
            close_to(k)
        if tag in RAW:
            # everything up to the end tag is text
            lowered = lowered or page.lower()
            end = lowered.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
        if tag in VOID:
            if tag == "br":
                text_of(" ")
            elif tag == "hr" and not unseen:
                flush()
            continue
        if tag in ("html", "body") and count[tag]:
            continue
        opened.append(tag)
        count[tag] += 1
        if tag in UNSEEN:
            unseen += 1
        elif tag == "a":
            links += 1
        elif tag in BLOCKS and not unseen:
            flush()
            tokens = [t.lower() for name, value in ATTRIBUTE.findall(match[3]) if name.lower() in ("class", "id", "role") for t in TOKEN.findall(value)]
            node = Node(tag, tokens, stack[-1], len(nodes))
            stack[-1].children.append(node)
            stack.append(node)
            nodes.append(node)
        if tag == "body" and count["head"]:
            # an unclosed head ends where the body begins
            unseen -= count.pop("head")
            opened[:] = [t for t in opened if t != "head"]
    text_of(page[at:])
    close_to(0)
    flush()
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    """One row of NAMES for each node."""
    before = 0
    for node in nodes:
        node.before = before
        own = [text for _, text in node.parts]
        node.own_chars = sum(map(len, own))
        before += node.own_chars
        node.chars, node.links, node.blocks = node.own_chars, node.link_chars, len(own)
        joined = " ".join(own)
        node.stops = sum(joined.count(c) for c in ".!?")
        node.prose = joined.count(" ") + len(own)
        node.h1, node.article = node.tag == "h1", node.tag in ("article", "main")
        node.sign = "©" in joined
    for node in reversed(nodes):
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.links += node.links
            up.blocks += node.blocks
            up.stops += node.stops
            up.prose += node.prose
            up.h1, up.article, up.sign = up.h1 or node.h1, up.article or node.article, up.sign or node.sign
    total = max(1, nodes[0].chars)
    out = np.zeros((len(nodes), len(NAMES)))
    index = {n: k for k, n in enumerate(NAMES)}
    n_tags, n_groups = len(TAGS), len(GROUPS)
    above = index["own_main"] + n_groups
    under = [(t, index[f"under_{t}"]) for t in ("article", "main", "nav", "aside", "header", "footer", "form", "li")]
    at = index["depth"]
    for k, node in enumerate(nodes):
        row, up = out[k], node.parent
        kind = _CLASS_OF.get(node.tag, node.tag)
        if kind in TAGS:
            row[TAGS.index(kind)] = 1
        for t in node.tokens:
            if t in SUGGESTS:
                row[n_tags + SUGGESTS[t]] = 1
        if up is not None:
            high = out[up.order]
            row[above : above + n_groups] = np.maximum(high[above : above + n_groups], high[n_tags : n_tags + n_groups])
            for t, j in under:
                row[j] = high[j] or up.tag == t
            row[at] = high[at] + 1
            siblings = len(up.children)
            place = node.at / siblings
            around = (up.chars - node.chars) / max(1, siblings - 1)
        else:
            siblings, place, around = 1, 0.0, 0.0
        chars = node.chars
        row[at + 1 :] = (
            math.log1p(node.own_chars), math.log1p(chars), chars / total, node.links / max(1, chars), math.log1p(node.blocks), chars / (1 + node.blocks), math.log1p(siblings), place, math.log1p(around),
            node.prose / max(1, node.blocks), 100 * node.stops / max(1, chars), node.before / total, node.h1, node.article, node.sign, math.log1p(node.prose / max(1, node.blocks)),
        )
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The most probable labelling in which every kept node's parent is kept."""
    yes = -np.logaddexp(0, -odds)
    no = -np.logaddexp(0, odds)
    drop, keep = no.copy(), yes.copy()
    for node in reversed(nodes):
        if node.parent is not None:
            k, up = node.order, node.parent.order
            drop[up] += drop[k]
            keep[up] += max(drop[k], keep[k])
    kept = [bool(keep[0] >= drop[0])]
    for node in nodes[1:]:
        kept.append(kept[node.parent.order] and bool(keep[node.order] >= drop[node.order]))
    return kept


def main_text(nodes: list[Node], kept: list[bool]) -> str:
    return "\n".join(text for _, text in sorted(part for node, k in zip(nodes, kept, strict=True) if k for part in node.parts))


# training pages


def _generated(r: random.Random) -> tuple[str, str]:
    """A page and its main text."""
    letters = r.choice(("etaoinshrdlu", "aeioubcdñrslt", "eninschtüßrda", "eéèauxlrtionç"))
    word = lambda: "".join(r.choice(letters) for _ in range(r.randint(1, 11)))
    noise = r.choice(("",) * 6 + ("***", "$$$", "!!", " |", "&&&", "%%%"))

    def prose(low: int, high: int) -> str:
        words = [word() + (noise if noise and r.random() < 0.8 else "") for _ in range(r.randint(low, high))]
        text = " ".join(w + r.choice(("", "", "", "", "", ",", ".")) for w in words)
        return text[:1].upper() + text[1:] + r.choice((".", ".", ".", "", "?"))

    truth: list[str] = []
    esc = lambda t: html.escape(t, quote=r.random() < 0.5)

    def shown(tag: str, text: str, attrs: str = "", close: bool = True) -> str:
        truth.append(" ".join(text.split()))
        words, inner = text.split(" "), esc(text)
        if len(words) > 3 and r.random() < 0.25:
            k = r.randint(0, len(words) - 2)
            mark = r.choice(("b", "em", "a href=\"/x\"", "strong", "span"))
            inner = " ".join([*map(esc, words[:k]), f"<{mark}>{esc(words[k])}</{mark.split()[0]}>", *map(esc, words[k + 1 :])])
        return f"<{tag}{attrs}>{inner}" + (f"</{tag}>" if close else "")

    def links(n: int, tag: str = "li") -> str:
        return "".join(f"<{tag}><a href=\"/{word()}\">{word()}{' ' + word() if r.random() < 0.3 else ''}</a></{tag}>" for _ in range(n))

    def named(tokens: str) -> str:
        return f" {r.choice(('class', 'class', 'id'))}=\"{r.choice(tokens.split('|'))}\""

    def boiler(kind: str) -> str:
        if kind == "menu":
            inner = f"<ul>{links(r.randint(3, 9))}</ul>" if r.random() < 0.8 else links(r.randint(3, 7), "span")
            if r.random() < 0.15:
                return f"<table><tr>{links(r.randint(2, 5), 'td')}</tr></table>"
            return r.choice((f"<div id=\"top\">{links(4, 'span')}</div>", f"<div role=\"navigation\">{inner}</div>", f"<nav>{inner}</nav>", f"<nav{named('menu|main-nav|navbar')}>{inner}</nav>", f"<div{named('menu|navigation|nav|top-menu|breadcrumbs')}>{inner}</div>"))
        if kind == "header":
            inner = r.choice((f"<h1>{word()} {word()}</h1>", f"<div class=\"logo\">{word()}</div>", f"<p>{prose(2, 8)}</p>")) + (boiler("menu") if r.random() < 0.5 else "")
            return r.choice((f"<header>{inner}</header>", f"<div{named('header|site-header|masthead')}>{inner}</div>"))
        if kind == "footer":
            inner = r.choice((f"&copy; {word()}.example.com &middot; {prose(2, 25)}", f"<p>&copy; {r.randint(1999, 2026)} {prose(2, 12)}</p>", f"<ul>{links(4)}</ul><p>{prose(3, 15)}</p>", prose(3, 30)))
            return r.choice((f"<footer>{inner}</footer>", f"<footer>{inner}</footer>", f"<div{named('footer|site-footer|page-footer|copyright')}>{inner}</div>"))
        if kind == "advert":
            inner = r.choice((prose(2, 40), f"<p>{prose(3, 30)}</p>", f"<a href=\"/buy\">{prose(3, 12)}</a>"))
            return r.choice(("<!-- ad -->", "")) + f"<{(t := r.choice(('div', 'div', 'aside', 'section')))}{named('ad|ads|advert|banner-ad|sponsored|promo|ad-slot|advertisement')}>{inner}</{t}>"
        if kind == "side":
            inner = r.choice((f"<h3>{prose(1, 4)}</h3><ul>{links(r.randint(2, 8))}</ul>", f"<p>{prose(5, 60)}</p>", f"<h2>{prose(1, 4)}</h2><p>{prose(8, 40)}</p><ul>{links(3)}</ul>"))
            return r.choice((f"<aside>{inner}</aside>", f"<aside{named('sidebar|widget|related')}>{inner}</aside>", f"<div{named('sidebar|side|widget|related-posts|rail|recommended')}>{inner}</div>"))
        if kind == "notice":
            inner = r.choice((prose(5, 30), f"<p>{prose(5, 40)}</p><button>{word()}</button>", f"<p>{prose(5, 20)}</p>"))
            return f"<{(t := r.choice(('div', 'div', 'section')))}{named('cookie-notice|cookie|notice|consent|newsletter|popup|gdpr-banner|alert|subscribe')}>{inner}</{t}>"
        if kind == "form":
            inner = f"<label>{prose(1, 4)}</label><input name=\"q\"><p>{prose(2, 12)}</p><button>{word()}</button>"
            return r.choice((f"<form action=\"/s\">{inner}</form>", f"<form{named('search|login|contact-form')}>{inner}</form>", f"<div{named('search-form|login|form')}>{inner}</div>"))
        if kind == "comments":
            one = lambda: r.choice((f"<div class=\"comment\"><p>{prose(4, 80)}</p></div>", f"<li class=\"comment\"><span>{word()}</span><p>{prose(4, 50)}</p></li>", f"<p>{prose(4, 60)}</p>", f"<article class=\"comment\"><p>{prose(4, 60)}</p></article>"))
            inner = (f"<h2>{prose(1, 3)}</h2>" if r.random() < 0.6 else "") + "".join(one() for _ in range(r.randint(1, 6)))
            return f"<{(t := r.choice(('section', 'div', 'div', 'ol')))}{named('comments|comment-list|replies|discussion|reader-comments|disqus')}>{inner}</{t}>"
        inner = "".join(f"<a href=\"/{s}\">{s}</a> " for s in ("share", "tweet", word()))
        return f"<div{named('share|social|sharing-buttons')}>{inner}</div>"

    top = [k for k in ("notice", "header", "menu", "advert", "form", "side") if r.random() < {"menu": 0.8, "advert": 0.5}.get(k, 0.25)]
    bottom = [k for k in ("share", "comments", "side", "advert", "form", "footer", "notice") if r.random() < {"footer": 0.8, "comments": 0.35}.get(k, 0.2)]
    inside = [k for k in ("advert", "share", "side", "form", "notice", "comments", "menu") if r.random() < 0.08]
    r.shuffle(top)
    blocks = []
    title = prose(1, 14)
    if r.random() < 0.85:
        h = shown(r.choice(("h1", "h1", "h1", "h2")), title)
        blocks.append(f"<header>{h}</header>" if r.random() < 0.15 else h)
    for _ in range(r.choice((1, 1, 2, 3, 4, 6, 8, 15, 30))):
        kind = r.random()
        if kind < 0.75:
            blocks.append(shown("p", prose(*r.choice(((1, 4), (5, 40), (20, 120)))), close=r.random() < 0.9))
        elif kind < 0.82:
            blocks.append(shown(r.choice(("h2", "h3")), prose(1, 8)))
        elif kind < 0.88:
            t = r.choice(("ul", "ol"))
            blocks.append(f"<{t}>" + "".join(shown("li", prose(1, 25)) for _ in range(r.randint(1, 6))) + f"</{t}>")
        elif kind < 0.89:
            blocks.append(shown("pre", prose(2, 12)))
        elif kind < 0.92:
            blocks.append("<blockquote>" + shown("p", prose(5, 40)) + "</blockquote>")
        elif kind < 0.94:
            blocks.append("<table>" + "".join("<tr>" + "".join(shown("td", prose(1, 4)) for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
        elif kind < 0.97:
            blocks.append(shown("div", prose(5, 60)))
        else:
            # an unclosed inline tag and a line break before the next paragraph
            truth.append(text := prose(3, 40))
            blocks.append(f"<p><b>{esc(text)}<br>")
    for k in inside:
        blocks.insert(r.randint(1, len(blocks)), boiler(k))
    if len(blocks) > 3 and r.random() < 0.25:
        # parts with headings of their own
        cut = sorted(r.sample(range(1, len(blocks)), r.randint(1, min(4, len(blocks) - 1))))
        t = r.choice(("section", "div", "div"))
        blocks = [*blocks[: cut[0]], *(f"<{t}>" + "".join(blocks[a:b]) + f"</{t}>" for a, b in zip(cut, [*cut[1:], len(blocks)], strict=True))]
    body = "".join(blocks)
    body = r.choice((
        f"<article>{body}</article>", f"<article>{body}</article>", f"<article{named('post|entry|story')}>{body}</article>", f"<main>{body}</main>", f"<main><article>{body}</article></main>",
        f"<div{named('content|post-content|article-body|entry|main|story-text')}>{body}</div>", f"<div id=\"main\"><div{named('content|post')}>{body}</div></div>", f"<section{named('content|article')}>{body}</section>", f"<div>{body}</div>", f"<div{named('col-main|center|text|col1|c3')}>{body}</div>", body,
    ))
    page = "".join(map(boiler, top)) + body + "".join(map(boiler, bottom))
    if r.random() < 0.3:
        page = f"<div{named('wrapper|page|container|site')}>{page}</div>"
    head = f"<head><meta charset=\"utf-8\"><title>{esc(title)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";f(1);</script></head>" if r.random() < 0.9 else ""
    return f"<!DOCTYPE html><html lang=\"en\">{head}<body>{page}" + ("</body></html>" if r.random() < 0.9 else ""), "\n".join(truth)


def _labelled(page: str, truth: str) -> list[Node]:
    """The nodes of a generated page; a node's label is whether its subtree holds main text."""
    nodes = parse(page)
    left: dict[str, int] = {}
    for line in truth.split("\n"):
        left[line] = left.get(line, 0) + 1
    for node in reversed(nodes):
        own = False
        for _, text in node.parts:
            if left.get(text):
                own = True
        node.label = int(own or any(c.label for c in node.children))
    return nodes


@cache
def trained(pages: int = TRAINING_PAGES, seed: int = 11) -> Trees:
    r = random.Random(seed)
    rows, labels = [], []
    for _ in range(pages):
        nodes = _labelled(*_generated(r))
        rows.append(features(nodes))
        labels += [n.label for n in nodes]
    return fit(np.concatenate(rows), np.array(labels), list(NAMES), TREES, DEPTH, rate=0.25)


def extract_page(page: str | None, model: Trees) -> str:
    nodes = parse(page)
    return main_text(nodes, decode(nodes, model.score(features(nodes))))


def extract(df: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``df`` (page_id, url, html)."""
    trees = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                pages = [parse(p) for p in batch.column(2).slice(k, 128).to_pylist()]
                odds = trees.score(np.concatenate([features(nodes) for nodes in pages]))
                texts, at = [], 0
                for nodes in pages:
                    texts.append(main_text(nodes, decode(nodes, odds[at : at + len(nodes)])))
                    at += len(nodes)
                columns = [batch.column(0).slice(k, 128), batch.column(1).slice(k, 128), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return df.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
