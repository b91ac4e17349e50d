"""Main text of web pages by consensus host paths.

A page's containers are scored by their paragraphs. Its best containers vote, under a path of tags and classes in which
digits and places are generalised, and Spark adds the votes of a host. Every page is then extracted again with the path
that has most of its host's votes among all that the page itself has, or with one inside of it that does better where it
occurs. A page falls back to its own best container if that path holds little of, or far more than, what this one holds,
or if no path has votes, and to the whole body if it has no container.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.base import per_text, stored, text_or_empty

_TAG = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"(?:[^\"]*+\")?+|'(?:[^']*+')?+)*+)(?:>|\Z))", re.DOTALL)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
#: Elements whose content is text for no reader.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "object", "select", "xmp", "noframes", "annotation", "annotation-xml"}
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE) for t in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
          "math", "semantics", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msup", "msub", "msubsup", "msqrt", "mroot", "mover", "munder", "munderover", "mstyle", "mspace", "mpadded", "mfenced"}
#: Elements that are never part of an article, and the words of class, id and role that mark others so.
SKIP = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "input", "head"}
#: Words of the languages of the corpus: English, German, French and Spanish.
NOT_TEXT = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "anuncio", "anuncios", "anzeige", "anzeigen", "aviso", "avisos", "commentaire", "commentaires",
            "comment", "comments", "comentario", "comentarios", "complementary", "consent", "cookie", "cookies", "dialog", "disclaimer", "disqus", "formulaire", "formular", "formulario",
            "gdpr", "hinweis", "hinweise", "kommentar", "kommentare", "lateral", "modal", "newsletter", "notice", "notices", "notification", "popup", "promo", "promoted", "publicidad",
            "publicite", "recommended", "related", "replies", "respond", "seitenleiste", "sidebar", "signup", "sponsor", "sponsored", "subscribe", "subscription", "teaser", "werbung"}
MAY_WRAP = {"banner", "breadcrumb", "breadcrumbs", "buscar", "cabecera", "compartir", "contentinfo", "entete", "footer", "fusszeile", "header", "kopfzeile", "masthead", "menu", "menue",
            "nav", "navbar", "navegacion", "navigation", "pager", "pagination", "partager", "recherche", "search", "share", "sharing", "skip", "social", "suche", "teilen", "toolbar",
            "topbar", "widget"}
SKIP_WORDS = NOT_TEXT | MAY_WRAP
_WORDS = re.compile(r"[a-z]+")
#: A class with one of these speaks of what its element has beside it; these make a header an article's own; and these at
#: the end of a class say where or how, not what.
MODIFIERS = {"has", "have", "with", "without", "no", "non", "not", "hide", "hides", "show", "shows", "is"}
OWN_HEADER = {"article", "chapter", "content", "entry", "page", "post", "review", "section", "story"}
PLACES = {"area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "center", "col", "column", "container", "content", "count", "desktop", "fixed", "form", "group", "holder", "icon", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "module", "outer", "panel", "placeholder", "post", "posts", "primary", "right", "row", "secondary", "section", "slot", "sticky", "stories", "text", "thread", "title", "toggle", "top", "unit", "wrap", "wrapper", "zone"}
#: How an element is ruled out: by a word that a wrapper of the page may bear, by one of what is no article, for good.
WRAPPER, OTHER, SURE = 1, 2, 3
#: Paragraph-like tags whose text scores for the containers around it, and tags that may be containers.
PARAGRAPH = {"p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "td", "li", "dd", "dt", "figcaption"}
CONTAINER = {"article", "main", "section", "div", "td", "body", "center", "table", "tbody", "tr", "span"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_ENDS_P = {"address", "article", "aside", "blockquote", "center", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}


def _id(path: str) -> int:
    return int.from_bytes(hashlib.blake2b(path.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class Node:
    __slots__ = ("tag", "path", "parent", "skip", "first", "last", "score", "out", "box", "inside", "never")

    def __init__(self, tag: str, step: str, parent: Node | None, out: int, first: int):
        """``out``: how the element itself is ruled out, 0 if it is not. A path is a number that its steps make."""
        self.tag, self.parent, self.out, self.first = tag, parent, out, first
        self.path = _id(f"{parent.path}/{step}") if parent is not None else 0
        self.skip = out > 0 or (parent is not None and parent.skip)
        self.never = out == SURE or (parent is not None and parent.never)
        self.box = self if tag in CONTAINER else parent.box if parent is not None else None
        self.inside = tag in ("article", "main") or (parent is not None and parent.inside)
        self.last, self.score = None, 0.0


def _ruled_out(token: str, inside: bool) -> int:
    """How a class, id or role rules an element out.

    A class is what its last word says, places aside: "ad-slot" is an ad, "social-impact" is nothing social. An article's
    own header stays: "post-header", and any that stands in an article (``inside``).
    """
    words = _WORDS.findall(token)
    while len(words) > 1 and words[-1] in PLACES:
        words.pop()
    if not words or words[-1] not in SKIP_WORDS or not MODIFIERS.isdisjoint(words[:-1]):
        return 0
    if words[-1] == "header" and (inside or not OWN_HEADER.isdisjoint(words[:-1])):
        return 0
    return OTHER if words[-1] in NOT_TEXT else WRAPPER


def _general(tag: str, attrs: str, inside: bool = False) -> tuple[str, int]:
    """A step of a path, digits generalised, and how its attributes rule it out."""
    if not attrs.strip():
        return tag, 0
    kind, skip = "", 0
    for k, a, b, c in _ATTR.findall(attrs):
        k, v = k.lower(), (a or b or c).lower()
        if k in ("class", "id", "role"):
            if k == "class":
                kind = "." + ".".join(sorted({re.sub(r"\d+", "#", x) for x in v.split()}))
            skip = max([skip, *(_ruled_out(x, inside) for x in v.split())])
        elif k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and re.search(r"display\s*:\s*none", v)):
            skip = SURE
    return tag + kind, skip


def parse(page: str) -> tuple[list[tuple[str, Node, float, bool]], list[Node]]:
    """The text blocks of a page as (text, node, share of linked text, glued) in page order, and its container nodes.

    A node's blocks are those numbered first to last - 1. Character references are decoded and white space made one
    space; blocks without text are left out. A glued block follows the one before without white space: a span that is
    ruled out cuts a line in blocks.
    """
    root = Node("", "", None, 0, 0)
    cur, blocks, nodes = root, [], []
    buf: list[str] = []
    links = [0]
    in_link, at = 0, 0
    # open spans: the node that each stands in, or its own if it is ruled out, and whether that is so
    spans: list[tuple[Node, bool]] = []
    apart = [True]
    is_open: Counter[str] = Counter()

    def end_block(inline: bool = False) -> None:
        raw = _html.unescape("".join(buf))
        text = " ".join(raw.split())
        if text:
            blocks.append((text, cur, min(1.0, links[0] / len(text)), not apart[0] and not raw[0].isspace()))
            apart[0] = raw[-1].isspace()
        apart[0] = apart[0] or not inline or (raw != "" and not text)
        buf.clear()
        links[0] = 0

    def close(node: Node) -> Node:
        node.last = len(blocks)
        is_open[node.tag] -= 1
        return node.parent

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue  # inside an element whose content is no markup
        if m.start() > at:
            buf.append(page[at : m.start()])
            links[0] += (m.start() - at) * bool(in_link)
        at = m.end()
        if m["tag"] is None:
            if m["cdata"]:
                buf.append(_html.escape(m["cdata"]))
            continue
        tag = m["tag"].lower()
        if tag in RAW:
            if not m["end"] and not m["attrs"].endswith("/"):
                at = _RAW_END[tag].search(page, at).end()
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = max(0, in_link + (-1 if m["end"] else 1))
            if tag != "span":
                continue
            if m["end"]:
                while spans and spans[-1][0].last is not None:
                    spans.pop()  # closed by an outer block
                # the end of a span that was opened outside of the block counts for nothing, as in browsers
                if spans and spans[-1][0] is cur and spans.pop()[1]:
                    end_block(inline=True)
                    cur = close(cur)
                continue
            step, out = _general(tag, m["attrs"])
            if out:
                end_block(inline=True)
                cur = Node(tag, step, cur, out, len(blocks))
                is_open[tag] += 1
                nodes.append(cur)
            spans.append((cur, out > 0))
            continue
        if tag == "br":
            buf.append(" ")
            continue
        end_block()
        in_link = 0
        if m["end"]:
            if is_open[tag]:
                while cur.tag != tag:
                    cur = close(cur)
                cur = close(cur)
            continue
        shut = CLOSES.get(tag, set()) | ({"p"} if tag in _ENDS_P else set())
        n = cur
        while n is not root and n.tag in shut:
            cur = n = close(n)
        if tag in VOID or tag == "html":
            continue
        step, out = _general(tag, m["attrs"], cur.inside)
        # header is ruled out, too, unless it stands in an article
        if tag in SKIP or (tag == "header" and not cur.inside):
            out = SURE
        elif tag in ("body", "article", "main"):
            out = 0
        cur = Node(tag, step, cur, out, len(blocks))
        is_open[tag] += 1
        nodes.append(cur)
        if m["attrs"].endswith("/") and tag in ("svg", "path"):
            cur = close(cur)
    if at < len(page):
        buf.append(page[at:])
    end_block()
    while cur is not root:
        cur = close(cur)
    _restore(blocks, nodes)
    return blocks, nodes


def _restore(blocks: list, nodes: list[Node]) -> None:
    """Takes back what a class, id or role ruled out, if nothing else of the page can be its article.

    What is ruled out stays so wherever the page has an article, a main or paragraphs in a container outside of it,
    however little text that is. Else an element that has an article, a main or a first heading and paragraphs is a
    wrapper; without such an element, one whose word a wrapper may bear and that has paragraphs.
    """
    if not any(n.out in (WRAPPER, OTHER) for n in nodes):
        return
    told: dict[Node, bool] = {}  # nodes with paragraphs that are not all links
    for text, node, linked, _ in blocks:
        if node.never or linked > 0.8 or not (node.tag in PARAGRAPH and node.tag not in HEADINGS or node.inside or node.out):
            continue
        if not node.skip and (node.inside or (node.box is not None and node.box.tag != "body")):
            return
        told[node] = True
    heads = {n: True for n in nodes if not n.never and n.tag in ("article", "main", "h1") and n.first < n.last}
    for n in reversed(nodes):  # from the inside out
        for has in (told, heads):
            if has.get(n) and n.parent is not None:
                has[n.parent] = True
    loose = any(not b[1].skip and b[1].tag in PARAGRAPH and b[1].tag not in HEADINGS for b in blocks)
    strong = {n for n in nodes if n.out in (WRAPPER, OTHER) and told.get(n) and heads.get(n)}
    weak = set() if strong or loose else {n for n in nodes if n.out == WRAPPER and told.get(n)}
    for n in nodes:
        n.skip = n.parent.skip or (n.out > 0 and n not in strong and n not in weak)


def scored(blocks: list, nodes: list[Node]) -> list[tuple[int, float]]:
    """Container paths and scores, best first. Text that is not linked scores for its nearest container, half for the
    next one out and a quarter beyond; semantic tags weigh more, and a path that occurs often is summed."""
    for text, node, linked, _ in blocks:
        if node.skip:
            continue
        n, share = node.box, (len(text) * (1 - linked)) ** 0.5 * (1.0 if node.tag in PARAGRAPH else 0.6)
        while n is not None and share > 0.2:
            n.score += share
            share /= 2
            n = n.parent.box if n.parent is not None else None
    weight = {"article": 1.5, "main": 1.3, "body": 0.4, "td": 0.9, "tr": 0.5, "tbody": 0.5, "table": 0.5}
    total: dict[int, float] = {}
    for n in nodes:
        if n.score > 0 and not n.skip:
            total[n.path] = max(total.get(n.path, 0.0), n.score * weight.get(n.tag, 1.0))
    return sorted(total.items(), key=lambda x: (-x[1], x[0]))


def _joined(blocks: list) -> str:
    """The texts of blocks that are not ruled out, with a space wherever white space or a block's end lay between."""
    out, apart = [], True
    for text, node, _, glued in blocks:
        apart = apart or not glued
        if not node.skip:
            out += [" ", text] if apart and out else [text]
            apart = False
    return "".join(out)


def _held(blocks: list, nodes: list[Node], path: int) -> list[tuple[int, int]]:
    """First and last block + 1 of the outermost nodes with text that have this path, in page order."""
    spans, reach, shown = [], 0, [0]
    for b in blocks:
        shown.append(shown[-1] + (not b[1].skip))
    for n in nodes:
        if n.path == path and not n.skip and n.first >= reach and shown[n.last] > shown[n.first]:
            spans.append((n.first, n.last))
            reach = n.last
    return spans


def text_of(blocks: list, nodes: list[Node], paths: list[int]) -> str:
    """The text of the first of ``paths`` that the page has: of all its outermost nodes with text, in page order."""
    for path in paths:
        spans = _held(blocks, nodes, path)
        if spans:
            return " ".join(filter(None, (_joined(blocks[s:e]) for s, e in spans)))
    return _joined(blocks)


def host(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def candidates(pages: DataFrame, best: int = 3) -> DataFrame:
    """key, host, v array of (path, vote) for each row of ``pages`` (key, host, html): all its containers' paths, as numbers.

    Each page gives its ``best`` containers votes in proportion to their scores, the others none.
    """

    def run(texts: list[bytes]) -> list[pa.Array]:
        paths, shares, offsets = [], [], [0]
        for t in texts:
            found = scored(*parse(t.decode("utf-8", "replace")))
            top = sum(s for _, s in found[:best])
            paths += [p for p, _ in found]
            # rounded, so that sums are the same in any order
            shares += [int(1000 * (s / top) ** 2) if i < best else 0 for i, (_, s) in enumerate(found)]
            offsets.append(len(paths))
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(paths, pa.int64()), pa.array(shares, pa.int64())], ["path", "vote"]))]

    return per_text(pages, run, "v array<struct<path:bigint,vote:bigint>>", ["key", "host"], text="html")


#: Votes for nothing that are added to a path's for its mean, so that one page alone weighs less.
PRIOR = 60


def chosen(pages: DataFrame) -> DataFrame:
    """key, most, mean: of the voted paths that a page has, the one with most of its host's votes and the one with the
    highest mean vote, each vote weighed by itself, so that a teaser on other pages does no harm. ``pages``: key, host,
    html."""
    each = stored(candidates(pages), "paths").select("key", "host", F.inline("v"))
    voted = (each.groupBy("host", "path").agg(F.sum("vote").alias("votes"), F.sum(F.col("vote") * F.col("vote")).alias("squares")).where("votes > 0")
             .select("host", "path", "votes", (F.col("squares") / (F.col("votes") + PRIOR)).alias("mean")))
    best = (each.join(stored(voted, "votes"), ["host", "path"]).groupBy("key")
            .agg(F.max(F.struct("votes", "path")).alias("most"), F.max(F.struct("mean", "path")).alias("mean")))
    return stored(best.select("key", F.col("most.path").alias("most"), F.col("mean.path").alias("mean")), "chosen")


#: A path is not taken if it holds less than LITTLE or more than FAR_MORE times the unlinked text of the page's own best.
LITTLE, FAR_MORE = 0.2, 2.0


def _paths(blocks: list, nodes: list[Node], most: int | None, mean: int | None) -> list[int]:
    """The path to extract a page with: the host's or the page's own best; none if the page has no container."""
    own = scored(blocks, nodes)
    if not own:
        return []
    best, have = own[0][0], {p for p, _ in own}
    path, near = (p if p in have else best for p in (most, mean))
    # a wrapper that all templates of a host share has more votes than the container of each, but fewer a page
    n = next((n for n in nodes if n.path == near), None)
    while n is not None and n.path != path:
        n = n.parent
    if n is not None:
        path = near
    if path != best:
        mine, held = (sum(len(b[0]) * (1 - b[2]) for s, e in _held(blocks, nodes, x) for b in blocks[s:e] if not b[1].skip) for x in (best, path))
        if not LITTLE * mine <= held <= FAR_MORE * mine:
            path = best
    return [path]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages`` (page_id, url, html).

    Null html counts as empty and gives an empty text; pages with a null or odd url share the empty host; repeated rows give a
    row each; other columns are ignored. An empty table gives an empty result.
    """
    # equal pages of a host have one key: what is chosen for one is right for all
    p = pages.select("page_id", "url", "html").withColumn("host", host()).withColumn("key", F.xxhash64("host", "html"))
    joined = p.join(chosen(p.select("key", "host", "html")), "key", "left").select("page_id", "url", "most", "mean", "html")

    return _again(joined)


def _again(joined: DataFrame) -> DataFrame:
    src = joined.select("page_id", "url", "most", "mean", text_or_empty("html").cast("binary").alias("html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:2])

    def run(batches):
        for b in batches:
            texts = []
            for most, mean, t in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                blocks, nodes = parse(t.decode("utf-8", "replace"))
                texts.append(text_of(blocks, nodes, _paths(blocks, nodes, most, mean)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
