"""Main text of web pages by paths that the pages of a host agree on.

Each page's containers are scored by the text that they hold without links and boilerplate. The pages of
a host vote for the generalised tag and class paths of their best containers, and every page is then
extracted with the winning path of its host, or with its own best container if it lacks that path. From
there it climbs as long as what an ancestor adds (headline, lead, short sections beside the body) is no
boilerplate: neither mostly links nor, as the pages of the host show, the same on all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.common import cut, join_counted, regroup, strings

#: Containers for which a page votes.
BALLOTS = 3
#: What a container keeps of the score of text one level further down.
DECAY = 0.85
#: Factor for containers whose tag or role says that they hold the article.
SEMANTIC = 1.5
CHUNK_BYTES = 8 << 20
#: More levels than any page has.
EVERY = 1 << 30

#: Fixed values of the format: elements without content, with raw text, that end an open paragraph, and inline ones.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: A new one ends an open one of the same set, unless one of the scopes is open above it.
SIBLINGS = {t: g for g in (frozenset({"li"}), frozenset({"dt", "dd"}), frozenset({"tr"}), frozenset({"td", "th"}), frozenset({"option"}), frozenset({"thead", "tbody", "tfoot"})) for t in g}
SCOPES = frozenset("ul ol dl table select article section div body html main td th".split())
#: Elements that are never part of the article.
DROPPED = frozenset("script style noscript template iframe svg canvas object embed nav aside footer form button select textarea input fieldset dialog menu head title".split())
#: Words in class, id or role that mark boilerplate: as the whole mark or its last part, or as its first part before one of BESIDE_NOISE.
NOISE = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside rail footer colophon "
    "header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login register comment comments commentlist disqus respond replies reply discussion "
    "share sharing social related recommended recommendations pagination pager widget widgets toolbar search form contentinfo complementary skip".split()
)
#: Parts of a mark that leave the meaning of a word of NOISE before them as it is, and those that turn a mark into a statement about the page.
BESIDE_NOISE = frozenset(
    "area bar block body bottom box button buttons card column container content footer form group head header icons inline inner item items left link links list main outer panel popup posts row "
    "right section slot stories strip text title top unit widget widgets wrap wrapper zone articles".split()
)
STATEMENTS = frozenset("with without has have no not is enabled disabled hide hides show shows".split())
#: Words of NOISE for readers' own texts, which may be longer than the article.
READERS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
#: A container marked as boilerplate is kept if it holds a headline or article and more than this share of the page's text.
MOST = 0.5
KEPT = frozenset(("html", "body", "main", "article"))
SEMANTIC_MARKS = frozenset(("main", "articlebody"))

OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HEADING = frozenset(("h1", "h2", "h3"))


class Node:
    __slots__ = ("tag", "step", "parent", "parts", "noise", "semantic", "inline")

    def __init__(self, tag: str, step: str, parent: Node | None, noise: str, semantic: bool, inline: bool = False):
        # noise: why it is boilerplate, the word of NOISE or "#" for its tag; empty if it is none
        self.tag, self.step, self.parent, self.noise, self.semantic, self.inline = tag, step, parent, noise, semantic, inline
        self.parts: list = []  # strings, child nodes, and True and False around link text

    def path(self) -> str:
        steps, node = [], self
        while node.parent is not None:
            steps.append(node.step)
            node = node.parent
        return ">".join(reversed(steps))


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def generalised(tag: str, classes: str) -> str:
    """A step of a path: the tag with its classes in order, numbers left out."""
    own = sorted({re.sub(r"[0-9]+|[0-9a-f]{8,}", "#", c) for c in classes.lower().replace(">", " ").split()})
    return ".".join([tag, *own])


def marks_noise(mark: str) -> str:
    """The word of NOISE by which a class, id or role marks boilerplate, or nothing."""
    parts = re.findall(r"[a-z]+", mark)
    if not parts or not STATEMENTS.isdisjoint(parts):
        return ""
    if parts[-1] in NOISE:
        return parts[-1]
    return parts[0] if parts[0] in NOISE and BESIDE_NOISE.issuperset(parts[1:]) else ""


def open_node(tag: str, raw: str, parent: Node, inline: bool = False) -> Node:
    found = attributes(raw) if raw.strip(" /\n\t") else {}
    classes = found.get("class", "")
    semantic = tag in ("article", "main") or bool({found.get("role", "").lower(), found.get("itemprop", "").lower()} & SEMANTIC_MARKS)
    noisy = "#" if tag in DROPPED or tag == "header" or "hidden" in found else ""
    if not noisy and found and (not semantic or tag == "article") and tag not in ("html", "body", "main"):
        noisy = next(filter(None, map(marks_noise, f"{classes} {found.get('id', '')} {found.get('role', '')}".lower().split())), "")
    return Node(tag, generalised(tag, classes), parent, noisy, semantic, inline)


class Tags:
    """Reads the tags of a page from left to right; what it has seen once it does not look at again."""

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.resumed = 0  # a reader may skip raw text by raising this
        self.dead: set[int] = set()  # quotes from which no tag ends

    def __iter__(self) -> Iterator[tuple[int, int, str, str, str]]:
        """First and last character (exclusive), "/" or nothing, name and attributes of each tag; the name is empty for comments and the like."""
        html, at = self.html, 0
        while True:
            at = html.find("<", at)
            if at < 0:
                return
            if html.startswith("<!--", at):
                end = html.find("-->", at + 2)
                end = len(html) if end < 0 else end + 3
                yield at, end, "", "", ""
                at = end
                continue
            if at > self.last:
                return
            m = OPEN.match(html, at)
            if m:
                end = self.end(m.end())
                yield at, end, m[1], m[2].lower(), html[m.end() : end - 1]
            elif html[at + 1 : at + 2] in ("!", "?"):
                end = html.find(">", at) + 1
                yield at, end, "", "", ""
            else:
                end = at + 1
            at = self.resumed = max(end, self.resumed)

    def end(self, at: int) -> int:
        """Where a tag ends whose attributes begin here: after the first > outside quotes, or else after the first >."""
        html, begin, seen = self.html, at, []
        while True:
            m = STOP.search(html, at)
            if m is None or m.start() in self.dead:
                break
            if m[0] == ">":
                return m.end()
            seen.append(m.start())
            at = html.find(m[0], m.end()) + 1
            if not at:
                break
        self.dead.update(seen)
        return html.find(">", begin) + 1


def parse(html: str) -> Node:
    """The tree of block elements of a page; inline elements leave their text only, broken nesting is closed as browsers do.

    The work is in proportion to the length of the page, however it is broken.
    """
    root = Node("#", "", None, "", False)
    stack = [root]
    places: dict[str, list[int]] = {}  # where in the stack each name is open

    def last(*names: str) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def shut(k: int) -> None:
        for node in stack[k:]:
            places[node.tag].pop()
        del stack[k:]

    def put(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    at = 0
    tags = Tags(html)
    for begin, end, closing, tag, raw in tags:
        if begin < at:  # within raw text
            continue
        if begin > at:
            stack[-1].parts.append(html[at:begin])
        at = end
        if not tag:
            continue
        if tag == "a":
            stack[-1].parts.append(not closing)
        elif tag == "br" or tag == "wbr":
            if tag == "br":
                stack[-1].parts.append(" ")
        elif tag in INLINE:
            muted = stack[-1] if stack[-1].inline else None
            if muted is not None and muted.tag == tag:  # an inline element that is left out ends with its own end tag
                put(Node(tag, tag, muted, "#", False, True)) if not closing else shut(len(stack) - 1)
            elif not closing and raw and ("class" in raw or "hidden" in raw or "id" in raw or "role" in raw):
                node = open_node(tag, raw, stack[-1], True)
                if node.noise:
                    stack[-1].parts.append(node)
                    put(node)
        elif closing:
            k = last(tag)
            if k > 0 and not (tag in ("p", "li", "td") and k < last("article", "main", "body")):
                shut(k)
        else:
            if tag in CLOSES_P and last("p") > last(*SCOPES):
                shut(last("p"))
            group = SIBLINGS.get(tag)
            if group and last(*group) > last(*(SCOPES - group)):
                shut(last(*group))
            if tag == "body" and places.get("body") or tag == "html" and len(stack) > 1:
                continue
            if tag in ("body", "article", "main", "div", "nav") and stack[-1].tag == "head":
                shut(len(stack) - 1)
            node = open_node(tag, raw, stack[-1])
            stack[-1].parts.append(node)
            if tag in RAW:
                m = raw_end(tag).search(html, at)
                at = m.end() if m else len(html)
                tags.resumed = at
            elif tag not in VOID and not raw.endswith("/") or tag == "p":
                put(node)
    if at < len(html):
        stack[-1].parts.append(html[at:])
    spare(root)
    return root


RAW_ENDS: dict[str, re.Pattern] = {}


def raw_end(tag: str) -> re.Pattern:
    if tag not in RAW_ENDS:
        RAW_ENDS[tag] = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I)
    return RAW_ENDS[tag]


def spare(root: Node) -> None:
    """Takes the mark of boilerplate off containers that hold a headline or article and most of the page's text."""
    sizes: dict[int, tuple[int, bool]] = {}
    marked: list[Node] = []
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, done = todo.pop()
        if not done:
            todo.append((node, True))
            todo += [(x, False) for x in node.parts if isinstance(x, Node) and x.tag not in DROPPED]
            continue
        below = [sizes[id(x)] for x in node.parts if isinstance(x, Node) and x.tag not in DROPPED]
        size = sum(len(x) for x in node.parts if isinstance(x, str)) + sum(n for n, _ in below)
        sizes[id(node)] = size, node.tag in ("h1", "article", "main") or any(h for _, h in below)
        if node.noise in NOISE and node.noise not in READERS and not node.inline:
            marked.append(node)
    total = sizes[id(root)][0]
    for node in marked:
        size, headed = sizes[id(node)]
        if headed and size > MOST * total:
            node.noise = ""


def blocks(top: Node, inside: bool = False) -> list[tuple[Node, str, int]]:
    """The text blocks below a node in page order, each with its element and its characters within links; boilerplate is left out.

    Of a header inside the article only the headings stay.
    """
    out: list[tuple[Node, str, int]] = []
    todo: list = [(top, iter(top.parts), [], [0], False, False)]

    def close(node: Node, text: list[str], linked: list[int]) -> None:
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                out.append((node, joined, min(linked[0], len(joined))))
            text.clear()
            linked[0] = 0

    while todo:
        node, parts, text, linked, link, only_headings = todo.pop()
        for part in parts:
            if part is True or part is False:
                link = part
            elif isinstance(part, str):
                if not only_headings or node.tag in HEADING:
                    text.append(part)
                    if link:
                        linked[0] += len(part)
            elif not part.inline:
                close(node, text, linked)
                heads = only_headings
                if part.noise:
                    if not (part.tag == "header" and inside):
                        continue
                    heads = True
                todo.append((node, parts, text, linked, link, only_headings))
                todo.append((part, iter(part.parts), [], [0], link, heads))
                break
        else:
            close(node, text, linked)
    return out


def containers(root: Node) -> list[tuple[float, Node]]:
    """Containers by falling score; equal scores in page order."""
    scores: dict[int, float] = {}
    nodes: dict[int, Node] = {}
    for node, text, linked in blocks(root):
        worth = (len(text) - linked) * (0.3 if linked * 2 > len(text) else 1.0)
        up = node if node.tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "dd", "dt", "td") else node.parent
        share = 1.0
        while up is not None and up.tag != "#":
            nodes.setdefault(id(up), up)
            scores[id(up)] = scores.get(id(up), 0.0) + worth * share
            share *= DECAY
            up = up.parent if share > 1e-6 else None
    ranked = [(s * (SEMANTIC if nodes[k].semantic else 1.0), nodes[k]) for k, s in scores.items() if nodes[k].tag not in ("html",)]
    ranked.sort(key=lambda x: -x[0])
    return ranked


def matching(root: Node, path: str) -> list[Node]:
    """The nodes with a path, in page order, outside boilerplate."""
    level = [root]
    for step in path.split(">"):
        level = [part for node in level for part in node.parts if isinstance(part, Node) and not part.noise and part.step == step]
    return level


def beside(node: Node, group: frozenset[int] | None = None) -> list[tuple[str, str, bool]]:
    """What the parent of a container, or of a group of them, adds to it: step, text and whether it is mostly links, of each part with text."""
    out: list[tuple[str, str, bool]] = []
    loose, linked, link = [], 0, False
    for part in node.parent.parts:
        if part is True or part is False:
            link = part
        elif isinstance(part, str):
            loose.append(part)
            linked += len(part) if link else 0
        elif part is not node and not (group and id(part) in group) and (not part.noise or part.tag == "header"):
            found = [b for b in blocks(part, True) if not part.noise or b[0].tag in HEADING]
            if found:
                rest = [(len(t), n) for b, t, n in found if b.tag not in HEADING]
                out.append((part.step, "\n".join(t for _, t, _ in found), sum(n for _, n in rest) * 2 > sum(n for n, _ in rest)))
    text = " ".join(unescape("".join(loose)).split())
    if text:
        out.append(("#", text, linked * 2 > len(text)))
    return out


def climbed(nodes: list[Node], most: int | None) -> list[Node]:
    """For containers with one parent the widest ancestor, at most so many levels up, that adds no boilerplate, or else themselves.

    Headers count only if the host's pages tell.
    """
    up, level, best, group = nodes[0], 0, nodes, frozenset(map(id, nodes))
    while up.tag != "body" and up.parent.tag not in ("#", "html") and (most is None or level < most):
        added = beside(up, group if level == 0 else None)
        if any(heavy or most is None and step.split(".")[0] == "header" for step, _, heavy in added):
            break
        up, level = up.parent, level + 1
        if added:
            best = [up]
    return best


def extract(html: str, path: str | None, climb: int | None = None) -> str:
    """The main text of one page with the path of its host and the levels that its pages may climb.

    A page without that path is extracted with the path of its own best container.
    """
    root = parse(html)
    nodes = [n for n in (matching(root, path) if path else []) if blocks(n, True)]
    if not nodes:
        climb = None
        for _, best in containers(root)[:1]:
            twins = [n for n in (best.parent.parts if best.tag == "article" else ()) if isinstance(n, Node) and n.tag == "article" and not n.noise and blocks(n, True)]
            nodes = twins or [n for n in matching(root, best.path()) if blocks(n, True)] or [best]
    families: dict[int, list[Node]] = {}
    for n in nodes:
        families.setdefault(id(n.parent), []).append(n)
    tops = {id(n): n for own in families.values() for n in climbed(own, climb)}
    outer = [n for n in tops.values() if not inside(n, tops)]
    return "\n".join(t for n in outer or [root] for _, t, _ in blocks(n, bool(outer)))


def inside(node: Node, tops: dict[int, Node]) -> bool:
    """Whether a node stands below another one of them."""
    up = node.parent
    while up is not None and id(up) not in tops:
        up = up.parent
    return up is not None


def host() -> Column:
    """The host of column url in lower case, without user and port; empty if there is none."""
    authority = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))


VOTES = "host string, path string, level int, step string, vote double, own long, hash long"


def _number(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def votes(pages: DataFrame) -> DataFrame:
    """host, path, vote: up to BALLOTS containers of each page with their scores as shares of the best one's.

    Level is 0; rows of higher levels have the parts (step) that the ancestor so many levels up adds to the
    container, with hashes of the container's text and of the part's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in VOTES.split(", ")]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.int64(), pa.int64())
        for t in regroup(batches, "html", CHUNK_BYTES):
            rows = []
            for host_name, html in zip(t.column("host").to_pylist(), strings(t.column("html")), strict=True):
                best = containers(parse(html))[:BALLOTS]
                seen = set()
                for s, node in best:
                    path = node.path()
                    if s > 0 and path not in seen:
                        seen.add(path)
                        rows.append((host_name, path, 0, "", s / best[0][0], 0, 0))
                        up, level, own = node, 0, None
                        while up.tag != "body" and up.parent.tag not in ("#", "html"):
                            added, level = beside(up), level + 1
                            if any(heavy for _, _, heavy in added):
                                break
                            if added and own is None:
                                own = _number("\n".join(x for _, x, _ in blocks(node, True)))
                            rows.extend((host_name, path, level, step, 0.0, own, _number(x)) for step, x, _ in added)
                            up = up.parent
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return pages.select(host().alias("host"), "html").mapInArrow(run, VOTES)


def consensus(pages: DataFrame) -> DataFrame:
    """host, path, the number of votes of its pages and the levels that they may climb (all: EVERY); equal votes go to the first path in order of text.

    A level is boilerplate if a part of it is the same on pages whose containers differ, or a header that is not seen to differ.
    """
    same = F.min("hash") == F.max("hash")
    boiler = same & ((F.min("own") != F.max("own")) | F.col("step").rlike(r"^header(\.|$)"))
    parts = votes(pages).groupBy("host", "path", "level", "step").agg(F.sum(F.round("vote", 6)).alias("votes"), F.count_if(F.col("level") == 0).alias("pages"), boiler.alias("boiler"))
    tally = parts.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("pages").alias("pages"), F.coalesce(F.min(F.when(F.col("boiler") & (F.col("level") > 0), F.col("level") - 1)), F.lit(EVERY)).alias("climb"))
    won = tally.groupBy("host").agg(F.min_by(F.struct("path", "climb"), F.struct(-F.round("votes", 3), F.col("path"))).alias("won"), F.sum("pages").alias("ballots"))
    return won.select("host", "won.path", "ballots", "won.climb")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null html is empty and gives an empty text. Pages without a host (null or odd urls) vote together.
    Null ids stay null, repeated rows give repeated rows, an empty table gives none; only columns
    page_id, url and html are read. Blocks are joined by one line end, white space within one is one space.
    """
    total = pages.count()
    paths = cut(consensus(pages))
    rows = pages.select("page_id", "url", "html", host().alias("host"))
    joined = join_counted(rows, paths, "host", "ballots", total * BALLOTS, spread=F.xxhash64("page_id", "url").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regroup(batches, "html", CHUNK_BYTES):
            texts = [extract(h, p, c) for h, p, c in zip(strings(t.column("html")), t.column("path").to_pylist(), t.column("climb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([t.column("page_id").combine_chunks().cast(pa.int64()), t.column("url").combine_chunks(), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "path", "climb").mapInArrow(run, "page_id long, url string, text string, n_chars long")
