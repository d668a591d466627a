"""Main text by consensus paths of hosts.

Pages of a host share a template. Each page scores its containers and votes for
the generalised tag-class path of the one that holds its text, with all that
lies inside: its outermost article or main, or the deepest container with nearly
all text and no article-like text beside it. Votes are summed per host in Spark.
Each page is then extracted again from that of its containers which most pages
of its host voted for. Only such containers come into question as lose none of
the page's article-like text: the page's own best one and those around it; or,
where its own best is no more than the body, one with a tenth of the page's
text that has half of all votes of the host. So a page of a rare template, or one whose usual container is
nearly empty, falls back on its own best one.

A path is a chain of nodes (node around, name) with a running hash, so that time
and memory are linear in the page, however deep its elements are nested.

What counts as text: preformatted ``xmp`` and formulas (``math`` without its
annotations) do. Of a ``header`` inside an article or main the headings do and
the rest does not; any other header doesn't. Marked words (MARKED) in class, id
or role drop a container; a paragraph, heading or inline element only if a whole
name is such a word: ``notice``, but not ``share-price``.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import pick, stored
from gridmix.llm.url_filter import host_of

# FIXED VALUES: element names of HTML by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object canvas annotation annotation-xml".split())
BLOCKS = frozenset((
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul xmp").split())
CONTAINERS = frozenset("article body div main section td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a marked word anywhere in a name marks; others need a name that is the word.
BOXES = BLOCKS - HEADINGS - {"p"}
#: Containers of a whole text, and such that are parts of the one around them.
WHOLE = frozenset(("article", "main"))
PARTS = frozenset(("section", "td"))
BOILERPLATE = frozenset("nav header footer aside form menu button select dialog head".split())
#: Of RAW, what ends only at its own end tag, or with the page.
CODE = frozenset("script style".split())
#: Words of a class, id or role that mark what is no article text.
MARKED = re.compile(
    r"(?<![^\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|login|masthead|menu|"
    r"modal|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promo\w*|related|replies|respond|search|share|"
    r"sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?![^\s_-])", re.I)
#: Words for texts beside the page's own, which may be longer and be articles themselves.
BESIDE = frozenset("ad ads comment comments disqus related replies respond".split())
#: A tag of these ends an open paragraph.
ENDS_P = BLOCKS - {"br", "body", "head", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: An element that a new one of the same kind closes, and where the search for it stops.
SIBLINGS = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
            "td": {"tr"}, "th": {"tr"}, "option": {"select"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?P<close>>|\Z)", re.S)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
XMP_END = re.compile(r"</xmp(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)
RAW_START = {name: re.compile(rf"<{name}(?=[\s/>])", re.I) for name in RAW - CODE}
#: Comments and code, to be passed over, and the tags of the other RAW elements.
RAW_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<code>script|style)(?=[\s/>]).*?(?:</(?P=code)(?=[\s/>]|\Z)|\Z)"
    rf"|<(?P<end>/?)(?P<name>{'|'.join(sorted(RAW - CODE))})(?=[\s/>]|\Z)"
    r"(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.I)
#: What differs between pages in a class, and what parts containers in a path.
VARIABLE = re.compile(r"[0-9>]+")

#: Share of a page's text from which a container has nearly all of it.
NEARLY = 0.9
#: A block of so many words, not a third of them in links, is like article text.
ARTICLE_WORDS = 8
#: Share of a page's text from which a container that half of its host's votes name is taken.
NAMED = 0.1


class Mark:
    """An element whose class, id or role has marked words, and the marked element around it."""

    __slots__ = ("tokens", "outer", "holds", "text", "skip", "beside")

    def __init__(self, tokens: dict[str, frozenset[str]], outer: Mark | None):
        self.tokens, self.outer, self.holds, self.text, self.skip = tokens, outer, False, 0, True
        #: It or one around it is named by the mere word, or for texts beside the page's own.
        self.beside = bool(outer and outer.beside or self.words() & BESIDE or self.words() & tokens.keys())

    def words(self) -> set[str]:
        return set().union(*self.tokens.values())


class Element:
    __slots__ = ("name", "node", "skip", "link", "mark", "whole", "dropped", "titled")

    def __init__(self, name: str, node: int, skip: bool, link: bool, mark: Mark | None, whole: bool, dropped: bool, titled: bool = False):
        self.name, self.node, self.skip, self.link = name, node, skip, link
        self.mark, self.whole, self.dropped, self.titled = mark, whole, dropped, titled


class Parsed:
    """The blocks of a page, and its container paths as nodes: node 0 is the page, a node's parent comes before it."""

    def __init__(self) -> None:
        self.parents, self.names, self.keys = [0], [""], [0]
        self.rows: list[tuple[int, bool, str, int]] = []
        self._places: dict[tuple[int, str], int] = {}

    def node(self, parent: int, name: str) -> int:
        """The node of a container name inside another node."""
        place = self._places.get((parent, name))
        if place is None:
            place = self._places[parent, name] = len(self.parents)
            self.parents.append(parent)
            self.names.append(name)
            self.keys.append(xxhash.xxh64_intdigest(name, seed=self.keys[parent] % (1 << 64)))
        return place

    def element(self, node: int) -> str:
        """Element name of a node."""
        return self.names[node].partition(".")[0]

    def key(self, node: int) -> int:
        """The path's hash, as a signed long."""
        return self.keys[node] - (1 << 64) if self.keys[node] >> 63 else self.keys[node]

    def way(self, node: int) -> list[int]:
        """The nodes from below the page to ``node``."""
        out = []
        while node:
            out.append(node)
            node = self.parents[node]
        return out[::-1]


def marked_tokens(found: dict[str, str], box: bool) -> dict[str, frozenset[str]]:
    """The marked words of each name in class, id and role that has any; unless ``box``, of names that are such a word."""
    tokens = {}
    for key in ("class", "id", "role"):
        if MARKED.search(found.get(key, "")):
            for token in found[key].lower().split():
                if (words := MARKED.findall(token)) and (box or token in words):
                    tokens[VARIABLE.sub("", token)] = frozenset(words)
    return tokens


def raw_ends(page: str) -> dict[int, int]:
    """Where a RAW element that has an end tag of its own ends, by the end of its start tag."""
    ends: dict[int, int] = {}
    started: dict[str, list[int]] = {}
    for m in RAW_TAG.finditer(page):
        name = (m["name"] or "").lower()
        if name and m["end"]:
            if started.get(name):
                ends[started[name].pop()] = m.end()
        elif name and not m["attributes"].rstrip().endswith("/"):
            started.setdefault(name, []).append(m.end())
    return ends


def settle(marks: list[Mark], found: list[tuple[int, bool, str, int, Mark | None, bool]]) -> None:
    """Decide which marked elements are skipped.

    A marked element is kept if it holds an article or main, or if its marked
    names hold most of the page's text outside links. Where an article or main
    has a tenth of that text outside, an element named by the mere word keeps
    its mark in spite of an article in it, and one of BESIDE in any case.
    """
    total = outside = 0
    for _, skip, text, linked, mark, whole in found:
        if not skip:
            worth = unlinked(text, linked)
            total += worth
            if mark:
                mark.text += worth
            if whole and not (mark and mark.beside):
                outside += worth
    for mark in reversed(marks):
        if mark.outer:
            mark.outer.text += mark.text
    # Marks are in page order, so those around one are what is left open. A name inside itself counts once.
    named: dict[str, int] = {}
    around: list[Mark] = []
    often: Counter[str] = Counter()
    for mark in marks:
        while around and around[-1] is not mark.outer:
            often.subtract(around.pop().tokens.keys())
        for token in mark.tokens:
            if not often[token]:
                named[token] = named.get(token, 0) + mark.text
        around.append(mark)
        often.update(mark.tokens.keys())
    other = outside and outside * 10 >= total
    for mark in marks:
        words = mark.words()
        beside = other and words & BESIDE
        usual = set().union(*(w for t, w in mark.tokens.items() if named[t] * 2 > total))
        kept = not beside and (words <= usual or mark.holds and not (other and words & mark.tokens.keys()))
        mark.skip = not kept or bool(mark.outer and mark.outer.skip)


def blocks(page: str) -> Parsed:
    """The blocks of text of a page, in page order: (container's node, skipped, text, characters in links).

    Broken markup is read on: an unknown end tag is passed over, an end tag
    closes what is open inside its element, and the page's end closes all. An
    unfinished tag at the end is no text. A RAW element that is closed in its
    tag is empty; one without an end tag, other than code, ends with its parent
    or before the next block. An empty page has no blocks.
    """
    parsed = Parsed()
    opened: Counter[str] = Counter()
    out: list[tuple[int, bool, str, int, Mark | None, bool]] = []
    marks: list[Mark] = []
    ends: dict[int, int] | None = None
    stack = [Element("", 0, False, False, None, False, False)]
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            if words := html.unescape("".join(text)).split():
                own = stack[-1]
                out.append((own.node, own.skip, " ".join(words), linked, own.mark, own.whole))
            text.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        if any(e.name in BLOCKS for e in stack[depth:]):
            flush()
        opened.subtract(e.name for e in stack[depth:])
        del stack[depth:]

    def push(element: Element) -> None:
        opened[element.name] += 1
        stack.append(element)

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece and not stack[-1].dropped:
            text.append(piece)
            if stack[-1].link:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if not m["close"] and at == end:
            break
        if m["end"]:
            if name == "br":
                flush()
            # A name that isn't open is not looked for.
            for depth in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[depth].name == name:
                    pop_to(depth)
                    break
                if name not in BLOCKS and stack[depth].name in BLOCKS and stack[depth].name != "p":
                    break  # an inline end tag doesn't close blocks
            continue
        if name in BLOCKS:
            while stack[-1].dropped:
                opened[stack.pop().name] -= 1
            if name in ENDS_P and opened["p"]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == "p":
                        pop_to(depth)
                        break
                    if stack[depth].name in BLOCKS:
                        break
            flush()
        if name in SIBLINGS and opened[name]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    pop_to(depth)
                    break
                if stack[depth].name in SIBLINGS[name]:
                    break
        if name in VOID:
            continue
        parent = stack[-1]
        if name in CODE:
            close = RAW_END[name].search(page, at)
            at = close.end() if close else end
            continue
        if name == "xmp":  # all up to its end tag is text as it stands
            close = XMP_END.search(page, at)
            text.append(page[at:close.start() if close else end].replace("&", "&amp;"))
            flush()
            at = close.end() if close else end
            continue
        if name in RAW:
            if m["attributes"].rstrip().endswith("/"):
                continue
            if ends is None:
                close = RAW_END[name].search(page, at)
                if close and not RAW_START[name].search(page, at, close.start()):
                    at = close.end()
                    continue
                ends = raw_ends(page)
            if at in ends:
                at = ends[at]
            else:
                push(Element(name, parent.node, parent.skip, parent.link, parent.mark, parent.whole, True))
            continue
        found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(m["attributes"])} if m["attributes"].strip() else {}
        titled = parent.titled and name not in BOILERPLATE or name == "header" and parent.whole and not parent.skip
        skip = "hidden" in found or (parent.skip or name in BOILERPLATE) and not (parent.titled and name in HEADINGS)
        mark = parent.mark
        if not skip and found and name not in ("body", "html", "article", "main") and (tokens := marked_tokens(found, name in BOXES)):
            mark = Mark(tokens, mark)
            marks.append(mark)
        node = parent.node
        if name in CONTAINERS:
            classes = ".".join(sorted({VARIABLE.sub("", c) for c in found.get("class", "").lower().split()} - {""}))
            node = parsed.node(node, name + (f".{classes}" if classes else ""))
        if m["attributes"].rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in WHOLE and not skip:
            around = mark
            while around and not around.holds:
                around.holds = True
                around = around.outer
        push(Element(name, node, skip, parent.link or name == "a", mark, parent.whole or name in WHOLE, parent.dropped, titled))
    flush()
    if marks:
        settle(marks, out)
    parsed.rows = [(node, skip or bool(mark and mark.skip), words, n) for node, skip, words, n, mark, _ in out]
    return parsed


def unlinked(text: str, linked: int) -> int:
    """Characters of a block outside links; none in a block that is mostly links."""
    return len(text) - linked if len(text) > 2 * linked else 0


def article_like(text: str, linked: int) -> bool:
    return text.count(" ") + 1 >= ARTICLE_WORDS and 3 * linked < len(text)


def held_text(page: Parsed) -> tuple[list[int], list[int], list[int]]:
    """For each node: characters outside links directly in it, the same with all that lies inside, and
    the article-like blocks it holds."""
    own, like = [0] * len(page.parents), [0] * len(page.parents)
    for node, skip, text, linked in page.rows:
        if not skip:
            own[node] += unlinked(text, linked)
            like[node] += article_like(text, linked)
    held = list(own)
    for node in range(len(held) - 1, 0, -1):
        held[page.parents[node]] += held[node]
        like[page.parents[node]] += like[node]
    return own, held, like


def outermost_wholes(page: Parsed, held: list[int]) -> list[int]:
    """The articles and mains with text that lie in no other one."""
    inside = [False] * len(held)
    out = []
    for node in range(1, len(held)):
        inside[node] = inside[page.parents[node]]
        if not inside[node] and page.element(node) in WHOLE:
            inside[node] = True
            if held[node]:
                out.append(node)
    return out


def best_path(page: Parsed) -> tuple[int, float] | None:
    """The node that holds the page's text, and its share of it.

    A container has all text outside links that lies in it, at any depth. The
    outermost article or main is taken if it has most of the page's text and no
    other one has much. Else the way leads from the page inwards while one
    container has nearly all text and all that is like article text, and ends
    where text stands beside it.
    """
    own, held, like = held_text(page)
    total = held[0]
    if not total:
        return None
    outermost = outermost_wholes(page, held)
    if outermost:
        best = min(outermost, key=lambda n: (-held[n], n))
        if held[best] * 2 >= total and held[best] >= NEARLY * sum(held[n] for n in outermost):
            return best, held[best] / total
    # Nine tenths of the text are in one container of a node at most; the first one met is it.
    nearly = {page.parents[n]: n for n in range(len(held) - 1, 0, -1) if held[n] >= NEARLY * total and like[n] == like[0]}
    node = 0
    while not own[node] and page.element(node) not in WHOLE and node in nearly:
        name, inner = page.element(node), page.element(nearly[node])
        if inner in PARTS and not (name in ("", "body") or name == inner == "td"):
            break
        node = nearly[node]
    return (node, held[node] / total) if node else None


def candidates(page: Parsed) -> list[tuple[int, bool]]:
    """(node, named) of the containers that votes may choose: the page's own best one and those around it,
    from the outermost; and, where the own best is no more than the body, the others with a tenth
    of the text and a block like article text, which only half of the host's votes can choose."""
    _, held, like = held_text(page)
    best = best_path(page)
    way = page.way(best[0]) if best else []
    chain = set(way)
    out = [(n, False) for n in way]
    if held[0] and page.element(way[-1] if way else 0) in ("", "body"):
        out += [(n, True) for n in range(1, len(held)) if n not in chain and held[n] >= NAMED * held[0] and like[n]]
    return out


def spans(page: Parsed) -> tuple[list[int], list[int]]:
    """For each node its place, nodes inside others placed after them and together, and the last place inside it."""
    size = [1] * len(page.parents)
    for n in range(len(size) - 1, 0, -1):
        size[page.parents[n]] += size[n]
    place, following = [0] * len(size), [1] * len(size)
    for n in range(1, len(size)):
        place[n] = following[page.parents[n]]
        following[page.parents[n]] += size[n]
        following[n] = place[n] + 1
    return place, [p + k - 1 for p, k in zip(place, size)]


def extract(page: Parsed, nodes: list[int]) -> str:
    """The blocks in the first of ``nodes``; all that aren't skipped without one."""
    inside = [not nodes or n == nodes[0] for n in range(len(page.parents))]
    for n in range(1, len(inside)):
        inside[n] = inside[n] or inside[page.parents[n]]
    return "\n".join(text for n, skip, text, _ in page.rows if not skip and inside[n])


_CANDIDATES = "array<struct<key:long,first:int,last:int,named:boolean>>"
SCORED = f"page_id long, url string, host string, candidates {_CANDIDATES}, best long, weight double, blocks array<struct<place:int,text:string>>"
_CANDIDATE = pa.struct([("key", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("named", pa.bool_())])
_BLOCK = pa.struct([("place", pa.int32()), ("text", pa.string())])


def scored(pages: DataFrame) -> DataFrame:
    """Each row (page_id, url, host, html) with its candidates, its vote and its blocks.

    A candidate has its path's hash and holds the blocks whose ``place`` is from
    ``first`` to ``last``. The vote is the hash of the page's own best path with
    its share of the text; a page without text has none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):  # one page at a time: a page may be long
                page = blocks(batch.column(3)[row].as_py())
                best, (place, last) = best_path(page), spans(page)
                named = [{"key": page.key(n), "first": place[n], "last": last[n], "named": k} for n, k in candidates(page)]
                found = [{"place": place[n], "text": t} for n, skip, t, _ in page.rows if not skip]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(row, 1) for i in range(3)], pa.array([named], pa.list_(_CANDIDATE)),
                     pa.array([page.key(best[0]) if best else None], pa.int64()), pa.array([best[1] if best else None], pa.float64()),
                     pa.array([found], pa.list_(_BLOCK))],
                    ["page_id", "url", "host", "candidates", "best", "weight", "blocks"])

    return pages.select("page_id", "url", "host", "html").mapInArrow(run, SCORED)


def chosen(pages: DataFrame) -> DataFrame:
    """(host, candidates, won) of every kind of page: its candidate with the most votes of the host (ties: the outer one).

    Pages of a host with the same candidates are one kind, so this grows with
    the templates and not with the pages.
    """
    voting = pages.where(F.col("best").isNotNull())
    # Votes in thousandths: whole numbers add up alike in any order.
    summed = voting.groupBy("host", F.col("best").alias("key")).agg(F.sum(F.round(F.col("weight") * 1000).cast("long")).alias("n"))
    totals = summed.groupBy("host").agg(F.sum("n").alias("of"))
    each = pages.select("host", "candidates").distinct().withColumn("c", F.explode("candidates"))
    voted = each.withColumn("key", F.col("c.key")).join(summed, ["host", "key"]).join(totals, "host")
    voted = voted.where(~F.col("c.named") | (2 * F.col("n") >= F.col("of")))
    order = F.struct("n", (F.col("c.last") - F.col("c.first")).alias("wide"), (-F.col("c.first")).alias("outer"))
    return voted.groupBy("host", "candidates").agg(F.max_by("c", order).alias("won"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null or empty page and one without text give an empty text. Pages with a
    null url or one without a host vote together. Equal rows give equal rows,
    extra columns are left out, an empty table gives no rows. Pages are read
    whole, however long or deep.
    """
    source = pick(pages, id_col, url_col, html_col).select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")).withColumn("host", host_of(F.col("url")))
    # Each page is parsed once; what is written is smaller than the pages.
    parsed = stored(scored(source), "page-blocks")
    # Kinds are written, so that the planner knows their size: while they are few, no page is shuffled to its kind.
    # If they are many, adaptive execution splits the join for a host with very many pages.
    told = parsed.join(stored(chosen(parsed), "page-kinds"), ["host", "candidates"], "left")
    inside = F.filter("blocks", lambda b: F.coalesce(b["place"].between(F.col("won.first"), F.col("won.last")), F.lit(True)))
    text = F.array_join(F.transform(inside, lambda b: b["text"]), "\n")
    return told.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
