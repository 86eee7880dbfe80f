"""Main text of web pages by wrapper induction: trees of a host's pages are aligned by simple tree matching.

Each page is parsed to a tree of blocks; same-named siblings count as one node. Every task merges the trees of a
host's pages into one template: nodes that simple tree matching aligns become one, with the number of pages that have
it, the text it holds if that never varies, and the amount of text. The templates of the tasks are merged in the
same way, first in parts and then per host, so all pages are used and no group of pages is gathered. In a
host's template, nodes whose text is the same on all pages that have them are its frame, if those are ``SUPPORT`` or
more different pages and a ``SHARE`` of the host's, or all of two or more pages; copies of a page, with the same text, count once. Of the varying ones,
that with most of the text becomes the content. A page is then aligned with its host's wrapper, and its text is taken
in page order, without frame nodes, without what never varies beside the content node and the nodes around it, and
without blocks that are named as menus, adverts and the like. What varies beside the content node stays, but where article
or main elements hold ``DOMINANT`` of that text, only headings stay beside them. A name is a class, id or role, split at ``-``,
``_`` and capitals: its first or last word rules, unless the first one denies or allows it (no-comments, has-sidebar), and
never an article or main element; a form is treated as a named block. A named block that holds most of its page's text
besides frame stays, unless an article or main element outside of named blocks has text. Ids and classes with digits
inside, as programs make them up, do not tell nodes apart.

Defined results: a NULL or empty html, and one without text, give an empty text; a NULL or unreadable URL counts
as a host of its own; a page that has no node where its host's wrapper puts the content is taken as its own template;
repeated rows are extracted each; an empty table gives no rows; pages without an id and URL share a piece; long pages are read whole; other columns are left
behind.
"""

from __future__ import annotations

import html
import json
import math
import re
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.base import staged

#: Different pages on which a text must be the same to belong to the frame, and their share of the host's.
SUPPORT = 5
SHARE = 0.2
#: Digests of different pages that a node keeps, the least: all of so many, or else an even sample that shows the share.
SAMPLE = 64
#: Share of the varying text that a node must hold for what never varies beside it to be left out.
DOMINANT = 0.6
#: Elements nested more deeply are not told apart from what surrounds them; their text is kept.
DEPTH = 150
#: Bytes of html under one key of a large host, and about what a task reads; a host is large from this share of all bytes on.
PIECE_BYTES = 512 << 10
TASK_BYTES = 16 << 20
LARGE = 4096
#: Tasks that read the pages, the most; beyond, each reads more.
MOST_TASKS = 100_000
#: Hosts whose templates a task holds at a time.
HOSTS_HELD = 1000

# Names of elements and words in their class, id and role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noframes".split())
NEVER = frozenset(
    "head script style noscript iframe template textarea title nav header footer aside button select option input "
    "svg canvas object embed audio video dialog menu noframes".split()
)
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs header masthead footer contentinfo sidebar aside complementary cookie cookies consent "
    "gdpr notice alert popup modal overlay subscribe newsletter signup login search share sharing social comment comments "
    "disqus replies reply respond related recommended pagination pager widget toolbar skip".split()
)
#: First words that deny or allow what the others name; and words that name part of the content in a content block's name.
DENIED = frozenset("no not without has have with show hide is can".split())
OWN_PART = frozenset("header masthead banner notice alert search promo".split())
CONTENT = frozenset("article post entry content story text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WHOLE = frozenset("article main".split())
#: Begins the key of a named block, and no tag.
NAMED = "!"
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dt dd figcaption caption".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
HOLDS = frozenset("ul ol dl table article section div main body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>)"
    r"|</?[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_DIGITS = re.compile(r"[\d_-]+")
_MADE_UP = re.compile(r"\S*\d[a-zA-Z]\S*")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@cache
def rules_out(name: str) -> bool:
    """Whether a class, id or role names a block that is no content."""
    parts = [p.lower() for p in _PART.findall(name)]
    if not parts or parts[0] in DENIED:
        return False
    own = bool(CONTENT.intersection(parts))
    return any(p in WORDS and not (own and p in OWN_PART) for p in (parts[0], parts[-1]))


class Node:
    """An element that is a block, or an inline one that may be left out. Children are nodes and texts.

    ``skipped`` ones always are; ``named`` ones are by their class, id or role, which their key shows.
    """

    __slots__ = ("tag", "key", "children", "skipped", "named")

    def __init__(self, tag: str, attributes: str = ""):
        names = [] if not attributes else [(a.lower(), v.strip("\"'")) for a, v in _ATTRIBUTE.findall(attributes)]
        self.tag = tag
        self.key = ".".join([tag, *sorted(_DIGITS.sub("", _MADE_UP.sub("", v)).lower().strip() for a, v in names if a != "role")])
        self.skipped = tag in NEVER
        self.named = tag == "form" or tag not in WHOLE and any(rules_out(w) for _, v in names for w in v.split())
        if self.named:
            self.key = NAMED + self.key
        self.children: list[Node | str] = []


def parse(page: str) -> Node:
    """A tree of blocks of a page, whatever its tags; comments and declarations are left out."""
    root = Node("html")
    stack = [root]
    at = 0
    while found := _TOKEN.search(page, at):
        if found.start() > at:
            stack[-1].children.append(page[at : found.start()])
        at = found.end()
        closing, opening = found[1], found[2]
        if opening:
            tag, attributes = opening.lower(), found[3]
            if tag in ("html", "body"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if tag in INLINE:
                if tag == "br":
                    stack[-1].children.append(" ")
                elif attributes != ">" and tag not in VOID and (node := Node(tag, attributes)).named:
                    stack[-1].children.append(node)
                    if len(stack) < DEPTH or not stack[-1].named:
                        stack.append(node)
                continue
            for i in range(len(stack) - 1, 0, -1):  # a block ends a paragraph, and some end their like
                if stack[i].tag == "p" or stack[i].tag in CLOSES.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i].tag in HOLDS:
                    break
            node = Node(tag, attributes)
            stack[-1].children.append(node)
            if tag not in VOID and not attributes.endswith("/>") and (
                len(stack) < DEPTH or node.skipped or node.named and not stack[-1].named
            ):
                stack.append(node)
        elif closing:
            tag = closing.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


def clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


class Group:
    """Same-named siblings of a page as one node."""

    __slots__ = ("key", "nodes", "kids")

    def __init__(self, key: str, nodes: list[Node]):
        self.key, self.nodes = key, nodes
        same: dict[str, list[Node]] = {}
        for node in nodes:
            for child in node.children:
                if isinstance(child, Node) and not child.skipped:
                    same.setdefault(child.key, []).append(child)
        self.kids = [Group(k, n) for k, n in same.items()]

    def template(self, seen: list[int] | None = None) -> dict:
        """A template of one page: key, pages, seen (digests of different pages), check (of the own text, None if it
        varies), size and kids."""
        own = clean(" ".join(c for n in self.nodes for c in n.children if isinstance(c, str)))
        shared = [] if seen is None else seen
        out = {"key": self.key, "pages": 1, "seen": shared, "check": crc32(own.encode()) if own else 0, "size": len(own),
               "kids": [k.template(shared) for k in self.kids]}
        if seen is None:
            shared.append(xxhash.xxh32_intdigest(repr(list(_checks(out)))))
        return out


def _checks(t: dict) -> Iterator[int]:
    """What tells the text of a page from others."""
    if t["check"]:
        yield t["check"]
    for k in t["kids"]:
        yield from _checks(k)


def _kids(x) -> list:
    return x["kids"] if isinstance(x, dict) else x.kids


def _key(x) -> str:
    return x["key"] if isinstance(x, dict) else x.key


def matching(a, b) -> int:
    """Simple tree matching: the most nodes of two trees that can be paired, with order and descent kept."""
    return 1 + _table(_kids(a), _kids(b))[-1][-1] if _key(a) == _key(b) else 0


def _table(left: list, right: list) -> list[list[int]]:
    table = [[0] * (len(right) + 1)]
    for a in left:
        above, row = table[-1], [0]
        for j, b in enumerate(right):
            row.append(max(row[j], above[j + 1], above[j] + matching(a, b) if _key(a) == _key(b) else 0))
        table.append(row)
    return table


def aligned(left: list, right: list) -> list[tuple]:
    """Pairs of a best matching of two child lists, in order, with None beside what has no partner."""
    if [_key(x) for x in left] == [_key(x) for x in right] and len({_key(x) for x in left}) == len(left):
        return list(zip(left, right))
    table, out = _table(left, right), []
    i, j = len(left), len(right)
    while i or j:
        if i and j and _key(left[i - 1]) == _key(right[j - 1]) and table[i][j] == table[i - 1][j - 1] + matching(left[i - 1], right[j - 1]):
            i, j = i - 1, j - 1
            out.append((left[i], right[j]))
        elif i and table[i][j] == table[i - 1][j]:
            i -= 1
            out.append((left[i], None))
        else:
            j -= 1
            out.append((None, right[j]))
    return out[::-1]


def _sampled(a: list[int], b: list[int]) -> list[int]:
    if a == b or len(a) == SAMPLE and b[0] > a[-1]:
        return a
    return sorted({*a, *b})[:SAMPLE]


def merge(a: dict, b: dict) -> dict:
    """The template of all pages of two templates whose roots match."""
    return {
        "key": a["key"], "pages": a["pages"] + b["pages"], "seen": _sampled(a["seen"], b["seen"]), "check": a["check"] if a["check"] == b["check"] else None,
        "size": a["size"] + b["size"],
        "kids": [merge(x, y) if x and y else x or y for x, y in aligned(a["kids"], b["kids"])],
    }


def unvarying(t: dict) -> set[int]:
    """The nodes of a host's template whose own text is the same on enough different pages."""
    whole, out = set(t["seen"]), set()

    def look(x: dict) -> None:
        enough = min(SUPPORT, max(len(whole), 2))
        if x["check"] is not None and len(x["seen"]) >= enough and len(whole.intersection(x["seen"])) >= SHARE * len(whole):
            out.add(id(x))
        for k in x["kids"]:
            look(k)

    look(t)
    return out


def varying(t: dict, same: set[int], named: bool = True) -> int:
    """Amount of text below a node, without the own text of the nodes in ``same``, and with named blocks or without."""
    if not named and t["key"].startswith(NAMED):
        return 0
    return (0 if id(t) in same else t["size"]) + sum(varying(k, same, named) for k in t["kids"])


def induce(t: dict) -> dict:
    """The wrapper of a template: its tree, with the content node, frame nodes and nodes with frame text marked.

    From the root, the child with most of the varying text is entered as long as it holds ``DOMINANT`` of it and isn't
    a paragraph or the like; an article or main element that holds that much ends the descent. Named blocks do not
    count, unless nothing else varies.
    """
    same = unvarying(t)
    named = not varying(t, same, False)
    path, node = [], t
    while node["kids"] and node["key"].split(".")[0] not in WHOLE:
        all_text = varying(node, same, named)
        best = max(range(len(node["kids"])), key=lambda i: varying(node["kids"][i], same, named))
        child = node["kids"][best]
        if child["key"].split(".")[0] in TEXTUAL or varying(child, same, named) < DOMINANT * all_text or not all_text:
            break
        path.append(best)
        node = child

    def shape(x: dict, path: list[int] | None, beside: bool = False) -> dict:
        # Plain headings and paragraphs may agree by chance, as in copies; a named or other block doesn't.
        own = bool(x["check"] and id(x) in same and x["key"] not in TEXTUAL)
        still = (own or beside) and not varying(x, same)
        kids = [shape(k, path[1:] if path and i == path[0] else None, bool(path) and i != path[0]) for i, k in enumerate(x["kids"])]
        return {"key": x["key"], "frame": still, "mute": own and not still, "content": path == [], "kids": kids}

    return {"tree": shape(t, path), "varies": bool(varying(t, same))}


def _left_out(root: Node, frame: set[int], mute: set[int]) -> set[int]:
    """Frame nodes, and the named blocks of a page that go. ``mute`` are nodes whose own text is frame."""
    sizes: list[tuple[Node, int, bool]] = []
    outside = False

    def weigh(node: Node, inside: bool) -> tuple[int, bool]:
        """Amount of text, and whether an article or main element has some of it."""
        nonlocal outside
        size, whole = 0, False
        for child in node.children:
            if isinstance(child, str):
                size += 0 if id(node) in mute else len(clean(child))
            elif not child.skipped and id(child) not in frame:
                more, held = weigh(child, inside or node.named)
                size, whole = size + more, whole or held
        whole = whole or node.tag in WHOLE and size > 0
        outside = outside or whole and not (inside or node.named)
        if node.named:
            sizes.append((node, size, whole))
        return size, whole

    total, _ = weigh(root, False)
    return frame | {id(n) for n, size, whole in sizes if 2 * size <= total or outside and not whole}


def _articles_hold_it(root: Node, gone: set[int], mute: set[int]) -> bool:
    """Whether article and main elements hold ``DOMINANT`` of the text that would be kept."""

    def weigh(node: Node, inside: bool) -> tuple[int, int]:
        all_text = held = 0
        for child in node.children:
            if isinstance(child, str):
                size = 0 if id(node) in mute else len(clean(child))
                all_text, held = all_text + size, held + size * inside
            elif not child.skipped and id(child) not in gone:
                more, whole = weigh(child, inside or child.tag in WHOLE)
                all_text, held = all_text + more, held + whole
        return all_text, held

    all_text, held = weigh(root, False)
    return held > 0 and held >= DOMINANT * all_text


def extract(page: str, wrapper: dict | None) -> str:
    """The page's blocks of content, joined by line ends."""
    group = Group("html", [parse(page)])
    known = wrapper is not None
    if wrapper is None:
        wrapper = induce(group.template())
    frame: set[int] = set()
    mute: set[int] = set()

    def mark(x: dict, g: Group) -> bool:
        """Whether the content node was met."""
        if wrapper["varies"] and (x["frame"] or x["mute"]):
            (frame if x["frame"] else mute).update(map(id, g.nodes))
        met = [mark(a, b) for a, b in aligned(x["kids"], g.kids) if a and b]
        return x["content"] or any(met)

    if not mark(wrapper["tree"], group) and known:
        return extract(page, None)
    gone = _left_out(group.nodes[0], frame, mute)
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if text := clean("".join(held)):
            out.append(text)
        held.clear()

    alone = _articles_hold_it(group.nodes[0], gone, mute)

    def walk(node: Node, kept: bool) -> None:
        for child in node.children:
            if isinstance(child, str):
                if id(node) not in mute and kept:
                    held.append(child)
            elif child.tag in INLINE:
                if id(child) not in gone:
                    walk(child, kept)
            else:
                flush()
                if not child.skipped and id(child) not in gone:
                    walk(child, kept or child.tag in WHOLE or child.tag in HEADINGS)
                    flush()

    for node in group.nodes:
        walk(node, not alone)
        flush()
    return "\n".join(out)


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A template of every host met and the bytes of its pages; full memory is emptied in between."""
    held: dict[str, dict] = {}
    size: dict[str, int] = {}

    def emptied() -> pa.RecordBatch:
        columns = [pa.array(list(held), pa.string()), pa.array(map(json.dumps, held.values()), pa.string()), pa.array(size.values(), pa.int64())]
        held.clear()
        size.clear()
        return pa.RecordBatch.from_arrays(columns, names=["host", "template", "bytes"])

    for batch in batches:
        for host, page, length in zip(batch["host"], batch["html"], pc.binary_length(batch["html"])):
            host, t = host.as_py(), Group("html", [parse(page.as_py() or "")]).template()
            held[host] = merge(held[host], t) if host in held else t
            size[host] = size.get(host, 0) + (length.as_py() or 0)
            if len(held) >= HOSTS_HELD:
                yield emptied()
    yield emptied()


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    whole = None
    for text in sorted(rows["template"]):
        t = json.loads(text)
        whole = t if whole is None else merge(whole, t)
    return pd.DataFrame({"host": rows["host"].iloc[:1], "template": [json.dumps(whole)]})


def _induced(rows: pd.DataFrame) -> pd.DataFrame:
    whole = _merged(rows)
    return pd.DataFrame({"host": whole["host"], "wrapper": [json.dumps(induce(json.loads(whole["template"].iloc[0])))]})


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.coalesce(F.lower(F.try_parse_url("url", F.lit("HOST"))), F.concat(F.lit("?"), F.coalesce("url", F.lit(""))))
    return pages.select("page_id", "url", "html", host.alias("host"))


def templates(pages: DataFrame) -> DataFrame:
    """host, template, bytes for the hosts of every task over ``pages`` (page_id, url, html), written once."""
    made = _with_host(pages).select("host", "html").mapInArrow(_templates, "host string, template string, bytes long")
    return staged(made, "templates")


def wrappers(held: DataFrame) -> DataFrame:
    """host, wrapper for every host of ``held`` templates.

    They are merged in as many parts as a part then holds, at most, of one host's: both steps grow with the root of their number.
    """
    part = F.pmod(F.xxhash64("template"), F.lit(math.isqrt(held.count()) + 1)).alias("part")
    merged = held.groupBy("host", part).applyInPandas(_merged, "host string, template string")
    return merged.groupBy("host").applyInPandas(_induced, "host string, wrapper string")


def large_hosts(held: DataFrame, total: int) -> DataFrame:
    """key (hash of the host), pieces for the hosts that hold a share of 1 / ``LARGE`` of ``total`` bytes: ``LARGE`` rows at most."""
    sizes = held.groupBy(F.xxhash64("host").alias("key")).agg(F.sum("bytes").alias("bytes"))
    return sizes.where(F.col("bytes") * LARGE >= total).select("key", F.ceil(F.col("bytes") / PIECE_BYTES).alias("pieces"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read: dict[str | None, dict | None] = {None: None}
    for batch in batches:
        texts = []
        for page, wrapper in zip(batch["html"], batch["wrapper"]):
            wrapper = wrapper.as_py()
            if wrapper not in read:
                read[wrapper] = json.loads(wrapper)
            texts.append(extract(page.as_py() or "", read[wrapper]))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html).

    The wrapper of a large host stands under a key for every piece of its pages, by their measured bytes, and pages and
    wrappers meet in as many tasks as all bytes ask for: what a task reads does not grow with the pages or with one host.
    """
    held = templates(pages)
    total = held.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    large = F.broadcast(large_hosts(held, total))
    tasks = min(total // TASK_BYTES + 1, MOST_TASKS)

    def in_pieces(df: DataFrame) -> DataFrame:
        keyed = df.withColumn("key", F.xxhash64("host")).join(large, "key", "left")
        return keyed.withColumn("pieces", F.greatest(F.coalesce("pieces", F.lit(1)), F.lit(1)))

    known = in_pieces(wrappers(held)).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    given = in_pieces(_with_host(pages)).withColumn("piece", F.pmod(F.xxhash64("page_id", "url"), F.col("pieces")))
    known = known.select("host", "piece", "wrapper").repartition(tasks, "host", "piece")
    given = given.select("host", "piece", "page_id", "url", "html").repartition(tasks, "host", "piece")
    both = given.join(known.hint("shuffle_hash"), ["host", "piece"], "left").select("page_id", "url", "html", "wrapper")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return both.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
