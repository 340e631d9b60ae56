"""Main text of web pages with a site style tree.

The DOMs of a host are merged by their style paths (tags with their classes).
Each node of the merged tree gets an importance: a leaf's from how its contents
spread over the host's pages (a text on all pages has high entropy and counts
for nothing, a text on one page counts in full), an inner node's from how its
children's layout varies and from what its leaves hold. Branches of low
importance are cut from every page of the host. What markup itself names as
furniture (navigation, adverts, forms, comments and the like) is cut as well.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.texts import bounded_batches, checkpointed, slices

# Names of HTML elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr br".split()
)
SILENT = frozenset(
    "head script style template noscript iframe object embed svg math canvas audio video map form input select option optgroup button textarea "
    "fieldset datalist nav footer aside menu dialog title xmp noembed noframes".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select body html article section div main".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup share sharing social sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "comment comments respond disqus related recommended recommendations widget pagination pager toolbar login".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[a-z0-9]+")
GAMMA = 0.9


@dataclass
class Block:
    """A run of text in one place: its style path, whether markup cuts it, whether an article holds it."""

    path: str
    silent: bool
    article: bool
    text: str


class Element:
    __slots__ = ("tag", "path", "silent", "article", "children")

    def __init__(self, tag: str, path: str, silent: bool, article: bool):
        self.tag, self.path, self.silent, self.article, self.children = tag, path, silent, article, []


def _furniture(tag: str, attributes: str, article: bool) -> tuple[bool, str]:
    """Whether markup names an element as furniture, and its style name."""
    style = tag
    silent = tag in SILENT or (tag == "header" and not article)
    if attributes.strip(" /\n\t\r"):
        found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
        names = found.get("class", "").lower()
        if names.strip():
            style += "." + ".".join(sorted(set(names.split())))
        words = set(NAME.findall(names)) | set(NAME.findall(found.get("id", "").lower()))
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        silent = silent or hidden or bool(words & NAMED) and tag not in ("html", "body", "main", "article") or found.get("role") in ROLES
    return silent, style


def parse(page: str) -> tuple[list[Block], dict[str, str]]:
    """The blocks of a page in order, and the layout of each inner node: its children's styles, runs of equal ones as one."""
    root = Element("", "", False, False)
    stack, blocks, layout = [root], [], {}
    words: list[str] = []
    at = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(words)).split()) if words else ""
        words.clear()
        if text:
            top = stack[-1]
            blocks.append(Block(top.path, top.silent, top.article, text))

    def close() -> None:
        done = stack.pop()
        if done.children:
            layout[done.path] = ",".join(done.children)

    def inside(tags) -> int | None:
        """The place of the nearest such element in scope."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in SCOPES:
                return None
        return None

    while at < len(page):
        m = TOKEN.search(page, at)
        words.append(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in INLINE:
            if tag == "br":
                words.append(" ")
            continue
        flush()
        if m[1]:
            opened = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), None)
            if opened is not None:
                while len(stack) > opened:
                    close()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        implied = inside({"p"}) if tag in CLOSES_P else inside(SIBLINGS[tag]) if tag in SIBLINGS else None
        if implied is not None:
            while len(stack) > implied:
                close()
        if tag in VOID:
            continue
        top = stack[-1]
        silent, style = _furniture(tag, m[3] or "", top.article)
        if not top.children or top.children[-1] != style:
            top.children.append(style)
        stack.append(Element(tag, f"{top.path}/{style}", top.silent or silent, top.article or tag in ("article", "main")))
    flush()
    while len(stack) > 1:
        close()
    return blocks, layout


def main_text(page: str, cut: frozenset) -> str:
    """The blocks that neither markup nor the style tree cuts; where articles have text, theirs alone.

    The tree alone never empties a page: copies of one page would else be all furniture.
    """

    def kept(path: str) -> bool:
        if path not in known:
            steps = path.split("/")
            known[path] = not any("/".join(steps[:i]) in cut for i in range(2, len(steps) + 1))
        return known[path]

    known: dict[str, bool] = {}
    named = [b for b in parse(page)[0] if not b.silent]
    blocks = [b for b in named if kept(b.path)] or named
    own = [b for b in blocks if b.article]
    return "\n".join(b.text for b in own or blocks)


def _features(batches):
    """Of each page: its contents by path, with marks for the first of a path and of a content, and its nodes' layouts."""
    for batch in slices(batches, 200):
        rows: dict[str, list] = defaultdict(list)
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            key = xxhash.xxh64_intdigest(page) - (1 << 63)
            blocks, layout = parse(page)
            counts: dict[tuple, int] = defaultdict(int)
            for b in blocks:
                counts["leaf", b.path, xxhash.xxh64_intdigest(b.text)] += 1
            for path, children in layout.items():
                counts["layout", path, xxhash.xxh64_intdigest(children)] += 1
            seen = set()
            for (kind, path, value), n in counts.items():
                rows["host"].append(host)
                rows["page"].append(key)
                rows["kind"].append(kind)
                rows["path"].append(path)
                rows["value"].append(value - (1 << 63))
                rows["uses"].append(n)
                rows["first"].append(int((kind, path) not in seen))
                seen.add((kind, path))
        if rows:
            yield pa.RecordBatch.from_pydict(dict(rows), schema=FEATURES)


FEATURES = pa.schema([("host", pa.string()), ("page", pa.int64()), ("kind", pa.string()), ("path", pa.string()), ("value", pa.int64()), ("uses", pa.int64()), ("first", pa.int64())])
ALL_HOSTS = "*"


def style_tree(pages: DataFrame, least_pages: int = 10) -> DataFrame:
    """``host, path, pages, importance`` of each node of each host's merged tree, and of the tree of all hosts under ``*``.

    ``pages(host, html)``; copies of a page count once. Hosts with fewer than ``least_pages`` pages have no tree of their own.
    """
    rows = pages.mapInArrow(_features, "host string, page bigint, kind string, path string, value bigint, uses bigint, first bigint")
    rows = rows.groupBy("host", "kind", "path", "value", "page").agg(F.max("uses").alias("uses"), F.max("first").alias("first"))  # copies once
    counts = rows.groupBy("host", "kind", "path", "value").agg(F.sum("uses").alias("uses"), F.count(F.lit(1)).alias("n"), F.sum("first").alias("first"))
    counts = checkpointed(counts, "features")
    everywhere = counts.groupBy(F.lit(ALL_HOSTS).alias("host"), "kind", "path", "value").agg(*[F.sum(c).alias(c) for c in ("uses", "n", "first")])
    counts = counts.unionAll(everywhere)
    nodes = counts.groupBy("host", "kind", "path").agg(F.sum("first").alias("m"))
    rows = counts.join(nodes, ["host", "kind", "path"])
    spread = F.when(F.col("m") > 1, F.log("n") / F.log("m")).otherwise(0.0)
    leaves = rows.where("kind = 'leaf'").groupBy("host", "path").agg(
        F.sum("uses").alias("uses"), F.sum(F.col("uses") * (1.0 - spread)).alias("worth"), F.max("m").alias("m")
    )
    share = F.col("n") / F.col("m")
    inner = rows.where("kind = 'layout'").groupBy("host", "path").agg(
        F.when(F.max("m") > 1, -F.sum(share * F.log(share)) / F.log(F.max("m"))).otherwise(1.0).alias("variety"),
        F.max("m").alias("m"),
        F.max("n").alias("common"),
    )
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    below = leaves.where("path <> ''").select("host", F.explode(above).alias("path"), "uses", "worth", "m")
    content = below.groupBy("host", "path").agg((F.sum("worth") / F.sum("uses")).alias("content"), F.max("m").alias("leaf_pages"))
    both = content.join(inner, ["host", "path"], "left")
    weight = F.lit(GAMMA)
    importance = F.when(F.col("variety").isNull(), F.col("content")).otherwise((1 - weight) * F.col("variety") + weight * F.col("content"))
    tree = both.select("host", "path", F.greatest("leaf_pages", F.coalesce("m", F.lit(0))).alias("pages"), importance.alias("importance"))
    return tree.where((F.col("pages") >= least_pages) | (F.col("host") == ALL_HOSTS))


def host_of(url: Column) -> Column:
    """The host in lower case; empty for a null url or one without a host."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def _texts(batches):
    for batch in slices(batches, 200):
        known: dict[tuple, frozenset] = {}
        found = []
        for page, cut in zip(batch.column("html").to_pylist(), batch.column("cut").to_pylist()):
            key = tuple(cut or ())
            if key not in known:
                known[key] = frozenset(key)
            found.append(main_text(page, known[key]))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"])


def extracted(pages: DataFrame, least: float = 0.25, least_pages: int = 10) -> DataFrame:
    """``page_id, url, text`` per row of ``pages(page_id, url, html)``.

    Nodes with an importance below ``least`` are cut. A host with fewer than
    ``least_pages`` pages is held against the tree of all hosts. Null and empty
    html gives an empty text; a null url is a host of its own; repeated rows each
    get their text; other columns are not read. Pages are joined with the cut
    paths of their host, which grow with the host's templates, not its pages.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    tree = checkpointed(style_tree(rows.select("host", "html"), least_pages), "style-tree")
    cut = tree.where(F.col("importance") < least).groupBy("host").agg(F.array_sort(F.collect_set("path")).alias("cut"))
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    names = sizes.select("host", F.when(F.col("n") >= least_pages, F.col("host")).otherwise(F.lit(ALL_HOSTS)).alias("tree"))
    cuts = names.join(cut.withColumnRenamed("host", "tree"), "tree", "left").select("host", "cut")
    joined = rows.join(checkpointed(cuts, "cut-paths"), "host", "left").select("page_id", "url", "html", "cut")
    return joined.mapInArrow(_texts, "page_id bigint, url string, text string")
