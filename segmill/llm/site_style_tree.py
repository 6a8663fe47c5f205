"""Main text of web pages by site style trees.

Pages of one host share a tree: nodes are paths of tags with their class and id (long numbers in names
count as one), merged over pages. A node is known by a hash of its path, so depth costs no memory.
A node's content is as important as its texts are rare over the host's pages: with p_j the share of a
text's places on page j of m, the text's entropy to the base m is near 1 if every page has it and 0
if one page has it; importance is 1 minus the mean entropy, by length. Presentation counts too: the
children of the element around a node, as a style, have an entropy over pages that raises it; links
lower it, and so does standing outside `article` and `main` on a host that has them, and a tag or name
that pages give to menus, footers, adverts, forms, comments and the like. The text of nodes of low
importance is removed from each page of the host, inside `article` and `main` as well; a branch
without other text goes.

A name takes a branch of any length below the threshold, unless the branch holds most of the text
without links that is rare on the host, within the main branches or on a host without them: such a
name stands for the article's wrapper. Names of reader comments always count. An `aside` inside an
article needs more than its tag: text that other pages repeat, or links.

Pages of a host with the same main text (the same article under several addresses) count as one, so
that copies do not make an article look like a menu. One rule is fixed: a page with unnamed text never
comes out empty: where all of it is of low importance, it stays.

Pages are parsed once, to blocks with their text, the hash of their path and of their text, in a table
bucketed by task. Statistics are Spark aggregations over (host, path, hash), so a host of any size costs
a task only partial sums. Nodes of low importance are joined to the nodes of each page, and only these
go to the task that has the page's text; no list per host is made.

Cases: null html is empty, and its text is empty; a null url has a host of its own (''); repeated
rows each get their row; text outside any element is a block of the root; an unclosed element ends
with its parent, an unclosed form field, title or drawing at the next block; broken markup of any kind
is read as browsers do (an unclosed tag, quote or comment takes what follows) and never raises; a page
of any depth or length is read in time in proportion to its length; nodes of equal importance go or
stay alike; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from segmill.llm.common import configure, join_counted, stage
from segmill.llm.parts import SLOT_TEXT, bucket_number
from segmill.sources.staging import MOST_BUCKETS, bucket_homes, stage_bucketed

#: Text of a node below this importance goes.
LEAST_IMPORTANCE = 0.3
#: Weights of presentation: of a name, of `aside` in a main branch, what standing outside the main branches takes, what links take, what a varied style adds.
NAMED, ASIDE, OUTSIDE, LINKED, VARIED = 0.2, 0.5, 0.5, 0.5, 0.2

#: Elements without text for readers, without content, and without an end tag.
SILENT = frozenset("script style noscript template head title iframe object svg math canvas select optgroup option datalist textarea button xmp noembed noframes".split())
#: Of these, those that end at the next block, and those that do if no end tag follows.
FIELDS, LOOSE = frozenset("title iframe svg math select optgroup option datalist textarea".split()), frozenset("button object canvas noscript template".split())
#: Elements whose content is text up to their end tag; without one the first four take the rest of the page.
RAW = ("script", "style", "xmp", "noframes", "noembed", "iframe", "textarea", "title")
CHROME = frozenset("nav footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br img wbr".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
#: Words in class, id or role that name what is not the article.
CHROME_WORDS = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
    "header masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion related "
    "recommended replies reply respond share sharing sidebar sponsor sponsored subscribe toolbar widget widgets alert complementary "
    "contentinfo search banners topbar copyright social".split()
)
#: Those of them that name readers' comments.
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
#: Words that may stand beside those in one name; with any other word (has-sidebar, related-work) it is not such a name.
PLAIN_WORDS = frozenset(
    "area article bar block body bottom box btn button buttons col column container content entry global group inner item items left link links list main "
    "message outer page panel post posts primary right row secondary section site slot small stories sub text title top unit wide wrap wrapper".split()
)
#: Words that name no chrome inside the main branch.
HEADER_WORDS = frozenset(("header", "masthead", "banner"))
#: Elements of a head; any other ends it.
IN_HEAD = frozenset("head meta link title style script base noscript template basefont bgsound noframes".split())
#: Which open element a start tag ends, and where the search for it stops.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr main menu nav ol p pre search section table ul".split()
)
CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("html body table td th div article section main ul ol dl aside nav footer header form".split())

#: A text of a node on one page: how often it stands there, its length, and how much of all its places is links.
FEATURE = (
    T.StructType().add("node", T.LongType()).add("over", T.LongType()).add("in_main", T.BooleanType()).add("branches", T.ArrayType(T.LongType())).add("sure", T.BooleanType())
    .add("aside", T.BooleanType()).add("feature", T.LongType()).add("size", T.LongType()).add("links", T.LongType()).add("c", T.LongType())
)
STYLE = T.StructType().add("node", T.LongType()).add("style", T.LongType()).add("c", T.LongType())
PARSED = (
    T.StructType().add("slot", T.LongType()).add("row", T.LongType()).add("page_id", T.LongType()).add("url", T.StringType()).add("host", T.StringType()).add("copy", T.LongType()).add("main", T.BooleanType())
    .add("features", T.ArrayType(FEATURE)).add("styles", T.ArrayType(STYLE)).add("nodes", T.ArrayType(T.LongType())).add("fallback", T.ArrayType(T.IntegerType())).add("texts", T.ArrayType(T.StringType()))
)
RESULT = T.StructType().add("page_id", T.LongType()).add("url", T.StringType()).add("text", T.StringType()).add("n_chars", T.LongType())
HOST = r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
#: Named branches around a node that are told apart; more stand for the outermost ones.
MOST_BRANCHES = 8
_NAME, _NUMBER = re.compile(r"[^a-z0-9]+"), re.compile(r"\d{3,}")


#: A comment; a declaration or other mark without meaning; an end tag; a start tag with its attributes. Nothing is read twice.
_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]|\Z))[^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|<([a-zA-Z][^\s/>]*+)((?:=\s*+"[^"]*+(?:"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>=]|=)*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+|'[^']*+|[^\s>"']++))?""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_NAMES = ("class", "id", "role")


@dataclass(frozen=True)
class Place:
    """A node of the tree: its path's hash, the one above it, whether it stands in a main branch, and what names cover it.

    branches: those above it (or itself) that a tag or name marks; sure: one of them is for comments;
    aside: it stands in an `aside` of a main branch.
    """

    node: int
    over: int
    in_main: bool
    branches: tuple[int, ...]
    sure: bool
    aside: bool

    @property
    def named(self) -> bool:
        return self.sure or bool(self.branches)


@dataclass(frozen=True)
class Block:
    place: Place
    text: str
    links: int


class Node:
    """An element with text or children: its label, and the mark of a name (* main, ! chrome, ? comments, ~ aside)."""

    __slots__ = ("above", "label", "mark", "holds_main", "place")

    def __init__(self, above: Node | None, label: str, mark: str):
        self.above, self.label, self.mark, self.holds_main, self.place = above, label, mark, False, None


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class PageTree:
    """Blocks of a page in order, each with its path, and the children of its elements as styles."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, Node, list[str], bool]] = []
        self.open: Counter[str] = Counter()
        self.found: list[tuple[Node, str, int]] = []
        self.shown: list[tuple[Node, str]] = []
        self.blocks: list[Block] = []
        self.styles: list[tuple[int, int]] = []
        self.text: list[str] = []
        self.links = self.silent = self.in_link = self.fields = self.mains = 0
        self.root = self.node = Node(None, "", "")
        self.root.place = Place(0, 0, False, (), False, False)

    def read(self, html: str) -> PageTree:
        at, start, last_end = 0, 0, {}
        absent: set[str] = set()
        while (at := html.find("<", at)) >= 0:
            m = _MARKUP.match(html, at)
            if m is None:  # a sign in the text
                at += 1
                continue
            self.data(html[start:at])
            at = start = m.end()
            if m.group(1):
                self.end(m.group(1).lower())
            elif m.group(2):
                tag = m.group(2).lower()
                if tag in _RAW_END and tag not in absent:
                    if after := _RAW_END[tag].search(html, at):
                        at = start = after.start()
                    elif tag in RAW[:4]:
                        at = start = len(html)
                    else:
                        absent.add(tag)
                if tag in LOOSE and tag not in last_end:
                    last_end[tag] = html.lower().rfind(f"</{tag}")
                self.begin(tag, m.group(3), loose=tag in LOOSE and last_end[tag] < at)
        self.data(html[start:])
        while self.stack:
            self.pop()
        self.flush()
        self.blocks = [Block(self.place_of(node), text, links) for node, text, links in self.found]
        self.styles = [(self.place_of(node).node, _hash(style)) for node, style in self.shown]
        return self

    def data(self, text: str) -> None:
        if text and not self.silent:
            text = unescape(text)
            self.text.append(text)
            if self.in_link:
                self.links += len(text)

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append((self.node, text, min(self.links, len(text))))
        self.text, self.links = [], 0

    def begin(self, tag: str, attributes: str, loose: bool = False) -> None:
        if tag not in IN_HEAD and self.stack and self.stack[-1][0] == "head":
            self.pop()
        if tag in CLOSES_P:
            while self.fields:
                self.pop()
            self.close(("p",))
        if tag in CLOSES_SAME:
            self.close(CLOSES_SAME[tag])
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag in INLINE:
            if tag == "a":
                self.in_link += 1
            return
        self.flush()
        names = [v for k, v in self.attributes(attributes) if k in _NAMES and v]
        label = _NUMBER.sub("#", ".".join([tag, *(w for v in names for w in _NAME.split(v) if w)]))
        mark = "*" if tag in MAIN else self.mark(tag, names)
        if tag in MAIN:
            above = self.node
            while above is not None and not above.holds_main:  # no name counts for what holds the main branch
                above.holds_main, above.mark = True, above.mark.strip("!?~")
                above = above.above
            self.mains += 1
        if self.stack:
            self.stack[-1][2].append(label)
        field = loose or tag in FIELDS
        self.stack.append((tag, self.node, [], field))
        self.open[tag] += 1
        self.fields += field
        self.node = Node(self.node, label, mark)
        self.silent += tag in SILENT

    @staticmethod
    def attributes(text: str) -> list[tuple[str, str]]:
        return [(k.lower(), unescape(v.lstrip("\"'")).lower()) for k, v in _ATTRIBUTE.findall(text)] if "=" in text else []

    def mark(self, tag: str, names: list[str]) -> str:
        """Whether the tag, or a whole class, id or role, names what is not content."""
        inside = any(self.open[t] for t in MAIN)
        if tag in ("html", "body") or (inside and tag in HEADINGS):
            return ""
        chrome = CHROME_WORDS - HEADER_WORDS if inside else CHROME_WORDS
        found = [w for v in names for name in v.split() if _is_name(words := [w for w in _NAME.split(name) if w], chrome) for w in words]
        if not COMMENT_WORDS.isdisjoint(found):
            return "?"
        if found or (tag in CHROME and not (inside and tag == "aside")) or tag == "header":
            return "!"
        return "~" if tag == "aside" else ""

    def end(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.in_link = max(0, self.in_link - 1)
            return
        if self.open[tag]:
            while self.pop() != tag:
                pass
        elif tag == "p":
            self.flush()

    def close(self, tags: tuple[str, ...]) -> None:
        """End the nearest open element of these tags, unless another scope lies between."""
        if not any(self.open[t] for t in tags):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at][0]
            if tag in tags:
                while len(self.stack) > at:
                    self.pop()
                return
            if tag in SCOPE:
                return

    def pop(self) -> str:
        self.flush()
        tag, before, children, field = self.stack.pop()
        if children:
            short = [c for c, before_it in zip(children, [None, *children], strict=False) if c != before_it]
            self.shown.append((self.node, ",".join(short)))
        self.open[tag] -= 1
        self.fields -= field
        self.silent -= tag in SILENT
        self.node = before
        self.in_link = 0
        return tag

    def place_of(self, node: Node) -> Place:
        way = []
        while node.place is None:
            way.append(node)
            node = node.above
        place = node.place
        for below in reversed(way):
            own, mark = _hash(f"{place.node}/{below.label}/{below.mark}"), below.mark
            branches = (*place.branches, own) if mark == "!" and len(place.branches) < MOST_BRANCHES else place.branches
            place = below.place = Place(own, place.node, place.in_main or mark == "*", branches, place.sure or mark == "?", place.aside or mark == "~")
        return place


def _is_name(words: list[str], chrome: frozenset[str]) -> bool:
    return not chrome.isdisjoint(words) and all(w in chrome or w in PLAIN_WORDS or w.isdigit() for w in words)


def hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", host)


def main_text(blocks: list[Block]) -> list[int]:
    """Places of the blocks that no name covers: those of the main branches, or all if the page has none there."""
    unnamed = [k for k, b in enumerate(blocks) if not b.place.named]
    return [k for k in unnamed if blocks[k].place.in_main] or unnamed


def _digest(blocks: list[Block]) -> int | None:
    return _hash("\0".join(f"{b.place.node}\0{b.text}" for b in blocks)) if blocks else None


def parse_pages(pages: DataFrame, homes: list[int] | None = None) -> DataFrame:
    """Each page's blocks, with what the style trees count of them; homes: numbers of the slots that tasks get.

    fallback: places of the blocks that stay where all are of low importance.
    """
    homes = homes or [0]
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in PARSED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        row, slot = task << 33, homes[task % len(homes)]
        for batch in batches:
            out = []
            for page_id, url, html, host in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tree = PageTree().read(html or "")
                counts, links = Counter(), Counter()
                for b in tree.blocks:
                    counts[b.place, b.text] += 1
                    links[b.place, b.text] += b.links
                features = [dict(vars(place), feature=_hash(text), size=len(text), links=links[place, text], c=c) for (place, text), c in counts.items()]
                styles = [dict(node=node, style=style, c=c) for (node, style), c in Counter(tree.styles).items()]
                main = main_text(tree.blocks)
                own = dict(slot=slot, row=row, page_id=page_id, url=url, host=host, copy=_digest([tree.blocks[k] for k in main] or tree.blocks), main=any(b.place.in_main for b in tree.blocks))
                out.append(own | dict(features=features, styles=styles, nodes=[b.place.node for b in tree.blocks], fallback=main, texts=[b.text.encode("utf-8", "replace").decode() for b in tree.blocks]))
                row += 1
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return hosted(pages).select("page_id", "url", "html", "host").mapInArrow(run, PARSED)


def _entropy(total: str, weighted: str, pages: str):
    """Entropy to the base of the number of pages, from sum(c) and sum(c log c)."""
    h = (F.log(F.col(total)) - F.col(weighted) / F.col(total)) / F.log(F.col(pages))
    return F.when(F.col(pages) > 1, F.greatest(F.lit(0.0), F.least(F.lit(1.0), h))).otherwise(0.0)


def wrappers(nodes: DataFrame) -> DataFrame:
    """(host, branch): named branches that hold most of the host's rare text without links, so that their name does not count.

    A branch in a main branch is held against the text there; outside them only hosts without them have any.
    """
    rare = nodes.where(F.col("in_main") | (F.col("mains") < 0.5))
    whole = rare.groupBy("host", "in_main").agg(F.sum("free").alias("whole"))
    held = rare.select("host", "in_main", "free", F.explode("branches").alias("branch")).groupBy("host", "in_main", "branch").agg(F.sum("free").alias("held"))
    whole = whole.groupBy("host").agg(F.sum("whole").alias("all"), F.sum(F.when(F.col("in_main"), F.col("whole"))).alias("main"))
    joined = held.join(whole, "host").where(2 * F.col("held") > F.when(F.col("in_main"), F.col("main")).otherwise(F.col("all")))
    return joined.select("host", "branch").distinct()


def style_tree(parsed: DataFrame) -> DataFrame:
    """(host, node, importance, size, n): the merged trees of all hosts, every node that has text of its own; n is at least the pages that have it.

    Pages with the same main text (copy) count once: what several of them have counts as on one page.
    """
    pages = parsed.where("copy is not null").groupBy("host", "copy").agg(F.max("main").alias("main")).groupBy("host").agg(F.count(F.lit(1)).alias("m"), F.count_if("main").alias("mains"))
    node = [F.max(c).alias(c) for c in ("over", "in_main", "branches", "sure", "aside")]  # the same wherever the node stands
    on_page = parsed.select("host", "copy", F.inline("features")).groupBy("host", "node", "feature", "copy")
    on_page = on_page.agg(F.max("c").alias("c"), F.max("size").alias("size"), F.max("links").alias("links"), F.count(F.lit(1)).alias("n"), *node)
    texts = on_page.groupBy("host", "node", "feature").agg(
        F.sum("c").alias("k"), F.sum(F.col("c") * F.log("c")).alias("clogc"), F.sum(F.col("c") * F.col("size")).alias("size"), F.sum("links").alias("links"), F.sum("n").alias("n"), *node
    )
    texts = texts.join(pages, "host").withColumn("entropy", _entropy("k", "clogc", "m"))
    nodes = texts.groupBy("host", "node").agg(
        F.sum("size").alias("size"), F.sum(F.col("size") * (1 - F.col("entropy"))).alias("rare"), F.sum("links").alias("links"),
        F.sum((F.col("size") - F.col("links")) * (1 - F.col("entropy"))).alias("free"), F.max(F.col("mains") / F.col("m")).alias("mains"), F.sum("n").alias("n"), *node,
    )
    nodes = stage(nodes)
    styles = parsed.select("host", "copy", F.inline("styles")).groupBy("host", "node", "style", "copy").agg(F.max("c").alias("c"))
    styles = styles.groupBy("host", F.col("node").alias("over"), "style").agg(F.sum("c").alias("c"))
    styles = styles.groupBy("host", "over").agg(F.sum("c").alias("k"), F.sum(F.col("c") * F.log("c")).alias("clogc")).withColumn("shown", _entropy("k", "clogc", "k"))
    counted = nodes.select("host", "node", F.explode("branches").alias("branch")).join(wrappers(nodes), ["host", "branch"], "left_anti").select("host", "node").distinct().withColumn("covered", F.lit(True))
    content = F.col("rare") / F.greatest(F.col("size"), F.lit(1))
    linked = F.least(F.col("links") / F.greatest(F.col("size"), F.lit(1)), F.lit(1.0))
    look = F.coalesce(F.col("shown"), F.lit(0.0))  # a style that varies over pages is a sign of content
    named = F.when(F.col("sure") | F.coalesce("covered", F.lit(False)), NAMED).when(F.col("aside"), ASIDE).otherwise(1.0)
    outside = F.when(F.col("in_main"), 1.0).otherwise(1 - OUTSIDE * F.col("mains"))
    importance = F.least(F.lit(1.0), content * (1 - LINKED * linked + VARIED * look)) * named * outside
    found = nodes.join(styles.select("host", "over", "shown"), ["host", "over"], "left").join(counted, ["host", "node"], "left")
    return found.select("host", "node", importance.alias("importance"), "size", "n")


def low_nodes(parsed: DataFrame, tree: DataFrame, least: float) -> DataFrame:
    """(slot, low): for the pages of each slot, (row, node) of their nodes of low importance. A node that many pages have is dealt out."""
    there = parsed.select("slot", "row", "host", F.explode(F.array_distinct("nodes")).alias("node"))
    low = stage(tree.where(F.col("importance") < least).select("host", "node", "n"))
    found = join_counted(there, low, ["host", "node"])
    return stage(found.groupBy("slot").agg(F.collect_list(F.struct("row", "node")).alias("low")))


def extract_main_text(spark: SparkSession, pages: DataFrame, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    configure(spark)
    size = pages.agg(F.sum(F.octet_length(F.col("html").cast("string")))).first()[0] or 0
    slots = min(MOST_BUCKETS, bucket_number(size, SLOT_TEXT))
    parsed = stage_bucketed(parse_pages(pages, bucket_homes(spark, slots)), "slot", slots)
    low = low_nodes(parsed, stage(style_tree(parsed)), least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for texts, nodes, fallback, low in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True):
                gone = set(low or ())
                stays = [k for k, node in enumerate(nodes) if node not in gone] or fallback
                out.append("\n".join(texts[k] for k in stays))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=RESULT.names)

    own = F.transform(F.filter("low", lambda x: x["row"] == F.col("row")), lambda x: x["node"])
    return parsed.join(low.hint("shuffle_hash"), "slot", "left").select("page_id", "url", "texts", "nodes", "fallback", own.alias("low")).mapInArrow(run, RESULT)
