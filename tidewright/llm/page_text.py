"""Main text of web pages with site templates removed.

Pages are parsed into elements; every element subtree gets a hash of its tag, classes and content.
Spark counts, per host, the pages that hold each block element. A subtree in at least ``FEW_PAGES`` pages
and the square root of the host's pages is a template part, a strong one in at least ``MIN_PAGES`` pages and
``SHARE`` of them. The parts of a host are sent once ahead of its pages (of each slice of a host with many
pages), which are parsed again without them. Menus, headers, footers, sidebars, notices, adverts, forms, comments,
scripts and styles are also dropped by their tag, class, id or role.

The text is taken from ``main`` or ``article`` elements where the page has them. The counts decide inside
these too, but spare what an article may share with others: a single paragraph, heading, list item, quote,
code, table or figure that recurs, and a container of such blocks with more than half of the text (a page in
several copies). Elsewhere strong parts always go; other parts go unless they are a single block or hold
more than half of the text. A host with fewer than ``FEW_PAGES`` pages shows no recurrence.

Character references are decoded, white space inside a block becomes one space, blocks are joined by
two \\n in page order. Null or empty html gives an empty text; a null url is a host of its own (empty).
Broken markup never fails: an unclosed element ends with its parent, a paragraph at the next block.
Repeated rows are separate pages and each counts. Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import arrow_schema, record_batch, saved, small_batches

FEW_PAGES, MIN_PAGES, SHARE = 3, 10, 0.1
#: A host with more than 1 / SLICES of all pages is dealt over slices of that size (at most SLICES such hosts).
SLICES = 16384

_MARK, _NAME_END = re.compile("[>\"']"), re.compile(r"[\s/>]")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"\s+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg math object canvas textarea title xmp noembed noframes".split())
_GONE = _RAW | frozenset("head nav header footer aside form button select option label fieldset input dialog menu audio video map".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre table dl figcaption".split())
#: Blocks that count as one quoted passage.
_PASSAGES = _TEXT_BLOCKS | {"figure", "dt", "dd", "tr", "td", "th", "tbody", "thead", "caption"}
#: An opening tag of the key ends open elements of the value, up to the nearest element in _SCOPE.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
_SCOPE = frozenset("html body div section article main ul ol dl table aside nav header footer form blockquote".split())
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|banner|sponsor|sponsored|promo|promotion|nav|navbar|navigation|menu|menubar|"
    r"breadcrumb|breadcrumbs|sidebar|aside|footer|header|masthead|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|"
    r"subscribe|subscription|newsletter|signup|login|comment|comments|commentlist|disqus|reply|replies|respond|share|sharing|social|"
    r"related|recommended|pagination|pager|toolbar|widget|search|skip|copyright|disclaimer|hidden)(?:$|[\s_-])", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())


class Node:
    __slots__ = ("tag", "noise", "parts", "label", "code", "textual", "size")

    def __init__(self, tag: str, label: str, noise: bool):
        self.tag, self.label, self.noise, self.parts, self.code, self.textual, self.size = tag, label, noise, [], 0, tag in _TEXT_BLOCKS, 0


def _attributes(tag: str, text: str) -> tuple[str, bool]:
    """(class and id text, whether they mark the element as no content)."""
    if not text or "=" not in text and "hidden" not in text:
        return "", False
    names = {}
    for m in _ATTRIBUTE.finditer(text):
        names.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    label = f"{names.get('class', '')} {names.get('id', '')}".strip()
    noise = (
        "hidden" in names or names.get("aria-hidden", "").lower() == "true" or names.get("role", "").lower() in _ROLES
        or "display:none" in names.get("style", "").replace(" ", "").lower()
        or tag not in ("html", "body", "main", "article") and bool(label) and bool(_NOISE.search(label)))
    return label, noise


class _Open:
    """The open elements, with the places of each tag and of the scopes, so that no tag walks the stack."""

    def __init__(self, root: Node):
        self.nodes, self.places, self.scopes = [root], defaultdict(list), [0]

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.nodes))
        if node.tag in _SCOPE:
            self.scopes.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        """Close all elements from place ``at`` on."""
        while len(self.nodes) > at:
            self.places[self.nodes.pop().tag].pop()
        while self.scopes[-1] >= at:
            self.scopes.pop()

    def close(self, tag: str) -> None:
        """End the innermost ``tag``, unless it lies outside the innermost scope and is none itself."""
        places = self.places[tag]
        if places and (tag in _SCOPE or places[-1] > self.scopes[-1]):
            self.cut(places[-1])

    def end(self, tags: set[str]) -> None:
        """End the outermost of ``tags`` inside the innermost scope."""
        lowest = len(self.nodes)
        for tag in tags:
            places = self.places[tag]
            if places and places[-1] > self.scopes[-1]:
                lowest = min(lowest, places[bisect_right(places, self.scopes[-1])])
        self.cut(lowest)


class _Ends:
    """Where the markup that starts at a place ends; linear in the page over all calls, however broken it is."""

    def __init__(self, page: str):
        self.page, self.last, self.stop = page, page.rfind(">"), -1
        self.places = [m.start() for m in _MARK.finditer(page)]
        # From the back: outside quotes a > ends a tag, and a quote leads behind its partner.
        self.ends, partner = [-1] * (len(self.places) + 1), {}
        for k in range(len(self.places) - 1, -1, -1):
            mark = page[self.places[k]]
            if mark == ">":
                self.ends[k] = self.places[k]
            else:
                if mark in partner:
                    self.ends[k] = self.ends[partner[mark] + 1]
                partner[mark] = k

    def name(self, at: int) -> int:
        """The end of the name that starts at ``at``."""
        if not at <= self.stop:
            found = _NAME_END.search(self.page, at)
            self.stop = found.start() if found else len(self.page)
        return self.stop

    def tag(self, at: int) -> int:
        """The > that ends a tag whose name ends at ``at``, or -1."""
        return self.ends[bisect_left(self.places, at)]


def parse(page: str) -> Node:
    root = Node("#root", "", False)
    opened, ends, at, size = _Open(root), _Ends(page), 0, len(page)
    while at < size:
        parts = opened.nodes[-1].parts
        if page[at] != "<":
            stop = page.find("<", at)
            stop = size if stop < 0 else stop
            parts.append(page[at:stop])
            at = stop
            continue
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = size if stop < 0 else stop + 3
            continue
        if page.startswith(("<!", "<?"), at) and at < ends.last:
            at = page.find(">", at) + 1
            continue
        closing = page.startswith("/", at + 1)
        start = at + 1 + closing
        stop = ends.name(start) if at < ends.last and start < size and page[start].isascii() and page[start].isalpha() else -1
        end = ends.tag(stop) if stop > 0 else -1
        if end < 0:
            parts.append("<")
            at += 1
            continue
        tag, rest, at = page[start:stop].lower(), page[stop:end], end + 1
        if closing:
            opened.close(tag)
            continue
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if tag == "body" and opened.places["head"]:
            opened.cut(opened.places["head"][0])
        if tag in _BLOCK:
            opened.end({"p"} | _ENDS.get(tag, set()))
        node = Node(tag, *_attributes(tag, rest))
        opened.nodes[-1].parts.append(node)
        if tag not in _VOID and not rest.rstrip().endswith("/"):
            opened.push(node)
    return root


def _finish(root: Node) -> list[Node]:
    """All elements, children before parents, with subtree hashes and characters of text that the fixed lists leave."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in node.parts if isinstance(p, Node)]
    order.reverse()
    for node in order:
        content = [f"<{node.tag} {node.label}>"]
        for p in node.parts:
            if isinstance(p, Node):
                content.append(f"{p.code:x}")
                node.textual |= p.textual
                if not _listed(p):
                    node.size += p.size
            else:
                content.append(_SPACE.sub(" ", p).strip())
                node.size += len(content[-1])
        node.code = xxhash.xxh3_64_intdigest("\x00".join(content).encode("utf-8", "replace")) >> 1
    return order


def _listed(node: Node) -> bool:
    return node.tag in _GONE or node.noise


def subtrees(page: str) -> set[int]:
    """Hashes of the page's element subtrees below the body."""
    return {n.code for n in _finish(parse(page)) if n.tag in _BLOCK and n.tag not in ("html", "body", "main", "article") and n.parts}


def main_text(page: str, strong: frozenset[int] = frozenset(), weak: frozenset[int] = frozenset()) -> str:
    root = parse(page)
    order = _finish(root)
    roots = []

    def gone(node: Node, inside: bool, size: int) -> bool:
        if _listed(node):
            return True
        often = node.code in strong
        if not often and node.code not in weak or node.tag not in _BLOCK or node.tag in ("html", "body", "main", "article"):
            return False
        if often and not (inside and node.textual):
            return True
        return node.tag not in _PASSAGES and 2 * node.size <= size

    def find(tag: str) -> None:
        todo = [root]
        while todo:
            node = todo.pop()
            if node.tag == tag:
                roots.append(node)
            elif not _listed(node):
                todo += [p for p in reversed(node.parts) if isinstance(p, Node)]

    for tag in ("main", "article"):
        if not roots and any(n.tag == tag for n in order):
            find(tag)
    inside = bool(roots)
    blocks, line = [], []

    def end_block() -> None:
        text = _SPACE.sub(" ", "".join(line)).strip()
        if text:
            blocks.append(text)
        line.clear()

    for start in roots or [root]:
        todo: list = [start]
        while todo:
            item = todo.pop()
            if item is None:
                end_block()
            elif isinstance(item, str):
                line.append(entities.unescape(item))
            elif not gone(item, inside, start.size):
                if item.tag in ("br", "td", "th"):
                    line.append(" ")
                block = item.tag in _BLOCK and item.tag not in ("td", "th")
                if block:
                    end_block()
                    todo.append(None)
                todo += reversed(item.parts)
        end_block()
    return "\n\n".join(blocks)


def page_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = small_batches(pages).select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.xxhash64(host).alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("host long,code long")
        for batch in batches:
            hosts, codes = [], []
            for at, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                found = subtrees(page)
                found.add(-1)  # counts the page itself
                hosts += [at] * len(found)
                codes += found
            yield record_batch(schema, host=hosts, code=codes)

    counts = saved(rows.select("host", "html").mapInArrow(elements, "host long, code long").groupBy("host", "code").agg(F.count("*").alias("n"))
                   .where((F.col("n") >= FEW_PAGES) | (F.col("code") == -1)), "subtrees")
    sites = counts.where("code = -1").select("host", F.col("n").alias("n_pages"))
    slice_size = max(1.0, (sites.agg(F.sum("n_pages")).first()[0] or 0) / SLICES)
    # SLICES rows at most, 16 bytes each, whatever the input.
    busy = F.broadcast(sites.where(F.col("n_pages") > slice_size).select("host", F.ceil(F.col("n_pages") / slice_size).alias("slices")))
    often = (F.col("n") >= MIN_PAGES) & (F.col("n") >= SHARE * F.col("n_pages"))
    parts = (counts.where("code <> -1").join(sites, "host").where(often | (F.col("n") >= F.sqrt("n_pages")))
             .groupBy("host").agg(F.collect_list(F.when(often, F.col("code"))).alias("strong"), F.collect_list(F.when(~often, F.col("code"))).alias("weak"))
             .join(busy, "host", "left").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("slices", F.lit(1)) - 1))).drop("slices"))
    dealt = (rows.withColumn("row", F.monotonically_increasing_id()).join(busy, "host", "left")
             .withColumn("slice", F.pmod("row", F.coalesce("slices", F.lit(1)).cast("long"))).drop("row", "slices"))
    # A row of parts stands ahead of the pages it is for, so that no page carries a copy.
    queue = (parts.withColumn("page", F.lit(False)).unionByName(dealt.withColumn("page", F.lit(True)), allowMissingColumns=True)
             .repartition("host", "slice").sortWithinPartitions("host", "slice", "page"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("id long,url string,text string,n_chars long")
        at, strong, weak = None, frozenset(), frozenset()
        for batch in batches:
            ids, urls, texts = [], [], []
            for row in batch.to_pylist():
                if (row["host"], row["slice"]) != at:
                    at, strong, weak = (row["host"], row["slice"]), frozenset(), frozenset()
                if not row["page"]:
                    strong, weak = frozenset(row["strong"]), frozenset(row["weak"])
                    continue
                ids.append(row["id"])
                urls.append(row["url"])
                texts.append(main_text(row["html"], strong, weak))
            yield record_batch(schema, id=ids, url=urls, text=texts, n_chars=list(map(len, texts)))

    return queue.mapInArrow(extract, "id long, url string, text string, n_chars long").withColumnRenamed("id", id_col)
