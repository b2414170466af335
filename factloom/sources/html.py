"""HTML pages as trees, and trees as ordered blocks and table rows. Markup is recovered as it comes: end tags are implied, stray ones ignored, and what is never closed ends with its parent."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch of pages; a larger page is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 64, 4 << 20
#: Elements nest so deep at most; deeper ones become siblings, with all their text.
DEEPEST = 200
#: Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
OWN_BLOCKS = HEADINGS | frozenset("p pre ul ol li table".split())
CONTAINERS = frozenset("div section article main header footer td th tr tbody thead tfoot".split())
UNSEEN = frozenset("script style noscript head title template".split())
CELLS, ROWS, GROUPS = frozenset(("td", "th")), frozenset(("tr",)), frozenset(("tbody", "thead", "tfoot"))
#: What the start of an element ends, up to where: an open element of the first set is closed unless one of the second lies between.
IMPLIED = (
    ({"p"}, OWN_BLOCKS | CONTAINERS | {"form", "hr", "blockquote", "dl", "address", "center"}, {"td", "th", "table", "button"}),
    ({"li"}, {"li"}, {"ul", "ol", "table"}),
    (CELLS, CELLS | ROWS | GROUPS, {"table"}),
    (ROWS, ROWS | GROUPS, {"table"}),
    (GROUPS, GROUPS, {"table"}),
    ({"dt", "dd"}, {"dt", "dd"}, {"dl"}),
    ({"option"}, {"option"}, {"select"}),
)
_NO_BREAK, _SPACE = re.compile("[   ]"), re.compile(r"[\t\r\n\f ]+")
_MARKER = re.compile(r"(?i)\bitem\s+\d+[a-z]?\b|\bpart\s+[ivx]+\b")
_CLOSING = re.compile(r"(?i)\bsignatures?\b")
_SIGNED = re.compile(r"(?i)^\s*/\s*s\s*/")
_BOLD = ("bold", "700", "800", "900")


def clean(text: str) -> str:
    """No-break spaces as spaces, runs of white space as one, none at the ends."""
    return _SPACE.sub(" ", _NO_BREAK.sub(" ", text)).strip()


class Node:
    """An element with its attributes and, in order, its texts and elements."""

    __slots__ = ("tag", "attributes", "children", "hidden", "_seen")

    def __init__(self, tag: str, attributes: dict[str, str], hidden: bool):
        self.tag, self.attributes, self.hidden = tag, attributes, hidden
        self.children: list[str | Node] = []
        self._seen: tuple[str, int, int, bool] | None = None

    def elements(self) -> Iterator[Node]:
        return (c for c in self.children if isinstance(c, Node))

    def below(self) -> Iterator[Node]:
        for c in self.elements():
            yield c
            yield from c.below()

    def raw(self) -> str:
        """Visible text as it stands; a line break is a space, a word break nothing."""
        if self.hidden:
            return ""
        return "".join([c if isinstance(c, str) else " " if c.tag == "br" else c.raw() for c in self.children])

    def seen(self) -> tuple[str, int, int, bool]:
        """Clean visible text, links into the page, characters of all links, and whether it is set bold, wholly or in part."""
        if self._seen is None:
            inner, style = list(self.below()), (self.attributes.get("style") or "").lower()
            links = [n for n in inner if n.tag == "a" and "href" in n.attributes]
            internal = sum((n.attributes["href"] or "").strip().startswith("#") for n in links)
            bold = self.tag in ("b", "strong") or ("font-weight" in style and any(b in style for b in _BOLD)) or any(n.tag in ("b", "strong") for n in inner)
            self._seen = clean(self.raw()), internal, sum(len(clean(n.raw())) for n in links), bold
        return self._seen


def _hides(tag: str, attributes: dict[str, str]) -> bool:
    declared = [d.partition(":") for d in (attributes.get("style") or "").lower().split(";")]
    styles = {(p.strip(), v.strip()) for p, _, v in declared}
    return tag in UNSEEN or tag in ("ix:header", "ix:hidden", "hidden") or "hidden" in attributes or ("display", "none") in styles or ("visibility", "hidden") in styles


class Tree(HTMLParser):
    """The tree of a page, from its start and end tags as they come."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {}, False)
        self.open = [self.root]
        self.feed(html)
        self.close()

    def _end(self, tags: frozenset[str] | set[str], stops: frozenset[str] | set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in stops:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        attributes = {k: v or "" for k, v in attrs}
        if tag in ("html", "body"):  # one body, whose attributes count; a repeated one opens nothing
            if tag == "body" and _hides(tag, attributes):
                self.root.hidden = True
            return
        for ended, starts, stops in IMPLIED:
            if tag in starts:
                self._end(ended, stops)
        node = Node(tag, attributes, _hides(tag, attributes))
        self.open[-1].children.append(node)
        if tag not in VOID and len(self.open) < DEEPEST:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if ":" in tag and self.open[-1].tag == tag:  # only elements of XML can be empty so
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        inline = tag not in OWN_BLOCKS | CONTAINERS
        self._end({tag}, OWN_BLOCKS | CONTAINERS if inline and ":" not in tag else {"table"} - {tag} if tag not in CELLS | ROWS | GROUPS else {"table"})

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def _kind(node: Node, text: str) -> str:
    name = " ".join(filter(None, (node.attributes.get(k, "") for k in ("id", "class", "name")))).lower()
    if "footnote" in name or "foot-note" in name:
        return "footnote"
    return "signature" if _SIGNED.match(text) or ("signature" in name and "item" not in text.lower()) else "paragraph"


def rows_of(table: Node) -> list[list[Node]]:
    return [[c for c in tr.elements() if c.tag in CELLS] for tr in table.below() if tr.tag == "tr"]


def _is_layout(table: Node) -> bool:
    """A table that only places other things: it holds a marker of a section, or blocks, or no more than one column."""
    text = table.seen()[0]
    rows = rows_of(table)
    return bool(_MARKER.search(text) or _CLOSING.search(text[:40])) or max(map(len, rows), default=0) <= 1 or any(n.tag in OWN_BLOCKS - {"table", "li", "pre"} for n in table.below())


class Blocks:
    """Ordered blocks of a tree: (parent, type, level, bold, anchor, internal links, link characters, total characters, text)."""

    def __init__(self, root: Node):
        self.out: list[tuple] = []
        if not root.hidden:
            self._container(root, None)

    def _emit(self, kind: str, node: Node, parent: int | None, text: str | None, level: int | None = None) -> int:
        whole, internal, link_chars, bold = node.seen()
        anchor = node.attributes.get("id") or node.attributes.get("name") or None
        self.out.append((parent, kind, level, bold, anchor, internal, link_chars, len(whole), text))
        return len(self.out) - 1

    def _walk(self, node: Node, parent: int | None) -> None:
        if node.hidden:
            return
        if node.tag in HEADINGS or node.tag in ("p", "pre"):
            text = node.seen()[0]
            if text:
                heading = node.tag in HEADINGS
                self._emit("heading" if heading else _kind(node, text), node, parent, text, int(node.tag[1]) if heading else None)
        elif node.tag in ("ul", "ol"):
            self._container(node, self._emit("list", node, parent, None))
        elif node.tag == "li":
            nested = [c for c in node.elements() if c.tag in ("ul", "ol")]
            parts = [c if isinstance(c, str) else " " if c.tag == "br" else c.raw() for c in node.children if not (isinstance(c, Node) and c.tag in ("ul", "ol"))]
            item = self._emit("list_item", node, parent, clean("".join(parts)) or None)
            for n in nested:
                self._walk(n, item)
        elif node.tag == "table" and not _is_layout(node):
            cells = [[clean(c.raw()) for c in row] for row in rows_of(node)]
            text = "\n".join([" | ".join(c) for c in cells if any(c)])
            if text:
                self._emit("table", node, parent, text)
        else:
            self._container(node, parent)

    def _container(self, node: Node, parent: int | None) -> None:
        """Texts between blocks are paragraphs of the container."""
        buffer: list[str] = []

        def flush() -> None:
            text = clean("".join(buffer))
            buffer.clear()
            if text:
                self._emit(_kind(node, text), node, parent, text)

        def inline(n: Node) -> None:
            for c in n.children:
                if isinstance(c, str):
                    buffer.append(c)
                elif c.tag == "br":
                    buffer.append(" ")
                elif c.tag in OWN_BLOCKS or c.tag in CONTAINERS:
                    flush()
                    self._walk(c, parent)
                elif not c.hidden:
                    inline(c)

        inline(node)
        flush()


def _bounded(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session, from before pages go to Python; smaller settings stay."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{key}").rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


BLOCK = "doc_id long, ordinal int, parent_ordinal int, block_type string, heading_level int, is_bold boolean, anchor_id string, internal_links int, link_chars int, total_chars int, text string"


def html_blocks(pages: DataFrame) -> DataFrame:
    """pages(doc_id, html) -> the visible text as ordered blocks with their signals and their list's or item's ordinal, a page by itself.

    A block is a heading, paragraph, footnote, signature, list (without a text of its own), list item or table; a table that only lays out is descended. Null and empty pages, and pages without visible text,
    have none. Rows that repeat a doc_id are pages of their own."""
    _bounded(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
        for b in batches:
            rows = [(doc, i, *block) for doc, html in zip(b.column("doc_id").to_pylist(), b.column("html").to_pylist(), strict=True) if html for i, block in enumerate(Blocks(Tree(html).root).out)]
            cols = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [c.split()[0] for c in BLOCK.split(", ")])

    return pages.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("html").cast("string").alias("html")).mapInArrow(run, BLOCK)


INDEX_ROW = "accession string, place int, sequence string, description string, name string, document_type string, url string"


def index_html_rows(pages: DataFrame, host: str = "https://www.sec.gov") -> DataFrame:
    """pages(accession, base, html) -> the documents that a filing's index page lists: place, sequence, description, name, document_type, url.

    Rows of tables of the class tableFile with four cells or more, of which the third has a link; header rows have other cells and are none. A link with an empty text is named by its address; addresses are
    whole, from the host's root, or else under base. Empty cells are null. Null and empty pages have no rows."""
    _bounded(pages.sparkSession)

    def listed(base: str, html: str) -> Iterator[tuple]:
        for table in Tree(html).root.below():
            if table.tag == "table" and table.attributes.get("class") == "tableFile":
                for tr in (n for n in table.below() if n.tag == "tr"):
                    cells = [c for c in tr.elements() if c.tag == "td"]
                    link = next((n for n in cells[2].below() if n.tag == "a"), None) if len(cells) > 3 else None
                    if link is not None:
                        href = link.attributes.get("href", "")
                        name = clean(link.raw()) or href.rstrip("/").rsplit("/", 1)[-1]
                        url = href if href.startswith("http") else host + href if href.startswith("/") else (base or "") + name
                        yield clean(cells[0].raw()) or None, clean(cells[1].raw()) or None, name, clean(cells[3].raw()) or None, url

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(a, i, *r) for a, base, html in zip(*(b.column(c).to_pylist() for c in ("accession", "base", "html")), strict=True) if html for i, r in enumerate(listed(base, html))]
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 1 else pa.string()) for i, c in enumerate(cols)], [c.split()[0] for c in INDEX_ROW.split(", ")])

    return pages.select(*[F.col(c).cast("string").alias(c) for c in ("accession", "base", "html")]).mapInArrow(run, INDEX_ROW)
