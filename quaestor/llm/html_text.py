"""HTML extraction: the visible text of a page, laid out as it is shown.

A tree builder reads tags, text and comments, closes what HTML leaves open
(a paragraph before a block, an item before the next, rows and cells), and
drops stray end tags.  Rendering leaves out what is not shown (head, scripts,
styles, templates, ``hidden``, ``display: none``, ``visibility: hidden``, closed
dialogs, titles, descriptions, definitions, metadata and annotations of drawings
and formulas) and emits all other text: blocks on lines of their own, paragraphs and
headings with an empty line between, lists with marks and indents, preformatted
text as it stands, and tables with their cells aligned in columns.

Cases: null and empty pages give an empty text; text outside of any tag is
shown; unfinished tags and comments at the end are dropped like a browser
does; elements nest as deep as they stand; a head that is not closed ends where
anything but head content begins; repeated rows each give their row; an empty
table gives none; a kept column called ``text`` is an error.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from html import unescape
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaestor.llm.common import table

#: Fixed values of the HTML standard: what a head may hold, largest spans.
_IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
MOST_COLUMNS, MOST_ROWS = 1000, 65534

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
_UNSEEN = frozenset("head script style template title noscript iframe object audio video canvas "
                    "datalist noembed noframes".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option "
                   "p pre search section summary table ul".split())
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre table blockquote figure menu".split())
_ENDS_P = (_BLOCK - frozenset("body html option optgroup legend".split())) | {"hr"}
#: Start tags that close an open element, and the elements that keep it open.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)), "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    **{x: (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",))
       for x in ("thead", "tbody", "tfoot")},
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)"
                    r"((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])[^\s>]*+))*+)>)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|(?![\"'])([^\s>]+)))?")
#: Inside drawings and formulas: what is not shown, and what begins a word.
_ASIDE = frozenset("desc defs metadata annotation annotation-xml".split())
_APART = frozenset("text mtr mtd".split())
_HIDING = {("display", "none"), ("visibility", "hidden"), ("visibility", "collapse")}
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def build_tree(html: str) -> Node:
    root = Node("#page", {})
    open_: list[Node] = [root]
    here: Counter = Counter()  # open elements by tag

    def close(tags, stops=()) -> None:
        """Closes up to the nearest open element of ``tags``, unless one of
        ``stops`` stands before it."""
        if not any(here[t] for t in tags):
            return
        for depth in range(len(open_) - 1, 0, -1):
            if open_[depth].tag in tags:
                for x in open_[depth:]:
                    here[x.tag] -= 1
                del open_[depth:]
                return
            if open_[depth].tag in stops:
                return

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            tail = html[at:]
            # a tag that never ends takes the rest with it
            cut = re.search(r"<[a-zA-Z/!?]", tail)
            if open_[-1].tag == "head":
                close(("head",))
            open_[-1].children.append(unescape(tail[:cut.start()] if cut else tail))
            break
        if m.start() > at:
            text = unescape(html[at:m.start()])
            if open_[-1].tag == "head" and not text.isspace():
                close(("head",))
            open_[-1].children.append(text)
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                open_[-1].children.append(Node("br", {}))
            elif tag == "p" and not here["p"]:
                open_[-1].children.append(Node("p", {}))
            else:
                close((tag,), () if tag == "table" else ("table",) if tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else ())
            continue
        if open_[-1].tag == "head" and tag not in _IN_HEAD:
            close(("head",))
        if tag in _ENDS_P:
            close(("p",), ("table", "td", "th", "button", "object", "caption"))
        if tag in _CLOSES:
            tags, stops = _CLOSES[tag]
            while True:
                before = len(open_)
                close(tags, stops)
                if len(open_) == before:
                    break
        node = Node(tag, _attributes(m[3].rstrip("/") if m[3] else ""))
        ended = m[3].endswith("/")
        # a drawing's or formula's own tags have other rules
        if (ended or tag in _ASIDE or tag in _APART) and tag not in ("svg", "math"):
            inside = here["svg"] or here["math"]
            around = next((x.tag for x in reversed(open_) if x.tag in ("svg", "math", "foreignobject")), "") if inside else ""
            ended = ended and around in ("svg", "math")
            if around and tag in _ASIDE:
                node.attributes["hidden"] = ""
            elif around and tag in _APART:
                open_[-1].children.append(" ")
        open_[-1].children.append(node)
        if ended:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(html, at)
            node.children.append(html[at:end.start()] if tag not in ("textarea", "title") else unescape(html[at:end.start()]))
            at = end.end()
        elif tag not in _VOID:
            open_.append(node)
            here[tag] += 1
            if tag == "table" and here[tag] > 100:  # a table is laid out inside its cell
                sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 6 * here[tag]))
    return root


def _shown(node: Node) -> bool:
    a = node.attributes
    if node.tag in _UNSEEN or "hidden" in a or node.tag == "dialog" and "open" not in a:
        return False
    if "style" not in a:
        return True
    said = {}  # the last declaration of a property holds
    for d in re.sub(r"/\*.*?(?:\*/|\Z)", " ", a["style"], flags=re.S).split(";"):
        name, _, value = d.partition(":")
        said[name.strip().lower()] = value.lower().replace("!important", "").strip()
    return not any(said.get(name) == value for name, value in _HIDING)


def _span(text: str, most: int) -> int:
    n = int(text) if text.isdecimal() and text.isascii() else 1
    return min(n, most)


class _Page:
    """Lines as they grow: spaces between words join, blocks start lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.now, self.space, self.gap, self.indent, self.mark = [], False, False, "", ""

    def word(self, text: str) -> None:
        parts = _BLANK.sub(" ", text)
        if parts in ("", " "):
            self.space = self.space or bool(parts)
            return
        if self.now and (self.space or parts[0] == " "):
            self.now.append(" ")
        self.now.append(parts.strip(" "))
        self.space = parts[-1] == " "

    def line(self) -> None:
        if self.now:
            self.put("".join(self.now))
        self.now, self.space = [], False

    def flush_mark(self) -> None:
        """An item without text of its own."""
        if self.mark:
            self.put("")

    def put(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        if self.mark:
            self.lines.append((self.indent[:-len(self.mark)] + self.mark + text).rstrip())
            self.mark = ""
        else:
            self.lines.append((self.indent + text).rstrip())

    def blank(self) -> None:
        self.line()
        self.gap = True


def _table_lines(node: Node) -> list[str]:
    """Rows of the table, every column as wide as its widest cell."""
    rows, captions, todo = [], [], [(c, 0) for c in reversed(node.children)]
    stray, groups = [], 0
    while todo:
        c, group = todo.pop()
        if isinstance(c, str):
            if not c.isspace():
                stray.append(_BLANK.sub(" ", c).strip())
            continue
        if not _shown(c):
            continue
        if c.tag in ("thead", "tbody", "tfoot"):
            groups += 1
            todo.extend((x, groups) for x in reversed(c.children))
        elif c.tag == "tr":
            cells = []
            for d in c.children:
                if isinstance(d, str):
                    if not d.isspace():
                        cells.append((_BLANK.sub(" ", d).strip(), 1, 1))
                elif _shown(d):
                    text = " ".join(x.strip() for x in render(d) if x.strip())
                    down = _span(d.attributes.get("rowspan", "1"), MOST_ROWS)
                    cells.append((text, max(1, _span(d.attributes.get("colspan", "1"), MOST_COLUMNS)), down or MOST_ROWS))
            rows.append((group, cells))
        elif c.tag == "caption":
            captions += render(c)
        elif c.tag not in ("col", "colgroup"):
            stray += render(c)
    placed, widths, below, now = [], [], {}, None
    for group, cells in rows:
        if group != now:  # no cell reaches over its group
            below, now = {}, group
        line, at, begun = [], 0, {}
        for text, span, down in cells:
            while at in below:
                at += 1
            line.append((at, text, span))
            begun.update((x, down) for x in range(at, at + span))
            at += span
            widths += [0] * (at - len(widths))
            if span == 1:
                widths[at - 1] = max(widths[at - 1], len(text))
        below = {x: n - 1 for x, n in {**below, **begun}.items() if n > 1}
        placed.append(line)
    out = [x for x in captions + stray if x]
    for line in placed:
        parts, upto = [], 0
        for at, text, span in line:
            parts += [" " * w for w in widths[upto:at]]  # columns that a cell above holds
            parts.append(text.ljust(sum(widths[at:at + span]) + 3 * (span - 1)))
            upto = at + span
        if any(t for _, t, _ in line):
            out.append(" | ".join(parts).rstrip())
    return out


def render(top: Node) -> list[str]:
    """The lines that ``top`` shows."""
    page = _Page()
    # (node, leaving?, what to restore)
    todo: list[tuple] = [(c, False, None) for c in reversed(top.children)]
    lists: list[list] = []
    pre = top.tag == "pre"
    while todo:
        node, leaving, before = todo.pop()
        if isinstance(node, str):
            if pre:
                first, *more = node.replace("\r\n", "\n").split("\n")
                page.now.append(first)
                for x in more:
                    page.put("".join(page.now))
                    page.now = [x]
            else:
                page.word(node)
            continue
        tag = node.tag
        if leaving:
            if tag == "pre":
                pre = False
                if page.now and not "".join(page.now).strip():
                    page.now = []
            page.line()
            if tag == "li":
                page.flush_mark()
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            if before is not None:
                page.mark, page.indent = "", before
            if tag in _SPACED and not (lists and tag in ("ul", "ol", "menu")):
                page.gap = True
            continue
        if not _shown(node):
            continue
        if tag == "br":
            page.put("".join(page.now)) if page.now or page.mark else page.lines and page.put("")
            page.now, page.space = [], False
        elif tag == "hr":
            page.blank()
        elif tag == "table":
            page.blank()
            for x in _table_lines(node):
                page.put(x)
            page.gap = True
        elif tag == "input":
            if node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                page.word(" " + node.attributes.get("value", "") + " ")
        elif tag in _BLOCK:
            page.line()
            if tag == "li":
                page.flush_mark()
            if tag in _SPACED and not page.mark and not (lists and tag in ("ul", "ol", "menu")):
                page.gap = True
            before = page.indent
            if tag in ("ul", "ol", "menu", "dir"):
                start = node.attributes.get("start", "1")
                lists.append([tag, int(start) if start.isdecimal() else 1])
                before = None
            elif tag == "li":
                if lists and lists[-1][0] == "ol":
                    page.mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                else:
                    page.mark = "- "
                page.indent += " " * len(page.mark)
            elif tag in ("dd", "blockquote"):
                page.indent += "  "
            else:
                before = None
            if tag == "pre" and node.children and isinstance(node.children[0], str):
                node.children[0] = node.children[0].removeprefix("\n")
            pre = pre or tag == "pre"
            todo.append((node, True, before))
            todo.extend((c, False, None) for c in reversed(node.children))
        else:
            if tag in ("td", "th", "tr"):
                page.space = True
            todo.extend((c, False, None) for c in reversed(node.children))
    page.line()
    return page.lines


def visible_text(html: str | None) -> str:
    return "\n".join(render(build_tree(html or ""))).strip("\n")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 500):
            part = b.slice(lo, 500)
            texts = [visible_text(h) for h in part.column(part.num_columns - 1).to_pylist()]
            yield pa.record_batch([*part.columns[:-1], pa.array(texts, pa.string())],
                                  names=[*b.schema.names[:-1], "text"])


def extract(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep`` of every page, and its visible ``text``."""
    if "text" in keep:
        raise ValueError("a kept column has the name of the result: text")
    source = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    return source.mapInArrow(_extract, f"{fields}text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extract(table(spark, sf_dir, "pages"), ["page_id"])
    return text.select("page_id", "text", F.length("text").cast("long").alias("n_chars"))
