"""HTML extraction: layout-aware rendering of all visible text.

A tree builder reads tags, comments, raw-text elements and entities, closes elements whose end is implied
(p, li, dt/dd, option, table parts) and ignores stray end tags. A renderer walks the tree: invisible
elements (head, script, style, template, hidden, display:none ...) give nothing, formulas, labels of drawings,
options and aria-hidden text are shown, blocks stand
on lines of their own, paragraphs and headings apart by a blank line, lists carry markers and indents,
table cells are padded to aligned columns, pre keeps its white space, other white space collapses and a no-break space becomes a blank.

One narrow map over pages, one page at a time: no shuffle. A null page gives a null text, an empty one an
empty text. Nesting beyond ``DEEPEST`` is flattened (its visible text stays), and nothing recurses, so a page of
a million open tags is read to its end. Repeated rows are rendered alike; an empty table gives none;
extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEEPEST = 400
TAB = "  "

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes object audio video canvas datalist annotation annotation-xml desc metadata".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "header hgroup html legend li main menu nav ol optgroup option p pre search section summary table ul h1 h2 h3 h4 h5 h6 hr caption tr thead tbody tfoot text".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure hr".split())
#: an opening tag on the left closes the nearest open element named on the right, but not across the barriers
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"optgroup", "option"}, {"select"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
CLOSES_P = BLOCK - {"html", "body", "li", "dd", "dt", "caption", "tr", "thead", "tbody", "tfoot", "option", "optgroup", "legend", "text"}
SCOPE = frozenset("td th table caption button html template object".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def parse(page: str) -> Node:
    """The tree of a page: children are nodes and strings."""
    root = Node("#root")
    stack, at, n = [root], 0, len(page)
    lost: list[str] = []  # beyond DEEPEST: an invisible element and what is open in it

    def close(names, barriers) -> None:
        for i in range(len(lost) - 1, -1, -1):
            if lost[i] in names:
                del lost[i:]
                return
            if lost[i] in barriers:
                return
        if lost and any(x.tag in names for x in stack):
            lost.clear()
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in barriers:
                return

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            if not lost:
                stack[-1].children.append(html.unescape(page[at:]))
            break
        if m.start() > at and not lost:
            stack[-1].children.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if m.group(2) is None:
            if m.group().startswith("<![CDATA[") and not lost:
                stack[-1].children.append(m.group()[9:].removesuffix("]]>"))
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if tag == "br":
                stack[-1].children.append(Node("br"))
            else:
                close({tag}, SCOPE - {tag} if tag not in ("table", "html", "body") else frozenset())
            continue
        attrs = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(m.group(3))} if m.group(3).strip(" /\n\t\r") else {}
        if tag in CLOSES_P:
            close({"p"}, SCOPE)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in ("tr", "tbody", "thead", "tfoot"):
            close({"td", "th"}, {"table"})
            if tag != "tr":
                close({"tr"}, {"table"})
            close({"tr"} if tag == "tr" else set(), {"table"})
        node = Node(tag, attrs)
        if not lost:
            stack[-1].children.append(node)
        if tag in VOID or m.group(3).endswith("/") and any(x.tag in ("svg", "math") for x in stack):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            inner = page[at:end.start() if end else n]
            node.children.append(html.unescape(inner) if tag in ("textarea", "title") else inner)
            at = end.end() if end else n
            continue
        if lost:
            lost.append(tag)
        elif len(stack) < DEEPEST:
            stack.append(node)
        elif unseen(node):
            lost.append(tag)
    return root


def unseen(node: Node) -> bool:
    a = node.attrs
    return (node.tag in UNSEEN or "hidden" in a
            or node.tag == "input" or (node.tag == "dialog" and "open" not in a) or bool(INVISIBLE.search(a.get("style", ""))))


class _Lines:
    """Collects text into lines: white space collapses, blank lines between blocks don't add up."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.blank = "", True

    def text(self, s: str) -> None:
        s = SPACE.sub(" ", s)
        if s.startswith(" ") and (not self.line or self.line.endswith(" ")):
            s = s[1:]
        self.line += s

    def end(self) -> None:
        if self.line.strip(" "):
            self.lines.append(self.line.rstrip(" "))
        self.line = ""

    def gap(self) -> None:
        self.end()
        if self.lines and self.lines[-1] != "":
            self.lines.append("")

    def done(self) -> list[str]:
        self.end()
        while self.lines and self.lines[-1] == "":
            self.lines.pop()
        return self.lines


def _width(s: str) -> int:
    return len(s)


def _rows(table: Node) -> tuple[list[list[Node]], list[Node]]:
    """A table's rows of cells, and its captions, not entering nested tables."""
    rows, captions, walk = [], [], [iter(table.children)]
    while walk:
        child = next(walk[-1], None)
        if child is None:
            walk.pop()
        elif isinstance(child, Node) and not unseen(child):
            if child.tag == "tr":
                rows.append([c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th") and not unseen(c)])
            elif child.tag in ("td", "th"):
                rows.append([child])
            elif child.tag == "caption":
                captions.append(child)
            elif child.tag in ("thead", "tbody", "tfoot", "colgroup"):
                walk.append(iter(child.children))
    return rows, captions


def _loose(table: Node) -> list:
    """What a table holds outside its rows and captions (text, and nodes that aren't table parts)."""
    out, walk = [], [iter(table.children)]
    while walk:
        child = next(walk[-1], None)
        if child is None:
            walk.pop()
        elif isinstance(child, str):
            if child.strip():
                out.append(child)
        elif child.tag in ("thead", "tbody", "tfoot", "colgroup"):
            if not unseen(child):
                walk.append(iter(child.children))
        elif child.tag == "tr":
            if not unseen(child):
                out += [c for c in child.children if (c.strip() if isinstance(c, str) else c.tag not in ("td", "th"))]
        elif child.tag not in ("td", "th", "caption", "col"):
            out.append(child)
    return out


def render(root: Node) -> str:
    """All visible text of a tree. Works through explicit frames, never by recursion."""
    # a frame: [node, iterator of children, lines, finish callback or None, list state, pre]
    top = _Lines()
    frames = [[root, iter(root.children), top, None, None, False]]

    def enter(node: Node, lines: _Lines, lists, pre: bool) -> None:
        tag = node.tag
        if unseen(node):
            return
        if tag == "br":
            if lines.line.strip(" "):
                lines.end()
            return
        if tag in ("img", "area"):
            if node.attrs.get("alt", "").strip():
                lines.text(node.attrs["alt"])
            return
        if tag == "hr":
            lines.gap()
            return
        if tag == "table":
            lines.gap()
            rows, captions = _rows(node)
            cells = [[_Lines() for _ in row] for row in rows]
            before = [_Lines() for _ in (*captions, 0)]

            def finish(cells=cells, before=before, lines=lines):
                for b in before:
                    lines.lines += b.done()
                texts = [[c.done() for c in row] for row in cells]
                width: list[int] = []
                for row in texts:
                    for i, cell in enumerate(row):
                        own = max(map(_width, cell), default=0)
                        if i < len(width):
                            width[i] = max(width[i], own)
                        else:
                            width.append(own)
                for row in texts:
                    for k in range(max(map(len, row), default=0)):
                        line = TAB.join((cell[k] if k < len(cell) else "").ljust(width[i]) for i, cell in enumerate(row)).rstrip()
                        if line:
                            lines.lines.append(line)
                lines.gap()

            frames.append([node, iter(()), lines, finish, lists, pre])
            loose = Node("#loose")
            loose.children = _loose(node)
            jobs = [(c, b) for c, b in zip([*captions, loose], before)] + [(c, x) for row, ls in zip(rows, cells) for c, x in zip(row, ls)]
            for n, x in reversed(jobs):
                frames.append([n, iter(n.children), x, None, None, pre])
            return
        if tag in ("ul", "ol", "menu", "dir"):
            outer = lists is not None
            (lines.end if outer else lines.gap)()
            start = node.attrs.get("start", "1")
            state = [tag == "ol", int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0]
            frames.append([node, iter(node.children), lines, (lines.end if outer else lines.gap), state, pre])
            return
        if tag in ("li", "dd", "blockquote"):
            (lines.gap if tag == "blockquote" else lines.end)()
            inner = _Lines()
            if tag == "li":
                if lists is not None and lists[0]:
                    value = node.attrs.get("value", "")
                    lists[1] = int(value) if re.fullmatch(r"-?\d{1,9}", value) else lists[1] + 1
                    mark = f"{lists[1]}. "
                else:
                    mark = "- "
            else:
                mark = "> " if tag == "blockquote" else TAB

            def finish(inner=inner, lines=lines, mark=mark, tag=tag):
                rest = mark if tag == "blockquote" else " " * len(mark)
                for k, s in enumerate(inner.done()):
                    lines.lines.append(((mark if k == 0 else rest) + s).rstrip() if s or tag == "blockquote" else "")
                if tag == "blockquote":
                    lines.gap()

            frames.append([node, iter(node.children), inner, finish, lists if tag == "li" else None, pre])
            if tag == "li":
                frames[-1][4] = [False, 0] if lists is None else lists
            return
        if tag in BLOCK:
            leave = lines.gap if tag in SPACED else lines.end
            leave()
            frames.append([node, iter(node.children), lines, leave, lists, pre or tag == "pre"])
            return
        if tag in ("td", "th"):
            lines.text(" ")
        frames.append([node, iter(node.children), lines, None, lists, pre])

    while frames:
        frame = frames[-1]
        child = next(frame[1], None)
        if child is None:
            frames.pop()
            if frame[3]:
                frame[3]()
        elif isinstance(child, str):
            if frame[5]:
                first, *more = child.replace("\r\n", "\n").split("\n")
                frame[2].line += first
                for s in more:
                    frame[2].lines.append(frame[2].line.rstrip())
                    frame[2].line = s
            else:
                frame[2].text(child)
        else:
            enter(child, frame[2], frame[4], frame[5])
    lines = top.done()
    while lines and lines[0] == "":
        lines.pop(0)
    return "\n".join(lines).replace("\u00a0", " ")


def page_text(page: str) -> str:
    return render(parse(page))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text per page row."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [None if p is None else page_text(p) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"])

    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, text string")
