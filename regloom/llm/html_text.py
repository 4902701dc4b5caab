"""Visible text of HTML pages, laid out as a reader sees it.

A page's tags and texts are read once by one pattern; a tree builder with
implied end tags, void elements and raw-text elements makes the tree, and a
renderer walks it: hidden parts (scripts, styles, templates, comments, the
``hidden`` attribute, ``display:none``) are left out, everything else is kept,
navigation and advertisements too. Blocks stand on lines of their own,
paragraphs and headings are set apart by an empty line, list items are marked
and indented by depth, table rows are lines whose cells are padded to common
column widths, and preformatted text keeps its white space.

Defined cases: null html gives an empty text; broken markup never fails, and
unknown tags are inline, a tag that nothing closes is text; pages of any length are
rendered whole, without recursion and in time in proportion to it; repeated rows are rendered each; an empty table gives an empty
result; other columns are ignored.
"""
from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
UNSEEN = set("head script style template noscript iframe object title meta link datalist noembed noframes".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
             "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option optgroup p pre search section "
             "select summary table ul xmp".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl pre xmp blockquote table figure".split())
#: Tags that close an open p.
CLOSE_P = BLOCKS - set("body dd dt html legend li option optgroup select".split())
#: Start tag: open elements that it closes, and those at which the search stops.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    **{x: ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for x in ("thead", "tbody", "tfoot")}}
SCOPE = set("table td th caption html template object button marquee applet".split())
#: A quote opens a quoted run only behind "=", as in a browser.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                 r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)"
                 r"(?P<rest>(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*+)(?P<shut>>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


#: Levels of indentation that are shown, and the width to which cells are padded; deeper lists
#: and longer cells keep their text, so output stays in proportion to the page.
DEEPEST, WIDEST = 32, 200


class Node:
    __slots__ = ("name", "attrs", "parts", "level")

    def __init__(self, name: str, attrs: str = ""):
        self.name, self.attrs, self.parts, self.level = name, attrs, [], 0

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "") for m in ATTRIBUTE.finditer(self.attrs)}

    def seen(self) -> bool:
        if self.name in UNSEEN:
            return False
        if not self.attrs.strip():
            return True
        a = self.attributes()
        return not ("hidden" in a or HIDDEN.search(a.get("style", "")) or self.name == "dialog" and "open" not in a
                    or self.name == "input" and a.get("type", "").lower() == "hidden")


def build(page: str) -> Node:
    """Tree of a page. Open elements are a stack; an end tag closes up to its
    element if that is open in the same table cell, and is dropped otherwise."""
    root = Node("#root")
    stack, at = [root], 0
    places: dict[str, list[int]] = {}  # of the open elements of each name, in the stack

    def top(names: set[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def cut(i: int) -> None:
        for node in stack[i:]:
            places[node.name].pop()
        del stack[i:]

    def close(names: set[str], stops: set[str]) -> bool:
        i = top(names)
        if not i or i < top(stops):
            return False
        cut(i)
        return True

    while at < len(page):
        m = TAG.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            stack[-1].parts.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        if not m["name"]:
            continue
        if not m["shut"]:  # nothing behind it closes a tag
            stack[-1].parts.append(html.unescape(page[m.start():]))
            break
        name = m["name"].lower()
        if m["end"]:
            if name == "p" and not places.get("p"):
                stack[-1].parts.append(Node("p"))
            elif name == "br":
                stack[-1].parts.append(Node("br"))
            else:
                close({name}, SCOPE - {name} if name not in ("table", "html", "body") else set())
            continue
        if name in CLOSE_P:
            close({"p"}, SCOPE)
        if name in IMPLIED:
            while close(*IMPLIED[name]):
                pass
        node, parent = Node(name, m["rest"]), stack[-1]
        parent.parts.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\s*/?>", re.I).search(page, at)
            body = page[at:end.start() if end else len(page)]
            if name == "textarea":
                node.parts.append(html.unescape(body))
            elif name == "xmp":
                node.parts.append(body)
            at = end.end() if end else len(page)
        elif name not in VOID:
            head = top({"head"}) if name == "body" else 0
            if head:  # body ends a head that was left open
                parent.parts.pop()
                cut(head)
                stack[-1].parts.append(node)
            places.setdefault(name, []).append(len(stack))
            stack.append(node)
    return root


class Lines:
    """Lines of a block container: words flow, breaks and blocks end lines."""

    def __init__(self):
        self.done: list[str] = []
        self.flow: list[str] = []
        self.gap = False
        self.lead = ""
        self.depth = 0

    def text(self, value: str, kept: bool) -> None:
        if kept:
            first, *more = value.replace("\r\n", "\n").split("\n")
            self.flow.append(first)
            for line in more:
                self.end(kept=True)
                self.flow.append(line)
        else:
            self.flow.append(SPACE.sub(" ", value))

    def end(self, kept: bool = False) -> None:
        line = "".join(self.flow)
        line = line.rstrip() if kept else SPACE.sub(" ", line).strip(" ")
        self.flow = []
        if line or self.lead.strip():
            if self.gap and self.done:
                self.done.append("")
            self.gap = False
            self.done.append(("  " * min(self.depth, DEEPEST) + self.lead + line).rstrip())
            self.lead = ""
        elif kept and self.done:
            self.done.append("")

    def apart(self) -> None:
        self.end()
        self.gap = True


def aligned(rows: list[list[str]]) -> list[str]:
    """Cells padded to the widths of their columns; a cell's lines are joined."""
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            widths[i:i + 1] = [max(len(cell), widths[i] if i < len(widths) else 0)]
    return [" | ".join(c.ljust(min(w, WIDEST)) for c, w in zip(row, widths)).rstrip() for row in rows]


def render(root: Node) -> str:
    """Text of a tree, by a walk with an explicit stack."""
    out = Lines()
    holders: list[tuple] = []  # tables and cells being filled: what goes on outside them
    lists: list[list] = []
    pre = 0
    todo: list[tuple] = [("node", root)]
    while todo:
        what, x = todo.pop()
        if what == "text":
            out.text(x, pre > 0)
        elif what == "node":
            name = x.name
            if name in ("br", "hr", "img", "input"):
                if name == "br":
                    out.end(kept=pre > 0)
                elif name == "hr":
                    out.apart()
                elif x.seen():
                    a = x.attributes()
                    shown = a.get("alt", "") if name == "img" else a.get("value") or a.get("placeholder", "")
                    if shown and a.get("type", "").lower() not in ("checkbox", "radio"):
                        out.text(html.unescape(shown) + " ", False)
                continue
            if not x.seen():
                continue
            todo.append(("leave", x))
            if name in BLOCKS or name in ("tr", "caption"):
                out.apart() if name in SPACED and not (lists and name in ("ul", "ol")) else out.end()
            if name in ("ul", "ol", "menu", "dir"):
                start = x.attributes().get("start", "1") if name == "ol" else ""
                lists.append([name, int(start) if start.isdigit() else 1])
                out.depth += len(lists) > 1
            elif name == "li":
                mark = "- "
                if lists and lists[-1][0] == "ol":
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                out.lead = mark
            elif name == "dd":
                out.depth += 1
            elif name in ("pre", "xmp"):
                pre += 1
            elif name == "table":
                holders.append((out, []))
            elif name == "tr" and holders:
                holders[-1][1].append([])
            elif name in ("td", "th") and holders:
                holders.append((out, None))
                out = Lines()
            for part in reversed(x.parts):
                todo.append(("text" if isinstance(part, str) else "node", part))
        else:
            name = x.name
            if name in ("td", "th") and holders and holders[-1][1] is None:
                out.end()
                cell = " ".join(line.strip() for line in out.done if line.strip())
                out = holders.pop()[0]
                if holders and holders[-1][1] is not None:
                    if not holders[-1][1]:
                        holders[-1][1].append([])
                    holders[-1][1][-1].append(cell)
                    span = x.attributes().get("colspan", "")
                    if span.isdigit():
                        holders[-1][1][-1] += [""] * min(int(span) - 1, 1000)
                else:
                    out.text(cell + " ", False)
            elif name == "table" and holders and holders[-1][1] is not None:
                rows = [r for r in holders.pop()[1] if any(r)]
                out.apart()
                for line in aligned(rows):
                    out.text(line, True)
                    out.end(kept=True)
            if name in ("ul", "ol", "menu", "dir") and lists:
                lists.pop()
                out.end()
                if lists:
                    out.depth = max(out.depth - 1, 0)
            elif name == "dd":
                out.end()
                out.depth = max(out.depth - 1, 0)
            elif name in ("pre", "xmp"):
                pre -= 1
                out.end(kept=True)
            if name in BLOCKS or name in ("tr", "caption"):
                out.apart() if name in SPACED and not lists else out.end()
                if name == "li":
                    out.lead = ""
    out.end()
    return "\n".join(out.done).strip("\n")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_chars, n_lines) of every page."""
    used = pages.select("page_id", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [render(build(h)) if h else "" for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                    names=["page_id", "text", "n_chars", "n_lines"])

    return used.mapInArrow(run, f"page_id {dict(used.dtypes)['page_id']}, text string, n_chars long, n_lines long")
