"""A page's block tree: elements that matter for layout, and their runs of text.

Scripts, styles, comments and markup give no text.  Inline elements belong to
the run of text around them; a ``br`` counts as white space.  Missing end tags
are handled as browsers do for paragraphs, list items, table cells and
definitions; an unclosed script, style, title, text area or comment ends with the
page, any other unclosed silent element with the block around it.
"""

from __future__ import annotations

import html
import re

ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
#: Silent elements whose content is no markup.
RAW = {"script", "style", "title", "textarea"}
SILENT = {"script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "select", "title"}
NAME = re.compile(r"[a-z]+")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"html", "head", "body", "article", "section", "main", "nav", "aside", "header", "footer", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6",
         "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "form", "fieldset", "blockquote",
         "pre", "figure", "figcaption", "address", "details", "summary", "dialog", "center"}
#: An opening tag closes an open element of these, up to one of the limits.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, {"html"})}


class Node:
    """A block element (``words`` None) or a run of text in one."""

    __slots__ = ("parent", "tag", "names", "text", "linked", "depth")

    def __init__(self, parent: int, tag: str, names: tuple[str, ...], depth: int, text: str | None = None, linked: float = 0.0):
        self.parent, self.tag, self.names, self.depth, self.text, self.linked = parent, tag, names, depth, text, linked


def names_of(attributes: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(attributes)}


def parse(page: str) -> list[Node]:
    """Nodes in page order; a parent comes before its children, node 0 is the root."""
    nodes = [Node(-1, "#root", (), 0)]
    open_tags: list[tuple[str, int]] = [("#root", 0)]  # (tag, its block node)
    run: list[str] = []
    state = {"link": 0, "linked": 0, "all": 0}
    held: dict[str, int] = {}  # open elements by tag, so that what is not open costs no search

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            if text:
                at = open_tags[-1][1]
                nodes.append(Node(at, "#text", (), nodes[at].depth + 1, text, state["linked"] / max(1, state["all"])))
            run.clear()
            state["linked"] = state["all"] = 0

    def say(raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            run.append(text)
            seen = len(text) if not text.isspace() else 0
            state["all"] += seen
            if state["link"]:
                state["linked"] += seen

    def close(i: int) -> None:
        if any(t in BLOCK for t, _ in open_tags[i:]):
            flush()
        for t, _ in open_tags[i:]:
            held[t] -= 1
            state["link"] -= t == "a"
        del open_tags[i:]

    def enter(tag: str, block: int) -> None:
        open_tags.append((tag, block))
        held[tag] = held.get(tag, 0) + 1

    def close_open(tags: set[str], limits: set[str]) -> None:
        if not any(held.get(t) for t in tags):
            return
        for i in range(len(open_tags) - 1, 0, -1):
            if open_tags[i][0] in tags:
                return close(i)
            if open_tags[i][0] in limits:
                return

    at, n, said = 0, len(page), 0
    while (i := page.find("<", at)) >= 0:
        m = TOKEN.match(page, i)
        if not m:
            at = i + 1
            continue
        say(page[said: i])
        at = said = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, ending = tag.lower(), m[1] or m[4]
        if ending:
            if held.get(tag):
                close(next(i for i in range(len(open_tags) - 1, 0, -1) if open_tags[i][0] == tag))
            continue
        if tag in SILENT:
            if not (m[3] or m[6] or "").rstrip().endswith("/") or tag in RAW:
                quiet = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, at)
                if not quiet and tag not in RAW:
                    around = nodes[open_tags[-1][1]].tag
                    end = re.compile(rf"</{re.escape(around)}\s*(?:>|\Z)", re.I).search(page, at)
                    at = said = end.start() if end else n
                else:
                    at = said = quiet.end() if quiet else n
            continue
        if tag == "br":
            run.append(" ")
        if tag in VOID:
            continue
        if tag in BLOCK:
            close_open({"p"}, {"table", "td", "th", "article", "section", "aside", "div", "li", "blockquote", "figure", "body"})
            if tag in CLOSES:
                close_open(*CLOSES[tag])
            flush()
            attributes = names_of(m[3] or m[6]) if m[3] or m[6] else {}
            names = tuple(w for k in ("class", "id", "role") if k in attributes for w in NAME.findall(attributes[k].lower()))
            parent = open_tags[-1][1]
            nodes.append(Node(parent, tag, names, nodes[parent].depth + 1))
            enter(tag, len(nodes) - 1)
        else:
            if tag == "a":
                state["link"] += 1
            enter(tag, open_tags[-1][1])
    say(page[said:])
    flush()
    return nodes
