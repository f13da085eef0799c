"""A small document tree of an HTML page: elements, text, and the page's blocks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.DOTALL
)
_MARK = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+|[0-9]+")

# Names from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table tbody tfoot "
    "thead tr ul caption".split()
)
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HEAD = frozenset("base bgsound link meta noscript script style template title".split())
_SCOPE = frozenset("ul ol dl table div article section main body html".split())


@dataclass(slots=True)
class Node:
    tag: str
    marks: str = ""  # class, id, role and itemprop, lower case
    children: list = field(default_factory=list)  # nodes and decoded strings
    holds: bool = False  # whether most of the text of the page's articles is in it

    def names(self) -> list[list[str]]:
        """The words of each class, id, role and itemprop."""
        return [_WORD.findall(token) for token in self.marks.split()]

    def nodes(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]


def parse(html: str) -> Node:
    """The tree of a page; unclosed elements end where their parent or a sibling of their kind does.

    The head ends at the first text or element that cannot be in it. Trees may be of any depth.
    """
    root = Node("html")
    stack, at, end = [root], 0, len(html)
    open_p = 0  # open paragraphs, at least as many as there are

    def end_head() -> None:
        if len(stack) > 1 and stack[1].tag == "head":
            del stack[1:]

    def text(upto: int) -> None:
        if upto > at and (part := html[at:upto]).strip():
            end_head()
            stack[-1].children.append(unescape(part) if "&" in part else part)
        elif upto > at:
            stack[-1].children.append(" ")

    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            text(end)
            break
        text(m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag not in _HEAD:
            end_head()
        if tag in ("html", "body"):
            continue  # the root stands for both
        if tag in BLOCK and open_p:  # a block ends an open paragraph
            open_p = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE:
                    break
        if tag in _CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in _CLOSES[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE:
                    break
        marks = " ".join(v.strip("\"'").lower() for _, v in _MARK.findall(m[3])) if "=" in m[3] else ""
        node = Node(tag, marks)
        stack[-1].children.append(node)
        if tag == "svg" and m[3].endswith("/"):
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, at)
            at = close.end() if close else end
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
            open_p = 1 if tag == "p" else open_p
    return root


def one_line(parts: list[str]) -> str:
    return _SPACE.sub(" ", "".join(parts)).strip()
