"""A page as a tree: block elements, and below them the blocks of text that a reader sees.

Inline elements are seen through; only the share of linked text is kept of them. Text that is
never shown (head, scripts, styles, templates, controls of forms) does not enter the tree.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes select option button textarea datalist object svg math canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr input".split()
)
#: What may stand in a head; any other start tag, and text, ends one.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: What an opening tag closes, if open, up to the elements that stop the search.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table", "thead", "tbody", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "body": (frozenset(["head"]), frozenset()),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAMES = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page(NamedTuple):
    """Nodes in page order, the root first: ``parents`` by number, ``names`` the element (empty for
    a text block), ``words`` tokens of class, id and role, ``texts`` and ``linked`` (characters in
    links) of text blocks, ``marks`` a label given in the page, or None."""

    parents: list[int]
    names: list[str]
    words: list[tuple[str, ...]]
    texts: list[str]
    linked: list[int]
    marks: list[bool | None]


def parse(page: str) -> Page:
    out = Page([-1], ["#root"], [()], [""], [0], [None])
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements and the node each stands for
    hidden = links = 0
    open_names: Counter[str] = Counter()
    held: list[str] = []
    linked = 0

    def add(name: str, tokens: tuple[str, ...], text: str, chars: int, mark) -> int:
        for column, value in zip(out, (stack[-1][1], name, tokens, text, chars, mark)):
            column.append(value)
        return len(out.parents) - 1

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                add("", (), text, min(linked, len(text)), None)
            held, linked = [], 0

    def close(upto: int) -> None:
        nonlocal hidden, links
        while len(stack) > upto:
            name = stack[-1][0]
            if name not in INLINE:
                flush()
            hidden -= name in HIDDEN
            links -= name == "a"
            open_names[name] -= 1
            stack.pop()

    def say(raw: str) -> None:
        nonlocal linked
        if stack[-1][0] == "head" and raw.strip(" \t\n\f\r"):
            close(len(stack) - 1)
        if raw and not hidden:
            text = html.unescape(raw) if "&" in raw else raw
            held.append(text)
            if links:
                linked += len(text)

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        if closing := found[1]:
            name = closing.lower()
            if not open_names[name]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name in INLINE and stack[depth][0] not in INLINE:
                    break  # an inline end tag does not close blocks
            continue
        if not found[2]:
            continue
        name, attributes = found[2].lower(), found[3]
        if stack[-1][0] == "head" and name not in IN_HEAD:
            if name in ("html", "head"):
                continue  # a repeated one is ignored
            close(len(stack) - 1)  # </head> and <body> may be left out
        if name in VOID:
            if name in ("br", "hr", "wbr"):
                held.append(" ") if name == "br" and not hidden else flush() if name == "hr" else None
            continue
        if name not in INLINE:
            flush()
            while len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] in INLINE) and open_names["p"]:
                close(len(stack) - 1)  # a block ends an open paragraph and what is open in it
        if rule := CLOSES.get(name):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in rule[0]:
                    close(depth)
                    break
                if stack[depth][0] in rule[1]:
                    break
        tokens, mark = _described(attributes) if attributes and "=" in attributes else ((), None)
        node = stack[-1][1]
        if name not in INLINE and name not in HIDDEN and not hidden:
            node = add(name, tokens, "", 0, mark)
        if attributes.endswith("/") and name in ("svg", "math"):
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            if stop is None:
                if name in HIDDEN:
                    at = end
                continue
            close_at = page.find(">", stop.end())
            at = end if close_at < 0 else close_at + 1
            continue
        stack.append((name, node))
        open_names[name] += 1
        hidden += name in HIDDEN
        links += name == "a"
    close(1)
    flush()
    return out


def _described(attributes: str) -> tuple[tuple[str, ...], bool | None]:
    tokens, mark = [], None
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = values[0] or values[1] or values[2]
        if name.lower() in ("class", "id", "role", "itemprop"):
            tokens += _NAMES.findall(_CAMEL.sub(" ", value).lower())
        elif name == "data-content":
            mark = value == "1"
    return tuple(dict.fromkeys(tokens)), mark
