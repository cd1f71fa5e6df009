"""The text blocks of an HTML page in page order, with what is known about each.

A block is the text between two block-level tags. Inline tags do not cut it, a line break is white
space. An open paragraph ends at the next block-level tag, list items and table cells at their next
kind. Comments, scripts, styles and other raw elements have no text. A tag cut off at the end of the
page is dropped.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME_WORD = re.compile(r"[a-z]+")

# The block-level tags, and the elements whose content is no text.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog
dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe
label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot
th thead title tr ul""".split())
RAW_TAGS = frozenset("script style noscript template textarea svg".split())
EMPTY_TAGS = frozenset("hr".split())
# What an opening tag ends, if it is open inside the given elements.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}),
         "option": ({"option"}, {"select"})}
_P_HOLDERS = frozenset("body html article section main div td th li button form".split())


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # open elements: tag, words of class, id and role
    linked: float  # share of the characters inside links


def _raw_ends(page: str, tag: str, at: int) -> int:
    end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
    return end.end() if end else len(page)


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links, linked, at = 0, 0, 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            if links:
                linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            joined = " ".join(html.unescape(raw).split())
            if joined:
                out.append(Block(joined, tuple(stack), min(1.0, linked / len(raw))))
            parts.clear()
            linked = 0

    while True:
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            flush()
            return out
        text(page[at:found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if tag in RAW_TAGS:
            if not found["end"] and not found["rest"].endswith("/"):
                at = _raw_ends(page, tag, at)
        elif tag == "a":
            links = max(0, links - 1) if found["end"] else links + 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK_TAGS:
            flush()
            links = 0
            if found["end"]:
                if any(name == tag for name, _ in stack):
                    while stack.pop()[0] != tag:
                        pass
            else:
                _close(stack, tag)
                if tag not in EMPTY_TAGS:
                    stack.append((tag, _names(found["rest"])))


def _close(stack: list, tag: str) -> None:
    """End what the opening tag ends by itself."""
    kinds, inside = _ENDS.get(tag, (frozenset(), frozenset()))
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in kinds:
            del stack[i:]
            break
        if stack[i][0] in inside:
            break
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == "p":
            del stack[i:]
            break
        if stack[i][0] in _P_HOLDERS:
            break


def _names(rest: str) -> tuple[str, ...]:
    if "=" not in rest:
        return ()
    values = [next((v for v in groups if v), "") for groups in _NAMES.findall(rest)]
    return tuple(w for value in values for w in _NAME_WORD.findall(value.lower()))
