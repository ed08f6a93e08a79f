"""The leaf blocks of an HTML page with what surrounds them. Runs inside tasks."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

# Fixed values of the HTML standard and words that class names commonly use.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
NEVER_TEXT = frozenset("select option button object canvas audio video map datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table".split())
TOLD_TAGS = frozenset(
    "article aside blockquote dd dialog figcaption figure footer form h1 h2 h3 h4 h5 h6 header li main menu nav p pre "
    "section table".split()
)
SILENT_TAGS = frozenset("dd h1 h2 h3 h4 h5 h6 li p pre section table".split())
TOLD_CLASSES = frozenset(
    "ad ads advert advertisement advertising article author banner body breadcrumb breadcrumbs byline comment comments "
    "consent content cookie cookies disclaimer entry footer form gdpr header login main masthead menu meta modal nav "
    "navbar navigation newsletter notice popup post promo recommended related reply replies respond search share "
    "sharing sidebar signup social sponsor sponsored story subscribe tags text toolbar widget".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+")


@dataclass(slots=True)
class Block:
    text: str
    around: frozenset[str]
    nearest: str
    link_share: float


def _told(tag: str, attributes: str) -> list[str]:
    """Names of the tag and its classes that say what it is for."""
    told = [tag] if tag in TOLD_TAGS else []
    if attributes:
        for match in _NAMES.finditer(attributes):
            words = _WORD.findall(match[1] or match[2] or match[3] or "")
            told += ["." + w.lower() for w in words if w.lower() in TOLD_CLASSES]
    return told


def blocks(html: str) -> list[Block]:
    """The non-empty blocks of text in page order, white space within each made one space.

    Every start or end of a block-level element ends a block; a line break
    is white space. Broken markup is read as far as it goes: unknown end
    tags are skipped, open elements end with the page.
    """
    found: list[Block] = []
    # Of each open element: its name, what surrounds its text, the nearest telling element, and two counts.
    stack: list[tuple[str, frozenset[str], str, int, int]] = [("", frozenset(), "", 0, 0)]
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append(Block(text, stack[-1][1], stack[-1][2], min(1.0, linked / len(text))))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1][4]:
            text = unescape(raw)
            pieces.append(text)
            if stack[-1][3]:
                linked += len(text.strip())

    opened: Counter[str] = Counter()

    def close(names: frozenset[str] | set[str], scope: frozenset[str] = frozenset()) -> None:
        if not any(opened[name] for name in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                opened.subtract(entry[0] for entry in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in scope:
                return

    at, end = 0, html.rfind(">")
    while at <= end:
        match = _TAG.search(html, at)
        if match is None:
            break
        add(html[at : match.start()])
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), match[1] or match[4]
        if tag in RAW_TEXT and not closing:
            if not (match[3] or match[6] or "").rstrip().endswith("/"):
                stop = re.compile(f"</{re.escape(tag)}", re.I).search(html, at)
                after = html.find(">", stop.start()) if stop else -1
                at = after + 1 if after >= 0 else len(html)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            flush()
        if closing:
            close({tag})
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS:
            close({"p"})
        if tag in CLOSES:
            close(CLOSES[tag], SCOPES)
        told = _told(tag, match[3] or match[6] or "")
        _, around, nearest, links, hidden = stack[-1]
        nearest = next((t for t in reversed(told) if t not in SILENT_TAGS), nearest)
        around = around.union(told) if told else around
        stack.append((tag, around, nearest, links + (tag == "a"), hidden + (tag in NEVER_TEXT)))
        opened[tag] += 1
    add(html[max(at, 0) :])
    flush()
    return found
