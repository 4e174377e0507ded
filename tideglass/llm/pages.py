"""Leaf blocks of web pages: the runs of text between block-level tags, with their ancestors."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Element names of HTML.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details
    dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup
    hr html legend li main menu nav noscript ol optgroup option p pre search section select summary
    table tbody td template tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW_TAGS = ("script", "style", "title", "textarea", "iframe")
CLOSES_P = BLOCK_TAGS - {"button", "noscript", "option", "optgroup", "select", "template"}
CLOSES_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
               "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW_TAGS)})\b(?>[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|(?P<text>[^<]+|<)", re.IGNORECASE | re.DOTALL)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_NAME_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    """``path``: (tag, parts of its class, id and role) from the root down; ``linked``: how many
    characters of ``text`` stand in links."""

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: int


def _name_parts(attrs: str) -> tuple[str, ...]:
    if "=" not in attrs:
        return ()
    return tuple(p for value in _NAMES.findall(attrs) for p in _NAME_PART.findall(value.lower()))


def leaf_blocks(html: str | None) -> list[Block]:
    """The blocks of a page in order; white space inside is one space, empty ones are left out.

    Scripts, styles, titles and the like, HTML comments and drawings (``svg``) hold no text; a
    drawing ends at the latest where a block begins. Character references
    are decoded. Missing and stray end tags, unclosed comments and a page cut off anywhere are
    borne. Every text of the page is in exactly one block.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links, drawings, at = 0, 0, 0, None

    def flush() -> None:
        nonlocal linked, at
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, at, linked))
            parts.clear()
        linked, at = 0, None

    def pop(k: int) -> None:
        nonlocal links, drawings
        drawings -= sum(tag == "svg" for tag, _ in stack[k:])
        links -= sum(tag == "a" for tag, _ in stack[k:])
        del stack[k:]

    for m in _TOKEN.finditer(html or ""):
        if text := m["text"]:
            if drawings:
                continue
            if at is None and not text.isspace():
                at = tuple(stack)
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text)
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag in BLOCK_TAGS:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK_TAGS:
            flush()
            if drawings:
                pop(next(k for k, (name, _) in enumerate(stack) if name == "svg"))
            if tag in CLOSES_P:
                _close(stack, ("p",), (), pop)
            if tag in CLOSES_SAME:
                same = ("dt", "dd") if tag in ("dt", "dd") else \
                    ("td", "th") if tag in ("td", "th") else (tag,)
                _close(stack, same, CLOSES_SAME[tag], pop)
        if tag not in VOID_TAGS and not m["attrs"].endswith("/"):
            stack.append((tag, _name_parts(m["attrs"])))
            links += tag == "a"
            drawings += tag == "svg"
    flush()
    return blocks


def _close(stack: list, tags: tuple[str, ...], within: tuple[str, ...], pop) -> None:
    """Ends the innermost open element of ``tags``, looking no further than one of ``within``, or,
    for a paragraph, than the block around it."""
    for k in range(len(stack) - 1, -1, -1):
        tag = stack[k][0]
        if tag in tags:
            pop(k)
            return
        if tag in within or (not within and tag in BLOCK_TAGS):
            return
