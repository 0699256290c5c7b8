"""A small reader of HTML: elements as a tree, and the blocks of text they hold."""

from __future__ import annotations

import html
import re

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td "
    "template tfoot th thead title tr ul button textarea script style".split()
)
# A start tag of the first kind ends an open element of the second, unless one of the third lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
# A paragraph ends where one of these starts.
ENDS_P = BLOCK - {"body", "head", "html", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "title", "script", "style", "button", "select", "template", "noscript"}
P_SCOPE = frozenset({"button", "td", "th", "table", "caption", "object", "template"})

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_WORDS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Page:
    """tags, parents (-1 for the root), words (of class, id and role) of the elements in order; blocks as lists of (element, text)."""

    __slots__ = ("tags", "parents", "words", "blocks")

    def __init__(self, text: str):
        self.tags, self.parents, self.words, self.blocks = ["#root"], [-1], [""], []
        self._read(text)

    def _read(self, text: str) -> None:
        tags, parents, words = self.tags, self.parents, self.words
        stack, block, at = [0], [], 0

        def flush() -> None:
            nonlocal block
            if block:
                self.blocks.append(block)
                block = []

        def close(depth: int) -> None:
            if any(tags[n] in BLOCK for n in stack[depth:]):
                flush()
            del stack[depth:]

        for token in iter(lambda: _TOKEN.search(text, at), None):
            if token.start() > at:
                block.append((stack[-1], html.unescape(text[at : token.start()])))
            at = token.end()
            end, start, attributes = token.groups()
            if end:
                end = end.lower()
                for depth in range(len(stack) - 1, 0, -1):
                    if tags[stack[depth]] == end:
                        close(depth)
                        break
                else:
                    if end in BLOCK:
                        flush()
            elif start:
                start = start.lower()
                ends, scope = CLOSES.get(start, ((), ()))
                if start in ENDS_P:
                    ends, scope = {"p", *ends}, P_SCOPE | set(scope)
                for depth in range(len(stack) - 1, 0, -1) if ends else ():
                    if tags[stack[depth]] in scope:
                        break
                    if tags[stack[depth]] in ends:
                        close(depth)
                if start in BLOCK:
                    flush()
                tags.append(start)
                parents.append(stack[-1])
                found = _WORDS.findall(attributes) if attributes and "=" in attributes else ()
                words.append(" ".join([a or b or c for a, b, c in found]).lower() if found else "")
                if start == "br":
                    block.append((stack[-1], " "))
                if start in RAW:
                    shut = re.compile(rf"</{re.escape(start)}\s*[^>]*(?:>|\Z)", re.I).search(text, at)
                    inner = text[at : shut.start() if shut else len(text)]
                    block.append((len(tags) - 1, html.unescape(inner) if start in ("title", "textarea") else inner))
                    flush() if start in BLOCK else None
                    at = shut.end() if shut else len(text)
                elif start not in VOID:
                    stack.append(len(tags) - 1)
            if at >= len(text):
                break
        if at < len(text):
            block.append((stack[-1], html.unescape(text[at:])))
        flush()

    def text(self, keep: list[bool]) -> str:
        """The blocks of kept elements: white space as one space, trimmed, joined by line breaks; empty ones are left out."""
        lines = (" ".join("".join([t for n, t in block if keep[n]]).split()) for block in self.blocks)
        return "\n".join([line for line in lines if line])
