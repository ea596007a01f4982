"""HTML to text by one scan from left to right; it never goes back, so any markup takes linear time."""

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# HTML elements that start a new line of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr title ul".split()
)
# HTML elements whose body is never text, and those whose body is text without tags.
HIDDEN_TAGS = frozenset(("script", "style", "noscript", "template"))
PLAIN_TAGS = frozenset(("title", "textarea"))

# What may be more than a sign of its own.
MARKUP = re.compile(r"<(?:[A-Za-z!?]|/(?s:.))")
# A tag of the usual kind, without quotes, is one match; others go through their attributes.
OPENING = re.compile(r"</?([A-Za-z][^ \t\n\f\r/>]*)")
SIMPLE = re.compile(r"[^>\"']*+>")
ATTRIBUTE = re.compile(r"[ \t\n\f\r/]*+(?:[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+([ \t\n\f\r]*+=[ \t\n\f\r]*+)?+)?+")
UNQUOTED = re.compile(r"[^ \t\n\f\r>]*+")
COMMENT_END = re.compile(r"--!?>")
BODY_END = {tag: re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.I) for tag in HIDDEN_TAGS | PLAIN_TAGS}
# Numbers of characters: zeros in front say nothing, and no character has more than seven digits.
ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])")
TOO_LARGE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{8,});?")


def decoded(text: str) -> str:
    """``text`` with all references to characters decoded once: the longest name that fits, decimal and hexadecimal numbers."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = TOO_LARGE.sub("�", ZEROS.sub(r"&#\1", text))
    return unescape(text)


class Scanner:
    """The states of the scan. ``gone`` holds what was looked for without success: it is not looked for again."""

    def __init__(self, html: str):
        self.html, self.gone = html, set()

    def find(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.gone.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """Where the tag ends whose attributes begin at ``at``; -1 if it does not.

        A quoted value may hold ``>``. A quote that does not close is part of an unquoted value.
        """
        html = self.html
        simple = SIMPLE.match(html, at)
        if simple:
            return simple.end()
        while True:
            found = ATTRIBUTE.match(html, at)
            at = found.end()
            if found[1] is not None:
                quote = html[at : at + 1]
                close = self.find(quote, at + 1) if quote in ("'", '"') else -1
                at = close + 1 if close >= 0 else UNQUOTED.match(html, at).end()
            if at >= len(html):
                return -1
            if html[at] == ">":
                return at + 1

    def comment_end(self, at: int) -> int:
        """Where the comment or declaration ends that begins at ``at``; the end of the page if it does not."""
        html = self.html
        if html.startswith("<!--", at):
            if html.startswith(">", at + 4):
                return at + 5
            if html.startswith("->", at + 4):
                return at + 6
            found = COMMENT_END.search(html, at + 4)
            return found.end() if found else len(html)
        found = self.find(">", at)
        return found + 1 if found >= 0 else len(html)

    def parts(self) -> Iterator[str]:
        """Texts, and a line break for each tag of a block."""
        html, at, n = self.html, 0, len(self.html)
        while found := MARKUP.search(html, at):
            mark = found.start()
            opening = OPENING.match(html, mark)
            if not opening:
                yield decoded(html[at:mark])
                at = self.comment_end(mark)
                continue
            name = opening[1].lower()
            end = self.tag_end(opening.end())
            if end < 0:
                break  # no tag ends behind here: the rest is text
            if mark > at:
                yield decoded(html[at:mark])
            if name in BLOCK_TAGS:
                yield "\n"
            at = end
            if name in BODY_END and html[mark + 1] != "/" and name not in self.gone:
                close = BODY_END[name].search(html, at)
                if close:
                    if name in PLAIN_TAGS:
                        yield decoded(html[at : close.start()])
                    at = close.start()
                elif name in HIDDEN_TAGS:
                    at = n
                else:
                    self.gone.add(name)
        yield decoded(html[at:])


def visible(html: str) -> str:
    """The text of a page, a line break for each tag of a block; blanks and empty lines are kept."""
    return "".join(Scanner(html).parts()) if "<" in html else decoded(html)


def visible_text(html: Column) -> Column:
    """``visible`` of a column; null stays null."""

    @F.arrow_udf("string")
    def scanned(pages: pa.Array) -> pa.Array:
        return pa.array([None if p is None else visible(p) for p in pages.to_pylist()], pa.string())

    return scanned(html)
