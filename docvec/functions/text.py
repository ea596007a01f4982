"""Text columns. Everything here but the scan of HTML stays in the JVM."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docvec.functions import html

# The characters that count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as the body of a regular expression class.
BLANK = r"\t-\r\x1c-\x1f\x85\p{Z}"

# What words are made of, as the body of a class.
WORD = r"\p{L}\p{M}\p{N}\p{Pc}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it uses more than once, with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def replace_chain(text: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def strip(text: Column) -> Column:
    """Text without leading and trailing white space, Unicode spaces included."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column) -> Column:
    """White-space separated words; an all-blank text has none."""
    return F.regexp_extract_all(text, F.lit(f"[^{BLANK}]+"), 0)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{BLANK}]+"))


def file_extension(path: Column) -> Column:
    """Lower-cased extension without its dot; ``unknown`` when there is none.

    A name that only starts with dots has no extension.
    """
    ext = F.regexp_extract(path, r"(?:^|/)\.*[^./][^/]*\.([^./]*)$", 1)
    return F.coalesce(F.nullif(F.lower(ext), F.lit("")), F.lit("unknown"))


def file_stem(path: Column) -> Column:
    """File name without folder and without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=[^.])\.[^.]*$", "")


def flat_name(path: Column) -> Column:
    """A path as one flat file name."""
    return F.translate(path, "/", "_")


def unquote(text: Column) -> Column:
    """Text without the quote marks around it, as in entity tags."""
    return F.btrim(text, F.lit('"'))


def fenced_code(text: Column, language: str = "python") -> Column:
    """Body of the first fenced block of ``language``; null when there is none."""
    body = F.regexp_extract(text, rf"(?s)```{language}\s*(.*?)```", 1)
    return F.nullif(body, F.lit(""))


def cut_words(text: Column, window: int = 750, skip: int = 500) -> Column:
    """A sample of about ``window`` words.

    Short texts are unchanged; long ones lose the first ``skip`` words and everything
    behind the window; those in between keep their last ``window`` words.
    """

    def cut(w: Column) -> Column:
        n = F.size(w)
        return (
            F.when(n <= window, text)
            .when(n >= skip + window, F.array_join(F.slice(w, skip + 1, window), " "))
            .otherwise(F.array_join(F.slice(w, -window, window), " "))
        )

    return let(words(text), cut)


def squeeze(text: Column) -> Column:
    """Runs of blanks become one blank, runs of blank lines one line break; ends trimmed."""
    steps = [(r"[ \t\r\f\x0b\x{a0}]{2,}|[\t\r\f\x0b\x{a0}]", " "), (r" ?\n[ \n]*", "\n")]
    return F.btrim(replace_chain(text, steps), F.lit(" \n"))


def html_to_text(page: Column) -> Column:
    """Readable text of an HTML page: one line per block element, tags and scripts gone."""
    return squeeze(html.visible_text(page))


def markdown_steps() -> list[tuple[str, str]]:
    return [
        (r"(?m)^[ \t]*(?:```|~~~).*$", ""),
        (r"(?m)^[ \t]*(?:[-*_][ \t]*){3,}$", ""),
        (r"(?m)^[ \t]{0,3}#{1,6}[ \t]+", ""),
        (r"(?m)[ \t]+#+[ \t]*$", ""),
        (r"(?m)^[ \t]*>[ \t]?", ""),
        (r"(?m)^[ \t]*(?:[-*+]|[0-9]{1,9}[.)])[ \t]+", ""),
        (r"!\[([^\]]*)\]\([^)]*\)", "$1"),
        (r"\[([^\]]*)\]\([^)]*\)", "$1"),
        # A mark of emphasis opens before and closes behind a character that is no white space.
        (r"\*\*(?!\s)([^*\n]+)(?<!\s)\*\*", "$1"),
        (r"__(?!\s)([^_\n]+)(?<!\s)__", "$1"),
        (r"\*(?!\s)([^*\n]+)(?<!\s)\*", "$1"),
        (r"`([^`\n]+)`", "$1"),
    ]


def markdown_to_text(markdown: Column) -> Column:
    """Text of a Markdown page without headings, emphasis, links, bullets and fences."""
    return squeeze(replace_chain(markdown, markdown_steps()))


def decode_utf8(content: Column) -> Column:
    """Binary content as text, a byte-order mark removed."""
    return F.regexp_replace(F.decode(content, "UTF-8"), r"^\x{FEFF}", "")


def token_count(text: Column) -> Column:
    """Words of letters, marks, digits and connectors of any script, and single other signs; a null text counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[{WORD}]+|[^{WORD}{BLANK}]")), F.lit(0)).cast("bigint")
