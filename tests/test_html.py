import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from docvec.functions import html
from docvec.functions import text as tx


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("1 < 2 & 3 > 2", "1 < 2 & 3 > 2"),
        ("a<p title='x>y'>b</p>c", "a\nb\nc"),
        ("<p title=it's>b'c</p>", "\nb'c\n"),
        ("<a href=x/y?a=\"b>c</a>", "c"),
        ("<a title=\"no end>text", "text"),
        ("x <b and c", "x <b and c"),
        ("x<!-- a > b -->y<!-->z<!--->w<!--c--!>v", "xyzwv"),
        ("x<!-- no end <p>y", "x"),
        ("<!DOCTYPE html><?xml version='1'?>x</>y</ z>w", "xyw"),
        ("<script>if (a < b) '</p>'</script >x<SCRIPT>y</scripts></Script>z", "xz"),
        ("<style>p{}", ""),
        ("<title>a <b> &amp; c</title>d", "\na <b> & c\nd"),
        ("<title>a<p>b", "\na\nb"),
        ("<template><p>x</p></template>y", "y"),
        ("<br/><hr><BR />", "\n\n\n"),
        ("<custom-tag a=1 b>x</custom-tag>", "x"),
        ("&amp;lt; &lt &notit; &notin; &nosuch; &#65;&#x42;&#0;&#xD800;&#x110000;", "&lt; < ¬it; ∉ &nosuch; AB���"),
        ("&#0000000000065;&#" + "9" * 10_000 + ";&#x" + "f" * 10_000 + ";", "A��"),
        ("&AMP;&copy2;&b.alpha;&fjlig;", "&©2;&b.alpha;fj"),
        ("a&am<b>p;", "a&amp;"),
    ],
)
def test_states(page, want):
    assert html.visible(page) == want


class Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in html.BLOCK_TAGS:
            self.found.append("\n")
        self.hidden += tag in html.HIDDEN_TAGS

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in html.BLOCK_TAGS:
            self.found.append("\n")
        self.hidden -= tag in html.HIDDEN_TAGS

    def handle_data(self, data):
        if not self.hidden:
            self.found.append(data)


def test_well_formed_pages_as_the_standard_parser_reads_them(spark, sf):
    r = random.Random(4)
    parts = ["<p>", "</p>", "<b class=\"x > y\">", "</b>", "<br/>", " text ", "é &amp; ", "&#233;", "<!-- c -->", "<script>a<b</script>", "<a href='u'>", "</a>", "<li id=x data-y>", "\n"]
    pages = ["".join(r.choice(parts) for _ in range(30)) for _ in range(300)]
    pages += [p["html"] for p in spark.read.parquet(f"{sf}/pages.parquet").collect() if p["html"]]
    for page in pages:
        parser = Text()
        parser.feed(page)
        parser.close()
        assert html.visible(page) == "".join(parser.found)


@pytest.mark.parametrize(
    "mark", ["<a b ", "<!--", '<a "', "&", "&#", "&#1", "<", "</", "<!", '<a b="', "<a b='>", '<a b="x>y" ', "<x y=' z=\"", "<title>", "<textarea>x", "<p/", "<a =", "&amp", "<script", "\n ", " \n"]
)
def test_a_megabyte_of_any_mark_takes_linear_time(mark):
    page = mark * (1_000_000 // len(mark))
    start = time.perf_counter()
    html.visible(page)
    assert time.perf_counter() - start < 2


def test_bad_pages_in_a_column(spark):
    bad = spark.range(4).select(F.element_at(F.array(F.repeat(F.lit("<a b "), 200_000), F.repeat(F.lit("<!--"), 250_000), F.lit(None), F.lit("<p>x")), (F.col("id") + 1).cast("int")).alias("h"))
    start = time.perf_counter()
    got = [r[0] for r in bad.select(tx.html_to_text(F.col("h"))).collect()]
    assert [None if g is None else len(g) for g in got] == [999_999, 0, None, 1]
    assert time.perf_counter() - start < 15
