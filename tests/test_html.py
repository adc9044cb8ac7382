"""HTML tokens against the rules stated in Python."""

import html as stdlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakework.functions import html as HT
from lakework.operators import invoices as I
from tests.conftest import rows

REFERENCES = [
    "&amp;", "&amp", "&lt;b&gt;", "&#160;", "&#xA0;", "&#X41;", "&#65", "&eacute;", "&eacutex", "&notit;", "&notin;", "&not", "&bogus;", "&;", "&", "&&amp;",
    "&#0;", "&#128;", "&#x9F;", "&#129;", "&#1;", "&#11;", "&#127;", "&#xFFFE;", "&#x1FFFF;", "&#xFDD0;", "&#xD800;", "&#x110000;", "&#99999999999999999999;",
    "&#000000000065;", "&#x1F600;", "&#13;", "&CounterClockwiseContourIntegral;", "&fjlig;", "&ampamp;", "&#;", "&#x;", "&a b", "plain", "",
]


def unescaped(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r["u"] for r in df.select("i", HT.unescape(F.col("t")).alias("u")).orderBy("i").collect()]


def test_references(spark):
    texts = REFERENCES + [a + b for a in REFERENCES for b in ("x", ";", "&lt;", " 1")]
    assert unescaped(spark, texts) == [stdlib.unescape(t) for t in texts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.sampled_from("&#x;19aAlmpgtno \n"), max_size=12), min_size=20, max_size=60))
def test_references_fuzz(spark, texts):
    assert unescaped(spark, texts) == [stdlib.unescape(t) for t in texts]


def plain_lines(page):
    """Line breaks at br, at the ends of block elements and in the text; tags out; references replaced; blanks out."""
    text = "".join(
        "\n" if re.match(r"(?i)<(\s*br\s*/?|/\s*(p|tr|td|div|table))\s*>$", t) else "" if re.match("<[^>]+>$", t) else t
        for t in re.findall(r"<[^>]+>|[^<]+|<", page)
    )
    lines = (x.replace("\xa0", " ").strip() for x in re.split(r"[\r\n]", stdlib.unescape(text)))
    return [x for x in lines if x]


PAGES = [
    "<html><body><p>One</p><p> two <b>bold</b>&nbsp;</p>three<br/>four<BR>five< br / >six</td>seven\r\neight</body>",
    "a < b > c <> d <", "<p>&#10;x&#13;y</p>", "", "<br><br>", "no tags &eacute;", "<!-- a > b --> z", "x<td class='q'>y</ TD >z",
]


def test_lines(spark):
    df = spark.createDataFrame(list(enumerate(PAGES)), "i int, html string")
    got = [r["l"] for r in df.select("i", HT.lines(HT.tokens(F.col("html"))).alias("l")).orderBy("i").collect()]
    assert got == [plain_lines(p) for p in PAGES]


def test_elements(spark):
    page = "<title>\n A &amp; <b>B</b>  C</title><H1 class='x'>One</H1><h1>two</h1><h2>open"
    df = spark.createDataFrame([(page,), ("",), ("<title></title>",)], "html string")
    out = df.select(*[HT.element_text(F.col("html"), tag).alias(tag) for tag in ("title", "h1", "h2", "h3")])
    assert [tuple(r) for r in out.collect()] == [("A & B C", "One", None, None), (None,) * 4, (None,) * 4]


def test_label_values(spark):
    emails = [
        ("span", "<td><span>Supplier</span></td><td><span> ACME &amp; Co </span></td>"),
        ("case", "<span class='l'>SUPPLIER  </span><b>x</b><span>ACME</span>"),
        ("line", "<p>Supplier</p><p>ACME</p>"),
        ("nbsp", "<p>Invoice&#160;Date</p><p>Supplier</p><p>&nbsp;ACME&#x2d;1</p>"),
        ("label follows", "<p>Supplier</p><p>Invoice Date</p><p>1/2/2026</p><p>supplier</p><p>ACME</p>"),
        ("blank span", "<span>Supplier</span><br><span> </span><p>Supplier</p><p>ACME</p>"),
        ("none", "<p>Supplier ACME</p>"),
        ("empty", ""),
    ]
    df = spark.createDataFrame(emails, "message_id string, html string")
    got = dict(rows(I.email_fields(df, "v2"), "message_id", "supplier"))
    assert got == {"span": "ACME &amp; Co", "case": "ACME", "line": "ACME", "nbsp": "ACME-1", "label follows": "ACME", "blank span": "ACME", "none": None, "empty": None}
