"""HTML as a list of tokens: tags, and the texts between them.

One pattern cuts a page into tokens; everything else is a function of that array: the text lines of a page, the
text of an element, the texts of spans.  Character references follow the HTML5 rules for text.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakework.functions.clean import clean

# --- fixed values ------------------------------------------------------------
#: Elements whose end breaks a line; so does every ``br``.
BLOCKS = ("p", "tr", "td", "div", "table")
# -----------------------------------------------------------------------------

#: The common names first: a map is searched from its begin.
_COMMON = ("amp;", "nbsp;", "lt;", "gt;", "quot;", "apos;")
NAMED = {k: html5[k] for k in _COMMON} | html5
#: Numbers 128 to 159 mean what Windows-1252 has there; the five it leaves free mean themselves.
WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}

TOKEN = r"(?s)<[^>]+>|[^<]+|<"
REFERENCE = r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|&|[^&]+"


def _map(pairs: dict[str, str]) -> Column:
    """A constant map; the optimiser reads the text once."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _numbered(digits: Column, base: int) -> Column:
    """The character of a numeric reference; U+FFFD where there is none, nothing where text may not hold it."""
    short = F.regexp_replace(digits, "^0+", "")
    # Nine digits of either base are beyond the last code point.
    n = F.when(F.length(short) > 8, F.lit(0x110000)).otherwise(F.conv(F.concat(F.lit("0"), short), base, 10).cast("bigint"))
    gone = n.between(1, 8) | n.between(0x0B, 0x0B) | n.between(0x0E, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
    return (
        F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("�"))
        .when(n.between(0x80, 0x9F), F.try_element_at(_map({str(k): v for k, v in WINDOWS.items()}), n.cast("string")))
        .when(gone, F.lit(""))
        .otherwise(code_point(n))
    )


def _named(name: Column) -> Column:
    """The text of a named reference; a name without semicolon may run into the text after it."""
    lengths = F.filter(F.sequence(F.length(name) - 1, F.lit(1), F.lit(-1)), lambda k: F.map_contains_key(_map(NAMED), F.substring(name, F.lit(1), k)))
    # An array of one length serves as a local name.
    prefix = F.transform(
        F.slice(lengths, 1, 1), lambda k: F.concat(F.try_element_at(_map(NAMED), F.substring(name, F.lit(1), k)), F.substring(name, k + 1, F.length(name)))
    )
    by_prefix = F.when(F.length(name) > 2, F.get(prefix, F.lit(0)))
    return F.coalesce(F.try_element_at(_map(NAMED), name), by_prefix, F.concat(F.lit("&"), name))


def _reference(t: Column) -> Column:
    digits = F.rtrim(F.substring(t, F.lit(3), F.length(t)), F.lit(";"))
    return (
        F.when(~t.startswith("&") | (t == "&"), t)
        .when(F.lower(F.substring(t, 1, 3)) == "&#x", _numbered(F.substring(digits, F.lit(2), F.length(digits)), 16))
        .when(t.startswith("&#"), _numbered(digits, 10))
        .otherwise(_named(F.substring(t, F.lit(2), F.length(t))))
    )


def unescape(text: Column) -> Column:
    """Character references replaced by what they stand for, each once."""
    parts = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, _reference), "")).otherwise(text)


def tokens(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def is_tag(token: Column) -> Column:
    return token.startswith("<") & (F.length(token) > 1)


def nbsp_clean(c: Column) -> Column:
    """No-break spaces as spaces, ends trimmed."""
    return clean(F.replace(c, F.lit(" "), F.lit(" ")))


def lines(tokens: Column) -> Column:
    """The non-blank text lines of a page: broken at ``br``, at the ends of block elements and at line breaks of the text."""
    breaks = rf"(?i)^<(?:\s*br\s*/?|/\s*(?:{'|'.join(BLOCKS)}))\s*>$"
    text = F.array_join(F.transform(tokens, lambda t: F.when(~is_tag(t), t).when(t.rlike(breaks), "\n").otherwise("")), "")
    # An array of one text serves as a local name: the text is put together once.
    plain = F.get(F.transform(F.array(text), unescape), F.lit(0))
    return F.filter(F.transform(F.split(plain, r"[\r\n]"), nbsp_clean), lambda x: x != "")


def element_text(html: Column, tag: str) -> Column:
    """Text of the first ``<tag>`` element that is closed: inner tags removed, references replaced, whitespace collapsed."""
    inner = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    text = unescape(F.array_join(F.filter(tokens(inner), lambda t: ~is_tag(t)), ""))
    return F.nullif(clean(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(""))


def span_texts(tokens: Column) -> Column:
    """The texts that stand between a tag and the end of a span, in order."""
    texts = F.filter(tokens, lambda t, i: ~is_tag(t) & (i > 0) & F.lower(F.get(tokens, i + 1)).eqNullSafe(F.lit("</span>")))
    return F.when(F.size(tokens) > 1, texts)


def _label(c: Column) -> Column:
    return F.lower(clean(F.regexp_replace(c, r"(?U)\s+", " ")))


def span_labels(spans: Column) -> Column:
    """The texts of spans as they are compared with a label."""
    return F.transform(spans, lambda s: F.lower(F.regexp_replace(s, r"(?U)\s+$", "")))


def line_labels(lines: Column) -> Column:
    """The lines as they are compared with a label."""
    return F.transform(lines, _label)


def label_value(spans: Column, span_labels: Column, lines: Column, line_labels: Column, label: str, known: Sequence[str]) -> Column:
    """The span after the one that is ``label``, else the line after the one that is, unless it is a label too."""
    at = F.array_position(span_labels, F.lit(label.lower()))
    span = F.nullif(nbsp_clean(F.when(at > 0, F.get(spans, at.cast("int")))), F.lit(""))
    names = [k.lower() for k in known]
    after = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(lines) - 1, F.lit(1))),
        lambda i: (F.get(line_labels, i - 1) == label.lower()) & ~F.get(line_labels, i).isin(*names),
    )
    return F.coalesce(span, F.get(lines, F.get(after, F.lit(0))))
