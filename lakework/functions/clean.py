"""

Every function takes and returns a ``Column`` built only from built-in Spark
expressions, so they stay inside whole-stage codegen.  ANSI mode is assumed to
be on: every lenient parse goes through a ``try_*`` function.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -------------------------
# Null tokens for survey exports, compared case-insensitively after trim.
NULLISH_TOKENS = ("", "null", "none", "nan", "na", "n/a")
# Literal null tokens of the release sheets, compared case-sensitively.
LITERAL_NULL_TOKENS = ("", "nan", "NaT")
# Scope id used for a blank distribution scope.
COMP_SCOPE = "COMP"
# Object-type priority for the attribute dimension, best first.
OBJECT_TYPE_PRIORITY = ("EZ_POLE", "ET_TOWER", "ET_POLE", "ED_POLE")
# Vendor whose delivery folders are not parsed, and the scope it gets.
UNPARSED_FOLDER_VENDOR = "SCE ESI"
UNPARSED_FOLDER_SCOPE = "ESI"
# The tower object type: the only one whose voltage counts for pricing.
TOWER_OBJECT_TYPE = "ET_TOWER"
# Lenient timestamp formats tried in order.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "M/d/yyyy h:mm:ssa",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy",
)
# Survey export formats (C15) and loose invoice date formats (C17); weekday names are stripped first.
SURVEY_FORMATS = ("M/d/yyyy h:mm:ssa", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
LOOSE_DATE_FORMATS = ("MMMM d, yyyy", "M/d/yyyy", "M/d/yy", "yyyy-M-d")
# ---------------------------------------------------------------------------

# Characters stripped by ``clean``: every code point Python's ``str.isspace`` accepts.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Text with all Unicode whitespace trimmed at both ends (null stays null).

    ``btrim`` with the explicit set: Spark's ``trim`` strips spaces only, and a
    regex costs about three times as much per row.
    """
    return F.btrim(_c(c).cast("string"), F.lit(WHITESPACE))


def clean_column(name: str) -> Column:
    """C1 for a column of a projection of its own: what ``clean`` gives, in a fraction of the time.

    ``btrim`` looks up both ends of a text in the whole set, so text between two printable ASCII characters is taken as it
    is.  That names the text three times: over a longer expression, or repeated inside one, the generated method would
    outgrow what the JVM compiles.
    """
    s = F.col("`" + name.replace("`", "``") + "`").cast("string")
    return F.when(s.rlike(r"(?s)\A[!-~](?:.*[!-~])?\z"), s).otherwise(F.btrim(s, F.lit(WHITESPACE)))


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, empty → null."""
    return F.nullif(clean(c), F.lit(""))


def null_tokens(c: Column | str, tokens: Sequence[str] = NULLISH_TOKENS, case_sensitive: bool = False, cleaned: bool = False) -> Column:
    """Trimmed text (``cleaned``: it is already), null when it equals one of ``tokens``."""
    t = _c(c) if cleaned else clean(c)
    probe = t if case_sensitive else F.lower(t)
    # One array literal instead of one literal per token: fewer Py4J calls when
    # the plan is built; same three-valued result as ``isin``.
    return F.when(F.array_contains(F.lit(list(tokens)), probe), F.lit(None).cast("string")).otherwise(t)


def literal_nulls(c: Column | str, cleaned: bool = False) -> Column:
    """C4: the release-sheet null tokens (case-sensitive)."""
    return null_tokens(c, LITERAL_NULL_TOKENS, case_sensitive=True, cleaned=cleaned)


def scope_or_comp(c: Column | str, cleaned: bool = False) -> Column:
    """A blank distribution scope id becomes ``COMP``."""
    return F.coalesce(literal_nulls(c, cleaned), F.lit(COMP_SCOPE))


def business_key(scope: Column | str, floc: Column | str) -> Column:
    """``scope|floc``, null when either part is null."""
    return F.concat(_c(scope), F.lit("|"), _c(floc))


def business_key_nonblank(scope: Column | str, floc: Column | str) -> Column:
    """``scope|floc`` only when both parts are non-blank."""
    s, f = _c(scope), _c(floc)
    return F.when((s != "") & (f != ""), F.concat(s, F.lit("|"), f))


def to_double(c: Column | str) -> Column:
    """Lenient number parse, null on failure."""
    return _try_cast(clean(c), "double")


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def to_int_truncating(c: Column | str, default: int = 0) -> Column:
    """Lenient integer that truncates decimals; ``default`` on failure.

    Text such as ``NaN`` or ``Infinity`` parses as a double but has no integer
    value; it, like anything out of the integer range, gets the default (a
    plain cast would fail the query under ANSI mode).
    """
    # A failed number parse costs a Java exception per row, and text without a digit has no integer value.
    d = F.when(_c(c).cast("string").rlike("[0-9]"), _try_cast(blank_to_null(c), "double"))
    return F.coalesce(d.try_cast("bigint"), F.lit(default).cast("bigint"))


def number_in_text(c: Column | str) -> Column:
    """Drop thousands commas, take the first signed decimal number."""
    t = F.regexp_replace(_c(c).cast("string"), ",", "")
    return _try_cast(F.nullif(F.regexp_extract(t, r"(-?\d+(?:\.\d+)?)", 1), F.lit("")), "double")


def currency_code(c: Column | str, mode: str = "trailing") -> Column:
    """C11: currency code: trailing ``[A-Z]{3}`` (v1) or first whole upper-case word (v2)."""
    pattern = r"([A-Z]{3})\s*$" if mode == "trailing" else r"\b([A-Z]{3})\b"
    return F.nullif(F.regexp_extract(_c(c).cast("string"), pattern, 1), F.lit(""))


def digits_or_text(c: Column | str) -> Column:
    """The first run of digits, else the trimmed text (blank → null)."""
    return F.coalesce(F.nullif(F.regexp_extract(_c(c).cast("string"), r"\d+", 0), F.lit("")), blank_to_null(c))


# Shape of the texts each format can parse.  A failed pattern parse costs a
# Java exception per row, so a format is only tried on text of its shape; ISO
# text goes through the exception-free cast parser.
_FORMAT_SHAPES = {
    "M/d/yyyy h:mm:ssa": r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} ?[AaPp][Mm]$",
    "M/d/yyyy H:mm:ss": r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "M/d/yy": r"^\d{1,2}/\d{1,2}/\d{2}$",
    "MMMM d, yyyy": r"^[A-Za-z]+ \d{1,2}, \d{4}$",
}
_ISO_FORMATS = {"yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "yyyy-M-d"}


def _iso_to_ts(t: Column) -> Column:
    # The cast parser reads ISO dates and timestamps (one- or two-digit month
    # and day, optional time) and returns null otherwise, without exceptions.
    return t.try_cast("timestamp_ntz")


def _parse_any(t: Column, formats: Iterable[str]) -> Column:
    parts, iso_done = [], False
    for f in formats:
        if f in _ISO_FORMATS:
            if not iso_done:
                parts.append(_iso_to_ts(t))
                iso_done = True
            continue
        shape = _FORMAT_SHAPES.get(f)
        parsed = F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz")
        parts.append(F.when(t.rlike(shape), parsed) if shape else parsed)
    return F.coalesce(*parts)


def to_timestamp_lenient(c: Column | str, formats: Iterable[str] = TIMESTAMP_FORMATS) -> Column:
    """First format that parses wins; timestamp without time zone."""
    return _parse_any(literal_nulls(c), formats)


def parsed_timestamp(c: Column | str, formats: Iterable[str] = TIMESTAMP_FORMATS) -> Column:
    """C13 on a column that ``literal_nulls`` made."""
    return _parse_any(_c(c), formats)


def to_date_mdy_dash(c: Column | str) -> Column:
    """C14: ``M-d-yyyy`` date (one- or two-digit month and day), null when invalid."""
    s, t = _c(c).cast("string"), clean(c)
    # Text of the plain shape goes to the cast parser, reordered, and a month or day out of range to no parser at all:
    # the pattern parser costs several times as much per row, and an exception for each that it refuses.
    month, day, year = F.substring_index(s, "-", 1), F.substring_index(F.substring_index(s, "-", 2), "-", -1), F.substring_index(s, "-", -1)
    parsed = F.when(F.length(t).between(8, 10), F.to_date(F.try_to_timestamp(t, F.lit("M-d-yyyy"))))
    plain = s.rlike(r"^(0?[1-9]|1[0-2])-(0?[1-9]|[12]\d|3[01])-\d{4}\z")
    return F.when(plain, F.concat_ws("-", year, month, day).try_cast("date")).when(~s.rlike(r"^\d{1,2}-\d{1,2}-\d{4}\z"), parsed)


def to_timestamp_survey(c: Column | str) -> Column:
    """Survey export timestamps (``1/13/2026 3:24:51PM``) or ISO text."""
    return to_timestamp_lenient(c, SURVEY_FORMATS)


def to_iso_date(c: Column | str) -> Column:
    """Date → ``yyyy-MM-dd`` text, null on failure."""
    t = blank_to_null(c)
    return F.date_format(_parse_any(t, TIMESTAMP_FORMATS + LOOSE_DATE_FORMATS), "yyyy-MM-dd")


def loose_date(c: Column | str) -> Column:
    """C17: several formats (weekday stripped), then an embedded ISO date, else the original text."""
    t = blank_to_null(c)
    no_weekday = F.regexp_replace(t, r"(?i)^(monday|tuesday|wednesday|thursday|friday|saturday|sunday),?\s*", "")
    # A bare year or month is no date.
    parsed = F.when(~no_weekday.rlike(r"^\s*\d{4}(-\d{1,2})?\s*$"), _parse_any(no_weekday, LOOSE_DATE_FORMATS))
    embedded = F.nullif(F.regexp_extract(t, r"\b(\d{4}-\d{2}-\d{2})\b", 1), F.lit(""))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), embedded, t)


def to_bool_true_false(c: Column | str) -> Column:
    """``TRUE``/``FALSE`` in any case, else null."""
    u = F.upper(null_tokens(c))
    return F.when(u == "TRUE", F.lit(True)).when(u == "FALSE", F.lit(False))


def false_if_null(c: Column | str) -> Column:
    """Three-valued flag with null read as false."""
    return F.coalesce(_c(c).cast("boolean"), F.lit(False))


def folder_parts(folder: Column | str, vendor: Column | str) -> dict[str, Column]:
    """C20: ``SCOPE-BLOCK_Assets_YYYYMMDD`` → scope_id, block_id, folder_date.

    The special vendor's folders are not parsed: its scope is fixed, block and date null.
    """
    f = _c(folder).cast("string")
    v = _c(vendor).cast("string")
    first_token = F.substring_index(f, "_", 1)
    halves = F.split(first_token, "-", 2)
    special = v == UNPARSED_FOLDER_VENDOR
    return {
        "scope_id": F.when(special, F.lit(UNPARSED_FOLDER_SCOPE)).otherwise(F.substring_index(first_token, "-", 1)),
        "block_id": F.when(special, F.lit(None).cast("string")).otherwise(F.get(halves, 1)),
        "folder_date": F.when(special, F.lit(None).cast("date")).otherwise(
            _yyyymmdd(F.substring_index(f, "_", -1))
        ),
    }


def _yyyymmdd(t: Column) -> Column:
    # As in ``to_date_mdy_dash``: eight digits need no pattern parser.
    plain = t.rlike(r"^\d{4}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])\z")
    iso = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    parsed = F.when(F.length(t) == 8, F.to_date(F.try_to_timestamp(t, F.lit("yyyyMMdd"))))
    return F.when(plain, iso.try_cast("date")).when(~t.rlike(r"^\d{8}\z"), parsed)


def scope_from_block(c: Column | str) -> Column:
    """Scope id = leading ``[A-Z]dddd`` before a dash of a block id."""
    return F.nullif(F.regexp_extract(_c(c).cast("string"), r"^([A-Z]\d{4})-", 1), F.lit(""))


def row_signature(cols: Sequence[str]) -> Column:
    """SHA-256 of the columns sorted by name, as text, null → ``""``, ``|``-joined."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sorted(cols)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def norm_label(c: Column | str) -> Column:
    """Lower-case label with all whitespace (incl. NBSP) collapsed to one space."""
    return F.lower(clean(F.regexp_replace(_c(c).cast("string"), r"(?U)\s+", " ")))


def pick_priority(values: Column | str, priority: Sequence[str] = OBJECT_TYPE_PRIORITY) -> Column:
    """From a ``;``-joined list, the first value in ``priority`` order, else the first element."""
    parts = F.filter(F.transform(F.split(_c(values), ";"), lambda x: clean(x)), lambda x: x != "")
    out = F.get(parts, 0)
    for p in reversed(priority):
        out = F.when(F.array_contains(parts, p), F.lit(p)).otherwise(out)
    return out


def first_of_list(values: Column | str) -> Column:
    """First non-blank element of a ``;``-joined list."""
    parts = F.filter(F.transform(F.split(_c(values), ";"), lambda x: clean(x)), lambda x: x != "")
    return F.get(parts, 0)


def tower_voltage(object_type: Column | str, voltage: Column | str) -> Column:
    """The voltage only counts for tower rows."""
    return F.when(F.coalesce(_c(object_type), F.lit("")) == TOWER_OBJECT_TYPE, _c(voltage))


def reasons(flags: Sequence[str]) -> Column:
    """Names of the flags that are literally true, in order, ``;``-joined; ``""`` if none."""
    return F.concat_ws(";", *[F.when(F.col(f) == F.lit(True), F.lit(f)) for f in flags])


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num/den``, 0.0 when ``den`` is not positive."""
    return F.when(_c(den) > 0, _c(num).cast("double") / _c(den)).otherwise(F.lit(0.0))


def first_truthy(a: Column | str, b: Column | str) -> Column:
    """``a`` unless blank or null, else ``b``."""
    return F.coalesce(F.nullif(_c(a).cast("string"), F.lit("")), _c(b))
