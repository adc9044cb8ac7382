"""Scope assignment: release lines, HELO lines, events, and the current assignment.

to a DataFrame; run values (run date, run id, file name) are plain arguments
so plans stay deterministic.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.functions.clean import business_key, clean, clean_column, literal_nulls, parsed_timestamp, scope_or_comp, to_timestamp_lenient
from lakework.functions.columns import find_col, q, require_col, strip_names
from lakework.operators.common import top1

# --- fixed values that must equal the reference's -------------------------
# Slot columns of a transmission sheet: "Scope Package #N", any case and spacing.
SCOPE_PACKAGE_RE = r"(?i)^Scope Package\s*#\s*(\d+)\s*$"
# Event precedence on equal date and run date (higher wins); others rank 0.
EVENT_PRIORITY = {"move_to_helo": 2, "removal": 1}
# Assignment method precedence (higher wins); others rank 0.
METHOD_PRIORITY = {"HELO": 2, "DRONE": 1}
# Removal-date column spellings, in lookup order.
DIST_REMOVAL_COLS = ("SCOPE_REMOVAL_DATE", "SCOPE_REMOVAL DATE", "Scope Removal Date")
TRANS_REMOVAL_COLS = ("Date_Removed", "DATE_REMOVED", "Date Removed")
# ---------------------------------------------------------------------------

LINE_SCHEMA = T.StructType(
    [
        T.StructField("floc", T.StringType()),
        T.StructField("scope_id", T.StringType()),
        T.StructField("scope_removal_date", T.TimestampNTZType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("visit_no", T.LongType()),
        T.StructField("scope_floc_key", T.StringType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("run_date", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("source_file_saved", T.StringType()),
        T.StructField("source_sheet", T.StringType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("floc", T.StringType()),
        T.StructField("scope_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_effective_date", T.TimestampNTZType()),
        T.StructField("visit_no", T.LongType()),
        T.StructField("scope_floc_key", T.StringType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("run_date", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("source_file_saved", T.StringType()),
        T.StructField("source_sheet", T.StringType()),
    ]
)

def _null_ts():
    return F.lit(None).cast("timestamp_ntz")

def _null_long():
    return F.lit(None).cast("bigint")


def _vendor_col(df: DataFrame, vendor: str | None) -> Column:
    if vendor is not None:
        return F.lit(vendor)
    return clean(q(require_col(df.columns, ["vendor"])))


def _lit(v) -> Column:
    """A run value: a literal, or a per-row column when one sheet holds several runs."""
    return v if isinstance(v, Column) else F.lit(v)


def _meta(df: DataFrame, vendor, run_date, run_id, source_file_saved, source_sheet) -> list[Column]:
    return [
        _vendor_col(df, vendor).alias("vendor"),
        _lit(run_date).cast("string").alias("run_date"),
        _lit(run_id).cast("string").alias("run_id"),
        F.lit(source_file_saved).cast("string").alias("source_file_saved"),
        F.lit(source_sheet).cast("string").alias("source_sheet"),
    ]


def scope_package_columns(columns: Sequence[str]) -> list[tuple[int, str]]:
    """The slot columns and their numbers, ordered by number."""
    hits = []
    for c in columns:
        m = re.match(SCOPE_PACKAGE_RE, c)
        if m:
            hits.append((int(m.group(1)), c))
    return sorted(hits)


def unpivot_scope_packages(df: DataFrame, slot_col: str = "scope_package_slot", value_col: str = "scope_raw") -> DataFrame:
    """One row per non-blank package slot; ``visit_no`` is the slot number.

    Slots are cast to text first (``unpivot`` needs one type).  Blank slots are
    dropped (F3).  Raises when the sheet has no slot columns.
    """
    hits = scope_package_columns(df.columns)
    if not hits:
        raise ValueError("no 'Scope Package #N' columns found to unpivot")
    slots = [c for _, c in hits]
    ids = [c for c in df.columns if c not in slots]
    typed = df.select(*[q(c) for c in ids], *[q(c).cast("string").alias(c) for c in slots])
    long = typed.unpivot([q(c) for c in ids], [q(c) for c in slots], slot_col, value_col)
    return (
        long.withColumn(value_col, clean(F.col(value_col)))
        .filter(F.col(value_col).isNotNull() & (F.col(value_col) != ""))
        .withColumn(
            "visit_no",
            F.regexp_extract(F.col(slot_col), SCOPE_PACKAGE_RE, 1).try_cast("bigint"),
        )
    )


def release_line_distribution(
    raw: DataFrame, *, run_date: str, run_id: str, source_file_saved: str = "", vendor: str | None = None
) -> DataFrame:
    """D4 (distribution): blank scope → COMP, active when the removal date is null or unparseable."""
    df = strip_names(raw)
    c_floc = require_col(df.columns, ["FLOC"])
    c_scope = require_col(df.columns, ["SCOPE_ID"])
    c_rem = find_col(df.columns, ["SCOPE_REMOVAL_DATE"])
    floc = clean(q(c_floc))
    scope = scope_or_comp(q(c_scope))
    removal = to_timestamp_lenient(q(c_rem)) if c_rem else _null_ts()
    return df.select(
        floc.alias("floc"),
        scope.alias("scope_id"),
        removal.alias("scope_removal_date"),
        removal.isNull().alias("is_active"),
        _null_long().alias("visit_no"),
        business_key(scope, floc).alias("scope_floc_key"),
        *_meta(df, vendor, run_date, run_id, source_file_saved, "Distribution"),
    )


def release_line_transmission(
    raw: DataFrame, *, run_date: str, run_id: str, source_file_saved: str = "", vendor: str | None = None
) -> DataFrame:
    """D4 (transmission) with U1: one line per non-blank package slot, no COMP."""
    df = strip_names(raw)
    c_floc = require_col(df.columns, ["FLOC"])
    c_rem = find_col(df.columns, ["Date_Removed"])
    long = unpivot_scope_packages(df)
    floc = clean(q(c_floc))
    scope = F.col("scope_raw")
    removal = to_timestamp_lenient(q(c_rem)) if c_rem else _null_ts()
    return long.select(
        floc.alias("floc"),
        scope.alias("scope_id"),
        removal.alias("scope_removal_date"),
        removal.isNull().alias("is_active"),
        F.col("visit_no"),
        business_key(scope, floc).alias("scope_floc_key"),
        *_meta(long, vendor, run_date, run_id, source_file_saved, "Transmission"),
    )


def _nonblank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def helo_line(
    raw: DataFrame,
    *,
    run_date: str,
    run_id: str,
    source_file_saved: str = "",
    source_sheet: str = "Distribution",
    vendor: str | None = None,
) -> DataFrame:
    """HELO tracker line: always active, null visit, blank keys dropped (never COMP)."""
    df = strip_names(raw)
    floc = clean(q(require_col(df.columns, ["FLOC"])))
    scope = clean(q(require_col(df.columns, ["SCOPE_ID"])))
    return df.select(
        floc.alias("floc"),
        scope.alias("scope_id"),
        _null_ts().alias("scope_removal_date"),
        F.lit(True).alias("is_active"),
        _null_long().alias("visit_no"),
        business_key(scope, floc).alias("scope_floc_key"),
        *_meta(df, vendor, run_date, run_id, source_file_saved, source_sheet),
    ).filter(_nonblank("floc") & _nonblank("scope_id"))


def events_line(
    raw: DataFrame,
    *,
    event_type: str,
    asset_class: str,
    run_date: str,
    run_id: str,
    source_file_saved: str = "",
    vendor: str | None = None,
) -> DataFrame:
    """Removal or move_to_helo events for one asset class.

    Removal needs a parseable effective date and a key (F4); move_to_helo takes
    the run date as its effective date and needs the key only.  Distribution
    blanks become COMP; transmission scopes come from package slots.
    """
    if event_type not in ("removal", "move_to_helo"):
        raise ValueError(f"unknown event type {event_type!r}")
    df = strip_names(raw)
    floc_name = require_col(df.columns, ["FLOC"])
    distribution = asset_class.lower() == "distribution"
    if distribution:
        base = df
        scope = scope_or_comp(q(require_col(df.columns, ["SCOPE_ID", "Scope ID"])))
        visit = _null_long()
        sheet = "Distribution"
    else:
        base = unpivot_scope_packages(df)
        scope = F.col("scope_raw")
        visit = F.col("visit_no")
        sheet = "Transmission"
    if event_type == "removal":
        rem_cols = DIST_REMOVAL_COLS if distribution else TRANS_REMOVAL_COLS
        effective = to_timestamp_lenient(q(require_col(base.columns, rem_cols)))
    else:
        effective = to_timestamp_lenient(_lit(run_date))
    floc = clean(q(floc_name))
    out = base.select(
        floc.alias("floc"),
        scope.alias("scope_id"),
        F.lit(event_type).alias("event_type"),
        effective.alias("event_effective_date"),
        visit.alias("visit_no"),
        business_key(scope, floc).alias("scope_floc_key"),
        *_meta(base, vendor, run_date, run_id, source_file_saved, sheet),
    )
    keep = _nonblank("floc") & _nonblank("scope_id")
    if event_type == "removal":
        keep = keep & F.col("event_effective_date").isNotNull()
    return out.filter(keep)


@dataclass(frozen=True)
class Source:
    """Where lines of one (asset class, method) come from: run and file."""

    run_date: str
    run_id: str
    source_file_saved: str
    source_dataset: str = ""


def _by_kind(sources: dict[tuple[str, str], Source], field: str) -> Column:
    out = F.lit(None).cast("string")
    for (asset_class, method), source in sources.items():
        out = F.when((F.col("asset_class") == asset_class) & (F.col("assignment_method") == method), F.lit(getattr(source, field))).otherwise(out)
    return out


#: What a line says of its sheet; lines of one asset class and method have it in common.
SOURCE_COLS = ("run_date", "run_id", "source_file_saved", "source_sheet", "source_dataset")


def _source_columns(sources: dict[tuple[str, str], Source]) -> dict[str, Column]:
    by_kind = {c: _by_kind(sources, c) for c in ("run_date", "run_id", "source_file_saved", "source_dataset")}
    return by_kind | {"source_sheet": F.col("asset_class")}


def _visits(columns: Sequence[str], distribution: Column, scope: Column) -> Column:
    """U1 as an array of (visit_no, scope): the one scope of a distribution row, else the non-blank package slots (cleaned)."""
    entry = lambda n, c: F.struct(n.cast("bigint").alias("visit_no"), c.alias("scope"))
    slots = [entry(F.lit(n), q(c)) for n, c in scope_package_columns(columns)]
    packages = F.filter(F.array(*slots), lambda e: e["scope"].isNotNull() & (e["scope"] != ""))
    return F.when(distribution, F.array(entry(F.lit(None), scope))).otherwise(packages)


def _vendor(df: DataFrame) -> Column:
    return q(require_col(df.columns, ["vendor"]))


def _cleaned_sheet(df: DataFrame, distribution: Column, scope_names: Sequence[str], date: Callable[[Column], Column] = lambda c: c) -> tuple[DataFrame, Column, Column]:
    """A sheet with its texts cleaned and the text of its date as ``__removal`` (what ``date`` makes of the removal date's);
    and its floc and scope.

    Each step names a text several times, so the steps are projections of their own: one expression over all of them would
    become a method that the JVM does not compile.
    """
    floc, scope = require_col(df.columns, ["FLOC"]), require_col(df.columns, scope_names)
    dates = [require_col(df.columns, DIST_REMOVAL_COLS), require_col(df.columns, TRANS_REMOVAL_COLS)]
    texts = [floc, scope, *dates, require_col(df.columns, ["vendor"]), *[c for _, c in scope_package_columns(df.columns)]]
    df = df.withColumns({c: clean_column(c) for c in dict.fromkeys(texts)})
    df = df.withColumn("__date", F.when(distribution, q(dates[0])).otherwise(q(dates[1])))
    return df.withColumn("__removal", date(literal_nulls("__date", cleaned=True))), q(floc), q(scope)


def assignment_lines(raw: DataFrame, sources: dict[tuple[str, str], Source]) -> DataFrame:
    """D4, D5 and D7 over sheets of all kinds in one pass.

    ``raw`` has asset_class and assignment_method beside the columns of the sheets (vendor, FLOC, SCOPE_ID, the two
    removal dates, package slots); the result is the lines with the columns that D7 adds.
    """
    df = strip_names(raw)
    distribution, helo = F.col("asset_class") == "Distribution", F.col("assignment_method") == "HELO"
    sheet, floc, sheet_scope = _cleaned_sheet(df, distribution, ["SCOPE_ID"])
    scope = F.when(helo, sheet_scope).otherwise(scope_or_comp(sheet_scope, cleaned=True))
    rows = sheet.select(
        "asset_class",
        "assignment_method",
        floc.alias("floc"),
        F.when(~helo, parsed_timestamp("__removal")).alias("scope_removal_date"),
        _vendor(sheet).alias("vendor"),
        F.explode(_visits(df.columns, distribution | helo, scope)).alias("v"),
    )
    active, source = F.col("scope_removal_date").isNull(), _source_columns(sources)
    lines = rows.select(
        "floc",
        F.col("v.scope").alias("scope_id"),
        "scope_removal_date",
        active.alias("is_active"),
        F.col("v.visit_no").alias("visit_no"),
        business_key(F.col("v.scope"), F.col("floc")).alias("scope_floc_key"),
        "vendor",
        *[source[c].alias(c) for c in ("run_date", "run_id", "source_file_saved", "source_sheet")],
        "assignment_method",
        "asset_class",
        source["source_dataset"].alias("source_dataset"),
        (helo | active).alias("base_is_active"),
    )
    return lines.filter(~helo | (_nonblank("floc") & _nonblank("scope_id")))


def event_lines(raw: DataFrame, *, run_date: Column, run_id: Column, source_file_saved: str = "") -> DataFrame:
    """D6 over sheets of both asset classes and all event types in one pass.

    ``raw`` has asset_class and event_type beside the columns of the sheets.  A removal needs a date of its own; every other event, one of an
    unknown type too, takes effect on its run date.
    """
    df = strip_names(raw)
    distribution = F.col("asset_class") == "Distribution"
    is_removal = F.col("event_type") == "removal"
    # An event's date is its removal date or its run date: one text, parsed once.
    sheet, floc, sheet_scope = _cleaned_sheet(df, distribution, ["SCOPE_ID", "Scope ID"], lambda removal: F.when(is_removal, removal).otherwise(literal_nulls(run_date)))
    scope = scope_or_comp(sheet_scope, cleaned=True)
    rows = sheet.select(
        "asset_class",
        "event_type",
        floc.alias("floc"),
        parsed_timestamp("__removal").alias("event_effective_date"),
        _vendor(sheet).alias("vendor"),
        run_date.cast("string").alias("run_date"),
        run_id.cast("string").alias("run_id"),
        F.explode(_visits(df.columns, distribution, scope)).alias("v"),
    )
    lines = rows.select(
        "floc",
        F.col("v.scope").alias("scope_id"),
        "event_type",
        "event_effective_date",
        F.col("v.visit_no").alias("visit_no"),
        business_key(F.col("v.scope"), F.col("floc")).alias("scope_floc_key"),
        "vendor",
        "run_date",
        "run_id",
        F.lit(source_file_saved).alias("source_file_saved"),
        F.col("asset_class").alias("source_sheet"),
    )
    return lines.filter(_nonblank("floc") & _nonblank("scope_id") & (~is_removal | F.col("event_effective_date").isNotNull()))


def _priority(c: str, table: dict[str, int]) -> Column:
    out = F.lit(0)
    for k, v in sorted(table.items(), key=lambda kv: kv[1]):
        out = F.when(F.col(c) == k, F.lit(v)).otherwise(out)
    return out


LATEST_EVENT_COLS = (
    "vendor",
    "scope_floc_key",
    "event_type",
    "event_effective_date",
    "run_date",
    "run_id",
    "source_file_saved",
    "source_sheet",
    "visit_no",
    "scope_id",
    "floc",
)


def latest_events(events: DataFrame) -> DataFrame:
    """The latest event per (vendor, scope_floc_key).

    Newest effective date, then newest run date, then move_to_helo over removal
    over anything else, then run id; all descending with nulls last.  The rest
    of the columns complete the order so ties resolve deterministically.
    """
    cols = [c for c in LATEST_EVENT_COLS if c in events.columns]
    df = events.select(*cols)
    if "event_effective_date" not in df.columns:
        df = df.withColumn("event_effective_date", _null_ts())
    order = [
        F.col("event_effective_date").desc_nulls_last(),
        F.col("run_date").desc_nulls_last(),
        _priority("event_type", EVENT_PRIORITY).desc(),
        F.col("run_id").desc_nulls_last(),
        *_present(df, ["event_type", "source_file_saved", "source_sheet", "visit_no", "scope_id", "floc"]),
    ]
    return top1(df, ["vendor", "scope_floc_key"], order)


def _present(df: DataFrame, names: Sequence[str], desc_nulls_first: Sequence[str] = ()) -> list[Column]:
    """Ascending (nulls last) tie-break terms for the columns that exist."""
    out = []
    for n in names:
        if n in df.columns:
            out.append(F.col(n).desc_nulls_first() if n in desc_nulls_first else F.col(n).asc_nulls_last())
    return out


def prepare_assignments(line: DataFrame, *, method: str, asset_class: str, source_dataset: str) -> DataFrame:
    """Method, asset class, source and ``base_is_active`` (HELO always; DRONE from is_active, default true)."""
    for c in ("floc", "scope_id", "scope_floc_key"):
        if c not in line.columns:
            raise ValueError(f"missing required column {c!r} in {source_dataset}")
    if method == "HELO":
        base = F.lit(True)
    elif "is_active" in line.columns:
        base = F.col("is_active").cast("boolean")
    else:
        base = F.lit(True)
    return line.withColumns(
        {
            "assignment_method": F.lit(method),
            "asset_class": F.lit(asset_class),
            "source_dataset": F.lit(source_dataset),
            "base_is_active": base,
        }
    )


KEY = ("vendor", "scope_floc_key")
CLASS_KEY = ("asset_class", *KEY)


def preferred_assignment(assignments: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """One row per key (vendor, scope_floc_key; with the asset class where a frame holds both), HELO over DRONE.

    The reference sorts on the method alone (ties arbitrary); here the newest
    run, then the remaining columns, make the choice total.
    """
    order = [
        _priority("assignment_method", METHOD_PRIORITY).desc(),
        *[F.col(c).desc_nulls_last() for c in ("run_date", "run_id") if c in assignments.columns],
        *_present(
            assignments,
            ["source_dataset", "visit_no", "scope_removal_date", "source_file_saved", "source_sheet", "floc", "scope_id"],
            desc_nulls_first=["scope_removal_date"],
        ),
    ]
    return top1(assignments, list(keys), order)


def apply_events(assignments: DataFrame, latest: DataFrame | None, keys: Sequence[str] = KEY) -> DataFrame:
    """D8 with J-a: override the base flag by the latest event of the key.

    removal → inactive, REMOVED; move_to_helo → ACTIVE_HELO on a HELO row,
    MOVED_TO_HELO (inactive) on a DRONE row; no event → ACTIVE_HELO /
    ACTIVE_DRONE / INACTIVE from the base flag; any other event type keeps the
    base flag with a null status.  Both sides are one row per
    (vendor, scope_floc_key) and already hash-partitioned on it, so the join
    adds no shuffle.
    """
    if latest is None:
        a = assignments.withColumns({"event_type": F.lit(None).cast("string"), "event_effective_date": _null_ts()})
    else:
        e = latest.select(*keys, "event_type", "event_effective_date")
        a = assignments.join(e, list(keys), "left")
    et = F.col("event_type").cast("string")
    method = F.col("assignment_method")
    base = F.col("base_is_active").cast("boolean")
    is_removal = F.coalesce(et, F.lit("")) == "removal"
    is_move = F.coalesce(et, F.lit("")) == "move_to_helo"
    no_event = et.isNull() | (et == "")
    active = (
        F.when(is_removal, F.lit(False))
        .when(is_move & (method == "HELO"), F.lit(True))
        .when(is_move & (method == "DRONE"), F.lit(False))
        .otherwise(base)
    )
    status = (
        F.when(is_removal, F.lit("REMOVED"))
        .when(is_move & (method == "HELO"), F.lit("ACTIVE_HELO"))
        .when(is_move & (method == "DRONE"), F.lit("MOVED_TO_HELO"))
        .when(no_event & (method == "HELO") & active, F.lit("ACTIVE_HELO"))
        .when(no_event & (method == "DRONE") & active, F.lit("ACTIVE_DRONE"))
        .when(no_event & ~active, F.lit("INACTIVE"))
    )
    return a.withColumns(
        {
            "latest_event_type": et,
            "latest_event_effective_date": F.col("event_effective_date").cast("timestamp_ntz"),
            "is_active_assignment": active,
            "assignment_status": status.cast("string"),
        }
    )


def current_assignment(
    drone_line: DataFrame | None,
    helo_line_df: DataFrame | None,
    latest: DataFrame | None,
    *,
    asset_class: str,
    drone_dataset: str,
    helo_dataset: str,
    gold_run_date: str | None = None,
    gold_run_id: str | None = None,
) -> DataFrame:
    """Current assignment of one asset class: union → W2 → J-a → D8 (+ run columns)."""
    parts = []
    if drone_line is not None:
        parts.append(prepare_assignments(drone_line, method="DRONE", asset_class=asset_class, source_dataset=drone_dataset))
    if helo_line_df is not None:
        parts.append(prepare_assignments(helo_line_df, method="HELO", asset_class=asset_class, source_dataset=helo_dataset))
    if not parts:
        raise ValueError("no assignment lines given")
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    out = apply_events(preferred_assignment(union), latest)
    if gold_run_date is not None:
        out = out.withColumns({"gold_run_date": F.lit(gold_run_date), "gold_run_id": F.lit(gold_run_id)})
    return out


def current_assignments(
    lines: DataFrame, latest: DataFrame, *, gold_run_date: str, gold_run_id: str, sources: dict[tuple[str, str], Source] | None = None
) -> DataFrame:
    """D9 for both asset classes at once, from lines that ``assignment_lines`` made.

    Everything is keyed by (asset_class, vendor, scope_floc_key): the lines are shuffled once, for W2, and the joins that
    follow find them in place.  An event counts for both classes, so each latest event stands for each class.

    With ``sources``, those the lines were made with, what a line says of its sheet is not carried through the shuffle and
    the sorts but found again from its class and method.  It then never decides between two lines: of one key, those of equal
    rank are of one method.
    """
    methods = {method for _, method in sources or {}}
    found_again = bool(methods) and methods <= METHOD_PRIORITY.keys()
    columns = lines.columns
    if found_again:
        lines = lines.drop(*SOURCE_COLS)
    classes = F.explode(F.array(F.lit("Distribution"), F.lit("Transmission"))).alias("asset_class")
    events = latest.select(classes, *KEY, "event_type", "event_effective_date")
    chosen = preferred_assignment(lines, CLASS_KEY)
    if found_again:
        chosen = chosen.withColumns(_source_columns(sources)).select(*columns)
    out = apply_events(chosen, events, CLASS_KEY)
    return out.withColumns({"gold_run_date": F.lit(gold_run_date), "gold_run_id": F.lit(gold_run_id)})
