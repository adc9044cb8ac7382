
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakework.functions.clean import clean, literal_nulls, to_timestamp_lenient
from lakework.functions.columns import find_col, q, strip_names
from lakework.operators.assignment import SCOPE_PACKAGE_RE, scope_package_columns
from lakework.functions.clean import COMP_SCOPE

# --- fixed values that must equal the reference's -------------------------
DIST_FLOC_NAMES = ("FLOC", "FLOC_ID")
DIST_SCOPE_NAMES = ("SCOPE_ID", "Scope ID")
DIST_REMOVAL_NAMES = ("SCOPE_REMOVAL_DATE", "Scope Removal Date", "Date_Removed", "DATE_REMOVED")
TRANS_REMOVAL_NAMES = ("Date_Removed", "DATE_REMOVED", "SCOPE_REMOVAL_DATE", "Scope Removal Date")
# Helper columns never compared for an update.
HELPER_COLS = ("_key", "_is_active", "_removal_dt", "_scope_id", "_floc", "_visit_no", "_scope_package_slot")
# ---------------------------------------------------------------------------

def _null_ts():
    return F.lit(None).cast("timestamp_ntz")



def _removal(df: DataFrame, names) -> F.Column:
    c = find_col(df.columns, names)
    return to_timestamp_lenient(q(c)) if c else _null_ts()


def keyed_distribution(raw: DataFrame) -> DataFrame:
    """Blank scope → COMP, key ``scope|floc``, active when no removal date parses."""
    df = strip_names(raw)
    floc_c = find_col(df.columns, DIST_FLOC_NAMES)
    scope_c = find_col(df.columns, DIST_SCOPE_NAMES)
    if not floc_c or not scope_c:
        raise ValueError(f"distribution delta: missing FLOC or SCOPE_ID in {df.columns[:50]}")
    rem = _removal(df, DIST_REMOVAL_NAMES)
    out = df.withColumns(
        {
            "_floc": clean(q(floc_c)),
            "_scope_id": F.coalesce(literal_nulls(q(scope_c)), F.lit(COMP_SCOPE)),
            "_removal_dt": rem,
        }
    )
    return out.withColumns(
        {
            "_is_active": F.col("_removal_dt").isNull(),
            "_visit_no": F.lit(None).cast("bigint"),
            "_key": F.concat(F.col("_scope_id"), F.lit("|"), F.col("_floc")),
        }
    )


def keyed_transmission(raw: DataFrame, key_cols: Sequence[str] = ("_scope_id", "_floc")) -> DataFrame:
    """D3: package slots unpivoted (U1) or a SCOPE_ID fallback (U2); blanks dropped; key ``scope|floc``, or of other helper
    columns (``_visit_no`` too, where one scope may stand in several slots; no visit is a blank part)."""
    df = strip_names(raw)
    floc_c = find_col(df.columns, DIST_FLOC_NAMES)
    if not floc_c:
        raise ValueError("transmission delta: missing FLOC/FLOC_ID")
    hits = scope_package_columns(df.columns)
    if hits:
        slots = [c for _, c in hits]
        ids = [c for c in df.columns if c not in slots]
        typed = df.select(*[q(c) for c in ids], *[q(c).cast("string").alias(c) for c in slots])
        out = typed.unpivot([q(c) for c in ids], [q(c) for c in slots], "_scope_package_slot", "_scope_id")
        out = out.withColumn("_scope_id", clean("_scope_id")).filter(
            F.col("_scope_id").isNotNull() & (F.col("_scope_id") != "")
        )
        out = out.withColumn(
            "_visit_no",
            F.regexp_extract("_scope_package_slot", SCOPE_PACKAGE_RE, 1).try_cast("bigint"),
        )
    else:
        scope_c = find_col(df.columns, DIST_SCOPE_NAMES)
        if not scope_c:
            raise ValueError("transmission delta: no Scope Package #N and no SCOPE_ID fallback")
        out = df.withColumn("_scope_id", clean(q(scope_c))).filter(
            F.col("_scope_id").isNotNull() & (F.col("_scope_id") != "")
        )
        out = out.withColumn("_visit_no", F.lit(None).cast("bigint"))
    out = out.withColumns({"_floc": clean(q(floc_c)), "_removal_dt": _removal(out, TRANS_REMOVAL_NAMES)})
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) if c == "_visit_no" else F.col(c) for c in key_cols]
    key = parts[0]
    for part in parts[1:]:
        key = F.concat(key, F.lit("|"), part)
    return out.withColumns({"_is_active": F.col("_removal_dt").isNull(), "_key": key})


def duplicate_keys(df: DataFrame, key: str = "_key", top: int = 10) -> DataFrame:
    """Q4/L3: the most frequent duplicated keys with their counts (top-k report)."""
    return (
        df.groupBy(key)
        .count()
        .filter(F.col("count") > 1)
        .orderBy(F.col("count").desc(), F.col(key).asc_nulls_first())
        .limit(top)
    )


def ensure_unique_keys(df: DataFrame, context: str, key: str = "_key") -> None:
    """Q4: fail with a sample of the worst duplicates (reads at most ten result rows)."""
    sample = duplicate_keys(df, key).collect()
    if sample:
        raise ValueError(f"duplicate delta keys in {context}: { {r[key]: r['count'] for r in sample} }")


def key_delta(prev: DataFrame, cur: DataFrame, *, check_unique: bool = True) -> DataFrame:
    """Classify keys of two keyed snapshots in one full outer join.

    ADDED: ``added_new`` (new and active), ``reactivated`` (inactive → active);
    REMOVED: ``removed_soft`` (active → inactive, current row),
    ``removed_missing_in_current`` (active and gone, previous row);
    UPDATED: ``updated_active`` (active in both, some common non-helper column
    differs).  Keys match null to null.  Output: one row per
    classified key, ``change_set`` and ``_delta_type`` first, then the columns
    of the side the row comes from.
    """
    if check_unique:
        ensure_unique_keys(cur, "CURRENT")
        ensure_unique_keys(prev, "PREVIOUS")
    compare = sorted((set(cur.columns) & set(prev.columns)) - set(HELPER_COLS))
    cols = list(dict.fromkeys([*cur.columns, *[c for c in prev.columns if c not in cur.columns]]))
    # Column by column, null and blank alike; joined texts could agree where columns differ.
    sig = F.array(*[F.coalesce(q(c).cast("string"), F.lit("")) for c in compare]) if compare else F.array().cast("array<string>")

    def side(df: DataFrame, tag: str) -> DataFrame:
        present = [c for c in cols if c in df.columns]
        return df.select(
            F.col("_key").alias(f"{tag}_k"),
            F.col("_is_active").alias(f"{tag}_active"),
            sig.alias(f"{tag}_sig"),
            F.struct(*[q(c) for c in present]).alias(f"{tag}_row"),
            F.lit(True).alias(f"{tag}_in"),
        )

    j = side(cur, "c").join(side(prev, "p"), F.col("c_k").eqNullSafe(F.col("p_k")), "full_outer")
    in_c = F.coalesce(F.col("c_in"), F.lit(False))
    in_p = F.coalesce(F.col("p_in"), F.lit(False))
    ca, pa = F.col("c_active"), F.col("p_active")
    delta_type = (
        F.when(in_c & ~in_p & ca, F.lit("added_new"))
        .when(in_c & in_p & ~pa & ca, F.lit("reactivated"))
        .when(in_c & in_p & pa & ~ca, F.lit("removed_soft"))
        .when(~in_c & in_p & pa, F.lit("removed_missing_in_current"))
        .when(in_c & in_p & pa & ca & (F.col("c_sig") != F.col("p_sig")), F.lit("updated_active"))
    )
    change_set = (
        F.when(F.col("_delta_type").isin("added_new", "reactivated"), F.lit("ADDED"))
        .when(F.col("_delta_type").isin("removed_soft", "removed_missing_in_current"), F.lit("REMOVED"))
        .otherwise(F.lit("UPDATED"))
    )
    classified = j.withColumn("_delta_type", delta_type).filter(F.col("_delta_type").isNotNull())
    from_prev = F.col("_delta_type") == "removed_missing_in_current"
    cur_cols, prev_cols = set(cur.columns), set(prev.columns)

    def pick(c: str):
        cv = F.col("c_row")[c] if c in cur_cols else None
        pv = F.col("p_row")[c] if c in prev_cols else None
        if cv is None:
            return F.when(from_prev, pv)
        if pv is None:
            return F.when(~from_prev, cv)
        return F.when(from_prev, pv).otherwise(cv)

    return classified.select(change_set.alias("change_set"), "_delta_type", *[pick(c).alias(c) for c in cols])


def canonical_key_frame(keyed: DataFrame) -> DataFrame:
    """The minimal canonical frame of a keyed snapshot (floc, scope, removal date, visit)."""
    return keyed.select(
        F.col("_floc").alias("floc"),
        F.col("_scope_id").alias("scope_id"),
        F.col("_removal_dt").alias("scope_removal_date"),
        F.col("_visit_no").alias("visit_no"),
    )
