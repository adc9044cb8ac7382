
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakework.functions.clean import blank_to_null, clean, to_double, tower_voltage
from lakework.functions.columns import collapse_name_spaces, find_col, q
from lakework.operators.common import bounded_bytes

# --- fixed values that must equal the reference's -------------------------
# Accepted spellings per canonical rate-card column (case-insensitive).
RATE_CARD_ALIASES = {
    "vendor": ("vendor", "contractor", "vendor_name"),
    "billing_bucket": ("billing_bucket", "program", "program_acronym", "bucket"),
    "object_type": ("object_type", "eq_objtype", "eq_obj_type", "object"),
    "voltage": ("voltage", "kv", "kV", "voltage_kv"),
    "unit_price": ("unit_price", "price", "rate", "unit rate", "unit_rate"),
    "uom": ("uom", "unit", "unit_of_measure"),
    "effective_start_date": ("effective_start_date", "start_date", "effective_start"),
    "effective_end_date": ("effective_end_date", "end_date", "effective_end"),
    "priority": ("priority", "rule_priority"),
    "rule_name": ("rule_name", "rule", "rate_name", "pricing_rule"),
}
DEFAULT_UOM = "FLOC"
# Default rule priority: base, plus a step per specified attribute.
PRIORITY_BASE = 10
PRIORITY_STEP = 10
# ---------------------------------------------------------------------------


def rate_card(
    raw: DataFrame,
    *,
    run_date: str,
    run_id: str,
    source_system: str,
    position: Column | None = None,
) -> DataFrame:
    """Canonical rate card.

    vendor, bucket and price are required columns; rows with a null vendor,
    bucket or price are dropped (a blank vendor survives, as in the reference).
    ``rule_pos`` keeps the rule's place in the card for price tie-breaks.
    """
    df = collapse_name_spaces(raw)
    found = {k: find_col(df.columns, v) for k, v in RATE_CARD_ALIASES.items()}
    missing = [k for k in ("vendor", "billing_bucket", "unit_price") if found[k] is None]
    if missing:
        raise ValueError(f"rate card is missing required fields: {missing}")
    null_s = F.lit(None).cast("string")

    def opt(name: str, fn) -> Column:
        return fn(q(found[name])) if found[name] else null_s

    obj = opt("object_type", blank_to_null)
    volt = opt("voltage", blank_to_null)
    if found["priority"]:
        priority = F.coalesce(to_double(q(found["priority"])).try_cast("bigint"), F.lit(0).cast("bigint"))
    else:
        priority = (
            F.lit(PRIORITY_BASE)
            + F.when(obj.isNotNull(), F.lit(PRIORITY_STEP)).otherwise(F.lit(0))
            + F.when(volt.isNotNull(), F.lit(PRIORITY_STEP)).otherwise(F.lit(0))
        ).cast("bigint")
    out = df.select(
        clean(q(found["vendor"])).alias("vendor"),
        clean(q(found["billing_bucket"])).alias("billing_bucket"),
        obj.alias("object_type"),
        volt.alias("voltage"),
        (blank_to_null(q(found["uom"])) if found["uom"] else F.lit(DEFAULT_UOM)).alias("uom"),
        to_double(q(found["unit_price"])).alias("unit_price"),
        opt("effective_start_date", blank_to_null).alias("effective_start_date"),
        opt("effective_end_date", blank_to_null).alias("effective_end_date"),
        priority.alias("priority"),
        opt("rule_name", blank_to_null).alias("rule_name"),
        F.lit(run_date).alias("rate_run_date"),
        F.lit(run_id).alias("rate_run_id"),
        F.lit(source_system).alias("rate_source_system"),
        (position if position is not None else F.lit(0)).alias("rule_pos"),
    )
    return out.dropna(subset=["vendor", "billing_bucket", "unit_price"])


def _rule_index(rules: DataFrame) -> DataFrame:
    """Rate rules folded to one row per (vendor, billing_bucket).

    A rule matches a row when its object type is null or equal, and its
    (tower-only) voltage is null or equal.  Since a rule voltage only counts on
    tower rules, a rule is one of three patterns: generic, by object type, or
    by object type and voltage.  Per pattern we keep the number of priced rules
    and the first non-null price in card order, then nest the patterns in maps
    keyed by object type (and voltage).  The index grows with the card, not
    with the rows to price, and one equi-join replaces the candidate explosion.
    """
    r = rules.select(
        blank_to_null("vendor").alias("vendor"),
        blank_to_null("billing_bucket").alias("billing_bucket"),
        blank_to_null("object_type").alias("r_obj"),
        tower_voltage(blank_to_null("object_type"), blank_to_null("voltage")).alias("r_volt"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("rule_pos"),
    )
    first_price = F.min_by(F.col("unit_price"), F.when(F.col("unit_price").isNotNull(), F.col("rule_pos")))
    per_pattern = r.groupBy("vendor", "billing_bucket", "r_obj", "r_volt").agg(
        F.count("unit_price").alias("n"),
        first_price.alias("p"),
    )
    entry = F.struct(F.col("n"), F.col("p"))
    return per_pattern.groupBy("vendor", "billing_bucket").agg(
        F.sum(F.when(F.col("r_obj").isNull(), F.col("n"))).alias("n_generic"),
        F.max(F.when(F.col("r_obj").isNull(), F.col("p"))).alias("p_generic"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("r_obj").isNotNull() & F.col("r_volt").isNull(), F.struct(F.col("r_obj"), entry)))
        ).alias("by_obj"),
        F.map_from_entries(
            F.collect_list(
                F.when(
                    F.col("r_volt").isNotNull(),
                    F.struct(F.concat(F.col("r_obj"), F.lit("\u0001"), F.col("r_volt")), entry),
                )
            )
        ).alias("by_obj_volt"),
    )


#: Copies of a rule index row, each for a part of the rows that ask for it.
SPREAD = 32


def attach_unit_price(rows: DataFrame, rules: DataFrame, broadcast_max_bytes: int | None = None, spread: int = SPREAD) -> DataFrame:
    """Price every row by the most specific matching rule.

    ``pricing_match_count`` counts matching rules with a price; status is
    NO_MATCH / MATCHED / MULTI_MATCH by that count.  The price is the first
    non-null one by specificity (object type + voltage, then object type, then
    generic), card order inside a level.  Vendor and bucket match null to null.

    Few vendors and buckets share all rows, so the join also runs over a part number: rows take theirs from a hash of
    their own columns, and the rule index, one row per (vendor, bucket), is repeated for each of ``spread`` parts.  A
    bucket that holds half of the rows is thus dealt over ``spread`` keys when the index is not broadcast.  Spark
    broadcasts it by its size estimate or, at run time, by its measured size; ``broadcast_max_bytes`` adds a hint behind a
    measured bound instead, and then nothing is repeated.
    """
    df = rows.withColumns({c: blank_to_null(c) for c in ("vendor", "billing_bucket", "object_type", "voltage")})
    idx = _rule_index(rules).withColumnsRenamed({"vendor": "__r_vendor", "billing_bucket": "__r_bucket"})
    cond = F.col("vendor").eqNullSafe(F.col("__r_vendor")) & F.col("billing_bucket").eqNullSafe(F.col("__r_bucket"))
    if broadcast_max_bytes is not None and bounded_bytes(idx, broadcast_max_bytes):
        j = df.join(F.broadcast(idx), cond, "left")
    else:
        df = df.withColumn("__part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(spread)).cast("int"))
        idx = idx.withColumn("__r_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        j = df.join(idx, cond & (F.col("__part") == F.col("__r_part")), "left").drop("__part", "__r_part")
    volt_j = tower_voltage(F.col("object_type"), F.col("voltage"))
    by_obj = F.when(F.col("object_type").isNotNull(), F.element_at(F.col("by_obj"), F.col("object_type")))
    by_ov = F.when(
        volt_j.isNotNull(),
        F.element_at(F.col("by_obj_volt"), F.concat(F.col("object_type"), F.lit("\u0001"), volt_j)),
    )
    n = (
        F.coalesce(F.col("n_generic"), F.lit(0))
        + F.coalesce(by_obj["n"], F.lit(0))
        + F.coalesce(by_ov["n"], F.lit(0))
    ).cast("int")
    out = j.withColumns(
        {
            "pricing_match_count": n,
            "unit_price": F.coalesce(by_ov["p"], by_obj["p"], F.col("p_generic")),
        }
    ).withColumn(
        "pricing_match_status",
        F.when(F.col("pricing_match_count") == 0, F.lit("NO_MATCH"))
        .when(F.col("pricing_match_count") == 1, F.lit("MATCHED"))
        .otherwise(F.lit("MULTI_MATCH")),
    )
    return out.drop("__r_vendor", "__r_bucket", "n_generic", "p_generic", "by_obj", "by_obj_volt")
