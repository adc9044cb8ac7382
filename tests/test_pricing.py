from lakework.operators import pricing as P
from tests.conftest import rows

RULES = "vendor string, billing_bucket string, object_type string, voltage string, unit_price double, rule_pos long"
ROWS = "id int, vendor string, billing_bucket string, object_type string, voltage string"


def test_price_cases(spark):
    rules = spark.createDataFrame(
        [
            ("VA", "GEN", None, None, 10.0, 1),          # one generic
            ("VA", "SPEC", None, None, 10.0, 2),         # generic + object-specific
            ("VA", "SPEC", "ED_POLE", None, 15.0, 3),
            ("VA", "NULLP", "ED_POLE", None, None, 4),   # specific null price + generic
            ("VA", "NULLP", None, None, 11.0, 5),
            ("VA", "TOW", "ET_TOWER", "66kV", 50.0, 6),  # tower rule with voltage
            ("VA", "VOLT", "ED_POLE", "66kV", 70.0, 7),  # voltage ignored for non-tower rules
            (None, "NV", None, None, 5.0, 8),            # null vendor matches null vendor
        ],
        RULES,
    )
    data = spark.createDataFrame(
        [
            (1, "VB", "GEN", "ED_POLE", None),
            (2, "VA", "GEN", "ED_POLE", None),
            (3, "VA", "SPEC", "ED_POLE", None),
            (4, "VA", "NULLP", "ED_POLE", None),
            (5, "VA", "VOLT", "ED_POLE", "11kV"),
            (6, "VA", "TOW", "ET_TOWER", None),
            (7, None, "NV", None, None),
            (8, "VA", "TOW", "ET_TOWER", "66kV"),
        ],
        ROWS,
    )
    out = P.attach_unit_price(data, rules)
    got = {r[0]: r[1:] for r in rows(out, "id", "pricing_match_status", "pricing_match_count", "unit_price")}
    assert got == {
        1: ("NO_MATCH", 0, None),
        2: ("MATCHED", 1, 10.0),
        3: ("MULTI_MATCH", 2, 15.0),
        4: ("MATCHED", 1, 11.0),
        5: ("MATCHED", 1, 70.0),
        6: ("NO_MATCH", 0, None),
        7: ("MATCHED", 1, 5.0),
        8: ("MATCHED", 1, 50.0),
    }


def test_rate_card_aliases_and_priority(spark):
    raw = spark.createDataFrame(
        [(" VA ", "D360", "ED_POLE", None, "12.5"), (" ", "D360", None, None, "7"), ("VA", None, None, None, "1"), ("VB", "HELO", "", "", "x")],
        "contractor string, program string, object string, kv string, `unit  rate` string",
    )
    out = P.rate_card(raw, run_date="d", run_id="r", source_system="F")
    assert rows(out, "vendor", "billing_bucket", "object_type", "unit_price", "priority", "uom") == [
        ("", "D360", None, 7.0, 10, "FLOC"),
        ("VA", "D360", "ED_POLE", 12.5, 20, "FLOC"),
    ]
