import datetime as dt

from pyspark.sql import functions as F

from lakework.functions import clean as C


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first()["o"]


def test_trim_unicode_whitespace(spark):
    assert one(spark, C.clean("v"), "\t a b \n") == "a b"
    assert one(spark, C.clean("v"), None) is None


def test_null_tokens(spark):
    for tok in ["", " N/A ", "None", "NULL", "nan", "na"]:
        assert one(spark, C.null_tokens("v"), tok) is None
    assert one(spark, C.null_tokens("v"), " M1 ") == "M1"
    assert one(spark, C.literal_nulls("v"), "NULL") == "NULL"  # case-sensitive set: "", nan, NaT
    assert one(spark, C.literal_nulls("v"), "NaT") is None


def test_scope_or_comp_and_key(spark):
    assert one(spark, C.scope_or_comp("v"), "  ") == "COMP"
    assert one(spark, C.business_key(F.lit("D1"), F.col("v")), None) is None


def test_int_truncates_and_defaults(spark):
    assert one(spark, C.to_int_truncating("v"), "8.9") == 8
    assert one(spark, C.to_int_truncating("v"), "x") == 0
    assert one(spark, C.to_int_truncating("v"), "") == 0
    assert one(spark, C.to_int_truncating("v"), "NaN") == 0
    assert one(spark, C.to_int_truncating("v"), "-Infinity") == 0
    assert one(spark, C.to_int_truncating("v"), "-8.9") == -8


def test_dates(spark):
    assert one(spark, C.to_date_mdy_dash("v"), "1-2-2026") == dt.date(2026, 1, 2)
    assert one(spark, C.to_date_mdy_dash("v"), "13-45-2026") is None
    assert one(spark, C.to_timestamp_survey("v"), "1/13/2026 3:24:51PM") == dt.datetime(2026, 1, 13, 15, 24, 51)
    assert one(spark, C.to_timestamp_lenient("v"), "not a date") is None
    assert one(spark, C.loose_date("v"), "Tuesday, January 13, 2026") == "2026-01-13"
    assert one(spark, C.loose_date("v"), "due 2026-02-03 latest") == "2026-02-03"
    assert one(spark, C.loose_date("v"), "whenever") == "whenever"


def test_money_and_currency(spark):
    assert one(spark, C.number_in_text("v"), "$18,281.04 USD") == 18281.04
    assert one(spark, C.currency_code("v"), "$18,281.04 USD") == "USD"
    assert one(spark, C.currency_code("v", "word"), "USD 12") == "USD"
    assert one(spark, C.digits_or_text("v"), "approx 120 poles") == "120"


def test_folder_parts(spark):
    df = spark.createDataFrame(
        [("D2603-0001_Assets_20260101", "VendorA"), ("nodash_Assets_20260101", "VendorA"),
         ("D1-2_Assets_bad", "VendorA"), ("07-X123", "SCE ESI")],
        "folder string, vendor string",
    )
    p = C.folder_parts("folder", "vendor")
    got = [tuple(r) for r in df.select(p["scope_id"], p["block_id"], p["folder_date"]).collect()]
    assert got == [
        ("D2603", "0001", dt.date(2026, 1, 1)),
        ("nodash", None, dt.date(2026, 1, 1)),
        ("D1", "2", None),
        ("ESI", None, None),
    ]


def test_scope_from_block_and_flags(spark):
    assert one(spark, C.scope_from_block("v"), "D2603-0001") == "D2603"
    assert one(spark, C.scope_from_block("v"), "bad") is None
    assert one(spark, C.to_bool_true_false("v"), "true") is True
    assert one(spark, C.to_bool_true_false("v"), "maybe") is None


def test_priority_pick(spark):
    assert one(spark, C.pick_priority("v"), "ED_POLE;ET_TOWER") == "ET_TOWER"
    assert one(spark, C.pick_priority("v"), "XX;YY") == "XX"
    assert one(spark, C.pick_priority("v"), None) is None


def test_reasons_skip_null_and_false(spark):
    df = spark.createDataFrame([(True, None, True)], "A boolean, B boolean, C boolean")
    assert df.select(C.reasons(["A", "B", "C"])).first()[0] == "A;C"
    df = spark.createDataFrame([(False, None)], "A boolean, B boolean")
    assert df.select(C.reasons(["A", "B"])).first()[0] == ""


def test_row_signature_matches_python(spark):
    import hashlib

    df = spark.createDataFrame([("b", None, 1.5)], "z string, a string, m double")
    got = df.select(C.row_signature(df.columns)).first()[0]
    assert got == hashlib.sha256("|1.5|b".encode()).hexdigest()


def test_clean_column_equals_clean(spark):
    from lakework.functions.clean import WHITESPACE, clean, clean_column

    texts = [None, "", "a", " ", "\n", "é", "aé", "éa", "a b", "a\nb", "a\n", "　a", "a ", "\x85a b\xa0", "~", "!x~", "\x7fa", "a\x00", *[f"{w}x y{w}" for w in WHITESPACE], "x\U0001f600"]
    df = spark.createDataFrame([(t,) for t in texts], "`a t` string")
    assert [tuple(r) for r in df.select(clean("`a t`"), clean_column("a t")).collect() if r[0] != r[1]] == []


def test_plain_dates_equal_the_parser(spark):
    from lakework.functions.clean import _yyyymmdd, clean, to_date_mdy_dash, to_int_truncating

    dates = ["1-2-2001", "01-02-2001", "12-31-1999", "2-29-2000", "2-29-2001", "2-30-2001", "13-45-2001", "0-1-2001", "1-0-2001", "00-01-2001", " 1-2-2001 ",
             "1-2-2001\n", "001-2-2001", "1-2-201", "1-1-0000", "1-1-+2001", "1/2/2001", "-1-2-2001", "a-b-2001", "", None, "1-2-02001", "12-31-9999"]
    days = ["20010102", "20010230", "20011301", "20010100", "00000101", "2001010", "200101021", "bad", "abcdefgh", "2001-1-2", "20000229", " 2001010", "+2001010", "", None]
    df = spark.createDataFrame([(d, y) for d in dates for y in days[:1]] + [(None, y) for y in days], "d string, y string")
    t = clean("d")
    old_d = F.when(F.length(t).between(8, 10), F.to_date(F.try_to_timestamp(t, F.lit("M-d-yyyy"))))
    old_y = F.when(F.length("y") == 8, F.to_date(F.try_to_timestamp(F.col("y"), F.lit("yyyyMMdd"))))
    got = df.select("d", "y", to_date_mdy_dash("d").cast("string"), old_d.cast("string"), _yyyymmdd(F.col("y")).cast("string"), old_y.cast("string")).collect()
    assert [tuple(r) for r in got if r[2] != r[3] or r[4] != r[5]] == []
    numbers = spark.createDataFrame([(x,) for x in ("7.9", " 8 ", "x", "", None, "NaN", "Infinity", "1e3", "0x1p3", "-2.5", "9" * 30)], "n string")
    assert [r[0] for r in numbers.select(to_int_truncating("n")).collect()][:7] == [7, 8, 0, 0, 0, 0, 0]
