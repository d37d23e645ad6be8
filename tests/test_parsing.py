import datetime as dt

import pytest
from pyspark.sql import functions as F

from predial.functions import parsing, rules

# text, strict integer, integer through a double, number
NUMBERS = [
    ("12", 12, 12, 12.0),
    (" 12 ", 12, 12, 12.0),
    ("\t12", 12, 12, 12.0),
    ("12.0", None, 12, 12.0),
    ("12.7", None, 12, 12.7),
    ("-0.4", None, 0, -0.4),
    ("1e3", None, 1000, 1000.0),
    ("1d", None, 1, 1.0),
    ("0x1p3", None, 8, 8.0),
    ("NaN", None, None, None),
    ("Infinity", None, None, None),
    ("-Infinity", None, None, None),
    ("99999999999", None, None, 99999999999.0),
    ("007", 7, 7, 7.0),
    ("", None, None, None),
    ("abc", None, None, None),
    ("inf", None, None, None),
    ("+Infinity", None, None, None),
    ("+5", 5, 5, 5.0),
    ("-5", -5, -5, -5.0),
    (".5", None, 0, 0.5),
    ("\n8\t", 8, 8, 8.0),
    ("2147483647", 2147483647, 2147483647, 2147483647.0),
    ("2147483648", None, None, 2147483648.0),
    ("2147483647.5", None, 2147483647, 2147483647.5),
    ("-2147483648", -2147483648, -2147483648, -2147483648.0),
    ("-2147483649", None, None, -2147483649.0),
    ("1e400", None, None, None),
    ("$5", None, None, None),
    ("5 5", None, None, None),
    (None, None, None, None),
]

DATES = [
    ("20030721", dt.date(2003, 7, 21)),
    (" 20030721 ", dt.date(2003, 7, 21)),
    ("19490101", dt.date(1949, 1, 1)),
    ("2003-07-21", None),
    ("20030230", None),
    ("2003721", None),
    ("200307211", None),
    ("00000000", None),
    ("", None),
    (None, None),
]


def test_numbers(spark):
    df = spark.createDataFrame([(n, r[0]) for n, r in enumerate(NUMBERS)], "n int, t string")
    found = df.select(
        "n", parsing.to_int("t", strict=True), parsing.to_int("t"), parsing.to_number("t")
    ).orderBy("n").collect()
    assert [tuple(r)[1:] for r in found] == [r[1:] for r in NUMBERS]


def test_guarded_reading_equals_plain_try_functions(spark):
    """The conditions in front of the casts must not change a single result."""
    parts = ["", " ", "\t", "+", "-", "1", "12.7", "e3", "d", "0x1p3", "Infinity", "NaN", "x", "9" * 11, "é"]
    texts = [a + b + c for a in parts for b in parts for c in parts]
    df = spark.createDataFrame([(t,) for t in texts], "t string").distinct()
    trim = F.trim("t")
    number = trim.try_cast("double")
    plain = {
        "int": (number.try_cast("int"), parsing.to_int("t")),
        "strict": (trim.try_cast("int"), parsing.to_int("t", strict=True)),
        "number": (F.when(F.abs(number) < float("inf"), number), parsing.to_number("t")),
    }
    for name, (expected, found) in plain.items():
        wrong = df.filter(~expected.eqNullSafe(found)).select("t", expected, found)
        assert wrong.collect() == [], name


@pytest.mark.parametrize("pattern", ["yyyyMMdd", "yyyy-MM-dd", "d/M/yyyy"])
def test_guarded_dates_equal_plain_try_to_timestamp(spark, pattern):
    parts = ["", " ", "+", "-", "2003", "02", "07", "21", "30", "7", "/", "-", "x", "1", "00"]
    texts = {a + b + c + d + e for a in parts for b in parts for c in parts
             for d in ("07", "-07-", "7", "/", "") for e in ("21", "30", "2003", " ", "x")}
    # Spark itself fails on signed years of many digits.
    endless = {t for t in texts if t.strip()[:1] in ("+", "-") and len(t.strip()) > len(pattern) + 2}
    far = spark.createDataFrame([(t,) for t in endless], "t string")
    if pattern != "d/M/yyyy":
        assert far.filter(parsing.to_date("t", pattern).isNotNull()).isEmpty()
    df = spark.createDataFrame([(t,) for t in texts - endless], "t string")
    expected = F.try_to_timestamp(F.trim("t"), F.lit(pattern)).cast("date")
    found = parsing.to_date("t", pattern)
    wrong = df.filter(~expected.eqNullSafe(found)).select("t", expected.cast("string"))
    assert wrong.collect() == []
    assert not df.filter(found.isNotNull()).isEmpty()


def test_dates(spark):
    df = spark.createDataFrame([(n, r[0]) for n, r in enumerate(DATES)], "n int, t string")
    found = df.select("n", parsing.to_date("t", "yyyyMMdd")).orderBy("n").collect()
    assert [r[1] for r in found] == [r[1] for r in DATES]


@pytest.mark.parametrize("zone", ["UTC", "America/Santiago"])
def test_dates_do_not_shift_with_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = spark.sql(
            "SELECT explode(sequence(date '1960-01-01', date '2026-06-30')) AS d"
        ).withColumn("t", F.date_format("d", "yyyyMMdd"))
        assert days.filter(parsing.to_date("t", "yyyyMMdd") != F.col("d")).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_blank_is_spaces_only(spark):
    texts = [None, "", "   ", "\t", " x "]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    found = df.select("n", parsing.is_blank("t"), parsing.blank_to_null("t")).orderBy("n").collect()
    assert [tuple(r)[1:] for r in found] == [
        (True, None), (True, None), (True, None), (False, "\t"), (False, "x"),
    ]


def test_caps_are_inclusive_and_optional(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 1.0, 10.0, 10.5, None)], "x double")
    capped = [r[0] for r in df.select(rules.positive_up_to(F.col("x"), 10.0)).collect()]
    uncapped = [r[0] for r in df.select(rules.positive_up_to(F.col("x"), None)).collect()]
    assert capped == [None, None, 1.0, 10.0, None, None]
    assert uncapped == [None, None, 1.0, 10.0, 10.5, None]


def test_date_range(spark):
    days = [dt.date(1949, 12, 31), dt.date(1950, 1, 1), dt.date(2020, 1, 1), dt.date(2020, 1, 2)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    test = rules.outside_dates(F.col("d"), dt.date(2020, 1, 1))
    assert [r[0] for r in df.select(test).collect()] == [True, False, False, True]
    tomorrow = spark.sql("SELECT date_add(current_date(), 1) AS d")
    assert tomorrow.select(rules.outside_dates(F.col("d"))).first()[0]


def test_fraction_and_not_finite(spark):
    df = spark.createDataFrame([("1.5", 1), ("1.0", 1), ("x", None)], "t string, v int")
    assert [r[0] for r in df.select(rules.has_fraction("t", "v")).collect()] == [True, False, None]
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (1.0, inf, -inf, float("nan"), None)], "x float")
    found = [r[0] for r in df.select(rules.not_finite(F.col("x"))).collect()]
    assert found == [False, True, True, True, None]


def test_bad_link_is_the_exact_negation(spark):
    cases = [(1, 1), (0, 1), (None, 1), (1, 69_999), (1, 70_000), (1, None), (None, None), (0, None)]
    df = spark.createDataFrame(cases, "cod_com_bc int, cod_pr int")
    good = df.filter(rules.is_link()).count()
    bad = df.filter(rules.is_bad_link()).count()
    assert (good, bad) == (2, len(cases) - 2)


def test_every_code_around_digits_reads_as_the_plain_functions_do(spark):
    codes = [chr(i) for i in range(256)]
    texts = [t for c in codes for t in (c, c + "12", "12" + c, c + "12" + c, c + "1.5", "1.5" + c,
                                        c + "-3", " " + c + "7 ", "1" + c + "2", c + "NaN", c + c + "9")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    trim = F.trim("t")
    number = trim.try_cast("double")
    plain = {
        "int": (number.try_cast("int"), parsing.to_int("t")),
        "strict": (trim.try_cast("int"), parsing.to_int("t", strict=True)),
        "number": (F.when(F.abs(number) < float("inf"), number), parsing.to_number("t")),
    }
    for name, (expected, found) in plain.items():
        assert df.filter(~expected.eqNullSafe(found)).select("t", expected, found).collect() == [], name
