"""Column builders on the edge cases they exist for."""

import datetime

import pytest
from pyspark.sql import functions as F

from layerforge.functions import audit, numeric, predicates, text
from layerforge.functions.keys import null_as_empty, surrogate_key


def apply(spark, build, *values, dtype="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    out = df.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]


def test_lower_and_upper_trim_spaces_only(spark):
    assert apply(spark, text.lower_trimmed, "  AbC ", "\tA ", None) == ["abc", "\ta", None]
    assert apply(spark, text.upper_trimmed, " 12a-b ") == ["12A-B"]


def test_title_case_breaks_words_at_spaces(spark):
    assert apply(spark, text.title_case, " joHN  o'NEIL-smith ", "", None) == [
        "John  O'neil-smith",
        "",
        None,
    ]


def test_street_collapses_any_whitespace_but_not_nbsp(spark):
    assert apply(spark, text.squeezed_title_case, "new \t  road", "a  b") == [
        "New Road",
        "A  B",
    ]


def test_phone_keeps_digits_and_separators(spark):
    assert apply(
        spark, text.phone_digits, "1-570-236-7033", " 1.570-236x7033 (ab)+1 ", None
    ) == ["1-570-236-7033", "1570-2367033 ()+1", None]


def test_joined_skips_null(spark):
    df = spark.createDataFrame([("a", 7), (None, 7), ("a", None), (None, None)], "s string, n int")
    out = df.select(text.joined(", ", F.col("s"), F.col("n")).alias("r")).collect()
    assert [r["r"] for r in out] == ["a, 7", "7", "a", ""]


def test_plain_double_accepts_only_plain_decimals(spark):
    values = [" -37.31 ", "12", "\t5 ", "1e5", "+3", ".5", "abc", "", "12.", None]
    assert apply(spark, numeric.plain_double, *values) == [
        -37.31, 12.0, 5.0, None, None, None, None, None, None, None,
    ]


def test_cents_rounds_half_up(spark):
    assert apply(spark, numeric.cents, 2.675, -2.675, 10.0, None, dtype="double") == [
        2.68, -2.68, 10.0, None,
    ]


def test_null_if_keeps_undecided(spark):
    def negative(c):
        return numeric.null_if(c, c < 0)

    assert apply(spark, negative, -1.0, 0.0, None, dtype="double") == [None, 0.0, None]

    def off_range(c):
        return numeric.null_if(c, ~c.between(0, 5))

    assert apply(spark, off_range, -0.1, 0.0, 5.0, 5.1, None, dtype="double") == [
        None, 0.0, 5.0, None, None,
    ]


def test_email_predicate(spark):
    def bad(c):
        return predicates.mismatches(c, predicates.EMAIL_PATTERN)

    assert apply(spark, bad, "a.b+c@x.co", "A@B.ORG", "a@b", " a@b.co ", "a#1@b.co", None) == [
        False, False, True, True, True, None,
    ]


def test_zip_predicate(spark):
    def bad(c):
        return predicates.mismatches(c, predicates.ZIP_PATTERN)

    assert apply(spark, bad, "12926-3874", "12345", "1234", "12345-12", None) == [
        False, False, True, True, None,
    ]


def test_url_predicate(spark):
    def bad(c):
        return predicates.mismatches(c, predicates.URL_PATTERN)

    assert apply(spark, bad, "ftp://x", "http://x", "https://x", "xhttp://", None) == [
        True, False, False, True, None,
    ]


def test_globe_limits_are_inclusive_and_null_passes(spark):
    rows = [(90.0, 180.0), (-90.0, -180.0), (90.1, 0.0), (0.0, 180.1), (None, None), (None, 200.0)]
    df = spark.createDataFrame(rows, "lat double, long double")
    out = df.select(predicates.off_the_globe(F.col("lat"), F.col("long")).alias("r")).collect()
    assert [r["r"] for r in out] == [False, False, True, True, False, True]


def test_blank(spark):
    assert apply(spark, predicates.blank, "", " ", "x", None) == [True, False, False, True]


def test_key_of_known_int(spark):
    # Fixed value: the seeded Murmur3 hash of the int 1.
    assert apply(spark, surrogate_key, 1, dtype="int") == [559580957]
    assert apply(spark, surrogate_key, 1, dtype="bigint") != [559580957]


def test_key_never_fails_or_goes_negative(spark):
    df = spark.range(200_000).select(F.min(surrogate_key(F.col("id").cast("int"))).alias("m"))
    assert df.first()["m"] >= 0
    smallest = spark.range(1).select(F.abs(F.lit(-(2**31)).cast("bigint")).alias("k"))
    assert smallest.first()["k"] == 2**31


def test_text_pair_key_treats_null_as_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "c string, z string")
    keys = df.select(
        surrogate_key(null_as_empty(F.col("c")), null_as_empty(F.col("z"))).alias("k")
    ).distinct()
    assert keys.count() == 1


def test_wide_keys_and_unknown_algorithm(spark):
    ids = spark.range(300_000).select(surrogate_key(F.col("id"), algorithm="xxhash64").alias("k"))
    assert ids.distinct().count() == 300_000
    with pytest.raises(ValueError):
        surrogate_key(F.col("id"), algorithm="md5")


def test_bayes_score(spark):
    df = spark.createDataFrame([(4.0, 10), (None, 10), (5.0, 0)], "r double, v int")
    out = df.select(numeric.bayes_score(F.col("r"), F.col("v"), F.lit(3.0)).alias("s")).collect()
    assert [r["s"] for r in out] == [pytest.approx((20 * 3 + 40) / 30), None, pytest.approx(3.0)]


def test_ndjson_line_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, "ç")], "id int, title string, x string")
    assert df.select(text.ndjson_line("id", "title", "x").alias("l")).first()["l"] == (
        '{"id":1,"title":null,"x":"ç"}'
    )


def test_audit_time_can_be_pinned(spark):
    at = datetime.datetime(2024, 5, 1, 12, 0)
    row = spark.range(1).select(
        audit.audit_time(at).alias("a"), audit.audit_time().alias("now")
    ).first()
    assert row["a"] == at and row["now"] is not None
