from __future__ import annotations

from pyspark.sql import functions as F

from jobsignals.functions.text import blank_to_null, clean_html, dedupe_ignoring_case, slug, snippet, utrim
from jobsignals.functions.values import array_length, level, midpoint, ratio


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_trim_takes_every_kind_of_white_space(spark):
    assert one(spark, utrim(F.lit(" \t\r\n\x0b 　a b \n"))) == "a b"
    assert one(spark, blank_to_null(F.lit("\n \t"))) is None
    assert one(spark, blank_to_null(F.lit(None).cast("string"))) is None


def test_clean_html(spark):
    assert one(spark, clean_html(F.lit("<p>Hi\n<b>there</b></p>\t x "))) == "Hi there x"
    assert one(spark, clean_html(F.lit(None).cast("string"))) == ""
    assert one(spark, clean_html(F.lit("a < b and c > d <>"))) == "a d <>"


def test_slug_and_snippet(spark):
    assert one(spark, slug(F.lit("Brisbane Region"))) == "brisbane-region"
    assert one(spark, snippet(F.lit("\n ab\ncd " + "x" * 500))) == ("ab cd " + "x" * 500)[:240]
    assert one(spark, snippet(F.lit(None).cast("string"))) == ""


def test_dedupe_keeps_first_spelling(spark):
    words = F.array(*[F.lit(w) for w in ["AWS", "aws", " Python ", "python", ""]])
    assert one(spark, dedupe_ignoring_case(words)) == ["AWS", "Python"]
    with_null = F.array(F.lit("b"), F.lit(None).cast("string"), F.lit("B"), F.lit("a"))
    assert one(spark, dedupe_ignoring_case(with_null)) == ["b", "a"]
    assert one(spark, dedupe_ignoring_case(F.array().cast("array<string>"))) == []


def test_dedupe_evaluates_its_input_once(spark):
    df = spark.range(1).select(dedupe_ignoring_case(F.split(F.expr("repeat('a b ', 10)"), " ")).alias("x"))
    assert df._jdf.queryExecution().analyzed().toString().count("split(") == 1


def test_levels_beyond_the_end_are_null(spark):
    area = F.array(F.lit("Australia"))
    assert one(spark, level(area, 0)) == "Australia"
    assert one(spark, level(area, 3)) is None
    assert one(spark, level(F.lit(None).cast("array<string>"), 0)) is None


def test_midpoint(spark):
    null = F.lit(None).cast("double")
    assert one(spark, midpoint(F.lit(1.0), F.lit(2.0))) == 1.5
    assert one(spark, midpoint(F.lit(1.0), null)) == 1.0
    assert one(spark, midpoint(null, F.lit(2.0))) == 2.0
    assert one(spark, midpoint(null, null)) is None


def test_ratio_and_length(spark):
    assert one(spark, ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, array_length(F.lit(None).cast("array<string>"))) == 0
