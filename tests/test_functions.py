from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flakeform.functions import (
    initials,
    length_bucket,
    lenient_cast,
    natural_hash,
    padded_sequence,
    reduced_code,
    text_length,
)


def evaluate(spark, value, kind, rule):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(rule(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("text", "code"),
    [
        ("Health service manager", "HSM"),
        ("  Health\t service  manager ", "HSM"),
        ("Oak, Elm and Ash", "OEAA"),
        ("Reed-Marsh", "R"),
        ("nursing home b\x1cc", "NHBC"),
        ("\U0001f600x straße", "\U0001f600S"),
        ("", ""),
        ("   ", ""),
        (None, None),
    ],
)
def test_initials(spark, text, code):
    assert evaluate(spark, text, "string", initials) == code


@pytest.mark.parametrize(
    ("code", "threshold", "reduced"),
    [("CAGM", 3, "G"), ("HSM", 3, "HSM"), ("ABCDE", 4, "D"), ("ABCD", 4, "ABCD"), ("", 3, ""), (None, 3, None)],
)
def test_reduced_code(spark, code, threshold, reduced):
    assert evaluate(spark, code, "string", lambda c: reduced_code(c, threshold)) == reduced


@pytest.mark.parametrize(
    ("length", "bucket"),
    [
        (None, 50),
        (0, 50),
        (1, 50),
        (50, 50),
        (51, 100),
        (255, 255),
        (256, 500),
        (8000, 8000),
        (8001, 9000),
        (8999, 9000),
        (9000, 10000),
    ],
)
def test_length_bucket(spark, length, bucket):
    assert evaluate(spark, length, "int", length_bucket) == bucket


def test_length_bucket_with_own_sizes(spark):
    assert evaluate(spark, 25, "int", lambda c: length_bucket(c, [30, 10])) == 30
    assert evaluate(spark, 31, "int", lambda c: length_bucket(c, [30, 10])) == 1000


def test_text_length_counts_characters_and_null_as_zero(spark):
    assert evaluate(spark, "éü😀", "string", text_length) == 3
    assert evaluate(spark, None, "string", text_length) == 0


def test_lenient_cast_turns_dirt_into_null(spark):
    assert evaluate(spark, "n/a", "string", lambda c: lenient_cast(c, "int")) is None
    assert evaluate(spark, "2.345", "string", lambda c: lenient_cast(c, "decimal(10,2)")) == Decimal("2.35")
    assert evaluate(spark, "123456789012", "string", lambda c: lenient_cast(c, "decimal(10,2)")) is None


@pytest.mark.parametrize(("number", "text"), [(0, "000000"), (42, "000042"), (1234567, "1234567")])
def test_padded_sequence_never_cuts(spark, number, text):
    assert evaluate(spark, number, "long", lambda c: padded_sequence(c, 6)) == text


def test_natural_hash_tells_parts_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), ("a", None), (None, "a"), ("-", ""), (None, None), ("1:a", None), ("", "-")]
    df = spark.createDataFrame(rows, "x string, y string").select(natural_hash(["x", "y"]).alias("id"))
    assert df.distinct().count() == len(rows)
