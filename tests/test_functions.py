"""Scalar functions and the places where engines differ."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from panelmill.functions import numeric, text
from panelmill.operators import stats
from panelmill.operators.stats import linear_fit


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, lo, hi, expected",
    [
        ("7,86", 0, None, "7.86"),
        ("6.14%", 0, 100, "6.14"),
        ("$1,234.50", 0, None, "1234.50"),
        ("unknown", 0, 120, None),
        ("652.0", 0, 100, None),
        ("652.0%", 0, 100, None),
        ("-7,5", None, None, "-7.5"),
        ("+5", None, None, None),
        ("1,234", 0, None, "1.234"),
        ("  12 ", 0, None, "12"),
        ("", 0, None, None),
        (None, 0, None, None),
        ("5\n", None, None, None),
        ("$", None, None, None),
        ("1.2.3", None, None, None),
        ("100", 0, 100, "100"),
    ],
)
def test_clean_numeric(spark, raw, lo, hi, expected):
    got = one(spark, text.clean_numeric("x", lo, hi), x=raw)
    assert got == (None if expected is None else Decimal(expected))
    df = spark.createDataFrame([(raw,)], "x string")
    assert text.clean_numerics(df, {"v": ("x", lo, hi)}).first()["v"] == got


def test_blank_and_trim_take_spaces_only(spark):
    assert one(spark, text.blank_to_null("x"), x="   ") is None
    assert one(spark, text.trimmed("x"), x=" \ta  ") == "\ta "


def test_pattern_does_not_match_before_newline(spark):
    assert one(spark, text.matches("x", r"^[0-9]{4}\z"), x="2000\n") is False


@pytest.mark.parametrize(
    "raw, kind, valid",
    [
        ("2000", "integer", True),
        (" 2000 ", "integer", True),
        ("2000.0", "integer", False),
        ("2_000", "integer", False),
        ("99999999999", "integer", False),
        ("NaN", "numeric", True),
        ("1e5", "numeric", True),
        ("5d", "numeric", False),
        ("2026-08-18 04:12:07", "timestamp", True),
        ("2026", "timestamp", False),
        ("infinity", "timestamp", True),
        ("2026-13-01", "timestamp", False),
    ],
)
def test_input_validity(spark, raw, kind, valid):
    assert one(spark, text.is_valid("x", kind), x=raw) is valid


def test_rounding_to_whole_numbers(spark):
    value = text.as_decimal("x", "decimal(38,15)")
    assert one(spark, numeric.round_to_bigint(value), x="53219166.99999997") == 53219167


def test_round_half_away_from_zero(spark):
    assert one(spark, numeric.round_dec(F.lit(1.005), 2), x="") == Decimal("1.01")
    assert one(spark, numeric.round_dec(F.lit(-2.5), 0), x="") == Decimal("-3")


def test_ratio_and_logarithm_guards(spark):
    assert one(spark, numeric.safe_ratio(F.lit(1), F.lit(0)), x="") is None
    assert one(spark, numeric.safe_ln(F.lit(0)), x="") is None
    assert one(spark, numeric.safe_ln(F.lit(10)), x="") == Decimal("2.3026")


def test_correlation_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 7.0)], "x double, y double")
    row = stats.correlations(df, "y", {"c": "x"}).first()
    assert row["c"] is None
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0), (4.0, None)], "x double, y double")
    assert stats.correlations(df, "y", {"c": "x"}).first()["c"] == Decimal("0.993")


def test_linear_fit_needs_spread(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 3.0), ("b", 1.0, 1.0)], "g string, x double, y double")
    fit = {r["g"]: r for r in linear_fit(df, "x", "y", ["g"]).collect()}
    assert (fit["a"]["slope"], fit["a"]["intercept"], fit["a"]["pairs"]) == (2, -1, 2)
    assert fit["b"]["slope"] is None and fit["b"]["pairs"] == 1


def test_top_changes_put_unknown_first(spark):
    df = spark.createDataFrame([("a", 1), ("b", -5), ("c", None)], "k string, d int")
    assert [r["k"] for r in stats.top_abs_change(df, "d", "k", 2).collect()] == ["c", "b"]


def test_all_pass(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert stats.all_pass(df, F.col("x") > 0).first()[0] is False
    assert stats.all_pass(df.limit(0), F.col("x") > 0).first()[0] is False
