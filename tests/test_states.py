"""Run states, exact sums, overflowing numbers, bad pages, repeated keys."""

import pytest
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.numeric import mean_dec
from panelmill.operators.dedup import key_duplicate_members
from panelmill.plans import gates, runlog
from panelmill.plans.refresh import upsert_panel
from panelmill.session import stage
from panelmill.sources import payload

from tests.test_skew import small  # noqa: F401


def test_terminal_events_before_the_start_are_ignored(spark):
    events = [
        ("a", "p", "succeeded", 5, 1, 1, None),
        ("a", "p", "running", 10, None, None, None),
        ("a", "p", "failed", 20, None, None, "x"),
        ("a", "p", "succeeded", 30, 2, 2, None),
        ("b", "p", "running", 7, None, None, None),
        ("b", "p", "failed", 6, None, None, "y"),
        ("c", "p", "succeeded", 8, 3, 3, None),
    ]
    got = runlog.run_states(spark.createDataFrame(events, runlog.EVENTS)).orderBy("run_id")
    rows = got.select("run_id", "started_ns", "finished_ns", "status", "staging_rows", "error_message").collect()
    assert [tuple(r) for r in rows] == [("a", 10, 20, "failed", None, "x"), ("b", 7, None, "running", None, None)]
    assert got.where("duration_seconds < 0").isEmpty()


def test_mean_of_bigints_beyond_their_sum(spark):
    df = spark.range(3).select(F.lit(9_000_000_000_000_000_000).alias("population"))
    assert float(df.agg(mean_dec("population", 0).alias("m")).first()["m"]) == 9e18


def staged(spark, **values):
    row = {
        "country_name": "A", "country_code": "AAA", "region": "r", "income_group": "i", "year": "2001",
        **dict.fromkeys(fixed.INDICATORS, "50"), "source_file": "s", "ingested_at": "2024-01-01 00:00:00",
    }
    return spark.createDataFrame([tuple((row | values)[c] for c in fixed.SOURCE_COLUMNS)], ", ".join(f"{c} string" for c in fixed.SOURCE_COLUMNS))


@pytest.mark.parametrize(
    "values, message",
    [
        ({}, None),
        ({"gdp_usd": "9" * 24}, fixed.MESSAGE_VALUES),
        ({"population": "9" * 32}, fixed.MESSAGE_VALUES),
        ({"population": "5.00000000001"}, fixed.MESSAGE_RANGES),
        ({"population": "5.00000000000000000001"}, fixed.MESSAGE_RANGES),
        ({"population": "5.000"}, None),
    ],
)
def test_no_number_is_lost_at_the_gates(spark, values, message):
    codes = spark.createDataFrame([("AAA",)], "country_code string")
    report = gates.gate_report(staged(spark, **values), codes, "s", 2000, 2010)
    assert gates.first_failure(report, 1).first()["message"] == message


def test_upsert_refuses_a_key_twice(spark):
    batch = staged(spark).union(staged(spark, gdp_usd="60"))
    with pytest.raises(gates.GateFailure):
        upsert_panel(upsert_panel_target(spark), batch)


def upsert_panel_target(spark):
    from panelmill.operators.keyed import cast_panel

    return cast_panel(staged(spark)).limit(0)


def test_bad_pages_are_counted_and_stop(spark):
    row = '{"indicator":{"id":"g"},"countryiso3code":"AAA","date":"%s","value":83.0512195121951}'
    good, cut, dated = (f"[{{}},[{row % y}]]" for y in ("2001", "2002", "20x1"))
    pages = spark.createDataFrame([(1, good), (2, cut[:-5]), (3, dated)], "page int, body string")
    assert tuple(payload.page_problems(pages).first()) == (3, 1, 1)
    with pytest.raises(ValueError):
        payload.require_pages(pages)
    only = payload.require_pages(pages.where("page = 1"))
    assert str(payload.flatten_pages(only).first()["value"]) == "83.051219512195100"


def test_uncorrected_fixes_stop(spark):
    row = spark.createDataFrame([(5, 5, 2, 2, 1)], "raw_rows int, cleaned_rows int, documented_fixes int, targets_found int, targets_corrected int")
    with pytest.raises(gates.GateFailure):
        gates.require_fixed(row)
    assert gates.require_fixed(row.withColumn("targets_corrected", F.lit(2)))["raw_rows"] == 5


def test_members_of_a_hot_key_are_split(small):  # noqa: F811
    """A third of the records has one key."""
    df = stage(small.range(300_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS k", "sha2(CAST(id AS STRING), 512) AS name").repartition(16))
    members = key_duplicate_members(df, ["k"], "name", "id").agg(F.count("*").alias("n"))
    assert members.collect()[0]["n"] == 100_000
