"""Detectors, dedup, skew handling and the clean pipeline on small hand-made tables."""

import datetime
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.catalog import cleaning
from panelmill.catalog.inputs import Inputs
from panelmill.catalog.publishing import manifest
from panelmill.operators import dedup, detect, keyed, validate
from panelmill.operators.joins import outside_scope, resolve
from panelmill.operators.skew import join_groups
from panelmill.plans import clean
from panelmill.session import stage

from .conftest import SF, rows

BASE = {
    "country_name": "Alpha",
    "country_code": "AAA",
    "region": "North",
    "income_group": "High",
    "year": "2001",
    "gdp_usd": "100.00",
    "population": "10",
    "life_expectancy": "70",
    "unemployment_rate": "5",
    "co2_emissions_per_capita": "1",
    "access_to_electricity_pct": "99",
    "source_file": "a.csv",
    "ingested_at": "2026-08-18 04:12:07",
}


def raw(spark, *changes):
    data = [(n, *(BASE | change).values()) for n, change in enumerate(changes, 1)]
    schema = "raw_record_id bigint, " + ", ".join(f"{c} string" for c in BASE)
    return spark.createDataFrame(data, schema)


def dim(spark):
    return spark.createDataFrame(
        [("AAA", "Alpha", "North", "High"), ("BBB", "Beta", "South", "Low")],
        "country_code string, country_name string, region string, income_group string",
    )


def issues(spark, *changes):
    rows_ = clean.annotate(raw(spark, *changes), dim(spark), 2000, 2023)
    log = clean.audit_log(rows_, 2000, 2023)
    return rows(log, "raw_record_id", "column_name", "issue_type", "cleaned_value")


def test_clean_record_has_no_issue(spark):
    assert issues(spark, {}) == []


def test_detectors(spark):
    assert issues(spark, {"country_code": "WLD"}) == [(1, "country_code", fixed.CODE_STANDARDIZED, "AAA")]
    assert issues(spark, {"year": "FY2013"}) == [(1, "year", fixed.YEAR_STANDARDIZED, "2013")]
    assert issues(spark, {"year": "2005.0"}) == [(1, "year", fixed.YEAR_STANDARDIZED, "2005")]
    assert issues(spark, {"year": "1899"}) == [(1, "year", fixed.YEAR_OUT_OF_RANGE, None)]
    assert issues(spark, {"gdp_usd": "$1,234.5"}) == [(1, "gdp_usd", fixed.FORMAT_STANDARDIZED, "1234.5")]
    assert issues(spark, {"gdp_usd": " "}) == [(1, "gdp_usd", fixed.MISSING_NUMERIC, None)]
    assert issues(spark, {"gdp_usd": None}) == [(1, "gdp_usd", fixed.MISSING_NUMERIC, None)]
    assert issues(spark, {"gdp_usd": "n/a"}) == [(1, "gdp_usd", fixed.INVALID_NUMERIC, None)]
    assert issues(spark, {"life_expectancy": "187.4"}) == [(1, "life_expectancy", fixed.OUT_OF_RANGE, None)]
    # A format that belongs to another column is neither repaired nor invalid.
    assert issues(spark, {"gdp_usd": "7,5"}) == []
    # The range check sees plain numbers only.
    assert issues(spark, {"unemployment_rate": "652.0%"}) == [
        (1, "unemployment_rate", fixed.FORMAT_STANDARDIZED, "652.0")
    ]


def test_name_match_goes_before_code_match(spark):
    got = issues(spark, {"country_code": "BBB", "region": "East"})
    assert (1, "country_code", fixed.CODE_STANDARDIZED, "AAA") in got
    assert (1, "reference_fields", fixed.REFERENCE_STANDARDIZED, "Alpha | North | High") in got
    # The name match agrees in all attributes, so the differing code match is the one reported.
    got = issues(spark, {"country_code": "BBB"})
    assert (1, "reference_fields", fixed.REFERENCE_STANDARDIZED, "Beta | South | Low") in got


def test_single_and_merged_numeric_detectors_agree(spark):
    values = ["1", "-1", "7,5", "-7,5", "6%", "$5", "x", "", None, "1e5", "+5", "200", "5\n", "$,", "%"]
    df = raw(spark, *[{c: v for c in fixed.INDICATORS} for v in values])
    apart = [
        *detect.format_fix_issues(),
        *detect.set_null_issues(fixed.INDICATORS),
        *detect.out_of_range_issues(fixed.BOUNDS),
    ]
    assert rows(detect.audit_rows(df, apart)) == rows(detect.audit_rows(df, detect.numeric_issues(fixed.BOUNDS)))


def test_outside_scope_keeps_missing_keys(spark):
    df = raw(spark, {"country_code": None, "country_name": None}, {"country_code": " aaa "}, {"country_name": "Zed"})
    assert rows(outside_scope(df, dim(spark)), "raw_record_id") == [(1,)]
    assert resolve(df, dim(spark)).count() == 3


def test_dedup_prefers_newest_then_missing_source_then_lowest_id(spark):
    df = raw(spark, {}, {"source_file": "b.csv"}, {"source_file": "b.csv"}, {"year": "2001.0"}, {"country_code": " aaa"})
    kept = dedup.first_per_key(df, dedup.panel_keys(), dedup.panel_order())
    assert rows(kept, "raw_record_id") == [(2,), (4,)]
    lost = dedup.duplicate_issues(df)
    assert [r[0] for r in rows(lost, "raw_record_id")] == [1, 3, 5]
    df = raw(spark, {}, {"source_file": None})
    assert rows(dedup.first_per_key(df, dedup.panel_keys(), dedup.panel_order()), "raw_record_id") == [(2,)]


def test_dedup_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    data = [
        (n, rng.choice(["AAA", "AAA", "aaa ", "BBB", None, ""]), str(rng.choice([2000, 2001])), rng.choice(["a", "b", None]))
        for n in range(3000)
    ]
    df = spark.createDataFrame(data, "raw_record_id bigint, country_code string, year string, source_file string")
    groups = defaultdict(list)
    for n, code, year, source in data:
        groups[(None if code is None else code.strip(" ").upper(), year)].append((n, source))
    order = {None: 0, "b": 1, "a": 2}
    best = {min(g, key=lambda r: (order[r[1]], r[0]))[0] for g in groups.values()}
    kept = dedup.first_per_key(df, dedup.panel_keys(), dedup.panel_order())
    assert {r[0] for r in rows(kept, "raw_record_id")} == best
    lost = dedup.duplicate_issues(df).select("raw_record_id")
    assert {r[0] for r in rows(lost)} == set(range(3000)) - best


def test_first_per_key_limits_before_the_shuffle(spark):
    kept = dedup.first_per_key(raw(spark, {}), dedup.panel_keys(), dedup.panel_order())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_join_groups_matches_a_plain_join_for_hot_cold_and_missing_keys(spark):
    rng = random.Random(5)
    data = [(n, rng.choice(["hot"] * 5 + ["x", "y", None])) for n in range(2000)]
    df = spark.createDataFrame(data, "id bigint, k string")
    groups = df.groupBy("k").agg(F.count("*").alias("n"))
    counts = defaultdict(int)
    for _, k in data:
        counts[k] += 1
    got = join_groups(df, groups, ["k"])
    assert rows(got, "id", "k", "n") == sorted(
        [(n, k, counts[k]) for n, k in data], key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def test_injected_defects_are_reported_one_by_one(spark):
    i = Inputs(spark, SF).land()
    audit = stage(cleaning.audit_of(i, stage(cleaning.annotated(i))))
    known = {
        "aggregate_row": [fixed.CODE_STANDARDIZED, fixed.OUTSIDE_SCOPE],
        "referential_integrity": [fixed.CODE_STANDARDIZED],
        "type_drift": [fixed.YEAR_STANDARDIZED],
        "out_of_range": [fixed.YEAR_OUT_OF_RANGE],
        "text_formatting": [fixed.FORMAT_STANDARDIZED],
        "impossible_value": [fixed.OUT_OF_RANGE],
        "orphan_record": [fixed.OUTSIDE_SCOPE],
        "exact_duplicate": [fixed.DUPLICATE_KEY, fixed.YEAR_OUT_OF_RANGE],
    }
    found = defaultdict(set)
    for r in audit.collect():
        found[r["raw_record_id"]].add(r["issue_type"])
    checked = 0
    for m in manifest(i).collect():
        if m["defect_type"] in known:
            checked += 1
            assert found[m["raw_record_id"]] & set(known[m["defect_type"]]), m
        if m["defect_type"] == "null_sentinel" and m["column_name"] in fixed.INDICATORS:
            assert found[m["raw_record_id"]] & {fixed.MISSING_NUMERIC, fixed.INVALID_NUMERIC}, m
    assert checked > 50


def test_fixture_counts_and_invariants(spark):
    i = Inputs(spark, SF).land()
    rows_ = stage(cleaning.annotated(i))
    cleaned, audit = stage(cleaning.clean_of(i, rows_)), stage(cleaning.audit_of(i, rows_))
    counts = validate.reconcile(rows_, cleaned, audit).first().asDict()
    assert counts == {
        "raw_rows": 1477, "cleaned_rows": 792, "quarantined_rows": 14, "excluded_duplicates": 671, "passed": True,
    }
    assert dedup.dup_keys(cleaned, ["country_code", "year"]).isEmpty()
    assert dedup.dup_keys(audit, ["raw_record_id", "column_name", "issue_type"]).isEmpty()
    again = keyed.insert_missing(audit, audit, ["raw_record_id", "column_name", "issue_type"])
    assert keyed.tables_equal(audit, again)


def test_documented_fix_reaches_the_clean_value(spark):
    df = raw(spark, {"life_expectancy": "7.5"}, {"year": "2002", "population": "51484.0"})
    fixes = spark.createDataFrame(
        [("AAA", "2001", "life_expectancy", fixed.LIFE_DECIMAL, "7.5", "75.0")],
        "country_code string, year string, column_name string, issue_type string, original_value string, cleaned_value string",
    )
    by_id = spark.createDataFrame(
        [(2, fixed.POPULATION_SCALE, "51484000")], "raw_record_id bigint, issue_type string, cleaned_value string"
    )
    noted = clean.annotate(df, dim(spark), 2000, 2023)
    out = {r["raw_record_id"]: r for r in clean.clean_panel(noted, fixed.BOUNDS, fixes, by_id).collect()}
    assert out[1]["life_expectancy"] == Decimal("75.00")
    assert out[2]["population"] == 51484000
    assert out[1]["ingested_at"] == datetime.datetime(2026, 8, 18, 4, 12, 7)
    log = clean.audit_log(noted, 2000, 2023, fixed.BOUNDS, fixes, by_id)
    assert rows(log, "raw_record_id", "issue_type", "original_value", "cleaned_value") == [
        (1, fixed.LIFE_DECIMAL, "7.5", "75.0"),
        (2, fixed.POPULATION_SCALE, "51484.0", "51484000"),
    ]
    checked = validate.verify_fixes(fixes, clean.clean_panel(noted, fixed.BOUNDS, fixes, by_id), df, log)
    assert rows(checked, "country_code", "raw_value", "passed") == [("AAA", "7.5", True)]


def test_unreadable_year_stays_null_for_the_gates(spark):
    noted = clean.annotate(raw(spark, {"year": "FY2109"}, {"year": "soon"}), dim(spark), 2000, 2023)
    cleaned = clean.clean_panel(noted)
    report = validate.constraint_report(
        cleaned, not_null=["year"], checks={"year_in_period": F.col("year").between(2000, 2023)}
    )
    assert dict(rows(report)) == {"year_not_null": 1, "year_in_period": 1}


FIX_SCHEMA = (
    "country_code string, year string, column_name string, issue_type string, original_value string, cleaned_value string"
)


def test_documented_fix_of_every_column(spark):
    values = {c: f"{9 - k}.5" for k, c in enumerate(fixed.INDICATORS)}
    df = raw(spark, values | {"population": "8"}, {"year": "2002", "population": "8"})
    wrong = values | {"population": "8"}
    fixes = spark.createDataFrame(
        [("AAA", "2001", c, "documented", wrong[c], str(20 + k)) for k, c in enumerate(fixed.INDICATORS)]
        + [("AAA", "2002", "population", "documented", "8", "21")],
        FIX_SCHEMA,
    )
    by_id = spark.createDataFrame([(2, "by id", "99")], "raw_record_id bigint, issue_type string, cleaned_value string")
    noted = clean.annotate(df, dim(spark), 2000, 2023)
    panel = clean.clean_panel(noted, fixed.BOUNDS, fixes, by_id)
    out = {r["raw_record_id"]: r for r in panel.collect()}
    assert [out[1][c] for c in fixed.INDICATORS] == [20 + k for k in range(6)] and out[2]["population"] == 99
    log = clean.audit_log(noted, 2000, 2023, fixed.BOUNDS, fixes, by_id)
    got = rows(log.where("issue_type IN ('documented', 'by id')"), "raw_record_id", "column_name", "cleaned_value")
    expected = [(1, c, str(20 + k)) for k, c in enumerate(fixed.INDICATORS)] + [(2, "population", "99")]
    assert got == sorted(expected, key=lambda r: tuple(map(str, r)))
    checked = validate.verify_fixes(fixes.where("year = 2001"), panel, df, log)
    assert checked.where("passed").count() == 6 and checked.count() == 6


def test_documented_fix_of_an_unknown_column_raises(spark):
    fixes = spark.createDataFrame([("AAA", "2001", "region", "documented", "North", "South")], FIX_SCHEMA)
    noted = clean.annotate(raw(spark, {}), dim(spark), 2000, 2023)
    for frame in (clean.clean_panel(noted, fixed.BOUNDS, fixes), clean.documented_audit(raw(spark, {}), fixes, None)):
        with pytest.raises(Exception, match="unknown column: region"):
            frame.collect()
