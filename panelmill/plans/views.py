"""Derived views and end reports over a typed panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.numeric import complete, safe_ln, safe_ratio
from panelmill.operators.stats import endpoint_change


def analytic_view(panel: DataFrame) -> DataFrame:
    """The panel with per-capita and logarithmic columns and a completeness flag."""
    ratio = safe_ratio("gdp_usd", "population")
    both_positive = (F.col("gdp_usd") > 0) & (F.col("population") > 0)
    return panel.withColumns(
        {
            "gdp_per_capita": F.round(ratio, 2),
            "log_gdp_per_capita": F.when(both_positive, safe_ln(ratio)),
            "log_population": safe_ln("population"),
            "has_complete_indicators": complete(fixed.INDICATORS),
        }
    )


def change_report(panel: DataFrame, start: int, end: int) -> DataFrame:
    """Per entity: change of two measures between two years, largest first, NULL last."""
    columns = ["access_to_electricity_pct", "life_expectancy"]
    changes = endpoint_change(panel, "country_code", "year", start, end, columns, ["country_name"])
    report = changes.select(
        "country_name",
        "country_code",
        F.round("access_to_electricity_pct_change", 2).alias("electricity_change_pp"),
        F.round("life_expectancy_change", 2).alias("life_expectancy_change_years"),
    )
    return report.orderBy(F.desc_nulls_last("electricity_change_pp"), "country_code")


def comparison_report(panel: DataFrame, year: int) -> DataFrame:
    """Per entity in one year: output per head and two measures, by code."""
    return (
        panel.where(F.col("year") == year)
        .select(
            "country_name",
            "country_code",
            "year",
            F.round(safe_ratio("gdp_usd", "population"), 2).alias("gdp_per_capita_current_usd"),
            F.col("life_expectancy").alias("life_expectancy_years"),
            "access_to_electricity_pct",
        )
        .orderBy("country_code")
    )


def per_capita_preview(panel: DataFrame, year: int) -> DataFrame:
    """Output per head in one year, highest first, NULL last."""
    return (
        panel.where(F.col("year") == year)
        .select(
            "country_name",
            "year",
            F.round(safe_ratio("gdp_usd", "population"), 2).alias("gdp_per_capita_usd"),
        )
        .orderBy(F.desc_nulls_last("gdp_per_capita_usd"), "country_name")
    )
