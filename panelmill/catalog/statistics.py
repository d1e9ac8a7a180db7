"""Queries over the typed panel: views, reports, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.catalog.base import query
from panelmill.catalog.inputs import END, FIRST_YEAR, START, Inputs, define
from panelmill.functions.numeric import mean_dec
from panelmill.operators import stats
from panelmill.plans import views

# Rounding in the check SQL goes through decimal(38,8): both engines then agree on ties.
define(
    "analytic",
    """
SELECT *, round(CAST(gdp_usd / nullif(population, 0) AS DECIMAL(38,8)), 2) AS gdp_per_capita,
       CASE WHEN gdp_usd > 0 AND population > 0
            THEN round(CAST(ln(CAST(gdp_usd AS DOUBLE) / population) AS DECIMAL(38,8)), 4) END AS log_gdp_per_capita,
       CASE WHEN population > 0 THEN round(CAST(ln(CAST(population AS DOUBLE)) AS DECIMAL(38,8)), 4) END AS log_population,
       gdp_usd IS NOT NULL AND population IS NOT NULL AND life_expectancy IS NOT NULL
         AND unemployment_rate IS NOT NULL AND co2_emissions_per_capita IS NOT NULL
         AND access_to_electricity_pct IS NOT NULL AS has_complete_indicators
FROM panel_typed""",
    ["panel_typed"],
)
define(
    "changes",
    f"""
SELECT a.country_name, a.country_code, a.life_expectancy AS life_start,
       b.life_expectancy - a.life_expectancy AS life, b.access_to_electricity_pct - a.access_to_electricity_pct AS elec,
       b.co2_emissions_per_capita - a.co2_emissions_per_capita AS co2, b.unemployment_rate - a.unemployment_rate AS unemp,
       b.gdp_per_capita - a.gdp_per_capita AS gdp
FROM analytic a JOIN analytic b ON a.country_code = b.country_code
WHERE a."year" = {START} AND b."year" = {END}""",
    ["analytic"],
)


def corr_sql(y: str, x: str) -> str:
    c = f"corr(CAST({y} AS DOUBLE), CAST({x} AS DOUBLE))"
    return f"CAST(round(CAST(CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS DECIMAL(38,8)), 3) AS DOUBLE)"


def mean_sql(x: str, digits: int) -> str:
    return f"CAST(round(CAST(avg({x}) AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


CHANGE_COLUMNS = [
    "life_expectancy",
    "access_to_electricity_pct",
    "co2_emissions_per_capita",
    "unemployment_rate",
    "gdp_per_capita",
]


def analytic(i: Inputs):
    return views.analytic_view(i.panel_typed)


def changes(i: Inputs):
    return stats.endpoint_change(
        analytic(i), "country_code", "year", START, END, CHANGE_COLUMNS, ["country_name"]
    )


@query(
    "r1_change_report",
    """SELECT country_name, country_code, CAST(round(elec, 2) AS DOUBLE) AS electricity_change_pp,
       CAST(round(life, 2) AS DOUBLE) AS life_expectancy_change_years FROM changes
       ORDER BY electricity_change_pp DESC NULLS LAST, country_code""",
    "changes",
)
def r1_change_report(i: Inputs):
    """Change of two measures between the endpoints per entity."""
    return views.change_report(i.panel_typed, START, END)


@query(
    "r2_comparison_report",
    f"""SELECT country_name, country_code, "year", CAST(gdp_per_capita AS DOUBLE) AS gdp_per_capita_current_usd,
        CAST(life_expectancy AS DOUBLE) AS life_expectancy_years,
        CAST(access_to_electricity_pct AS DOUBLE) AS access_to_electricity_pct
        FROM analytic WHERE "year" = {END} ORDER BY country_code""",
    "analytic",
)
def r2_comparison_report(i: Inputs):
    """Three measures per entity in one year."""
    return views.comparison_report(i.panel_typed, END)


@query(
    "r2_per_capita_preview",
    f"""SELECT country_name, "year", CAST(gdp_per_capita AS DOUBLE) AS gdp_per_capita_usd
        FROM analytic WHERE "year" = {END} ORDER BY 3 DESC NULLS LAST, 1""",
    "analytic",
)
def r2_per_capita_preview(i: Inputs):
    """Output per head in one year, highest first."""
    return views.per_capita_preview(i.panel_typed, END)


@query(
    "r3_analytic_view",
    """SELECT country_code, country_name, region, income_group, "year", CAST(gdp_usd AS DOUBLE) AS gdp_usd, population,
       CAST(life_expectancy AS DOUBLE) AS life_expectancy, CAST(unemployment_rate AS DOUBLE) AS unemployment_rate,
       CAST(co2_emissions_per_capita AS DOUBLE) AS co2_emissions_per_capita,
       CAST(access_to_electricity_pct AS DOUBLE) AS access_to_electricity_pct,
       CAST(gdp_per_capita AS DOUBLE) AS gdp_per_capita, CAST(log_gdp_per_capita AS DOUBLE) AS log_gdp_per_capita,
       CAST(log_population AS DOUBLE) AS log_population, has_complete_indicators FROM analytic""",
    "analytic",
)
def r3_analytic_view(i: Inputs):
    """Typed panel with derived columns."""
    return analytic(i).drop("source_file", "ingested_at")


@query(
    "p12_complete",
    'SELECT country_code, "year", has_complete_indicators FROM analytic',
    "analytic",
)
def p12_complete(i: Inputs):
    """Completeness flag per record."""
    return analytic(i).select("country_code", "year", "has_complete_indicators")


@query(
    "r3_view_check",
    """SELECT count(*) AS total_rows, count(DISTINCT (country_code, "year")) AS unique_country_years,
       count(*) FILTER (WHERE gdp_per_capita IS NULL) AS gdp_per_capita_nulls,
       count(*) FILTER (WHERE NOT has_complete_indicators) AS incomplete_rows FROM analytic""",
    "analytic",
)
def r3_view_check(i: Inputs):
    """Row, key, NULL and incompleteness counts of the analytic view."""
    return analytic(i).agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(F.struct("country_code", "year")).alias("unique_country_years"),
        F.count_if(F.col("gdp_per_capita").isNull()).alias("gdp_per_capita_nulls"),
        F.count_if(~F.col("has_complete_indicators")).alias("incomplete_rows"),
    )


@query(
    "a13_overview",
    """SELECT count(*) AS total_records, count(DISTINCT country_code) AS entities, min("year") AS first_year,
       max("year") AS last_year, count(*) FILTER (WHERE has_complete_indicators) AS complete_records,
       count(*) FILTER (WHERE NOT has_complete_indicators) AS incomplete_records,
       CAST(round(CAST(100.0 * count(*) FILTER (WHERE has_complete_indicators) / count(*) AS DECIMAL(38,8)), 2) AS DOUBLE)
         AS completeness_pct FROM analytic""",
    "analytic",
)
def a13_overview(i: Inputs):
    """Dataset overview."""
    return stats.overview(i.panel_typed, "country_code", "year", fixed.INDICATORS)


@query(
    "a14_trend",
    f"""SELECT "year", count(*) AS records, {mean_sql("life_expectancy", 2)} AS avg_life_expectancy,
        {mean_sql("co2_emissions_per_capita", 2)} AS avg_co2_emissions_per_capita,
        {mean_sql("unemployment_rate", 2)} AS avg_unemployment_rate,
        {mean_sql("access_to_electricity_pct", 2)} AS avg_access_to_electricity_pct,
        {mean_sql("gdp_per_capita", 2)} AS avg_gdp_per_capita,
        CAST(round(CAST(avg(population) / 1000000 AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_population_millions
        FROM analytic GROUP BY "year" ORDER BY "year" """,
    "analytic",
)
def a14_trend(i: Inputs):
    """Mean indicators by year."""
    columns = [
        "life_expectancy",
        "co2_emissions_per_capita",
        "unemployment_rate",
        "access_to_electricity_pct",
        "gdp_per_capita",
    ]
    return stats.trend(analytic(i), "year", columns, millions=["population"])


@query(
    "a15_compare_groups",
    f"""SELECT income_group, count(*) AS records, {mean_sql("life_expectancy", 2)} AS avg_life_expectancy,
        {mean_sql("access_to_electricity_pct", 2)} AS avg_access_to_electricity_pct,
        {mean_sql("gdp_per_capita", 2)} AS avg_gdp_per_capita
        FROM analytic GROUP BY income_group ORDER BY 3 DESC NULLS FIRST, 1""",
    "analytic",
)
def a15_compare_groups(i: Inputs):
    """Mean indicators by income group."""
    columns = ["life_expectancy", "access_to_electricity_pct", "gdp_per_capita"]
    return stats.compare_groups(analytic(i), "income_group", columns)


def register_correlations(name: str, y: str, xs: dict[str, str]) -> None:
    check = ", ".join(f"{corr_sql(y, x)} AS {alias}" for alias, x in xs.items())

    @query(name, f"SELECT {check} FROM analytic", "analytic")
    def build(i: Inputs):
        """Correlations of one measure with the others."""
        return stats.correlations(analytic(i), y, xs)


register_correlations(
    "a16_correlations",
    "life_expectancy",
    {
        "co2_correlation": "co2_emissions_per_capita",
        "unemployment_correlation": "unemployment_rate",
        "electricity_correlation": "access_to_electricity_pct",
        "gdp_per_capita_correlation": "gdp_per_capita",
        "population_correlation": "population",
    },
)
OTHERS = {
    "co2_correlation": "co2_emissions_per_capita",
    "unemployment_correlation": "unemployment_rate",
    "electricity_correlation": "access_to_electricity_pct",
}
register_correlations("a16_gdp_correlations", "gdp_per_capita", OTHERS)
register_correlations("a16_population_correlations", "population", OTHERS)


@query(
    "a17_paired_corr",
    f"""SELECT count(*) AS paired_observations,
        {corr_sql("access_to_electricity_pct", "life_expectancy")} AS correlation
        FROM panel_typed WHERE access_to_electricity_pct IS NOT NULL AND life_expectancy IS NOT NULL""",
    "panel_typed",
)
def a17_paired_corr(i: Inputs):
    """Pairs and correlation of two measures."""
    return stats.paired_correlation(i.panel_typed, "access_to_electricity_pct", "life_expectancy")


@query(
    "a18_corr_by_year",
    f"""SELECT "year", count(*) AS paired_observations,
        {corr_sql("access_to_electricity_pct", "life_expectancy")} AS correlation
        FROM panel_typed WHERE access_to_electricity_pct IS NOT NULL AND life_expectancy IS NOT NULL
        GROUP BY "year" ORDER BY "year" """,
    "panel_typed",
)
def a18_corr_by_year(i: Inputs):
    """Pairs and correlation of two measures by year."""
    return stats.paired_correlation(
        i.panel_typed, "access_to_electricity_pct", "life_expectancy", ["year"]
    ).orderBy("year")


@query(
    "a18_corr_by_group_year",
    f"""SELECT income_group, "year", count(*) AS paired_observations,
        {corr_sql("access_to_electricity_pct", "life_expectancy")} AS correlation
        FROM panel_typed WHERE access_to_electricity_pct IS NOT NULL AND life_expectancy IS NOT NULL
        GROUP BY income_group, "year" """,
    "panel_typed",
)
def a18_corr_by_group_year(i: Inputs):
    """The same by income group and year; one group has a constant measure."""
    return stats.paired_correlation(
        i.panel_typed, "access_to_electricity_pct", "life_expectancy", ["income_group", "year"]
    )


@query(
    "a19_change_corr",
    f"""SELECT {corr_sql("life", "elec")} AS electricity_change_correlation,
        {corr_sql("life", "co2")} AS co2_change_correlation,
        {corr_sql("life", "unemp")} AS unemployment_change_correlation,
        {corr_sql("life", "gdp")} AS gdp_change_correlation FROM changes""",
    "changes",
)
def a19_change_corr(i: Inputs):
    """Correlation of one change with four others."""
    return stats.change_correlations(
        changes(i),
        "life_expectancy",
        {
            "electricity_change_correlation": "access_to_electricity_pct",
            "co2_change_correlation": "co2_emissions_per_capita",
            "unemployment_change_correlation": "unemployment_rate",
            "gdp_change_correlation": "gdp_per_capita",
        },
    )


@query(
    "a19_paired_change_corr",
    f"""SELECT count(*) AS paired_observations, {corr_sql("elec", "life")} AS correlation
        FROM changes WHERE elec IS NOT NULL AND life IS NOT NULL""",
    "changes",
)
def a19_paired_change_corr(i: Inputs):
    """Pairs and correlation of two changes."""
    return stats.paired_correlation(
        changes(i), "access_to_electricity_pct_change", "life_expectancy_change"
    )


@query(
    "j11_endpoint_change",
    """SELECT country_name, country_code, CAST(life AS DOUBLE) AS life_expectancy_change,
       CAST(elec AS DOUBLE) AS access_to_electricity_pct_change, CAST(co2 AS DOUBLE) AS co2_emissions_per_capita_change,
       CAST(unemp AS DOUBLE) AS unemployment_rate_change, CAST(round(gdp, 2) AS DOUBLE) AS gdp_per_capita_change
       FROM changes""",
    "changes",
)
def j11_endpoint_change(i: Inputs):
    """Changes between two years of every entity that has both."""
    rounded = F.round("gdp_per_capita_change", 2)
    return (
        changes(i)
        .withColumn("gdp_per_capita_change", rounded)
        .select("country_name", "country_code", *[f"{c}_change" for c in CHANGE_COLUMNS])
    )


@query(
    "o2_top_abs_change",
    """SELECT country_name, CAST(round(gdp, 2) AS DOUBLE) AS gdp_per_capita_change,
       CAST(round(life, 2) AS DOUBLE) AS life_expectancy_change
       FROM changes ORDER BY abs(gdp) DESC NULLS FIRST, country_code LIMIT 10""",
    "changes",
)
def o2_top_abs_change(i: Inputs):
    """Ten largest absolute changes of output per head."""
    top = stats.top_abs_change(changes(i), "gdp_per_capita_change", "country_code")
    return top.select(
        "country_name",
        F.round("gdp_per_capita_change", 2).alias("gdp_per_capita_change"),
        F.round("life_expectancy_change", 2).alias("life_expectancy_change"),
    )


@query(
    "o2_top_change_start",
    """SELECT country_name, CAST(life_start AS DOUBLE) AS life_expectancy_start,
       CAST(round(life, 2) AS DOUBLE) AS life_expectancy_change, CAST(round(gdp, 2) AS DOUBLE) AS gdp_per_capita_change
       FROM changes ORDER BY abs(gdp) DESC NULLS FIRST, country_code LIMIT 10""",
    "changes",
)
def o2_top_change_start(i: Inputs):
    """The same ten with their starting life expectancy."""
    top = stats.top_abs_change(changes(i), "gdp_per_capita_change", "country_code")
    return top.select(
        "country_name",
        "life_expectancy_start",
        F.round("life_expectancy_change", 2).alias("life_expectancy_change"),
        F.round("gdp_per_capita_change", 2).alias("gdp_per_capita_change"),
    )


def members(i: Inputs):
    """The member list of the dashboard sheets: every entity but those of one group."""
    return i.panel_dim.where(F.col("income_group") != "BUILDING").select("country_name")


@query(
    "a25_avg_change",
    f"""SELECT country_name, CAST(round(CAST(avg(life_expectancy) FILTER (WHERE "year" = {END})
          - avg(life_expectancy) FILTER (WHERE "year" = {START}) AS DECIMAL(38,8)), 4) AS DOUBLE) AS life_expectancy_change
        FROM panel_typed WHERE country_name IN (SELECT country_name FROM panel_dim WHERE income_group <> 'BUILDING')
        GROUP BY country_name ORDER BY 2 DESC NULLS LAST, 1""",
    "panel_typed panel_dim",
)
def a25_avg_change(i: Inputs):
    """Difference of conditional means per listed entity."""
    return stats.avg_change(
        i.panel_typed, "country_name", "year", START, END, "life_expectancy", members(i)
    )


def nullable_year(i: Inputs):
    """Analytic view whose partial last year counts as unknown, which sheets treat differently."""
    return analytic(i).withColumn("year", F.nullif(F.col("year"), F.lit(2001)))


define("nullable_year", 'SELECT * REPLACE (nullif("year", 2001) AS "year") FROM analytic', ["analytic"])


def register_scatter(name: str, x: str, require_x: bool) -> None:
    having = f"HAVING avg({x}) IS NOT NULL" if require_x else ""

    @query(
        name,
        f"""SELECT country_name, income_group, {mean_sql(x, 4)} AS avg_{x},
            {mean_sql("life_expectancy", 4)} AS avg_life_expectancy
            FROM nullable_year WHERE "year" = {END} OR "year" IS NULL GROUP BY country_name, income_group {having}""",
        "nullable_year",
    )
    def build(i: Inputs):
        """Mean of two measures per entity in one year, rows without a year included."""
        return stats.scatter(
            nullable_year(i), "year", END, ["country_name", "income_group"], x, "life_expectancy", require_x
        )


register_scatter("a26_scatter", "gdp_per_capita", False)
register_scatter("a26_scatter_having", "co2_emissions_per_capita", True)
register_scatter("a26_scatter_electricity", "access_to_electricity_pct", False)
register_scatter("a26_scatter_unemployment", "unemployment_rate", False)


def fit_sql(x: str, y: str) -> str:
    x, y = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    parts = [f"regr_count({y}, {x}) AS pairs"]
    for f, alias in (("slope", "slope"), ("intercept", "intercept"), ("r2", "r_squared")):
        parts.append(
            f"CAST(CASE WHEN regr_sxx({y}, {x}) > 0 THEN "
            f"round(CAST(regr_{f}({y}, {x}) AS DECIMAL(38,10)), 6) END AS DOUBLE) AS {alias}"
        )
    return ", ".join(parts)


@query(
    "a27_linear_fit",
    f"""SELECT {fit_sql("avg_x", "avg_y")} FROM (
        SELECT avg(co2_emissions_per_capita) AS avg_x, avg(life_expectancy) AS avg_y FROM nullable_year
        WHERE "year" = {END} OR "year" IS NULL GROUP BY country_name, income_group)""",
    "nullable_year",
)
def a27_linear_fit(i: Inputs):
    """Trend line through the scatter points, pooled over groups."""
    points = stats.scatter(
        nullable_year(i), "year", END, ["country_name", "income_group"], "co2_emissions_per_capita", "life_expectancy"
    )
    return stats.linear_fit(points, "avg_co2_emissions_per_capita", "avg_life_expectancy")


@query(
    "a27_linear_fit_by_group",
    f"""SELECT income_group, {fit_sql("access_to_electricity_pct", "life_expectancy")}
        FROM panel_typed GROUP BY income_group""",
    "panel_typed",
)
def a27_linear_fit_by_group(i: Inputs):
    """Trend line per group; the group with a constant measure has none."""
    return stats.linear_fit(i.panel_typed, "access_to_electricity_pct", "life_expectancy", ["income_group"])


PROFILE = [
    "access_to_electricity_pct",
    "co2_emissions_per_capita",
    "gdp_per_capita",
    "life_expectancy",
    "unemployment_rate",
]


@query(
    "a28_profile_matrix",
    " UNION ALL ".join(
        f"""SELECT income_group, '{c}' AS measure, {mean_sql(c, 4)} AS average
            FROM nullable_year WHERE "year" = {END} GROUP BY income_group"""
        for c in PROFILE
    ),
    "nullable_year",
)
def a28_profile_matrix(i: Inputs):
    """Mean of five measures by group in one year."""
    return stats.profile_matrix(nullable_year(i), "income_group", PROFILE, "year", END)


@query(
    "a29_series",
    f"""SELECT "year", income_group, {mean_sql("life_expectancy", 4)} AS avg_life_expectancy FROM panel_typed
        WHERE country_name IN (SELECT country_name FROM panel_dim WHERE income_group <> 'BUILDING')
        GROUP BY "year", income_group ORDER BY 1, 2""",
    "panel_typed panel_dim",
)
def a29_series(i: Inputs):
    """Mean of a measure by year and group for listed entities."""
    return stats.series(
        i.panel_typed, "year", "income_group", "life_expectancy", "country_name", members(i)
    )


@query(
    "a30_rank_list",
    f"""SELECT country_name, {mean_sql("life_expectancy", 4)} AS avg_life_expectancy
        FROM panel_typed GROUP BY country_name ORDER BY 2 DESC NULLS LAST, 1""",
    "panel_typed",
)
def a30_rank_list(i: Inputs):
    """Entities by mean of a measure."""
    return stats.rank_list(i.panel_typed, "country_name", "life_expectancy")


@query(
    "a31_sum_attr",
    """SELECT country_code, CASE WHEN min(country_name) = max(country_name) THEN min(country_name)
         WHEN min(country_name) IS NOT NULL THEN '*' END AS country_name,
       CAST(sum(round(elec, 2)) AS DOUBLE) AS sum_electricity_change_pp,
       CAST(sum(round(life, 2)) AS DOUBLE) AS sum_life_expectancy_change_years FROM changes GROUP BY country_code""",
    "changes",
)
def a31_sum_attr(i: Inputs):
    """Sums of the change report per code, with the single name."""
    report = views.change_report(i.panel_typed, START, END)
    return stats.sum_by(
        report, "country_code", ["electricity_change_pp", "life_expectancy_change_years"], "country_name"
    )


@query(
    "a31_sum_attr_region",
    """SELECT region, CASE WHEN min(income_group) = max(income_group) THEN min(income_group)
         WHEN min(income_group) IS NOT NULL THEN '*' END AS income_group,
       CAST(sum(life_expectancy) AS DOUBLE) AS sum_life_expectancy FROM panel_typed GROUP BY region""",
    "panel_typed",
)
def a31_sum_attr_region(i: Inputs):
    """Sums per region, where the attribute has several values and gets the marker."""
    return stats.sum_by(i.panel_typed, "region", ["life_expectancy"], "income_group")


@query(
    "f_math",
    """SELECT country_code, "year", CAST(round(CAST(life_expectancy / 3 AS DECIMAL(38,8)), 2) AS DOUBLE) AS third,
       CASE WHEN gdp_usd > 0 THEN CAST(round(CAST(ln(CAST(gdp_usd AS DOUBLE)) AS DECIMAL(38,8)), 4) AS DOUBLE) END AS ln_gdp,
       CAST(abs(life_expectancy - 50) AS DOUBLE) AS distance, life_expectancy <> floor(life_expectancy) AS fractional,
       CAST(round(CAST(gdp_usd / nullif(access_to_electricity_pct, 0) AS DECIMAL(38,8)), 2) AS DOUBLE) AS ratio
       FROM panel_typed""",
    "panel_typed",
)
def f_math(i: Inputs):
    """Rounding, logarithm, absolute value, integer test, safe division."""
    from panelmill.functions.numeric import round_dec, safe_ln, safe_ratio

    life = F.col("life_expectancy")
    return i.panel_typed.select(
        "country_code",
        "year",
        F.round(life.cast("decimal(38,10)") / 3, 2).alias("third"),
        safe_ln("gdp_usd").alias("ln_gdp"),
        F.abs(life - 50).alias("distance"),
        (life != F.floor(life)).alias("fractional"),
        round_dec(safe_ratio("gdp_usd", "access_to_electricity_pct"), 2).alias("ratio"),
    )


@query(
    "a22_null_rates",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name,
            CAST(round(CAST(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) AS DECIMAL(38,8)), 1) AS DOUBLE) AS null_pct
            FROM panel_typed"""
        for c in fixed.INDICATORS
    ),
    "panel_typed",
)
def a22_null_rates(i: Inputs):
    """NULL rate of every indicator."""
    return stats.null_rates(i.panel_typed, fixed.INDICATORS)


@query(
    "a21_bool_and",
    f"""SELECT coalesce(bool_and(coalesce("year" >= {FIRST_YEAR} AND gdp_usd > 0, FALSE)), FALSE) AS all_passed
        FROM panel_typed""",
    "panel_typed",
)
def a21_bool_and(i: Inputs):
    """Whether a condition holds on all rows; an unknown result fails it."""
    return stats.all_pass(i.panel_typed, (F.col("year") >= FIRST_YEAR) & (F.col("gdp_usd") > 0))


@query(
    "a26_group_means",
    f"""SELECT region, income_group, count(*) AS records, {mean_sql("life_expectancy", 4)} AS avg_life_expectancy
        FROM panel_typed GROUP BY region, income_group""",
    "panel_typed",
)
def a26_group_means(i: Inputs):
    """Record count and a mean by two dimensions."""
    means = {"avg_life_expectancy": mean_dec("life_expectancy", 4)}
    return stats.group_means(i.panel_typed, ["region", "income_group"], means, "records")
