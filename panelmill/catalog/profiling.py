"""Queries that profile the raw text panel and match it with the dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.catalog.base import query
from panelmill.catalog.inputs import FIRST_YEAR, LAST_YEAR, Inputs
from panelmill.functions import text
from panelmill.operators import dedup, joins, profile, stats

RAW = "panel_raw"
BOTH = "panel_raw panel_dim"


def t(column: str) -> str:
    """Check SQL for text without outer spaces."""
    return f"trim({column}, ' ')"


def nb(column: str) -> str:
    """Check SQL for trimmed text with blank as NULL."""
    return f"nullif({t(column)}, '')"


INDICATOR_LIST = ", ".join(f"'{c}'" for c in fixed.INDICATORS)


def unpivot_sql(columns: list[str], ids: str, value: str = "raw_value", source: str = RAW) -> str:
    return " UNION ALL ".join(
        f"""SELECT {ids}, '{c}' AS column_name, "{c}" AS {value} FROM {source}""" for c in columns
    )


# --- text predicates -------------------------------------------------------------------------


@query("p1_blank_to_null", f"SELECT raw_record_id, {nb('region')} AS region, {nb('population')} AS population FROM panel_raw", RAW)
def p1_blank_to_null(i: Inputs):
    """Trimmed text with blank as NULL."""
    return i.panel_raw.select(
        "raw_record_id",
        text.blank_to_null("region").alias("region"),
        text.blank_to_null("population").alias("population"),
    )


@query(
    "p2_distinct_from",
    f"SELECT raw_record_id, {nb('region')} IS DISTINCT FROM {nb('income_group')} AS differs, "
    f"{nb('population')} IS DISTINCT FROM {nb('region')} AS differs_null FROM panel_raw",
    RAW,
)
def p2_distinct_from(i: Inputs):
    """NULL-safe inequality."""
    b = text.blank_to_null
    return i.panel_raw.select(
        "raw_record_id",
        text.distinct_from(b("region"), b("income_group")).alias("differs"),
        text.distinct_from(b("population"), b("region")).alias("differs_null"),
    )


@query(
    "p3_regex_class",
    f"""SELECT raw_record_id, regexp_full_match({t('"year"')}, '[0-9]{{4}}') AS plain_year,
        regexp_full_match({t('"year"')}, 'FY[0-9]{{4}}') AS fiscal_year,
        regexp_full_match({t('"year"')}, '[0-9]{{4}}\\.0') AS float_year,
        NOT regexp_full_match({t('gdp_usd')}, '-?[0-9]+([.][0-9]+)?') AS odd_gdp FROM panel_raw""",
    RAW,
)
def p3_regex_class(i: Inputs):
    """Anchored pattern tests."""
    year = text.trimmed("year")
    return i.panel_raw.select(
        "raw_record_id",
        text.matches(year, fixed.YEAR_PLAIN).alias("plain_year"),
        text.matches(year, fixed.YEAR_FISCAL).alias("fiscal_year"),
        text.matches(year, fixed.YEAR_FLOAT).alias("float_year"),
        (~text.matches(text.trimmed("gdp_usd"), fixed.NUMBER_PLAIN)).alias("odd_gdp"),
    )


@query(
    "p4_guarded_cast",
    f"""SELECT raw_record_id,
        CASE WHEN regexp_full_match({t('"year"')}, '[0-9]{{4}}')
             THEN TRY_CAST({t('"year"')} AS INTEGER) NOT BETWEEN {FIRST_YEAR} AND {LAST_YEAR} ELSE TRUE END AS bad_year
        FROM panel_raw""",
    RAW,
)
def p4_guarded_cast(i: Inputs):
    """Format test before a cast inside a predicate."""
    bad = text.guarded(
        text.trimmed("year"), fixed.YEAR_PLAIN, "int", lambda y: ~y.between(FIRST_YEAR, LAST_YEAR), True
    )
    return i.panel_raw.select("raw_record_id", bad.alias("bad_year"))


@query(
    "p6_text_range",
    f"""SELECT raw_record_id, {t('"year"')} AS year_text FROM panel_raw
        WHERE regexp_full_match({t('"year"')}, '[0-9]{{4}}') AND {t('"year"')} NOT BETWEEN '{FIRST_YEAR}' AND '{LAST_YEAR}'""",
    RAW,
)
def p6_text_range(i: Inputs):
    """Range test on text after a format test."""
    year = text.trimmed("year")
    outside = text.matches(year, fixed.YEAR_PLAIN) & ~year.between(str(FIRST_YEAR), str(LAST_YEAR))
    return i.panel_raw.where(outside).select("raw_record_id", year.alias("year_text"))


@query(
    "p7_membership",
    f"""SELECT raw_record_id, country_code IS NULL OR country_code NOT IN (SELECT country_code FROM panel_dim) AS code_unknown,
        upper({t('country_code')}) IN ('EUU', 'WLD') AS is_aggregate FROM panel_raw""",
    BOTH,
)
def p7_membership(i: Inputs):
    """Membership in a dimension and in a literal list."""
    known = i.panel_dim.select(F.col("country_code").alias("known"))
    return i.panel_raw.join(known, F.col("country_code") == F.col("known"), "left").select(
        "raw_record_id",
        F.col("known").isNull().alias("code_unknown"),
        F.upper(text.trimmed("country_code")).isin(fixed.AGGREGATE_CODES).alias("is_aggregate"),
    )


NUMERIC_SQL = r"\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*"
FINITE_SQL = "('nan', 'infinity', '+infinity', '-infinity', 'inf', '+inf', '-inf')"
STAMP_SQL = r"\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?\s*"


def valid_sql(c: str, kind: str) -> str:
    if kind == "integer":
        return rf"(regexp_full_match({c}, '\s*[+-]?[0-9]+\s*') AND TRY_CAST({t(c)} AS INTEGER) IS NOT NULL)"
    if kind == "numeric":
        return f"(regexp_full_match({c}, '{NUMERIC_SQL}') OR lower({t(c)}) IN {FINITE_SQL})"
    return (
        f"((regexp_full_match({c}, '{STAMP_SQL}') AND TRY_CAST({t(c)} AS TIMESTAMP) IS NOT NULL) "
        f"OR lower({t(c)}) IN ('infinity', '-infinity'))"
    )


@query(
    "p8_input_valid",
    f"""SELECT raw_record_id, {valid_sql('"year"', 'integer')} AS year_ok, {valid_sql('gdp_usd', 'numeric')} AS gdp_ok,
        {valid_sql('unemployment_rate', 'numeric')} AS unemployment_ok,
        {valid_sql('ingested_at', 'timestamp')} AS stamp_ok, {valid_sql('source_file', 'timestamp')} AS source_as_stamp
        FROM panel_raw""",
    RAW,
)
def p8_input_valid(i: Inputs):
    """Whether text is valid input for a type."""
    return i.panel_raw.select(
        "raw_record_id",
        text.is_valid("year", "integer").alias("year_ok"),
        text.is_valid("gdp_usd", "numeric").alias("gdp_ok"),
        text.is_valid("unemployment_rate", "numeric").alias("unemployment_ok"),
        text.is_valid("ingested_at", "timestamp").alias("stamp_ok"),
        text.is_valid("source_file", "timestamp").alias("source_as_stamp"),
    )


@query(
    "p10_pick_column",
    """SELECT raw_record_id, column_name, CASE column_name WHEN 'life_expectancy' THEN life_expectancy
         WHEN 'gdp_usd' THEN gdp_usd END AS picked
       FROM (SELECT *, CASE WHEN source_file = 'extract_2025Q1.csv' THEN 'life_expectancy' ELSE 'gdp_usd' END AS column_name
             FROM panel_raw)""",
    RAW,
)
def p10_pick_column(i: Inputs):
    """Column chosen by a value of the row."""
    name = F.when(F.col("source_file") == "extract_2025Q1.csv", F.lit("life_expectancy")).otherwise(F.lit("gdp_usd"))
    named = i.panel_raw.withColumn("column_name", name)
    return named.select(
        "raw_record_id", "column_name", text.pick("column_name", ["life_expectancy", "gdp_usd"]).alias("picked")
    )


@query(
    "p11_passed",
    f"""SELECT raw_record_id, coalesce(TRY_CAST(CASE WHEN regexp_full_match({t('life_expectancy')}, '-?[0-9]+([.][0-9]+)?')
          THEN {t('life_expectancy')} END AS DECIMAL(38,15)) <= 120, FALSE) AS passed FROM panel_raw""",
    RAW,
)
def p11_passed(i: Inputs):
    """Unknown counts as not passed."""
    value = text.clean_numeric("life_expectancy")
    return i.panel_raw.select("raw_record_id", text.passed(value <= 120).alias("passed"))


@query(
    "p13_key_inspect",
    f"""SELECT raw_record_id, country_code, "year", gdp_usd, source_file FROM panel_raw r
        WHERE EXISTS (SELECT 1 FROM fixes f WHERE f.country_code = {t('r.country_code')} AND f."year" = {t('r."year"')})""",
    "panel_raw fixes",
)
def p13_key_inspect(i: Inputs):
    """Records of listed keys."""
    return joins.rows_for_keys(i.panel_raw, i.documented_fixes).select(
        "raw_record_id", "country_code", "year", "gdp_usd", "source_file"
    )


@query("f1_trim", f"SELECT raw_record_id, {t('country_name')} AS name, {t('country_code')} AS code FROM panel_raw", RAW)
def f1_trim(i: Inputs):
    """Text without outer spaces."""
    return i.panel_raw.select(
        "raw_record_id", text.trimmed("country_name").alias("name"), F.trim("country_code").alias("code")
    )


@query(
    "f_strings",
    f"""SELECT raw_record_id, upper({t('country_code')}) AS up, lower(country_name) AS low, left(country_name, 3) AS head,
        right({t('"year"')}, 4) AS tail, split_part({t('"year"')}, '.', 1) AS part,
        replace(replace(gdp_usd, '$', ''), ',', '') AS bare,
        concat_ws(' | ', {nb('country_name')}, {nb('region')}, {nb('income_group')}) AS joined FROM panel_raw""",
    RAW,
)
def f_strings(i: Inputs):
    """Case, parts, replacement, joining."""
    year = text.trimmed("year")
    return i.panel_raw.select(
        "raw_record_id",
        F.upper(text.trimmed("country_code")).alias("up"),
        F.lower("country_name").alias("low"),
        F.left("country_name", F.lit(3)).alias("head"),
        F.right(year, F.lit(4)).alias("tail"),
        F.split_part(year, F.lit("."), F.lit(1)).alias("part"),
        F.replace(F.replace("gdp_usd", F.lit("$"), F.lit("")), F.lit(","), F.lit("")).alias("bare"),
        F.concat_ws(" | ", *[text.blank_to_null(c) for c in fixed.DIM_ATTRIBUTES]).alias("joined"),
    )


@query(
    "f_nulls",
    f"""SELECT raw_record_id, nullif(gdp_usd, 'NULL') AS gdp, coalesce({nb('region')}, {nb('population')}, 'none') AS shown,
        coalesce({nb('population')}, '[missing]') AS population FROM panel_raw""",
    RAW,
)
def f_nulls(i: Inputs):
    """NULLIF and COALESCE."""
    b = text.blank_to_null
    return i.panel_raw.select(
        "raw_record_id",
        F.nullif(F.col("gdp_usd"), F.lit("NULL")).alias("gdp"),
        F.coalesce(b("region"), b("population"), F.lit("none")).alias("shown"),
        F.coalesce(b("population"), F.lit(fixed.MISSING_MARK)).alias("population"),
    )


# --- dimension joins -------------------------------------------------------------------------


@query(
    "j1_inner_dim",
    f"""SELECT r.raw_record_id, d.country_code, d.country_name AS expected_country_name, d.region AS expected_region
        FROM panel_raw r JOIN panel_dim d ON {t('r.country_code')} = d.country_code""",
    BOTH,
)
def j1_inner_dim(i: Inputs):
    """Records whose trimmed code is in the dimension."""
    return joins.join_dim(i.panel_raw, i.panel_dim).select(
        "raw_record_id",
        F.col("expected_country_code").alias("country_code"),
        "expected_country_name",
        "expected_region",
    )


@query(
    "j2_orphans",
    f"""SELECT r.raw_record_id, r.country_code, r.country_name FROM panel_raw r
        LEFT JOIN panel_dim d ON {nb('r.country_code')} = d.country_code WHERE d.country_code IS NULL""",
    BOTH,
)
def j2_orphans(i: Inputs):
    """Records whose code is not in the dimension."""
    return joins.orphans(i.panel_raw, i.panel_dim).select("raw_record_id", "country_code", "country_name")


@query(
    "j3_two_way",
    f"""SELECT r.raw_record_id, c.country_code AS code_by_code, n.country_code AS code_by_name FROM panel_raw r
        LEFT JOIN panel_dim c ON {t('r.country_code')} = c.country_code
        LEFT JOIN panel_dim n ON {t('r.country_name')} = n.country_name""",
    BOTH,
)
def j3_two_way(i: Inputs):
    """Dimension codes by code and by name."""
    return joins.resolve_two_ways(i.panel_raw, i.panel_dim).select(
        "raw_record_id", "code_by_code", "code_by_name"
    )


ENTITY_CLASS = f"""SELECT r.raw_record_id, {nb('r.country_code')} AS raw_country_code, {nb('r.country_name')} AS raw_country_name,
        {nb('r."year"')} AS raw_year, n.country_code AS expected_country_code,
        CASE WHEN upper({t('r.country_code')}) IN ('EUU', 'WLD') THEN 'aggregate entity'
             WHEN n.country_code IS NOT NULL THEN 'country-code mismatch'
             ELSE 'outside approved reference scope' END AS issue_type
        FROM panel_raw r LEFT JOIN panel_dim c ON {t('r.country_code')} = c.country_code
        LEFT JOIN panel_dim n ON {t('r.country_name')} = n.country_name WHERE c.country_code IS NULL"""


@query("d15_entity_class", ENTITY_CLASS, BOTH)
def d15_entity_class(i: Inputs):
    """Why a code is not in the dimension."""
    return joins.classify_entities(i.panel_raw, i.panel_dim)


@query("p9_classify", f"SELECT issue_type, count(*) AS records FROM ({ENTITY_CLASS}) GROUP BY issue_type", BOTH)
def p9_classify(i: Inputs):
    """Records per class of unknown code."""
    classes = joins.classify_entities(i.panel_raw, i.panel_dim)
    return classes.groupBy("issue_type").agg(F.count("*").alias("records"))


@query(
    "j4_anti_or",
    f"""SELECT r.raw_record_id, r.country_code, r.country_name FROM panel_raw r WHERE NOT EXISTS (
          SELECT 1 FROM panel_dim d WHERE d.country_code = upper({t('r.country_code')}) OR d.country_name = {t('r.country_name')})""",
    BOTH,
)
def j4_anti_or(i: Inputs):
    """Records matching neither by code nor by name."""
    return joins.outside_scope(i.panel_raw, i.panel_dim).select("raw_record_id", "country_code", "country_name")


@query(
    "j5_match_either",
    f"""SELECT r.raw_record_id, coalesce(n.country_code, c.country_code) AS matched_code,
        coalesce(n.country_name, c.country_name) AS matched_name FROM panel_raw r
        LEFT JOIN panel_dim c ON c.country_code = upper({t('r.country_code')})
        LEFT JOIN panel_dim n ON n.country_name = {t('r.country_name')}
        WHERE c.country_code IS NOT NULL OR n.country_code IS NOT NULL""",
    BOTH,
)
def j5_match_either(i: Inputs):
    """One dimension row by name, else by code."""
    return joins.match_either(i.panel_raw, i.panel_dim).select(
        "raw_record_id",
        F.col("matched.country_code").alias("matched_code"),
        F.col("matched.country_name").alias("matched_name"),
    )


@query(
    "j9_conformance",
    """SELECT r.raw_record_id, r.country_code, r.country_name, r.region, r.income_group FROM panel_raw r
       LEFT JOIN panel_dim d ON r.country_code = d.country_code
       WHERE d.country_code IS NULL OR r.country_name IS DISTINCT FROM d.country_name
          OR r.region IS DISTINCT FROM d.region OR r.income_group IS DISTINCT FROM d.income_group""",
    BOTH,
)
def j9_conformance(i: Inputs):
    """Records that do not conform to the dimension."""
    return joins.conformance_violations(i.panel_raw, i.panel_dim).select(
        "raw_record_id", "country_code", "country_name", "region", "income_group"
    )


@query(
    "j13_unpivot",
    unpivot_sql(fixed.INDICATORS, "raw_record_id"),
    RAW,
)
def j13_unpivot(i: Inputs):
    """Indicators as rows."""
    return profile.unpivot_values(i.panel_raw, ["raw_record_id"], fixed.INDICATORS)


# --- profiles --------------------------------------------------------------------------------


@query(
    "a1_baseline",
    f"""SELECT count(*) AS raw_row_count, count(DISTINCT raw_record_id) AS unique_raw_ids,
        count(DISTINCT {nb('country_code')}) AS distinct_country_codes,
        count(DISTINCT {nb('country_name')}) AS distinct_country_names,
        count(*) FILTER (WHERE ingested_at IS NULL) AS missing_ingestion_stamps FROM panel_raw""",
    RAW,
)
def a1_baseline(i: Inputs):
    """Baseline counts of the raw panel."""
    return stats.baseline(
        i.panel_raw,
        "raw_record_id",
        {"distinct_country_codes": "country_code", "distinct_country_names": "country_name"},
        {"missing_ingestion_stamps": "ingested_at"},
    )


@query(
    "a1_dimension",
    """SELECT count(*) AS reference_row_count, count(DISTINCT country_code) AS unique_country_codes,
       count(DISTINCT country_name) AS unique_country_names FROM panel_dim""",
    "panel_dim",
)
def a1_dimension(i: Inputs):
    """Baseline counts of the dimension."""
    return i.panel_dim.agg(
        F.count("*").alias("reference_row_count"),
        F.count_distinct("country_code").alias("unique_country_codes"),
        F.count_distinct("country_name").alias("unique_country_names"),
    )


@query(
    "a2_key_uniqueness",
    """SELECT count(*) AS total_rows, count(DISTINCT raw_record_id) AS unique_record_ids,
       count(DISTINCT (country_code, "year")) AS unique_country_years,
       count(*) = count(DISTINCT raw_record_id) AND count(*) = count(DISTINCT (country_code, "year")) AS passed
       FROM panel_raw""",
    RAW,
)
def a2_key_uniqueness(i: Inputs):
    """Rows against distinct ids and keys."""
    return profile.key_uniqueness(i.panel_raw, "raw_record_id", ["country_code", "year"])


@query(
    "a3_null_counts",
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in fixed.INDICATORS) + " FROM panel_typed",
    "panel_typed",
)
def a3_null_counts(i: Inputs):
    """NULL values per indicator of the typed panel."""
    return profile.null_counts(i.panel_typed, fixed.INDICATORS)


@query(
    "a4_blank_counts",
    "SELECT " + ", ".join(f"count(*) - count({nb(c)}) AS missing_{c}" for c in fixed.INDICATORS) + " FROM panel_raw",
    RAW,
)
def a4_blank_counts(i: Inputs):
    """Missing values per indicator by difference."""
    return profile.blank_counts(i.panel_raw, fixed.INDICATORS)


MISSING = f"""SELECT * FROM ({unpivot_sql(fixed.SOURCE_COLUMNS, 'raw_record_id')}) WHERE {nb('raw_value')} IS NULL"""


@query(
    "a5_missing_by_column",
    f"SELECT column_name, count(*) AS missing_or_blank_count FROM ({MISSING}) GROUP BY column_name",
    RAW,
)
def a5_missing_by_column(i: Inputs):
    """Missing values per source column."""
    return profile.missing_by_column(i.panel_raw, fixed.SOURCE_COLUMNS)


@query(
    "a6_missing_by_record",
    "SELECT raw_record_id, country_code, country_name, \"year\", missing_columns FROM (SELECT *, concat_ws(', ', "
    + ", ".join(f"""CASE WHEN {nb(f'"{c}"')} IS NULL THEN '{c}' END""" for c in fixed.SOURCE_COLUMNS)
    + ") AS missing_columns FROM panel_raw) WHERE missing_columns <> ''",
    RAW,
)
def a6_missing_by_record(i: Inputs):
    """Missing columns per record."""
    ids = ["raw_record_id", "country_code", "country_name", "year"]
    return profile.missing_by_record(i.panel_raw, ids, fixed.SOURCE_COLUMNS)


def register_mismatch(name: str, attribute: str) -> None:
    named = attribute == "country_name"
    years = f", min({nb('r.\"year\"')}) AS first_year, max({nb('r.\"year\"')}) AS last_year" if named else ""
    other = "" if named else "d.country_name, "
    group_other = "" if named else ", d.country_name"

    @query(
        name,
        f"""SELECT {t('r.country_code')} AS country_code, {other}{nb(f'r.{attribute}')} AS raw_{attribute},
            d.{attribute} AS expected_{attribute}, count(*) AS row_count{years}
            FROM panel_raw r JOIN panel_dim d ON {t('r.country_code')} = d.country_code
            WHERE {nb(f'r.{attribute}')} IS DISTINCT FROM d.{attribute}
            GROUP BY {t('r.country_code')}, {nb(f'r.{attribute}')}, d.{attribute}{group_other}""",
        BOTH,
    )
    def build(i: Inputs):
        """Codes whose attribute differs from the dimension."""
        return joins.attribute_mismatches(i.panel_raw, i.panel_dim, attribute)


register_mismatch("a7_name_mismatch", "country_name")
register_mismatch("a7_region_mismatch", "region")
register_mismatch("a7_group_mismatch", "income_group")


@query(
    "a8_orphan_summary",
    f"""SELECT {nb('r.country_code')} AS country_code, {nb('r.country_name')} AS country_name, count(*) AS row_count,
        min({nb('r."year"')}) AS first_year, max({nb('r."year"')}) AS last_year
        FROM panel_raw r LEFT JOIN panel_dim d ON {nb('r.country_code')} = d.country_code
        WHERE d.country_code IS NULL GROUP BY 1, 2""",
    BOTH,
)
def a8_orphan_summary(i: Inputs):
    """Unknown codes with counts and years."""
    return joins.orphan_summary(i.panel_raw, i.panel_dim)


ALL_COLUMNS = ", ".join(f'"{c}"' for c in fixed.SOURCE_COLUMNS)


@query(
    "a9_exact_dups",
    f"""SELECT country_code, country_name, "year", count(*) AS duplicate_count, min(raw_record_id) AS first_record_id,
        max(raw_record_id) AS last_record_id FROM panel_raw GROUP BY {ALL_COLUMNS} HAVING count(*) > 1""",
    RAW,
)
def a9_exact_dups(i: Inputs):
    """Groups of identical records."""
    return dedup.exact_duplicates(i.panel_raw, fixed.SOURCE_COLUMNS, "raw_record_id").select(
        "country_code", "country_name", "year", "duplicate_count", "first_record_id", "last_record_id"
    )


@query(
    "a9_exact_dup_members",
    f"""SELECT country_code, country_name, "year", n AS duplicate_count, lowest AS first_record_id, raw_record_id FROM (
          SELECT *, count(*) OVER (PARTITION BY {ALL_COLUMNS}) AS n,
                 min(raw_record_id) OVER (PARTITION BY {ALL_COLUMNS}) AS lowest FROM panel_raw) WHERE n > 1""",
    RAW,
)
def a9_exact_dup_members(i: Inputs):
    """Records of groups of identical records."""
    members = dedup.exact_duplicate_members(i.panel_raw, fixed.SOURCE_COLUMNS, "raw_record_id")
    return members.select(
        "country_code", "country_name", "year", "duplicate_count", "first_record_id", "raw_record_id"
    )


KEYS = f"""SELECT raw_record_id, {nb('country_code')} AS country_code, {nb('"year"')} AS "year",
           {nb('country_name')} AS country_name FROM panel_raw"""


@query(
    "a10_key_dups",
    f"""SELECT country_code, "year", count(*) AS record_count, count(DISTINCT country_name) AS name_count,
        min(raw_record_id) AS first_record_id, max(raw_record_id) AS last_record_id
        FROM ({KEYS}) GROUP BY country_code, "year" HAVING count(*) > 1""",
    RAW,
)
def a10_key_dups(i: Inputs):
    """Keys with several records."""
    return dedup.key_duplicates(i.panel_raw, ["country_code", "year"], "country_name", "raw_record_id")


@query(
    "a10_key_dup_names",
    f"""SELECT country_code, "year", country_name, records, record_count FROM (
          SELECT country_code, "year", country_name, count(*) AS records,
                 CAST(sum(count(*)) OVER (PARTITION BY country_code, "year") AS BIGINT) AS record_count
          FROM ({KEYS}) GROUP BY country_code, "year", country_name)
        WHERE record_count > 1 AND country_name IS NOT NULL""",
    RAW,
)
def a10_key_dup_names(i: Inputs):
    """Distinct names of duplicated keys."""
    return dedup.key_duplicate_names(i.panel_raw, ["country_code", "year"], "country_name", "raw_record_id")


@query(
    "a10_key_dup_members",
    f"""SELECT raw_record_id, country_code, "year", n AS record_count FROM (
          SELECT *, count(*) OVER (PARTITION BY country_code, "year") AS n FROM ({KEYS})) WHERE n > 1""",
    RAW,
)
def a10_key_dup_members(i: Inputs):
    """Records of duplicated keys."""
    return dedup.key_duplicate_members(i.panel_raw, ["country_code", "year"], "country_name", "raw_record_id")


@query(
    "a11_dup_keys",
    'SELECT country_code, "year", count(*) AS occurrences FROM panel_raw GROUP BY country_code, "year" HAVING count(*) > 1',
    RAW,
)
def a11_dup_keys(i: Inputs):
    """Keys that occur more than once."""
    return dedup.dup_keys(i.panel_raw, ["country_code", "year"])


@query("a12_source_counts", "SELECT source_file, count(*) AS rows_from_source FROM panel_raw GROUP BY source_file", RAW)
def a12_source_counts(i: Inputs):
    """Records per source."""
    return profile.source_counts(i.panel_raw)


@query(
    "d12_year_profile",
    f"""SELECT raw_record_id, country_code, country_name, "year" AS raw_year,
        CASE WHEN {nb('"year"')} IS NULL THEN 'missing year'
             WHEN NOT regexp_full_match({t('"year"')}, '[0-9]{{4}}') THEN 'invalid year format'
             ELSE 'outside {FIRST_YEAR}-{LAST_YEAR} range' END AS issue_type
        FROM panel_raw WHERE CASE WHEN regexp_full_match({nb('"year"')}, '[0-9]{{4}}')
             THEN TRY_CAST({t('"year"')} AS INTEGER) NOT BETWEEN {FIRST_YEAR} AND {LAST_YEAR} ELSE TRUE END""",
    RAW,
)
def d12_year_profile(i: Inputs):
    """Records with an odd year."""
    return profile.year_issues(i.panel_raw, FIRST_YEAR, LAST_YEAR)


IDS = ["raw_record_id", "country_code", "country_name", "year"]
IDS_SQL = 'raw_record_id, country_code, country_name, "year"'


@query(
    "d13_non_numeric",
    f"""SELECT {IDS_SQL}, column_name, {t('raw_value')} AS raw_value FROM ({unpivot_sql(fixed.INDICATORS, IDS_SQL)})
        WHERE {nb('raw_value')} IS NOT NULL AND NOT regexp_full_match({t('raw_value')}, '[+-]?[0-9]+([.][0-9]+)?')""",
    RAW,
)
def d13_non_numeric(i: Inputs):
    """Indicator values that are no plain numbers."""
    return profile.non_numeric(i.panel_raw, IDS, fixed.INDICATORS)


def bounds_sql(column: str, position: int) -> str:
    cases = " ".join(
        f"WHEN '{c}' THEN {b[position]}" for c, b in fixed.BOUNDS.items() if b[position] is not None
    )
    return f"CAST(CASE {column} {cases} END AS INTEGER)"


@query(
    "d14_range_profile",
    f"""SELECT * FROM (SELECT {IDS_SQL}, column_name, {t('raw_value')} AS raw_value,
          {bounds_sql('column_name', 0)} AS minimum_allowed, {bounds_sql('column_name', 1)} AS maximum_allowed
        FROM ({unpivot_sql(fixed.INDICATORS, IDS_SQL)}))
        WHERE CASE WHEN regexp_full_match(raw_value, '[+-]?[0-9]+([.][0-9]+)?')
          THEN TRY_CAST(raw_value AS DECIMAL(38,15)) < minimum_allowed
               OR coalesce(TRY_CAST(raw_value AS DECIMAL(38,15)) > maximum_allowed, FALSE) ELSE FALSE END""",
    RAW,
)
def d14_range_profile(i: Inputs):
    """Plain numbers outside their bounds."""
    return profile.range_profile(i.panel_raw, IDS, fixed.BOUNDS)


@query(
    "d16_staging_checks",
    f"""SELECT raw_record_id, column_name, {t('raw_value')} AS raw_value
        FROM ({unpivot_sql(fixed.INDICATORS, 'raw_record_id')}) WHERE NOT {valid_sql('raw_value', 'numeric')}""",
    RAW,
)
def d16_staging_checks(i: Inputs):
    """Staged values that could not be cast."""
    return profile.inconvertible(i.panel_raw, ["raw_record_id"], fixed.INDICATORS)


# Bounds of staged values: open above but for percentages.
STAGING_BOUNDS = {
    "gdp_usd": (0, None),
    "unemployment_rate": (0, 100),
    "co2_emissions_per_capita": (0, None),
    "access_to_electricity_pct": (0, 100),
}


def dec_sql(c: str) -> str:
    number = r"\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)\s*"
    return f"(CASE WHEN regexp_full_match({c}, '{number}') THEN TRY_CAST({t(c)} AS DECIMAL(38,15)) END)"


@query(
    "d16_staging_ranges",
    f"""SELECT raw_record_id FROM panel_raw WHERE coalesce({dec_sql('gdp_usd')} < 0, FALSE)
        OR coalesce({dec_sql('population')} <= 0, FALSE) OR coalesce({dec_sql('life_expectancy')} <= 0, FALSE)
        OR coalesce({dec_sql('unemployment_rate')} NOT BETWEEN 0 AND 100, FALSE)
        OR coalesce({dec_sql('co2_emissions_per_capita')} < 0, FALSE)
        OR coalesce({dec_sql('access_to_electricity_pct')} NOT BETWEEN 0 AND 100, FALSE)""",
    RAW,
)
def d16_staging_ranges(i: Inputs):
    """Staged records with a value out of range."""
    return profile.staging_range_violations(
        i.panel_raw, STAGING_BOUNDS, ["population", "life_expectancy"]
    ).select("raw_record_id")
