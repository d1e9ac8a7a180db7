"""Panel-shaped inputs that Spark derives from the given tables, and the same inputs as SQL text.

``Inputs`` builds them with DataFrame operations; ``CTES`` holds the SQL the checks run.  Defects
are placed into every table by arithmetic on the order key, so both sides get the same ones.

A panel record is one order: entity = customer, period = order year, indicators = measures of its
lineitems.  Repeated orders of one customer and year are the conflicting duplicates.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.operators.inject import Copy, Defect, append_copies, apply_defects
from panelmill.operators.skew import shuffled
from panelmill.session import stage, tune

FIRST_YEAR, LAST_YEAR = 1995, 2001  # accepted period (the last year is partial)
START, END = 1995, 2000  # endpoints of change analyses
# The kinds of defects (the strings in the rules below) and these odd values are those of
# the data the detectors were made for.
ODD_LIFE, ODD_RATE, ODD_SHARE, ODD_YEAR = "187.4", "652.0", "102.5", "1899"
CODE_PATTERN = r"^C[0-9]{9}\z"
RATE_FIXED = "unemployment_rate_corrected"
DUPLICATE_OFFSET, ORPHAN_OFFSET = 1_000_000_000, 2_000_000_000


CODE = "concat('C', lpad(CAST({} AS STRING), 9, '0'))"


def hundredths(numerator: str, denominator: str) -> str:
    """floor(numerator / denominator) hundredths as decimal(18,2); the same in both engines."""
    whole = f"CAST(floor(CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE)) AS BIGINT)"
    return f"CAST(CAST({whole} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def hit(p: int, r: int) -> str:
    return f"k % {p} = {r}"


def indicator_defects() -> list[Defect]:
    """Defects of the six indicator columns: the first rule hit in a column wins."""
    gdp, population, life, unemployment, co2, electricity = fixed.INDICATORS
    artefact = f"concat(CAST(CAST({population} AS BIGINT) - 1 AS STRING), '.99999997')"
    return [
        Defect(gdp, hit(137, 11), f"concat('$', {gdp})", "text_formatting"),
        Defect(gdp, hit(139, 12), "'NULL'", "null_sentinel"),
        Defect(population, hit(149, 13), artefact, "float_artefact"),
        Defect(population, hit(151, 14), "''", "null_sentinel"),
        Defect(life, hit(157, 15), f"'{ODD_LIFE}'", "impossible_value"),
        Defect(life, hit(163, 16), "'unknown'", "null_sentinel"),
        Defect(unemployment, hit(167, 17), f"concat({unemployment}, '%')", "text_formatting"),
        Defect(unemployment, hit(173, 18), f"'{ODD_RATE}'", "impossible_value"),
        Defect(co2, hit(179, 19), f"replace({co2}, '.', ',')", "text_formatting"),
        Defect(co2, hit(181, 20), f"concat('-', {co2})", "impossible_value"),
        Defect(electricity, hit(191, 21), "'..'", "null_sentinel"),
        Defect(electricity, hit(193, 22), f"'{ODD_SHARE}'", "impossible_value"),
    ]


def key_defects() -> list[Defect]:
    """Defects of names, codes, regions and years.

    Code and year defects stay on records that are alone in their (customer, year): a corrected
    record must not collide with a clean twin.
    """
    name, code = "country_name", "country_code"
    moved = f"solo AND {hit(53, 6)} AND NOT {hit(223, 2)}"
    return [
        Defect(name, hit(211, 1), f"concat({name}, ' ')", "name_variant"),
        Defect(name, hit(223, 2), f"concat('Alias ', {name})", "name_variant"),
        Defect(code, f"solo AND {hit(61, 3)}", "'WLD'", "aggregate_row"),
        Defect(code, hit(101, 4), f"concat(' ', {code}, ' ')", "whitespace_or_case"),
        Defect(code, hit(103, 5), f"lower({code})", "whitespace_or_case"),
        Defect(code, moved, f"concat('X', {code})", "referential_integrity"),
        Defect("region", hit(109, 7), "''", "null_sentinel"),
        Defect("income_group", hit(113, 9), "''", "null_sentinel"),
        Defect("year", f"solo AND {hit(59, 8)}", "concat('FY', year)", "type_drift"),
        Defect("year", f"solo AND {hit(67, 9)}", "concat(year, '.0')", "type_drift"),
        Defect("year", hit(131, 10), f"'{ODD_YEAR}'", "out_of_range"),
    ]


def record_copies() -> list[Copy]:
    """Exact duplicates, and copies of an entity that no dimension knows."""
    orphan = {"country_code": "'IRN'", "country_name": "'Orphan'"}
    return [
        Copy(hit(997, 5), DUPLICATE_OFFSET, "exact_duplicate"),
        Copy(hit(991, 6), ORPHAN_OFFSET, "orphan_record", orphan),
    ]


class Inputs:
    """Input frames over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def order_facts(self) -> DataFrame:
        """One row per order with lineitems: key, customer, year and six measures."""
        lines = self.table("lineitem").selectExpr(
            "l_orderkey AS k",
            "l_quantity",
            "CAST(round(l_discount * 100) AS BIGINT) AS d",
            "CAST(round(l_tax * 100) AS BIGINT) AS t",
            "CAST(l_returnflag = 'R' AS INT) AS r",
        )
        per_order = lines.groupBy("k").agg(
            F.count("*").alias("n"),
            F.sum("l_quantity").alias("qty"),
            F.sum("d").alias("disc"),
            F.sum("t").alias("tax"),
            F.sum("r").alias("ret"),
        )
        orders = self.table("orders").selectExpr(
            "o_orderkey AS k",
            "o_custkey AS custkey",
            "year(o_orderdate) AS yr",
            "CAST(o_totalprice AS DECIMAL(20,2)) AS gdp",
        )
        # Both sides have a row per order; the lines are shuffled by order anyway.
        return orders.join(shuffled(per_order), "k").selectExpr(
            "k",
            "custkey",
            "yr",
            "gdp",
            "CAST(qty AS BIGINT) AS population",
            f"{hundredths('4000 * n + 500 * disc', 'n')} AS life",
            f"{hundredths('100 * tax', 'n')} AS unemp",
            "CAST(n AS DECIMAL(18,2)) AS co2",
            f"{hundredths('10000 * ret', 'n')} AS elec",
        )

    @cached_property
    def panel_dim(self) -> DataFrame:
        """One row per customer: code, name, region, income group."""
        nation = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        customers = self.table("customer").join(nation, F.expr("c_nationkey = n_nationkey"))
        return customers.selectExpr(
            f"{CODE.format('c_custkey')} AS country_code",
            "c_name AS country_name",
            "r_name AS region",
            "c_mktsegment AS income_group",
        )

    @cached_property
    def panel_text(self) -> DataFrame:
        """Defect-free text records, one per order, with the key and the ``solo`` mark."""
        facts = self.order_facts.withColumn("country_code", F.expr(CODE.format("custkey")))
        # The only order of its (customer, year): counted by partial aggregation and joined back
        # on the unique order key, so a customer with very many orders makes no hot task.
        lone = (
            facts.groupBy("custkey", "yr")
            .agg(F.count("*").alias("orders"), F.min("k").alias("k"))
            .where("orders = 1")
            .selectExpr("k", "TRUE AS lone")
        )
        return (
            facts.join(self.panel_dim, "country_code")
            .join(lone, "k", "left")
            .selectExpr(
                "k",
                "coalesce(lone, FALSE) AS solo",
                "k + 1 AS raw_record_id",
                "country_name",
                "country_code",
                "region",
                "income_group",
                "CAST(yr AS STRING) AS year",
                "CAST(gdp AS STRING) AS gdp_usd",
                "CAST(population AS STRING) AS population",
                "CAST(life AS STRING) AS life_expectancy",
                "CAST(unemp AS STRING) AS unemployment_rate",
                "CAST(co2 AS STRING) AS co2_emissions_per_capita",
                "CAST(elec AS STRING) AS access_to_electricity_pct",
                f"CASE WHEN {hit(3, 0)} THEN 'extract_2025Q1.csv' ELSE 'extract_2024Q4.csv' END AS source_file",
                "'2026-08-18 04:12:07' AS ingested_at",
            )
        )

    def land(self) -> "Inputs":
        """Write the text records once, for queries that read them in several places."""
        self.panel_text = stage(self.panel_text, "panel_text")
        return self

    @cached_property
    def panel_raw(self) -> DataFrame:
        """Text records with defects, exact duplicates and orphans."""
        dirty = apply_defects(self.panel_text, key_defects() + indicator_defects())
        return append_copies(dirty, record_copies(), "raw_record_id").select(
            "raw_record_id", *fixed.SOURCE_COLUMNS
        )

    @cached_property
    def documented_fixes(self) -> DataFrame:
        """Known true values of some defects, keyed by code, year, column and raw value."""
        lone = self.panel_text.where("solo")

        def fixes(column: str, issue: str, wrong: str, where: str) -> DataFrame:
            return lone.where(where).selectExpr(
                "country_code",
                "year",
                f"'{column}' AS column_name",
                f"'{issue}' AS issue_type",
                f"'{wrong}' AS original_value",
                f"{column} AS cleaned_value",
            )

        life = fixes("life_expectancy", fixed.LIFE_DECIMAL, ODD_LIFE, hit(157, 15))
        gdp = fixes("gdp_usd", fixed.GDP_UNIT, "NULL", f"NOT {hit(137, 11)} AND {hit(139, 12)}")
        rate = fixes("unemployment_rate", RATE_FIXED, ODD_RATE, f"NOT {hit(167, 17)} AND {hit(173, 18)}")
        return life.unionByName(gdp).unionByName(rate)

    @cached_property
    def record_fixes(self) -> DataFrame:
        """Known true populations, keyed by record id."""
        return self.panel_text.where(hit(149, 13)).selectExpr(
            "raw_record_id", f"'{fixed.POPULATION_SCALE}' AS issue_type", "population AS cleaned_value"
        )

    @cached_property
    def panel_typed(self) -> DataFrame:
        """Typed panel, one row per (customer, year), with a constant group and NULL cells."""
        cells = self.order_facts.groupBy("custkey", "yr").agg(
            F.sum("gdp").cast("decimal(20,2)").alias("gdp_usd"),
            F.sum("population").alias("population"),
            F.min("life").alias("life_expectancy"),
            F.min("unemp").alias("unemployment_rate"),
            F.min("co2").alias("co2_emissions_per_capita"),
            F.min("elec").alias("access_to_electricity_pct"),
        )
        cells = cells.withColumn("country_code", F.expr(CODE.format("custkey")))
        return cells.join(self.panel_dim, "country_code").selectExpr(
            "country_name",
            "country_code",
            "region",
            "income_group",
            "yr AS year",
            "CASE WHEN custkey % 397 <> 0 THEN gdp_usd END AS gdp_usd",
            "population",
            "life_expectancy",
            "unemployment_rate",
            "co2_emissions_per_capita",
            "CASE WHEN income_group = 'BUILDING' THEN CAST(100 AS DECIMAL(18,2)) "
            "ELSE access_to_electricity_pct END AS access_to_electricity_pct",
            "'typed_feed' AS source_file",
            "'2026-08-18 04:12:07' AS ingested_at",
        )

    @cached_property
    def staging(self) -> DataFrame:
        """The typed panel as text: what a snapshot of an official feed looks like."""
        return self.panel_typed.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in fixed.SOURCE_COLUMNS])

    @cached_property
    def long_values(self) -> DataFrame:
        """(indicator, entity, year, value): one row per measured or missing cell."""
        values = self.panel_typed.selectExpr(
            "country_code AS entity", "year", *[f"CAST({c} AS DECIMAL(20,2)) AS {c}" for c in fixed.INDICATORS]
        )
        return values.unpivot(["entity", "year"], fixed.INDICATORS, "indicator", "value")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")


CTES = {
    "order_facts": """
SELECT o.o_orderkey AS k, o.o_custkey AS custkey, CAST(year(o.o_orderdate) AS INTEGER) AS yr,
       CAST(o.o_totalprice AS DECIMAL(20,2)) AS gdp, l.qty AS population,
       CAST(CAST(floor(CAST(4000 * l.n + 500 * l.disc AS DOUBLE) / CAST(l.n AS DOUBLE)) AS BIGINT) * 0.01 AS DECIMAL(18,2)) AS life,
       CAST(CAST(floor(CAST(100 * l.tax AS DOUBLE) / CAST(l.n AS DOUBLE)) AS BIGINT) * 0.01 AS DECIMAL(18,2)) AS unemp,
       CAST(l.n AS DECIMAL(18,2)) AS co2,
       CAST(CAST(floor(CAST(10000 * l.ret AS DOUBLE) / CAST(l.n AS DOUBLE)) AS BIGINT) * 0.01 AS DECIMAL(18,2)) AS elec
FROM orders o JOIN (
  SELECT l_orderkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS disc,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS tax,
         count(*) FILTER (WHERE l_returnflag = 'R') AS ret
  FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey""",
    "panel_dim": """
SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS country_code, c_name AS country_name,
       r_name AS region, c_mktsegment AS income_group
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "panel_text": """
SELECT f.k, f.solo, f.k + 1 AS raw_record_id, d.country_name, d.country_code, d.region, d.income_group,
       CAST(f.yr AS VARCHAR) AS yr_txt, CAST(f.gdp AS VARCHAR) AS gdp_usd,
       CAST(f.population AS VARCHAR) AS population, CAST(f.life AS VARCHAR) AS life_expectancy,
       CAST(f.unemp AS VARCHAR) AS unemployment_rate, CAST(f.co2 AS VARCHAR) AS co2_emissions_per_capita,
       CAST(f.elec AS VARCHAR) AS access_to_electricity_pct,
       CASE WHEN f.k % 3 = 0 THEN 'extract_2025Q1.csv' ELSE 'extract_2024Q4.csv' END AS source_file,
       '2026-08-18 04:12:07' AS ingested_at
FROM (SELECT *, count(*) OVER (PARTITION BY custkey, yr) = 1 AS solo FROM order_facts) f
JOIN panel_dim d ON d.country_code = 'C' || lpad(CAST(f.custkey AS VARCHAR), 9, '0')""",
    "panel_dirty": """
SELECT k, raw_record_id,
  CASE WHEN k % 211 = 1 THEN country_name || ' ' WHEN k % 223 = 2 THEN 'Alias ' || country_name
       ELSE country_name END AS country_name,
  CASE WHEN solo AND k % 61 = 3 THEN 'WLD' WHEN k % 101 = 4 THEN ' ' || country_code || ' '
       WHEN k % 103 = 5 THEN lower(country_code)
       WHEN solo AND k % 53 = 6 AND k % 223 <> 2 THEN 'X' || country_code ELSE country_code END AS country_code,
  CASE WHEN k % 109 = 7 THEN '' ELSE region END AS region,
  CASE WHEN k % 113 = 9 THEN '' ELSE income_group END AS income_group,
  CASE WHEN solo AND k % 59 = 8 THEN 'FY' || yr_txt WHEN solo AND k % 67 = 9 THEN yr_txt || '.0'
       WHEN k % 131 = 10 THEN '1899' ELSE yr_txt END AS "year",
  CASE WHEN k % 137 = 11 THEN '$' || gdp_usd WHEN k % 139 = 12 THEN 'NULL' ELSE gdp_usd END AS gdp_usd,
  CASE WHEN k % 149 = 13 THEN CAST(CAST(population AS BIGINT) - 1 AS VARCHAR) || '.99999997'
       WHEN k % 151 = 14 THEN '' ELSE population END AS population,
  CASE WHEN k % 157 = 15 THEN '187.4' WHEN k % 163 = 16 THEN 'unknown' ELSE life_expectancy END AS life_expectancy,
  CASE WHEN k % 167 = 17 THEN unemployment_rate || '%' WHEN k % 173 = 18 THEN '652.0'
       ELSE unemployment_rate END AS unemployment_rate,
  CASE WHEN k % 179 = 19 THEN replace(co2_emissions_per_capita, '.', ',')
       WHEN k % 181 = 20 THEN '-' || co2_emissions_per_capita
       ELSE co2_emissions_per_capita END AS co2_emissions_per_capita,
  CASE WHEN k % 191 = 21 THEN '..' WHEN k % 193 = 22 THEN '102.5'
       ELSE access_to_electricity_pct END AS access_to_electricity_pct,
  source_file, ingested_at
FROM panel_text""",
    "panel_raw": """
SELECT * EXCLUDE (k) FROM panel_dirty
UNION ALL
SELECT * EXCLUDE (k) REPLACE (raw_record_id + 1000000000 AS raw_record_id) FROM panel_dirty WHERE k % 997 = 5
UNION ALL
SELECT * EXCLUDE (k) REPLACE (raw_record_id + 2000000000 AS raw_record_id, 'IRN' AS country_code,
                              'Orphan' AS country_name) FROM panel_dirty WHERE k % 991 = 6""",
    "fixes": """
SELECT country_code, yr_txt AS "year", 'life_expectancy' AS column_name,
       'life_expectancy_decimal_corrected' AS issue_type, '187.4' AS original_value, life_expectancy AS cleaned_value
FROM panel_text WHERE solo AND k % 157 = 15
UNION ALL
SELECT country_code, yr_txt, 'gdp_usd', 'gdp_unit_corrected', 'NULL', gdp_usd
FROM panel_text WHERE solo AND k % 137 <> 11 AND k % 139 = 12
UNION ALL
SELECT country_code, yr_txt, 'unemployment_rate', 'unemployment_rate_corrected', '652.0', unemployment_rate
FROM panel_text WHERE solo AND k % 167 <> 17 AND k % 173 = 18""",
    "record_fixes": """
SELECT raw_record_id, 'population_scale_corrected' AS issue_type, population AS cleaned_value
FROM panel_text WHERE k % 149 = 13""",
    "panel_typed": """
SELECT d.country_name, d.country_code, d.region, d.income_group, f.yr AS "year",
       CASE WHEN f.custkey % 397 <> 0 THEN f.gdp_usd END AS gdp_usd, f.population, f.life_expectancy,
       f.unemployment_rate, f.co2_emissions_per_capita,
       CASE WHEN d.income_group = 'BUILDING' THEN CAST(100 AS DECIMAL(18,2))
            ELSE f.access_to_electricity_pct END AS access_to_electricity_pct,
       'typed_feed' AS source_file, '2026-08-18 04:12:07' AS ingested_at
FROM (SELECT custkey, yr, CAST(sum(gdp) AS DECIMAL(20,2)) AS gdp_usd, CAST(sum(population) AS BIGINT) AS population,
             min(life) AS life_expectancy, min(unemp) AS unemployment_rate,
             min(co2) AS co2_emissions_per_capita, min(elec) AS access_to_electricity_pct
      FROM order_facts GROUP BY custkey, yr) f
JOIN panel_dim d ON d.country_code = 'C' || lpad(CAST(f.custkey AS VARCHAR), 9, '0')""",
    "staging": """
SELECT country_name, country_code, region, income_group, CAST("year" AS VARCHAR) AS "year",
       CAST(gdp_usd AS VARCHAR) AS gdp_usd, CAST(population AS VARCHAR) AS population,
       CAST(life_expectancy AS VARCHAR) AS life_expectancy, CAST(unemployment_rate AS VARCHAR) AS unemployment_rate,
       CAST(co2_emissions_per_capita AS VARCHAR) AS co2_emissions_per_capita,
       CAST(access_to_electricity_pct AS VARCHAR) AS access_to_electricity_pct, source_file, ingested_at
FROM panel_typed""",
    "long_values": """
SELECT indicator, country_code AS entity, "year", value FROM (
  SELECT 'gdp_usd' AS indicator, country_code, "year", CAST(gdp_usd AS DECIMAL(20,2)) AS value FROM panel_typed
  UNION ALL SELECT 'population', country_code, "year", CAST(population AS DECIMAL(20,2)) FROM panel_typed
  UNION ALL SELECT 'life_expectancy', country_code, "year", CAST(life_expectancy AS DECIMAL(20,2)) FROM panel_typed
  UNION ALL SELECT 'unemployment_rate', country_code, "year", CAST(unemployment_rate AS DECIMAL(20,2)) FROM panel_typed
  UNION ALL SELECT 'co2_emissions_per_capita', country_code, "year", CAST(co2_emissions_per_capita AS DECIMAL(20,2)) FROM panel_typed
  UNION ALL SELECT 'access_to_electricity_pct', country_code, "year", CAST(access_to_electricity_pct AS DECIMAL(20,2)) FROM panel_typed)""",
}

NEEDS = {
    "order_facts": [],
    "panel_dim": [],
    "panel_text": ["order_facts", "panel_dim"],
    "panel_dirty": ["panel_text"],
    "panel_raw": ["panel_dirty"],
    "fixes": ["panel_text"],
    "record_fixes": ["panel_text"],
    "panel_typed": ["order_facts", "panel_dim"],
    "staging": ["panel_typed"],
    "long_values": ["panel_typed"],
}


def define(name: str, text: str, needs: list[str]) -> None:
    """Add a named step that check SQL may build on."""
    CTES[name] = text
    NEEDS[name] = needs


def with_inputs(body: str, *names: str) -> str:
    """SQL that defines the named inputs, and what they need, before ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS[name]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    steps = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    return f"WITH {steps}\n{body}"
