"""Queries for sources, coverage, gates, upserts, publication, run log, retention, injection."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill import fixed
import panelmill.catalog.statistics  # noqa: F401 - defines the step "changes"
from panelmill.catalog.base import query
from panelmill.catalog.cleaning import AUDIT_SQL, CLEAN_SQL, annotated, audit_of, clean_of
from panelmill.catalog.inputs import (
    CODE,
    END,
    FIRST_YEAR,
    LAST_YEAR,
    START,
    Inputs,
    define,
    hit,
    indicator_defects,
    key_defects,
    record_copies,
)
from panelmill.catalog.profiling import t
from panelmill.functions import text
from panelmill.operators import coverage, inject, keyed, retention, validate
from panelmill.operators.skew import shuffled
from panelmill.plans import gates, load, refresh, runlog, views
from panelmill.session import scratch_dir, stage
from panelmill.sources import landing, payload, reports
from panelmill.sources.versions import Conflict, VersionedSet, VersionedTable

QUOTED = ", ".join(f'"{c}"' for c in fixed.SOURCE_COLUMNS)

# --- landing ---------------------------------------------------------------------------------


@query("s1_text_landing", f"SELECT {QUOTED} FROM panel_raw", "panel_raw")
def s1_text_landing(i: Inputs):
    """The raw panel through a CSV snapshot and back, as text."""
    path = scratch_dir(i.spark, "csv")
    landing.write_text(i.panel_raw.select(*fixed.SOURCE_COLUMNS), path)
    return landing.read_text_landing(i.spark, path)


@query(
    "s2_record_id",
    "SELECT o_orderkey + 1 AS raw_record_id, o_custkey, TRUE AS stamped FROM orders",
)
def s2_record_id(i: Inputs):
    """Record ids from a unique source key, with the load time."""
    orders = i.table("orders").select("o_orderkey", "o_custkey")
    loaded = landing.with_record_id(orders, F.col("o_orderkey") + 1)
    return loaded.select("raw_record_id", "o_custkey", F.col("pipeline_loaded_at").isNotNull().alias("stamped"))


@query(
    "s2_keyless_ids",
    "SELECT count(*) AS records, count(*) AS distinct_ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id FROM lineitem",
)
def s2_keyless_ids(i: Inputs):
    """Record ids of a table without a key are dense from 1."""
    loaded = landing.with_record_id(i.table("lineitem").select("l_orderkey", "l_linenumber"))
    return loaded.agg(
        F.count("*").alias("records"),
        F.count_distinct("raw_record_id").alias("distinct_ids"),
        F.min("raw_record_id").alias("first_id"),
        F.max("raw_record_id").alias("last_id"),
    )


def listing(i: Inputs) -> DataFrame:
    """File names with times in them: logs for one event type, snapshots for the others."""
    is_log = F.col("event_type") == "error"
    log_name = F.concat(F.lit("pipeline_"), F.date_format("ts", fixed.LOG_FORMAT), F.lit(".log"))
    return i.events.select(
        F.when(is_log, log_name).otherwise(F.date_format("ts", fixed.SNAPSHOT_FORMAT)).alias("name"),
        F.col("event_type").alias("group"),
        "value",
    )


define(
    "listing",
    """SELECT CASE WHEN event_type = 'error' THEN 'pipeline_' || strftime(ts, '%Y%m%dT%H%M%S_%f') || 'Z.log'
     ELSE strftime(ts, '%Y-%m-%d_%H%M%S_%f') || 'Z' END AS name, event_type AS "group", ts, value FROM events""",
    [],
)


@query(
    "s3_latest_snapshot",
    "SELECT strftime(max(ts), '%Y-%m-%d_%H%M%S_%f') || 'Z' AS latest FROM events WHERE event_type <> 'error'",
)
def s3_latest_snapshot(i: Inputs):
    """Newest snapshot of a listing; other names are ignored."""
    return landing.latest_stamp(listing(i))


NOW = datetime.datetime(2024, 1, 31, tzinfo=datetime.timezone.utc)
AGES = {"log": 10, "snapshot": 15}


@query(
    "w2_retention",
    f"""SELECT name, "group" FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY ts DESC, name DESC) AS n FROM listing)
        WHERE n > 3 AND value <= 40 AND ts < TIMESTAMP '2024-01-31' - CASE WHEN "group" = 'error'
          THEN INTERVAL {AGES['log']} DAY ELSE INTERVAL {AGES['snapshot']} DAY END""",
    "listing",
)
def w2_retention(i: Inputs):
    """Files that may go: old, not among the newest three of their group, not protected."""
    files = listing(i)
    protected = files.where("value > 40")
    kinds = [
        (fixed.LOG_NAME, fixed.LOG_FORMAT, AGES["log"]),
        (fixed.SNAPSHOT_NAME, fixed.SNAPSHOT_FORMAT, AGES["snapshot"]),
    ]
    parts = [
        retention.retention_candidates(files, pattern, time_format, NOW, days, protected).select("name", "group")
        for pattern, time_format, days in kinds
    ]
    return parts[0].unionByName(parts[1])


def tree(i: Inputs) -> DataFrame:
    """Files below dated folders: most hold the one known file, some another one or a folder as well."""
    held = (
        "CASE WHEN event_id % 5 = 0 THEN array('/panel.csv', '/notes.txt') WHEN event_id % 5 = 1 THEN array('/old/panel.csv') "
        "WHEN event_id % 5 = 2 THEN array('/other.csv') ELSE array('/panel.csv') END"
    )
    files = i.events.where("event_type <> 'error'").select("event_id", "ts", F.explode(F.expr(held)).alias("file"))
    return files.select(F.concat(F.date_format("ts", fixed.SNAPSHOT_FORMAT), "file").alias("path"), "event_id")


@query(
    "w2_tree_retention",
    f"""WITH f AS (SELECT strftime(ts, '%Y-%m-%d_%H%M%S_%f') || 'Z' AS name, date_trunc('microsecond', ts) AS stamp, event_id FROM events WHERE event_type <> 'error'),
        e AS (SELECT name, stamp, count(*) AS n, min(event_id % 5) AS kind, bool_or(event_id % 7 = 0) AS shielded FROM f GROUP BY name, stamp),
        r AS (SELECT *, row_number() OVER (ORDER BY stamp DESC, name DESC) AS newest FROM e)
        SELECT name FROM r WHERE newest > 3 AND NOT shielded AND n = 1 AND kind >= 3
          AND stamp < TIMESTAMP '2024-01-31' - INTERVAL {AGES['snapshot']} DAY""",
)
def w2_tree_retention(i: Inputs):
    """Dated folders that may go: old, not among the newest, unprotected, holding the one known file only."""
    files = tree(i)
    protected = files.where("event_id % 7 = 0")
    found = retention.tree_candidates(
        files, fixed.SNAPSHOT_NAME, fixed.SNAPSHOT_FORMAT, NOW, AGES["snapshot"], protected, "panel.csv"
    )
    return found.select("name")


ZONES = ["", "Z", "+02", " -05:30", "+0200", " UTC", "+25:00", " Mars"]


@query(
    "p8_zoned_stamps",
    f"""SELECT event_id, z < 6 AS valid, CASE WHEN z < 6 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS read
        FROM (SELECT event_id, ts, event_id % {len(ZONES)} AS z FROM events)""",
)
def p8_zoned_stamps(i: Inputs):
    """Timestamps with a zone behind them: valid where the zone is one, and read without it."""
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("event_id") % len(ZONES) + 1).cast("int"))
    stamps = i.events.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), zone).alias("stamp"))
    return stamps.select(
        "event_id",
        text.is_valid("stamp", "timestamp").alias("valid"),
        F.date_format(text.as_timestamp("stamp"), "yyyy-MM-dd HH:mm:ss").alias("read"),
    )


VALUE_SOURCES = {
    "gdp_usd": "gdp",
    "population": "population",
    "life_expectancy": "life",
    "unemployment_rate": "unemp",
    "co2_emissions_per_capita": "co2",
    "access_to_electricity_pct": "elec",
}


def pages(i: Inputs) -> DataFrame:
    """One page of JSON per order: six indicator rows, some without entity or value."""
    facts = i.order_facts.withColumn("code", F.expr(f"CASE WHEN {hit(61, 3)} THEN '' ELSE {CODE.format('custkey')} END"))
    sources = VALUE_SOURCES | {"gdp_usd": f"CASE WHEN NOT {hit(139, 12)} THEN gdp END"}
    rows = ", ".join(
        f"named_struct('indicator', named_struct('id', '{name}'), 'countryiso3code', code, "
        f"'date', CAST(yr AS STRING), 'value', CAST({value} AS DECIMAL(20,2)))"
        for name, value in sources.items()
    )
    keep_null = "map('ignoreNullFields', 'false')"
    return facts.selectExpr(
        "k AS page",
        f"concat('[', to_json(named_struct('page', k)), ',', to_json(array({rows}), {keep_null}), ']') AS body",
    )


@query(
    "s4_flatten_pages",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS indicator, 'C' || lpad(CAST(custkey AS VARCHAR), 9, '0') AS entity, yr AS "year",
            CAST(arg_max({value}, k) AS DOUBLE) AS value FROM order_facts
            WHERE k % 61 <> 3 {"AND k % 139 <> 12" if name == "gdp_usd" else ""} GROUP BY custkey, yr"""
        for name, value in VALUE_SOURCES.items()
    ),
    "order_facts",
)
def s4_flatten_pages(i: Inputs):
    """Cells of paged JSON payloads, last value wins."""
    return payload.flatten_pages(pages(i))


def with_bad_pages(i: Inputs) -> DataFrame:
    """Good pages, pages cut short, pages whose periods are no year, rows that are no objects, values in words."""
    good = pages(i)
    cut = good.where("page % 53 = 4").selectExpr("page", "left(body, length(body) - 9) AS body")
    dated = good.where("page % 59 = 5").selectExpr("page", """regexp_replace(body, '"date":"', '"date":"Q') AS body""")
    odd = good.where("page % 71 = 6").selectExpr("page", "concat('[{\"page\":', page, '},[7,{}]]') AS body")
    worded = good.where("page % 73 = 7").selectExpr(
        "page", """concat('[{},[{"indicator":{"id":"i"},"countryiso3code":"E","date":"2000","value":"many"}]]') AS body"""
    )
    return good.union(cut).union(dated).union(odd).union(worded)


@query(
    "s4_bad_pages",
    """SELECT count(*) + count(*) FILTER (WHERE k % 53 = 4) + count(*) FILTER (WHERE k % 59 = 5)
         + count(*) FILTER (WHERE k % 71 = 6) + count(*) FILTER (WHERE k % 73 = 7) AS pages,
       count(*) FILTER (WHERE k % 53 = 4) AS malformed_pages, 6 * count(*) FILTER (WHERE k % 59 = 5) AS bad_periods FROM order_facts""",
    "order_facts",
)
def s4_bad_pages(i: Inputs):
    """What is wrong with pages, next to good ones."""
    return payload.page_problems(with_bad_pages(i))


@query(
    "s4_rejected_rows",
    """SELECT k AS page, CAST(NULL AS INTEGER) AS "position", 'malformed page' AS problem FROM order_facts WHERE k % 53 = 4
       UNION ALL SELECT k, CAST(unnest(range(6)) AS INTEGER), 'unreadable period' FROM order_facts WHERE k % 59 = 5
       UNION ALL SELECT k, 0, 'malformed row' FROM order_facts WHERE k % 71 = 6
       UNION ALL SELECT k, 0, 'unreadable value' FROM order_facts WHERE k % 73 = 7""",
    "order_facts",
)
def s4_rejected_rows(i: Inputs):
    """The pages and rows that are set aside while the others load."""
    _, rejected = payload.split_pages(with_bad_pages(i))
    return rejected


@query(
    "s4_accepted_cells",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS indicator, 'C' || lpad(CAST(custkey AS VARCHAR), 9, '0') AS entity, yr AS "year",
            CAST(arg_max({value}, k) AS DOUBLE) AS value FROM order_facts
            WHERE k % 61 <> 3 {"AND k % 139 <> 12" if name == "gdp_usd" else ""} GROUP BY custkey, yr"""
        for name, value in VALUE_SOURCES.items()
    ),
    "order_facts",
)
def s4_accepted_cells(i: Inputs):
    """Cells of the good pages, with the bad ones set aside."""
    accepted, _ = payload.split_pages(with_bad_pages(i))
    return accepted


@query(
    "s5_code_fallback",
    """SELECT indicator, CASE WHEN indicator = 'co2_emissions_per_capita' THEN 'second' ELSE 'first' END AS code,
       entity, "year", CAST(CASE WHEN indicator = 'co2_emissions_per_capita' THEN value + 1 ELSE value END AS DOUBLE) AS value
       FROM long_values""",
    "long_values",
)
def s5_code_fallback(i: Inputs):
    """Values of the first source code that has any; the first one of an indicator has none."""
    empty = "CASE WHEN indicator <> 'co2_emissions_per_capita' THEN value END"
    sources = (
        f"inline(array(named_struct('code', 'first', 'value', {empty}), "
        "named_struct('code', 'second', 'value', CAST(value + 1 AS DECIMAL(20,2)))))"
    )
    values = i.long_values.selectExpr("indicator", "entity", "year", sources)
    ranks = [(name, code, n) for name in fixed.INDICATORS for n, code in enumerate(("first", "second"))]
    priority = i.spark.createDataFrame(ranks, "indicator string, code string, rank int")
    return payload.first_nonempty_source(values, priority)


@query(
    "s6_assemble_panel",
    f"""SELECT coalesce(n.country_name, e.country_code) AS country_name, e.country_code, coalesce(n.region, '') AS region,
        coalesce(n.income_group, '') AS income_group, CAST(y.yr AS INTEGER) AS "year",
        {", ".join(f"CAST(p.{c} AS DOUBLE) AS {c}" for c in fixed.INDICATORS)}
        FROM panel_dim e CROSS JOIN range({START}, {END + 1}) AS y(yr)
        LEFT JOIN panel_typed p ON p.country_code = e.country_code AND p."year" = y.yr
        LEFT JOIN (SELECT * FROM panel_dim WHERE income_group <> 'BUILDING') n ON n.country_code = e.country_code""",
    "panel_typed panel_dim",
)
def s6_assemble_panel(i: Inputs):
    """Wide panel on the complete grid, unnamed entities defaulted."""
    info = i.panel_dim.where("income_group <> 'BUILDING'")
    return payload.assemble_panel(
        i.long_values, i.panel_dim, info, "country_code", START, END, fixed.INDICATORS
    )


@query(
    "s10_typeof",
    """SELECT lower(typeof(raw_record_id)) AS raw_record_id_type, lower(typeof("year")) AS year_type,
       lower(typeof(gdp_usd)) AS gdp_usd_type, lower(typeof(population)) AS population_type,
       lower(typeof(life_expectancy)) AS life_expectancy_type, lower(typeof(unemployment_rate)) AS unemployment_rate_type,
       lower(typeof(co2_emissions_per_capita)) AS co2_emissions_per_capita_type,
       lower(typeof(access_to_electricity_pct)) AS access_to_electricity_pct_type FROM clean_rows LIMIT 1""",
    "clean_rows",
)
def s10_typeof(i: Inputs):
    """Types of the clean panel."""
    return landing.types_of(clean_of(i, annotated(i)), ["raw_record_id", "year", *fixed.INDICATORS])


@query(
    "s11_row_json",
    f"""SELECT raw_record_id, CAST(to_json(struct_pack(raw_record_id := raw_record_id,
        {", ".join(f'"{c}" := "{c}"' for c in fixed.SOURCE_COLUMNS)})) AS VARCHAR) AS row_value FROM panel_raw""",
    "panel_raw",
)
def s11_row_json(i: Inputs):
    """Rows as JSON text."""
    return i.panel_raw.select("raw_record_id", landing.row_json(i.panel_raw).alias("row_value"))


# --- coverage --------------------------------------------------------------------------------


@query(
    "j12_missing_cells",
    f"""SELECT d.country_code, d.country_name, CAST(y.yr AS INTEGER) AS missing_year
        FROM panel_dim d CROSS JOIN range({FIRST_YEAR}, {LAST_YEAR + 1}) AS y(yr)
        LEFT JOIN panel_raw r ON {t('r.country_code')} = d.country_code AND {t('r."year"')} = CAST(y.yr AS VARCHAR)
        WHERE r.raw_record_id IS NULL""",
    "panel_raw panel_dim",
)
def j12_missing_cells(i: Inputs):
    """Cells of the grid without a raw record."""
    return coverage.missing_cells(i.panel_raw, i.panel_dim, FIRST_YEAR, LAST_YEAR)


define(
    "wanted",
    f"""SELECT n.indicator, d.country_code AS entity, CAST(y.yr AS INTEGER) AS "year" FROM panel_dim d
  CROSS JOIN range({START}, {END + 1}) AS y(yr)
  CROSS JOIN (VALUES {", ".join(f"('{c}')" for c in fixed.INDICATORS)}) AS n(indicator)""",
    ["panel_dim"],
)


@query(
    "a24_coverage",
    f"""SELECT w.indicator, w.expected, coalesce(f.available, 0) AS available, coalesce(f.unexpected, 0) AS unexpected,
        w.expected - coalesce(f.available, 0) AS missing
        FROM (SELECT indicator, count(*) AS expected FROM wanted GROUP BY indicator) w LEFT JOIN (
          SELECT v.indicator, count(*) FILTER (WHERE v.value IS NOT NULL AND v."year" BETWEEN {START} AND {END}) AS available,
            count(*) FILTER (WHERE v."year" NOT BETWEEN {START} AND {END}) AS unexpected
          FROM long_values v GROUP BY v.indicator) f ON f.indicator = w.indicator""",
    "wanted long_values",
)
def a24_coverage(i: Inputs):
    """Expected, available, missing and unexpected cells per indicator."""
    return coverage.coverage(i.long_values, i.panel_dim, "country_code", START, END, fixed.INDICATORS)


@query(
    "a24_missing_list",
    """SELECT w.indicator, w.entity, w."year" FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM long_values v
       WHERE v.indicator = w.indicator AND v.entity = w.entity AND v."year" = w."year" AND v.value IS NOT NULL)""",
    "wanted long_values",
)
def a24_missing_list(i: Inputs):
    """Expected cells without a value."""
    return coverage.missing_list(i.long_values, i.panel_dim, "country_code", START, END, fixed.INDICATORS)


@query(
    "u3_cell_sets",
    f"""SELECT count(*) FILTER (WHERE "year" BETWEEN {START} AND {END}) AS common,
        count(*) FILTER (WHERE "year" NOT BETWEEN {START} AND {END}) AS only_present,
        (SELECT count(*) FROM panel_dim) * {END - START + 1} - count(*) FILTER (WHERE "year" BETWEEN {START} AND {END}) AS only_expected
        FROM (SELECT DISTINCT entity, "year" FROM long_values)""",
    "long_values panel_dim",
)
def u3_cell_sets(i: Inputs):
    """Intersection and differences of present and expected cells."""
    return coverage.cell_sets(i.long_values, i.panel_dim, "country_code", START, END)


# --- gates -----------------------------------------------------------------------------------

NUMERIC = r"\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*"


def gate_sql(source: str, table: str, columns: str = "") -> str:
    values = " OR ".join(
        f"coalesce(trim({c}, ' '), '') = '' OR NOT regexp_full_match({c}, '{NUMERIC}')" for c in fixed.INDICATORS
    )

    def d(c: str) -> str:
        return f"(CASE WHEN regexp_full_match({c}, '{NUMERIC}') THEN TRY_CAST({c} AS DECIMAL(38,10)) END)"

    year = """(CASE WHEN regexp_full_match("year", '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST("year" AS INTEGER) END)"""
    ranges = " OR ".join(
        f"coalesce({test}, FALSE)"
        for test in [
            f"{year} NOT BETWEEN {FIRST_YEAR} AND {LAST_YEAR}",
            f"{d('gdp_usd')} < 0",
            f"{d('population')} <= 0",
            f"{d('population')} <> floor({d('population')})",
            f"{d('life_expectancy')} <= 0",
            f"{d('unemployment_rate')} NOT BETWEEN 0 AND 100",
            f"{d('co2_emissions_per_capita')} < 0",
            f"{d('access_to_electricity_pct')} NOT BETWEEN 0 AND 100",
        ]
    )
    return f"""SELECT {columns} count(*) AS staging_rows,
      count(*) FILTER (WHERE country_code IS NULL OR country_code NOT IN (SELECT country_code FROM panel_dim)
        OR {year} IS NULL OR source_file IS DISTINCT FROM '{source}' OR TRY_CAST(ingested_at AS TIMESTAMP) IS NULL) AS identity_violations,
      count(*) FILTER (WHERE {values}) AS value_violations, count(*) FILTER (WHERE {ranges}) AS range_violations,
      (SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY country_code, {year} HAVING count(*) > 1)) AS duplicate_keys
      FROM {table}"""


@query("g_gate_report", gate_sql("extract_2025Q1.csv", "panel_raw"), "panel_raw panel_dim")
def g_gate_report(i: Inputs):
    """Gate counts of the raw panel taken as a staged batch."""
    return gates.gate_report(
        i.panel_raw.select(*fixed.SOURCE_COLUMNS), i.panel_dim, "extract_2025Q1.csv", FIRST_YEAR, LAST_YEAR
    )


def filled(i: Inputs) -> DataFrame:
    """The staged panel with every value present."""
    return i.staging.withColumn("gdp_usd", F.coalesce("gdp_usd", F.lit("1.00")))


def spoiled(i: Inputs) -> DataFrame:
    """The filled batch with one impossible percentage per entity."""
    wrong = F.when(F.col("year") == str(START), F.lit("101")).otherwise(F.col("unemployment_rate"))
    return filled(i).withColumn("unemployment_rate", wrong)


define("filled", "SELECT * REPLACE (coalesce(gdp_usd, '1.00') AS gdp_usd) FROM staging", ["staging"])
define(
    "spoiled",
    f"""SELECT * REPLACE (CASE WHEN "year" = '{START}' THEN '101' ELSE unemployment_rate END AS unemployment_rate) FROM filled""",
    ["filled"],
)
define("doubled", "SELECT * FROM filled UNION ALL SELECT * FROM filled", ["filled"])


@query(
    "g_first_failure",
    " UNION ALL ".join(
        gate_sql("typed_feed", table, f"'{table}' AS batch, {message} AS message,")
        for table, message in {
            "staging": f"'{fixed.MESSAGE_VALUES}'",
            "filled": "CAST(NULL AS VARCHAR)",
            "spoiled": f"'{fixed.MESSAGE_RANGES}'",
            "doubled": f"'{fixed.MESSAGE_DUPLICATE}'",
        }.items()
    ),
    "spoiled doubled",
)
def g_first_failure(i: Inputs):
    """First failing gate of four batches, three of them bad."""
    batches = {
        "staging": i.staging,
        "filled": filled(i),
        "spoiled": spoiled(i),
        "doubled": filled(i).unionByName(filled(i)),
    }
    out = None
    for name, batch in batches.items():
        report = gates.gate_report(batch, i.panel_dim, "typed_feed", FIRST_YEAR, LAST_YEAR)
        row = gates.first_failure(report, None).withColumn("batch", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "g_row_count",
    f"""SELECT count(*) AS staging_rows, CASE WHEN count(*) <> 720 THEN '{fixed.MESSAGE_ROWS.format(rows=720)}' END AS message,
        CAST(NULL AS VARCHAR) AS right_number FROM filled""",
    "filled",
)
def g_row_count(i: Inputs):
    """The row gate goes first; with the right number of rows it passes."""
    report = stage(gates.gate_report(filled(i), i.panel_dim, "typed_feed", FIRST_YEAR, LAST_YEAR), "report")
    passes = gates.first_failure(report, report.first()["staging_rows"]).select("staging_rows", F.col("message").alias("right_number"))
    return gates.first_failure(report, 720).select("staging_rows", "message").join(passes, "staging_rows")


@query(
    "g7_pre_post",
    """SELECT (SELECT count(*) FROM panel_raw) AS raw_rows, (SELECT count(*) FROM clean_rows) AS cleaned_rows,
       count(*) AS documented_fixes, count(raw_value) AS targets_found, count(*) FILTER (passed) AS targets_corrected FROM verified""",
    "verified",
)
def g7_pre_post(i: Inputs):
    """Counts around the documented corrections."""
    rows = stage(annotated(i.land()), "annotated")
    return gates.fix_conditions(clean_of(i, rows), audit_of(i, rows), i.documented_fixes, i.panel_raw)


# --- keyed writes ----------------------------------------------------------------------------


def early(batch: DataFrame) -> DataFrame:
    return batch.where("year <= '1999'")


def late(batch: DataFrame) -> DataFrame:
    """The batch of the later years, values revised; two years overlap with the early one."""
    revised = (F.col("gdp_usd").cast("decimal(20,2)") * 2).cast("decimal(20,2)").cast("string")
    return batch.where("year >= '1998'").withColumn("gdp_usd", revised)


TYPED_SQL = (
    'country_name, country_code, region, income_group, "year", '
    + ", ".join(c if c == "population" else f"CAST({c} AS DOUBLE) AS {c}" for c in fixed.INDICATORS)
    + ", source_file, CAST(epoch(CAST(ingested_at AS TIMESTAMP)) AS BIGINT) AS ingested_at"
)


def typed_out(df: DataFrame) -> DataFrame:
    """Official decimals at two digits and times as epoch seconds, for comparison."""
    decimals = [c for c in fixed.INDICATORS if c != "population"]
    return df.withColumns(
        {c: F.col(c).cast("decimal(20,2)") for c in decimals} | {"ingested_at": F.unix_seconds("ingested_at")}
    )


@query("m5_cast_panel", f"SELECT {TYPED_SQL} FROM panel_typed", "panel_typed")
def m5_cast_panel(i: Inputs):
    """Typed panel from staged text."""
    return typed_out(keyed.cast_panel(i.staging))


define(
    "upserted",
    """SELECT * REPLACE (CASE WHEN "year" >= 1998 THEN CAST(2 * gdp_usd AS DECIMAL(20,2)) ELSE gdp_usd END AS gdp_usd) FROM panel_typed""",
    ["panel_typed"],
)


@query("m3_upsert", f"SELECT {TYPED_SQL} FROM upserted", "upserted")
def m3_upsert(i: Inputs):
    """Early years, then later ones upserted; NULL overwrites."""
    return typed_out(refresh.upsert_panel(keyed.cast_panel(early(i.staging)), late(i.staging)))


@query(
    "u2_multiset_diff",
    """SELECT coalesce(a.country_code, b.country_code) AS country_code, coalesce(a."year", b."year") AS "year",
       coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b
       FROM (SELECT country_code, "year", count(*) AS n FROM panel_raw GROUP BY 1, 2) a
       FULL JOIN (SELECT country_code, "year", count(*) AS n FROM staging GROUP BY 1, 2) b
         ON a.country_code = b.country_code AND a."year" = b."year" WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
    "panel_raw staging",
)
def u2_multiset_diff(i: Inputs):
    """Keys that occur differently often in two tables."""
    keys = ["country_code", "year"]
    return keyed.multiset_difference(i.panel_raw.select(*keys), i.staging.select(*keys))


# --- publication -----------------------------------------------------------------------------


@query(
    "s8_publish_gate",
    """SELECT expected, report_rows, unique_keys, CASE WHEN report_rows <> wanted OR unique_keys <> wanted
            THEN 'Expected ' || wanted || ' unique countries in the report.' END AS message
       FROM (SELECT count(*) AS report_rows, count(DISTINCT country_code) AS unique_keys FROM changes) c,
            (SELECT 'thirty' AS expected, 30 AS wanted UNION ALL SELECT 'all', count(*) FROM changes) w""",
    "changes",
)
def s8_publish_gate(i: Inputs):
    """Row and key gate of the change report, for a wrong number of rows and for the right one."""
    report = stage(views.change_report(i.panel_typed, START, END), "report")
    gates_ = {"thirty": 30, "all": report.count()}
    rows = [reports.report_gate(report, "country_code", n).withColumn("expected", F.lit(name)) for name, n in gates_.items()]
    return rows[0].unionByName(rows[1])


@query(
    "s7_report_round_trip",
    """SELECT country_name, country_code, CAST(round(elec, 2) AS DOUBLE) AS electricity_change_pp,
       CAST(round(life, 2) AS DOUBLE) AS life_expectancy_change_years FROM changes""",
    "changes",
)
def s7_report_round_trip(i: Inputs):
    """The change report exported, checked, published and read back."""
    report = stage(views.change_report(i.panel_typed, START, END), "report")
    order = [F.desc_nulls_last("electricity_change_pp"), F.col("country_code")]
    base = scratch_dir(i.spark, "reports")
    reports.publish_report(report, base, fixed.CHANGE_REPORT_COLUMNS, report.count(), "country_code", order)
    text = reports.current_report(i.spark, base, fixed.CHANGE_REPORT_COLUMNS)
    return text.withColumns(
        {c: F.col(c).cast("double") for c in ("electricity_change_pp", "life_expectancy_change_years")}
    )


@query("s9_full_refresh", f"SELECT {TYPED_SQL} FROM panel_typed", "panel_typed")
def s9_full_refresh(i: Inputs):
    """A published table replaced as a whole."""
    table = VersionedTable(i.spark, scratch_dir(i.spark, "typed"))
    table.overwrite(keyed.cast_panel(early(i.staging)))
    return typed_out(table.overwrite(keyed.cast_panel(i.staging)))


def refreshed(i: Inputs, with_bad: bool):
    """Table and log after an early batch, a later one and optionally a bad one."""
    i.staging = stage(i.staging, "feed")
    table = VersionedTable(i.spark, scratch_dir(i.spark, "typed"), "year")
    log = runlog.RunLog(i.spark, scratch_dir(i.spark, "runs"))
    batches = [early(filled(i)), late(filled(i))] + ([spoiled(i)] if with_bad else [])
    for batch in batches:
        try:
            refresh.refresh(batch, table, log, i.panel_dim, "typed_feed", FIRST_YEAR, LAST_YEAR, None)
        except gates.GateFailure:
            continue
    return table, log


define(
    "refreshed",
    """SELECT * REPLACE (CASE WHEN "year" >= 1998 THEN CAST(2 * coalesce(gdp_usd, 1.00) AS DECIMAL(20,2))
         ELSE coalesce(gdp_usd, 1.00) END AS gdp_usd) FROM panel_typed""",
    ["panel_typed"],
)


@query("r5_refresh", f"SELECT {TYPED_SQL} FROM refreshed", "refreshed")
def r5_refresh(i: Inputs):
    """Published table after two accepted refreshes."""
    table, _ = refreshed(i, with_bad=False)
    return typed_out(table.read().select(*fixed.SOURCE_COLUMNS))


@query(
    "m6_publish",
    f"""SELECT * FROM (VALUES
          ('succeeded', (SELECT count(*) FROM panel_typed WHERE "year" <= 1999), (SELECT count(*) FROM panel_typed WHERE "year" <= 1999), NULL),
          ('succeeded', (SELECT count(*) FROM panel_typed WHERE "year" >= 1998), (SELECT count(*) FROM panel_typed), NULL),
          ('failed', NULL, NULL, '{fixed.MESSAGE_RANGES}')) AS v(status, staging_rows, typed_rows, error_message)""",
    "panel_typed",
)
def m6_publish(i: Inputs):
    """Run log of two accepted refreshes and a rejected one that changed nothing."""
    _, log = refreshed(i, with_bad=True)
    return log.runs().select("status", "staging_rows", "typed_rows", "error_message")


@query(
    "m6_two_writers",
    """SELECT country_code, "year", CAST(gdp_usd AS DOUBLE) AS gdp_usd, CAST(1 AS BIGINT) AS conflicts,
       CAST(3 AS BIGINT) AS commits FROM (
         SELECT * REPLACE (CASE WHEN "year" >= 1998 THEN CAST(2 * coalesce(gdp_usd, 1.00) AS DECIMAL(20,2)) ELSE coalesce(gdp_usd, 1.00) END AS gdp_usd)
         FROM panel_typed)""",
    "panel_typed",
)
def m6_two_writers(i: Inputs):
    """Two batches merged into the same version: the second to publish is refused and merges anew."""
    i.staging = stage(i.staging, "feed")
    table = VersionedTable(i.spark, scratch_dir(i.spark, "typed"), "year")
    log = runlog.RunLog(i.spark, scratch_dir(i.spark, "runs"))

    def load(batch: DataFrame) -> None:
        refresh.refresh(batch, table, log, i.panel_dim, "typed_feed", FIRST_YEAR, LAST_YEAR, None)

    load(early(filled(i)).where("year <= '1996'"))
    mine = stage(keyed.cast_panel(late(filled(i))), "mine")
    periods = sorted(r[0] for r in mine.select("year").distinct().collect())
    written = refresh.write_upsert(table, mine, periods)
    load(early(filled(i)).where("year >= '1996'"))
    conflicts = 0
    try:
        table.publish(written)
    except Conflict:
        conflicts = 1
        refresh.merge(table, mine, periods, "", None, 1)
    commits = table.commits().count()
    return table.read().select(
        "country_code", "year", F.col("gdp_usd").cast("decimal(20,2)").alias("gdp_usd"),
        F.lit(conflicts).cast("bigint").alias("conflicts"), F.lit(commits).alias("commits"),
    )


HISTORY_TIMES = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"]


@query(
    "m4_history",
    f"""SELECT country_code, "year", CAST(gdp_usd AS DOUBLE) AS gdp_usd, valid_from, valid_to FROM (
          SELECT country_code, "year", gdp_usd, '{HISTORY_TIMES[0]}' AS valid_from,
            CASE WHEN "year" >= 1998 AND gdp_usd <> 2 * gdp_usd THEN '{HISTORY_TIMES[1]}' END AS valid_to FROM panel_typed WHERE "year" <= 1999
          UNION ALL SELECT country_code, "year", 2 * gdp_usd, '{HISTORY_TIMES[1]}', NULL FROM panel_typed
          WHERE "year" >= 1998 AND ("year" > 1999 OR gdp_usd <> 2 * gdp_usd))""",
    "panel_typed",
)
def m4_history(i: Inputs):
    """States of every key with their times: early years, later ones revised, and the same batch again."""
    first, second, third = (F.lit(x).cast("timestamp") for x in HISTORY_TIMES)
    keys, columns = ["country_code", "year"], ["gdp_usd"]
    history = keyed.begin_history(keyed.cast_panel(early(i.staging)), keys, columns, first)
    revised = keyed.cast_panel(late(i.staging))
    for at in (second, third):
        history = stage(keyed.track_changes(history, revised, keys, columns, at), "history")
    shown = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in keyed.PERIOD}
    return history.withColumns(shown | {"gdp_usd": F.col("gdp_usd").cast("decimal(20,2)")})


# --- loads -----------------------------------------------------------------------------------


def table_set(i: Inputs) -> tuple[VersionedSet, runlog.RunLog]:
    base = scratch_dir(i.spark, "tables")
    return VersionedSet(i.spark, base, [load.CLEAN, load.AUDIT]), runlog.RunLog(i.spark, f"{base}-runs")


def shown_clean(df: DataFrame) -> DataFrame:
    return df.drop("cleaned_at").withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))


@query("r4_load_clean", f"SELECT {CLEAN_SQL} FROM clean_rows", "clean_rows")
def r4_load_clean(i: Inputs):
    """The clean panel as it is published together with its audit log."""
    tables, log = table_set(i)
    load.load_clean(i.land().panel_raw, i.panel_dim, tables, log, FIRST_YEAR, LAST_YEAR, i.documented_fixes, i.record_fixes)
    return shown_clean(tables.read(load.CLEAN))


def met_fixes(i: Inputs) -> DataFrame:
    """The documented corrections whose record still has the code, the year and the value they name."""
    records = i.panel_raw.select(
        F.upper(text.trimmed("country_code")).alias("code"), text.trimmed("year").alias("yr"), validate.cells(fixed.INDICATORS, "string").alias("texts")
    )
    met = F.expr("country_code = code AND year = yr") & (text.trimmed(validate.cell("texts", fixed.INDICATORS)) == F.col("original_value"))
    return i.documented_fixes.join(shuffled(records), met, "left_semi")


def maintained(i: Inputs) -> VersionedSet:
    """The published tables of a load without documented corrections, which are applied afterwards, twice."""
    tables, log = table_set(i)
    i.land()
    load.load_clean(i.panel_raw, i.panel_dim, tables, log, FIRST_YEAR, LAST_YEAR, None, i.record_fixes)
    for _ in range(2):
        load.apply_fixes(met_fixes(i), i.panel_raw, tables, log)
    return tables


@query("g7_apply_fixes", f"SELECT {CLEAN_SQL} FROM clean_rows", "clean_rows")
def g7_apply_fixes(i: Inputs):
    """The published clean panel after a maintenance update."""
    return shown_clean(maintained(i).read(load.CLEAN))


@query("g7_apply_fixes_audit", f"SELECT {AUDIT_SQL} FROM audit", "audit")
def g7_apply_fixes_audit(i: Inputs):
    """The published audit log after a maintenance update."""
    return maintained(i).read(load.AUDIT).drop("logged_at")


@query(
    "s6_extract_snapshot",
    f"""SELECT coalesce(n.country_name, d.country_code) AS country_name, d.country_code, coalesce(n.region, '') AS region,
        coalesce(n.income_group, '') AS income_group, CAST(y.yr AS VARCHAR) AS "year",
        {", ".join(f"CAST(p.{c} AS DOUBLE) AS {c}" for c in fixed.INDICATORS)}, 'feed' AS source_file
        FROM panel_dim d CROSS JOIN range({FIRST_YEAR}, {LAST_YEAR + 1}) AS y(yr)
        LEFT JOIN (SELECT 'C' || lpad(CAST(custkey AS VARCHAR), 9, '0') AS code, yr,
            {", ".join(f"arg_max({v}, k) FILTER ({'k % 139 <> 12' if c == 'gdp_usd' else 'TRUE'}) AS {c}" for c, v in VALUE_SOURCES.items())}
            FROM order_facts WHERE k % 61 <> 3 GROUP BY ALL) p ON p.code = d.country_code AND p.yr = y.yr
        LEFT JOIN (SELECT * FROM panel_dim WHERE income_group <> 'BUILDING') n ON n.country_code = d.country_code""",
    "order_facts panel_dim",
)
def s6_extract_snapshot(i: Inputs):
    """A text snapshot made from paged payloads, after every page and cell has been checked."""
    path = scratch_dir(i.spark, "snapshot")
    codes = [(c, code, rank) for c in fixed.INDICATORS for rank, code in enumerate((f"{c}.old", c))]
    codes = i.spark.createDataFrame(codes, "indicator string, code string, rank int")
    info = i.panel_dim.where("income_group <> 'BUILDING'")
    load.extract_snapshot(pages(i), codes, i.panel_dim, info, FIRST_YEAR, LAST_YEAR, path, "feed")
    read = landing.read_text_landing(i.spark, path).drop("ingested_at")
    return read.withColumns({c: F.col(c).cast("double") for c in fixed.INDICATORS})


def run_events(i: Inputs) -> DataFrame:
    """Run events made of the event table, one run per user: signups and views start, purchases and
    clicks end well, errors end in failure."""
    return i.events.selectExpr(
        "CAST(user_id AS STRING) AS run_id",
        "'refresh' AS pipeline_name",
        "CASE WHEN event_type IN ('signup', 'view') THEN 'running' WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status",
        "unix_micros(CAST(ts AS TIMESTAMP)) * 1000 AS at_ns",
        "CASE WHEN event_type IN ('purchase', 'click') THEN event_id END AS staging_rows",
        "CASE WHEN event_type IN ('purchase', 'click') THEN event_id END AS typed_rows",
        "CASE WHEN event_type = 'error' THEN props END AS error_message",
    )


define(
    "runs",
    """SELECT CAST(b.user_id AS VARCHAR) AS run_id, 'refresh' AS pipeline_name, b.began * 1000 AS started_ns,
     e.at_us * 1000 AS finished_ns, CASE WHEN e.user_id IS NULL THEN 'running' WHEN e.bad = 1 THEN 'failed' ELSE 'succeeded' END AS status,
     CASE WHEN e.bad = 0 THEN e.event_id END AS staging_rows, CASE WHEN e.bad = 1 THEN e.props END AS error_message,
     (e.at_us - b.began) / 1e6 AS duration_seconds
  FROM (SELECT user_id, min(epoch_us(ts)) AS began FROM events WHERE event_type IN ('signup', 'view') GROUP BY user_id) b
  LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_us, bad DESC, event_id) AS nth
    FROM (SELECT x.user_id, epoch_us(x.ts) AS at_us, CASE x.event_type WHEN 'error' THEN 1 ELSE 0 END AS bad, x.event_id, x.props
          FROM events x WHERE x.event_type NOT IN ('signup', 'view') AND EXISTS (
            SELECT 1 FROM events s WHERE s.user_id = x.user_id AND s.event_type IN ('signup', 'view') AND s.ts <= x.ts))
  ) e ON e.user_id = b.user_id AND e.nth = 1""",
    [],
)
RUN_COLUMNS = ["run_id", "pipeline_name", "started_ns", "finished_ns", "status", "staging_rows", "error_message", "duration_seconds"]


@query("l_run_log", f"SELECT {', '.join(RUN_COLUMNS)} FROM runs", "runs")
def l_run_log(i: Inputs):
    """State of every run from its events."""
    return runlog.run_states(run_events(i)).select(*RUN_COLUMNS)


@query(
    "o3_last_n",
    f"SELECT {', '.join(RUN_COLUMNS)} FROM runs ORDER BY started_ns DESC, run_id DESC LIMIT 10",
    "runs",
)
def o3_last_n(i: Inputs):
    """The ten latest runs."""
    return runlog.last_runs(runlog.run_states(run_events(i))).select(*RUN_COLUMNS)


# --- injection -------------------------------------------------------------------------------


@query("r6_inject", f"SELECT raw_record_id, {QUOTED} FROM panel_raw", "panel_raw")
def r6_inject(i: Inputs):
    """The text panel with defects, exact duplicates and orphans."""
    return i.panel_raw


def manifest(i: Inputs) -> DataFrame:
    defects = inject.manifest(i.panel_text, key_defects() + indicator_defects(), ["raw_record_id"])
    return defects.unionByName(inject.copy_manifest(i.panel_text, record_copies(), "raw_record_id"))


CHANGED = ["country_name", "country_code", "region", "income_group", "year", *fixed.INDICATORS]
define(
    "manifest",
    " UNION ALL ".join(
        f"""SELECT d.raw_record_id, '{c}' AS column_name, p.{'yr_txt' if c == 'year' else c} AS original_value,
     d."{c}" AS dirty_value FROM panel_dirty d JOIN panel_text p USING (k)
     WHERE d."{c}" IS DISTINCT FROM p.{'yr_txt' if c == 'year' else c}"""
        for c in CHANGED
    )
    + """ UNION ALL SELECT raw_record_id + 1000000000, '*', NULL, NULL FROM panel_dirty WHERE k % 997 = 5
 UNION ALL SELECT raw_record_id + 2000000000, '*', NULL, NULL FROM panel_dirty WHERE k % 991 = 6""",
    ["panel_dirty", "panel_text"],
)


@query(
    "r6_manifest",
    "SELECT raw_record_id, column_name, original_value, dirty_value FROM manifest",
    "manifest",
)
def r6_manifest(i: Inputs):
    """What the injection changed."""
    return manifest(i).drop("defect_type")


@query(
    "a23_defect_summary",
    """SELECT defect_type, count(*) AS defects FROM (
         SELECT CASE WHEN column_name = '*' THEN CASE WHEN raw_record_id >= 2000000000 THEN 'orphan_record' ELSE 'exact_duplicate' END
           WHEN column_name = 'country_name' THEN 'name_variant'
           WHEN column_name = 'country_code' AND dirty_value = 'WLD' THEN 'aggregate_row'
           WHEN column_name = 'country_code' AND dirty_value LIKE 'X%' THEN 'referential_integrity'
           WHEN column_name = 'country_code' THEN 'whitespace_or_case'
           WHEN column_name = 'year' AND dirty_value = '1899' THEN 'out_of_range'
           WHEN column_name = 'year' THEN 'type_drift'
           WHEN dirty_value IN ('', 'NULL', 'unknown', '..') THEN 'null_sentinel'
           WHEN dirty_value LIKE '%.99999997' THEN 'float_artefact'
           WHEN dirty_value LIKE '$%' OR dirty_value LIKE '%\\%' ESCAPE '\\' OR dirty_value LIKE '%,%' THEN 'text_formatting'
           ELSE 'impossible_value' END AS defect_type FROM manifest)
       GROUP BY defect_type ORDER BY defects DESC, defect_type""",
    "manifest",
)
def a23_defect_summary(i: Inputs):
    """Defects by type, most common first."""
    return inject.defect_summary(manifest(i))


@query(
    "a23_affected",
    """SELECT count(*) AS defects, count(DISTINCT raw_record_id) AS affected, (SELECT count(*) FROM panel_raw) AS records,
       CAST(round(CAST(100.0 * count(DISTINCT raw_record_id) / (SELECT count(*) FROM panel_raw) AS DECIMAL(38,8)), 1) AS DOUBLE) AS affected_pct
       FROM manifest""",
    "manifest panel_raw",
)
def a23_affected(i: Inputs):
    """Share of records with a defect."""
    return inject.affected_share(manifest(i), i.panel_raw, "raw_record_id")
