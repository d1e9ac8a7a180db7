"""Loads that publish everything or nothing: an extract, the clean track, a maintenance update.

Each one checks what it has read before it writes, and what it has written before it publishes.  A
condition that fails raises ``GateFailure``; what was published before stays the current version.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.text import any_of, beyond_sql, decimal_sql, number_text_sql, out_of_range, trimmed
from panelmill.operators.coverage import coverage
from panelmill.operators.dedup import dup_keys
from panelmill.operators.keyed import upsert
from panelmill.operators.skew import shuffled
from panelmill.operators.validate import cell, cells, reconcile, verify_fixes
from panelmill.plans.clean import annotate, audit_log, clean_panel
from panelmill.plans.gates import GateFailure
from panelmill.plans.runlog import RunLog
from panelmill.session import stage
from panelmill.sources.landing import write_text
from panelmill.sources.payload import assemble_panel, first_nonempty_source, split_pages
from panelmill.sources.versions import Conflict, Version, VersionedSet

KEYS = ["country_code", "year"]
AUDIT_KEYS = ["raw_record_id", "column_name", "issue_type"]
CLEAN, AUDIT = "clean", "audit"


def require_none(counts: dict[str, int]) -> None:
    """GateFailure with the names and numbers of the conditions that don't count zero."""
    broken = [f"{name}: {n}" for name, n in counts.items() if n]
    if broken:
        raise GateFailure("; ".join(broken))


# --- extract ---------------------------------------------------------------------------------


def extract_snapshot(
    pages: DataFrame,
    codes: DataFrame,
    entities: DataFrame,
    info: DataFrame,
    first: int,
    last: int,
    path: str,
    source: str,
    key: str = "country_code",
) -> DataFrame:
    """Pages of a feed to a text snapshot at ``path``; returns the coverage per indicator.

    ``codes`` has (indicator, code, rank): the feed's codes for an indicator in order of preference; the first
    one with any value is taken.  Pages or rows that cannot be read, and values for an entity or a
    period that wasn't asked for, stop the load before anything is written.  Missing values are no
    failure: they are counted in the coverage and stay blank.
    """
    cells, rejected = split_pages(pages)
    problems = {r["problem"]: r["count"] for r in rejected.groupBy("problem").count().orderBy("problem").collect()}
    require_none(problems)
    by_code = cells.withColumnRenamed("indicator", "code").join(codes.select("indicator", "code"), "code")
    values = stage(first_nonempty_source(by_code, codes).select("indicator", "entity", "year", "value"), "values")
    report = stage(coverage(values, entities, key, first, last, fixed.INDICATORS), "coverage")
    require_none({f"unexpected cells of {r['indicator']}": r["unexpected"] for r in report.where("unexpected > 0").orderBy("indicator").collect()})
    panel = assemble_panel(values, entities, info, key, first, last, fixed.INDICATORS)
    stamped = panel.withColumns({"source_file": F.lit(source), "ingested_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")})
    write_text(stamped.select(*[F.col(c).cast("string").alias(c) for c in fixed.SOURCE_COLUMNS]), path)
    return report


# --- clean track -----------------------------------------------------------------------------


def clean_violations(first: int, last: int, bounds: dict[str, tuple]) -> list[Column]:
    """Counts of the constraints of a clean record, as aggregates."""
    required = ["raw_record_id", "country_code", "country_name", "region", "income_group", "year", "source_file"]
    ranges = [out_of_range("year", first, last), *[out_of_range(c, lo, hi) for c, (lo, hi) in bounds.items()]]
    return [
        F.count_if(any_of([F.col(c).isNull() for c in required])).alias("records without a required value"),
        F.count_if(any_of(ranges)).alias("records outside the accepted range"),
    ]


def load_clean(
    raw: DataFrame,
    dim: DataFrame,
    tables: VersionedSet,
    log: RunLog,
    first: int,
    last: int,
    fixes: DataFrame | None = None,
    record_fixes: DataFrame | None = None,
    bounds: dict[str, tuple] = fixed.BOUNDS,
    name: str = "clean_load",
) -> Version:
    """Raw text to the clean panel and its audit log, both published by one commit or neither.

    The constraints of a clean record are counted while it is written, the keys on what was written: a
    year that only its correction brings out of the period, say, ends the load with nothing
    published.  Raw records must equal clean, quarantined and excluded ones.  Clean rows get
    ``cleaned_at``, audit rows ``logged_at``.
    """

    def make(base: Version | None) -> Version:
        rows = stage(annotate(raw, dim, first, last), "annotated")
        seen = Observation("clean")
        clean = clean_panel(rows, bounds, fixes, record_fixes).observe(seen, *clean_violations(first, last, bounds))
        frames = {
            CLEAN: clean.withColumn("cleaned_at", F.current_timestamp()),
            AUDIT: audit_log(rows, first, last, bounds, fixes, record_fixes).withColumn("logged_at", F.current_timestamp()),
        }
        version = tables.write(frames, base)
        written = tables.read(CLEAN, version), tables.read(AUDIT, version)
        counts = dict(seen.get)
        counts["repeated records"] = dup_keys(written[0], ["raw_record_id"]).count()
        counts["repeated keys"] = dup_keys(written[0], KEYS).count()
        counts["repeated audit entries"] = dup_keys(written[1], AUDIT_KEYS).count()
        counts["records not accounted for"] = int(not reconcile(rows, *written).first()["passed"])
        require_none(counts)
        return version

    return published(tables, log, name, make, lambda v: (tables.rows(CLEAN, v), tables.rows(AUDIT, v)))


def published(
    tables: VersionedSet, log: RunLog, name: str, make: Callable[[Version | None], Version], rows: Callable[[Version], tuple[int, int]], attempts: int = 5
) -> Version:
    """Log, make a version from the current one and publish it; after a conflict make it anew."""
    run_id = log.start(name)
    try:
        for attempt in range(attempts):
            version = make(tables.current())
            try:
                tables.publish(version, run_id)
                break
            except Conflict:
                if attempt + 1 == attempts:
                    raise
    except Exception as error:
        log.fail(run_id, name, str(error))
        raise
    log.succeed(run_id, name, *rows(version))
    return version


# --- maintenance -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Expected:
    """Row counts that a maintenance update was written for; None for any."""

    raw_rows: int | None = None
    clean_rows: int | None = None


def targets(fixes: DataFrame, clean: DataFrame, raw: DataFrame, bounds: dict[str, tuple] = fixed.BOUNDS) -> DataFrame:
    """The documented fixes with the record each one is for, and whether that is still what was documented.

    ``sound`` asks that the raw record has the code, the period and the raw value of the fix, and that the
    clean cell holds either the number of that raw value or already the correction.
    """
    typed = clean.select("raw_record_id", *KEYS, cells(fixed.INDICATORS, "decimal(38,4)").alias("typed"))
    texts = raw.select(
        "raw_record_id", F.upper(trimmed("country_code")).alias("raw_code"), trimmed("year").alias("raw_year"), cells(fixed.INDICATORS, "string").alias("texts")
    )
    rules = fixes.withColumns(
        {
            "year": F.col("year").cast("smallint"),
            "wanted": F.expr(decimal_sql("cleaned_value")).cast("decimal(38,4)"),
            "old_text": F.expr(number_text_sql("original_value")),
        }
    ).withColumn("old_number", F.expr(decimal_sql("old_text")))
    # What cleaning makes of the raw value: NULL where it is out of bounds or no number.
    beyond = " ".join(f"WHEN column_name = '{c}' THEN {beyond_sql('old_text', 'old_number', lo, hi)}" for c, (lo, hi) in bounds.items())
    old = F.expr(f"CASE WHEN NOT (CASE {beyond} END) THEN old_number END").cast("decimal(38,4)")
    met = rules.join(shuffled(typed), KEYS, "left").join(shuffled(texts), "raw_record_id", "left")
    now = cell("typed", fixed.INDICATORS)
    sound = (
        F.col("raw_record_id").isNotNull()
        & F.col("wanted").isNotNull()
        & (F.col("raw_code") == F.col("country_code"))
        & (F.col("raw_year") == F.col("year").cast("string"))
        & (trimmed(cell("texts", fixed.INDICATORS)) == F.col("original_value"))
        & (now.eqNullSafe(F.col("wanted")) | now.eqNullSafe(old))
    )
    return met.select("raw_record_id", *KEYS, "column_name", "issue_type", "original_value", "cleaned_value", "wanted", F.coalesce(sound, F.lit(False)).alias("sound"))


def corrected(clean: DataFrame, found: DataFrame) -> DataFrame:
    """The clean table with the targets' cells set; only rows that really change get a new ``cleaned_at``."""
    wide = found.groupBy("raw_record_id").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "wanted"))).alias("_new"))
    joined = clean.join(wide, "raw_record_id", "left")
    new = {c: F.col("_new")[c].cast(joined.schema[c].dataType) for c in fixed.INDICATORS}
    changed = any_of([new[c].isNotNull() & ~new[c].eqNullSafe(F.col(c)) for c in fixed.INDICATORS])
    values = {c: F.coalesce(new[c], F.col(c)) for c in fixed.INDICATORS}
    stamp = {"cleaned_at": F.when(changed, F.current_timestamp()).otherwise(F.col("cleaned_at"))}
    return joined.withColumns(values | stamp).select(*clean.columns)


def relogged(audit: DataFrame, found: DataFrame) -> DataFrame:
    """The audit log with one row per target; a row that says the same already keeps its ``logged_at``."""
    rows = found.select(
        "raw_record_id", "column_name", "issue_type", "original_value", "cleaned_value",
        F.lit(fixed.CORRECTED).alias("action_taken"), F.current_timestamp().alias("logged_at"),
    )
    said = ["original_value", "cleaned_value", "action_taken"]
    same = rows.join(shuffled(audit.select(*AUDIT_KEYS, *said)), [*AUDIT_KEYS, *said], "left_semi")
    news = rows.join(same.select(*AUDIT_KEYS), AUDIT_KEYS, "left_anti")
    return upsert(audit, news, AUDIT_KEYS, [*said, "logged_at"])


def apply_fixes(
    fixes: DataFrame, raw: DataFrame, tables: VersionedSet, log: RunLog, expected: Expected = Expected(), name: str = "documented_fixes"
) -> Version:
    """Apply documented corrections to the published clean panel and its audit log, all or none.

    ``fixes`` has (country_code, year, column_name, issue_type, original_value, cleaned_value).  Before: the
    row counts are as expected and every target is still what was documented.  After, on what was
    written: every target carries its correction in the panel and in the log.  Running it again
    publishes the same rows with the same times.
    """
    fixes = stage(fixes, "fixes")

    def make(base: Version | None) -> Version:
        if base is None:
            raise GateFailure("nothing is published yet")
        clean, audit = tables.read(CLEAN, base), tables.read(AUDIT, base)
        found = stage(targets(fixes, clean, raw), "targets")
        counts = {"documented fixes without their target": found.where("NOT sound").count()}
        for what, want, have in (("raw", expected.raw_rows, raw.count), ("clean", expected.clean_rows, lambda: tables.rows(CLEAN, base))):
            if want is not None:
                counts[f"{what} rows too many or too few"] = abs(have() - want)
        counts["fixes of one cell that contradict each other"] = dup_keys(found, ["raw_record_id", "column_name"]).count()
        require_none(counts)
        version = tables.write({CLEAN: corrected(clean, found), AUDIT: relogged(audit, found)}, base)
        checked = verify_fixes(fixes, tables.read(CLEAN, version), raw, tables.read(AUDIT, version))
        require_none({"targets without their correction": checked.where("NOT passed").count()})
        return version

    return published(tables, log, name, make, lambda v: (fixes.count(), tables.rows(CLEAN, v)))
