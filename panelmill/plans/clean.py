"""The clean pipeline: text records to a typed panel and an audit log.

Shape: one scan joined with the dimension by code and by name; all detectors in one projection;
one shuffle to keep the best record of every key.  The audit log adds one anti join on the record
id for the losing duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.text import as_timestamp, clean_numerics, trim_sql, trimmed
from panelmill.operators.dedup import duplicate_issues, first_per_key, panel_keys, panel_order
from panelmill.operators.detect import all_issues, audit_rows, entry, is_quarantined, when, year_fix
from panelmill.operators.joins import DIM, resolve

ID = "raw_record_id"


def attach_documented_fixes(raw: DataFrame, fixes: DataFrame, columns: list[str]) -> DataFrame:
    """Add the documented correction of each listed column as ``fix_<column>`` (a struct).

    ``fixes`` has (country_code, year, column_name, issue_type, original_value, cleaned_value) and
    applies where code, year and the raw value of that column agree; a column that isn't listed
    raises.  One equi-join: the corrections of a code and year travel as one row.
    """
    known = F.col("column_name").isin(columns)
    unknown = F.concat(F.lit("documented fix of an unknown column: "), F.coalesce("column_name", F.lit("NULL")))
    rules = (
        fixes.groupBy(
            F.col("country_code").alias("_code"),
            F.col("year").alias("_year"),
            F.when(known, F.col("column_name")).otherwise(F.raise_error(unknown)).alias("_column"),
            F.col("original_value").alias("_value"),
        )
        .agg(F.min(F.struct(F.col("issue_type").alias("issue"), F.col("cleaned_value").alias("value"))).alias("_fix"))
        .groupBy("_code", "_year")
        .agg(F.collect_list(F.struct("_column", "_value", "_fix")).alias("_fixes"))
    )
    joined = raw.join(
        rules,
        (F.upper(trimmed("country_code")) == F.col("_code")) & (trimmed("year") == F.col("_year")),
        "left",
    )

    def found(c: str):
        match = F.filter("_fixes", lambda x: (x["_column"] == c) & (x["_value"] == trimmed(c)))
        return F.get(match, F.lit(0))["_fix"]

    return joined.withColumns({f"fix_{c}": found(c) for c in columns}).drop("_code", "_year", "_fixes")


def attach_record_fixes(raw: DataFrame, fixes: DataFrame, column: str) -> DataFrame:
    """Add the correction documented for a record id: ``fixes`` has (raw_record_id, issue_type, cleaned_value).

    It goes before one documented for code and year.
    """
    rules = fixes.groupBy(ID).agg(
        F.min(F.struct(F.col("issue_type").alias("issue"), F.col("cleaned_value").alias("value"))).alias("_by_id")
    )
    joined = raw.join(rules, ID, "left")
    name = f"fix_{column}"
    fix = F.coalesce("_by_id", name) if name in raw.columns else F.col("_by_id")
    return joined.withColumn(name, fix).drop("_by_id")


def documented_issues(columns: list[str]) -> list[str]:
    """Detectors that report the attached corrections."""
    return [
        when(
            (
                f"fix_{c} IS NOT NULL",
                entry(c, f"fix_{c}.issue", trim_sql(c), f"fix_{c}.value", fixed.CORRECTED),
            )
        )
        for c in columns
    ]


def documented_audit(raw: DataFrame, fixes: DataFrame | None, record_fixes: DataFrame | None) -> DataFrame:
    """Audit rows of documented corrections, from the few columns they depend on.

    Only records that a correction names are looked at: ids and (code, year) are few next to the
    records, and both joins keep the matching records alone.  A correction by id goes before one by code.
    """
    rows = raw.select(ID, "country_code", "year", *fixed.INDICATORS)
    parts = []
    if fixes is not None:
        named = fixes.select(F.col("country_code").alias("_code"), F.col("year").alias("_year")).distinct()
        match = (F.upper(trimmed("country_code")) == F.col("_code")) & (trimmed("year") == F.col("_year"))
        parts.append(rows.join(named, match, "left_semi"))
    if record_fixes is not None:
        parts.append(rows.join(record_fixes.select(ID).distinct(), ID, "left_semi"))
    # A record named both ways would come twice.
    few = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1].join(parts[0].select(ID), ID, "left_anti"))
    rows, columns = attach_fixes(few, fixes, record_fixes)
    return audit_rows(rows, documented_issues(columns))


def attach_fixes(
    rows: DataFrame, fixes: DataFrame | None, record_fixes: DataFrame | None
) -> tuple[DataFrame, list[str]]:
    """Records with their ``fix_…`` structs, and the columns that got one."""
    columns = []
    if fixes is not None:
        rows, columns = attach_documented_fixes(rows, fixes, fixed.INDICATORS), [*fixed.INDICATORS]
    if record_fixes is not None:
        rows = attach_record_fixes(rows, record_fixes, "population")
        columns = [*dict.fromkeys([*columns, "population"])]
    return rows, columns


def annotate(raw: DataFrame, dim: DataFrame, first: int, last: int) -> DataFrame:
    """Raw records with the dimension rows found by code and by name and the quarantine flag."""
    return resolve(raw, dim).withColumn("quarantined", F.expr(is_quarantined(first, last)))


def clean_panel(
    annotated: DataFrame,
    bounds: dict[str, tuple] = fixed.BOUNDS,
    fixes: DataFrame | None = None,
    record_fixes: DataFrame | None = None,
) -> DataFrame:
    """Typed records: not quarantined, best of their key, attributes from the dimension.

    A record matched by name takes the dimension row of its name, else that of its code.  Values
    out of bounds or unreadable are NULL.  Years that cannot be read stay NULL for the gates.
    Documented corrections are joined after the duplicates are gone.
    """
    kept = first_per_key(annotated.where("NOT quarantined"), panel_keys(), panel_order())
    kept, columns = attach_fixes(kept, fixes, record_fixes)
    text = {c: f"coalesce(fix_{c}.value, {c})" if c in columns else c for c in bounds}
    typed = clean_numerics(kept, {c: (text[c], lo, hi) for c, (lo, hi) in bounds.items()})
    dim = F.coalesce("by_name", "by_code")
    values = {c: F.col(c) for c in bounds}
    values["population"] = F.round("population", 0)
    return typed.select(
        ID,
        *[dim[c].alias(c) for c in DIM],
        F.coalesce(F.expr(year_fix()), trimmed("year")).try_cast("smallint").alias("year"),
        # Numbers that don't fit their type are NULL, with an audit row of their own.
        *[values[c].try_cast(fixed.CLEAN_TYPES[c]).alias(c) for c in fixed.INDICATORS],
        trimmed("source_file").alias("source_file"),
        as_timestamp("ingested_at").alias("ingested_at"),
    )


def audit_log(
    annotated: DataFrame,
    first: int,
    last: int,
    bounds: dict[str, tuple] = fixed.BOUNDS,
    fixes: DataFrame | None = None,
    record_fixes: DataFrame | None = None,
) -> DataFrame:
    """One row per record, column and issue: detectors, losing duplicates, documented corrections.

    ``annotated`` is read for each of the three and twice for the duplicates; put it through
    ``session.stage`` first unless it is cheap to compute again.
    """
    log = audit_rows(annotated, all_issues(first, last, bounds))
    log = log.unionByName(duplicate_issues(annotated.where("NOT quarantined")))
    if fixes is None and record_fixes is None:
        return log
    return log.unionByName(documented_audit(annotated, fixes, record_fixes))


def review_list(audit: DataFrame, raw: DataFrame, issues: list[str], context: list[str]) -> DataFrame:
    """Audit rows of some issue types with columns of their raw record; blanks shown by a mark."""
    shown = F.coalesce(F.nullif(trimmed("original_value"), F.lit("")), F.lit(fixed.MISSING_MARK))
    picked = audit.where(F.col("issue_type").isin(issues)).withColumn("original_value", shown)
    return picked.join(raw.select(ID, *context), ID)
