"""Read-only profiling of text records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.text import (
    any_of,
    as_decimal,
    blank_to_null,
    classify,
    guarded,
    is_valid,
    matches,
    out_of_range,
    passed,
    trimmed,
)
from panelmill.operators.validate import sum_counts


def count_columns(df: DataFrame, conditions: dict[str, Column], count_name: str) -> DataFrame:
    """(column_name, count) of a condition per column, from one pass without an unpivoted table."""
    wide = df.agg(*[F.count_if(condition).alias(c) for c, condition in conditions.items()])
    return wide.unpivot([], list(conditions), "column_name", count_name)


def missing_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing or blank values per column; columns without any are left out."""
    conditions = {c: blank_to_null(c).isNull() for c in columns}
    return count_columns(df, conditions, "missing_or_blank_count").where("missing_or_blank_count > 0")


def missing_by_record(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """Records with missing values and the list of those columns in order; no shuffle."""
    names = [F.when(blank_to_null(c).isNull(), F.lit(c)) for c in columns]
    listed = F.concat_ws(", ", *names)
    return df.select(*ids, listed.alias("missing_columns")).where("missing_columns <> ''")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: NULL values per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def blank_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: missing values per column as total minus non-blank values."""
    return df.agg(
        *[(F.count("*") - F.count(F.nullif(F.trim(F.col(c)), F.lit("")))).alias(f"missing_{c}") for c in columns]
    )


def source_counts(df: DataFrame, column: str = "source_file") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows_from_source"))


def distinct_count(df: DataFrame, keys: list[Column | str], name: str, rows: str | None = None) -> DataFrame:
    """One row: distinct keys (of one key only those that aren't NULL), and optionally all rows.

    Counted in two levels, groups and then their number, which needs no row to be repeated; several
    such counts are put side by side by ``sum_counts``, each reading its own columns only.
    """
    counted = df.groupBy(*[(F.col(k) if isinstance(k, str) else k).alias(f"_{n}") for n, k in enumerate(keys)]).agg(F.count("*").alias("_n"))
    whole = F.count("*") if len(keys) > 1 else F.count("_0")
    return counted.agg(whole.alias(name), *([F.sum("_n").alias(rows)] if rows else []))


def key_uniqueness(df: DataFrame, id_column: str, keys: list[str]) -> DataFrame:
    """Rows, distinct ids, distinct composite keys (NULL parts count) and whether all agree."""
    ids = distinct_count(df, [id_column], "unique_record_ids", "total_rows")
    # A constant second part, as a NULL key counts here.
    both = distinct_count(df, [*keys, F.lit(0)], "unique_country_years")
    out = sum_counts(ids, both).select("total_rows", "unique_record_ids", "unique_country_years")
    rows = F.col("total_rows")
    return out.withColumn(
        "passed", (rows == F.col("unique_record_ids")) & (rows == F.col("unique_country_years"))
    )


def unpivot_values(df: DataFrame, ids: list[str], columns: list[str], value: str = "raw_value") -> DataFrame:
    """One row per record and column."""
    return df.unpivot(ids, columns, "column_name", value)


def year_issues(df: DataFrame, first: int, last: int, id_column: str = "raw_record_id") -> DataFrame:
    """Records whose year is missing, has another format, or lies outside the period."""
    year = trimmed("year")
    bad = guarded(year, fixed.YEAR_PLAIN, "int", lambda y: ~y.between(first, last), True)
    label = classify(
        [
            (blank_to_null("year").isNull(), fixed.LABEL_YEAR_MISSING),
            (~matches(year, fixed.YEAR_PLAIN), fixed.LABEL_YEAR_FORMAT),
        ],
        f"outside {first}-{last} range",
    )
    return df.where(F.coalesce(bad, F.lit(True))).select(
        id_column, "country_code", "country_name", F.col("year").alias("raw_year"), label.alias("issue_type")
    )


def _per_indicator(df: DataFrame, ids: list[str], keep: dict[str, Column], extra=()) -> DataFrame:
    """One row per indicator value that meets its condition.

    Row-local: tests, explode and the filter on hits stay in one generated loop.
    """
    entries = [
        F.when(
            passed(condition),
            F.struct(F.lit(c).alias("column_name"), trimmed(c).alias("raw_value"), *[e(c) for e in extra]),
        )
        for c, condition in keep.items()
    ]
    hits = df.select(*ids, F.explode(F.array(*entries)).alias("hit")).where(F.col("hit").isNotNull())
    return hits.select(*ids, "hit.*")


def non_numeric(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """Non-blank indicator values that are not plain numbers; a leading plus is accepted here."""
    keep = {
        c: blank_to_null(c).isNotNull() & ~matches(trimmed(c), fixed.NUMBER_SIGNED) for c in columns
    }
    return _per_indicator(df, ids, keep)


def range_profile(df: DataFrame, ids: list[str], bounds: dict[str, tuple]) -> DataFrame:
    """Plain numbers outside their bounds, with the bounds."""

    def condition(c: str) -> Column:
        lo, hi = bounds[c]
        return guarded(
            trimmed(c), fixed.NUMBER_SIGNED, fixed.OFFICIAL_DECIMAL, lambda v: out_of_range(v, lo, hi), False
        )

    def bound(position: int, name: str):
        return lambda c: F.lit(bounds[c][position]).cast("int").alias(name)

    extra = [bound(0, "minimum_allowed"), bound(1, "maximum_allowed")]
    return _per_indicator(df, ids, {c: condition(c) for c in bounds}, extra)


def inconvertible(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """Staged indicator values that could not be cast to a number; missing values pass."""
    return _per_indicator(df, ids, {c: ~is_valid(c, "numeric") for c in columns})


def staging_range_violations(df: DataFrame, bounds: dict[str, tuple], positive: list[str]) -> DataFrame:
    """Staged records with a value outside its range; ``positive`` columns also exclude zero."""
    wrong = [out_of_range(as_decimal(c), lo, hi) for c, (lo, hi) in bounds.items()]
    wrong += [passed(as_decimal(c) <= 0) for c in positive]
    return df.where(any_of(wrong))
