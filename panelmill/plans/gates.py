"""Quality gates of a staged batch: one report row, first failing gate first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.text import (
    any_of,
    as_decimal,
    as_integer,
    blank_to_null,
    distinct_from,
    is_finite,
    is_valid,
    out_of_range,
    passed,
)
from panelmill.operators.dedup import dup_keys
from panelmill.operators.validate import sum_counts, verify_fixes

OPEN_BOUNDS = {
    "gdp_usd": (0, None),
    "unemployment_rate": (0, 100),
    "co2_emissions_per_capita": (0, None),
    "access_to_electricity_pct": (0, 100),
}


class GateFailure(RuntimeError):
    """A staged batch was rejected; the message is that of the first failing gate."""


def row_counts(source: str, first: int, last: int) -> list[Column]:
    """Counts of staged rows and of violations of identity, values and ranges, as aggregates.

    They belong to rows with ``_known``, the accepted code each one found.
    """
    identity = any_of(
        [
            F.col("_known").isNull(),
            blank_to_null("year").isNull(),
            ~passed(is_valid("year", "integer")),
            distinct_from("source_file", F.lit(source)),
            blank_to_null("ingested_at").isNull(),
            ~passed(is_valid("ingested_at", "timestamp")),
            ~passed(is_finite("ingested_at")),
        ]
    )
    values = any_of(
        [
            # A valid number that doesn't fit the decimal type is a violation, never a silent NULL.
            blank_to_null(c).isNull() | ~passed(is_valid(c, "numeric")) | ~passed(is_finite(c)) | as_decimal(c).isNull()
            for c in fixed.INDICATORS
        ]
    )
    population = as_decimal("population")
    ranges = any_of(
        [
            out_of_range(as_integer("year"), first, last),
            *[out_of_range(as_decimal(c), lo, hi) for c, (lo, hi) in OPEN_BOUNDS.items()],
            passed(population <= 0),
            passed(population > fixed.MAX_POPULATION),
            # On the text as well: a cast rounds digits beyond the scale.
            passed(population != F.floor(population)) | passed(F.col("population").rlike(r"^\s*[+-]?\d*\.0*[1-9]\d*\s*$")),
            passed(as_decimal("life_expectancy") <= 0),
        ]
    )
    return [
        F.count(F.lit(1)).alias("staging_rows"),
        F.count_if(identity).alias("identity_violations"),
        F.count_if(values).alias("value_violations"),
        F.count_if(ranges).alias("range_violations"),
    ]


def with_known(staging: DataFrame, codes: DataFrame) -> DataFrame:
    """Staged rows with ``_known``, their code if it is accepted."""
    known = codes.select(F.col("country_code").alias("_known")).distinct()
    return staging.join(known, F.col("country_code") == F.col("_known"), "left")


def gate_report(staging: DataFrame, codes: DataFrame, source: str, first: int, last: int) -> DataFrame:
    """One row: staged rows and violations of identity, values, ranges and key uniqueness.

    ``codes`` has the accepted country codes.  Row rules share one pass; the key gate adds one
    aggregation.  Casts are tried, never raised, so the gates do not depend on one another.
    """
    per_row = with_known(staging, codes).agg(*row_counts(source, first, last))
    keys = staging.select("country_code", as_integer("year").alias("year"))
    duplicates = dup_keys(keys, ["country_code", "year"]).agg(F.count("*").alias("duplicate_keys"))
    return sum_counts(per_row, duplicates)


def observed(staging: DataFrame, codes: DataFrame, source: str, first: int, last: int) -> tuple[DataFrame, Observation]:
    """The staged rows, and the row counts of :func:`gate_report`, known once the rows are written.

    The counts are metrics of that write: the batch isn't read again for them.
    """
    seen = Observation("gates")
    marked = with_known(staging, codes).observe(seen, *row_counts(source, first, last))
    return marked.select(*staging.columns), seen


def key_counts(staging: DataFrame) -> dict:
    """Keys that occur more than once, and the periods of a batch, in one pass over its keys."""
    keys = staging.groupBy("country_code", as_integer("year").alias("year")).agg(F.count("*").alias("n"))
    found = keys.agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.collect_set("year").alias("periods"), F.count_if(F.col("year").isNull()).alias("none"))
    row = found.first()
    return {"duplicate_keys": row["duplicate_keys"], "periods": [*sorted(row["periods"]), *([None] if row["none"] else [])]}


def first_failure(report: DataFrame, expected_rows: int | None) -> DataFrame:
    """The report with the message of the first failing gate, NULL if all pass.

    Without an expected number of rows any number but zero is accepted.
    """
    if expected_rows is None:
        wrong_count, text = F.col("staging_rows") == 0, fixed.MESSAGE_ROWS.format(rows="some")
    else:
        wrong_count = F.col("staging_rows") != expected_rows
        text = fixed.MESSAGE_ROWS.format(rows=expected_rows)
    message = (
        F.when(wrong_count, text)
        .when(F.col("identity_violations") > 0, fixed.MESSAGE_IDENTITY)
        .when(F.col("value_violations") > 0, fixed.MESSAGE_VALUES)
        .when(F.col("range_violations") > 0, fixed.MESSAGE_RANGES)
        .when(F.col("duplicate_keys") > 0, fixed.MESSAGE_DUPLICATE)
    )
    return report.withColumn("message", message)


def require_counts(spark: SparkSession, counts: dict, expected_rows: int | None) -> dict:
    """The counts of a batch, or GateFailure with the message of the first failing gate."""
    names = ["staging_rows", "identity_violations", "value_violations", "range_violations", "duplicate_keys"]
    report = spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))
    return require(first_failure(report, expected_rows))


def require(report: DataFrame) -> dict:
    """The report row as a dict, or GateFailure with its message."""
    row = report.first().asDict()
    if row["message"] is not None:
        raise GateFailure(row["message"])
    return row


def fix_conditions(clean: DataFrame, audit: DataFrame, fixes: DataFrame, raw: DataFrame) -> DataFrame:
    """One row of counts around a maintenance update of documented fixes.

    Targets whose raw value still is the documented one (before), and targets whose clean value
    and audit row carry the correction (after), next to raw and clean row counts.
    """
    checked = verify_fixes(fixes, clean, raw, audit)
    return sum_counts(
        raw.agg(F.count("*").alias("raw_rows")),
        clean.agg(F.count("*").alias("cleaned_rows")),
        checked.agg(
            F.count("*").alias("documented_fixes"),
            F.count_if(F.col("raw_value").isNotNull()).alias("targets_found"),
            F.count_if("passed").alias("targets_corrected"),
        ),
    )


def require_fixed(conditions: DataFrame) -> dict:
    """The counts of :func:`fix_conditions`, or GateFailure if a target is missing or uncorrected."""
    row = conditions.first().asDict()
    if row["targets_found"] != row["documented_fixes"]:
        raise GateFailure(f"{row['targets_found']} of {row['documented_fixes']} documented targets found")
    if row["targets_corrected"] != row["documented_fixes"]:
        raise GateFailure(f"{row['targets_corrected']} of {row['documented_fixes']} documented targets corrected")
    return row
