"""Coverage of an entity by period grid.

The grid is never built by a cross join: every entity explodes its own periods, in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.functions.text import trimmed
from panelmill.operators.validate import sum_counts


def grid(entities: DataFrame, first: int, last: int, period: str = "year") -> DataFrame:
    """Every (unique) entity row with every period; a reversed range is an error."""
    if first > last:
        raise ValueError("Start year must not be after end year")
    return entities.withColumn(period, F.explode(F.sequence(F.lit(first), F.lit(last))))


def missing_cells(df: DataFrame, dim: DataFrame, first: int, last: int) -> DataFrame:
    """(country_code, country_name, missing_year) of grid cells without a record.

    Records are reduced to distinct keys before the join, so repeated records of one cell never
    meet in one task.
    """
    cells = grid(dim.select("country_code", "country_name"), first, last, "missing_year")
    present = df.select(trimmed("country_code").alias("_code"), trimmed("year").alias("_year")).distinct()
    match = (F.col("country_code") == F.col("_code")) & (F.col("missing_year").cast("string") == F.col("_year"))
    return cells.join(present, match, "left_anti")


def _cells(long_df: DataFrame) -> DataFrame:
    """One row per (indicator, entity, year) with whether it has a value; zero is a value."""
    return long_df.groupBy("indicator", "entity", "year").agg(
        F.max(F.col("value").isNotNull()).alias("has_value")
    )


def _per_indicator(entities: DataFrame, key: str, indicators: list[str]) -> DataFrame:
    listed = F.array(*[F.lit(name) for name in indicators])
    return entities.select(F.col(key).alias("entity")).withColumn("indicator", F.explode(listed))


def coverage(
    long_df: DataFrame, entities: DataFrame, key: str, first: int, last: int, indicators: list[str]
) -> DataFrame:
    """Expected, available, missing and unexpected cells per indicator.

    Indicators without any data are reported too.  Unexpected cells count even without a value;
    available ones need a value.
    """
    if first > last:
        raise ValueError("Start year must not be after end year")
    zero = F.lit(0).cast("bigint")
    expected = (
        _per_indicator(entities, key, indicators)
        .groupBy("indicator")
        .agg((F.count("*") * (last - first + 1)).alias("expected"))
        .select("indicator", "expected", zero.alias("available"), zero.alias("unexpected"))
    )
    known = entities.select(F.col(key).alias("_entity"))
    cells = _cells(long_df).join(known, F.col("entity") == F.col("_entity"), "left")
    inside = F.col("_entity").isNotNull() & F.col("year").between(first, last)
    found = cells.groupBy("indicator").agg(
        zero.alias("expected"),
        F.count_if(inside & F.col("has_value")).alias("available"),
        F.count_if(~inside).alias("unexpected"),
    )
    total = expected.unionByName(found).groupBy("indicator").agg(
        *[F.sum(c).alias(c) for c in ("expected", "available", "unexpected")]
    )
    return total.withColumn("missing", F.col("expected") - F.col("available"))


def missing_list(
    long_df: DataFrame, entities: DataFrame, key: str, first: int, last: int, indicators: list[str]
) -> DataFrame:
    """(indicator, entity, year) of expected cells without a value."""
    wanted = grid(entities.select(F.col(key).alias("entity")), first, last)
    wanted = wanted.withColumn("indicator", F.explode(F.array(*[F.lit(name) for name in indicators])))
    available = _cells(long_df).where("has_value").select("indicator", "entity", "year")
    return wanted.join(available, ["indicator", "entity", "year"], "left_anti")


def cell_sets(long_df: DataFrame, entities: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """One row: sizes of the intersection and the differences of present and expected cells."""
    present = long_df.select("entity", "year").distinct()
    wanted = grid(entities.select(F.col(key).alias("entity")), first, last)
    both = present.intersect(wanted).agg(F.count("*").alias("common"))
    extra = present.subtract(wanted).agg(F.count("*").alias("only_present"))
    lacking = wanted.subtract(present).agg(F.count("*").alias("only_expected"))
    return sum_counts(both, extra, lacking)
