"""Duplicate detection and deterministic ranked deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelmill import fixed
from panelmill.functions.text import blank_to_null, trimmed
from panelmill.operators.skew import join_groups, shuffled


def first_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The best row of every key.

    A rank filter of one lets Spark keep only the best row per key of each partition before the
    shuffle, so a key that holds a third of the table sends one row per partition.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def not_first_per_key(df: DataFrame, id_column: str, keys: list[Column], order: list[Column]) -> DataFrame:
    """All rows but the best of every key, without ranking a whole key in one task.

    The best rows are found as in :func:`first_per_key`; the rest is an anti join on the unique
    record id, which spreads evenly however large a key is.
    """
    return df.join(shuffled(first_per_key(df, keys, order).select(id_column)), id_column, "left_anti")


def panel_keys() -> list[Column]:
    """Raw code and year as written, but for case and outer spaces.

    Year text is not normalized: ``2005.0`` and ``2005`` are different keys here.
    """
    return [F.upper(trimmed("country_code")), trimmed("year")]


def panel_order(id_column: str = "raw_record_id") -> list[Column]:
    """Newest source by name, a missing source first, then the lowest record id."""
    return [trimmed("source_file").desc_nulls_first(), F.col(id_column).asc()]


def duplicate_issues(df: DataFrame, id_column: str = "raw_record_id") -> DataFrame:
    """Audit rows for every record that loses against another one of its key."""
    needed = df.select(id_column, "country_code", "year", "source_file")
    losers = not_first_per_key(needed, id_column, panel_keys(), panel_order(id_column))
    parts = [trimmed(c) for c in ("country_code", "year", "source_file")]
    return losers.select(
        id_column,
        F.lit("row").alias("column_name"),
        F.lit(fixed.DUPLICATE_KEY).alias("issue_type"),
        F.concat_ws(fixed.PART_SEPARATOR, *parts).alias("original_value"),
        F.lit(None).cast("string").alias("cleaned_value"),
        F.lit(fixed.EXCLUDED_DUPLICATE).alias("action_taken"),
    )


def exact_duplicates(df: DataFrame, columns: list[str], id_column: str) -> DataFrame:
    """Groups of records equal in all columns (NULLs equal): size, lowest and highest id.

    The ids of a group are rows of :func:`exact_duplicate_members`, not an array: one group may be
    larger than a task can hold.
    """
    return (
        df.groupBy(*columns)
        .agg(
            F.count("*").alias("duplicate_count"),
            F.min(id_column).alias("first_record_id"),
            F.max(id_column).alias("last_record_id"),
        )
        .where("duplicate_count > 1")
    )


def exact_duplicate_members(df: DataFrame, columns: list[str], id_column: str) -> DataFrame:
    """Every record that has an exact copy, with the size and lowest id of its group."""
    groups = exact_duplicates(df, columns, id_column).drop("last_record_id")
    return join_groups(df.select(id_column, *columns), groups, columns)


def _with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumns({k: blank_to_null(k) for k in keys})


def _names_per_key(df: DataFrame, keys: list[str], name: str, id_column: str) -> DataFrame:
    return (
        _with_keys(df.select(id_column, *keys, name), [*keys, name])
        .groupBy(*keys, name)
        .agg(
            F.count("*").alias("records"),
            F.min(id_column).alias("first_record_id"),
            F.max(id_column).alias("last_record_id"),
        )
    )


def key_duplicates(df: DataFrame, keys: list[str], name: str, id_column: str) -> DataFrame:
    """Keys with several records: record count, number of distinct names, lowest and highest id."""
    return (
        _names_per_key(df, keys, name, id_column)
        .groupBy(*keys)
        .agg(
            F.sum("records").alias("record_count"),
            F.count(name).alias("name_count"),
            F.min("first_record_id").alias("first_record_id"),
            F.max("last_record_id").alias("last_record_id"),
        )
        .where("record_count > 1")
    )


def key_duplicate_names(df: DataFrame, keys: list[str], name: str, id_column: str) -> DataFrame:
    """The distinct names of every duplicated key, one per row, with their record counts."""
    groups = key_duplicates(df, keys, name, id_column).select(*keys, "record_count", "name_count")
    names = _names_per_key(df, keys, name, id_column).where(F.col(name).isNotNull())
    return join_groups(names, groups, keys).select(
        *keys, name, "records", "record_count"
    )


def key_duplicate_members(df: DataFrame, keys: list[str], name: str, id_column: str) -> DataFrame:
    """Every record of a duplicated key."""
    rows = _with_keys(df.select(id_column, *keys), keys)
    groups = rows.groupBy(*keys).agg(F.count("*").alias("record_count")).where("record_count > 1")
    return join_groups(rows, groups, keys)


def dup_keys(df: DataFrame, keys: list[str], count_name: str = "occurrences") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).where(F.col(count_name) > 1)
