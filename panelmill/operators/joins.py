"""Matching text records against the reference dimension.

No join here carries a broadcast hint: the dimension may be large.  The optimizer broadcasts a
side below its size threshold; otherwise AQE splits hot partitions of the sort-merge join.
Summaries aggregate the records before they join, so a hot code becomes one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.text import any_of, blank_to_null, classify, distinct_from, trimmed

DIM = ["country_code", *fixed.DIM_ATTRIBUTES]


def _dim(dim: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return dim.select(*[F.col(c).alias(f"{prefix}{c}") for c in columns])


def join_dim(df: DataFrame, dim: DataFrame, attributes: list[str] = tuple(fixed.DIM_ATTRIBUTES)) -> DataFrame:
    """Records whose trimmed code is in the dimension, with its attributes as ``expected_…``."""
    right = _dim(dim, "expected_", ["country_code", *attributes])
    return df.join(right, trimmed("country_code") == F.col("expected_country_code"))


def orphans(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Records whose trimmed code is not in the dimension, blank codes included."""
    right = _dim(dim, "dim_", ["country_code"])
    return df.join(right, blank_to_null("country_code") == F.col("dim_country_code"), "left_anti")


def resolve_two_ways(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Records with the dimension codes found by their trimmed code and by their trimmed name."""
    by_code = dim.select(F.col("country_code").alias("code_by_code"))
    by_name = dim.select(
        F.col("country_code").alias("code_by_name"), F.col("country_name").alias("dim_name")
    )
    return (
        df.join(by_code, trimmed("country_code") == F.col("code_by_code"), "left")
        .join(by_name, trimmed("country_name") == F.col("dim_name"), "left")
        .drop("dim_name")
    )


def classify_entities(df: DataFrame, dim: DataFrame, id_column: str = "raw_record_id") -> DataFrame:
    """Why the code of a record is not in the dimension: aggregate, wrong code, out of scope."""
    issue = classify(
        [
            (F.upper(trimmed("country_code")).isin(fixed.AGGREGATE_CODES), fixed.LABEL_AGGREGATE),
            (F.col("code_by_name").isNotNull(), fixed.LABEL_CODE_MISMATCH),
        ],
        fixed.LABEL_OUTSIDE,
    )
    return (
        resolve_two_ways(df, dim)
        .where(F.col("code_by_code").isNull())
        .select(
            id_column,
            blank_to_null("country_code").alias("raw_country_code"),
            blank_to_null("country_name").alias("raw_country_name"),
            blank_to_null("year").alias("raw_year"),
            F.col("code_by_name").alias("expected_country_code"),
            issue.alias("issue_type"),
        )
    )


def outside_scope(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Records matching the dimension neither by code (any case) nor by name.

    Two anti joins, each an equi-join; one anti join with OR would compare every pair.
    """
    codes, names = _dim(dim, "dim_", ["country_code"]), _dim(dim, "dim_", ["country_name"])
    return df.join(
        codes, F.upper(trimmed("country_code")) == F.col("dim_country_code"), "left_anti"
    ).join(names, trimmed("country_name") == F.col("dim_country_name"), "left_anti")


def resolve(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Records with the dimension rows found by code and by name as structs (NULL if none)."""
    entry = F.struct(*DIM)
    by_code = dim.select(F.col("country_code").alias("_code"), entry.alias("by_code"))
    by_name = dim.select(F.col("country_name").alias("_name"), entry.alias("by_name"))
    return (
        df.join(by_code, F.upper(trimmed("country_code")) == F.col("_code"), "left")
        .join(by_name, trimmed("country_name") == F.col("_name"), "left")
        .drop("_code", "_name")
    )


def match_either(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Records with one dimension row, found by name or else by code; no match, no row.

    The name goes first: it also decides which code a record gets.
    """
    matched = resolve(df, dim).withColumn("matched", F.coalesce("by_name", "by_code"))
    return matched.where(F.col("matched").isNotNull()).drop("by_code", "by_name")


def _summary(df: DataFrame, keys: dict[str, Column], years: bool) -> DataFrame:
    aggregates = [F.count("*").alias("row_count")]
    if years:
        year = blank_to_null("year")
        aggregates += [F.min(year).alias("first_year"), F.max(year).alias("last_year")]
    return df.groupBy(*[c.alias(name) for name, c in keys.items()]).agg(*aggregates)


def attribute_mismatches(df: DataFrame, dim: DataFrame, attribute: str) -> DataFrame:
    """Codes whose attribute differs from the dimension, with counts (and years for names)."""
    named = attribute == "country_name"
    keys = {"country_code": trimmed("country_code"), f"raw_{attribute}": blank_to_null(attribute)}
    counts = _summary(df, keys, years=named)
    columns = ["country_code", "country_name"] + ([] if named else [attribute])
    right = _dim(dim, "expected_", columns)
    joined = counts.join(right, F.col("country_code") == F.col("expected_country_code")).where(
        distinct_from(f"raw_{attribute}", f"expected_{attribute}")
    )
    if not named:
        joined = joined.withColumnRenamed("expected_country_name", "country_name")
    return joined.drop("expected_country_code")


def orphan_summary(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Code and name pairs whose code is not in the dimension, with counts and text years."""
    keys = {"country_code": blank_to_null("country_code"), "country_name": blank_to_null("country_name")}
    return orphans(_summary(df, keys, years=True), dim)


def rows_for_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Records of the listed (country_code, year) keys."""
    right = keys.select(F.col("country_code").alias("_code"), F.col("year").alias("_year")).distinct()
    return df.join(
        right,
        (trimmed("country_code") == F.col("_code")) & (trimmed("year") == F.col("_year")),
        "left_semi",
    )


def conformance_violations(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Records absent from the dimension or differing from it in an attribute."""
    right = _dim(dim, "dim_", DIM)
    wrong = any_of([distinct_from(a, f"dim_{a}") for a in fixed.DIM_ATTRIBUTES])
    joined = df.join(right, F.col("country_code") == F.col("dim_country_code"), "left")
    return joined.where(F.col("dim_country_code").isNull() | wrong).drop(*right.columns)


def exclude_actioned(df: DataFrame, audit: DataFrame, actions: list[str], id_column: str) -> DataFrame:
    """Records without an audit row carrying one of the actions."""
    excluded = audit.where(F.col("action_taken").isin(actions)).select(id_column)
    return df.join(excluded, id_column, "left_anti")


def leaks(df: DataFrame, audit: DataFrame, id_column: str = "raw_record_id") -> DataFrame:
    """Records that still carry an excluding audit action; a correct load has none."""
    excluded = audit.where(F.col("action_taken").isin(fixed.EXCLUDING_ACTIONS)).select(
        id_column, "issue_type", "action_taken"
    )
    return df.join(excluded, id_column)


def overlay_fixes(
    df: DataFrame, audit: DataFrame, fixes: dict[str, str], id_column: str = "raw_record_id"
) -> DataFrame:
    """Replace columns by the audited values of their issue types (column to issue type).

    The audit log is turned to one row per record first, so it is read and joined once.
    """
    picked = [
        F.max(F.when(F.col("issue_type") == issue, F.col("cleaned_value"))).alias(f"_fix_{c}")
        for c, issue in fixes.items()
    ]
    wide = audit.where(F.col("issue_type").isin(list(fixes.values()))).groupBy(id_column).agg(*picked)
    joined = df.join(wide, id_column, "left")
    return joined.withColumns({c: F.coalesce(f"_fix_{c}", c) for c in fixes}).drop(
        *[f"_fix_{c}" for c in fixes]
    )
