"""Keyed defect injection into any text table, with a manifest of what was changed.

Which records are hit is decided by conditions on their own columns, not by random numbers: the
same table always gets the same defects, on any number of partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Defect:
    """Replace ``column`` by ``value`` where ``where`` holds; both are SQL over the clean columns."""

    column: str
    where: str
    value: str
    kind: str


def _chains(df: DataFrame, defects: list[Defect], what) -> dict[str, str]:
    """Per defective column, the first-rule-wins branches over ``what(defect)``."""
    chains: dict[str, str] = {}
    for d in defects:
        if d.column not in df.columns:
            raise ValueError(f"no column {d.column} to put a defect into")
        chains[d.column] = f"{chains.get(d.column, 'CASE')} WHEN {d.where} THEN {what(d)}"
    return chains


def apply_defects(df: DataFrame, defects: list[Defect]) -> DataFrame:
    """One projection: every column takes its first matching defect, or stays as it is."""
    chains = _chains(df, defects, lambda d: d.value)
    return df.selectExpr(*[f"{chains[c]} ELSE {c} END AS {c}" if c in chains else c for c in df.columns])


@dataclass(frozen=True)
class Copy:
    """Repeat a record under ``id + offset`` where ``where`` holds, with replaced columns."""

    where: str
    offset: int
    kind: str
    replace: dict[str, str] = field(default_factory=dict)


def append_copies(df: DataFrame, copies: list[Copy], id_column: str) -> DataFrame:
    """Every record followed by its copies, in one pass over the table."""
    numbers = [f"CASE WHEN {c.where} THEN {n} END" for n, c in enumerate(copies, 1)]
    repeated = df.withColumn("_copy", F.expr(f"explode(array(0, {', '.join(numbers)}))"))
    values: dict[str, str] = {}
    for n, c in enumerate(copies, 1):
        for column, value in (c.replace | {id_column: f"{id_column} + {c.offset}"}).items():
            values[column] = f"{values.get(column, 'CASE')} WHEN _copy = {n} THEN {value}"
    return repeated.where("_copy IS NOT NULL").selectExpr(
        *[f"{values[c]} ELSE {c} END AS {c}" if c in values else c for c in df.columns]
    )


def manifest(df: DataFrame, defects: list[Defect], keys: list[str]) -> DataFrame:
    """(keys…, column_name, defect_type, original_value, dirty_value): one row per defect that changed a record."""
    kinds = _chains(df, defects, lambda d: f"'{d.kind}'")
    values = _chains(df, defects, lambda d: d.value)
    entries = [
        f"CASE WHEN {kinds[c]} END IS NOT NULL THEN named_struct('column_name', '{c}', "
        f"'defect_type', {kinds[c]} END, 'original_value', {c}, 'dirty_value', {values[c]} END) END"
        for c in kinds
    ]
    found = df.select(*keys, F.expr(f"explode(array({', '.join(entries)}))").alias("entry"))
    return found.where("entry IS NOT NULL").select(*keys, "entry.*")


def copy_manifest(df: DataFrame, copies: list[Copy], id_column: str) -> DataFrame:
    """(id, column_name, defect_type, original_value, dirty_value): one row per added copy."""
    entries = [
        f"CASE WHEN {c.where} THEN named_struct('id', {id_column} + {c.offset}, 'kind', '{c.kind}') END"
        for c in copies
    ]
    found = df.select(F.expr(f"explode(array({', '.join(entries)}))").alias("entry")).where("entry IS NOT NULL")
    return found.selectExpr(
        f"entry.id AS {id_column}",
        "'*' AS column_name",
        "entry.kind AS defect_type",
        "CAST(NULL AS STRING) AS original_value",
        "CAST(NULL AS STRING) AS dirty_value",
    )


def defect_summary(manifest_df: DataFrame) -> DataFrame:
    """Defects by type, most common first."""
    return (
        manifest_df.groupBy("defect_type")
        .agg(F.count("*").alias("defects"))
        .orderBy(F.desc("defects"), "defect_type")
    )


def affected_share(manifest_df: DataFrame, total: DataFrame, key: str) -> DataFrame:
    """One row: defects, records affected, records in all, share of records affected in percent."""
    hit = manifest_df.groupBy(key).agg(F.count("*").alias("defects")).agg(
        F.sum("defects").alias("defects"), F.count("*").alias("affected"), F.lit(0).cast("bigint").alias("records")
    )
    everything = total.agg(
        F.lit(0).cast("bigint").alias("defects"),
        F.lit(0).cast("bigint").alias("affected"),
        F.count("*").alias("records"),
    )
    sums = reduce(DataFrame.unionByName, [hit, everything]).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("defects", "affected", "records")]
    )
    share = F.col("affected").cast("decimal(38,10)") * 100 / F.nullif(F.col("records"), F.lit(0))
    return sums.withColumn("affected_pct", F.round(share, 1))
