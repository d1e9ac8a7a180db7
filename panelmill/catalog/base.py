"""Registry of named queries, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, ShortType

from panelmill.catalog.inputs import Inputs, with_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and short integers as integers, so that both engines print alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name).cast("int").alias(f.name)
            if isinstance(f.dataType, ShortType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, check: str | None = None, needs: str = ""):
    """Register ``build(inputs)`` under ``name``; ``check`` is its SQL over the inputs ``needs``."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Inputs(spark, sf_dir)))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = with_inputs(check, *needs.split())
        return build

    return register
