"""Joins whose shape is not left to the optimizer: with hot groups, and with frames as large as the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same(pairs: list[tuple[Column, Column]]) -> Column:
    """NULL-safe equality of all pairs, usable as an equi-join condition."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in pairs])


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that is met by a shuffle, never broadcast.

    For frames with about a row per record.  Spark takes a frame for as large as its compressed files, scaled
    by the number and types of its columns; as rows on the driver it may be tens of times larger.
    """
    return df.hint("merge")


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows with the one row of ``groups`` for their (NULL-safe) keys.

    An equi-join on a hash of the keys, verified by the keys themselves.  A hot group meets one row,
    so that adaptive execution can split its rows among tasks, however many such groups there are.
    """
    hashed = F.xxhash64(*keys)
    right = groups.withColumn("_hash", hashed).withColumnsRenamed({k: f"_g_{k}" for k in ["_hash", *keys]})
    # The hash goes first: it settles almost every comparison of the merge join.
    condition = (F.col("_hash") == F.col("_g__hash")) & same([(F.col(k), F.col(f"_g_{k}")) for k in keys])
    return rows.withColumn("_hash", hashed).join(right, condition).drop("_hash", "_g__hash", *[f"_g_{k}" for k in keys])
