"""Groups of rows for comparison, cut into blocks so that no group has to fit one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(members: DataFrame, group: str, node: str, size: int, least: int = 2, once: str | None = None) -> DataFrame:
    """Members of groups of at least ``least``, once per pair of blocks in which they are compared.

    Groups are counted first (one row per task and group is shuffled).  A group of n members is cut
    by a hash of the member into about n / size blocks, columns ``chunk`` and, for the pair of
    blocks, ``i`` <= ``j``.  Every two members of a group meet in exactly one pair of blocks.
    Of groups with the same members only that with the least ``once`` is kept, where such a column is named.
    """
    counted = [F.count("*").alias("members")]
    if once:
        # Members of a group are distinct: two exclusive ors of their hashes and their number tell sets apart.
        counted += [F.bit_xor(F.xxhash64(node)).alias("h"), F.bit_xor(F.xxhash64(node, F.lit(1))).alias("k"), F.min(once).alias("least")]
    sizes = members.groupBy(group).agg(*counted).where(F.col("members") >= least)
    if once:
        first = sizes.groupBy("members", "h", "k").agg(F.min(F.struct("least", group)).alias("first"))
        sizes = first.select(f"first.{group}", "members")
    found = members.join(sizes, group)
    blocks = F.ceil(F.col("members") / size).cast("int")
    found = found.withColumn("blocks", blocks).withColumn("chunk", F.pmod(F.xxhash64(node, F.lit(3)), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    found = found.select(*members.columns, "chunk", other.alias("other"))
    return found.select(*members.columns, "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Columns of a sorted partition in parts that end where a group of equal keys does, and where their groups begin; last, the end."""
    rest: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not len(batch):
            continue
        whole = {c: batch[c].to_numpy() for c in batch.columns}
        if rest is not None:
            whole = {c: np.concatenate([rest[c], v]) for c, v in whole.items()}
        edges = group_edges(whole, keys)
        if len(edges) > 2:
            yield {c: v[: edges[-2]] for c, v in whole.items()}, edges[:-1]
        rest = {c: v[edges[-2] :] for c, v in whole.items()}
    if rest is not None:
        yield rest, np.array([0, len(rest[keys[0]])])


def group_edges(columns: dict[str, np.ndarray], keys: list[str]) -> np.ndarray:
    """Where groups of consecutive rows with equal keys begin, and the number of rows."""
    new = np.logical_or.reduce([columns[k][1:] != columns[k][:-1] for k in keys])
    return np.r_[0, np.flatnonzero(new) + 1, len(columns[keys[0]])]


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Groups of two or more consecutive rows with equal keys, also across batches of a sorted partition."""
    for whole, edges in whole_groups(batches, keys):
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if end - start > 1:
                yield {c: v[start:end] for c, v in whole.items()}
