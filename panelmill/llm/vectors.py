"""Near duplicates among vectors by p-stable hashing, verified by exact cosines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from panelmill.llm.blocks import block_pairs, group_edges, whole_groups
from panelmill.llm.common import prepare
from panelmill.llm.components import components
from panelmill.session import stage

TABLES, PROJECTIONS, WIDTH = 64, 18, 2.0
MEMBERS = 512
# Blocks of up to so many members are compared together, by shifted rows.
FEW = 8
# Numbers that are compared at once.
CELLS = 2_000_000
BATCH = 4000
BLOCK = ["bucket", "i", "j"]


def codes(x: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """Cell of every normalised row in every table: the integer parts of (a.x + b) / width, hashed to 32 bits.

    Cells of equal hash are one cell.
    """
    rng = np.random.default_rng([seed, x.shape[1]])
    a = rng.standard_normal((x.shape[1], tables * projections))
    b = rng.uniform(0, width, tables * projections)
    cells = np.floor((x @ a + b) / width).astype(np.int64).reshape(len(x), tables, projections)
    factors = rng.integers(1, 2**62, projections, dtype=np.int64) * 2 + 1
    mixed = (cells.view(np.uint64) * factors.view(np.uint64)).sum(2)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)).astype("<u4").view("<i4")


def pairs_of(columns: dict[str, np.ndarray], x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places a < b of rows that meet in a block and are similar enough, of rows sorted by block and chunk.

    Members of one block meet in the pair of it with itself; in a pair of two, those of the one meet those of the other.
    """
    edges = group_edges(columns, BLOCK)
    sizes = np.diff(edges)
    number = np.repeat(np.arange(len(sizes)), sizes)
    itself, chunk = columns["i"] == columns["j"], columns["chunk"]
    few = (sizes <= FEW)[number]
    found = []
    for shift in range(1, FEW):
        a = np.flatnonzero(few[:-shift] & (number[:-shift] == number[shift:]))
        a = a[itself[a] | (chunk[a] != chunk[a + shift])]
        a = a[np.einsum("ij,ij->i", x[a], x[a + shift]) >= least]
        found.append((a, a + shift))
    for k in np.flatnonzero(sizes > FEW):
        start, end = edges[k], edges[k + 1]
        middle = start if itself[start] else start + np.searchsorted(chunk[start:end], columns["j"][start])
        linked = x[start : end if itself[start] else middle] @ x[middle:end].T >= least
        a, b = np.nonzero(np.triu(linked, 1) if itself[start] else linked)
        found.append((a + start, b + middle))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def met_first(cells: np.ndarray, t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether table t is the first in which the rows a and b share a cell."""
    step = max(1, CELLS // cells.shape[1])
    parts = []
    for k in range(0, len(a), step):
        p, q = a[k : k + step], b[k : k + step]
        earlier = np.arange(cells.shape[1])[None, :] < t[p][:, None]
        parts.append(~((cells[p] == cells[q]) & earlier).any(1))
    return np.concatenate([*parts, np.empty(0, dtype=bool)])


def near(
    vectors: DataFrame,
    least: float = 0.93,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = 7,
) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept.

    Two vectors of equal, non-null label and equal length link where their cosine in double precision is at least
    ``least``.  Vectors that are null, empty or zero or hold null or non-finite components link with nothing and are
    components of their own, as rows with a null label are.  A null vec_id takes part; a component of null
    ids only has a null id.  Rows of equal vec_id are separate vectors.

    Equal vectors of a label are one representative with a weight.  Representatives are hashed into ``tables`` tables of ``projections``
    quantised random projections: at distance 0.374 (cosine 0.93) one projection agrees with probability 0.85, all 18
    with 0.055, and some table with 0.97; at cosine 0.95 with 0.997.  Of buckets with the same members, as tight clusters
    have in many tables, only the first is kept.  Buckets are cut into blocks and compared block by block in
    separate tasks; a pair counts in the first table where it meets.  A task returns counts per member and the
    links of a spanning forest, never all pairs.
    """
    spark = vectors.sparkSession
    item = F.col("embedding")
    finite = F.size(F.filter(item, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))) == 0
    usable = F.col("label").isNotNull() & item.isNotNull() & (F.size(item) > 0) & finite
    usable = usable & (F.size(F.filter(item, lambda v: v != 0)) > 0)
    rows = vectors.select("vec_id", "label", "embedding", F.coalesce(usable, F.lit(False)).alias("usable"))
    name = F.xxhash64(F.size("embedding"), "embedding")
    # One node per label and distinct vector; its number is a hash of both.
    nodes = rows.where("usable").groupBy("label", "embedding").agg(F.count("*").alias("weight"))
    nodes = stage(nodes.withColumn("node", F.xxhash64("label", name)), "nodes")

    kind = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "<f8"

    def hashed(batches):
        for batch in batches:
            for size, part in batch.groupby(batch["embedding"].map(len)):
                given = np.stack(part["embedding"])
                cells = codes(normalised(given), tables, projections, width, seed)
                items = {"cells": [c.tobytes() for c in cells], "item": [v.tobytes() for v in given.astype(kind)]}
                yield pd.DataFrame({"node": part["node"], "label": part["label"], "size": size, "weight": part["weight"], "codes": list(cells)} | items)

    schema = f"node long, label {nodes.schema['label'].dataType.simpleString()}, size int, weight long, codes array<int>, cells binary, item binary"
    coded = stage(nodes.mapInPandas(hashed, schema), "codes")
    places = coded.select("node", F.posexplode("codes").alias("t", "code"), "label", "size")
    places = places.select("node", "t", F.xxhash64("label", "size", "t", "code").alias("bucket"))
    spread = stage(block_pairs(places, "bucket", "node", MEMBERS, once="t"), "blocks")
    members = spread.join(coded.select("node", "weight", "cells", "item"), "node")

    def compare(batches):
        for columns, _ in whole_groups(batches, BLOCK):
            length = np.fromiter(map(len, columns["item"]), dtype=np.int64, count=len(columns["item"]))
            for bytes_ in np.unique(length):
                rows = {c: v[length == bytes_] for c, v in columns.items()}
                x = normalised(np.frombuffer(b"".join(rows["item"]), dtype=kind).reshape(-1, bytes_ // int(kind[-1])))
                a, b = pairs_of(rows, x, least)
                if not len(a):
                    continue
                # Only what no earlier table has brought together.
                cells = np.frombuffer(b"".join(rows["cells"]), dtype="<i4").reshape(len(x), -1)
                fresh = met_first(cells, rows["t"], a, b)
                a, b = a[fresh], b[fresh]
                weight, node = rows["weight"], rows["node"]
                count = np.bincount(np.r_[a, b], np.r_[weight[b], weight[a]], len(x)).astype(np.int64)
                has = count > 0
                yield pd.DataFrame({"node": node[has], "links": count[has], "other": node[forest(len(x), a, b)][has]})

    dealt = members.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "chunk", "node")
    # Narrow rows, many of them in a batch.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    found = dealt.select(*BLOCK, "chunk", "t", "node", "weight", "cells", "item").mapInPandas(compare, "node long, links long, other long")
    found = stage(found, "links")
    prepare(spark)
    groups = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_node = nodes.select("node", "weight").join(counts, "node", "left").join(groups, "node", "left")
    per_node = per_node.select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    # Unusable rows are on their own; usable ones find their node by its hash.
    keyed = rows.select("vec_id", F.when(F.col("usable"), F.xxhash64(F.col("label"), name)).alias("node"))
    out = keyed.join(per_node, "node", "left")
    least_id = out.where("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("least"))
    out = out.join(least_id, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def normalised(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; first divided by their largest component, so that no square overflows."""
    x = x.astype(float)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1)[:, None]


def forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For every member the least member it is connected with by the links a-b."""
    least = np.arange(size)
    while True:
        before = least.copy()
        np.minimum.at(least, a, least[b])
        np.minimum.at(least, b, least[a])
        least = least[least]
        if (before == least).all():
            return least
