"""Merkle manifest of a corpus whose parents keep the hash state before each of their children.

A digest as hex text is 64 bytes, exactly one block of SHA-256.  So the state of a parent's hash before
a child is eight whole numbers with no bytes pending, can be stored in a table, and a changed child
is folded in by resuming that state with the new digest and the siblings to its right only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.common import small
from panelmill.session import stage

# Children of a parent; levels that one task builds of one row; nodes of such a row.
ARITY, DEPTH = 3, 5
CHUNK = ARITY**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Rows of chunks that are worked on together.
TOGETHER = 64
# A step of a path: slot, children, the state before the slot, the other children's digests.
STEP = 2 + 32 + (ARITY - 1) * 32


def root_bits(prime: int, power: int) -> int:
    """The first 32 bits of the fraction of a prime's root (square or cube), by which SHA-256 is defined."""
    target, low, high = prime << (32 * power), 0, 1 << 40
    while low + 1 < high:
        middle = (low + high) // 2
        low, high = (middle, high) if middle**power <= target else (low, middle)
    return low & 0xFFFFFFFF


PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, p))]
ROUNDS = [np.uint32(root_bits(p, 3)) for p in PRIMES[:64]]
START = np.array([root_bits(p, 2) for p in PRIMES[:8]], dtype=np.uint32)
HEX = np.frombuffer("".join(f"{x:02x}" for x in range(256)).encode(), dtype=np.uint8).reshape(256, 2)


def turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """One SHA-256 block for many hashes at once: states ``(n, 8)``, blocks ``(n, 16)``."""
    w = list(np.ascontiguousarray(block.T))
    a, b, c, d, e, f, g, h = start = list(np.ascontiguousarray(state.T))
    for i, k in enumerate(ROUNDS):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            s0 = turned(x, 7) ^ turned(x, 18) ^ (x >> np.uint32(3))
            s1 = turned(y, 17) ^ turned(y, 19) ^ (y >> np.uint32(10))
            w.append(w[i - 16] + s0 + w[i - 7] + s1)
        t1 = h + (turned(e, 6) ^ turned(e, 11) ^ turned(e, 25)) + ((e & f) ^ (~e & g)) + k + w[i]
        t2 = (turned(a, 2) ^ turned(a, 13) ^ turned(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
    return np.stack([x + y for x, y in zip(start, (a, b, c, d, e, f, g, h), strict=True)], axis=1)


def hexed(digests: np.ndarray) -> np.ndarray:
    """Digests ``(n, 32)`` as the bytes of their hex text ``(n, 64)``."""
    return HEX[digests].reshape(len(digests), 64)


def numbers(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data).view(">u4").astype(np.uint32)


def bytes_of(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state.astype(">u4")).view(np.uint8).reshape(-1, 32)


def take(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after one more child each."""
    return compress(state, numbers(hexed(digests)))


def finish(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """The digests of hashes that have taken so many children."""
    last = np.zeros((len(state), 16), dtype=np.uint32)
    last[:, 0] = 0x80000000
    last[:, 14] = (children.astype(np.uint64) * np.uint64(512)) >> np.uint64(32)
    last[:, 15] = (children.astype(np.uint64) * np.uint64(512)) & np.uint64(0xFFFFFFFF)
    return bytes_of(compress(state, last))


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def above(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parents of ``(rows, m, 32)`` nodes, and the states before their second and third child."""
    rows, m = nodes.shape[:2]
    p = -(-m // ARITY)
    full = np.zeros((rows, p * ARITY, 32), dtype=np.uint8)
    full[:, :m] = nodes
    slots = full.reshape(rows * p, ARITY, 32)
    children = np.tile(np.minimum(ARITY, m - ARITY * np.arange(p)), rows)
    state = np.tile(START, (rows * p, 1))
    before = np.zeros((rows * p, ARITY - 1, 32), dtype=np.uint8)
    for slot in range(ARITY):
        has = children > slot
        if slot:
            before[has, slot - 1] = bytes_of(state[has])
        state[has] = take(state[has], slots[has, slot])
    return finish(state, children).reshape(rows, p, 32), before.reshape(rows, p, ARITY - 1, 32)


def resumed(value: np.ndarray, slot: np.ndarray, children: np.ndarray, state: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The parents' digests with ``value`` at ``slot``: from the state before it, with what stands right of it."""
    state = np.where((slot == 0)[:, None], START, numbers(state))
    for at in range(ARITY):
        now = np.flatnonzero((at >= slot) & (at < children))
        if len(now):
            child = np.where((slot[now] == at)[:, None], value[now], others[now, max(at - 1, 0)])
            state[now] = take(state[now], child)
    return finish(state, children)


class Fold:
    """Leaves on their way up: the digest so far, and the hash of the siblings met so far."""

    def __init__(self, value: np.ndarray):
        self.value = value
        self.proof = np.tile(START, (len(value), 1))
        self.met = np.zeros(len(value), dtype=np.int64)

    def step(self, slot, children, state, others) -> None:
        """``others``: the siblings from left to right, as many as there are."""
        self.value = resumed(self.value, slot, children, state, others)
        for k in range(ARITY - 1):
            now = np.flatnonzero(children - 1 > k)
            if len(now):
                self.proof[now] = take(self.proof[now], others[now, k])
        self.met += children - 1


def layout(size: int, depth: int) -> list[int]:
    """The number of nodes at each level of a chunk, leaves first."""
    sizes = [size]
    for _ in range(depth):
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def steps_within(nodes: np.ndarray, states: np.ndarray, size: int, depth: int):
    """For each level: slot, children, state and others of every leaf's ancestor, ``(rows * size, …)``.

    ``nodes`` has the digests of all levels one after the other, ``states`` those of the parents.
    """
    rows, at, up = len(nodes), 0, 0
    place = np.arange(size)
    for m in layout(size, depth)[:-1]:
        level, p = nodes[:, at : at + m], -(-m // ARITY)
        slot, parent = place % ARITY, place // ARITY
        children = np.minimum(ARITY, m - ARITY * parent)
        state = np.zeros((rows, size, 32), dtype=np.uint8)
        state[:, slot > 0] = states[:, up : up + p][:, parent[slot > 0], slot[slot > 0] - 1]
        # The k-th sibling stands at slot k, or one further on from the leaf's own slot.
        beside = np.stack([ARITY * parent + k + (k >= slot) for k in range(ARITY - 1)], axis=1)
        others = level[:, np.minimum(beside, m - 1)]
        yield np.tile(slot, rows), np.tile(children, rows), state.reshape(-1, 32), others.reshape(-1, ARITY - 1, 32)
        at, up, place = at + m, up + p, parent


def blobs(column: pa.Array, width: int) -> np.ndarray:
    """Binary values of equal length as ``(rows, values, width)``."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1, width)


def alike(batch: pa.RecordBatch, *columns: str):
    """The batch in slices of rows that have equal shapes: members, group size, lengths of the named columns."""
    for start in range(0, batch.num_rows, TOGETHER):
        part = batch.slice(start, TOGETHER)
        shapes: dict[tuple, list[int]] = {}
        sizes = [part.column("n").to_pylist(), *[[len(x) for x in part.column(c).to_pylist()] for c in ("members", *columns)]]
        for row, (n, size, *lengths) in enumerate(zip(*sizes, strict=True)):
            shapes.setdefault((size, min(DEPTH, height(n)), *lengths), []).append(row)
        for (size, depth, *_), at in shapes.items():
            yield part.take(pa.array(at)), size, depth


def member(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column("members").flatten().field(name)


def chunked(nodes: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Nodes ``(grp, pos, n, digest, …)`` in rows of up to ``CHUNK``, with all levels above them and their states.

    Columns: grp, chunk, n, members, nodes, states, top (the one node left of this row).
    """
    rows = nodes.groupBy("grp", F.expr(f"pos DIV {CHUNK}").alias("chunk"), "n").agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", *carry))).alias("members")
    )

    def build(batches):
        for whole in batches:
            for batch, size, depth in alike(whole):
                level = blobs(member(batch, "digest"), 32).reshape(batch.num_rows, size, 32)
                levels, states = [level], []
                for _ in range(depth):
                    level, before = above(level)
                    levels.append(level)
                    states.append(before.reshape(len(level), -1, 32))
                every = np.concatenate(levels, axis=1)
                kept = np.concatenate(states, axis=1) if states else np.zeros((len(level), 0, 32), dtype=np.uint8)
                made = [[row.tobytes() for row in x] for x in (every, kept, level[:, 0])]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(m, pa.binary()) for m in made)], [*batch.schema.names, "nodes", "states", "top"]
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return stage(rows.mapInArrow(build, f"{kinds}, nodes binary, states binary, top binary"), "chunks")


def climbed(nodes: DataFrame) -> DataFrame:
    """``(grp, pos, path, top)``: for every node the steps to the one node left of its group, and that node.

    Each round works on rows of ``CHUNK`` nodes, so that the number of rounds is a logarithm of the
    largest group to that base, and no group comes together in one task.
    """
    chunks = chunked(nodes)
    with_paths = chunks.join(paths_above(chunks), ["grp", "chunk"])

    def spread(batches):
        for whole in batches:
            for batch, size, depth in alike(whole, "path"):
                rows = batch.num_rows
                given = blobs(batch.column("path"), STEP) if depth else np.zeros((rows, 0, STEP), dtype=np.uint8)
                within = [
                    np.concatenate([slot[:, None].astype(np.uint8), children[:, None].astype(np.uint8), state, others.reshape(len(state), -1)], axis=1)
                    for slot, children, state, others in steps_within(blobs(batch.column("nodes"), 32), states_of(batch), size, depth)
                ]
                own = np.stack(within, axis=1) if within else np.zeros((rows * size, 0, STEP), dtype=np.uint8)
                paths = np.concatenate([own, np.repeat(given, size, axis=0)], axis=1)
                again = pa.array(np.repeat(np.arange(rows), size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grp").take(again), member(batch, "pos"), pa.array([p.tobytes() for p in paths], pa.binary()), batch.column("end").take(again)],
                    ["grp", "pos", "path", "top"],
                )

    return stage(with_paths.mapInArrow(spread, "grp string, pos long, path binary, top binary"), "paths")


def states_of(batch: pa.RecordBatch) -> np.ndarray:
    rows = batch.num_rows
    return np.frombuffer(b"".join(batch.column("states").to_pylist()), dtype=np.uint8).reshape(rows, -1, ARITY - 1, 32)


def paths_above(chunks: DataFrame) -> DataFrame:
    """``(grp, chunk, path, end)``: the steps above each row of a chunked level, none where it is the whole group."""
    most = chunks.agg(F.max(F.ceil(F.col("n") / CHUNK))).first()[0] or 0
    if most <= 1:
        return chunks.select("grp", "chunk", F.lit(b"").alias("path"), F.col("top").alias("end"))
    upper = climbed(chunks.selectExpr("grp", "chunk AS pos", f"CAST(ceil(n / {CHUNK}) AS BIGINT) AS n", "top AS digest"))
    return upper.selectExpr("grp", "pos AS chunk", "path", "top AS end")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Staged rows with ``pos``, their place in their ``grp`` by ``order``, and ``n``, the size of the group.

    A range sort deals out every group, however large; places are counted within tasks and moved on by
    the counts of earlier tasks, one row per task and group.
    """
    keys = ["grp", *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def count(batches):
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            nth = []
            for grp in batch.column("grp").to_pylist():
                n = n + 1 if grp == last else 0
                last = grp
                nth.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nth, pa.int64()), pa.array([part] * len(nth), pa.int32())], [*batch.schema.names, "nth", "part"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
    counted = stage(ranged.mapInArrow(count, f"{kinds}, nth long, part int"), "placed")
    per_task = counted.groupBy("grp", "part").agg(F.count("*").alias("rows"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = per_task.select("grp", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(group).alias("n"))
    return counted.join(small(moved), ["grp", "part"]).withColumn("pos", F.col("before") + F.col("nth")).drop("before", "nth", "part")


def field(value: Column) -> Column:
    """A value as it is hashed: ``-`` for null, else its length in bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


@dataclass(frozen=True)
class Manifest:
    """The frames of a manifest, all in shared storage.

    ``chunks``: rows of up to 243 leaves of one source, with their changed digests, all nodes above them
    and the states before each child.  ``paths``: the steps above each such row.  ``sources``:
    grp, source, n_docs, subroot, the steps from there to the root, and the root.
    """

    chunks: DataFrame
    paths: DataFrame
    sources: DataFrame


def build(docs: DataFrame, changed: Column | None = None) -> Manifest:
    """The manifest of the rows of ``docs``; ``changed`` is the text each row has now (by default its own).

    Leaves of a source are in the order of doc_id, null first, then of their digests; a null source comes first.
    """
    now = F.col("text") if changed is None else changed
    grp = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    values = [F.col(c) for c in FIELDS]
    leaves = docs.select(
        "doc_id",
        "source",
        grp.alias("grp"),
        digest(values).alias("digest"),
        digest([*values[:-1], now]).alias("changed"),
        F.monotonically_increasing_id().alias("mark"),
    )
    leaves = placed(stage(leaves, "leaves"), ["doc_id", "digest", "mark"])
    chunks = chunked(leaves, ("doc_id", "changed"))
    paths = stage(paths_above(chunks), "above")
    subroots = paths.where("chunk = 0").select("grp", F.col("end").alias("digest"))
    sizes = chunks.where("chunk = 0").selectExpr("grp AS source", "n AS n_docs")
    ordered = stage(placed(subroots.selectExpr("'' AS grp", "grp AS source", "digest"), ["source"]), "sources")
    up = climbed(ordered.select("grp", "pos", "n", "digest")).selectExpr("pos", "path", "top")
    sources = ordered.join(up, "pos").join(sizes, "source")
    sources = sources.selectExpr("source AS grp", "IF(source = '', NULL, substring(source, 2)) AS source", "n_docs", "digest AS subroot", "path", "top AS root")
    return Manifest(chunks, paths, stage(sources, "roots"))


def strings(data: np.ndarray) -> pa.Array:
    """Digests ``(n, 32)`` as an array of hex texts."""
    ends = pa.py_buffer(np.arange(0, 64 * len(data) + 1, 64, dtype=np.int32))
    return pa.StringArray.from_buffers(len(data), ends, pa.py_buffer(np.ascontiguousarray(hexed(data))))


def fold(manifest: Manifest) -> DataFrame:
    """Every leaf folded up to the root with its changed digest, by the states its parents keep.

    Columns: doc_id, leaf, subroot, root, proof_sha256 (hash of all siblings on the way), folded_root,
    verified (folded_root = root); digests as hex text.
    """
    tops = manifest.sources.selectExpr("grp", "path AS last", "subroot", "root")
    rows = manifest.chunks.drop("top").join(manifest.paths.select("grp", "chunk", "path"), ["grp", "chunk"]).join(tops, "grp")
    id_kind = next(f for f in rows.schema["members"].dataType.elementType if f.name == "doc_id").dataType.simpleString()
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def up(batches):
        for whole in batches:
            for batch, size, depth in alike(whole, "path", "last"):
                nodes = blobs(batch.column("nodes"), 32)
                leaves = Fold(blobs(member(batch, "changed"), 32).reshape(-1, 32))
                for step in steps_within(nodes, states_of(batch), size, depth):
                    leaves.step(*step)
                for column in ("path", "last"):
                    if batch.column(column)[0].as_py():
                        for step in np.repeat(blobs(batch.column(column), STEP), size, axis=0).transpose(1, 0, 2):
                            leaves.step(step[:, 0].astype(np.int64), step[:, 1].astype(np.int64), step[:, 2:34], step[:, 34:].reshape(-1, ARITY - 1, 32))
                subroot, root = (np.repeat(blobs(batch.column(c), 32)[:, 0], size, axis=0) for c in ("subroot", "root"))
                proof = finish(leaves.proof, leaves.met)
                made = [nodes[:, :size].reshape(-1, 32), subroot, root, proof, leaves.value]
                same = pa.array((leaves.value == root).all(axis=1))
                yield pa.RecordBatch.from_arrays([member(batch, "doc_id"), *map(strings, made), same], names)

    return rows.mapInArrow(up, f"doc_id {id_kind}, " + ", ".join(f"{n} string" for n in names[1:-1]) + ", verified boolean")


def tampered() -> Column:
    """The text without its line ends in every second document by the crc32 of its id; a null id keeps its text."""
    odd = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(odd, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def prove(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` and each row's proof, with half of the rows tampered with.

    One row per row of ``docs``.  Null fields are hashed as ``-``, an empty text as ``0:``; repeated rows
    are leaves of their own, next to each other; other columns are ignored; no rows give no rows.
    """
    return fold(build(docs, tampered()))
