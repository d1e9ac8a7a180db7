"""Perplexity of texts by a class-based bigram model with exchange clustering."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import WORD_HASH, fold, split_words
from panelmill.session import stage

CLASSES, BUCKETS = 96, 768
# Words above this share of all tokens are exchanged one after the other; there can be no more of them than the inverse.
CLUSTERED = 1e-4
# Every word seen so often in training gets a class by its own contexts, whatever its share.
LEAST = 5
# At most so many words, the most frequent ones, are known to every task; all others are met by joins.
KNOWN = 1_000_000
# Words whose places a task remembers before it forgets them all.
REMEMBERED = 400_000
ROUNDS, PASSES = 6, 2
MIXED, BACKED = 0.9, 5.0
END = 0  # number of the end of a text; its hash is 0, too


def bucket_of(word: bytes) -> int:
    """Words seen less than LEAST times are clustered by their end and length."""
    return WORD_HASH[word[-3:]] % (BUCKETS // 3) * 3 + min(len(word) // 5, 2)


def word_counts(train: DataFrame) -> DataFrame:
    """(hash, bucket, c) of every word of the training texts, and the end of a text; counted per task first."""

    def batches(rows):
        counts: Counter = Counter()
        texts = 0

        def flush():
            words = list(counts)
            h = np.fromiter(map(WORD_HASH.__getitem__, words), dtype=np.uint64, count=len(words)).view(np.int64)
            out = [pa.array(h), pa.array([bucket_of(w) for w in words], pa.int32()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(out, ["hash", "bucket", "c"])

        for batch in rows:
            for text in batch.column(0).to_pylist():
                counts.update(split_words(text))
                texts += 1
            if len(counts) > 400_000:
                yield flush()
        yield flush()
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([-1], pa.int32()), pa.array([texts], pa.int64())], ["hash", "bucket", "c"])

    found = train.select("text").mapInArrow(batches, "hash long, bucket int, c long")
    return found.groupBy("hash").agg(F.min("bucket").alias("bucket"), F.sum("c").alias("c"))


class Numbering:
    """Words to places among the known words, sorted by hash; len(known) is the end, -1 - bucket any other word.

    For the exchange, places have numbers: 0 the end, then words above ``least``, then buckets.
    """

    def __init__(self, known: pd.DataFrame, least: float):
        known = known.sort_values("hash")
        self.hash, self.count, self.bucket = (known[c].to_numpy() for c in ("hash", "c", "bucket"))
        self.end = len(known)
        self.alone = self.count >= least
        self.first_bucket = int(self.alone.sum()) + 1
        self.size = self.first_bucket + BUCKETS
        number = self.first_bucket + self.bucket
        number[self.alone] = np.arange(1, self.first_bucket)
        self.number = self.table(number, END, np.arange(self.first_bucket, self.size))

    def table(self, words, end, buckets) -> np.ndarray:
        """Values by place; buckets are met from the end, as negative places count from there."""
        return np.concatenate([words, [end], buckets[::-1]])

    def places(self, words: list[bytes]) -> list[int]:
        """The places of some words, by one search for all of them."""
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)).view(np.int64)
        at = np.searchsorted(self.hash, h)
        known = at < self.end
        known[known] = self.hash[at[known]] == h[known]
        out = at.tolist()
        for i in np.flatnonzero(~known).tolist():
            out[i] = -1 - bucket_of(words[i])
        return out


def encode(docs: DataFrame, numbering, kind: str) -> DataFrame:
    """Per row: doc_id, held_out, a row number, the places of its words and end (four bytes each), and the hashes of its unknown words."""

    def batches(rows):
        names = numbering.value
        memo, part, row = {}, TaskContext.get().partitionId(), 0
        for batch in rows:
            ids, rare = [], []
            for text in batch.column(2).to_pylist():
                words = split_words(text)
                if new := set(words).difference(memo):
                    if len(memo) >= REMEMBERED:
                        memo.clear()
                        new = set(words)
                    new = list(new)
                    memo.update(zip(new, names.places(new), strict=True))
                places = np.fromiter(map(memo.__getitem__, words), dtype=np.int32, count=len(words))
                ids.append(np.append(places, np.int32(names.end)).tobytes())
                rare.append(np.array([WORD_HASH[words[i]] for i in np.flatnonzero(places < 0)], dtype=np.uint64).view(np.int64))
            numbers = np.arange(row, row + len(ids)) + (part << 33)
            row += len(ids)
            arrays = [pa.array(numbers, pa.int64()), pa.array(ids, pa.binary()), pa.array(rare, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["doc_id", "held_out", "row", "ids", "rare"])

    return docs.mapInArrow(batches, f"doc_id {kind}, held_out boolean, row long, ids binary, rare array<long>")


def places(column) -> np.ndarray:
    """The places of all rows of a batch, one after the other; an end before the first row is left to add."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int32)


class Counts:
    """Counts of codes in sorted arrays, merged now and then."""

    def __init__(self):
        self.held: list[np.ndarray] = []
        self.clear()

    def clear(self) -> None:
        self.codes, self.counts, self.waiting = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), 0

    def add(self, codes: np.ndarray) -> None:
        self.held.append(codes)
        self.waiting += len(codes)
        if self.waiting > 2_000_000:
            self.merge()

    def merge(self) -> None:
        new, n = np.unique(np.concatenate([self.codes[:0], *self.held]), return_counts=True)
        both, at = np.unique(np.concatenate([self.codes, new]), return_inverse=True)
        self.counts = np.bincount(at, np.concatenate([self.counts, n]), len(both)).astype(np.int64)
        self.codes, self.held, self.waiting = both, [], 0


def pair_counts(train: DataFrame, numbering) -> DataFrame:
    """(a, b, n): how often number b follows number a in the training texts; texts begin after an end."""

    def batches(rows):
        names = numbering.value
        seen = Counts()

        def flush():
            seen.merge()
            for k in range(0, len(seen.codes), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(seen.codes[k : k + 200_000]), pa.array(seen.counts[k : k + 200_000])], ["code", "n"])
            seen.clear()

        for batch in rows:
            ids = names.number[np.append(np.int32(names.end), places(batch.column(0)))]
            seen.add(ids[:-1] * names.size + ids[1:])
            if len(seen.codes) > 3_000_000:
                yield from flush()
        yield from flush()

    found = train.select("ids").mapInArrow(batches, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    size = numbering.value.size
    return found.select(F.expr(f"CAST(code DIV {size} AS INT)").alias("a"), (F.col("code") % size).cast("int").alias("b"), "n")


def with_far(codes: DataFrame, far: DataFrame | None) -> DataFrame:
    """The rows with the classes of their unknown words that have one: ``far`` is a list of (k, class) for the k-th unknown word."""
    if far is None:
        return codes.withColumn("far", F.lit(None).cast("array<struct<k:int,class:int>>"))
    hits = codes.select("row", F.posexplode("rare").alias("k", "hash")).join(far.select("hash", "class"), "hash")
    return codes.join(hits.groupBy("row").agg(F.collect_list(F.struct("k", "class")).alias("far")), "row", "left")


def far_places(ids: np.ndarray, rows, far) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """Positions and classes of the unknown words with a class in a batch, and where each is found (row, k)."""
    at, classes, where = [], [], []
    if far.null_count < len(far):
        unknown, first = np.flatnonzero(ids < 0), 0
        for r, (hashes, words) in enumerate(zip(rows, far.to_pylist(), strict=True)):
            for word in words or ():
                at.append(int(unknown[first + word["k"]]))
                classes.append(word["class"])
                where.append((r, word["k"]))
            first += len(hashes)
    return at, classes, where


def class_counts(train: DataFrame, classes) -> np.ndarray:
    """Counts of class pairs in the training texts: one row per pair of classes comes to the driver."""
    total = CLASSES + 1

    def batches(rows):
        of, n = classes.value, np.zeros(total * total, dtype=np.int64)
        for batch in rows:
            ids = places(batch.column(0))
            c = of[ids]
            at, new, _ = far_places(ids, batch.column(1).to_pylist(), batch.column(2))
            c[at] = new
            n += np.bincount(np.append(0, c[:-1]) * total + c, minlength=total * total)
        cells = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(n[cells], pa.int64())], ["cell", "n"])

    out = np.zeros(total * total)
    for r in train.select("ids", "rare", "far").mapInArrow(batches, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(total, total)


def contexts(train: DataFrame, numbering, classes) -> DataFrame:
    """How often each class follows and precedes every word seen LEAST times or more that the exchange didn't place.

    One row per word, task and flush: key (the hash), place (-1 if unknown), class, and cells of count * 256 + class,
    CLASSES + 1 more for the class before.
    """
    total = CLASSES + 1

    def batches(rows):
        names, of = numbering.value, classes.value
        moving = names.table((names.count >= LEAST) & ~names.alone, False, np.zeros(BUCKETS, dtype=bool))
        seen, local, mine = Counts(), {}, []

        def flush():
            seen.merge()
            word = seen.codes // (2 * total)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.empty(0, dtype=np.int64)
            cells = np.asarray(seen.counts * 256 + seen.codes % (2 * total), dtype="<i8")
            ends = np.append(first, len(word)) * 8
            hashes, known = np.array(list(local), dtype=np.int64), word[first] < names.end
            key, place, old = np.empty(len(first), dtype=np.int64), np.where(known, word[first], -1), np.empty(len(first), dtype=np.int64)
            key[known], old[known] = names.hash[word[first][known]], of[word[first][known]]
            key[~known], old[~known] = hashes[word[first][~known] - names.end], np.array(mine, dtype=np.int64)[word[first][~known] - names.end]
            for k in range(0, len(first), 10_000):
                m = min(k + 10_000, len(first))
                data = cells[ends[k] // 8 : ends[m] // 8].tobytes()
                packed = pa.Array.from_buffers(pa.binary(), m - k, [None, pa.py_buffer((ends[k : m + 1] - ends[k]).astype(np.int32).tobytes()), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([pa.array(key[k:m]), pa.array(place[k:m].astype(np.int32)), pa.array(old[k:m].astype(np.int32)), packed], ["key", "place", "class", "cells"])
            seen.clear()
            local.clear()
            mine.clear()

        for batch in rows:
            ids = places(batch.column(0))
            hashes = batch.column(1).to_pylist()
            c, word = of[ids], ids.astype(np.int64)
            at, new, where = far_places(ids, hashes, batch.column(2))
            c[at] = new
            picked = moving[ids]
            for position, (r, k), old in zip(at, where, new, strict=True):
                h = hashes[r][k]
                if h not in local:
                    local[h] = len(local)
                    mine.append(old)
                word[position] = names.end + local[h]
                picked[position] = True
            on = np.flatnonzero(picked)
            before = np.append(0, c[:-1])
            seen.add(np.concatenate([word[on] * 2 * total + c[on + 1], word[on] * 2 * total + total + before[on]]))
            if len(seen.codes) > 3_000_000:
                yield from flush()
        yield from flush()

    return train.select("ids", "rare", "far").mapInArrow(batches, "key long, place int, class int, cells binary")


def transitions(n: np.ndarray) -> np.ndarray:
    """Probabilities of classes after classes, smoothed towards the class's share."""
    share = (n.sum(0) + 0.5) / (n.sum() + 0.5 * len(n))
    return (n + BACKED * share) / (n.sum(1, keepdims=True) + BACKED)


def best_classes(found: DataFrame, n: np.ndarray, in_class: np.ndarray) -> DataFrame:
    """(key, place, class): the class in which the contexts of a word are likeliest, given the counts of class pairs.

    Words are judged apart from each other, in as many tasks as there are partitions; all that a task
    needs beside its words is the matrix of the classes.
    """
    total = CLASSES + 1
    logs = np.log(transitions(n))

    def batches(rows):
        def judged(keys, place, old, cells):
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            word = np.repeat(np.cumsum(np.append(True, keys[1:] != keys[:-1])) - 1, [len(x) // 8 for x in cells])
            code = np.frombuffer(b"".join(cells), dtype="<i8")
            counts = np.bincount(word * 2 * total + code % 256, code // 256, len(first) * 2 * total).reshape(len(first), 2, total)
            gain = counts[:, 0] @ logs.T + counts[:, 1] @ logs
            own = counts[:, 1].sum(1)
            sizes = in_class + own[:, None]
            sizes[np.arange(len(first)), old[first]] -= own
            gain -= own[:, None] * np.log(np.maximum(sizes, 0.5))
            gain[:, END] = -np.inf
            arrays = [pa.array(keys[first]), pa.array(place[first]), pa.array(gain.argmax(1).astype(np.int32))]
            return pa.RecordBatch.from_arrays(arrays, ["key", "place", "class"])

        rest = None
        for batch in rows:
            part = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)] + [np.array(batch.column(3).to_pylist() + [b""], dtype=object)[:-1]]
            part = [np.concatenate(x) for x in zip(rest, part, strict=True)] if rest else part
            done = int(np.searchsorted(part[0], part[0][-1])) if len(part[0]) else 0
            if done:
                yield judged(*[x[:done] for x in part])
            rest = [x[done:] for x in part]
        if rest and len(rest[0]):
            yield judged(*rest)

    return found.repartition("key").sortWithinPartitions("key").mapInArrow(batches, "key long, place int, class int")


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def class_matrix(pairs: DataFrame, classes: np.ndarray, total: int) -> np.ndarray:
    """Counts of class pairs: one row per pair of classes comes to the driver."""
    spread = spread_classes(pairs, classes)
    out = np.zeros((total, total))
    for r in spread.groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
        out[r["ca"], r["cb"]] = r["n"]
    return out


def spread_classes(pairs: DataFrame, classes: np.ndarray) -> DataFrame:
    """The pairs with the classes of both numbers; the map has one row per clustered word or bucket."""
    spark = pairs.sparkSession
    names = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(classes), dtype=np.int32), "class": classes.astype(np.int32)}))
    left = F.broadcast(names.select(F.col("id").alias("a"), F.col("class").alias("ca")))
    right = F.broadcast(names.select(F.col("id").alias("b"), F.col("class").alias("cb")))
    return pairs.join(left, "a").join(right, "b")


def exchange(pairs: DataFrame, size: int, weight: np.ndarray) -> np.ndarray:
    """Classes of the numbers: 0 is the end's own, 1 to CLASSES are found by exchange.

    Every round gathers, for each number, its counts with the classes before and after it (summed
    per task first), and moves half of the numbers, one after the other, to the class that raises the likelihood
    of the class bigrams most.  The moves of a round have to know of each other, or all rush
    to one class; they are made in one task, which gets at most 1 / CLUSTERED + BUCKETS rows of
    CLASSES counts whatever the size of the data.
    """
    total = CLASSES + 1
    order = np.argsort(-weight[1:], kind="stable") + 1
    classes = np.zeros(size, dtype=np.int64)
    classes[order] = np.arange(len(order)) % CLASSES + 1
    for turn in range(ROUNDS):
        spread = spread_classes(pairs, classes)
        n = class_matrix(pairs, classes, total)
        after = spread.where("a != 0").groupBy(F.col("a").alias("id"), F.col("cb").alias("c")).agg(F.sum("n").alias("r"), F.lit(0).cast("long").alias("l"))
        before = spread.where("b != 0").groupBy(F.col("b").alias("id"), F.col("ca").alias("c")).agg(F.lit(0).cast("long").alias("r"), F.sum("n").alias("l"))
        cells = after.union(before).groupBy("id").agg(F.collect_list(F.struct("c", "r", "l")).alias("cells"))
        moving = cells.where(F.pmod(F.xxhash64("id", F.lit(turn // 2)), F.lit(2)) == turn % 2)
        old = classes.copy()

        def move(batches, n=n, old=old):
            for batch in batches:
                ids, new = batch["id"].to_numpy(), []
                for i, part in zip(ids, batch["cells"], strict=True):
                    right, left = np.zeros(total), np.zeros(total)
                    for cell in part:
                        right[cell["c"]] += cell["r"]
                        left[cell["c"]] += cell["l"]
                    mine = old[i]
                    n[mine] = np.maximum(n[mine] - right, 0)
                    n[:, mine] = np.maximum(n[:, mine] - left, 0)
                    gain = (xlogx(n + right) - xlogx(n)).sum(1) + (xlogx(n.T + left) - xlogx(n.T)).sum(1)
                    outs, ins = n.sum(1), n.sum(0)
                    gain -= xlogx(outs + right.sum()) - xlogx(outs) + xlogx(ins + left.sum()) - xlogx(ins)
                    gain[0] = -np.inf
                    best = int(gain.argmax())
                    n[best] += right
                    n[:, best] += left
                    new.append(best)
                yield pd.DataFrame({"id": ids, "class": new})

        for r in moving.repartition(1).sortWithinPartitions("id").mapInPandas(move, "id int, class int").collect():
            classes[r["id"]] = r["class"]
    return classes


def score(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words (A-Z in lower case) and one end per text.  Training rows are those whose crc32 of the id
    modulo 5 is not 1, rows with a null id included; a null or empty text is the end alone.  base_score sums log10((c + 0.5) / (N + 0.5 (V + 1)))
    over all tokens; score is the log10 probability by the class model:

        P(w | v) = 0.9 P(class of w | class of v) (c(w) + 0.5) / (N(class) + 0.5 (V(class) + u)) + 0.1 base(w)

    Words above a share of CLUSTERED are exchanged one after the other, together with the buckets of all others
    (by last letters and length).  Then every other word seen LEAST times or more leaves its bucket for the class in
    which its own contexts are likeliest, in PASSES passes of parallel tasks.  What is left in the buckets is seen less
    often; a bucket has a word of its own for what training lacks (u counts the buckets of a class).  Transitions are smoothed
    towards the class's share.  The part of a token that depends on its own count is log10(c + 0.5) in both scores, the rest on classes only.  The KNOWN most
    frequent words travel to every task; counts and classes of all others are met by joins on the word's hash, so
    that their number isn't bounded.
    Repeated rows are scored each.  Without training rows N and V are 0 and every token has
    log10(0.5 / 0.5) = 0 as base.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False))
    train = docs.where(~held)
    counts = stage(word_counts(train), "words")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, types = sums["n"], sums["v"]
    base = np.log10(tokens + 0.5 * (types + 1))
    words = counts.where("bucket >= 0")
    steps = [d * 10**k for k in range(18) for d in (1, 2, 5)]
    more = words.agg(*[F.count_if(F.col("c") >= x).alias(str(x)) for x in steps]).first()
    limit = next(x for x in steps if more[str(x)] <= KNOWN)
    known = words.where(F.col("c") >= limit).toArrow().to_pandas()
    ends = counts.where("bucket < 0").first()
    ends = ends["c"] if ends else 0
    names = Numbering(known, CLUSTERED * tokens)
    numbering = spark.sparkContext.broadcast(names)
    codes = stage(encode(docs.select("doc_id", held.alias("held_out"), "text"), numbering, kind), "codes")
    train = codes.where("NOT held_out")
    pairs = stage(pair_counts(train, numbering), "pairs")

    # Tokens per number: of words above the share one by one, of buckets by what is left.
    weight = np.zeros(names.size)
    weight[END] = ends
    for r in words.where(F.col("c") < CLUSTERED * tokens).groupBy("bucket").agg(F.sum("c").alias("c")).collect():
        weight[names.first_bucket + r["bucket"]] = r["c"]
    weight[names.number[: names.end][names.alone]] = names.count[names.alone]
    exchanged = exchange(pairs, names.size, weight)

    # Classes of known words, of words that are met by joins, and of the buckets.
    of_bucket = exchanged[names.first_bucket :]
    of_place = exchanged[names.number[: names.end]]
    far = None
    if limit > LEAST:
        first = spark.createDataFrame(pd.DataFrame({"bucket": np.arange(BUCKETS, dtype=np.int32), "class": of_bucket.astype(np.int32)}))
        far = stage(words.where(F.col("c").between(LEAST, limit - 1)).join(F.broadcast(first), "bucket").select("hash", "c", "class"), "far")
    scarce = words.where(F.col("c") < min(limit, LEAST)).groupBy("bucket").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()

    def classes_now():
        """The classes by place, the texts with the classes of words met by joins, class pairs, and tokens per class."""
        classes = spark.sparkContext.broadcast(names.table(of_place, END, of_bucket))
        rows = with_far(codes, far)
        size = np.bincount(of_place, names.count + 0.5, CLASSES + 1) + np.bincount(of_bucket, minlength=CLASSES + 1) * 0.5
        size[END] += ends + 0.5
        for r in scarce:
            size[of_bucket[r["bucket"]]] += r["c"] + 0.5 * r["v"]
        for r in far.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect() if far is not None else ():
            size[r["class"]] += r["c"] + 0.5 * r["v"]
        return classes, rows, class_counts(rows.where("NOT held_out"), classes), size

    for _ in range(PASSES):
        classes, rows, n, in_class = classes_now()
        found = best_classes(contexts(rows.where("NOT held_out"), numbering, classes), n, in_class)
        if far is not None:
            found = stage(found, "found")
            far = stage(far.join(found.where("place < 0").select(F.col("key").alias("hash"), F.col("class").alias("new")), "hash", "left").select("hash", "c", F.coalesce("new", "class").alias("class")), "far")
        moved = found.where("place >= 0").select("place", "class").toArrow()
        of_place = of_place.copy()
        of_place[moved["place"].to_numpy()] = moved["class"].to_numpy()

    classes, rows, n, in_class = classes_now()
    table = np.log10(MIXED * transitions(n) / np.maximum(in_class, 0.5)[None, :] + (1 - MIXED) / 10.0**base)
    own_logs = names.table(np.log10(names.count + 0.5), np.log10(ends + 0.5), np.zeros(BUCKETS))
    model = spark.sparkContext.broadcast((table, own_logs))

    def scored(batches):
        of, (table, own) = classes.value, model.value
        end = names_end
        for batch in batches:
            ids = places(batch.column(3))
            c = of[ids]
            at, new, _ = far_places(ids, batch.column(4).to_pylist(), batch.column(5))
            c[at] = new
            lengths = np.array([len(x) // 4 for x in batch.column(3).to_pylist()], dtype=np.int64)
            first = np.cumsum(lengths) - lengths
            moves = table[np.append(0, c[:-1]), c]
            sums = [np.add.reduceat(x, first) if len(first) else x for x in ((ids >= 0) & ((ids != end) | seen_end), own[ids], moves)]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            arrays = [pa.array(x, k) for x, k in zip((lengths, sums[0].astype(np.int64), *sums[1:]), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], *arrays], ["doc_id", "held_out", "row", "n_tokens", "found", "own", "moves"])

    names_end, seen_end = names.end, ends > 0
    schema = f"doc_id {kind}, held_out boolean, row long, n_tokens long, found long, own double, moves double"
    texts = rows.select("doc_id", "held_out", "row", "ids", "rare", "far").mapInArrow(scored, schema)
    unknown = codes.where(F.size("rare") > 0)
    few = words.where(F.col("c") < limit).select("hash", "c")
    looked = unknown.select("row", F.explode("rare").alias("hash")).join(few, "hash")
    looked = looked.groupBy("row").agg(F.count("*").alias("seen"), F.sum(F.log10(F.col("c") + 0.5)).alias("rare_own"))
    looked = unknown.select("row", F.size("rare").alias("rare_n")).join(looked, "row", "left")
    out = texts.join(looked, "row", "left")
    seen = F.coalesce("seen", F.lit(0))
    own = F.col("own") + F.coalesce("rare_own", F.lit(0.0)) + (F.coalesce("rare_n", F.lit(0)) - seen) * float(np.log10(0.5))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("found") + seen).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (own - F.col("n_tokens") * float(base)).alias("base_score"),
        (own + F.col("moves")).alias("score"),
    )
