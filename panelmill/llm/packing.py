"""Vector best-fit packing of documents into training sequences."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.common import Memo
from panelmill.session import stage

END = 0
# A word of this one control character has an id of its own, which no other character's bytes give.
MARK = "\x00"
# A plain word: Latin letters that no normal form changes, then ASCII signs, without the apostrophe.
# The vocabulary's rules cut it between the two parts and nowhere else.
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")
ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of words, as little-endian unsigned 32-bit numbers, remembered per worker.

    The vocabulary's rules never look across ASCII white space, which they drop, so that the ids of a
    text are those of its white-space separated parts one after the other.  The new words of a
    batch are encoded together.  Plain ones are cut into letters and signs; the letters need no pattern
    but white space, and each one's ids end with the only id that closes a word.  Between other words
    go marks by which their ids are told apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.letters = Tokenizer.from_file(path)
        self.letters.encode_special_tokens = True
        self.letters.normalizer = normalizers.Sequence([])
        by_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), by_bytes])
        self.memo = Memo(self.alone, 600_000)
        (self.mark,) = np.frombuffer(self.alone(MARK.encode()), dtype="<u4")
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:  # without one, no id tells where a word ends, and all words go between marks
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.plain = PLAIN if suffix else re.compile(r"(?!)")

    def alone(self, word: bytes) -> bytes:
        return self.ids(self.tokenizer, word.decode()).tobytes()

    def ids(self, tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray, gap: int) -> None:
        """Remember the ids of each word: up to its end, those of the next one ``gap`` further on."""
        data, start = ids.tobytes(), 0
        for word, end in zip(words, ends.tolist(), strict=True):
            self.memo[word.encode()] = data[4 * start : 4 * end]
            start = end + gap

    def learn(self, new: set[bytes]) -> None:
        cut, others = [], []
        for word in b" ".join(new).decode().split(" "):
            if match := self.plain.fullmatch(word):
                cut.append((word, match[1].lower(), match[2]))
            elif MARK not in word:
                others.append(word)
        letters = [w for w in {x[1] for x in cut} if w.encode() not in self.memo]
        if letters:
            ids = self.ids(self.letters, " ".join(letters))
            self.keep(letters, ids, np.flatnonzero(self.closes[ids]) + 1, 0)
        for word, low, signs in cut:
            known = self.memo[low.encode()]
            self.memo[word.encode()] = known + self.memo[signs.encode()] if signs else known
        if others:
            ids = self.ids(self.tokenizer, f" {MARK} ".join(others))
            self.keep(others, ids, np.append(np.flatnonzero(ids == self.mark), len(ids)), 1)

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text of a batch; none for a missing text."""
        words = [text.encode().split() if text else [] for text in texts]
        new = set(chain.from_iterable(words)).difference(self.memo)
        # A batch may bring a word three times: as it is, its letters and its signs.
        if len(self.memo) + 3 * len(new) > self.memo.most:
            self.memo.clear()
            new = set(chain.from_iterable(words))
        if new:
            self.learn(new)
        return [b"".join(map(self.memo.__getitem__, ws)) for ws in words]


def encoder(path: str) -> Encoder:
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def pieces(docs: DataFrame, size: int, path: str) -> DataFrame:
    """The pieces of every document, numbered within their task and length.

    Columns: doc_id, piece, start, length, ids_crc32, part (task), nth (from 0 within part and
    length).
    """

    def batches(rows):
        encode, part = encoder(path), TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        for batch in rows:
            out: list[list] = [[] for _ in range(7)]
            for key, data in zip(batch.column(0).to_pylist(), encode.texts(batch.column(1).to_pylist()), strict=True):
                data += END.to_bytes(4, "little")
                for n, at in enumerate(range(0, len(data), 4 * size)):
                    ids = data[at : at + 4 * size]
                    length = len(ids) // 4
                    for column, value in zip(out, (key, n, at // 4, length, zlib.crc32(ids), part, seen[length]), strict=True):
                        column.append(value)
                    seen[length] += 1
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        batches, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    )


def best_fit(counts: dict[int, int], size: int, max_docs: int, max_cost: int, weights=(1.0, 1.0, 1.0)) -> list[tuple]:
    """Best-fit decreasing over a histogram of lengths; its size doesn't grow with the data.

    A sequence has three capacities: tokens, pieces, and attention cost (the sum of squared
    lengths).  Sequences with equal residuals are one class.  For each length, longest first, the
    class whose weighted residual norm after placing is least, among those where every constraint
    holds, takes as many pieces as fit; a new sequence is opened only where no class is left.

    Returns placements ``(length, first, last, base, per_bin, offset)``: pieces number first..last-1 of
    that length go ``per_bin`` to a sequence, from sequence ``base`` on, at ``offset``.
    """
    full = np.array([size, max_docs, max_cost], dtype=float)
    scale = np.array(weights, dtype=float) / full
    bins: dict[tuple[int, int, int], list[tuple[int, int]]] = defaultdict(list)
    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        need, at, left = (length, 1, length * length), 0, counts[length]
        if length > size or need[2] > max_cost or max_docs < 1:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            fits = [k for k in bins if k[0] >= length and k[1] >= 1 and k[2] >= need[2]]
            if fits:
                rest = (np.array(fits, dtype=float) - need) * scale
                key = fits[int(np.argmin((rest * rest).sum(1)))]
                base, number = bins[key].pop()
                if not bins[key]:
                    del bins[key]
            else:
                key = (size, max_docs, max_cost)
                base, number = opened, None
            per = min(key[0] // length, key[1], key[2] // need[2])
            if number is None:
                number = -(-left // per)
                opened += number
            used = min(number, left // per)
            after = tuple(k - per * n for k, n in zip(key, need, strict=True))
            if used:
                placed.append((length, at, at + used * per, base, per, size - key[0]))
                at, left = at + used * per, left - used * per
                bins[after].append((base, used))
            if left and used < number:
                placed.append((length, at, at + left, base + used, left, size - key[0]))
                bins[tuple(k - left * n for k, n in zip(key, need, strict=True))].append((base + used, 1))
                at, left, used = at + left, 0, used + 1
            if used < number:
                bins[key].append((base + used, number - used))
    return placed


def pack(
    docs: DataFrame,
    size: int = 2048,
    max_docs: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    path: str | None = None,
) -> DataFrame:
    """One row per piece of the documents, with the sequence and the place it is packed into.

    A document is its ids and an end id; a null or empty text is the end id alone.  Longer ones are cut into
    pieces of ``size``.  Every row of ``docs`` is packed, repeated rows and null ids as well;
    other columns are ignored; no rows give no rows.  ``max_docs`` and ``max_cost`` limit pieces and
    summed squared lengths of a sequence (by default neither binds); a piece that alone breaks
    them raises ``ValueError``.

    The best fit itself works on the counts of the at most ``size`` lengths; the pieces find their
    place by their number among those of equal length: the count in earlier tasks plus the number
    within the task.  No group of pieces comes together in one task.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path("word_bpe_49k.json")
    cut = stage(pieces(docs, size, path), "pieces")
    # One row per task and length.
    per_task = cut.groupBy("part", "length").count()
    by_length = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = best_fit(by_length, size, max_docs or size, max_cost or size * size, weights)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    plan_rows = spark.createDataFrame(plan, "length long, first long, last long, base long, per long, at long")
    nth = cut.join(starts, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before"))
    # The plan has a few rows per length: at most some thousands whatever the size of the data.
    return (
        nth.join(F.broadcast(plan_rows), "length")
        .where("nth >= first AND nth < last")
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            F.expr("base + (nth - first) DIV per").alias("sequence_id"),
            F.expr("at + (nth - first) % per * length").alias("offset"),
        )
    )
