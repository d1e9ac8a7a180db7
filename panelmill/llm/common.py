"""What several operators share: tables, folds, words, and the set-up of Python workers."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])

# Words are maximal runs of bytes other than space and 0x09-0x0D; in UTF-8 these bytes occur in no
# longer character, so that bytes.split() finds the same words as this pattern.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE = 5
# Rows that may be broadcast: 200 thousand of some tens of bytes.
BROADCAST_ROWS = 200_000
# Numbers of 64 bits in each row of a sieve, which has as many rows at most.
SIEVE_WORDS = 8


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and bound the batches they are sent.

    A batch holds at most 500 rows, as one text may be hundreds of kilobytes long.
    """
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read whole."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast only what has been counted as small; otherwise the join is left to the optimizer."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def sifted(rows: DataFrame, keys: list[str], wanted: DataFrame, named: list[str]) -> DataFrame:
    """``rows`` with a column ``_maybe``: false only where no row of ``wanted`` has these keys (null equals null).

    One bit of a broadcast table tells; its size is the same however many rows are wanted, of which some
    millions leave it selective.  What is told apart must still be joined; the other rows need not travel for it.
    """

    def place(names: list[str]) -> dict[str, Column]:
        h = F.xxhash64(*[F.col(c) for c in names])
        return {"_at": F.pmod(h, F.lit(BROADCAST_ROWS)), "_word": F.shiftrightunsigned(h, 58) % SIEVE_WORDS, "_bit": F.shiftrightunsigned(h, 40).bitwiseAND(63).cast("int")}

    marks = wanted.select(*[v.alias(c) for c, v in place(named).items()])
    words = [F.bit_or(F.when(F.col("_word") == k, F.expr("shiftleft(1L, _bit)")).otherwise(F.lit(0).cast("long"))) for k in range(SIEVE_WORDS)]
    sieve = marks.groupBy("_at").agg(F.array(*words).alias("_words"))
    found = rows.withColumns(place(keys)).join(F.broadcast(sieve), "_at", "left")
    maybe = F.coalesce(F.getbit(F.get("_words", F.col("_word").cast("int")), F.col("_bit")) == 1, F.lit(False))
    return found.select(*rows.columns, maybe.alias("_maybe"))


def fold(key: Column, folds: int) -> Column:
    """The crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string")) % folds


def text_of(column: str = "text") -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text with A-Z in lower case, as an array; empty for a text without words."""
    parts = F.split(F.regexp_replace(ascii_lower(text), f"^{SPACE}|{SPACE}$", ""), SPACE)
    return F.filter(parts, lambda w: w != "")


def split_words(text: str | None) -> list[bytes]:
    """The same words in Python, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Memo(dict):
    """Values computed once per key and worker; emptied when it has grown to ``most`` keys."""

    def __init__(self, compute, most: int = 400_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


WORD_HASH = Memo(xxhash.xxh3_64_intdigest)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text.

    A text of one to four words has its whole sequence as its one shingle; one without words none.
    """
    words = split_words(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(WORD_HASH.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(h) < SHINGLE:
        h = np.concatenate([h, np.arange(SHINGLE - len(h), dtype=np.uint64)])
    n = len(h) - SHINGLE + 1
    x = h[:n].copy()
    for i in range(1, SHINGLE):
        x *= _FACTOR
        x += h[i : i + n]
    x = np.sort(mix(x))
    return x[np.r_[True, x[1:] != x[:-1]]]
