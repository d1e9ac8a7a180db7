"""Quality rules: every rule evaluated once into a bit mask, policies and ablations on the masks."""

from __future__ import annotations

import operator
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import Memo

WINDOW = 5
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
# What is measured of a text, all whole numbers.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lettered", "n_shouted", "n_echoes")
# Rule: the condition under which a text fails, over its measurements.  The place of a rule is its bit
# in every ledger ever written: new rules go to the end, old ones are never moved or changed.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "short_words": "10 * word_chars < 25 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "few_letters": "100 * n_lettered < 60 * n_words",
    "shouting": "100 * n_shouted > 50 * n_words",
    "echoes": "100 * n_echoes > 20 * n_words",
}
BASE = ("few_words", "repeated_words")
# Version of a policy: the rules that reject a document.
POLICIES = {
    1: BASE,
    2: (*BASE, "short_words", "long_words", "symbols", "duplicate_lines"),
    3: tuple(RULES),
}
# A word has a letter if it holds an ASCII letter or any character beyond ASCII; it is shouted if it
# holds A-Z and no a-z.
LETTER, UPPER, LOWER = re.compile(rb"[A-Za-z\x80-\xff]"), re.compile(rb"[A-Z]"), re.compile(rb"[a-z]")
SHOUTED = 1 << 32
KINDS = Memo(lambda w: bool(LETTER.search(w)) + SHOUTED * bool(UPPER.search(w) and not LOWER.search(w)))


def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal where both ``a`` and ``b`` are; exact, no hashing."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].reshape(-1)


def repeated(words: list[bytes]) -> int:
    """Words in windows of five that occur twice or more in the list, first occurrences included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    one = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    two = pairs(one[:-1], one[1:])
    five = pairs(pairs(two[:n], two[2 : n + 2]), one[4:])
    starts = np.flatnonzero(np.bincount(five)[five] > 1)
    covers = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covers, starts, 1)
    np.add.at(covers, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(covers)))


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``; zeros for a missing one."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode().split()
    lines = Counter(line for line in text.split("\n") if line.strip(SPACES))
    kinds = sum(map(KINDS.__getitem__, words))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        lines.total() - len(lines),
        repeated(words),
        lines.total(),
        kinds % SHOUTED,
        kinds // SHOUTED,
        sum(map(operator.eq, words, words[1:])),
    )


def mask(rules: Iterable[str]) -> int:
    """The bits of the named rules; an unknown name raises ``ValueError``."""
    order = list(RULES)
    return sum(1 << order.index(name) for name in set(rules))


def ledger(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measurements, and ``failures``, a bit per failed rule.

    One pass without a shuffle over the whole texts.  A null text measures as an empty one and fails
    ``few_words``; null or repeated ids and repeated rows stay rows of their own; other columns
    are ignored; no rows give no rows.
    """

    def batches(rows):
        for batch in rows:
            found = np.array([measure(t) for t in batch.column(1).to_pylist()], dtype=np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in found.T.copy())], ["doc_id", *MEASURES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    measured = docs.select("doc_id", "text").mapInArrow(batches, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = " + ".join(f"IF({rule}, {1 << n}, 0)" for n, rule in enumerate(RULES.values()))
    return measured.withColumn("failures", F.expr(f"CAST({bits} AS BIGINT)"))


def fails(rules: Iterable[str], failures: str = "failures") -> Column:
    """Whether a row of a ledger fails any of the named rules."""
    return F.col(failures).bitwiseAND(F.lit(mask(rules))) != 0


def verdicts(entries: DataFrame, version: int) -> DataFrame:
    """The ledger with ``kept`` under a version of the policy; texts are not read again."""
    return entries.withColumn("kept", ~fails(POLICIES[version]))


def ablations(entries: DataFrame, versions: Iterable[int] = tuple(POLICIES)) -> DataFrame:
    """What each rule of each policy does: one row per version and rule.

    Columns: version, rule, n_docs, n_kept (under the whole policy), n_failed (documents that fail the
    rule), n_only (those that fail no other rule of the policy), n_kept_without (kept if the rule
    were left out).  The ledger is first counted per distinct mask, of which there are at most two
    to the number of rules; everything else is bitwise work on these counts.  An empty ledger
    gives no rows.
    """
    order = list(RULES)
    cells = [(v, name, mask(POLICIES[v]), 1 << order.index(name)) for v in versions for name in POLICIES[v]]
    cell = F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(c, ("version", "rule", "all", "bit"), strict=True)]) for c in cells]))
    counts = entries.groupBy("failures").agg(F.count("*").alias("n")).select("failures", "n", cell.alias("c")).select("failures", "n", "c.*")
    hit = F.col("failures").bitwiseAND(F.col("all"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return counts.groupBy("version", "rule").agg(
        F.sum("n").alias("n_docs"),
        total(hit == 0).alias("n_kept"),
        total(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(hit == F.col("bit")).alias("n_only"),
        total((hit == 0) | (hit == F.col("bit"))).alias("n_kept_without"),
    )


def judge(docs: DataFrame, version: int = 3) -> DataFrame:
    """Ledger, base verdict and the verdict of a policy for every row of ``docs``."""
    entries = verdicts(ledger(docs), version).withColumn("base_failed", fails(BASE))
    return entries.withColumn("kept", F.col("kept") & ~F.col("base_failed"))
