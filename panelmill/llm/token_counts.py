"""Token counts by a linear longest-match automaton, without building the pieces."""

from __future__ import annotations

import base64
from collections import deque

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import Memo

MARK = b" "


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a vocabulary file with one base64 piece and its rank per line."""
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]


class Automaton:
    """A trie of the vocabulary with failure links and the number of pieces each link pops.

    ``fail[v]`` is the node for what is left of the string of ``v`` once its longest-match pieces
    are cut off from its front as far as they are certain, ``popped[v]`` their number; -1 where
    no piece fits.  A word is read once, byte by byte, and every step either goes down the trie or
    pops pieces, so that the time is linear in its length.
    """

    def __init__(self, pieces: list[bytes]):
        self.next: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in pieces:
            at = 0
            for byte in piece:
                step = self.next[at].get(byte)
                if step is None:
                    step = self.next[at][byte] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                at = step
            ends[at] = at != 0
        self.fail, self.popped = [-1] * len(self.next), [0] * len(self.next)
        queue = deque([0])
        while queue:
            at = queue.popleft()
            for byte, step in self.next[at].items():
                queue.append(step)
                if ends[step]:
                    self.fail[step], self.popped[step] = 0, 1
                    continue
                back, count = self.fail[at], self.popped[at]
                while back >= 0 and byte not in self.next[back]:
                    count += self.popped[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[step], self.popped[step] = self.next[back][byte], count

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match, or -1 if some part of the word fits no piece."""
        at, count = 0, 0
        for byte in word:
            while byte not in self.next[at]:
                count += self.popped[at]
                at = self.fail[at]
                if at < 0:
                    return -1
            at = self.next[at][byte]
        while at > 0:
            count += self.popped[at]
            at = self.fail[at]
        return count if at == 0 else -1


AUTOMATA: dict[str, tuple[Automaton, Memo]] = {}


def counter(path: str) -> Memo:
    """Word to number of pieces, with the automaton of a vocabulary built once per worker."""
    if path not in AUTOMATA:
        automaton = Automaton(read_ranks(path))
        AUTOMATA[path] = automaton, Memo(lambda word: automaton.count(MARK + word))
    return AUTOMATA[path][1]


def vocabulary_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per row: the key, ``n_words``, ``n_tokens`` and ``n_unknown``.

    Words are runs of characters other than space and 0x09-0x0D.  Every word is read with a space
    in front, so that pieces that begin with a space begin a word and all others continue one, and
    cut greedily into the longest pieces of the vocabulary file (by default the byte-level one of
    50 thousand pieces, which holds every byte).  A word that no pieces fit counts as one token and as
    unknown.  A null or empty text has no words and 0 tokens; repeated rows are counted each.
    """
    path = path or vocabulary_path()

    def batches(rows):
        count = counter(path)
        for batch in rows:
            words, tokens, unknown = [], [], []
            for value in batch.column(1).to_pylist():
                parts = value.encode("utf-8", "surrogatepass").split() if value else []
                pieces = [count[w] for w in parts]
                bad = pieces.count(-1)
                words.append(len(parts))
                tokens.append(sum(pieces) + 2 * bad)
                unknown.append(bad)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array(unknown, pa.int64())],
                ["key", "n_words", "n_tokens", "n_unknown"],
            )

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    out = source.mapInArrow(batches, f"key {kind}, n_words long, n_tokens long, n_unknown long")
    return out.withColumnRenamed("key", key)
