"""Toxicity by weak supervision: mined voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelmill.llm.common import Memo, fold
from panelmill.session import stage

WORD_PATTERN = re.compile(r"[^\W_]+")
PREFIXES = (4, 5)
VOTERS, FEATURES = 192, 2048
LEAST_GAIN = 24.0
SAMPLE = 40_000
# Labelled ids that voters are mined from: a table of some megabytes.
LABELS = 200_000


def signals(word: str) -> tuple[str, ...]:
    """What voters may look for: the word itself, and what it begins with (marked with ``*``)."""
    return (word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n))


def doc_signals(text: str | None, memo: dict) -> set:
    out: set = set()
    if text:
        for word in set(WORD_PATTERN.findall(text.lower())):
            out.update(memo[word])
    return out


def mine(train: DataFrame) -> DataFrame:
    """Per signal of the labelled training texts: documents that hold it, and toxic ones of them.

    Counted per task first; only signals and their two counts are shuffled.
    """

    def batches(rows):
        memo, toxic, clean = Memo(signals), Counter(), Counter()

        def flush():
            names = list(toxic.keys() | clean.keys())
            hits = [toxic[n] for n in names]
            out = [pa.array(names, pa.string()), pa.array([t + clean[n] for n, t in zip(names, hits, strict=True)], pa.int64()), pa.array(hits, pa.int64())]
            toxic.clear()
            clean.clear()
            return pa.RecordBatch.from_arrays(out, ["signal", "n", "hits"])

        for batch in rows:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (toxic if label else clean).update(doc_signals(text, memo))
            if len(toxic) + len(clean) > 500_000:
                yield flush()
        yield flush()

    found = train.select("text", "toxic").mapInArrow(batches, "signal string, n long, hits long")
    return found.groupBy("signal").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))


def choose(counts: DataFrame, total: int, toxic: int) -> list[tuple[str, float, float]]:
    """The signals that tell most, best first, with their shares of clean and toxic texts.

    Told by the likelihood ratio of their two shares against one common share; LEAST_GAIN is far beyond
    what the best of a hundred thousand signals reaches by chance.  At most FEATURES: a bounded model.
    """
    t, n = F.col("hits"), F.col("n")
    clean = float(total - toxic)

    def surprise(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    parts = [(t, n * (toxic / total)), (n - t, n * (clean / total)), (toxic - t, (total - n) * (toxic / total)), (clean - (n - t), (total - n) * (clean / total))]
    gain = 2 * sum((surprise(seen.cast("double"), expected) for seen, expected in parts), F.lit(0.0))
    good = counts.where(t / toxic > 2 * (n - t) / clean).select("signal", ((n - t) / clean).alias("c"), (t / toxic).alias("t"), gain.alias("gain")).where(F.col("gain") >= LEAST_GAIN)
    return [(r["signal"], r["c"], r["t"]) for r in good.orderBy(F.desc("gain"), "signal").limit(FEATURES).collect()]


def featurize(docs: DataFrame, features: list[str]) -> DataFrame:
    """Per document: doc_id, held_out, and the indices of the features that its text has."""
    index = {f: i for i, f in enumerate(features)}

    def batches(rows):
        memo = Memo(lambda word: tuple(index[s] for s in signals(word) if s in index))
        for batch in rows:
            has = [sorted(doc_signals(t, memo)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(has, pa.list_(pa.int32()))], ["doc_id", "held_out", "has"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(batches, f"doc_id {kind}, held_out boolean, has array<int>")


def votes_of(has: list, voters: int) -> np.ndarray:
    votes = np.zeros((len(has), voters))
    for row, h in enumerate(has):
        h = np.asarray(h, dtype=int)
        votes[row, h[h < voters]] = 1.0
    return votes


def sums(frame: DataFrame, partial, names: str) -> np.ndarray:
    """Sum over all rows of the vector that ``partial(pandas frame)`` gives per batch."""

    def batches(rows):
        total = None
        for batch in rows:
            if len(batch):
                value = partial(batch)
                total = value if total is None else total + value
        if total is not None:
            yield pd.DataFrame({"i": np.arange(total.size), "x": total.ravel()})

    got = frame.select(*names.split()).mapInPandas(batches, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(max((r["i"] for r in got), default=-1) + 1)
    for r in got:
        out[r["i"]] = r["x"]
    return out


def groups_of(corr: np.ndarray, least: float = 0.6) -> np.ndarray:
    """Voters as groups: those joined by a correlation of at least ``least`` vote as one."""
    group = np.arange(len(corr))
    for i in range(len(corr)):
        for j in np.flatnonzero(corr[i, :i] >= least):
            group[group == group[i]] = group[j]
    return np.unique(group, return_inverse=True)[1]


class LabelModel:
    """Accuracies of groups of correlated voters and the class balance, from votes alone."""

    def __init__(self, group: np.ndarray, prior: float, shares: np.ndarray):
        self.group, self.size = group, int(group.max()) + 1
        self.prior = min(max(prior, 1e-4), 0.5)
        # P(vote | class), to begin with the largest share of the group's voters.
        self.rate = np.array([[shares[group == g, k].max() for g in range(self.size)] for k in (0, 1)])
        self.rate = np.clip(self.rate, 1e-4, 0.9)

    def grouped(self, votes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(votes), self.size))
        for g in range(self.size):
            out[:, g] = votes[:, self.group == g].max(1)
        return out

    def posterior(self, grouped: np.ndarray) -> np.ndarray:
        a, b = np.log(self.rate), np.log1p(-self.rate)
        x = np.log(self.prior / (1 - self.prior)) + grouped @ (a[1] - a[0]) + (1 - grouped) @ (b[1] - b[0])
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    def step(self, total: np.ndarray) -> float:
        """One maximization from the sums (n, posterior, votes, votes by posterior)."""
        n, pos, k = total[0], total[1], self.size
        all_votes, hit = total[2 : 2 + k], total[2 + k :]
        rate = np.stack([(all_votes - hit + 0.1) / (n - pos + 100), (hit + 1) / (pos + 4)])
        rate = np.clip(rate, 1e-6, 1 - 1e-6)
        moved = float(np.abs(rate - self.rate).max())
        # A toxic class of at most half of the rows, which every voter marks oftener.
        self.rate = np.stack([rate[0], np.maximum(rate[1], rate[0])])
        self.prior = float(np.clip(pos / max(n, 1), 1e-4, 0.5))
        return moved


def logistic(has: list, target: np.ndarray, width: int, rounds: int = 200, penalty: float = 1.0) -> np.ndarray:
    """Weights (the last is the intercept) of an L2-penalized logistic regression on soft labels."""
    rows = np.repeat(np.arange(len(has)), [len(h) for h in has])
    cols = np.concatenate([np.asarray(h, dtype=int) for h in has]) if len(rows) else np.empty(0, dtype=int)
    w, step = np.zeros(width + 1), np.zeros(width + 1)
    square = np.full(width + 1, 1e-8)
    for _ in range(rounds):
        x = w[-1] + np.bincount(rows, w[cols], len(has))
        error = 1 / (1 + np.exp(-np.clip(x, -40, 40))) - target
        grad = np.append(np.bincount(cols, error[rows], width), error.sum())
        grad[:-1] += penalty * w[:-1]
        step = 0.9 * step + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        w -= 0.1 * step / np.sqrt(square)
    return w


def training(docs: DataFrame, labels: DataFrame, most: int = LABELS) -> DataFrame:
    """(text, toxic) of the labelled training rows.

    Of all labelled training ids the ``most`` with the least hashes are taken, so that they are
    a table of bounded size, which is sent to the texts; no text is moved to meet its label.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(fold(F.col("doc_id"), 5) != 0).orderBy(F.xxhash64("doc_id", F.lit("label")), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")


@dataclass(frozen=True)
class Model:
    """Features and their weights (the last is the intercept); both empty where nothing could be learned."""

    features: list[str]
    weights: np.ndarray

    def scores(self, has) -> np.ndarray:
        x = np.array([self.weights[-1] + self.weights[np.asarray(h, dtype=int)].sum() for h in has])
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame | None]:
    """The model learned from the training rows, and the staged features of all documents."""
    train = training(docs, labels)
    size = train.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    chosen = choose(mine(train), size["n"], size["t"]) if 0 < size["t"] < size["n"] else []
    features = [name for name, _, _ in chosen]
    if not features:
        return Model([], np.empty(0)), None
    marked = stage(featurize(docs, features), "marked")
    learn, voters = marked.where("NOT held_out"), min(VOTERS, len(features))

    def moments(batch):
        v = votes_of(batch["has"], voters)
        return np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])

    total = sums(learn, moments, "has")
    n, mean = total[0], total[1 : 1 + voters] / total[0]
    cov = total[1 + voters :].reshape(voters, voters) / n - np.outer(mean, mean)
    std = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    model = LabelModel(groups_of(cov / np.outer(std, std)), size["t"] / size["n"], np.array([x[1:] for x in chosen[:voters]]))

    def expect(batch):
        g = model.grouped(votes_of(batch["has"], voters))
        p = model.posterior(g)
        return np.concatenate([[len(g), p.sum()], g.sum(0), p @ g])

    for _ in range(8):
        if model.step(sums(learn, expect, "has")) < 1e-3:
            break
    order = F.xxhash64("doc_id", F.lit("sample"))
    some = [learn.where(F.size("has") > 0), learn.where(F.size("has") == 0)]
    taken = [r["has"] for part in some for r in part.orderBy(order).limit(SAMPLE // 2).select("has").collect()]
    target = model.posterior(model.grouped(votes_of(taken, voters)))
    return Model(features, logistic(taken, target, len(features))), marked


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1) and predicted (1 from 0.5).

    Voters are mined from labelled texts of the training rows (crc32 of the id modulo 5 is not 0), of at most
    LABELS ids: lexicon voters look for a word, pattern voters for words that begin alike.  Correlations
    of their votes over the training rows, labelled or not, join voters that repeat each other into one;
    expectation maximization over the same rows estimates how often each votes in either class,
    and the class balance, which starts from the labelled share.  A logistic regression is fitted
    to the posteriors of a bounded sample (the SAMPLE training rows with the least hashes, half
    of them among rows with a vote), over the features; it scores every document from its whole text.

    Null or empty texts have no features and get the score of the intercept.  Ids without a label
    row or with a null label only take part unlabelled; several label rows of one id count as their
    maximum, labels of an id without a document not at all, and of an id with several documents with
    each of them.  Rows with a null id are training rows.  Repeated rows are scored each.  Without
    labels of both classes all scores are 0.
    """
    model, marked = fit(docs, labels)
    if marked is None:
        held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
        return docs.select("doc_id", held.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    def scored(rows):
        for batch in rows:
            s = model.scores(batch["has"])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return marked.mapInPandas(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that aren't predicted toxic, each judged by its own text; all columns as they are.

    The model goes to the rows, so that no row is moved, and null or repeated ids make no difference.
    """
    model, marked = fit(docs, labels)
    if marked is None:
        return docs
    index = {f: i for i, f in enumerate(model.features)}

    def clean(batches):
        memo = Memo(lambda word: tuple(index[s] for s in signals(word) if s in index))
        for batch in batches:
            has = [sorted(doc_signals(t, memo)) for t in batch.column(0).field(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(model.scores(has) < 0.5))], ["doc"])

    # The row travels as one value, so that its columns may have any names.
    at = [c.lower() for c in docs.columns].index("text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return rows.mapInArrow(clean, StructType([rows.schema["doc"]])).select("doc.*")
