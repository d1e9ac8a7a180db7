"""Quality by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import fold
from panelmill.llm.toxicity import sums
from panelmill.session import stage

LETTERS, UPPER_CASE, DIGITS = re.compile(r"[^\W\d_]"), re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d")
END_MARK = (".", ",", "!", "?", ";", ":")
STATISTICS = 16


def statistics(text: str | None) -> np.ndarray:
    """Sixteen transformed statistics of a whole text; counts by log, shares by square root."""
    text = text or ""
    words = text.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    counts = Counter(w.lower() for w in words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters, upper, digits = (len(p.findall(text)) for p in (LETTERS, UPPER_CASE, DIGITS))
    spaces = sum(map(text.count, (" ", "\n", "\t")))
    marks = sum(map(text.count, END_MARK))
    odd = max(chars - letters - digits - spaces - marks, 0) if text else 0
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    pairs = len(set(zip(words, words[1:], strict=False)))
    share = np.sqrt(
        [
            upper / max(letters, 1),
            digits / chars,
            odd / chars,
            marks / chars,
            text.count("!") / n,
            text.count("|") / n,
            repeats / n,
            1 - pairs / max(len(words) - 1, 1) if len(words) > 1 else 0.0,
            1 - len(set(lines)) / max(len(lines), 1) if lines else 0.0,
            max(counts.values(), default=0) / n,
            sum(len(w) == 1 and not w.isalnum() for w in words) / n,
            sum(w.endswith((".", "!", "?")) for w in words) / n,
        ]
    )
    return np.concatenate([np.log1p([len(words), (chars - spaces) / n, len(lines) and n / len(lines)]), [np.log1p(len(counts)) / np.log1p(n)], share])


class Discriminant:
    """Two normal densities with shrunken covariances; their Cholesky factors are kept."""

    def __init__(self, total: np.ndarray, shrink: float = 0.1):
        d = STATISTICS
        self.prior, mean, cov, self.factor = np.zeros(2), [], [], []
        for k in (0, 1):
            part = total[k * (1 + d + d * d) : (k + 1) * (1 + d + d * d)]
            n, m = part[0], part[1 : 1 + d] / part[0]
            self.prior[k] = n
            mean.append(m)
            cov.append(part[1 + d :].reshape(d, d) / n - np.outer(m, m))
        self.prior /= self.prior.sum()
        self.mean = np.array(mean)
        pooled = sum(p * c for p, c in zip(self.prior, cov, strict=True))
        target = np.diag(np.diag(pooled)) + 1e-6 * np.eye(d)
        self.factor = [np.linalg.cholesky((1 - shrink) * c + shrink * target) for c in cov]
        self.logdet = [2 * np.log(np.diag(f)).sum() for f in self.factor]
        self.slope, self.shift = 1.0, 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        value = []
        for m, f, logdet in zip(self.mean, self.factor, self.logdet, strict=True):
            z = np.linalg.solve(f, (x - m).T)
            value.append(-0.5 * ((z * z).sum(0) + logdet))
        return value[1] - value[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -40, 40)))


def matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in column])


def score(docs: DataFrame, labels: DataFrame, shrink: float = 0.1, threshold: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold``).

    Both classes' means and covariances come from all labelled training rows (crc32 of the id
    modulo 4 is not 2); covariances are shrunk by ``shrink`` towards the diagonal of the pooled one.
    The difference of log densities (Mahalanobis distances by cached Cholesky factors) becomes a probability by a
    two-parameter logistic curve, also fitted on the training rows.

    Null or empty texts have the statistics of an empty text and are scored like others.  Null
    labels and ids without labels don't teach; several label rows of one id count as their least.
    Rows with a null id are never held out.  Without two training rows of each class all scores are 1 (nothing is
    known against a document).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))

    def measured(rows):
        for batch in rows:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "x": [statistics(t).tolist() for t in batch["text"]]})

    source = docs.select("doc_id", held.alias("held_out"), "text")
    stats = stage(source.mapInPandas(measured, f"doc_id {kind}, held_out boolean, x array<double>"), "statistics")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    train = stats.where("NOT held_out").join(known, "doc_id")
    d = STATISTICS

    def moments(batch):
        x, y, out = matrix(batch["x"]), batch["quality"].to_numpy(), []
        for k in (0, 1):
            part = x[y == k]
            out += [[len(part)], part.sum(0), (part.T @ part).ravel()]
        return np.concatenate(out)

    total = sums(train, moments, "x quality")
    if total.size == 0 or min(total[0], total[1 + d + d * d]) < 2:
        return stats.select("doc_id", "held_out", F.lit(1.0).alias("score"), F.lit(1).alias("predicted"))
    model = Discriminant(total, shrink)

    def curve(batch):
        m, y = np.clip(model.margin(matrix(batch["x"])), -30, 30), batch["quality"].to_numpy()
        p = 1 / (1 + np.exp(-np.clip(model.slope * m + model.shift, -40, 40)))
        v = p * (1 - p)
        return np.array([((p - y) * m).sum(), (p - y).sum(), (v * m * m).sum(), (v * m).sum(), v.sum()])

    model.slope, model.shift = 0.3, float(np.log(model.prior[1] / model.prior[0]))
    for _ in range(6):
        g1, g0, h11, h10, h00 = sums(train, curve, "x quality")
        move = np.linalg.solve(np.array([[h11 + 1e-3, h10], [h10, h00 + 1e-3]]), [g1, g0])
        move = np.clip(move, -1, 1)
        model.slope, model.shift = float(np.clip(model.slope - move[0], 0.02, 2)), model.shift - float(move[1])
        if np.abs(move).max() < 1e-3:
            break

    def scored(rows):
        for batch in rows:
            if len(batch):
                s = model.score(matrix(batch["x"]))
                yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": s, "predicted": (s >= threshold).astype(np.int32)})

    return stats.mapInPandas(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
