"""Models against plain versions: discriminant by inverse covariances, its curve by many small steps."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import xxhash

from panelmill.llm import class_lm, quality
from panelmill.llm.common import prepare


def plain_margin(x, y, asked, shrink=0.1):
    """Log density of class 1 less that of class 0, by inverses and determinants."""
    parts = [x[y == k] for k in (0, 1)]
    covs = [np.cov(p.T, bias=True) for p in parts]
    pooled = sum(len(p) / len(x) * c for p, c in zip(parts, covs, strict=True))
    target = np.diag(np.diag(pooled)) + 1e-6 * np.eye(x.shape[1])
    value = []
    for p, c in zip(parts, covs, strict=True):
        s = (1 - shrink) * c + shrink * target
        d = asked - p.mean(0)
        value.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
    return value[1] - value[0]


def text_of(draw, good: bool) -> str:
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(draw.randint(5, 80))]
    if not good or draw.random() < 0.15:
        words = [draw.choice([w, w.upper(), "|", "###", "7"]) for w in words]
    if good:
        words[-1] += "."
    return draw.choice([" ", "\n"]).join(words)


def test_quality_against_a_plain_discriminant(spark):
    draw = random.Random(21)
    truth = [draw.random() < 0.6 for _ in range(500)]
    texts = [text_of(draw, good) for good in truth]
    noisy = [int(good if draw.random() < 0.9 else not good) for good in truth]
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame(list(enumerate(noisy)), "doc_id long, quality int")
    got = {r["doc_id"]: (r["held_out"], r["score"], r["predicted"]) for r in quality.score(docs, labels).collect()}

    held = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i in range(500)])
    x, y = np.stack([quality.statistics(t) for t in texts]), np.array(noisy)
    margin = plain_margin(x[~held], y[~held], x)
    m = np.clip(margin[~held], -30, 30)
    slope, shift = 0.3, 0.0
    for _ in range(40_000):
        p = 1 / (1 + np.exp(-np.clip(slope * m + shift, -40, 40)))
        slope -= 0.01 * ((p - y[~held]) * m).mean()
        shift -= 0.1 * (p - y[~held]).mean()
    expected = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -40, 40)))
    score = np.array([got[i][1] for i in range(500)])
    assert [got[i][0] for i in range(500)] == held.tolist()
    assert np.abs(score - expected).max() < 0.02
    # The curve is monotone, so that the order is that of the margins.
    order = np.argsort(margin, kind="stable")
    assert (np.diff(score[order]) >= -1e-9).all()
    assert [got[i][2] for i in range(500)] == [int(s >= 0.7) for s in score]


def test_a_very_long_text_has_a_score(spark):
    draw = random.Random(3)
    rows = [(i, text_of(draw, i % 3 > 0)) for i in range(120)] + [(500, " ".join(text_of(draw, True) for _ in range(3000)))]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, labels).collect()}
    assert len(got) == 121 and all(0 <= s <= 1 for s in got.values())


def test_places_are_searched_once_a_text_not_once_a_word(monkeypatch):
    words = [b"w%d" % k for k in range(500)]
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words[:200]], dtype=np.uint64).view(np.int64)
    known = pd.DataFrame({"hash": hashes, "c": np.ones(200, dtype=np.int64), "bucket": np.array([class_lm.bucket_of(w) for w in words[:200]], dtype=np.int32)})
    names, searches, search = class_lm.Numbering(known, 2.0), [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a: searches.append(a) or search(*a))
    got = names.places(words)
    assert len(searches) == 1 and names.places([]) == []
    assert [int(names.hash[p]) for p in got[:200]] == hashes.tolist()
    assert got[200:] == [-1 - class_lm.bucket_of(w) for w in words[200:]]
    assert class_lm.Numbering(known[:0], 2.0).places(words) == [-1 - class_lm.bucket_of(w) for w in words]
