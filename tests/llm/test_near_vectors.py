"""Near vectors in blocks, in repeated buckets, and against the check SQL with planted links."""

from __future__ import annotations

import duckdb
import numpy as np

from panelmill.llm import blocks, queries, vectors
from panelmill.llm.common import prepare


def planted(rng, cosine: float, n: int, d: int = 64):
    """Pairs of unit vectors at one cosine."""
    x = rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.standard_normal((n, d))
    y -= (x * y).sum(1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    return x, cosine * x + np.sqrt(1 - cosine**2) * y


def frame(spark, data, labels):
    rows = [(k, [float(c) for c in v], int(label)) for k, (v, label) in enumerate(zip(data, labels, strict=True))]
    return prepare(spark).createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_pairs_of_blocks_by_brute_force():
    """Blocks of every size, of one half and of two, side by side: each pair once."""
    rng = np.random.default_rng(11)
    keys = {"bucket": [], "i": [], "j": [], "chunk": []}
    for bucket, n in enumerate([1, 2, 3, 7, 8, 9, 30, 2, 5]):
        for i, j in ((0, 0), (0, 1)):
            keys["bucket"] += [bucket] * n
            keys["i"] += [i] * n
            keys["j"] += [j] * n
            keys["chunk"] += sorted(rng.integers(i, j + 1, n).tolist())
    columns = {c: np.array(v) for c, v in keys.items()}
    n = len(columns["chunk"])
    x = vectors.normalised(np.ones((n, 16)) + 0.6 * rng.standard_normal((n, 16)))
    a, b = vectors.pairs_of(columns, x, 0.75)
    got = list(zip(a.tolist(), b.tolist(), strict=True))

    def meet(p, q):
        same = all(columns[c][p] == columns[c][q] for c in ("bucket", "i", "j"))
        return same and (columns["i"][p] == columns["j"][p] or columns["chunk"][p] != columns["chunk"][q])

    true = {(p, q) for p in range(n) for q in range(p + 1, n) if meet(p, q) and x[p] @ x[q] >= 0.75}
    assert len(got) == len(set(got)) and set(got) == true and 10 < len(true) < n * n / 2


def test_a_pair_counts_in_the_first_table_it_shares(monkeypatch):
    monkeypatch.setattr(vectors, "CELLS", 40)
    rng = np.random.default_rng(2)
    cells, t = rng.integers(0, 4, (60, 5)), rng.integers(0, 5, 60)
    a, b = rng.integers(0, 60, 500), rng.integers(0, 60, 500)
    expected = [not any(cells[p, k] == cells[q, k] for k in range(t[p])) for p, q in zip(a, b, strict=True)]
    assert vectors.met_first(cells, t, a, b).tolist() == expected
    assert vectors.met_first(cells, t, a[:0], b[:0]).tolist() == []


def test_groups_with_the_same_members_are_kept_once(spark):
    members = {10: [1, 2, 3], 20: [1, 2, 3], 31: [1, 2], 42: [3, 4], 50: [1, 2, 3], 64: [5]}
    rows = [(n, g, g // 10) for g, ns in members.items() for n in ns]
    given = spark.createDataFrame(rows, "node long, bucket long, t int")
    kept = {r["bucket"] for r in blocks.block_pairs(given, "bucket", "node", 512, once="t").collect()}
    assert kept == {10, 31, 42}
    assert {r["bucket"] for r in blocks.block_pairs(given, "bucket", "node", 512).collect()} == {10, 20, 31, 42, 50}


def test_large_groups_in_blocks(spark, monkeypatch):
    """A group of near copies over many blocks: every link once, one component."""
    monkeypatch.setattr(vectors, "MEMBERS", 40)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(64)
    data = np.concatenate([centre + 0.08 * rng.standard_normal((400, 64)), rng.standard_normal((60, 64))])
    got = vectors.near(frame(spark, data, [1] * 460)).collect()
    assert all(r["n_links"] == (399 if r["vec_id"] < 400 else 0) for r in got)
    assert all(r["component_id"] == (0 if r["vec_id"] < 400 else r["vec_id"]) for r in got)


def test_recall_of_pairs_just_above_the_threshold(spark):
    rng = np.random.default_rng(9)
    found = {}
    for cosine in (0.9305, 0.94, 0.95, 0.9295):
        x, y = planted(rng, cosine, 1500)
        rows = vectors.near(frame(spark, np.concatenate([x, y]), np.tile(np.arange(1500) % 3, 2))).collect()
        assert all(r["component_id"] == r["vec_id"] % 1500 for r in rows if r["n_links"])
        found[cosine] = sum(r["n_links"] for r in rows) / 3000
    print(found)
    assert found[0.9295] == 0
    assert found[0.9305] > 0.95 and found[0.94] > 0.97 and found[0.95] > 0.985


def test_check_sql_with_planted_links(spark):
    rng = np.random.default_rng(6)
    x, y = planted(rng, 0.985, 150)
    z = planted(rng, 0.9, 100)
    data = np.concatenate([x, y, *z, x[:20], y[:20]]).astype(np.float32)
    labels = np.r_[np.arange(150) % 4, np.arange(150) % 4, np.arange(100) % 4, np.arange(100) % 4, np.arange(20) % 4, np.arange(20) % 5]
    given = frame(spark, data, labels).selectExpr("vec_id", "CAST(embedding AS array<float>) AS embedding", "label")
    con = duckdb.connect()
    embeddings = given.toArrow()  # noqa: F841 - read by name below
    con.register("embeddings", embeddings)
    cur = con.execute(queries.CHECKS["op2_embedding_near_dedup"])
    names = [d[0] for d in cur.description]
    expected = sorted(cur.fetchall())
    assert sorted(tuple(r) for r in vectors.near(given).select(*names).collect()) == expected
    assert sum(r[names.index("n_links")] for r in expected) > 300
