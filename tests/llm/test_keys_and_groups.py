"""Rows told apart by id and text, large groups of near copies, an independent label model."""

import random

import numpy as np
import pytest

import corpus_pipeline
from panelmill.llm import contamination, ngram_join, toxicity
from panelmill.llm.common import prepare, shingle_set

from .test_documents import changed, labelled, prose

random.seed(17)
SCHEMA = "doc_id long, text string, sig long, doc string"


def frame(spark, rows):
    return prepare(spark).createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(4)


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_one_of_each_group_stays_by_id_and_text(spark):
    p, q, near = prose(40), prose(40), prose(120)
    copy = changed(near, 1)
    rows = [(5, p), (5, q), (5, q), (None, near), (None, near), (7, copy), (8, near), (None, None), (None, None), (None, ""), (9, "a b"), (9, "A  B"), (10, None), (11, "")]
    got = kept(ngram_join.keep_one(frame(spark, rows)))
    ids_and_texts = [(i, (t or "").lower().split()) for i, t in got]
    assert sorted(ids_and_texts, key=repr) == sorted(
        [(5, p.lower().split()), (5, q.lower().split()), (7, copy.lower().split()), (None, []), (9, ["a", "b"]), (10, []), (11, [])], key=repr
    )


@pytest.mark.parametrize("near", [0.4, 0.9])
def test_two_thousand_near_copies(spark, near):
    """A third of the rows are variants of one text, many of them just below or above the threshold."""
    base = prose(90).split(" ")
    rows = []
    for k in range(700):
        words = list(base)
        for at in random.sample(range(90), random.randint(0, int(6 * near) + 1)):
            words[at] = f"w{random.randint(0, 40)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, prose(random.randint(1, 60))) for k in range(1300)]
    sets = [set(shingle_set(t).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for h in s:
            holders.setdefault(h, []).append(k)
    seen = set()
    for members in holders.values():
        for n, a in enumerate(members):
            for b in members[:n]:
                if (a, b) not in seen and root(a) != root(b):
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                        parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(frame(spark, rows)).collect()}
    assert got == {(i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)}


def test_links_of_blocks_are_at_most_one_a_member(spark, monkeypatch):
    """Mixed lists cut into many small blocks give the same components, and no more links than members."""
    base = prose(60).split(" ")
    rows = [(k, " ".join([f"v{k}_{n}" if random.random() < 0.03 else w for n, w in enumerate(base)])) for k in range(120)]
    whole = {tuple(r) for r in ngram_join.join(frame(spark, rows)).collect()}
    monkeypatch.setattr(ngram_join, "MEMBERS", 16)
    monkeypatch.setattr(ngram_join, "drawn_pairs", lambda within, percent: within.selectExpr("sig AS a", "sig AS b").where("1 = 0"))
    found = []
    plain = ngram_join.linked

    def counted(*given):
        out = plain(*given)
        found.append((given[0].count(), out.count()))
        return out

    monkeypatch.setattr(ngram_join, "linked", counted)
    assert {tuple(r) for r in ngram_join.join(frame(spark, rows)).collect()} == whole
    assert found and all(links <= members * 16 for members, links in found)


def test_wide_sums_of_a_point_do_not_wrap():
    points = np.full((1, 4096), 200, dtype=np.uint8)
    assert ngram_join.fold(points, 8).tolist() == [[102400] * 8]


def test_items_of_one_or_no_id_are_items_of_their_own(spark):
    a, b, c = prose(20), prose(20), prose(20)
    items = spark.createDataFrame([(None, a), (None, b), (3, a), (3, c), (3, c), (4, None)], "item_id long, text string")
    docs = frame(spark, [(1, f"{prose(9)} {a} {prose(9)}"), (2, f"{b} {prose(5)}"), (3, f"{prose(30)} {c}"), (4, prose(50)), (None, b)])
    got = sorted(((r["doc_id"], r["item_id"]) for r in contamination.matches(docs, items).collect()), key=repr)
    assert got == sorted([(1, None), (1, 3), (2, None), (3, 3), (None, None)], key=repr)
    assert [i for i, _ in kept(contamination.clean(docs, items))] == [4]


def test_toxic_rows_go_by_their_own_text(spark, tmp_path):
    docs, labels = labelled(spark, "vilest zounds", "toxic")
    docs = docs.select("doc_id", "text")
    bad = docs.where("doc_id = 8").first()["text"]
    more = spark.createDataFrame([(None, bad), (8, prose(30)), (1, bad), (None, prose(30))], docs.schema)
    every = docs.union(more).selectExpr("doc_id", "text", "1 AS doc", "'s' AS source")
    labels.select("doc_id", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    left = corpus_pipeline.toxicity(spark, prepare(spark) and every, str(tmp_path))
    assert left.columns == every.columns
    rows = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert all("zounds" not in (t or "") for _, t in rows)
    assert sum(i is None for i, _ in rows) == 2 and sum(i == 8 for i, _ in rows) == 1 and sum(i == 1 for i, _ in rows) == 1
    assert len(rows) > 440 and {9001, 9002} <= {i for i, _ in rows}
    assert corpus_pipeline.toxicity(spark, every.where("1 = 0"), str(tmp_path)).isEmpty()


def test_labels_without_a_document_and_repeated_ids(spark):
    """Counts come from the rows that were mined: labels of absent ids are no documents."""
    docs, labels = labelled(spark, "vilest zounds", "toxic")
    strangers = spark.createDataFrame([(10_000 + k, 1, 1) for k in range(3000)], labels.schema)
    plain = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels).where("doc_id < 600").collect()}
    mixed = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels.union(strangers)).where("doc_id < 600").collect()}
    assert plain.keys() == mixed.keys() and max(abs(plain[i] - mixed[i]) for i in plain) < 1e-9


def test_label_model_against_plain_expectation_maximization():
    """Votes drawn from known accuracies: the steps equal a row-by-row version and find the accuracies again."""
    rng = np.random.default_rng(5)
    truth = rng.random(6000) < 0.3
    rates = np.array([[0.05, 0.1, 0.02, 0.2], [0.7, 0.5, 0.6, 0.4]])
    votes = (rng.random((6000, 4)) < rates[truth.astype(int)]).astype(float)
    model = toxicity.LabelModel(np.arange(4), 0.2, np.array([[0.1, 0.4]] * 4))
    prior, rate = 0.2, np.array([[0.1] * 4, [0.4] * 4])
    for _ in range(30):
        p = model.posterior(model.grouped(votes))
        plain = []
        for row in votes:
            odds = prior / (1 - prior)
            for v, clean, toxic in zip(row, *rate, strict=True):
                odds *= toxic / clean if v else (1 - toxic) / (1 - clean)
            plain.append(odds / (1 + odds))
        plain = np.array(plain)
        assert np.allclose(p, plain)
        model.step(np.concatenate([[len(votes), p.sum()], votes.sum(0), p @ votes]))
        clean = ((1 - plain) @ votes + 0.1) / ((1 - plain).sum() + 100)
        rate = np.stack([clean, np.maximum((plain @ votes + 1) / (plain.sum() + 4), clean)])
        prior = min(max(plain.mean(), 1e-4), 0.5)
        assert np.allclose(rate, model.rate) and np.isclose(prior, model.prior)
    assert np.abs(model.rate - rates).max() < 0.06 and abs(model.prior - 0.3) < 0.04
