"""The operators over documents against plain versions, with odd rows and empty tables."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelmill.llm import class_lm, contamination, lines, ngram_join, packing, quality, token_counts, toxicity
from panelmill.llm.common import prepare

random.seed(5)
VOCABULARY = ["".join(random.choice("abcdefghij") for _ in range(random.randint(2, 7))) for _ in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sig string, key string, gone int, n_lines int"


def prose(n: int) -> str:
    return " ".join(random.choice(VOCABULARY) for _ in range(n))


def changed(text: str, n: int) -> str:
    words = text.split(" ")
    for at in random.sample(range(len(words)), n):
        words[at] = "x" + words[at]
    return " ".join(words)


LONG, SHARED, ITEM = prose(30_000), f"{prose(15)}\n{prose(9)}\n\n{prose(30)}", prose(20)
BASE = prose(120)
TEXTS = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "One  TWO"), (5, LONG), (5, prose(7)),
    (6, prose(60)), (6, prose(60)), (7, f"a b\n{SHARED}\nend"), (8, f"{SHARED.upper()}\nother end"), (9, f"x\n{SHARED}"),
    (10, f"{prose(40)} {ITEM} {prose(40)}"), (11, f"{prose(4000)} x{ITEM} {prose(50)}"), (12, ITEM[: len(ITEM) // 2]),
    (None, BASE), (None, None), (13, f"{prose(12)}\n{prose(12)}\nz"), (14, "\n".join(["same line " * 12] * 6)),
    *[(20 + k, changed(BASE, 1 + k % 3)) for k in range(25)], (50, BASE), (50, BASE), (51, prose(4)), (52, "naïve café " * 40),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "q", None, 1, 2) for i, t in TEXTS]
    return prepare(spark).createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM, 0), (2, None, 0), (3, "", 0), (4, "one two", 0), (None, prose(8), 0)], "item_id long, text string, hash int")


@pytest.fixture
def empty(docs):
    return docs.where("1 = 0")


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_token_counts_are_greedy(docs, empty):
    pieces = set(token_counts.read_ranks(token_counts.vocabulary_path()))

    def greedy(word):
        count = 0
        while word:
            word = word[next(n for n in range(len(word), 0, -1) if word[:n] in pieces) :]
            count += 1
        return count

    expected = [(i, len(w), sum(greedy(b" " + x) for x in w), 0) for i, w in ((i, (t or "").encode().split()) for i, t in TEXTS)]
    got = collected(token_counts.token_counts(docs), "doc_id", "n_words", "n_tokens", "n_unknown")
    assert got == sorted(expected, key=repr)
    assert token_counts.token_counts(empty).isEmpty()


def test_words_that_no_piece_fits():
    automaton = token_counts.Automaton([b"a", b"ab", b"bcd", b"abcde"])
    assert [automaton.count(w) for w in (b"ab", b"abcd", b"abcde", b"aab", b"abcdx", b"b", b"")] == [1, -1, 1, 2, -1, -1, 0]


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for i, t in TEXTS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], dtype="<u4").tobytes()
            expected.append((i, n, at, len(part) // 4, zlib.crc32(part)))
    rows = packing.pack(docs).collect()
    assert sorted([tuple(r)[:5] for r in rows], key=repr) == sorted(expected, key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for at, length in sorted(places):
            assert at == end
            end += length
        assert end <= 2048
    assert len(bins) <= -(-sum(e[3] for e in expected) // 2048) + 1
    assert packing.pack(empty).isEmpty()


@pytest.mark.parametrize("docs_cap, cost_cap", [(3, 10**9), (100, 5000)])
def test_best_fit_keeps_every_constraint(docs_cap, cost_cap):
    counts = {n: random.randint(1, 9) for n in range(1, 60)}
    bins, seen = defaultdict(list), defaultdict(list)
    for length, first, last, base, per, at in packing.best_fit(counts, 100, docs_cap, cost_cap):
        seen[length] += range(first, last)
        for k in range(last - first):
            bins[base + k // per].append((at + k % per * length, length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
    for places in bins.values():
        assert sum(n for _, n in places) <= 100 and len(places) <= docs_cap and sum(n * n for _, n in places) <= cost_cap
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:]))


def test_contamination_by_brute_force(docs, benchmark, empty):
    expected = set()
    for i, t in TEXTS:
        for item, q in benchmark.select("item_id", "text").collect():
            want, has = shingles(q), shingles(t)
            if want and 100 * len(want & has) >= 75 * len(want):
                expected.add((i, item, len(want), len(want & has)))
    got = collected(contamination.matches(docs, benchmark), "doc_id", "item_id", "n_shingles", "n_shared")
    assert got == sorted(expected, key=repr) and {(10, 1), (11, 1), (3, 4), (4, 4)} <= {g[:2] for g in got}
    bad = {g[0] for g in got}
    kept = contamination.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert collected(kept, "doc_id") == sorted([(i,) for i, _ in TEXTS if i not in bad], key=repr)
    assert contamination.matches(empty, benchmark).isEmpty()
    assert contamination.matches(docs, benchmark.where("1 = 0")).isEmpty()


def test_line_runs_by_brute_force(docs, empty):
    first, marked = {}, {}
    order = sorted({(i is None, i, t) for i, t in TEXTS if t}, key=lambda x: (x[0], x[1] or 0, x[2]))
    for _, i, t in order:
        rows = [w for w in map(words, t.split("\n")) if w]
        gone = marked.setdefault((i, t), set())
        for s in range(len(rows)):
            for e in range(s, min(len(rows), s + 20)):
                if sum(map(len, rows[s : e + 1])) >= 20:
                    run = tuple(map(tuple, rows[s : e + 1]))
                    if first.setdefault(run, (i, t, s)) != (i, t, s):
                        gone.update(range(s, e + 1))
    got = lines.dedup(docs)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_deleted"]
    assert collected(got, "doc_id", "n_deleted") == sorted([(i, len(marked.get((i, t), ()))) for i, t in TEXTS], key=repr)
    texts = {r["doc_id"]: r["text"] for r in got.where("doc_id in (0, 1, 7, 8, 9, 14)").collect()}
    assert texts[0] is None and texts[1] == "" and texts[7] == dict(TEXTS)[7]
    assert texts[8].split() == ["other", "end"] and texts[9].split() == ["x"] and texts[14].count("same line " * 12) == 1
    assert lines.dedup(empty).isEmpty()


def test_jaccard_components_by_brute_force(docs, empty):
    sets = [shingles(t) for _, t in TEXTS]
    parent = list(range(len(TEXTS)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(TEXTS):
        least[root(k)] = min((x for x in (least.get(root(k)), i) if x is not None), default=None)
    expected = [(i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(TEXTS)]
    got = collected(ngram_join.join(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(expected, key=repr)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id BETWEEN 21 AND 50").isEmpty()
    assert ngram_join.join(empty).isEmpty()


def test_tree_bounds_lose_nothing():
    sets = [np.unique(np.random.default_rng(k).integers(0, 300, 80).astype(np.uint64)) for k in range(120)]
    sizes, group = np.array([len(s) for s in sets]), np.arange(len(sets))
    points = [ngram_join.point(ngram_join.mix(s)) for s in sets]
    found = {(i, j) for a, b in ngram_join.tree_pairs(points, sizes, group, group, group, 15) for i, j in zip(a, b)}
    true = {(i, j) for i in group for j in group if i != j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 15 * len(np.union1d(sets[i], sets[j]))}
    assert true and true <= found


def test_language_model_scores(docs, empty, spark):
    rows = class_lm.score(docs).collect()
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in TEXTS]
    counts = defaultdict(int)
    for h, (_, t) in zip(held, TEXTS):
        for w in [*words(t), "\n"] if not h else ():
            counts[w] += 1
    total, types = sum(counts.values()), len(counts)
    expected = []
    for h, (i, t) in zip(held, TEXTS):
        tokens = [*words(t), "\n"]
        base = sum(np.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (types + 1))) for w in tokens)
        expected.append((i, h, len(tokens), sum(w in counts for w in tokens), total, round(base, 6)))
    got = [(*tuple(r)[:5], round(r["base_score"], 6)) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert class_lm.score(empty).isEmpty()


def labelled(spark, bad: str, column: str):
    rows, labels = [], []
    for k in range(600):
        flag = k % 4 == 0
        rows.append((k, prose(60) + (f" {bad} " * 3 if flag else ""), "en"))
        labels.append((k, int(flag) if column == "toxic" else int(not flag), int(flag) if column == "toxic" else int(not flag)))
    odd = [(None, prose(9), "x"), (9001, None, "x"), (9002, "", "x"), (5, rows[5][1], "x")]
    docs = spark.createDataFrame([*rows, *odd], "doc_id long, text string, toxic string")
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (7, None, None)], f"doc_id long, {column} int, text int")


def test_toxicity_learns_and_holds_out(spark, empty):
    docs, labels = labelled(spark, "vilest zounds", "toxic")
    got = toxicity.score(docs, labels).toPandas()
    assert len(got) == 604 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert [bool(h) for h in got.held_out] == [i == i and zlib.crc32(str(int(i)).encode()) % 5 == 0 for i in got.doc_id]
    held = got[got.held_out & (got.doc_id < 600)]
    assert ((held.doc_id % 4 == 0) == (held.predicted == 1)).mean() > 0.97
    assert not got[got.doc_id > 9000].predicted.any()
    assert toxicity.score(empty, labels).isEmpty()
    assert set(toxicity.score(docs, labels.where("1 = 0")).toPandas().score) == {0.0}


def test_quality_learns_and_holds_out(spark, empty):
    docs, labels = labelled(spark, "||| !!! ### ZZZ", "quality")
    got = quality.score(docs, labels).toPandas()
    assert len(got) == 604 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out & (got.doc_id < 600)]
    assert len(held) and ((held.doc_id % 4 != 0) == (held.predicted == 1)).mean() > 0.97
    assert quality.score(empty, labels).isEmpty()
    assert set(quality.score(docs, labels.where("1 = 0")).toPandas().score) == {1.0}


def test_pipeline_stages_take_effect(spark, docs, tmp_path):
    docs.sparkSession.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    out = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert not ids & {4, 10, 11, *range(21, 51)} and {0, 1, 2, 3, 5, 6, 7, 8, 9, 13, 14, 51, 52} <= ids


def test_encoder_gives_the_ids_of_whole_texts():
    encode = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    signs = "a Z é É ß ÿ Ÿ İ ı é ' 's 'LL ´ ª µ × ÷ 1 ½ _ - . !! \x00 \x1c \x85   ​ 世 😀 ﬁ Σ </w> <|endoftext|> $$$".split(" ")
    rng = random.Random(3)
    texts = ["".join(rng.choices([*signs, " ", "\t", "\n"], k=rng.randint(0, 14))) for _ in range(3000)] + [None, ""]
    for at in range(0, len(texts), 500):
        batch = texts[at : at + 500]
        for text, data in zip(batch, encode.texts(batch), strict=True):
            ids = encode.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(data, dtype="<u4").tolist() == ids


def test_rare_words_have_a_class_of_their_own(spark, monkeypatch):
    """Two words of one bucket and one count, each known from its own contexts only."""
    monkeypatch.setattr(class_lm, "CLUSTERED", 1.0)
    draw = random.Random(8)
    one, two = "maqua", "naqua"
    assert class_lm.bucket_of(one.encode()) == class_lm.bucket_of(two.encode())
    parts = [(["the", "a", "this"], one, ["runs", "sits"]), (["will", "can", "may"], two, ["it", "them"])]
    texts = []
    for k in range(60):
        before, word, after = parts[k % 2]
        middle = word if k % 6 < 2 else draw.choice(["cat", "dog"] if k % 2 == 0 else ["eat", "see"])
        texts.append(f"{draw.choice(before)} {middle} {draw.choice(after)}")
    asked = [f"the {w} runs" for w in (one, two)] + [f"will {w} it" for w in (one, two)]
    free = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 1]
    frame = prepare(spark).createDataFrame([*zip(free, texts), *zip(held, asked)], "doc_id long, text string")

    def scores():
        return {r["doc_id"]: r["score"] for r in class_lm.score(frame).collect()}

    got = scores()
    fits = [got[i] for i in held[:4]]
    assert fits[0] > fits[1] + 0.1 and fits[3] > fits[2] + 0.1
    monkeypatch.setattr(class_lm, "KNOWN", 3)
    joined = scores()
    assert joined.keys() == got.keys() and all(abs(joined[i] - got[i]) < 1e-9 for i in got)
