"""Manifest, rule ledger and spelling variants against plain versions, with odd rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmill.llm import manifest, rules, variants
from panelmill.llm.common import prepare

random.seed(11)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, n int, pos long, key string, word string, failures int"
WORDS = ["".join(random.choice("abcdeé") for _ in range(random.randint(5, 12))) for _ in range(60)]


def slip(word: str) -> str:
    at = random.randrange(len(word))
    return random.choice([word[:at] + word[at + 1 :], word[:at] + "z" + word[at:], word[:at] + "y" + word[at + 1 :]])


def prose(n: int) -> str:
    return " ".join(slip(w) if random.random() < 0.2 else w for w in random.choices(WORDS, [1 + 200 // (k + 1) for k in range(len(WORDS))], k=n))


LONG = prose(30_000)
TEXTS = [
    (0, None), (1, ""), (2, " \n\t \x0b"), (3, "One two\nthree"), (4, "a|b | | * %%\n" * 30), (5, LONG), (5, prose(7)), (5, prose(7)),
    (6, f"{prose(60)}\n{prose(8)}"), (6, f"{prose(3)}\nÉtrange ÀÉÎÕÜ×÷þÿ"), (None, prose(20)), (None, None), (None, prose(20)),
    (7, "SHOUTING WORDS ARE HERE TO STAY FOR EVER AND EVER AGAIN"), (8, "x x x x x x x x x x x x"), (9, "same line here\n" * 12 + "and an end of it"),
    (10, "1234 5678 90 12 34 56 78 90 12 34 56"), (11, "z" * 200_000), (12, "🙂 " * 40), (13, "a b c d \x1c e"), *[(20 + k, prose(40)) for k in range(60)],
]


@pytest.fixture(scope="module")
def docs(spark):
    sources = [None, "", "a", "é", "b", "b", "b", "b"]
    rows = [(i, t, "en" if k % 3 else None, sources[k % 8], len(t) if t and k % 5 else None, "g", 1, 2, "k", "w", 3) for k, (i, t) in enumerate(TEXTS)]
    return prepare(spark).createDataFrame([*rows, rows[6], rows[6], rows[10]], SCHEMA).repartition(5)


def everything(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_manifest(rows):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

    groups = defaultdict(list)
    for r in rows:
        groups[r.source].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = {s: tree([leaf(r, r.text) for r in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for place, r in enumerate(groups[s]):
            text = r.text
            if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            value, beside = leaf(r, text), []
            for levels, at in ((trees[s], place), (top, k)):
                for level in levels[:-1]:
                    run, i = level[at // 3 * 3 : at // 3 * 3 + 3], at % 3
                    beside += run[:i] + run[i + 1 :]
                    value, at = sha("".join([*run[:i], value, *run[i + 1 :]])), at // 3
            root = top[-1][0]
            out.append((r.doc_id, trees[s][0][place], trees[s][-1][0], root, sha("".join(beside)), value, value == root))
    return out


def test_states_are_those_of_sha256():
    rng = np.random.default_rng(3)
    for children in (1, 2, 3):
        nodes = rng.integers(0, 256, (50, children, 32), dtype=np.uint8)
        parents, before = manifest.above(nodes)
        for row, parent in zip(nodes, parents[:, 0], strict=True):
            assert parent.tobytes().hex() == sha("".join(x.tobytes().hex() for x in row))
        for slot in range(children):
            others = np.concatenate([np.delete(nodes, slot, axis=1), np.zeros((50, 3 - children, 32), np.uint8)], axis=1)
            others[:, :slot] = 0  # what stands left of the slot is in the state
            state = before[:, 0, slot - 1] if slot else np.zeros((50, 32), np.uint8)
            again = manifest.resumed(nodes[:, slot], np.full(50, slot), np.full(50, children), state, others)
            assert (again == parents[:, 0]).all()


def test_manifest(docs):
    got, wanted = everything(manifest.prove(docs)), plain_manifest(docs.collect())
    assert got == sorted(wanted, key=lambda r: tuple((x is not None, x) for x in r))
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 243, 244, 1500])
def test_manifest_of_one_source(spark, n):
    """A source that holds all rows: one chunk, a chunk and a lone node, several levels of chunks."""
    rows = prepare(spark).range(n).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "id AS n_chars", "concat('t\n', id) AS text")
    got = everything(manifest.prove(rows))
    assert got == sorted(plain_manifest(rows.collect()))


def test_manifest_of_many_sources(spark):
    rows = prepare(spark).range(900).selectExpr("id AS doc_id", "concat('s', id % 700) AS source", "'en' AS lang", "id AS n_chars", "'t\n' AS text")
    assert everything(manifest.prove(rows)) == sorted(plain_manifest(rows.collect()))


def test_manifest_frames(docs):
    made = manifest.build(docs)
    sizes = {r["source"]: r["n_docs"] for r in made.sources.collect()}
    assert sizes == {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    assert manifest.fold(made).where("NOT verified").count() == 0  # nothing was changed


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines),
        sum(bool(re.search(r"[A-Za-z\u0080-\U0010ffff]", w)) for w in words), sum(bool(re.search("[A-Z]", w)) and not re.search("[a-z]", w) for w in words),
        sum(a == b for a, b in zip(words, words[1:], strict=False)),
    )


def test_ledger(docs):
    made = rules.ledger(docs)
    texts = Counter((r.doc_id, plain_measures(r.text)) for r in docs.collect())
    assert Counter((r["doc_id"], tuple(r[m] for m in rules.MEASURES)) for r in made.collect()) == texts
    for row in made.collect():
        m = row.asDict()
        failed = {name for name, rule in rules.RULES.items() if eval(rule, {}, m)}
        assert row["failures"] == rules.mask(failed)


def test_base_and_verdict(docs):
    for r in rules.judge(docs).collect():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (r["failures"] == 0)


def test_policies_and_ablations_read_the_ledger_only(docs):
    made = rules.ledger(docs).cache()
    masks = [r["failures"] for r in made.collect()]
    for version, names in rules.POLICIES.items():
        kept = rules.verdicts(made, version).where("kept").count()
        assert kept == sum(m & rules.mask(names) == 0 for m in masks)
    found = {(r["version"], r["rule"]): r for r in rules.ablations(made).collect()}
    assert set(found) == {(v, name) for v, names in rules.POLICIES.items() for name in names}
    for (version, name), r in found.items():
        bit, every = rules.mask([name]), rules.mask(rules.POLICIES[version])
        assert r["n_docs"] == len(masks)
        assert r["n_kept"] == sum(m & every == 0 for m in masks)
        assert r["n_failed"] == sum(m & bit != 0 for m in masks)
        assert r["n_only"] == sum(m & every == bit for m in masks)
        assert r["n_kept_without"] == sum(m & (every & ~bit) == 0 for m in masks)
    with pytest.raises(ValueError):
        rules.mask(["no such rule"])


def plain_words(rows):
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            low = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{r.doc_id}:{low}".encode()) if r.doc_id is not None else 1
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_variants(words):
    out, form = [], {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_variants(docs):
    words = plain_words(docs.collect())
    got = everything(variants.group(docs))
    assert got == sorted(plain_variants(words), key=lambda r: tuple((x is not None, x) for x in r))
    assert sum(r[1] is not None for r in got) > 20


def test_every_kind_of_edit_is_found(spark):
    """All words one edit from words with repeated letters and of every length, and a chain of forms."""
    base = {"a" * 7, "ab" * 4, "abcdefg", "éèêëàâä", "aabbccddee", "abcdefghijk"}
    some = {w[:i] + c + w[i:] for w in base for i in range(len(w) + 1) for c in "aé"}
    some |= {w[:i] + w[i + 1 :] for w in base for i in range(len(w))} | {w[:i] + "q" + w[i + 1 :] for w in base for i in range(len(w))} | base
    words = {w: 2 + len(w) for w in some} | {"wwwwwwwa": 5, "wwwwwwwab": 50, "wwwwwwabx": 3, "wwwwwwwabc": 500, "wwwwwwwabcd": 5000}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    pairs = [tuple(r) for r in variants.pairs(frame).select("word", "other").collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs})
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    forms = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("x", "c")], "word string, form string")
    ends = {r["word"]: r["root"] for r in variants.roots(forms, 1_000_000).collect()}
    assert ends == dict.fromkeys("abcdex", "f")


def test_no_rows(docs):
    none = docs.where("1 = 0")
    for made in (manifest.prove(none), rules.judge(none), rules.ablations(rules.ledger(none)), variants.group(none), variants.group(docs.withColumn("text", F.lit(None).cast("string")))):
        assert made.collect() == []
