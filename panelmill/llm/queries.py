"""Registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from panelmill.llm import class_lm, contamination, lines, manifest, ngram_join, packing, quality, rules, templates, token_counts, toxicity, variants, vectors
from panelmill.llm.common import table

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = f"regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+')"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared", "containment")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_deleted")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.prove(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures", "base_failed", "kept")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_embedding_near_dedup,
        op3_toxicity,
        op4_decontamination,
        op5_line_dedup,
        op6_ngram_jaccard_join,
        op7_lm_scoring,
        op8_best_fit_packing,
        op9_quality,
        op10_token_counts,
        op11_merkle_manifest,
        op12_quality_rules,
        op13_spelling_variants,
    )
}

# Distinct shingles of a relation (id, text) as (id, shingle).
SHINGLES = """
SELECT DISTINCT {id} AS id, array_to_string(w[i:i + 4], ' ') AS shingle
FROM (SELECT {id}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
      FROM (SELECT {id}, {words} AS w FROM {table}) WHERE len(w) > 0)
"""
REACH = """
reach AS (SELECT a AS node, a AS other FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
"""

# The CRC-32 of each four bits.
CRC_STEPS = [reduce(lambda c, _: c >> 1 ^ 0xEDB88320 * (c & 1), range(4), x) for x in range(16)]


def crc(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes, the lower half of each byte first."""
    nibbles = (
        f"flatten([[instr('123456789ABCDEF', hex(encode({text}))[2 * i]), instr('123456789ABCDEF', hex(encode({text}))[2 * i - 1])] "
        f"FOR i IN range(1, strlen({text}) + 1)])"
    )
    step = f"xor(({CRC_STEPS}::BIGINT[])[(xor(c, x) & 15) + 1], c >> 4)"
    return f"xor(list_reduce(list_prepend(4294967295, {nibbles}::BIGINT[]), lambda c, x: {step}), 4294967295)"


def leaf(text: str) -> str:
    values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


# Words that hold what a pattern finds; all of a text's words; one value per adjacent pair.
PLAIN_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << n} ELSE 0 END" for n, rule in enumerate(rules.RULES.values()))

CHECKS = {
    "op2_embedding_near_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
       AND len([x FOR x IN e IF x <> 0]) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
          WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
{REACH}
SELECT v.vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, v.vec_id) AS component_id,
       coalesce(component_id, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = v.vec_id LEFT JOIN least ON least.node = v.vec_id
""",
    "op4_decontamination": f"""
WITH d AS ({SHINGLES.format(id="doc_id", words=WORDS, table="documents")}),
items AS (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS ({SHINGLES.format(id="item", words=WORDS, table="items")}),
s AS (SELECT id, count(*) AS n FROM q GROUP BY id)
SELECT d.id AS doc_id, i.item_id, s.n AS n_shingles, count(*) AS n_shared, count(*) / s.n::DOUBLE AS containment
FROM d JOIN q ON d.shingle = q.shingle JOIN s ON s.id = q.id JOIN items i ON i.item = q.id
GROUP BY d.id, q.id, i.item_id, s.n HAVING count(*) * 100 >= 75 * s.n
""",
    "op5_line_dedup": f"""
WITH l AS (
  SELECT doc_id, pos, line, {WORDS.replace("coalesce(text, '')", "line")} AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k,
             sum(len(w)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l WHERE len(w) > 0),
runs AS (
  SELECT a.doc_id, a.k AS s, b.k AS e, list(c.w ORDER BY c.k) AS content
  FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + 19
  JOIN f c ON c.doc_id = a.doc_id AND c.k BETWEEN a.k AND b.k
  WHERE b.upto - a.upto + len(a.w) >= 20
    AND (b.upto - a.upto + len(a.w) - len(b.w) < 20 OR b.upto - a.upto < 20)
  GROUP BY a.doc_id, a.k, b.k),
ranked AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS copy FROM runs),
gone AS (SELECT DISTINCT f.doc_id, f.pos FROM ranked r JOIN f ON f.doc_id = r.doc_id AND f.k BETWEEN r.s AND r.e WHERE r.copy > 1),
marked AS (SELECT l.*, gone.pos IS NOT NULL AS deleted FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos)
SELECT d.doc_id,
       CASE WHEN n_deleted = 0 THEN d.text WHEN n_deleted = n_lines THEN '' ELSE kept END AS text,
       n_lines::INT AS n_lines, n_deleted::INT AS n_deleted
FROM documents d JOIN (
  SELECT doc_id, count(*) FILTER (len(w) > 0) AS n_lines, count(*) FILTER (deleted) AS n_deleted,
         string_agg(line, chr(10) ORDER BY pos) FILTER (NOT deleted) AS kept
  FROM marked GROUP BY doc_id) m ON m.doc_id = d.doc_id
""",
    "op6_ngram_jaccard_join": f"""
WITH RECURSIVE s AS ({SHINGLES.format(id="doc_id", words=WORDS, table="documents")}),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
pairs AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.id <> y.id GROUP BY x.id, y.id),
links AS (SELECT a, b FROM pairs JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
{REACH}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.id = d.doc_id LEFT JOIN least ON least.node = d.doc_id
""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT *, {leaf("text")} AS leaf, CASE WHEN doc_id IS NOT NULL AND {crc("coalesce(doc_id::VARCHAR, '')")} % 2 = 0
         THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS changed FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
low AS (
  SELECT source, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM o GROUP BY source
  UNION ALL
  SELECT source, level + 1, [sha256(array_to_string(nodes[i:i + 2], '')) FOR i IN range(1, len(nodes) + 1, 3)]
  FROM low WHERE len(nodes) > 1),
s AS (SELECT source, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM low WHERE len(nodes) = 1),
high AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM s
  UNION ALL
  SELECT level + 1, [sha256(array_to_string(nodes[i:i + 2], '')) FOR i IN range(1, len(nodes) + 1, 3)] FROM high WHERE len(nodes) > 1),
every AS (SELECT source, level, nodes FROM low WHERE len(nodes) > 1
          UNION ALL SELECT s.source, s.height + high.level, high.nodes FROM s, high WHERE len(high.nodes) > 1),
way AS (
  SELECT o.source, o.doc_id, o.leaf, o.pos AS mark, 0 AS level, CASE WHEN s.height = 0 THEN s.pos ELSE o.pos END AS pos,
         s.height, s.pos AS place, o.changed AS folded, '' AS beside
  FROM o JOIN s ON s.source IS NOT DISTINCT FROM o.source
  UNION ALL
  SELECT w.source, w.doc_id, w.leaf, w.mark, w.level + 1, CASE WHEN w.level + 1 = w.height THEN w.place ELSE w.pos // 3 END, w.height, w.place,
         sha256(array_to_string([CASE WHEN i = w.pos + 1 THEN w.folded ELSE e.nodes[i] END
                                 FOR i IN range(w.pos // 3 * 3 + 1, least(w.pos // 3 * 3 + 3, len(e.nodes)) + 1)], '')),
         w.beside || array_to_string([CASE WHEN i = w.pos + 1 THEN '' ELSE e.nodes[i] END
                                      FOR i IN range(w.pos // 3 * 3 + 1, least(w.pos // 3 * 3 + 3, len(e.nodes)) + 1)], '')
  FROM way w JOIN every e ON e.source IS NOT DISTINCT FROM w.source AND e.level = w.level),
ends AS (SELECT *, row_number() OVER (PARTITION BY source, mark ORDER BY level DESC) AS last FROM way)
SELECT e.doc_id, e.leaf, s.subroot, r.root, sha256(e.beside) AS proof_sha256, e.folded AS folded_root, e.folded = r.root AS verified
FROM ends e JOIN s ON s.source IS NOT DISTINCT FROM e.source, (SELECT nodes[1] AS root FROM high WHERE len(nodes) = 1) r
WHERE e.last = 1
""",
    "op12_quality_rules": f"""
WITH w AS (SELECT row_number() OVER () AS id, doc_id, text, {PLAIN_WORDS} AS w FROM documents),
windows AS (
  SELECT id, w[i:i + 4] AS five, i FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
again AS (SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, five) AS n FROM windows) WHERE n > 1),
covered AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY id),
lines AS (
  SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY id),
m AS (
  SELECT w.id, doc_id, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
         (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g'))) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         len([x FOR x IN w IF regexp_matches(x, '[A-Za-z\\x{{80}}-\\x{{10ffff}}]')]) AS n_lettered,
         len([x FOR x IN w IF regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')]) AS n_shouted,
         len([i FOR i IN range(1, len(w)) IF w[i] = w[i + 1]]) AS n_echoes
  FROM w LEFT JOIN lines ON lines.id = w.id LEFT JOIN covered ON covered.id = w.id),
ledger AS (SELECT *, ({BITS})::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures, failures & {rules.mask(rules.BASE)} <> 0 AS base_failed,
       failures & {rules.mask(rules.POLICIES[3])} = 0 AS kept
FROM ledger
""",
    "op13_spelling_variants": f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 7),
hashed AS (
  SELECT doc_id, low, n, CASE WHEN doc_id IS NOT NULL THEN {crc("(coalesce(doc_id, 0)::VARCHAR || ':' || low)")} END AS h
  FROM (SELECT doc_id, low, count(*) AS n FROM runs GROUP BY doc_id, low)),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN low[:h % length(low)] || low[h % length(low) + 2:] ELSE low END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (m = top) AS other
         FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
          FROM words LEFT JOIN best ON best.word = words.word),
follow AS (SELECT word, word AS root, 0 AS step FROM forms
           UNION ALL SELECT follow.word, form, step + 1 FROM follow JOIN forms ON forms.word = follow.root WHERE form IS NOT NULL),
ends AS (SELECT word, root FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY step DESC) AS k FROM follow) WHERE k = 1)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN ends ON ends.word = forms.word
""",
}
