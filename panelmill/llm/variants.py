"""Spelling variants of corpus words: asymmetric q-chunks, one edit apart."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import LOWER, UPPER
from panelmill.session import stage

LETTERS = r"[A-Za-zÀ-ÿ]"
SHORTEST, FEWEST, TIMES = 7, 2, 10
# One run in so many loses a code point.
LOSES = 31


def altered(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Runs of letters of whole texts, in lower case (A-Z only): one row per run, column ``word``.

    A run whose crc32 together with its document's id is a multiple of 31 loses the code point that the
    crc32 names; a null id changes nothing.  Runs that end up shorter than ``shortest`` are left out.
    """
    # A pattern that asks for ``shortest`` letters finds whole runs, as it takes as many as it can.
    runs = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0)))
    low = docs.select("doc_id", runs.alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("low"))
    crc = F.when(F.col("doc_id").isNotNull(), F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "low")))
    low = low.select("low", crc.alias("h"))
    at = "CAST(h % char_length(low) AS INT)"
    less = F.expr(f"concat(left(low, {at}), substring(low, {at} + 2))")
    words = low.select(F.when(F.col("h") % LOSES == 0, less).otherwise(F.col("low")).alias("word"))
    return words.where(F.char_length("word") >= shortest)


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """``(word, n)`` of every word seen ``fewest`` times or more; tasks count before they shuffle."""
    return altered(docs, shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= fewest)


def parts(of: str) -> list[tuple[str, str]]:
    """What is kept of a word of length ``of`` when one quarter is left out: (from its start, from its end).

    The two chunks are the halves ``[0, q)`` and ``[q, of)``.  One edit leaves one of them whole; of the other
    half it leaves one half whole, which makes the key as selective as three quarters of the word.
    """
    q = f"({of} DIV 2)"
    a, b = f"({q} DIV 2)", f"(({of} - {q}) DIV 2)"
    return [("0", f"{of} - {a}"), (a, f"{of} - {q}"), (q, f"{of} - {q} - {b}"), (f"{q} + {b}", "0")]


def keyed(words: DataFrame, of: str) -> DataFrame:
    """The words with one row per part that is kept, ``part`` its number and ``key`` its hash."""
    cells = [
        f"named_struct('part', {k}, 'key', xxhash64({of}, {k}, left(word, {start}), right(word, {end})))"
        for k, (start, end) in enumerate(parts(of))
    ]
    return words.selectExpr("word", "n", "size", f"inline(array({', '.join(cells)}))")


def first_part(c: str, v: str) -> str:
    """SQL for the first part in which two words agree, by which a pair is found once only."""
    tests = [
        f"WHEN left({c}.word, {start}) = left({v}.word, {start}) AND right({c}.word, {end}) = right({v}.word, {end}) THEN {k}"
        for k, (start, end) in enumerate(parts(f"{c}.size"))
    ]
    return f"CASE {' '.join(tests)} END"


def pairs(words: DataFrame) -> DataFrame:
    """Every pair of distinct words one edit apart, once: ``(word, n, other, other_n)``.

    The longer word (of two equally long ones the smaller) contributes its chunks, one row per part that an
    edit may leave whole.  The other word contributes its grams at the same places, for a
    partner of its own length and one of a length more: a kept start lies at the same place in both
    words, a kept end is shifted by the difference of the lengths, which is at most one.  What
    meets on a key is verified.  ``words`` has distinct words of four code points or more;
    the join is a plain equi-join, so that a part that very many words share can be split.
    """
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    chunks = keyed(sized, "size").alias("c")
    grams = sized.selectExpr("word", "n", "size", "explode(array(size, size + 1)) AS partner")
    grams = grams.selectExpr(
        "word",
        "n",
        "size",
        "partner",
        "inline(array("
        + ", ".join(
            f"named_struct('key', xxhash64(partner, {k}, left(word, {start}), right(word, {end})))"
            for k, (start, end) in enumerate(parts("partner"))
        )
        + "))",
    ).alias("v")
    near = (
        "c.key = v.key AND c.size = v.partner AND (c.size > v.size OR c.word < v.word) "
        f"AND levenshtein(c.word, v.word, 1) = 1 AND c.part = {first_part('c', 'v')}"
    )
    return chunks.join(grams, F.expr(near)).selectExpr("c.word", "c.n", "v.word AS other", "v.n AS other_n")


def roots(forms: DataFrame, most: int, times: int = TIMES) -> DataFrame:
    """``(word, root)``: the last word reached from each by following ``(word, form)``.

    A form is ``times`` times as frequent as its word (two at least), so that no chain has more steps than
    ``most``, the largest count, has factors of ``times``; every round doubles the steps covered.
    """
    steps = int(math.log(max(most, 1), times)) + 1
    now = stage(forms.selectExpr("word", "form AS root"), "forms")
    for _ in range(math.ceil(math.log2(steps))):
        further = now.selectExpr("word AS root", "root AS further")
        now = stage(now.join(further, "root", "left").selectExpr("word", "coalesce(further, root) AS root"), "roots")
    return now


def group(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST, times: int = TIMES) -> DataFrame:
    """One row per word of the corpus with the form and the root of its spelling.

    Columns: word, form (its near word of largest count, ties by code point order, where that count is
    ``times`` its own; else null), root (reached by following forms; the word itself without
    one), n, n_near (near words; 0 for none), form_n.  Null and empty texts have no words; repeated rows
    and ids count each time; other columns are ignored; no rows give no rows.
    """
    words = stage(vocabulary(docs, shortest, fewest), "words")
    both = pairs(words).selectExpr(
        "inline(array(struct(word, other, other_n), struct(other AS word, word AS other, n AS other_n)))"
    )
    # The least struct has the largest count and then the smallest word; Spark compares text by bytes.
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less")).alias("form_n"),
    )
    found = stage(found, "forms")
    most = words.agg(F.max("n")).first()[0] or 1
    ends = roots(found.where("form IS NOT NULL"), most, times)
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
