"""Deletion of repeated runs of lines, by prefix doubling; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import WORD, text_of, words_of
from panelmill.session import stage


def doubled(names: str, half: int):
    """Names of blocks of twice ``half`` lines, from the names of their halves."""
    return lambda i: F.xxhash64(F.get(names, i), F.get(names, i + half))


def positions(offset: int = 0) -> Column:
    """0 to the last place at which a block of 1 + ``offset`` lines begins, none if there is none."""
    last = F.size("ids") - 1 - offset
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def named_runs(docs: DataFrame, least: int) -> DataFrame:
    """Per document the shortest runs of at least ``least`` words: (start, length, name, check).

    Lines are numbers (hashes of their words).  Prefix doubling names the blocks of 1, 2, 4, ...
    lines at every position: the name of 2k lines is that of the pair of names of k lines at a position
    and k further on.  A run of any length is named by the two blocks of the largest power of two
    that overlap in it, so that equal runs have equal names.  A run of lines with at least
    one word each that has just reached ``least`` words holds at most ``least`` lines, which bounds the doubling.
    """
    source = docs.select("doc_id", text_of().alias("text")).select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("rows"))
    parsed = source.select("doc_id", "text_hash", F.transform("rows", lambda r: words_of(r)).alias("words"))
    numbered = parsed.select("doc_id", "text_hash", F.filter("words", lambda w: F.size(w) > 0).alias("words"))
    n = numbered.select(
        "doc_id",
        "text_hash",
        F.transform("words", lambda w: F.xxhash64(w)).alias("ids"),
        F.transform("words", lambda w: F.hash(w)).alias("checks"),
        F.transform("words", lambda w: F.size(w)).alias("sizes"),
    )
    n = n.withColumn("upto", running("sizes")).withColumn("n0", F.col("ids"))
    levels = max(1, (least - 1).bit_length()) + 1
    for k in range(1, levels):
        n = n.withColumn(f"n{k}", F.transform(positions(2**k - 1), doubled(f"n{k - 1}", 2 ** (k - 1))))

    def named(start: Column, length: Column) -> Column:
        name = F
        for k in reversed(range(levels)):
            name = name.when(length >= 2**k, F.xxhash64(F.get(f"n{k}", start), F.get(f"n{k}", start + length - 2**k), length))
        return F.struct(start.alias("start"), length.alias("length"), name.alias("name"), F.hash(F.slice("checks", start + 1, length)).alias("check"))

    # Shortest run to the right of each position, and to the left of each end.
    def right(i: Column) -> Column:
        ahead = F.filter(F.slice("upto", i + 2, F.lit(least)), lambda u: u - F.get("upto", i) < least)
        return F.size(ahead) + 1

    def left(i: Column) -> Column:
        first = F.greatest(i + 1 - least, F.lit(0))
        behind = F.filter(F.slice("upto", first + 1, i + 1 - first), lambda u: F.get("upto", i + 1) - u < least)
        return F.size(behind) + 1

    n = n.withColumn("rights", F.transform(positions(), right)).withColumn("lefts", F.transform(positions(), left))
    count = F.size("ids")
    starts = F.filter(F.transform(positions(), lambda i: F.struct(i.alias("start"), F.get("rights", i).alias("length"))), lambda r: r["start"] + r["length"] <= count)
    ends = F.filter(F.transform(positions(), lambda i: F.struct((i + 1 - F.get("lefts", i)).alias("start"), F.get("lefts", i).alias("length"))), lambda r: r["start"] >= 0)
    n = n.withColumn("runs", F.array_distinct(F.concat(starts, ends)))
    n = n.select("doc_id", "text_hash", F.explode(F.transform("runs", lambda r: named(r["start"], r["length"]))).alias("run"))
    return n.select("doc_id", "text_hash", "run.*")


def running(sizes: str) -> Column:
    """0 and the running sums of an array, in two steps: of blocks of 64, and within them."""
    n = F.size(sizes)
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / 64).cast("int"))
    add = lambda a, x: a + x
    sums = F.transform(blocks, lambda b: F.aggregate(F.slice(sizes, b * 64 + 1, 64), F.lit(0), add))
    bases = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    inner = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.get(bases, F.floor(i / 64).cast("int")) + F.aggregate(F.slice(sizes, F.floor(i / 64).cast("int") * 64 + 1, i % 64), F.lit(0), add),
    )
    return inner


def dedup(docs: DataFrame, least: int = 20) -> DataFrame:
    """All columns of the documents, their text without later copies of repeated line runs.

    Lines end at line feeds; two lines are equal if their words are (A-Z in lower case); lines without words belong to no run and
    stay.  A run of consecutive lines (blank ones skipped) with at least ``least`` words that has an earlier copy, in the order of
    doc_id (null last), text hash and line, is deleted; the earliest copy of every line stays.  A document may lose all its lines;
    its text is then empty, and the row stays.

    The runs with equal names are an interval of the suffix array with that longest common prefix, whose first
    entry is the earliest copy.  It is enough to look at the shortest runs that reach ``least`` words
    rightwards from a line or leftwards from one: each maximal repeated run is the union of such runs, and all of them are
    repeated where it is.  So the doubling ends at blocks of ``least`` lines, and the order within an interval isn't needed.

    Null texts stay null and empty ones empty.  Rows that repeat id and text are one document and
    get the same result.  Added columns, in place of any of these names: n_lines (with words), n_deleted.
    """
    runs = stage(named_runs(docs, least), "runs")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "start")
    first = runs.groupBy("length", "name", "check").agg(F.min(place).alias("first"), F.max(place).alias("final"))
    first = first.where("first != final").select("length", "name", "check", "first")
    later = runs.join(first, ["length", "name", "check"]).where(place != F.col("first"))
    gone = later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "length")).alias("gone"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone")

    # The row travels as one value, so that its columns may have any names.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", text_of().alias("text"))
    both = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_hash")), "left")
    both = both.withColumn("rows", F.split("text", "\n"))
    both = both.withColumn("full", F.filter(F.sequence(F.lit(0), F.size("rows") - 1), lambda i: F.get("rows", i).rlike(WORD)))
    lost = F.flatten(F.transform("gone", lambda g: F.sequence(g["start"], g["start"] + g["length"] - 1)))
    both = both.withColumn("lost", F.array_distinct(F.transform(lost, lambda i: F.get("full", i))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("rows") - 1), F.col("lost"))
    rest = F.array_join(F.transform(kept, lambda i: F.get("rows", i)), "\n")
    emptied = F.size("lost") == F.size("full")
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).when(emptied, F.lit("")).otherwise(rest)
    added = {"n_lines": F.size("full"), "n_deleted": F.when(F.col("gone").isNotNull(), F.size("lost")).otherwise(0)}
    columns = [text.alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns if c not in added]
    return both.select(*columns, *[v.alias(c) for c, v in added.items()])
