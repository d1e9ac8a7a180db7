"""Benchmark decontamination by MinHash containment search, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import SHINGLE, small, text_of, words_of
from panelmill.session import stage


def shingles(words: str, make) -> Column:
    """``make`` of every run of five words; of the whole sequence where there are one to four words."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(1))), lambda i: make(F.slice(words, i, SHINGLE)))
    return F.when(n > 0, runs)


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """Rows (doc_id, item_id, n_shingles, n_shared, containment), one per document and item found in it.

    An item is found where a document holds at least ``percent`` percent of the item's distinct five-word
    shingles (A-Z in lower case; items and documents of one to four words have their sequence as one shingle).

    Search: items are partitioned by size, as their sketch depends on it.  The sketch of an item with n shingles is
    the floor(n * (100 - percent) / 100) + 1 + n / 8 of them with the least hashes; a document
    that holds enough of the item misses at most floor(n * (100 - percent) / 100) shingles, hence holds at least
    ``need`` of the sketch.  That is exact whatever the length of the document, where a sketch of the document would drown short
    items.  Documents with enough sketch hits are read again and compared with all shingles, as text.

    Null and empty texts hold nothing and are found nowhere.  Rows that repeat an id and text count once, of documents as of
    items; rows with equal or null ids and different texts are separate documents and separate items, with a result each.
    """
    # An item is its id and its text, as one number.
    given = benchmark.select("item_id", F.xxhash64("item_id", F.lit("id"), text_of()).alias("item"), words_of(text_of()).alias("words")).dropDuplicates(["item"])
    items = given.select("item", F.explode(F.array_distinct(shingles("words", lambda w: F.array_join(w, " ")))).alias("shingle"))
    items = stage(items, "items")
    sizes = items.groupBy("item").agg(F.count("*").alias("n"))
    index = items.withColumn("hash", F.xxhash64(F.split("shingle", " ")))
    ordered = index.groupBy("item").agg(F.array_sort(F.collect_set("hash")).alias("hashes"))
    spare = F.expr(f"CAST(floor(n * {100 - percent} / 100) AS INT)")
    # Size partitions: items whose number of shingles has as many binary digits.
    sketch = ordered.withColumn("n", F.size("hashes")).withColumn("partition", F.floor(F.log2("n")).cast("int"))
    sketch = sketch.withColumn("missing", spare).withColumn("k", F.least(F.col("n"), F.col("missing") + 1 + F.shiftright(F.col("n"), 3)))
    sketch = sketch.select("item", "partition", (F.col("k") - F.col("missing")).alias("need"), F.explode(F.slice("hashes", F.lit(1), F.col("k"))).alias("hash"))
    sketch = stage(sketch, "sketch")

    keyed = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), words_of(text_of()).alias("words"))
    sketched = keyed.select("doc_id", "text_hash", F.explode(shingles("words", lambda w: F.xxhash64(w))).alias("hash"))
    hits = sketched.join(small(sketch), "hash").groupBy("doc_id", "text_hash", "item", "partition", "need")
    candidates = hits.agg(F.count_distinct("hash").alias("hits")).where("hits >= need").select("doc_id", "text_hash", "item")
    candidates = stage(candidates, "candidates")

    # Exact containment, over the documents with candidates only.
    some = candidates.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct()
    some = keyed.join(small(some), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left_semi")
    held = some.select("doc_id", "text_hash", F.explode(F.array_distinct(shingles("words", lambda w: F.array_join(w, " ")))).alias("shingle"))
    wanted = small(items)
    shared = held.join(wanted, "shingle").distinct().groupBy("doc_id", "text_hash", "item").agg(F.count("*").alias("n_shared"))
    c, s = candidates.alias("c"), shared.alias("s")
    same = F.col("c.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("c.text_hash") == F.col("s.text_hash")) & (F.col("c.item") == F.col("s.item"))
    both = s.join(c, same, "left_semi").select("doc_id", "text_hash", "item", "n_shared")
    out = both.join(sizes, "item").where(F.col("n_shared") * 100 >= F.col("n") * percent).join(given.select("item", "item_id"), "item")
    return out.select("doc_id", "text_hash", "item_id", F.col("n").alias("n_shingles"), "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """The documents in which no item is found; all columns and rows else as they are."""
    found = matches(docs, benchmark, percent).select("doc_id", "text_hash").distinct().alias("found")
    # The row travels as one value, so that its columns may have any names.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").alias("id"), F.xxhash64(text_of()).alias("hash"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    return rows.join(small(stage(found, "found")), same, "left_anti").select("doc.*")
