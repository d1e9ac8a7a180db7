"""Write semantics on keyed tables, as frames: insert-if-absent, upsert, change-only update.

Keys are unique in the target (and, where said, in the source), so no join here meets a hot key.
The result is a new frame; :mod:`panelmill.sources.versions` publishes it without touching the
files that are being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.numeric import round_to_bigint
from panelmill.functions.text import any_of, as_decimal, as_integer, as_utc, distinct_from
from panelmill.operators.skew import same


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus those source rows whose key it lacks; present rows win, also among the source.

    Running it again with the same source changes nothing.
    """
    order = [F.xxhash64(*source.columns)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = source.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return target.unionByName(first.join(target.select(*keys), keys, "left_anti"))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert new keys; replace ``columns`` of present keys by the source, NULL included.

    Other columns of a present row keep the target's value.  Keys must be unique in the source.
    One full join: both sides are read and shuffled once.
    """
    left = target.withColumn("_old", F.lit(True)).alias("t")
    right = source.withColumn("_new", F.lit(True)).alias("s")
    joined = left.join(right, same([(F.col(f"t.{k}"), F.col(f"s.{k}")) for k in keys]), "full")

    def value(c: str):
        take_new = F.col("s._new").isNotNull()
        if c in source.columns and (c in columns or c in keys):
            return F.when(take_new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        if c in source.columns:
            return F.when(F.col("t._old").isNotNull(), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        return F.col(f"t.{c}")

    return joined.select(*[value(c).alias(c) for c in target.columns])


def upsert_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert of whole rows: all source rows plus the target rows whose key is not in the source."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def update_changed(target: DataFrame, fixes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Set columns to their non-NULL fix and mark in ``changed`` the rows that really differ.

    ``fixes`` has unique keys; unfixed rows and equal values stay unmarked, so a second run marks
    none.
    """
    types = dict(target.dtypes)
    right = fixes.select(*keys, *[F.col(c).cast(types[c]).alias(f"_fix_{c}") for c in columns])
    joined = target.join(right, keys, "left")
    changed = any_of(
        [F.col(f"_fix_{c}").isNotNull() & distinct_from(f"_fix_{c}", c) for c in columns]
    )
    return (
        joined.withColumn("changed", changed)
        .withColumns({c: F.coalesce(f"_fix_{c}", c) for c in columns})
        .drop(*[f"_fix_{c}" for c in columns])
    )


PERIOD = ["valid_from", "valid_to"]


def track_changes(history: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], at: Column) -> DataFrame:
    """A history of a keyed table after a batch: one row per key and state, ``valid_from`` to ``valid_to``.

    The open state of a key, the one without an end, is closed ``at`` that time if a column of the batch
    differs from it (NULL is a value), and a new one begins; unknown keys begin; states that are equal
    keep their times, so that the same batch again changes nothing.  Keys are unique in the
    batch.  Open states and batch meet in one full join; closed ones pass by.
    """
    state = [*keys, *columns]
    now = history.where("valid_to IS NULL").select(F.struct(*state, "valid_from").alias("old"), *[F.col(k).alias(f"_old_{k}") for k in keys])
    new = batch.select(F.struct(*state).alias("new"), *[F.col(k).alias(f"_new_{k}") for k in keys])
    met = now.join(new, same([(F.col(f"_old_{k}"), F.col(f"_new_{k}")) for k in keys]), "full")
    differs = any_of([distinct_from(f"old.{c}", f"new.{c}") for c in columns])
    begins = F.col("new").isNotNull() & (F.col("old").isNull() | differs)
    at, never = at.cast("timestamp"), F.lit(None).cast("timestamp")

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in state], start.alias("valid_from"), end.alias("valid_to"))

    kept = F.when(F.col("old").isNotNull(), row("old", F.col("old.valid_from"), F.when(begins, at).otherwise(never)))
    added = F.when(begins, row("new", at, never))
    rows = met.select(F.explode(F.array(kept, added)).alias("row")).where("row IS NOT NULL").select("row.*")
    return history.where("valid_to IS NOT NULL").select(*state, *PERIOD).unionByName(rows)


def begin_history(batch: DataFrame, keys: list[str], columns: list[str], at: Column) -> DataFrame:
    """The history of a table's first batch."""
    start = at.cast("timestamp").alias("valid_from")
    return batch.select(*keys, *columns, start, F.lit(None).cast("timestamp").alias("valid_to"))


def cast_panel(staging: DataFrame) -> DataFrame:
    """Typed panel from staged text; run the gates first, what cannot be cast becomes NULL."""
    decimals = {c: as_decimal(c) for c in fixed.INDICATORS}
    return staging.select(
        "country_name",
        "country_code",
        "region",
        "income_group",
        as_integer("year").alias("year"),
        *[
            (round_to_bigint(v) if c == "population" else v).alias(c)
            for c, v in decimals.items()
        ],
        "source_file",
        as_utc("ingested_at").alias("ingested_at"),
    )


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows with different multiplicity in the two frames, as (row columns…, n_a, n_b).

    Counted by one aggregation over both frames: nothing is expanded back into repeated rows.
    """
    columns = a.columns
    marked = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        b.select(*columns).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    )
    counted = marked.groupBy(*columns).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b"))
    return counted.where("n_a <> n_b")


def tables_equal(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same rows equally often."""
    return multiset_difference(a, b).isEmpty()
