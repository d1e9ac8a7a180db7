"""Paged JSON payloads to a panel: flatten, choose sources, assemble the grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType

from panelmill import fixed
from panelmill.operators.coverage import grid
from panelmill.session import stage

# What can be wrong with a page or one of its rows.
MALFORMED_PAGE, MALFORMED_ROW = "malformed page", "malformed row"
BAD_PERIOD, BAD_VALUE = "unreadable period", "unreadable value"
# Less than any page.
BEFORE_PAGES = str(-(2**63) - 1)
# What is read of a row, by one cast for a whole page; it is NULL for what is no object.
ROW = "struct<indicator: struct<id: string>, countryiso3code: string, date: string, value: variant>"


def entries(pages: DataFrame) -> DataFrame:
    """One row per row of every page: page, position, indicator, entity, year, value, problem.

    ``pages`` has (page, body) with ``[meta, rows]`` bodies, each parsed once.  A page without rows, which is
    no problem, and one that isn't whole JSON or whose second element is no list have one row
    without a position.  A row needs to be an object, with a period that is a whole number and a
    value that is a number of up to 23 digits before the point; a missing value is no problem.
    """
    parsed = pages.select("page", F.try_parse_json("body").alias("json"), F.col("body").isNotNull().alias("given"))
    rows = parsed.select("page", "json", "given", F.try_variant_get("json", "$[1]", f"array<{ROW}>").alias("rows"))
    # Looked at again only where there are no rows.
    second = F.try_variant_get("json", "$[1]", "variant")
    no_list = F.col("rows").isNull() & second.isNotNull() & ~F.is_variant_null(second)
    broken = F.col("given") & (F.col("json").isNull() | no_list)
    found = rows.select("page", broken.alias("broken"), F.posexplode_outer("rows").alias("position", "row"))
    read = found.select(
        "page",
        "position",
        F.col("row.indicator.id").alias("indicator"),
        F.col("row.countryiso3code").alias("entity"),
        F.col("row.date").alias("_date"),
        F.col("row.date").try_cast("int").alias("year"),
        (F.col("row.value").isNotNull() & ~F.is_variant_null("row.value")).alias("_valued"),
        F.try_variant_get("row.value", "$", fixed.OFFICIAL_DECIMAL).alias("value"),
        "broken",
        (F.col("position").isNotNull() & F.col("row").isNull()).alias("_odd"),
    )
    used = (F.coalesce("entity", F.lit("")) != "") & F.col("_valued")
    undated = F.col("year").isNull() & (F.col("_date").isNotNull() | used)
    problem = (
        F.when(F.col("broken"), MALFORMED_PAGE)
        .when(F.col("_odd"), MALFORMED_ROW)
        .when(undated, BAD_PERIOD)
        .when(used & F.col("value").isNull(), BAD_VALUE)
    )
    return read.select("page", "position", "indicator", "entity", "year", "value", problem.alias("problem"))


def page_order(kind: DataType) -> Column:
    """Page and position, a missing page first; as one number for whole pages, so that the aggregate hashes instead of sorting."""
    if not isinstance(kind, (IntegerType, LongType)):
        return F.struct("page", "position")
    page = F.coalesce(F.col("page").cast("decimal(20,0)"), F.lit(BEFORE_PAGES).cast("decimal(20,0)"))
    return page * F.lit(2**31).cast("decimal(10,0)") + F.col("position")


def cells(rows: DataFrame) -> DataFrame:
    """(indicator, entity, year, value) of the rows of :func:`entries` without a problem.

    Rows without an entity or a value are left out; of several values for a cell the last one wins,
    by page and position.
    """
    usable = rows.where("problem IS NULL AND coalesce(entity, '') <> '' AND value IS NOT NULL")
    return usable.groupBy("indicator", "entity", "year").agg(
        F.max_by("value", page_order(rows.schema["page"].dataType)).alias("value")
    )


def flatten_pages(pages: DataFrame) -> DataFrame:
    """The cells of the pages; the first problem met ends the job, so that nothing is lost unseen."""
    found = F.concat_ws(" ", "problem", F.lit("on page"), "page", F.lit("at"), "position")
    sound = F.when(F.col("problem").isNull(), True).otherwise(F.raise_error(found).cast("boolean"))
    return cells(entries(pages).where(sound))


def split_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells of the pages, and what was rejected as (page, position, problem).

    The pages are parsed once, into a staged copy that both frames read.
    """
    rows = stage(entries(pages), "entries")
    return cells(rows), rows.where("problem IS NOT NULL").select("page", "position", "problem")


def page_problems(pages: DataFrame) -> DataFrame:
    """One row: pages, malformed_pages, bad_periods (rows whose date is no year)."""
    return entries(pages).agg(
        F.count_if(F.coalesce("position", F.lit(0)) == 0).alias("pages"),
        F.count_if(F.col("problem") == MALFORMED_PAGE).alias("malformed_pages"),
        F.count_if(F.col("problem") == BAD_PERIOD).alias("bad_periods"),
    )


def require_pages(pages: DataFrame) -> DataFrame:
    """The pages, or ValueError with the number of each problem if there is any."""
    found = entries(pages).where("problem IS NOT NULL").groupBy("problem").count().orderBy("problem").collect()
    if found:
        raise ValueError(", ".join(f"{r['problem']}: {r['count']}" for r in found))
    return pages


def first_nonempty_source(long_df: DataFrame, priority: DataFrame) -> DataFrame:
    """Rows of the first source code per indicator that has any value.

    ``priority`` has (indicator, code, rank), a hand-written table.  The winners are no more rows
    than that table has indicators, so they may be broadcast and the values are not shuffled by
    their few distinct indicators.
    """
    having = long_df.where("value IS NOT NULL").groupBy("indicator", "code").agg(F.count("*").alias("observations"))
    ranked = having.join(priority, ["indicator", "code"])
    chosen = ranked.groupBy("indicator").agg(F.min_by("code", "rank").alias("code"))
    return long_df.join(F.broadcast(chosen), ["indicator", "code"])


def assemble_panel(
    long_df: DataFrame, entities: DataFrame, info: DataFrame, key: str, first: int, last: int, indicators: list[str]
) -> DataFrame:
    """One row per entity and period of the grid, indicators as columns, gaps NULL.

    Entities without an entry in ``info`` are named by their code and have empty attributes.
    """
    wide = long_df.groupBy(F.col("entity").alias(key), "year").pivot("indicator", indicators).agg(F.max("value"))
    cells = grid(entities.select(key), first, last).join(wide, [key, "year"], "left")
    named = cells.join(info, key, "left")
    return named.select(
        F.coalesce("country_name", key).alias("country_name"),
        key,
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("region", "income_group")],
        "year",
        *indicators,
    )
