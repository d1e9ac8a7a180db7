"""Landing of text records: CSV snapshots, record ids, schema contract, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelmill import fixed
from panelmill.operators.retention import list_files, parse_stamps
from panelmill.session import stage


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_text_landing(
    spark: SparkSession, path: str, columns: list[str] = tuple(fixed.SOURCE_COLUMNS)
) -> DataFrame:
    """CSV as text columns in fixed order: header checked, a malformed row aborts.

    Only an empty field without quotes is NULL; a quoted one is empty text.  For that the NULL mark
    must be something no text can hold, else the reader turns both into NULL.
    """
    return (
        spark.read.schema(text_schema(list(columns)))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("nullValue", "\u0000")
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_text(df: DataFrame, path: str) -> None:
    """CSV with a header, outer spaces kept; NULL is written as nothing, empty text as quotes."""
    df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def with_record_id(df: DataFrame, key: Column | None = None, name: str = "raw_record_id") -> DataFrame:
    """Add a unique record id and the load time.

    With a unique source ``key`` that is the id.  Without one, ids are dense from 1: the rows are
    staged with their place within the task that wrote them, tasks are counted, and every row's
    place is moved on by the rows of earlier tasks, one number per task.  No sort of the rows, and no task
    sees more than its own.  The ids are those of the staged copy, so that a lost executor or a
    second read changes none.
    """
    if key is not None:
        return df.select(key.cast("bigint").alias(name), "*", F.current_timestamp().alias("pipeline_loaded_at"))
    # The upper bits of this number are the task's, the lower 33 the place within it.
    placed = stage(df.withColumn("_mark", F.monotonically_increasing_id()), "landed")
    task, place = F.shiftright("_mark", 33), F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_task": task, "_place": place})
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_task").agg(F.count("*").alias("_rows"))
    starts = counts.select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    identifier = F.col("_start") + F.col("_place") + 1
    numbered = placed.join(starts, "_task").select(identifier.alias(name), *df.columns)
    return numbered.withColumn("pipeline_loaded_at", F.current_timestamp())


def latest_stamp(
    listing: DataFrame,
    pattern: str = fixed.SNAPSHOT_NAME,
    time_format: str = fixed.SNAPSHOT_FORMAT,
    name: str = "name",
) -> DataFrame:
    """One row: the name with the latest time in it."""
    return parse_stamps(listing, pattern, time_format, name).agg(F.max_by(name, F.struct("stamp", name)).alias("latest"))


def read_snapshot(spark: SparkSession, base: str, stamp: str | None = None) -> DataFrame:
    """Text records of one snapshot folder: the given one, or the latest below ``base``.

    A missing folder or an empty base fails here, before any run is logged.
    """
    if stamp is None:
        folders = list_files(spark, base, "*.csv").select("folder").distinct()
        stamp = latest_stamp(folders, name="folder").first()["latest"]
        if stamp is None:
            raise FileNotFoundError(f"no snapshot folder below {base}")
    return read_text_landing(spark, f"{base.rstrip('/')}/{stamp}")


def check_schema(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Differences between the columns of a frame and the expected names, order and types."""
    actual = dict(df.dtypes)
    problems = [f"missing column {c}" for c in expected if c not in actual]
    problems += [f"unexpected column {c}" for c in actual if c not in expected]
    problems += [
        f"column {c} is {actual[c]}, expected {kind}"
        for c, kind in expected.items()
        if c in actual and actual[c] != kind
    ]
    if not problems and list(actual) != list(expected):
        problems.append("columns are in another order")
    return problems


def types_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the type names of the columns, from the schema: no row of the frame is read."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    return df.sparkSession.range(1).select(*[F.lit(kind).alias(f"{c}_type") for c, kind in kinds.items()])


def row_json(df: DataFrame) -> Column:
    """A row as JSON text with all fields, NULL ones too."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: number of rows and an order-independent hash over all values."""
    hashed = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(hashed), F.lit(0)).alias("hash"))
