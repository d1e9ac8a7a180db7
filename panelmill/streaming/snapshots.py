"""Snapshot folders as a stream: every new folder is one refresh, published once.

The stream brings the names of new files; each of their folders is read whole, by the reader of a
manual run, and handed to the same refresh, in the order of the folders' first files.  The commit of
the table names the snapshot it was made of, so that a batch that Spark repeats after a crash publishes
nothing twice, wherever the crash was.

A snapshot that is rejected, by a gate or because it cannot be read, is logged as a failed run.
With a list of rejected snapshots it is noted there and passed by, so that later ones load; without
one it stops the query.  Other errors always stop it, and the next start tries again.
"""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelmill.plans.gates import GateFailure
from panelmill.plans.refresh import refresh
from panelmill.plans.runlog import RunLog
from panelmill.sources.commits import append_note, read_notes
from panelmill.sources.landing import read_snapshot
from panelmill.sources.versions import VersionedTable

FILES = "path string, modificationTime timestamp, length bigint, content binary"
REJECTED = "snapshot string, loaded string, message string, at_ns bigint"
# What Spark's reader says of a file that isn't the CSV it should be.
UNREADABLE = ("MALFORMED_RECORD", "MALFORMED_CSV", "header does not conform", "CSV header")


def is_rejection(error: Exception) -> bool:
    """Whether an error speaks of the snapshot and not of the cluster: trying again would not help."""
    if isinstance(error, GateFailure):
        return True
    return isinstance(error, (PySparkException, Py4JJavaError)) and any(text in str(error) for text in UNREADABLE)


def rejected_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The rejected snapshots noted at ``path``: (snapshot, loaded, message, at_ns)."""
    return read_notes(spark, path, REJECTED)


def contents(spark: SparkSession, base: str, folders: DataFrame) -> list[tuple[str, str]]:
    """(folder, name of what it holds) of the folders, in the order of their first files.

    The name changes with the names and lengths of the files, so that a folder that gets another file
    is something else to load.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(base)
        .select("path", "modificationTime", "length", F.element_at(F.split("path", "/"), -2).alias("folder"))
    )
    facts = F.struct(F.element_at(F.split("path", "/"), -1).alias("file"), "length")
    held = listed.join(folders.distinct(), "folder", "left_semi").groupBy("folder").agg(
        F.min("modificationTime").alias("landed"), F.sha2(F.to_json(F.sort_array(F.collect_list(facts))), 256).alias("digest")
    )
    return [(r["folder"], f"{r['folder']}#{r['digest']}") for r in held.orderBy("landed", "folder").collect()]


def refresh_stream(
    spark: SparkSession,
    base: str,
    table: VersionedTable,
    log: RunLog,
    codes: DataFrame,
    source: str,
    first: int,
    last: int,
    expected_rows: int | None,
    checkpoint: str,
    rejected: str | None = None,
) -> StreamingQuery:
    """Process all snapshot folders below ``base`` with files that were not processed before, then stop.

    Folders have to be complete when the stream starts; one that gets another file later is
    refreshed again, as a whole.  ``rejected`` is where rejected snapshots are noted and passed by.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(base)
        .select(F.element_at(F.split("path", "/"), -2).alias("folder"))
    )

    def run(batch: DataFrame, _: int) -> None:
        set_aside = set()
        if rejected is not None:
            set_aside = {r["loaded"] for r in rejected_snapshots(spark, rejected).select("loaded").distinct().collect()}
        for folder, loaded in contents(spark, base, batch):
            if loaded in set_aside or table.has_loaded(loaded):
                continue
            try:
                refresh(read_snapshot(spark, base, folder), table, log, codes, source, first, last, expected_rows, loaded=loaded)
            except Exception as error:
                if rejected is None or not is_rejection(error):
                    raise
                said = next(line for line in str(error).splitlines() if isinstance(error, GateFailure) or any(text in line for text in UNREADABLE))
                note = {"snapshot": folder, "loaded": loaded, "message": said, "at_ns": time.time_ns()}
                append_note(spark, rejected, note)

    return (
        files.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
