"""Validate-then-upsert refresh of the typed panel, all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelmill import fixed
from panelmill.operators.dedup import dup_keys
from panelmill.operators.keyed import cast_panel, upsert_rows
from panelmill.plans.gates import GateFailure, key_counts, observed, require_counts
from panelmill.plans.runlog import RunLog
from panelmill.session import stage
from panelmill.sources.versions import Conflict, Version, VersionedTable

KEYS = ["country_code", "year"]
ATTEMPTS = 5


def upsert_panel(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Target after inserting or replacing the staged rows by key; nothing is deleted.

    Whole rows are replaced: a NULL in the staged row overwrites.  A key twice in the batch raises
    GateFailure, as it has no one right row.
    """
    typed = cast_panel(staging)
    if not dup_keys(typed, KEYS).isEmpty():
        raise GateFailure(fixed.MESSAGE_DUPLICATE)
    return upsert_rows(target, typed, KEYS)


def write_upsert(table: VersionedTable, typed: DataFrame, periods: list) -> Version:
    """Write (not publish) the table after an upsert of typed rows with unique keys.

    In a partitioned table only the periods of the batch are read and rewritten: the period is
    part of the key, so no other partition can change.
    """
    base = table.current()
    if base is None:
        return table.write(typed)
    if table.partition is None:
        return table.write(upsert_rows(table.read(base), typed, KEYS), base)
    old = table.in_partitions(table.read(base), periods)
    return table.write(upsert_rows(old, typed, KEYS), base, keep=True)


def merge(table: VersionedTable, typed: DataFrame, periods: list, run_id: str, loaded: str | None, attempts: int) -> Version:
    """Publish the upsert; where another writer came first, merge into what that one published.

    What is ``loaded`` is looked for before every attempt, so that a repeated batch publishes nothing.
    """
    for attempt in range(attempts):
        if loaded is not None and table.has_loaded(loaded):
            return table.current()
        version = write_upsert(table, typed, periods)
        try:
            table.publish(version, run_id, loaded)
        except Conflict:
            if attempt + 1 == attempts:
                raise
        else:
            return version
    raise ValueError("at least one attempt is needed")


def refresh(
    staging: DataFrame,
    table: VersionedTable,
    log: RunLog,
    codes: DataFrame,
    source: str,
    first: int,
    last: int,
    expected_rows: int | None,
    name: str = "panel_refresh",
    loaded: str | None = None,
    attempts: int = ATTEMPTS,
) -> DataFrame:
    """Log the start, check every gate, write the upserted version, publish it, log success.

    Any error up to the publication, a failing gate first of all, leaves the published version
    untouched, is logged with its message, and is raised again.  What is published is never logged
    as failed: if only the log entry of the success cannot be written, that error is raised and the
    run stays running; the commit carries its id.  A concurrent refresh that publishes first
    makes this one merge again, up to ``attempts`` times; then it fails as a whole.

    The row rules are counted while the batch is staged, the rows of the table while it is written.
    After staging, the batch is read for its keys once and for the merge once.
    """
    run_id = log.start(name)
    try:
        marked, seen = observed(staging.select(*fixed.SOURCE_COLUMNS), codes, source, first, last)
        batch = stage(marked, "staging")
        keys = key_counts(batch)
        counts = require_counts(batch.sparkSession, seen.get | {"duplicate_keys": keys["duplicate_keys"]}, expected_rows)
        version = merge(table, cast_panel(batch), keys["periods"], run_id, loaded, attempts)
    except Exception as error:
        log.fail(run_id, name, str(error))
        raise
    log.succeed(run_id, name, counts["staging_rows"], version.rows)
    return table.read(version)
