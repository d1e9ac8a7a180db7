"""Published tables without a table format: immutable version folders and numbered commits.

A version is written completely to a folder of its own.  It becomes visible by one commit file,
the last step; readers take the commit with the highest number.  A failed or repeated write leaves an
unreferenced folder and changes nothing for readers.  Nothing is ever overwritten in place, so a
table can be read while its successor is written.

A version knows the commit it was made from, and its commit has the next number, whose file can be
created only once.  Of two writers that started from the same version, the second one gets
``Conflict`` and has to merge anew; no accepted batch is ever lost.

A partitioned table lists its partition folders in the commit, so a new version can keep the
untouched partitions of the old one where they are and write only the others.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.sources.commits import create_once, read_notes

COMMIT = "number bigint, parts array<struct<folder: string, rows: bigint>>, published_ns bigint, run_id string, loaded string"
COMMITS = "_commits"
KEPT_COMMITS, KEPT_DAYS = 3, 7


class Conflict(RuntimeError):
    """Another writer published first: what this one wrote was made from an older version."""


@dataclass(frozen=True)
class Version:
    """A written version: its folders below the base of the table, the rows in each, and its number.

    A version that isn't published yet has the number it would get.
    """

    parts: tuple[str, ...]
    counts: tuple[int, ...]
    number: int

    @property
    def rows(self) -> int:
        return sum(self.counts)


class VersionedTable:
    """A table below ``base``, published version by version, optionally partitioned by a column.

    The partition column must have few values (periods): their list is kept in the commit.
    """

    def __init__(self, spark: SparkSession, base: str, partition: str | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self.partition = partition

    def commits(self) -> DataFrame:
        """All commits, one row each; no rows before the first publication."""
        return read_notes(self.spark, f"{self.base}/{COMMITS}", COMMIT)

    def current(self) -> Version | None:
        """The newest published version, None before the first publication."""
        commit = self.commits().orderBy(F.desc("number")).first()
        if commit is None:
            return None
        return Version(tuple(p["folder"] for p in commit["parts"]), tuple(p["rows"] for p in commit["parts"]), commit["number"])

    def read(self, version: Version | None = None) -> DataFrame:
        """A version, the current one by default; filters on the partition column skip folders."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing is published below {self.base}")
        paths = [f"{self.base}/{part}" for part in version.parts]
        return self.spark.read.option("basePath", self.base).parquet(*paths).drop("version")

    def in_partitions(self, df: DataFrame, values: list) -> DataFrame:
        """The rows of a frame in the partitions with these values, a missing one among them."""
        known = F.col(self.partition).isin([v for v in values if v is not None])
        return df.where(known | F.col(self.partition).isNull()) if None in values else df.where(known)

    def write(self, df: DataFrame, base: Version | None = None, keep: bool = False) -> Version:
        """Write the successor of ``base`` without publishing it.

        With ``keep`` the partitions of ``base`` that ``df`` has no rows for are taken over as they are.
        Rows per folder come from the files' own counts; no column of them is read.
        """
        name, number = f"version={uuid.uuid4().hex}", (base.number if base else 0) + 1
        if self.partition is None:
            df.write.parquet(f"{self.base}/{name}")
            return Version((name,), (self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}").count(),), number)
        # Rebalanced by partition value: no task writes a sliver of every partition, and a large
        # partition is still split over several tasks.
        df.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(f"{self.base}/{name}")
        # The folders' names as Spark wrote them, so that a missing value or a sign needs no rule here.
        folder = F.regexp_extract(decoded("_metadata.file_path"), rf"{name}/([^/]+)/[^/]+$", 1)
        written = self.spark.read.schema(df.schema).option("basePath", self.base).parquet(f"{self.base}/{name}")
        counts = {r["folder"]: r["count"] for r in written.groupBy(folder.alias("folder")).count().collect()}
        parts = {f"{name}/{f}": n for f, n in sorted(counts.items())}
        if keep and base:
            old = {p: n for p, n in zip(base.parts, base.counts, strict=True) if p.rpartition("/")[2] not in counts}
            parts = old | parts
        return Version(tuple(parts), tuple(parts.values()), number)

    def publish(self, version: Version, run_id: str = "", loaded: str | None = None) -> None:
        """Make a written version the current one, or raise ``Conflict`` if its number is taken.

        ``loaded`` names what the version was made of; :meth:`has_loaded` finds it in the commits.
        """
        commit = {
            "number": version.number,
            "parts": [{"folder": p, "rows": n} for p, n in zip(version.parts, version.counts, strict=True)],
            "published_ns": time.time_ns(),
            "run_id": run_id,
            "loaded": loaded,
        }
        if not create_once(self.spark, f"{self.base}/{COMMITS}/{version.number:020d}.json", json.dumps(commit)):
            raise Conflict(f"version {version.number} of {self.base} was published by another writer")

    def has_loaded(self, loaded: str) -> bool:
        """Whether a commit says that it was made of this."""
        return not self.commits().where(F.col("loaded") == loaded).isEmpty()

    def overwrite(self, df: DataFrame, run_id: str = "") -> DataFrame:
        """Full refresh: write, publish, return the published table."""
        version = self.write(df, self.current())
        self.publish(version, run_id)
        return self.read(version)

    def unreachable(self, keep: int = KEPT_COMMITS, days: int = KEPT_DAYS, now: datetime | None = None) -> DataFrame:
        """Folders that no kept commit names and that may go: (folder, files, bytes, newest).

        The newest ``keep`` commits are kept.  A folder with a file of the last ``days`` may belong to a
        version that is still being written, and stays.  Nothing is deleted here.
        """
        kept = self.commits().orderBy(F.desc("number")).limit(keep).select(F.explode("parts.folder").alias("folder"))
        return sweep(self.spark, self.base, r"(version=[^/]+(?:/[^/=]+=[^/]*)?)", kept, days, now)


class VersionedSet:
    """Several tables below ``base`` that are published together, by one commit.

    A commit names the folders of every table, so that readers never see one table with the data of another
    commit, and a failure before it changes none of them.
    """

    def __init__(self, spark: SparkSession, base: str, names: list[str]):
        self.tables = {name: VersionedTable(spark, f"{base.rstrip('/')}/{name}") for name in names}
        self.commits = VersionedTable(spark, base)

    def current(self) -> Version | None:
        return self.commits.current()

    def _part(self, version: Version, name: str) -> dict[str, int]:
        prefix = f"{name}/"
        return {p.removeprefix(prefix): n for p, n in zip(version.parts, version.counts, strict=True) if p.startswith(prefix)}

    def read(self, name: str, version: Version | None = None) -> DataFrame:
        """One of the tables, as of a version, the current one by default."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing is published below {self.commits.base}")
        parts = self._part(version, name)
        return self.tables[name].read(Version(tuple(parts), tuple(parts.values()), version.number))

    def write(self, frames: dict[str, DataFrame], base: Version | None = None) -> Version:
        """Write some of the tables anew; the others stay as ``base`` has them.  Nothing is published."""
        parts: dict[str, int] = {}
        for name, table in self.tables.items():
            if name in frames:
                written = table.write(frames[name])
                parts |= {f"{name}/{p}": n for p, n in zip(written.parts, written.counts, strict=True)}
            elif base is not None:
                parts |= {f"{name}/{p}": n for p, n in self._part(base, name).items()}
        return Version(tuple(parts), tuple(parts.values()), (base.number if base else 0) + 1)

    def rows(self, name: str, version: Version) -> int:
        return sum(self._part(version, name).values())

    def publish(self, version: Version, run_id: str = "", loaded: str | None = None) -> None:
        """Make a written version of all tables the current one, or raise ``Conflict``."""
        self.commits.publish(version, run_id, loaded)


def decoded(column: str) -> Column:
    """The path behind the URL form in which Spark shows it; a plus sign is only itself there."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def sweep(spark: SparkSession, base: str, pattern: str, kept: DataFrame, days: int, now: datetime | None = None) -> DataFrame:
    """Folders below ``base`` whose path matches ``pattern``, without the kept and the young ones.

    One listing of names and times, no contents: (folder, files, bytes, newest).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    last = re.escape(base.rstrip("/").rpartition("/")[2])
    folder = F.regexp_extract("path", f"/{last}/{pattern}/", 1)
    found = files.select(folder.alias("folder"), "modificationTime", "length").where("folder <> ''")
    sizes = found.groupBy("folder").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest")
    )
    cutoff = (now or datetime.now(timezone.utc)) - timedelta(days=days)
    return sizes.where(F.col("newest") < F.lit(cutoff)).join(kept.select("folder").distinct(), "folder", "left_anti")


def stale_scratch(spark: SparkSession, days: int = KEPT_DAYS, now: datetime | None = None) -> DataFrame:
    """Folders of ``session.stage`` below the session's scratch space with no file of the last ``days``.

    Frames of a live session are young; an older one than any job runs belongs to a session that ended.
    """
    base = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    return sweep(spark, base, r"([^/]+-[0-9a-f]{32})", spark.createDataFrame([], "folder string"), days, now)
