"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here counts on.  Joins against a dimension are left to the
# optimizer: it broadcasts a side only after checking its size, and beyond that AQE splits the
# hot partitions of the sort-merge join, also where a later step has to be shuffled again for it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles a method above 8000 bytes; beyond it split methods are faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it then gets a new temporary folder.  On a
    cluster a machine-local folder would not be seen by the other executors, so that is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch space and read it back, which cuts its lineage.

    Used where one frame feeds several outputs: the work is done once, later reads are pruned to
    the columns they need, and a lost executor costs a re-read instead of a re-run.  The shuffle files of
    the write go as it ends; else they would stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before) if before else spark.conf.unset(CLEAN_UP)
    return spark.read.schema(df.schema).parquet(path)
