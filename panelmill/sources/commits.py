"""Files that exist once: the one step in which concurrent writers can be told apart."""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this content in one step; False if there already is one.

    The file is written under another name and then given its own, in a way that fails where the name
    is taken: a hard link on a local or mounted file system, elsewhere a rename without overwriting
    of Hadoop's file systems, which HDFS and stores with real renames do in one step.  A writer
    that dies before leaves a hidden file that no reader looks at.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = files.makeQualified(target).toUri()
    hidden = f".{uuid.uuid4().hex}.tmp"
    if uri.getScheme() == "file":
        return link_once(uri.getPath(), hidden, text)
    return rename_once(spark, files, target, hidden, text)


def append_note(spark: SparkSession, folder: str, note: dict) -> None:
    """Add one row to a folder of notes; writers don't meet, as each note is a file of its own."""
    create_once(spark, f"{folder.rstrip('/')}/{uuid.uuid4().hex}.json", json.dumps(note))


def read_notes(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All notes of a folder, no rows if there is none."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").json(folder)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def link_once(path: str, hidden: str, text: str) -> bool:
    folder = os.path.dirname(path)
    os.makedirs(folder, exist_ok=True)
    draft = os.path.join(folder, hidden)
    with open(draft, "w", encoding="utf-8") as out:
        out.write(text)
        out.flush()
        os.fsync(out.fileno())
    try:
        os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def rename_once(spark: SparkSession, files, target, hidden: str, text: str) -> bool:
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), hidden)
    out = files.create(draft)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True
