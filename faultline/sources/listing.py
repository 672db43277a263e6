"""Names directly below a folder, through whatever file system Spark uses for it."""

from __future__ import annotations

import os
import warnings
from collections.abc import Collection
from dataclasses import dataclass
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DONE = "_SUCCESS"
_UNDER_WAY = "_temporary"
#: The setting by which jobs mark the folders they have completed.
MARKS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    modified: int
    is_folder: bool


def entries(
    spark: SparkSession, pattern: str, besides: Collection[str] = ()
) -> list[Entry]:
    """Files and completed folders matching a glob, sorted by name.

    One entry per snapshot, never one per data file. A folder without the mark of a committed job
    is left out with a warning that names it: its writer was lost half-way. Where this session's
    jobs write no marks, a folder counts as completed once nothing temporary is left in it. The
    mark's time stands for the folder's, because object stores keep no time for folders.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    unmarked = writes_no_marks(spark)
    target = hadoop.Path(pattern)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(target) or []:
        path, modified = status.getPath(), status.getModificationTime()
        if path.getName() in besides:
            continue
        if status.isDirectory():
            done = hadoop.Path(path, _DONE)
            if fs.exists(done):
                modified = fs.getFileStatus(done).getModificationTime()
            elif not unmarked or fs.exists(hadoop.Path(path, _UNDER_WAY)):
                warnings.warn(f"left out, not marked as complete: {path.toString()}", stacklevel=2)
                continue
        found.append(Entry(path.getName(), path.toString(), modified, status.isDirectory()))
    return sorted(found, key=lambda entry: entry.name)


def writes_no_marks(spark: SparkSession) -> bool:
    """Whether this session's jobs leave completed folders without a mark."""
    return spark._jsc.hadoopConfiguration().get(MARKS) == "false"


def folders(spark: SparkSession, pattern: str) -> list[Entry]:
    """Folders matching a glob, complete or not."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [
        Entry(status.getPath().getName(), status.getPath().toString(), status.getModificationTime(), True)
        for status in fs.globStatus(target) or []
        if status.isDirectory()
    ]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless one is there; of several writers exactly one succeeds.

    The whole file is written beside its place and then moved there by a rename that refuses to
    replace. HDFS and other file systems with such a rename decide in their name service; on a local
    disk a hard link does. A store whose rename is a copy decides nothing and needs a single writer.
    """
    target, fs = _open(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(beside.toUri().getPath(), target.toUri().getPath())
        else:
            rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
            flags = spark.sparkContext._gateway.new_array(rename, 1)
            flags[0] = rename.NONE
            context = spark._jvm.org.apache.hadoop.fs.FileContext
            context.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, target, flags)
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(beside, False)
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    target, fs = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    target, fs = _open(spark, path)
    fs.delete(target, True)


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
