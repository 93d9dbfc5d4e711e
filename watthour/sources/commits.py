"""Tables that grow by commits: written aside, checked, then published by one rename.

A writer writes its rows once to a ``_staging`` folder of the table, which readers never see,
checks what it wrote, and renames that folder to ``commit=N`` with N one above the newest commit
it has checked against.  The rename fails where N exists, so of two writers that started
together the second looks at the first one's rows before it tries the next number.  The
rename must be atomic, as on HDFS and POSIX file systems.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

STAGING = "_staging"


def folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = folder(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    files, where = folder(spark, path)
    return sorted(e.getPath().getName() for e in files.listStatus(where)) if files.exists(where) else []


def numbers(spark: SparkSession, path: str, prefix: str = "commit=") -> list[int]:
    """Published numbers, ascending.  A folder without the mark of a complete write is skipped."""
    found = (c.removeprefix(prefix) for c in children(spark, path) if c.startswith(prefix))
    return sorted(int(n) for n in found if exists(spark, f"{path}/{prefix}{n}/_SUCCESS"))


def publish(spark: SparkSession, staged: str, target: str) -> bool:
    """Rename a staged folder to ``target``; False where another writer has taken that name."""
    files, source = folder(spark, staged)
    place = files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(target))
    source = files.makeQualified(source)
    if files.getScheme() == "file":
        # renaming onto a folder that holds files fails in the operating system, in one step
        try:
            os.rename(source.toUri().getPath(), place.toUri().getPath())
        except OSError:
            if exists(spark, target):
                return False
            raise
        return True
    fs = spark._jvm.org.apache.hadoop.fs
    option = getattr(fs, "Options$Rename")
    never_over = spark._sc._gateway.new_array(option, 1)
    never_over[0] = option.NONE
    try:
        fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, place, never_over)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


class Staged:
    """Rows written aside once; ``read`` gives them back for any number of checks."""

    def __init__(self, rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.path, self.schema = rows.sparkSession, path, rows.schema
        self.folder = f"{path}/{STAGING}/{uuid.uuid4().hex}"
        try:
            rows.write.partitionBy(*partition_by).parquet(self.folder)
        except BaseException:
            self.discard()
            raise

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder).select(*self.schema.names)

    def partitions(self, column: str) -> list[str]:
        """Values of a partition column, from the folder names."""
        return [c.partition("=")[2] for c in children(self.spark, self.folder) if c.startswith(f"{column}=")]

    def discard(self) -> None:
        files, where = folder(self.spark, self.folder)
        files.delete(where, True)

    def commit(self, check: Callable[[list[int] | None], None], prefix: str = "commit=") -> int:
        """Publish under the next free number and return it.

        ``check`` gets the numbers published since its last call (None the first time, for
        all there are) and raises where the rows must not be published; they are deleted then.
        """
        try:
            there = numbers(self.spark, self.path, prefix)
            check(None)
            while True:
                number = (there[-1] if there else 0) + 1
                if publish(self.spark, self.folder, f"{self.path}/{prefix}{number}"):
                    return number
                now = numbers(self.spark, self.path, prefix)
                fresh = [n for n in now if n not in set(there)]
                if not fresh:
                    raise RuntimeError(f"{self.path}/{prefix}{number} is in the way and no complete commit")
                check(fresh)
                there = now
        except BaseException:
            self.discard()
            raise
