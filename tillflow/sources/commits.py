"""A log of small commits that says which table versions and state values are current.

A commit is one JSON file named by its number, and holds the whole present content. A reader
takes the highest number. A writer adds the next number and never overwrites: of two writers that
start from one commit the store lets one create the file, and the other gets a ``Conflict``. That
holds as far as the store's create without overwriting is atomic, as on HDFS.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

# Commits kept; older ones are deleted as new ones come.
KEPT = 1000


class Conflict(RuntimeError):
    """Another writer has committed since the content was read."""


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, number: int | None = None):
        name = self.folder if number is None else f"{self.folder}/{number:020d}.json"
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def numbers(self) -> list[int]:
        if not self._files.exists(self._path()):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._path())]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def head(self) -> tuple[int, dict]:
        """Number and content of the last commit; -1 and nothing before the first.

        A commit that its writer has not finished cannot be read yet and does not count.
        """
        for number in reversed(self.numbers()):
            stream = self._files.open(self._path(number))
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                return number, json.loads(text)
            except ValueError:
                continue
        return -1, {}

    def commit(self, base: int, content: dict) -> int:
        """Add ``content`` as the commit after ``base``."""
        number = base + 1
        try:
            stream = self._files.create(self._path(number), False)
        except Py4JJavaError as error:
            if "Exist" in error.java_exception.getClass().getName():
                raise Conflict(f"commit {number} of {self.folder} is taken") from None
            raise
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if number >= KEPT:
            self._files.delete(self._path(number - KEPT), False)
        return number

    def history(self) -> DataFrame:
        """(number, content) of the commits that are kept."""
        texts = self.spark.read.text(self.folder, wholetext=True, pathGlobFilter="*.json")
        number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("long")
        return texts.select(number.alias("number"), F.col("value").alias("content"))

    def remove(self, folder: str) -> None:
        """Delete a folder that no commit names any more."""
        self._files.delete(self._jvm.org.apache.hadoop.fs.Path(folder), True)

    def exists(self, folder: str) -> bool:
        return self._files.exists(self._jvm.org.apache.hadoop.fs.Path(folder))
