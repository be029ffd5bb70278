"""Files through Hadoop's FileSystem, and commits that a reader sees whole or not at all.

Everything goes through the file system of the path itself (local, object
store, HDFS, ...), so nothing depends on a disk of the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path and all below it; a missing one is no error."""
    fs, place = _at(spark, path)
    fs.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a path, in order (none if it is missing)."""
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time in ms) of every file below a path."""
    fs, place = _at(spark, path)
    found, files = [], fs.listFiles(place, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def escaped_name(spark: SparkSession, path: str) -> str:
    """The last part of a path as its URI writes it."""
    return _at(spark, path)[1].toUri().getRawPath().rsplit("/", 1)[1]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has finished (Spark marks that at the very end)."""
    return exists(spark, f"{path}/_SUCCESS")


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless the path exists; of several writers at once exactly one succeeds.

    Distributed file systems promise that for a create without overwrite. On
    a local disk the file is written beside the path and linked to it, which
    the system refuses if the path exists.
    """
    fs, place = _at(spark, path)
    local = fs.getUri().getScheme() == "file"
    target = place.suffix(f".{uuid.uuid4().hex}.tmp") if local else place
    try:
        stream = fs.create(target, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if local:
            as_path = lambda p: spark._jvm.java.io.File(p.toUri().getPath()).toPath()
            try:
                spark._jvm.java.nio.file.Files.createLink(as_path(place), as_path(target))
            finally:
                fs.delete(target, False)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


class CommitLog:
    """Numbered commits below ``root/commits``, each one small JSON file.

    A number is given out once: a writer that finds it taken reads the commit
    that took it and tries the next one with what has changed since, so no
    commit is lost whoever writes at the same time. A file that a writer left
    empty when it died is a number without a commit.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/commits"

    def numbers(self) -> list[int]:
        return [int(n[:12]) for n in children(self.spark, self.folder) if n.endswith(".json")]

    def read(self, number: int) -> dict | None:
        text = read_text(self.spark, f"{self.folder}/{number:012d}.json")
        return json.loads(text) if text else None

    def latest(self) -> tuple[int, dict | None]:
        """The last commit's number and content (-1 and None before the first)."""
        for number in reversed(self.numbers()):
            content = self.read(number)
            if content is not None:
                return number, content
        return -1, None

    def add(self, number: int, content: dict) -> bool:
        """Commit under a number; False if another writer has it."""
        return create_new(self.spark, f"{self.folder}/{number:012d}.json", json.dumps(content, sort_keys=True))

    def update(self, change: Callable[[dict | None], dict | None]) -> int | None:
        """Commit what ``change`` makes of the last commit, again if another came in between; None if it makes nothing."""
        while True:
            # numbers first: a commit that comes after this line has the number that is tried
            number = max(self.numbers(), default=-1) + 1
            content = change(self.latest()[1])
            if content is None:
                return None
            if self.add(number, content):
                return number

    def forget_before(self, number: int) -> None:
        """Remove commits older than ``number``."""
        for n in self.numbers():
            if n < number:
                delete(self.spark, f"{self.folder}/{n:012d}.json")
