"""Files that tasks write and read themselves, below a folder that all machines reach."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the session's Hadoop settings resolve it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()


def opened(path: str):
    """(file system, path in it) for a qualified path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class Output:
    """A file that appears under its name only when whole; attempts of a task do not meet."""

    def __init__(self, folder: str, name: str):
        self.fs, root = opened(folder)
        self.fs.create_dir(root, recursive=True)
        self.final, self.draft = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.stream, self.at = self.fs.open_output_stream(self.draft), 0

    def write(self, data: bytes) -> int:
        """Appends and returns where the data begins."""
        start = self.at
        self.stream.write(data)
        self.at += len(data)
        return start

    def publish(self):
        self.stream.close()
        if not isinstance(self.fs, fs.LocalFileSystem) and self.fs.get_file_info(self.final).type != fs.FileType.NotFound:
            self.fs.delete_file(self.final)
        self.fs.move(self.draft, self.final)


def ranges(folder: str, name: str):
    """Random reads of one file."""
    system, root = opened(folder)
    return system.open_input_file(f"{root}/{name}")
