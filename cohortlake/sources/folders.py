"""A data source of the files in the folders below a root, those that Spark's file readers hide among them.

Readers of files skip names with an underscore and files of no bytes, which are
the markers and blank pages that say how far a shard is. Here every folder is a
partition, so folders are listed in parallel on the executors; the root alone
is listed once. The contents of files with given names are read along.
"""

from __future__ import annotations

import datetime
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path STRING, name STRING, folder STRING, length BIGINT, modified TIMESTAMP, content STRING"


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def subfolders(root: str) -> list[str]:
    """Names of the folders directly below root; none where root is missing."""
    if (local := _local(root)) is not None:
        if not os.path.isdir(local):
            return []
        with os.scandir(local) as found:
            return sorted(x.name for x in found if x.is_dir())
    from pyarrow import fs

    store, inner = _store(root)
    return sorted(x.base_name for x in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if x.type == fs.FileType.Directory)


def files_of(folder: str, contents: frozenset[str]) -> Iterator[tuple]:
    """name, length, modified and content (of the named files only) of the files in a folder."""
    if (local := _local(folder)) is not None:
        with os.scandir(local) as found:
            for x in sorted(found, key=lambda x: x.name):
                if x.is_file():
                    content = None
                    if x.name in contents:
                        with open(x.path, encoding="utf-8") as source:
                            content = source.read()
                    status = x.stat()
                    yield x.name, status.st_size, datetime.datetime.fromtimestamp(status.st_mtime, datetime.UTC), content
        return
    from pyarrow import fs

    store, inner = _store(folder)
    for x in store.get_file_info(fs.FileSelector(inner)):
        if x.is_file:
            content = None
            if x.base_name in contents:
                with store.open_input_stream(x.path) as source:
                    content = source.read().decode("utf-8")
            yield x.base_name, x.size, x.mtime, content


class Folder(InputPartition):
    def __init__(self, name: str):
        self.name = name


class _Reader(DataSourceReader):
    def __init__(self, root: str, contents: frozenset[str]):
        self.root, self.contents = root.rstrip("/"), contents

    def partitions(self) -> list[Folder]:
        return [Folder(x) for x in subfolders(self.root)] or [Folder("")]

    def read(self, partition: Folder) -> Iterator[tuple]:
        if partition.name:
            folder = f"{self.root}/{partition.name}"
            for name, length, modified, content in files_of(folder, self.contents):
                if not name.endswith(".crc"):
                    yield f"{folder}/{name}", name, partition.name, length, modified, content


class FolderFiles(DataSource):
    """format("folder_files").option("contents", "name,name").load(root)."""

    @classmethod
    def name(cls) -> str:
        return "folder_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], frozenset(x for x in self.options.get("contents", "").split(",") if x))


def folder_files(spark: SparkSession, root: str, contents: tuple[str, ...] = ()) -> DataFrame:
    """path, name, folder, length, modified, content of every file one folder below root."""
    spark.dataSource.register(FolderFiles)
    return spark.read.format("folder_files").option("contents", ",".join(contents)).load(root)
