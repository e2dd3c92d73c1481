"""Shared helpers: the shared folder, materialised steps and word rules."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separators of every word rule here.
SPACE = r"\x20\x09-\x0D"

#: Most characters of text that a task turns into Python objects at once.
CHUNK_CHARS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is spark.checkpoint.dir. Where that is unset, a local session sets and
    uses a fresh folder of its machine; on a cluster that is an error, as
    executors could not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.cohortlake.sharedFolder", None)
    if not folder:
        if not spark.conf.get("spark.master").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.cohortlake.sharedFolder", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again, which cuts its lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of steps that are written; it does so when the driver collects its garbage, which else may be half an hour away."""
    gc.collect()
    if (jvm := getattr(spark.sparkContext, "_jvm", None)) is not None:
        jvm.System.gc()


def numbered(documents: DataFrame, name: str = "row") -> DataFrame:
    """documents with a unique number of each row, written so that every use of a row sees the same one."""
    return materialize(documents.withColumn(name, F.monotonically_increasing_id()), "numbered-documents")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_chunks(batches: Iterator[pd.DataFrame], column: str = "text", most: int = CHUNK_CHARS) -> Iterator[pd.DataFrame]:
    """Cut batches so that each holds at most `most` characters, or one row."""
    for batch in batches:
        start, size = 0, 0
        for i, text in enumerate(batch[column]):
            here = len(text) if text else 0
            if i > start and size + here > most:
                yield batch.iloc[start:i]
                start, size = i, 0
            size += here
        if start < len(batch):
            yield batch.iloc[start:]


def id_columns(name: str = "doc_id") -> list[Column]:
    """An id and whether it is null, as two columns without nulls: beside a null pandas would round long ids to doubles."""
    own = F.col(name).cast("long")
    return [F.coalesce(own, F.lit(0)).alias(name), own.isNull().alias("no_id")]


def ids_of(batch: pd.DataFrame, name: str = "doc_id") -> pd.arrays.IntegerArray:
    """The exact ids of a batch with id_columns, null where they are."""
    return pd.arrays.IntegerArray(batch[name].to_numpy(np.int64).copy(), batch["no_id"].to_numpy(bool).copy())


_REMEMBERED: dict[str, Callable[[], None]] = {}


def remember_only(name: str, clear: Callable[[], None] = lambda: None) -> None:
    """Drop what other operators remember in this worker, which serves one of them at a time; `clear` drops what this one will."""
    others = [k for k in _REMEMBERED if k != name]
    for k in others:
        _REMEMBERED.pop(k)()
    _REMEMBERED[name] = clear
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library can give memory back
            ctypes.CDLL(None).malloc_trim(0)


def strings(values) -> pd.Series:
    """Python strings as they are, which Arrow takes as one array."""
    return pd.Series(list(values), dtype=object)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bound the bytes of an Arrow batch, as whole texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def local_path(path: str) -> str | None:
    """The path of a file: URI on this machine, else None."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None


def write_file(path: str, parts) -> int:
    """Write byte strings to a file of the shared folder; readers see all or nothing.

    A rerun of the task writes the same name again, so a lost executor leaves
    no second copy. Returns the bytes written.
    """
    size = 0
    if (local := local_path(path)) is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        aside = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(aside, "wb") as out:
            for part in parts:
                size += out.write(part)
        os.replace(aside, local)
        return size
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    store.create_dir(os.path.dirname(inner), recursive=True)
    aside = f"{os.path.dirname(inner)}/.{uuid.uuid4().hex}"
    with store.open_output_stream(aside) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    store.move(aside, inner)
    return size


def open_file(path: str):
    """A seekable binary reader of a file of the shared folder."""
    if (local := local_path(path)) is not None:
        return open(local, "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def ascii_lower(column):
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
