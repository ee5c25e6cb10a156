"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.sources.scratch import materialise, scratch_root

__all__ = [
    "Files",
    "crc_of_id",
    "documents",
    "in_slices",
    "materialise",
    "new_folder",
    "ragged",
    "ship_package",
    "strings",
    "table",
]

#: Text handled at once inside a task, in bytes; larger single texts are handled alone.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """The two columns that most operators work on; further columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def crc_of_id(column: str, modulus: int) -> Column:
    """The remainder that deals labelled rows to training and held-out parts."""
    return F.crc32(F.col(column).cast("string")) % modulus


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own for this run, in the shared scratch folder."""
    return f"{scratch_root(spark)}/clientlens-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, for functions that run there; once for an application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="clientlens-")), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


class Files:
    """A folder that tasks write to and read from, on whatever store the URI names."""

    def __init__(self, uri: str) -> None:
        if uri.startswith("file:"):
            self.store, self.root = fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
        elif "://" in uri:
            self.store, self.root = fs.FileSystem.from_uri(uri)
        else:
            self.store, self.root = fs.LocalFileSystem(), uri

    def create(self) -> None:
        self.store.create_dir(self.root, recursive=True)

    def sink(self, name: str):
        return self.store.open_output_stream(f"{self.root}/{name}")

    def source(self, name: str):
        """The file by name; a local one is mapped into memory, not read."""
        path = f"{self.root}/{name}"
        if isinstance(self.store, fs.LocalFileSystem):
            return pa.memory_map(path)
        return self.store.open_input_file(path)


def strings(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """A text column with 64-bit offsets, NULL as the empty text."""
    return batch.column(name).cast(pa.large_string()).fill_null("")


def in_slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """Bounds of consecutive rows that hold about ``limit`` bytes of text together."""
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        yield low, high
        low = high


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions ``starts[i], starts[i] + 1, ...`` of all rows, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)
