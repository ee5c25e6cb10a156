"""Token-ID output: Arrow files of equal-length sequences and masks.

Every document becomes its token ids and an end id. Documents in ascending order of id make one
stream of ids; Spark deals it by ranges of the id to tasks, and each task writes one shard:

* ``<shard>.arrow``: an Arrow file, record batches of ``ROWS_A_BATCH`` rows with the columns
  ``ids``, a fixed-size list of ``sequence_length`` unsigned integers, and ``mask``, a fixed-size
  list of booleans, false over the padding of the shard's last row. Ids take 16 bits where the
  vocabulary allows. All batches but the last have as many rows, so sequence ``i`` is row
  ``i % ROWS_A_BATCH`` of batch ``i // ROWS_A_BATCH``: reading it copies nothing.
* ``<shard>.docs``: an Arrow file with a row for each document: ``doc_id``, ``start`` in the
  shard, ``n_tokens``.

Names are unique for each attempt of a task. The manifest, a Parquet table that Spark commits,
names the files of the attempts that count, so a lost executor or a second attempt does no harm.

Defined results: NULL text is the empty text (the end id alone); rows with equal or NULL id all
count, ordered by the hash of their text (NULL ids first); an empty table gives no rows; further
columns are left out.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Files, documents, in_slices, materialise, new_folder, strings
from .tokenize import encoder, with_end

ROWS_A_BATCH = 256
MANIFEST = "shard int, name string, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _schema(sequence_length: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, sequence_length)), ("mask", pa.list_(pa.bool_(), sequence_length))])


def _sequences(ids: np.ndarray, schema: pa.Schema, length: int) -> pa.RecordBatch:
    """Ids as rows of ``length``; the last row is padded with 0."""
    rows = -(-len(ids) // length)
    full = np.zeros(rows * length, ids.dtype)
    full[: len(ids)] = ids
    mask = np.arange(rows * length) < len(ids)
    arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (full, mask)]
    return pa.record_batch(arrays, schema=schema)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, sequence_length: int = 2048) -> tuple[str, DataFrame]:
    """Write all documents; gives the folder and the manifest."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    Files(folder).create()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        kind = pa.uint16() if encode.vocabulary <= 1 << 16 else pa.uint32()
        schema, whole = _schema(sequence_length, kind), sequence_length * ROWS_A_BATCH
        name, files = uuid.uuid4().hex, Files(folder)
        waiting, n_waiting, n_docs, n_tokens = [], 0, 0, 0
        with (
            files.sink(f"{name}.arrow") as out,
            files.sink(f"{name}.docs") as out_docs,
            pa.ipc.new_file(out, schema) as rows,
            pa.ipc.new_file(out_docs, DOCS) as index,
        ):
            for batch in batches:
                texts = strings(batch)
                for low, high in in_slices(texts):
                    ids, bounds = with_end(*encode.columns(texts.slice(low, high - low)), end_id)
                    index.write_batch(
                        pa.record_batch(
                            [batch.column("doc_id").slice(low, high - low), n_tokens + bounds[:-1], np.diff(bounds)],
                            schema=DOCS,
                        )
                    )
                    n_docs, n_tokens = n_docs + high - low, n_tokens + len(ids)
                    waiting.append(ids.astype(kind.to_pandas_dtype()))
                    n_waiting += len(ids)
                    if n_waiting >= whole:
                        joined = np.concatenate(waiting)
                        for at in range(0, n_waiting - whole + 1, whole):
                            rows.write_batch(_sequences(joined[at : at + whole], schema, sequence_length))
                        waiting = [joined[n_waiting - n_waiting % whole :]]
                        n_waiting %= whole
            if n_waiting:
                rows.write_batch(_sequences(np.concatenate(waiting), schema, sequence_length))
        encode.forget()
        if n_docs:
            shard = TaskContext.get().partitionId()
            yield pa.record_batch(
                [pa.array([shard], pa.int32()), [name], [n_docs], [n_tokens]],
                names=["shard", "name", "n_docs", "n_tokens"],
            )

    mixed = F.xxhash64("text")
    ordered = (
        documents(docs)
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("doc_id").asc_nulls_first(), mixed)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), mixed)
    )
    return folder, materialise(ordered.mapInArrow(write, MANIFEST), "manifest")


def sequence(files: Files, name: str, number: int) -> tuple[pa.Array, pa.Array]:
    """Ids and mask of one sequence of a shard, without reading the others."""
    with pa.ipc.open_file(files.source(f"{name}.arrow")) as shard:
        batch = shard.get_batch(number // ROWS_A_BATCH)
    row = number % ROWS_A_BATCH
    return batch.column("ids")[row].values, batch.column("mask")[row].values


def _ids_of(shard: pa.RecordBatchFileReader) -> Iterator[np.ndarray]:
    for i in range(shard.num_record_batches):
        batch = shard.get_batch(i)
        ids, mask = (batch.column(c).flatten() for c in ("ids", "mask"))
        ids = ids.to_numpy()
        yield ids if i + 1 < shard.num_record_batches else ids[mask.to_numpy(zero_copy_only=False)]


def read_documents(folder: str, manifest: DataFrame) -> DataFrame:
    """From the files: each document's place in the whole stream, its length and the checksum of
    its ids as 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(folder)
        for batch in batches:
            for name, first in zip(batch.column("name").to_pylist(), batch.column("first").to_pylist()):
                with (
                    pa.ipc.open_file(files.source(f"{name}.arrow")) as shard,
                    pa.ipc.open_file(files.source(f"{name}.docs")) as index,
                ):
                    parts = _ids_of(shard)
                    held, at = np.empty(0, np.uint32), 0
                    for i in range(index.num_record_batches):
                        docs = index.get_batch(i)
                        starts, counts = (docs.column(c).to_numpy() for c in ("start", "n_tokens"))
                        sums = np.empty(len(starts), np.int64)
                        for k, (start, count) in enumerate(zip(starts.tolist(), counts.tolist())):
                            if at + len(held) < start + count:
                                more = [held[start - at :]]
                                n = len(more[0])
                                while n < count:
                                    more.append(next(parts).astype("<u4"))
                                    n += len(more[-1])
                                held, at = np.concatenate(more), start
                            sums[k] = zlib.crc32(held[start - at : start - at + count])
                        yield pa.record_batch(
                            [docs.column("doc_id"), first + starts, counts, sums],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    before = F.sum("n_tokens").over(Window.orderBy("shard")) - F.col("n_tokens")
    shards = manifest.select("name", before.alias("first"), "shard")
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(parts, "shard").select("name", "first").mapInArrow(read, READ)
