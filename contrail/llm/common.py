"""Helpers that the operators of this package share.

Conventions that hold for every operator here:

* only ``doc_id`` and ``text`` (and what a docstring names) are read; further columns of the
  input, whatever their names, never reach the operator's own joins;
* a NULL text counts as empty;
* intermediate tables are Parquet files below ``spark.checkpoint.dir`` (:func:`stage`), so a
  lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.session import scratch_path

#: odd multiplier of the rolling word hash (2**64 / golden ratio)
ROLL = np.uint64(0x9E3779B97F4A7C15)


def _folder(spark, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def stage(df: DataFrame, name: str, held: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder, read it back; the files go when the driver ends.

    The path is added to ``held``, for an operator that can :func:`discard` them earlier.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    folder, files = _folder(spark, path)
    files.deleteOnExit(folder)
    if held is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark, held: list[str]) -> None:
    """Delete staged tables that nothing will read again."""
    for path in held:
        folder, files = _folder(spark, path)
        files.delete(folder, True)
    held.clear()


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string), NULL text as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A batch's texts as UTF-8 (``bytes.lower`` and ``bytes.split`` touch A-Z and ``[\\x20\\x09-\\x0D]`` only)."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a rolling hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (empty if there are fewer)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # doubling: runs of 1, 2, 4, ... words, then the runs that make up ``size``
    run, length, out, done = hashes, 1, None, 0
    while True:
        if size & length:
            part = run[done:done + n]
            out = part.copy() if out is None else out * power(length) + part
            done += length
        if length * 2 > size:
            return mix(out)
        run = run[: len(run) - length] * power(length) + run[length:]
        length *= 2


def power(n: int) -> np.uint64:
    return np.uint64(pow(int(ROLL), n, 1 << 64))


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def list_of_longs(rows: list[np.ndarray]) -> pa.Array:
    """Array column from one integer vector per row."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), longs(flat.astype(flat.dtype if flat.dtype.itemsize == 8 else np.int64)))


Batches = Iterator[pa.RecordBatch]
