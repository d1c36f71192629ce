"""Exact duplicates by content-defined chunk recipes.

A text (A-Z lower-cased) is cut where a gear hash of the last 32 bytes has its lowest bits zero,
so equal texts have equal cuts. A chunk gets a 64-bit fingerprint; the distinct (fingerprint,
SHA-256) pairs show which fingerprints stand for one content only, which verifies them as
identifiers. A document is then its recipe, the ordered list of chunk identifiers, and only
recipes are shuffled and compared: a long document's bytes are read once and never moved.
Documents that hold a fingerprint with two contents are told apart by their SHA-256 as well.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import Batches, id_text, list_of_longs, mix, stage, text_bytes

AVERAGE = 1024  # bytes between cuts on average, beyond LEAST; a power of two
LEAST = 256
MOST = 8192
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cuts(text: bytes) -> list[int]:
    """End offsets of a text's chunks (none for an empty text)."""
    n = len(text)
    if n == 0:
        return []
    h = _GEAR[np.frombuffer(text, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # sums over the last 2, 4, 8, 16, 32 bytes
        grown = h.copy()
        grown[step:] += h[:-step] << np.uint32(step)
        h = grown
    ends, last = [], 0
    for at in np.flatnonzero((h >> np.uint32(32 - (AVERAGE.bit_length() - 1))) == 0) + 1:
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST:
            last = int(at)
            ends.append(last)
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _recipes(bits: int):
    mask = (1 << bits) - 1

    def run(batches: Batches) -> Batches:
        for batch in batches:
            whole, sizes, prints, digests = [], [], [], []
            for raw in text_bytes(batch):
                text = raw.lower()
                ends = cuts(text)
                chunks = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                whole.append(hashlib.sha256(text).hexdigest())
                sizes.append(len(text))
                prints.append(np.array([xxhash.xxh64_intdigest(c) & mask for c in chunks], np.uint64))
                digests.append([hashlib.sha256(c).digest() for c in chunks])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(whole), pa.array(sizes, pa.int64()), list_of_longs(prints),
                 pa.array(digests, pa.list_(pa.binary()))], ["doc_id", "text_sha256", "n_bytes", "recipe", "digests"])

    return run


def exact_groups(docs: DataFrame, fingerprint_bits: int = 64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z; the row with the largest doc_id of each
    group stays. NULL texts count as empty, and all empty texts are one group. Of rows that
    repeat the largest doc_id one stays. A NULL doc_id is smaller than any other, so a group of
    NULL ids keeps one row with a NULL keep_id. An empty table gives an empty result; extra
    columns are not read.
    """
    rows = stage(id_text(docs).mapInArrow(
        _recipes(fingerprint_bits),
        "doc_id long, text_sha256 string, n_bytes long, recipe array<long>, digests array<binary>")
        .withColumn("row", F.monotonically_increasing_id()), "recipes")
    chunk = rows.select("text_sha256", F.explode(F.arrays_zip("recipe", "digests")).alias("c")).select(
        "text_sha256", F.col("c.recipe").alias("print"), F.col("c.digests").alias("digest"))
    unclear = (chunk.groupBy("print").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
               .where("low <> high").select("print"))
    apart = stage(chunk.join(unclear, "print", "left_semi").select("text_sha256").distinct()
                  .withColumn("apart", F.col("text_sha256")), "apart")
    key = ["n_bytes", "recipe", "apart"]
    rows = rows.join(apart, "text_sha256", "left").select(
        "doc_id", "text_sha256", "n_bytes", "recipe", F.coalesce("apart", F.lit("")).alias("apart"), "row")
    # written, so that the join's two sides are plain exchanges and a hot group can be split
    groups = stage(rows.groupBy(*key).agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")), "groups")
    return rows.join(groups, key).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")
