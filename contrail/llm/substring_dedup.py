"""Repeated passages by difference-cover anchors.

A difference cover D modulo P has, for any two offsets, a common shift below P that takes both
into D. So if a window of ``size`` words occurs at two places, both places share an anchor: a run of
size - P + 1 words that starts at a position whose remainder modulo P is in D, at the same shift.
Only those positions (6 of 31) are hashed and shuffled. Places that share an anchor with another
text are extended: every ``size``-word window around them is hashed and judged against the
smallest document that holds it. All steps are grouped minima and equi-joins, linear in the rows.

Texts with the same words are one text for the search; later copies are covered whole.
Windows are compared by 64-bit hashes of 64-bit word hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import Batches, id_text, longs, stage, text_bytes, window_hashes, word_hashes

WINDOW = 50
#: fixed values: perfect difference sets, period -> remainders
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18)}


def cover(size: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of at least a third of the window."""
    period = max(p for p in COVERS if p <= max(1, size - size // 3))
    return period, COVERS[period]


def _key(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _short(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _texts(batches: Batches) -> Batches:
    for batch in batches:
        sizes, keys, short, kept = [], [], [], []
        for text in text_bytes(batch):
            words = text.split()
            sizes.append(len(words))
            keys.append(_key(word_hashes(words)))
            short.append(_short(keys[-1]))
            kept.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(short, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "words_id", "text_key", "whole_sha256"])


def _anchors(size: int):
    period, remainders = cover(size)
    length = size - period + 1

    def run(batches: Batches) -> Batches:
        for batch in batches:
            seen, hashes, keys, at = set(), [], [], []
            for text in text_bytes(batch):
                words = word_hashes(text.split())
                if len(words) < size:
                    continue
                key = _short(_key(words))
                if key in seen:
                    continue
                seen.add(key)
                runs = window_hashes(words, length)
                spots = np.flatnonzero(np.isin(np.arange(len(runs)) % period, remainders))
                hashes.append(runs[spots])
                at.append(spots)
                keys.append(np.full(len(spots), key, np.int64))
                if sum(map(len, at)) > 1 << 19:
                    yield _rows(hashes, keys, at)
                    hashes, keys, at = [], [], []
            if at:
                yield _rows(hashes, keys, at)

    return run


def _rows(hashes: list, keys: list, at: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [longs(np.concatenate(hashes)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(at).astype(np.int32))],
        ["hash", "text_key", "at"])


def _windows(size: int):
    period, _ = cover(size)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for doc, key, text, at in zip(batch.column("doc_id").to_pylist(), batch.column("words_id").to_pylist(),
                                          text_bytes(batch), batch.column("at"), strict=True):
                runs = window_hashes(word_hashes(text.split()), size)
                near = np.zeros(len(runs) + 1, np.int32)  # windows that hold one of the anchors
                spots = np.asarray(at.values)
                np.add.at(near, np.clip(spots - period + 1, 0, len(runs)), 1)
                np.add.at(near, np.minimum(spots + 1, len(runs)), -1)
                found = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                yield pa.RecordBatch.from_arrays(
                    [longs(runs[found]), pa.array([doc] * len(found), pa.int64()),
                     pa.array([key] * len(found), pa.binary()), pa.array(found.astype(np.int32))],
                    ["hash", "doc_id", "words_id", "at"])

    return run


def _strip(size: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            removed, kept, texts = [], [], []
            for text, at in zip(text_bytes(batch), batch.column("at"), strict=True):
                words = text.split()
                depth = np.zeros(len(words) + 1, np.int32)
                spots = np.asarray(at.values)
                np.add.at(depth, spots, 1)
                np.add.at(depth, spots + size, -1)
                gone = np.cumsum(depth[:-1]) > 0
                left = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                removed.append(int(gone.sum()))
                kept.append(hashlib.sha256(left).hexdigest())
                texts.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("words_id"), pa.array(removed, pa.int64()), pa.array(kept),
                 pa.array(texts)], ["doc_id", "words_id", "removed", "left_sha256", "kept_text"])

    return run


def repeated_passages(docs: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(all texts, texts that lose some of their words).

    The first table has a row per input row: doc_id, n_words, words_id, whole_sha256 and ``first``,
    the smallest doc_id with the same words. The second has doc_id, words_id, removed,
    left_sha256 and kept_text for texts (first copies only) with at least one covered word.
    """
    base = id_text(docs)
    rows = stage(base.mapInArrow(_texts, "doc_id long, n_words long, words_id binary, text_key long, whole_sha256 string"), "texts")
    firsts = stage(rows.groupBy("words_id", "text_key").agg(F.min("doc_id").alias("first")).where("first is not null"), "firsts")

    schema = "hash long, text_key long, at int"
    shared = base.mapInArrow(_anchors(size), schema).groupBy("hash").agg(
        F.min("text_key").alias("low"), F.max("text_key").alias("high")).where("low < high").select("hash")
    spots = base.mapInArrow(_anchors(size), schema).join(shared, "hash", "left_semi").select("text_key", "at").distinct()
    # one text's anchor positions: bounded by its length
    by_text = stage(spots.groupBy("text_key").agg(F.collect_list("at").alias("at")), "spots")

    keyed = firsts.withColumnRenamed("first", "doc_id").join(by_text, "text_key")
    texts = base.join(keyed.select("doc_id", "words_id", "at"), "doc_id")
    # a repeated doc_id may have other texts: only the text whose words these are
    texts = stage(texts.mapInArrow(_own, "doc_id long, words_id binary, text string, at array<int>"), "candidates")

    windows = stage(texts.mapInArrow(_windows(size), "hash long, doc_id long, words_id binary, at int"), "windows")
    owner = windows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where(
        "low < high").select("hash", "low")
    later = windows.join(owner, "hash").where("doc_id > low").select("doc_id", "words_id", "at").distinct()
    later = later.groupBy("doc_id", "words_id").agg(F.collect_list("at").alias("at"))
    cut = texts.drop("at").join(later, ["doc_id", "words_id"]).mapInArrow(
        _strip(size), "doc_id long, words_id binary, removed long, left_sha256 string, kept_text string")
    return rows.join(firsts.drop("text_key"), "words_id", "left"), cut


def _own(batches: Batches) -> Batches:
    for batch in batches:
        same = [_key(word_hashes(t.split())) == k
                for t, k in zip(text_bytes(batch), batch.column("words_id").to_pylist(), strict=True)]
        yield batch.select(["doc_id", "words_id", "text", "at"]).filter(pa.array(same, pa.bool_()))


def strip_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space).

    A word is removed if a window of ``size`` words of its document covers it and the same window
    starts in a document with a smaller doc_id; windows are judged on the input. NULL and empty
    texts have no words. Texts shorter than the window lose nothing. Rows that repeat a doc_id are
    one document: they never remove each other's words. A row with a NULL doc_id neither loses
    words nor makes others lose theirs. An empty table gives an empty result.
    """
    rows, cut = repeated_passages(docs, size)
    cut = cut.select("doc_id", "words_id", "removed", "left_sha256").dropDuplicates(["doc_id", "words_id"])
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= size)
    return rows.join(cut, ["doc_id", "words_id"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("left_sha256", "whole_sha256")).alias("kept_sha256"))
