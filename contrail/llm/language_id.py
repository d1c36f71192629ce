"""Language identification by compression: the language whose dictionary compresses a text best.

For each language a bounded sample of its training texts becomes a zstandard raw-content dictionary.
A text is cut into blocks; every block is compressed with every dictionary, and the language with the
smallest total wins. The margin to the second best, relative to the total, gives the score; narrow
margins are rejected.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import Batches

#: bounds of what is learned from: texts per language, characters of one text, bytes of a dictionary
SAMPLE_TEXTS = 64
SAMPLE_CHARS = 2048
DICTIONARY_BYTES = 64 * 1024
BLOCK = 4096
#: texts below so many bytes are compressed three times over: too short a text is stored as it is
SHORT = 200
#: margin (share of the winner's size) at which the score is 1, and the least score that is accepted
FULL_MARGIN = 0.10
ACCEPT = 0.05
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
_PARAMETERS = {"strategy": zstandard.STRATEGY_LAZY, "min_match": 4, "window_log": 18, "hash_log": 17, "chain_log": 17,
               "search_log": 4}


def normal(text: str) -> bytes:
    """The words of a text (letters only, lower case), one space apart."""
    return " ".join(_WORD.findall(text.lower())).encode()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Language -> dictionary content, from training rows only.

    Per language the SAMPLE_TEXTS distinct texts with the smallest hashes, the first SAMPLE_CHARS of
    each: a fixed bound per language however large the table (the per-language limit is applied
    in every task before anything is shuffled).
    """
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("h"), "text")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = rows.select("lang", "h").distinct().withColumn("rank", rank).where(F.col("rank") <= SAMPLE_TEXTS).select("lang", "h")
    # SAMPLE_TEXTS rows per language at most
    starts = rows.join(F.broadcast(chosen), ["lang", "h"]).select(
        "lang", "h", F.substring("text", 1, SAMPLE_CHARS).alias("start")).groupBy("lang", "h").agg(F.min("start").alias("start"))
    held: dict[str, list[bytes]] = {}
    for row in starts.orderBy("lang", F.desc("h")).collect():
        held.setdefault(row["lang"], []).append(normal(row["start"]))
    return {k: b" ".join(v)[-DICTIONARY_BYTES:] for k, v in sorted(held.items())}


@functools.lru_cache(maxsize=4)
def _coders(models: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    settings = zstandard.ZstdCompressionParameters(**_PARAMETERS)
    out = []
    for lang, content in models:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=settings)
        out.append((lang, zstandard.ZstdCompressor(dict_data=known, compression_params=settings)))
    return out


def classify(text: str | None, models: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """(language, score); ``und`` with score 0 for no text, no letter or no model."""
    if not text or not models or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    raw = normal(text)
    if len(raw) < SHORT:
        raw = (raw + b" ") * 3
    blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in _coders(models))
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], min(1.0, (sizes[1][0] - sizes[0][0]) / (FULL_MARGIN * sizes[0][0]))


def _predict(models):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [classify(t, models.value) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def languages(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, rejected.

    Learns from the text and non-NULL lang of documents with crc32(doc_id as text) mod 4 <> 2 only;
    predictions see the text only. ``und`` with score 0 if the text is NULL, has no letter, or there
    is nothing to learn from; ties go to the language that sorts first, with score 0. ``rejected``
    marks ``und`` and scores below ACCEPT. A row with a NULL doc_id is trained on and predicted.
    Whole texts are compressed, block by block. Repeated rows are predicted alike.
    """
    models = docs.sparkSession.sparkContext.broadcast(tuple(dictionaries(docs).items()))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predict(models), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                        ((F.col("lang_pred") == UNKNOWN) | (F.col("score") < ACCEPT)).alias("rejected"))


def accepted(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language is rejected; all columns as they were, no shuffle."""
    models = docs.sparkSession.sparkContext.broadcast(tuple(dictionaries(docs).items()))

    def sure(texts: pa.Array) -> pa.Array:
        found = [classify(t, models.value) for t in texts.to_pylist()]
        return pa.array([lang != UNKNOWN and score >= ACCEPT for lang, score in found], pa.bool_())

    return docs.where(F.arrow_udf(sure, "boolean")(F.col("text")))
