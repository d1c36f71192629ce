"""Benchmark passages in documents, with up to a share of edits, by pigeonhole pieces and Myers distance.

An item with an error budget of e edits is cut into e + 1 pieces. In any text that holds the item with at
most e edits at least one piece is untouched, so exact piece hits (one Aho-Corasick pass over the
whole text) find every candidate place. Around each hit, Myers' bit-parallel algorithm computes
the smallest edit distance of the item to any substring.

Texts and items are compared lower-cased with white space collapsed. The benchmark is read in
blocks of bounded size, each broadcast until its pass over the documents is written, so the driver and
the executors hold one block at a time; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import Batches, discard, stage

#: one edit per so many characters of an item
CHARS_PER_EDIT = 20
#: characters of benchmark text that are broadcast at once
BLOCK_CHARS = 16_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str, chars_per_edit: int) -> int:
    return len(item) // chars_per_edit


def myers(item: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to a substring of ``text``, and the end of the first such substring."""
    m = len(item)
    if m == 0:
        return 0, 0
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | minus
        d = ((((eq & plus) + plus) ^ plus) | eq) & full
        hp = minus | (full & ~(d | plus))
        hm = plus & d
        if hp & high:
            score += 1
        elif hm & high:
            score -= 1
        hp = (hp << 1) & full
        hm = (hm << 1) & full
        plus = (hm | (full & ~(x | hp)))
        minus = hp & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Finder:
    """All items of a block: an automaton over their pieces."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int):
        self.items = [(i, normal(t)) for i, t in items if normal(t)]
        self.edits = [budget(t, chars_per_edit) for _, t in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(self.items):
            parts = self.edits[k] + 1
            for p in range(parts):
                a, b = len(text) * p // parts, len(text) * (p + 1) // parts
                places.setdefault(text[a:b], []).append((k, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item_id, edits, end in the normalised text) of each item within its budget; the best place of each."""
        if not self.items:
            return
        text = normal(text)
        spans: dict[int, list[tuple[int, int]]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for k, at in where:
                start = end + 1 - length - at
                spans.setdefault(k, []).append((start - self.edits[k], start + len(self.items[k][1]) + self.edits[k]))
        for k, found in spans.items():
            item, best = self.items[k][1], None
            found.sort()
            low, high = found[0]
            merged = []
            for a, b in found[1:]:
                if a <= high:
                    high = max(high, b)
                else:
                    merged.append((low, high))
                    low, high = a, b
            merged.append((low, high))
            for a, b in merged:
                a = max(a, 0)
                window = text[a:b]
                exact = window.find(item)
                distance, end = (0, exact + len(item)) if exact >= 0 else myers(item, window)
                if distance <= self.edits[k] and (best is None or distance < best[0]):
                    best = distance, a + end
                if best and best[0] == 0:
                    break
            if best:
                yield self.items[k][0], *best


def blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of at most ``block_chars`` characters (a longer item is a block of its own)."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "text is not null").toLocalIterator(prefetchPartitions=False)
    for row in rows:
        if held and size + len(row["text"]) > block_chars:
            yield held
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if held:
        yield held


def _matches(sent):
    cache = {}

    def run(batches: Batches) -> Batches:
        if "finder" not in cache:
            cache["finder"] = Finder(*sent.value)
        for batch in batches:
            rows = [(d, *found) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    if t for found in cache["finder"].find(t)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("doc_id", "item_id", "edits", "end"), r, strict=True)) for r in rows],
                pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("end", pa.int64())]))

    return run


def matches(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, edits, end: each document and item that it holds within len // chars_per_edit edits.

    Rows only for contaminated documents, one per (row, item): the best place, its end counted in
    the normalised text. Lengths are those of the normalised item. Items with a NULL or blank text and NULL or
    empty texts match nothing; an item with a NULL item_id is reported with a NULL; items that are equal match alike. Repeated rows are reported as often
    as they occur, rows with a NULL doc_id with a NULL. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, edits int, end long"
    out = spark.createDataFrame([], schema)
    for items in blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast((items, chars_per_edit))
        out = out.unionByName(stage(source.mapInArrow(_matches(sent), schema), "matches"))
        sent.destroy()
    return out


def clean(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns as they were, no shuffle.

    Items are held as :func:`matches` finds them. NULL and empty texts hold none and stay, as do rows with a NULL
    doc_id; of repeated rows all go or all stay. An empty benchmark takes nothing away, an empty table stays
    empty. Of a benchmark of several blocks, what each block but the last leaves is written.
    """
    spark = docs.sparkSession
    held: list[str] = []
    sent = None
    for items in blocks(benchmark, block_chars):
        if sent is not None:  # write what the block before leaves, so that its broadcast can go
            before = held[-1:]
            docs = stage(docs, "clean", held)
            sent.destroy()
            discard(spark, before)
        sent = spark.sparkContext.broadcast((items, chars_per_edit))
        docs = docs.where(~F.arrow_udf(_holds(sent), "boolean")(F.col("text")))
    return docs


def _holds(sent):
    cache = {}

    def run(texts: pa.Array) -> pa.Array:
        if "finder" not in cache:
            cache["finder"] = Finder(*sent.value)
        return pa.array([bool(t) and any(True for _ in cache["finder"].find(t)) for t in texts.to_pylist()], pa.bool_())

    return run
