"""The best documents of every query text by an exact integer BM25, found by best-first search over document intervals.

Documents are cut into segments of consecutive rows. A segment holds one posting list per query term, ordered by
document, with the term's exact contribution ("impact") to each document's score and a sparse table that
gives the largest impact of any stretch of the list in two look-ups. A query starts with the whole segment as
one interval. The sum of its terms' range maxima bounds the score of every document of an interval; the intervals
with the largest bounds are split at the document of the largest impact, which is scored exactly, and an
interval whose bound cannot reach the best ``k`` any more is dropped. What a task has found bounds its later segments.

No postings are shuffled: a segment is indexed in the task that reads it, and a task sends at most ``k``
rows per query.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import Batches, discard, list_of_longs, stage, text_bytes

#: results of a query
TOP = 50
#: characters of query text that are searched for at a time (their terms are broadcast); one longer query stands alone
BLOCK_CHARS = 2_000_000
#: documents and postings of a segment
SEGMENT_DOCS, SEGMENT_POSTINGS = 8192, 1 << 20
#: intervals that are split at a time: the first round, the largest round, and cells (intervals x terms) of a round
FIRST_SPLITS, MOST_SPLITS, ROUND_CELLS = 16, 256, 1 << 20
#: bytes of a text that are split into terms at a time
TEXT_BYTES = 8 << 20
#: groups into which a query's candidates are dealt for the first of the two rankings
SALTS = 64

#: bytes of terms (ASCII letters and digits, all that is not ASCII), lower-cased; others become a blank
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a UTF-8 text."""
    text = text.translate(_TERM_BYTES)
    if len(text) <= TEXT_BYTES:
        return Counter(text.split())
    out, at = Counter(), 0
    while at < len(text):
        end = text.find(b" ", at + TEXT_BYTES)
        end = len(text) if end < 0 else end
        out.update(text[at:end].split())
        at = end
    return out


def _query_terms(batches: Batches) -> Batches:
    for batch in batches:
        terms = [sorted(term_counts(t)) for t in text_bytes(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch["item"], batch["item_id"], pa.array([[t.decode() for t in ts] for ts in terms], pa.list_(pa.string())),
             pa.array([sum(len(t) + 1 for t in ts) for ts in terms], pa.int64())], ["item", "item_id", "terms", "size"])


def _hits(vocabulary):
    """Per document with a term: its length and the counts of the query terms that it holds."""
    def run(batches: Batches) -> Batches:
        codes = vocabulary.value
        for batch in batches:
            keep, size, terms, counts = [], [], [], []
            for row, text in enumerate(text_bytes(batch)):
                found = term_counts(text)
                if not found:
                    continue
                hits = [(code, n) for t, n in found.items() if (code := codes.get(t)) is not None]
                keep.append(row)
                size.append(found.total())
                terms.append(np.fromiter((c for c, _ in hits), np.int64, len(hits)))
                counts.append(np.fromiter((n for _, n in hits), np.int64, len(hits)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(keep, pa.int64())), pa.array(size, pa.int64()), list_of_longs(terms).cast(pa.list_(pa.int32())),
                 list_of_longs(counts)], ["doc_id", "n", "terms", "counts"])

    return run


class Segment:
    """Posting lists of some documents, with range maxima.

    ``key`` is term * documents + place, in order, so a list is a slice and a document's posting is one binary search away.
    ``best[j][i]`` is the posting of the largest impact (the first of several) among the 2^j from ``i`` on; stretches
    that reach into the next list are never asked for.
    """

    def __init__(self, ids: np.ndarray, null: np.ndarray, length: np.ndarray, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray,
                 weights: np.ndarray, documents: int, total: int):
        order = np.lexsort((ids, null))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.null, self.size = ids[order], null[order], len(ids)
        wide = 50 * int(length.max(initial=0)) * documents >= 1 << 63  # beyond 64 bits: Python's whole numbers
        norm = (50 + (50 * (length.astype(object) if wide else length) * documents) // max(total, 1)).astype(np.int64)
        owner = np.repeat(np.arange(len(ids)), sizes)
        impact = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * norm[owner]))
        some = impact > 0
        key = (terms * self.size + place[owner])[some]
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.impact = np.append(impact[some][order], 0)  # the last one stands for "no posting"
        self.starts = np.searchsorted(self.key, np.arange(len(weights) + 1) * self.size)
        longest = int(np.diff(self.starts).max(initial=1))
        self.best = [np.arange(len(self.key), dtype=np.int32)]
        while 2 << (len(self.best) - 1) <= longest:
            half, last = 1 << (len(self.best) - 1), self.best[-1]
            left, right = last[:len(last) - half], last[half:]
            self.best.append(np.where(self.impact[right] > self.impact[left], right, left))
        width = max(len(self.key), 1)
        self.best = np.stack([np.pad(b, (0, width - len(b))) for b in self.best]) if len(self.key) else np.zeros((1, 1), np.int32)
        self.level = np.frombuffer(bytes([0] + [n.bit_length() - 1 for n in range(1, longest + 1)]), np.uint8)

    def maxima(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For stretches [low, high) of posting lists, an interval per row: the interval's bound, and its posting of the largest impact."""
        length = high - low
        level = self.level[length]
        some = length > 0
        left = self.best[level, np.where(some, low, 0)]
        right = self.best[level, np.where(some, high - (1 << level.astype(np.int64)), 0)]
        top = np.where(self.impact[right] > self.impact[left], right, left)
        top = np.where(some, top, len(self.key))
        value = self.impact[top]
        return value.sum(axis=1), top[np.arange(len(top)), value.argmax(axis=1)]

    def search(self, terms: np.ndarray, k: int, found: tuple) -> tuple:
        """(scores, ids, null flags) of the best ``k`` of ``found`` and this segment."""
        terms = terms[self.starts[terms + 1] > self.starts[terms]]
        if not len(terms):
            return found
        low, high = self.starts[terms][None, :], self.starts[terms + 1][None, :]
        bound, split = self.maxima(low, high)
        first = np.zeros(1, np.int64)
        step, most = FIRST_SPLITS, max(1, min(MOST_SPLITS, ROUND_CELLS // len(terms)))
        while len(bound):
            keep = bound > 0
            if len(found[0]) >= k:  # equal scores: the smaller doc_id stays
                keep = (bound > found[0][-1]) | ((bound == found[0][-1]) & (self.ids[first] <= found[1][-1]))
            if not keep.all():
                bound, split, low, high, first = bound[keep], split[keep], low[keep], high[keep], first[keep]
            if not len(bound):
                break
            step = min(step, most)
            now = np.argpartition(-bound, step)[:step] if len(bound) > step else np.arange(len(bound))
            later = np.ones(len(bound), bool)
            later[now] = False
            place = self.key[split[now]] % self.size
            at = np.searchsorted(self.key, terms[None, :] * self.size + place[:, None])
            here = at < high[now]
            here[here] = self.key[at[here]] == (terms[None, :] * self.size + place[:, None])[here]
            score = np.where(here, self.impact[at], 0).sum(axis=1)
            found = best_of(k, *(np.concatenate(x) for x in zip(found, (score, self.ids[place], self.null[place]))))
            lows, highs = np.concatenate([low[now], at + here]), np.concatenate([at, high[now]])
            firsts = np.concatenate([first[now], np.minimum(place + 1, self.size - 1)])
            bounds, splits = self.maxima(lows, highs)
            bound, split = np.concatenate([bound[later], bounds]), np.concatenate([split[later], splits])
            low, high = np.concatenate([low[later], lows]), np.concatenate([high[later], highs])
            first = np.concatenate([first[later], firsts])
            step *= 2
        return found


def best_of(k: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> tuple:
    order = np.lexsort((null, ids, -score))[:k]
    return score[order], ids[order], null[order]


_NONE = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))


def _segments(batches: Batches):
    """The task's documents in segments: lists of record batches."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        while batch.num_rows:
            ends = np.asarray(batch["terms"].offsets, dtype=np.int64)
            ends = ends[1:] - ends[0]
            room = max(1 if not held else 0, min(SEGMENT_DOCS - docs, int(np.searchsorted(ends, SEGMENT_POSTINGS - postings, "right"))))
            part = batch.slice(0, room)
            if part.num_rows:
                held.append(part)
                docs, postings = docs + part.num_rows, postings + int(ends[part.num_rows - 1])
            if part.num_rows < batch.num_rows:
                yield held
                held, docs, postings = [], 0, 0
            batch = batch.slice(room)
    if held:
        yield held


def _search(queries, k: int):
    """The task's best ``k`` documents of each query."""
    def run(batches: Batches) -> Batches:
        items, weights, documents, total = queries.value
        found = [_NONE] * len(items)
        for held in _segments(batches):
            table = pa.Table.from_batches(held).combine_chunks()
            terms, counts = (pa.concat_arrays([b[c].flatten() for b in held]) for c in ("terms", "counts"))
            sizes = np.concatenate([np.diff(np.asarray(b["terms"].offsets, dtype=np.int64)) for b in held])
            null = np.asarray(table["doc_id"].is_null(), dtype=bool)
            ids = np.asarray(table["doc_id"].fill_null(np.iinfo(np.int64).max), dtype=np.int64)
            segment = Segment(ids, null, np.asarray(table["n"], dtype=np.int64), np.asarray(terms, dtype=np.int64), np.asarray(counts, dtype=np.int64), sizes,
                              weights, documents, total)
            found = [segment.search(codes, k, f) for (_, _, codes), f in zip(items, found)]
        for (item, item_id, _), (score, ids, null) in zip(items, found):
            if len(score):
                n = len(score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * n, pa.int64()), pa.array([item_id] * n, pa.int64()), pa.array(ids, pa.int64(), mask=null), pa.array(score, pa.int64())],
                    ["item", "item_id", "doc_id", "score"])

    return run


def _blocks(items: DataFrame, block_chars: int) -> int:
    """Into how many hash blocks the queries go, so that a block has at most ``block_chars`` characters of terms or is one query."""
    blocks = 1
    while items.groupBy(F.expr(f"pmod(xxhash64(item), {blocks})")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).where(
            (F.col("size") > block_chars) & (F.col("n") > 1)).limit(1).count():
        blocks *= 2
    return blocks


def ranked(docs: DataFrame, queries: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (score above 0) of each row of ``queries`` (item_id, text).

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A term's weight is
    floor(1000 ln((2N + 2) / (2 df + 1))), its impact on a document weight * ((10^9 tf) div (1000 tf + 20 m)) with
    m = 50 + (50 n N) div L; a score sums the impacts of the query's distinct terms. Equal scores go by doc_id.

    Queries are searched for in blocks (``block_chars``), each against all documents. A NULL, empty or term-free text, of a
    query or a document, takes no part. Every row of ``queries`` is ranked for itself, also when its item_id is NULL or
    repeated; documents with repeated ids are ranked each, a NULL doc_id stands behind all others of its score.
    Empty tables give no rows. Further columns are not read.
    """
    spark = docs.sparkSession
    texts = queries.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"),
                           F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = stage(texts.mapInArrow(_query_terms, "item long, item_id long, terms array<string>, size long").where("size > 0"), "search-items")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    blocks = _blocks(items, block_chars)
    best, held = None, []
    for block in range(blocks):
        rows = [(r.item, r.item_id, r.terms) for r in items.where(F.expr(f"pmod(xxhash64(item), {blocks})") == block).collect()]
        found = stage(_candidates(texts, rows, k, held), "search-found")
        discard(spark, held)
        best = found if best is None else best.unionByName(found)
    # two rankings: the candidates of one query come from every task
    part = Window.partitionBy("item", "salt").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    last = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("salt", F.expr(f"pmod(xxhash64(doc_id, score), {SALTS})")).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    return best.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _candidates(texts: DataFrame, rows: list[tuple], k: int, held: list[str]) -> DataFrame:
    """(item, item_id, doc_id, score) of one block of queries: the best ``k`` of every task. ``held``: what :func:`discard` may delete after."""
    spark = texts.sparkSession
    codes = {t.encode(): i for i, t in enumerate(sorted({t for _, _, terms in rows for t in terms}))}
    vocabulary = spark.sparkContext.broadcast(codes)
    hits = stage(texts.mapInArrow(_hits(vocabulary), "doc_id long, n long, terms array<int>, counts array<long>"), "search-hits", held)
    documents, total = hits.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(codes), np.int64)
    for r in hits.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # at most a block's terms
        df[r["term"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    coded = [(item, item_id, np.array(sorted(codes[t.encode()] for t in terms), np.int64)) for item, item_id, terms in rows]
    sent = spark.sparkContext.broadcast((coded, weights, documents, total))
    return hits.mapInArrow(_search(sent, k), "item long, item_id long, doc_id long, score long")
