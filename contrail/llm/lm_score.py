"""Log-probability of documents under a byte model with prediction by partial matching (PPM).

Training counts every byte after its up to ORDER preceding ones over all training texts, as packed
(context, byte) keys that Spark sums; lower orders are sums of the highest. Scoring follows the
longest known context: a byte seen there has probability count / (total + kinds), the escape
kinds / (total + kinds), and bytes of the longer context are excluded in the shorter one. Since a
longer context's bytes always occur in its suffix, the exclusion is one subtraction per context,
precomputed with the model, and whole texts are scored with array operations.

What is learned grows with the input, what is broadcast does not: contexts seen at least 2^t times are
broadcast, with the smallest t that leaves at most MAX_ENTRIES keys per order. A context's shorter
contexts are at least as frequent, so a byte after a broadcast context is scored from the broadcast part
alone. All other bytes become distinct keys per text, which are joined by a shuffle with the counts of
the rarer contexts (fewer than 2^t symbols each); the score is the same for any bound. Word counts are
treated alike: the HEAD most frequent words are broadcast, all others are joined by a shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import Batches, id_text, longs, stage, text_bytes, word_hashes

ORDER = 5
MAX_ENTRIES = 1 << 21
HEAD = 1 << 18
_EDGE = 256  # symbol before and after a text
_BITS = 9
_SLICE = 1 << 21  # bytes counted or scored at once


def held_out(doc_id: Column) -> Column:
    """True for documents that are not trained on (NULL ids are trained on)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _keys(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context, symbol) of every byte and of each text's end, and their number per text."""
    lead = np.full(order, _EDGE, np.uint64)
    parts = []
    for t in texts:
        parts += [lead, np.frombuffer(t, np.uint8).astype(np.uint64), lead[:1] if order else np.full(1, _EDGE, np.uint64)]
    sym = np.concatenate(parts)
    n = len(sym) - order
    key = np.zeros(n, np.uint64)
    for k in range(order + 1):
        key = (key << np.uint64(_BITS)) | sym[k:k + n]
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes + order) - order  # windows of a text: its bytes and its end
    inside = np.zeros(n + order + 1, np.int8)
    np.add.at(inside, ends - sizes, 1)
    np.add.at(inside, ends, -1)
    return key[np.cumsum(inside[:n]) > 0], sizes


def _pieces(texts: list[bytes]):
    """Groups of whole texts of about _SLICE bytes (a longer text is a group of its own)."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > _SLICE:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def _count(order: int):
    def run(batches: Batches) -> Batches:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([c for _, c in held])).astype(np.int64)

        for batch in batches:
            for group in _pieces(text_bytes(batch)):
                held.append(np.unique(_keys(group, order)[0], return_counts=True))
                if len(held) == 8:
                    held = [merged()]
                    if len(held[0][0]) > 1 << 20:
                        yield pa.RecordBatch.from_arrays([longs(held[0][0]), pa.array(held[0][1])], ["key", "n"])
                        held = []
        if held:
            keys, counts = merged()
            yield pa.RecordBatch.from_arrays([longs(keys), pa.array(counts)], ["key", "n"])

    return run


def _words(batches: Batches) -> Batches:
    held = np.empty(0, np.uint64)
    counts = np.empty(0, np.int64)
    for batch in batches:
        for group in _pieces(text_bytes(batch)):
            new = word_hashes(b"\n".join(group).lower().split())
            keys, n = np.unique(new, return_counts=True)
            both, at = np.unique(np.concatenate([held, keys]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)
            held = both
            if len(held) > 1 << 20:
                yield pa.RecordBatch.from_arrays([longs(held), pa.array(counts)], ["word", "n"])
                held, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    yield pa.RecordBatch.from_arrays([longs(held), pa.array(counts)], ["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word: 64-bit hash, n) over the lower-cased words of all texts."""
    return id_text(docs).select("text").mapInArrow(_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(docs: DataFrame, order: int = ORDER, max_entries: int = MAX_ENTRIES) -> tuple[DataFrame, DataFrame | None]:
    """Counts per order k and packed (context of k symbols, symbol), in two parts.

    (k, key, n) of the frequent contexts, small enough to broadcast; and (k, context, total, kinds,
    less, symbols) of all others, where ``less`` is what the context's symbols count one order below and
    ``symbols`` maps each to its count. None if there are no others.
    """
    top = stage(id_text(docs).select("text").mapInArrow(_count(order), "key long, n long")
                .groupBy("key").agg(F.sum("n").alias("n")), "grams")
    levels = [top.select(F.lit(order).alias("k"), "key", "n")]
    for k in range(order - 1, -1, -1):
        levels.append(levels[-1].groupBy(F.col("key").bitwiseAND(F.lit((1 << _BITS * (k + 1)) - 1)).alias("key"))
                      .agg(F.sum("n").alias("n")).select(F.lit(k).alias("k"), "key", "n"))
    grams = levels[0]
    for level in levels[1:]:
        grams = grams.unionByName(level)
    contexts = F.shiftright("key", _BITS).alias("context")
    totals = grams.select("k", contexts, "n").groupBy("k", "context").agg(
        F.floor(F.log2(F.sum("n"))).cast("int").alias("size"), F.count("*").alias("entries"))
    by_size = totals.groupBy("k", "size").agg(F.sum("entries").alias("entries"))  # at most 64 sizes per order
    above = by_size.withColumn("kept", F.sum("entries").over(Window.partitionBy("k").orderBy(F.desc("size"))))
    least = above.where(F.col("kept") > max_entries).agg(F.coalesce(F.max("size") + 1, F.lit(0)).alias("least"))
    threshold = least.first()["least"]
    if threshold == 0:
        return grams, None
    grams, totals = stage(grams.withColumn("context", contexts), "gram_levels"), stage(totals, "gram_totals")
    head = grams.join(totals.where(F.col("size") >= threshold), ["k", "context"], "left_semi").select("k", "key", "n")
    below = grams.select((F.col("k") + 1).alias("k"), F.col("key").alias("shorter"), F.col("n").alias("below"))
    # at most 257 keys share a shorter one
    rare = (grams.join(totals.where(F.col("size") < threshold).select("k", "context"), ["k", "context"])
            .withColumn("shorter", F.col("key").bitwiseAND(F.expr(f"shiftleft(1L, {_BITS} * k) - 1")))
            .join(below, ["k", "shorter"], "left"))
    symbol = F.col("key").bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
    return head, stage(rare.groupBy("k", "context").agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.coalesce(F.sum("below"), F.lit(0)).alias("less"),
        F.map_from_entries(F.collect_list(F.struct(symbol, "n"))).alias("symbols")), "rare_contexts")


class Ppm:
    """Counts of all orders as sorted arrays, with the exclusions of every context worked out."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]):
        self.order = len(tables) - 1
        self.keys = [k for k, _ in tables]
        self.counts = [c.astype(np.float64) for _, c in tables]
        self.contexts, self.total, self.kinds, self.less, self.fewer = [], [], [], [], []
        for k, (keys, _) in enumerate(tables):
            context, start, kinds = np.unique(keys >> np.uint64(_BITS), return_index=True, return_counts=True)
            self.contexts.append(context)
            self.kinds.append(kinds.astype(np.float64))
            self.total.append(np.add.reduceat(self.counts[k], start) if len(keys) else np.empty(0))
            if k == 0 or not len(keys):  # order 0 has nothing below but the uniform level
                self.less.append(np.zeros(len(context)))
                continue
            shorter = keys & np.uint64((1 << _BITS * k) - 1)
            below = np.searchsorted(self.keys[k - 1], shorter)
            self.less.append(np.add.reduceat(self.counts[k - 1][below], start))
        top = self.order
        at = np.searchsorted(self.contexts[top], self.keys[top] >> np.uint64(_BITS))
        self.direct = np.log10(self.counts[top] / (self.total[top] + self.kinds[top])[at])
        self._index()

    def _index(self) -> None:
        """Open addressing over the highest order's keys."""
        keys = self.keys[self.order]
        self.bits = np.uint64(64 - max(4, (2 * len(keys)).bit_length()))
        self.slots = np.full(1 << (64 - int(self.bits)), -1, np.int32)
        left, spot = np.arange(len(keys), dtype=np.int32), self._spot(keys)
        while len(left):
            free = self.slots[spot] < 0
            self.slots[spot[free]] = left[free]  # the last of those that want one slot gets it
            lost = self.slots[spot] != left
            left, spot = left[lost], (spot[lost] + 1) & (len(self.slots) - 1)

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.bits).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions of highest-order keys, -1 where not known."""
        spot = self._spot(keys)
        out = self.slots[spot].astype(np.int64)
        if not len(self.keys[self.order]):
            return out
        look = np.flatnonzero((out >= 0) & (self.keys[self.order][out] != keys))
        while len(look):
            spot[look] = (spot[look] + 1) & (len(self.slots) - 1)
            out[look] = self.slots[spot[look]]
            look = look[(out[look] >= 0) & (self.keys[self.order][out[look]] != keys[look])]
        return out

    def _look(self, k: int, key: np.ndarray) -> tuple[np.ndarray, ...]:
        """Total, kinds and exclusion of each key's context and the key's count; zeros where not known."""
        if not len(self.keys[k]):
            return tuple(np.zeros(len(key)) for _ in range(4))
        context = key >> np.uint64(_BITS)
        at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
        known = self.contexts[k][at] == context
        entry = np.minimum(np.searchsorted(self.keys[k], key), len(self.keys[k]) - 1)
        return (self.total[k][at] * known, self.kinds[k][at] * known, self.less[k][at] * known,
                self.counts[k][entry] * (self.keys[k][entry] == key))

    def reach(self, keys: np.ndarray) -> np.ndarray:
        """Highest order whose context is known, -1 if none."""
        out = np.full(len(keys), -1)
        for k in range(self.order + 1):
            if len(self.contexts[k]):
                context = (keys & np.uint64((1 << _BITS * (k + 1)) - 1)) >> np.uint64(_BITS)
                at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
                out[self.contexts[k][at] == context] = k
        return out

    def escaped(self, keys: np.ndarray, rare: list[tuple[np.ndarray, ...]] | None = None) -> np.ndarray:
        """log10 probability of keys through escapes, from the highest order down, with exclusion.

        ``rare``: per order what :meth:`_look` gives, for contexts that the model does not hold.
        """
        out = np.zeros(len(keys))
        open_ = np.arange(len(keys))
        less, fewer = np.zeros(len(keys)), np.zeros(len(keys))  # counts and kinds excluded by the level above
        for k in range(self.order, -1, -1):
            total, kinds, below, count = self._look(k, keys[open_] & np.uint64((1 << _BITS * (k + 1)) - 1))
            if rare is not None:
                total, kinds, below, count = (
                    np.where(kinds > 0, own, other[open_]) for own, other in zip((total, kinds, below, count), rare[k], strict=True))
            known = kinds > 0
            total, left = total - less[open_], kinds - fewer[open_]
            live = known & (left > 0)
            hit = live & (count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                found = np.log10(count / (total + left))
                escape = np.log10(left / (total + left))
            out[open_[hit]] += found[hit]
            gone = live & ~hit
            out[open_[gone]] += escape[gone]
            # the level below loses this context's bytes (all of them, with what they count there)
            less[open_[known]] = below[known]
            fewer[open_[known]] = kinds[known]
            open_ = open_[~hit]
        out[open_] -= np.log10(np.maximum(_EDGE + 1 - fewer[open_], 1))
        return out

    def rare(self, keys: np.ndarray) -> np.ndarray:
        """Which keys have a longest context that the model does not hold."""
        contexts, wanted = self.contexts[self.order], keys >> np.uint64(_BITS)
        if not len(contexts):
            return np.ones(len(keys), bool)
        return contexts[np.minimum(np.searchsorted(contexts, wanted), len(contexts) - 1)] != wanted

    def missed(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of a text that :meth:`rare` holds for, and how often each occurs."""
        keys = _keys([text], self.order)[0]
        keys, times = np.unique(keys[self.find(keys) < 0], return_counts=True)
        rare = self.rare(keys)
        return keys[rare], times[rare]

    def score(self, texts: list[bytes], whole: bool = True) -> np.ndarray:
        """log10 probability of each text with its end; without its rare keys if the model is not ``whole``."""
        keys, sizes = _keys(texts, self.order)
        at = self.find(keys)
        logs = self.direct[at] if len(self.direct) else np.zeros(len(keys))
        miss = np.flatnonzero(at < 0)
        if len(miss):
            kinds, back = np.unique(keys[miss], return_inverse=True)
            found = self.escaped(kinds)
            if not whole:
                found[self.rare(kinds)] = 0.0
            logs[miss] = found[back]
        return np.add.reduceat(logs, np.cumsum(sizes) - sizes)


def _text_key(text: bytes) -> bytes:
    return hashlib.md5(text, usedforsecurity=False).digest()


def _head(sums, hashes: np.ndarray):
    """Positions of hashes in the broadcast head, and which are in it."""
    words, _ = sums
    if not len(words):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return at, words[at] == hashes


def _score(model, head, whole):
    cache = {}

    def run(batches: Batches) -> Batches:
        if "ppm" not in cache:
            cache["ppm"] = Ppm(model.value)
        for batch in batches:
            texts = text_bytes(batch)
            scores = [cache["ppm"].score(group, whole) for group in _pieces(texts)]
            words, known, base, keys = [], [], [], []
            for t in texts:
                hashes = word_hashes(t.lower().split())
                at, inside = _head(head.value, hashes)
                words.append(len(hashes))
                known.append(int(inside.sum()))
                base.append(float(head.value[1][at[inside]].sum()))
                keys.append(_text_key(t))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(words, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(np.concatenate([*scores, np.empty(0)]))],
                ["doc_id", "text_key", "words", "head_known", "head_sum", "score"])

    return run


def _tail(head):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            seen, rows, n, keys = set(), [], [], []
            for t in text_bytes(batch):
                key = _text_key(t)
                if key in seen:
                    continue
                seen.add(key)
                hashes = word_hashes(t.lower().split())
                kinds, count = np.unique(hashes[~_head(head.value, hashes)[1]], return_counts=True)
                rows.append(kinds)
                n.append(count)
                keys += [key] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), longs(np.concatenate([*rows, np.empty(0, np.uint64)])),
                 pa.array(np.concatenate([*n, np.empty(0, np.int64)]))], ["text_key", "word", "times"])

    return run


def _missed(model):
    def run(batches: Batches) -> Batches:
        ppm = Ppm(model.value)
        for batch in batches:
            for t in set(text_bytes(batch)):
                keys, times = ppm.missed(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_text_key(t)] * len(keys), pa.binary()), longs(keys), pa.array(times.astype(np.int64))],
                    ["text_key", "key", "times"])

    return run


def _contexts(model):
    """Every context of a key, longest first, down to the first that the model holds."""
    def run(batches: Batches) -> Batches:
        ppm = Ppm(model.value)
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            reach = ppm.reach(keys)
            for k in range(ppm.order + 1):
                at = keys[reach < k]
                context = (at & np.uint64((1 << _BITS * (k + 1)) - 1)) >> np.uint64(_BITS)
                yield pa.RecordBatch.from_arrays([longs(at), pa.array(np.full(len(at), k, np.int32)), longs(context)],
                                                 ["key", "k", "context"])

    return run


_STATS = ("total", "kinds", "less", "n")


def _finish(model):
    def run(batches: Batches) -> Batches:
        ppm = Ppm(model.value)
        for batch in batches:
            rare = [tuple(batch.column(f"{c}_{k}").to_numpy(zero_copy_only=False).astype(np.float64) for c in _STATS)
                    for k in range(ppm.order + 1)]
            logs = ppm.escaped(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64), rare)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(logs)], ["key", "log"])

    return run


def _rare_sums(base: DataFrame, model, rare_contexts: DataFrame, order: int) -> DataFrame:
    """(text_key, rare_sum): log10 probability of each text's keys that the broadcast part does not score."""
    # a text may come from several tasks: keep one of its equal rows
    found = stage(base.select("text").mapInArrow(_missed(model), "text_key binary, key long, times long")
                  .groupBy("text_key", "key").agg(F.max("times").alias("times")), "missed")
    chain = found.select("key").distinct().mapInArrow(_contexts(model), "key long, k int, context long")
    count = F.get(F.map_values(F.map_filter("symbols", lambda s, n: s == F.col("key").bitwiseAND(F.lit((1 << _BITS) - 1)))), F.lit(0))
    chain = chain.join(rare_contexts, ["k", "context"], "left").withColumn("n", count)
    per_key = chain.groupBy("key").agg(*(
        F.coalesce(F.max(F.when(F.col("k") == k, F.col(c))), F.lit(0)).cast("long").alias(f"{c}_{k}")
        for k in range(order + 1) for c in _STATS))
    logs = per_key.mapInArrow(_finish(model), "key long, log double")
    return found.join(logs, "key").groupBy("text_key").agg(F.sum(F.col("times") * F.col("log")).alias("rare_sum"))


def ppm_scores(docs: DataFrame, order: int = ORDER, max_entries: int = MAX_ENTRIES, head: int = HEAD) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is log10 of the probability of the text's bytes and its end; ``base_score`` that of its
    lower-cased words and one end token under add-a-half word counts. Both learn from the
    documents with crc32(doc_id as text) mod 5 <> 1. A NULL text is empty: one token, the end. A
    row with a NULL doc_id is trained on. Repeated rows count as often as they occur. With nothing
    to train on, bytes are uniform over 257 symbols. Extra columns are not read.
    """
    spark = docs.sparkSession
    base = id_text(docs)
    train = base.where(~held_out(F.col("doc_id")))

    frequent, rare_contexts = gram_counts(train, order, max_entries)
    grams = frequent.toArrow()
    k, key, n = (grams.column(c).to_numpy() for c in ("k", "key", "n"))
    tables = []
    for level in range(order + 1):
        keys, counts = key[k == level].view(np.uint64), n[k == level]
        by = np.argsort(keys)
        tables.append((keys[by], counts[by]))
    model = spark.sparkContext.broadcast(tables)

    vocabulary = stage(word_counts(train), "words")
    sums = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = train.count()
    tokens, kinds = sums["n"] + ends, sums["v"] + (1 if ends else 0)
    spread = tokens + 0.5 * (kinds + 1)
    top = vocabulary.orderBy(F.desc("n"), "word").limit(head).toArrow()
    words, counts = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    by = np.argsort(words)
    common = spark.sparkContext.broadcast((words[by], np.log10(counts[by] + 0.5)))

    rows = base.mapInArrow(
        _score(model, common, rare_contexts is None),
        "doc_id long, text_key binary, words long, head_known long, head_sum double, score double")
    tail = base.select("text").mapInArrow(_tail(common), "text_key binary, word long, times long")
    # a text may come from several tasks: keep one of its equal rows
    tail = (tail.groupBy("text_key", "word").agg(F.max("times").alias("times"))
            .join(vocabulary, "word", "left").groupBy("text_key").agg(
                F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail_sum"),
                F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known")))
    if rare_contexts is not None:
        rows = rows.join(_rare_sums(base, model, rare_contexts, order), "text_key", "left").withColumn(
            "score", F.col("score") + F.coalesce("rare_sum", F.lit(0.0))).drop("rare_sum")
    log_end, log_all = float(np.log10(ends + 0.5)), float(np.log10(spread))
    return rows.join(tail, "text_key", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), (F.col("words") + 1).alias("n_tokens"),
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) + F.lit(log_end) - (F.col("words") + 1) * F.lit(log_all))
        .alias("base_score"), "score")
