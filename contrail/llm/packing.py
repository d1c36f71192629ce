"""Packing documents into as few token sequences as possible: dominance reduction, then best fit.

Which document goes where depends on lengths only, so the instance is the histogram of piece lengths:
at most ``size`` numbers, whatever the number of documents. The driver solves that histogram
(:func:`solve`) into patterns ("k sequences that hold these lengths") and Spark hands the places of
the patterns to the pieces: pieces of a length are numbered without gathering them (a count per
length and part, running totals over the parts, a rank inside each part), and the number is
looked up in the bounded table of places.

Reduction, after Martello and Toth: lengths are tried from the longest down, with all that fit beside
them, until a pass over all of them fixes nothing more. A set that holds the length is fixed for good if it dominates all others, that is if the contents of any other feasible set can be
exchanged for its own without loss: the length alone when nothing fits beside it; with the one
length that fills the sequence exactly; with the longest partner when no two others fit
together beside it; with the longest partner when no feasible pair is longer than it and no
three fit. What no rule fixes goes to best fit, longest first.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import Batches, id_text, stage, text_bytes

SIZE = 2048
VOCABULARY = "word_bpe_49k.json"
PART_ROWS = 50_000
_CACHE_WORDS = 1_000_000
#: the split of VOCABULARY, and the same split of a lower-cased word of printable ASCII (which its other steps leave as it is)
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PRINTABLE = re.compile(rb"[!-~]+")

Pattern = tuple[tuple[int, ...], int]  # lengths in order of their place, number of sequences


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


# ---------------------------------------------------------------- the instance

def reduce_instance(counts: np.ndarray) -> list[Pattern]:
    """Fix dominating sets; takes them out of ``counts`` (index = length)."""
    fixed: list[Pattern] = []
    found = None
    while found is None or found:  # what is taken away may let a rule hold for a length that was passed over
        found = _reduce_once(counts)
        fixed += found
    return fixed


def _reduce_once(counts: np.ndarray) -> list[Pattern]:
    size = len(counts) - 1
    fixed: list[Pattern] = []
    for long in range(size, 0, -1):
        while counts[long]:
            room = size - long
            counts[long] -= 1  # the sequence's own first piece
            fits = np.flatnonzero(counts[: room + 1])
            if not len(fits):
                counts[long] += 1
                fixed.append(((long,), int(counts[long])))
                counts[long] = 0
                break
            best = int(fits[-1])
            small = np.repeat(fits, np.minimum(counts[fits], 3))[:3]
            pair = int(small[:2].sum()) if len(small) > 1 else room + 1
            three = int(small.sum()) if len(small) > 2 else room + 1
            sure = best == room or pair > room or (three > room and _longest_pair(counts, fits, room) <= best)
            counts[long] += 1
            if not sure:
                break  # not fixed (yet): the next length
            # taking lengths away only takes sets away, so the rule holds until one of the two runs out
            times = int(counts[long] // 2 if best == long else min(counts[long], counts[best]))
            counts[long] -= times
            counts[best] -= times
            fixed.append(((long, best), times))
    return fixed


def _longest_pair(counts: np.ndarray, fits: np.ndarray, room: int) -> int:
    """Longest sum of two pieces that fit into ``room``."""
    at = np.searchsorted(fits, room - fits, side="right") - 1
    alone = (at >= 0) & (fits[at] == fits) & (counts[fits] < 2)
    at[alone] -= 1
    sums = np.where(at >= 0, fits + fits[at], 0)
    return int(sums.max(initial=0))


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Best fit, longest length first, over equal sequences at once."""
    size = len(counts) - 1
    by_room: list[list[list]] = [[] for _ in range(size + 1)]  # room left -> [lengths, number of sequences]
    rooms = np.zeros(size + 1, bool)
    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            found = np.flatnonzero(rooms[length:])
            if not len(found):
                each = size // length
                whole, rest = divmod(left, each)
                for k, n in ((each, whole), (rest, 1)):
                    if k and n:
                        by_room[size - k * length].append([(length,) * k, n])
                        rooms[size - k * length] = True
                break
            room = length + int(found[0])
            lengths, n = by_room[room].pop()
            each = min(room // length, left)
            used = min(n, left // each)
            if n > used:
                by_room[room].append([lengths, n - used])
            rooms[room] = bool(by_room[room])
            by_room[room - each * length].append([lengths + (length,) * each, used])
            rooms[room - each * length] = True
            left -= each * used
    return [(tuple(lengths), n) for groups in by_room for lengths, n in groups]


def solve(counts: np.ndarray) -> list[Pattern]:
    """Patterns that hold every piece of the histogram exactly once."""
    left = np.array(counts, np.int64)
    left[0] = 0
    fixed = reduce_instance(left)
    return fixed + best_fit(left)


class Places:
    """Sequence and offset of the i-th piece of each length."""

    def __init__(self, patterns: list[Pattern]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        first = 0
        for lengths, n in patterns:
            offset = 0
            for length in lengths:
                start = taken.get(length, 0)
                rows.setdefault(length, []).append((start, first, offset, n))
                taken[length] = start + n
                offset += length
            first += n
        self.tables = {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in rows.items()}

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for k in np.unique(length).tolist():
            rows = np.flatnonzero(length == k)
            start, first, place, _ = self.tables[k]
            at = np.searchsorted(start, number[rows], side="right") - 1
            sequence[rows] = first[at] + number[rows] - start[at]
            offset[rows] = place[at]
        return sequence, offset


# ---------------------------------------------------------------- tokens

def _splits_as_known(coder) -> bool:
    """Are the steps before the merges those that ``_PIECES`` stands for?"""
    steps = json.loads(coder.to_str())
    before, split = steps["normalizer"] or {}, steps["pre_tokenizer"] or {}
    return ([x["type"] for x in before.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and before["normalizers"][1]["pattern"] == {"Regex": r"\s+"} and steps["post_processor"] is None
            and split.get("pretokenizers") == [
                {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}])


def _ids(numbers: Sequence[int]) -> bytes:
    return struct.pack(f"<{len(numbers)}I", *numbers)


def _words_together(coder, words: list[bytes]) -> list[bytes]:
    """The ids of each word from one call: an id belongs to the word in which its characters start."""
    texts = [w.decode() for w in words]
    found = coder.encode(" ".join(texts), add_special_tokens=False)
    at = np.fromiter((first for first, _ in found.offsets), np.int64)
    ends = (4 * np.searchsorted(at, np.cumsum([0, *(len(t) + 1 for t in texts)]))).tolist()
    whole = _ids(found.ids)
    return [whole[i:j] for i, j in zip(ends, ends[1:])]


def tokenizer(path: str) -> Callable[[bytes], bytes]:
    """Text -> its ids as little-endian 32-bit integers.

    The vocabulary drops white space between words and lower-cases, so a text's ids are the ids of its
    lower-cased words (runs without ASCII white space) in order. Words are encoded once and kept: a batch
    call would start threads beside Spark's own tasks. Of a full cache, the words used since it filled up
    last stay. A new word of printable ASCII is split into the vocabulary's pieces here and only unknown
    pieces go through its merges; a text's other new words are encoded in one call. A text that quotes a marker
    of the vocabulary is encoded whole: the tokenizer as loaded gives the marker its own id.
    """
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)
    markers = [t.content.lower().encode() for t in coder.get_added_tokens_decoder().values() if t.content]
    merges, in_pieces = coder.model, _splits_as_known(coder)
    known: dict[bytes, bytes] = {}
    older: dict[bytes, bytes] = {}
    pieces: dict[bytes, bytes] = {}

    def piece(part: bytes) -> bytes:
        found = pieces.get(part)
        if found is None:
            found = pieces[part] = _ids([t.id for t in merges.tokenize(part.decode())])
        return found

    def ids(text: bytes) -> bytes:
        nonlocal known, older
        lower = text.lower()
        if any(m in lower for m in markers):
            return _ids(coder.encode(text.decode(), add_special_tokens=False).ids)
        words = lower.split()
        others = []
        for w in {w for w in words if w not in known}:
            found = older.get(w)
            if found is not None:
                known[w] = found
            elif in_pieces and _PRINTABLE.fullmatch(w):
                known[w] = b"".join(map(piece, _PIECES.findall(w)))
            else:
                others.append(w)
        if others:
            known.update(zip(others, _words_together(coder, others), strict=True))
        out = b"".join(map(known.__getitem__, words))
        if len(known) > _CACHE_WORDS:
            known, older = {}, known
        if len(pieces) > _CACHE_WORDS:
            pieces.clear()
        return out

    return ids


_CODERS: dict[str, Callable[[bytes], bytes]] = {}


def _cut(size: int, path: str):
    def run(batches: Batches) -> Batches:
        coder = _CODERS.get(path) or _CODERS.setdefault(path, tokenizer(path))
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for d, t in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), strict=True):
                ids = coder(t) + bytes(4)
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    doc.append(d)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of at most ``size`` ids (a document ends with id 0)."""
    return id_text(docs).mapInArrow(
        _cut(size, path or vocabulary_path()), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _placed(places):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            sequence, offset = places.value.find(
                batch.column("length").to_numpy(zero_copy_only=False), batch.column("number").to_numpy(zero_copy_only=False))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids are those of its text (NULL: empty) and a final id 0. Only documents longer than
    ``size`` are cut. The pieces of a sequence lie gapless from offset 0 and sum to at most ``size``.
    Equal lengths are interchangeable. Repeated rows and rows with a NULL doc_id are packed like any
    other. An empty table gives an empty result; extra columns are not read.
    """
    spark = docs.sparkSession
    cut = stage(pieces(docs, size, path).withColumn("row", F.monotonically_increasing_id()), "pieces")
    # rows are numbered inside parts of bounded size: a task's rows are consecutive in ``row``
    cut = cut.withColumn("part", F.floor(F.col("row") / PART_ROWS))
    per_part = stage(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(size + 1, np.int64)
    for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        histogram[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(Places(solve(histogram)))
    before = per_part.select(
        "length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy("row")) - 1
    numbered = cut.withColumn("rank", rank).join(before, ["length", "part"]).withColumn(
        "number", F.col("before") + F.col("rank"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        _placed(places),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def lower_bound(docs_packed: DataFrame, size: int = SIZE) -> DataFrame:
    """One row: sequences used and the least number that the ids could fill."""
    return docs_packed.agg(F.countDistinct("sequence_id").alias("sequences"),
                           F.ceil(F.sum("length") / size).alias("least"))
