"""Near-duplicate documents by HyperMinHash registers, banding and exact verification.

Each document's set of word shingles is hashed once; the hash's leading bits choose a bucket and
the smallest remainder per bucket is kept as a 16-bit register: leading-zero count (6 bits)
and the mantissa bits after the leading one (10 bits). Buckets that no shingle hits are filled
by a second hash of the whole set, one per bucket, so two documents agree in any one register
with a probability equal to their Jaccard similarity, also for short texts.

Four registers are one band. Documents that share a band are candidates; a collision-corrected
Jaccard estimate from all registers drops the hopeless ones, and the rest is verified on the
full shingle sets. At a similarity of 0.75 a pair escapes all BANDS = 32 bands with a probability of 5e-6.

Large groups never become all pairs. Equal sets are one node from the start. A bucket's centre is the
member with the most company in all its buckets. In a first round each document is checked against one
centre, the heaviest of its buckets', and then against the centres that this has left in other components; in a second round only members that are *not* in the component with most of the
bucket's members are checked against the bucket's other components, so no link between components
is lost. There, two sets share at most as many shingles as either shares with anyone at all: that exact
bound settles most members of a group of near copies that are themselves too far from the others. The rest are
mostly pairs that miss the threshold by less than the estimate can tell: parity bits of the full sets, which differ
in no more places than the sets have shingles apart, settle nearly all of these before they become pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import Batches, discard, id_text, list_of_longs, mix, stage, text_bytes, window_hashes, word_hashes
from contrail.llm.components import components

WORDS = 5
THRESHOLD = 75  # per cent
BUCKETS = 256  # registers, four to a band
BANDS = 32  # bands that are looked up; all registers serve the estimate
MANTISSA = 10  # bits
#: standard deviations that an estimate may lie below the threshold before a pair is dropped unverified
MARGIN = 4.5
#: candidate documents (id and digest, about 50 bytes each) that are broadcast to pick their texts; more meet them in a shuffle
BROADCAST_NODES = 1 << 20
#: pairs of one node that meet its facts in one place; a node with more has a copy of them for each further lot
LOT = 256
#: longs of parity bits that a set has in the second round
PARITY = 16
_SEEDS = mix(np.arange(1, BUCKETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; with fewer words, of the whole sequence; none for no words."""
    hashes = word_hashes(text.lower().split())
    if not len(hashes):
        return hashes
    return np.unique(window_hashes(hashes, min(words, len(hashes))))


def registers(shingles: np.ndarray) -> np.ndarray:
    """BUCKETS uint16 registers of a sorted, non-empty set of hashes."""
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    first = np.searchsorted(shingles, np.arange(BUCKETS, dtype=np.uint64) << shift)
    last = np.append(first[1:], len(shingles))
    low = shingles[np.minimum(first, len(shingles) - 1)] << np.uint64((BUCKETS - 1).bit_length())
    empty = np.flatnonzero(first == last)
    for part in np.array_split(empty, max(1, len(empty) * len(shingles) // 1_000_000)):
        if len(part):
            low[part] = mix(shingles[:, None] ^ _SEEDS[part]).min(axis=0)
    fraction, exponent = np.frexp(low.astype(np.float64))
    zeros = np.minimum(64 - exponent, 63)
    mantissa = np.clip((fraction - 0.5) * (2 << MANTISSA), 0, (1 << MANTISSA) - 1)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


def parity(shingles: np.ndarray) -> np.ndarray:
    """64 * PARITY bits as longs: which classes of hashes a set has an odd number of."""
    odd = np.bincount((shingles & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _signatures(words: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes, keys, bands = [], [], []
            for text in text_bytes(batch):
                s = shingle_set(text, words)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                bands.append(registers(s).view(np.int64) if len(s) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), list_of_longs(bands)],
                ["doc_id", "n_shingles", "set_id", "bands"])

    return run


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, n_shingles, set_id (128-bit digest of the set, NULL if empty), bands (registers, four per long)."""
    return id_text(docs).mapInArrow(_signatures(words), "doc_id long, n_shingles long, set_id binary, bands array<long>")


def equal_registers(a: Column, b: Column) -> Column:
    """How many of the 16-bit registers packed in two band arrays are equal."""
    def lanes(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        return sum((F.when(z.bitwiseAND(F.lit(0xFFFF << s if s < 48 else -(1 << 48))) == 0, 1).otherwise(0)
                    for s in (0, 16, 32, 48)), F.lit(0))

    return F.aggregate(F.zip_with(a, b, lanes), F.lit(0), lambda t, x: t + x)


def estimate(equal: Column, n: Column, m: Column) -> Column:
    """Jaccard similarity from equal registers, less the chance collisions of compressed registers.

    Two independent bucket minima with rates n and m fall into one register cell with probability
    E[cell width / x] * n m / (n + m)^2; a cell's width is x / 2^MANTISSA times 1 / (2 ln 2) on average.
    """
    chance = F.lit(0.7213475 / (1 << MANTISSA)) * n * m / ((n + m) * (n + m))
    return (equal / F.lit(BUCKETS) - chance) / (F.lit(1.0) - chance)


def _possible(pair_a: str, pair_b: str, threshold: int) -> Column:
    """Estimate within MARGIN of the threshold, and sizes that allow it at all."""
    t = threshold / 100
    least = t - MARGIN * (t * (1 - t) / BUCKETS) ** 0.5
    n, m = F.col(f"{pair_a}.n"), F.col(f"{pair_b}.n")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * threshold) & (
        estimate(equal_registers(F.col(f"{pair_a}.bands"), F.col(f"{pair_b}.bands")), n, m) >= least)


def _shingles(words: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [shingle_set(t, words) for t in text_bytes(batch)]
            sets = [s.tobytes() for s in found]
            same = [xxhash.xxh3_128_digest(s) == i.as_py() for s, i in zip(sets, batch.column("set_id"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("set_id"), pa.array(sets, pa.binary()), list_of_longs(list(map(parity, found)))],
                ["node", "set_id", "shingles", "parity"]).filter(pa.array(same, pa.bool_()))

    return run


def _each_shingle(batches: Batches) -> Batches:
    for batch in batches:
        sets = [np.frombuffer(z.as_buffer(), np.int64) for z in batch.column("shingles")]
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), [len(x) for x in sets])
        whole = np.concatenate([*sets, np.empty(0, np.int64)])
        for k in range(0, len(whole), 1 << 20):
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[k:k + (1 << 20)]), pa.array(whole[k:k + (1 << 20)])], ["node", "shingle"])


def own_shingles(sets: DataFrame) -> DataFrame:
    """(node, own): how many of a node's shingles no other node has. Nodes without any do not appear."""
    each = sets.mapInArrow(_each_shingle, "node long, shingle long")
    return each.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other")).where(
        "node = other").groupBy("node").agg(F.count("*").alias("own"))


def _bounded(p: str, q: str, threshold: int) -> Column:
    """Two sets share at most what either shares with anyone; can that reach the threshold?"""
    n, m = F.col(f"{p}.n"), F.col(f"{q}.n")
    both = F.least(n - F.col(f"{p}.own"), m - F.col(f"{q}.own"))
    return both * 100 >= (n + m - both) * threshold


def _parity_allows(p: str, q: str, threshold: int) -> Column:
    """Two sets are at least as many shingles apart as their parity bits; can what is left reach the threshold?"""
    n, m = F.col(f"{p}.n"), F.col(f"{q}.n")
    apart = F.aggregate(F.zip_with(f"{p}.parity", f"{q}.parity", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    # |A & B| = (n + m - apart) / 2, |A | B| = (n + m + apart) / 2; a set without bits excludes nothing
    apart = F.coalesce(apart, F.lit(0))
    return (n + m - apart) * 100 >= (n + m + apart) * threshold


def _verify(threshold: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= threshold * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def attached(pairs: DataFrame, facts: DataFrame, side: str, value: Column, name: str) -> DataFrame:
    """``pairs`` with ``value`` of the facts of the node in column ``side`` (a or b), as column ``name``.

    The centre of a large group has a pair with each member. Its pairs are dealt in lots of about LOT, and
    its facts are copied once per lot, so no task has all of them.
    """
    lots = pairs.groupBy(side).agg(F.ceil(F.count("*") / LOT).cast("long").alias("_lots")).where("_lots > 1")
    dealt = pairs.join(lots, side, "left").withColumn(
        "_lot", F.pmod(F.xxhash64("a", "b"), F.coalesce("_lots", F.lit(1)))).drop("_lots")
    copies = facts.select(F.col("node").alias(side), value.alias(name)).join(lots, side, "left").select(
        side, name, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_lots", F.lit(1)) - 1)).alias("_lot"))
    return dealt.join(copies, [side, "_lot"]).drop("_lot")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    both = attached(attached(pairs, sets, "a", F.col("shingles"), "x"), sets, "b", F.col("shingles"), "y")
    return both.select("a", "b", "x", "y").mapInArrow(_verify(threshold), "a long, b long")


def _shingle_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(node, set_id, shingles, parity) of the documents in ``ids`` (node, set_id), whose texts are read again."""
    ids = ids.withColumnRenamed("node", "doc_id")
    if ids.count() <= BROADCAST_NODES:
        ids = F.broadcast(ids)
    return id_text(docs).join(ids, "doc_id").mapInArrow(
        _shingles(words), "node long, set_id binary, shingles binary, parity array<long>")


def near_components(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |A & B| >= threshold * |A | B| over their shingle sets;
    component_id is the smallest doc_id reachable over links, kept is doc_id = component_id.

    Empty and NULL texts have no shingles and are linked with nothing (component_id = doc_id).
    A row with a NULL doc_id links nothing and is kept, with a NULL component_id. Rows that
    repeat a doc_id are one document. An empty table gives an empty result. Extra columns are
    not read.
    """
    held: list[str] = []  # staged tables that go as soon as the components are known
    sig = stage(signatures(docs, words), "signatures")
    usable = sig.where("n_shingles > 0 and doc_id is not null")
    classes = stage(usable.groupBy("set_id").agg(F.min("doc_id").alias("node")), "classes")
    reps = stage(
        usable.join(classes.withColumnRenamed("node", "doc_id"), ["set_id", "doc_id"], "left_semi")
        .select(F.col("doc_id").alias("node"), "set_id", F.col("n_shingles").alias("n"), "bands")
        .dropDuplicates(["node", "set_id"]), "representatives", held)

    rows = reps.select("node", F.posexplode(F.slice("bands", 1, BANDS)).alias("band", "value"))
    shared = rows.groupBy("band", "value").agg(F.count("*").alias("members")).where("members > 1")
    members = stage(rows.join(shared, ["band", "value"]), "members", held)
    # a node in many large buckets is likely to be near all that is in them: it is its buckets' centre
    weight = members.groupBy("node").agg(F.sum("members").alias("weight"))
    members = stage(members.join(weight, "node").select("band", "value", "node", "weight"), "weighted", held)
    top = F.max(F.struct("weight", (-F.col("node")).alias("minus")))
    centres = stage(members.groupBy("band", "value").agg(top.alias("top")).select(
        "band", "value", F.col("top.weight").alias("heavy"), (-F.col("top.minus")).alias("first")), "centres", held)
    wanted = members.select("node").distinct()
    known = reps.join(wanted, "node", "left_semi").select("node", "set_id", "n", "bands")
    ids = stage(reps.join(wanted, "node", "left_semi").select("node", "set_id"), "ids", held)
    sets = stage(_shingle_sets(docs, ids, words), "sets", held)

    marks = F.struct("n", "bands")
    ends = (F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b"))

    def linked(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Those that the estimate lets through, and the links among them."""
        near = stage(attached(attached(pairs, known, "a", marks, "p"), known, "b", marks, "q")
                     .where(_possible("p", "q", threshold)).select("a", "b"), f"{name}_near", held)
        return near, stage(verified(near, sets, threshold), f"{name}_links", held)

    def placed(label: DataFrame, name: str) -> DataFrame:
        return stage(members.join(label, "node", "left").select(
            "band", "value", "node", F.coalesce("component", "node").alias("component")), name, held)

    # round 1: each node against the heaviest centre of its buckets, then what that leaves apart from a
    # bucket's centre against that centre too
    chosen = members.join(centres, ["band", "value"]).where("node <> first").groupBy("node").agg(
        F.max(F.struct("heavy", (-F.col("first")).alias("minus"))).alias("top"))
    tried = stage(chosen.select("node", (-F.col("top.minus")).alias("first")).select(*ends).distinct(), "tried", held)
    stars, links = linked(tried, "one")
    label = components(links, "a", "b")
    at = placed(label, "after_one")
    main = at.join(centres, ["band", "value"]).where("node = first").select(
        "band", "value", "first", F.col("component").alias("main"))
    apart = at.join(main, ["band", "value"]).where("component <> main").select(*ends).distinct()
    others, links = linked(stage(apart.join(tried, ["a", "b"], "left_anti"), "apart", held), "other")
    stars = stars.unionByName(others)
    label = components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links), "a", "b")

    # round 2: what is outside the component with most members of a bucket, against the rest of the bucket
    at = placed(label, "placed")
    sizes = at.groupBy("band", "value", "component").agg(F.count("*").alias("k"))
    mixed = sizes.groupBy("band", "value").agg(
        F.max_by("component", F.struct("k", "component")).alias("main"), F.count("*").alias("parts")).where(
        "parts > 1").select("band", "value", "main")
    open_rows = stage(at.join(mixed, ["band", "value"]), "open", held)
    # any further link is between two of these, so what none of the others has cannot be shared
    open_sets = sets.join(open_rows.select("node").distinct(), "node", "left_semi")
    own = own_shingles(open_sets.select("node", "shingles"))
    bits = open_sets.groupBy("node", "set_id").agg(F.any_value("parity").alias("parity"))
    facts = known.join(own, "node", "left").join(bits, ["node", "set_id"], "left").withColumn(
        "own", F.coalesce("own", F.lit(0))).drop("set_id")
    open_rows = stage(open_rows.join(facts, "node"), "bounded", held)
    side = F.struct("node", "component", "main", "n", "own", "parity", "bands")
    p = open_rows.where("component <> main").select("band", "value", side.alias("p"))
    q = open_rows.select("band", "value", side.alias("q"))
    first_shared = F.array_position(F.zip_with("p.bands", "q.bands", lambda x, y: x == y), F.lit(True)) == F.col("band") + 1
    once = (F.col("q.component") == F.col("q.main")) | (F.col("p.node") < F.col("q.node"))  # both outside: one order
    rest = (p.join(q, ["band", "value"]).where(F.col("p.component") != F.col("q.component")).where(once)
            .where(_bounded("p", "q", threshold)).where(first_shared).where(_parity_allows("p", "q", threshold))
            .where(_possible("p", "q", threshold))
            .select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct())
    more = stage(verified(stage(rest.join(stars, ["a", "b"], "left_anti"), "rest", held), sets, threshold), "more", held)

    label = components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), "a", "b")
    discard(docs.sparkSession, held)
    of_set = classes.join(label, "node", "left").select("set_id", F.coalesce("component", "node").alias("component"))
    out = sig.select("doc_id", "n_shingles", "set_id").join(of_set, "set_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` without the near-duplicates: the smallest doc_id of each group stays, all columns as they were.

    Rows with a NULL doc_id stay; rows that repeat a kept doc_id stay together.
    """
    dropped = near_components(docs, words, threshold).where("not kept").select(F.col("doc_id").alias("_dropped"))
    return docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")
