"""How far each source's term frequencies are from the other sources and from its language.

Arrow compute kernels count: in ``mapInArrow`` a batch is lower-cased (``ascii_lower``), split
(``split_pattern_regex``), ``dictionary_encode``d and summed by a hash ``group_by``, so a task sends one
partial row per (language, source, term). Spark sums these, keeps the terms that enough documents of a
language hold, and deals the kept counts into columnar shards (a range of terms by a block of sources), each
of which adds its share of every divergence.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import Batches, stage

#: documents of a language that must hold a term
MIN_DOCS = 30
#: added to every count
SMOOTHING = 5
#: the ``term`` part ends at this rank
TOP_TERMS = 50
#: what is not part of a term
BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: bytes of text that one kernel call takes, and partial rows that a task holds before it sends them
SLICE_BYTES, HELD_ROWS = 8 << 20, 1 << 20
#: expected terms of a shard and sources of a block: a shard's matrix has at most about SHARD_TERMS x 2 BLOCK_SOURCES cells
SHARD_TERMS, BLOCK_SOURCES = 2048, 128

PARTIAL = "lang string, source string, term string, n long, docs long"
_BREAK = re.compile(BREAK)


def _counts(texts: pa.Array, owner: pa.Array) -> pa.Table:
    """(owner, term, n): occurrences of each term in the texts of each owner."""
    terms = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BREAK)
    flat, owner = pc.list_flatten(terms), pc.take(owner, pc.list_parent_indices(terms))
    some = pc.not_equal(flat, "")
    coded = pc.dictionary_encode(pc.filter(flat, some))
    out = pa.table({"owner": pc.filter(owner, some), "code": coded.indices}).group_by(
        ["owner", "code"], use_threads=False).aggregate([([], "count_all")])
    return pa.table({"owner": out["owner"], "term": pc.take(coded.dictionary, out["code"]), "n": out["count_all"]})


def _parts(text: str) -> list[str]:
    """A long text in parts of about SLICE_BYTES, cut where no term is."""
    out, at = [], 0
    while at < len(text):
        gap = _BREAK.search(text, at + SLICE_BYTES // 4)
        end = gap.end() if gap else len(text)
        out.append(text[at:end])
        at = end
    return out


def _document_counts(texts: pa.Array) -> list[pa.Table]:
    """(owner, term, n) of a batch, in tables that hold whole documents each."""
    size = np.asarray(pc.binary_length(texts), dtype=np.int64)
    out, start = [], 0
    while start < len(texts):
        if size[start] > SLICE_BYTES:
            parts = [_counts(pa.array([p], pa.large_string()), pa.array([start])) for p in _parts(texts[start].as_py())]
            whole = pa.concat_tables(parts).group_by(["owner", "term"], use_threads=False).aggregate([("n", "sum")])
            out.append(whole.rename_columns(["owner", "term", "n"]))
            start += 1
            continue
        within = np.cumsum(size[start:])
        end = start + max(1, int(np.searchsorted(within, SLICE_BYTES, "right")))
        out.append(_counts(texts.slice(start, end - start), pa.array(np.arange(start, end))))
        start = end
    return out


def _merged(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns(["lang", "source", "term", "n", "docs"])


def _sent(table: pa.Table):
    for batch in table.combine_chunks().to_batches(max_chunksize=1 << 16):
        yield pa.RecordBatch.from_arrays(
            [batch[c].cast(t) for c, t in (("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                                           ("n", pa.int64()), ("docs", pa.int64()))],
            ["lang", "source", "term", "n", "docs"])


def _partial_counts(batches: Batches) -> Batches:
    """Partial sums of a task; a row with the empty term counts the documents of its (language, source)."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lang, source, text = (pc.fill_null(batch[c], "").cast(pa.large_string()) for c in ("lang", "source", "text"))
        for c in _document_counts(text):
            held.append(pa.table({"lang": pc.take(lang, c["owner"]), "source": pc.take(source, c["owner"]), "term": c["term"].cast(pa.large_string()),
                                  "n": c["n"], "docs": pa.array(np.ones(len(c), np.int64))}))
            rows += len(c)
            if rows > HELD_ROWS:
                held = [_merged(held)]
                rows = len(held[0])
                if rows > HELD_ROWS // 2:
                    yield from _sent(held[0])
                    held, rows = [], 0
        none = np.zeros(len(text), np.int64)
        held.append(pa.table({"lang": lang, "source": source, "term": pa.array([""] * len(text), pa.large_string()), "n": none, "docs": none + 1}))
        rows += len(text)
    if held:
        yield from _sent(_merged(held))


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 * (count + s) / (total + s * kept)) on whole numbers; decimals, as 10^9 * count may pass 64 bits."""
    return F.expr(f"cast(1 + (cast(1000000000 as decimal(10,0)) * (cast({count} as decimal(19,0)) + {SMOOTHING}))"
                  f" div (cast({total} as decimal(19,0)) + {SMOOTHING} * cast({kept} as decimal(18,0))) as bigint)")


def _shard_sums(table: pa.Table) -> pa.Table:
    """One shard: for each ordered pair of its sources, the sum of |p - q| over the terms that occur here.

    Rows with a NULL term give a source's share of a term that it never uses (``p``) and the number of kept
    terms of the language (``kept``). A pair of different blocks is summed only in the shard of both.
    """
    lang, left, right = table["lang"][0].as_py(), table["left"][0].as_py(), table["right"][0].as_py()
    table = table.combine_chunks()
    whole = pc.is_null(table["term"])
    base = table.filter(whole)
    names = base["source"].to_pylist()
    place = {s: i for i, s in enumerate(names)}
    zero, block, kept = (np.asarray(base[c], dtype=np.int64) for c in ("p", "block", "kept"))
    cells = table.filter(pc.invert(whole))
    terms = pc.dictionary_encode(cells["term"].combine_chunks() if isinstance(cells["term"], pa.ChunkedArray) else cells["term"])
    terms = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
    seen = len(terms.dictionary)
    share = np.repeat(zero[:, None], seen, axis=1)
    rows = np.fromiter((place[s] for s in cells["source"].to_pylist()), dtype=np.int64, count=len(cells))
    share[rows, np.asarray(terms.indices, dtype=np.int64)] = np.asarray(cells["p"], dtype=np.int64)
    one, other = np.flatnonzero(block == left), np.flatnonzero(block == right)
    out = {c: [] for c in ("source", "item", "value", "seen", "base", "kept")}
    for i in one:
        apart = np.abs(share[other] - share[i]).sum(axis=1)
        for j, value in zip(other.tolist(), apart.tolist()):
            if i == j:
                continue
            both = ((i, j),) if left == right else ((i, j), (j, i))  # within a block the loops meet both orders
            for a, b in both:
                out["source"].append(names[a])
                out["item"].append(names[b])
                out["value"].append(value)
                out["seen"].append(seen)
                out["base"].append(abs(int(zero[a] - zero[b])))
                out["kept"].append(int(kept[a]))
    n = len(out["value"])
    whole_numbers = {c: pa.array(out[c], pa.int64()) for c in ("value", "seen", "base", "kept")}
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "source": pa.array(out["source"], pa.string()),
                     "item": pa.array(out["item"], pa.string())} | whole_numbers)


def _pairs(shares: DataFrame, groups: DataFrame, shard_terms: int, block_sources: int) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of a language's sources."""
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / block_sources).cast("int").alias("blocks"),
                                       F.greatest(F.lit(1), F.ceil(F.max("kept") / shard_terms)).cast("int").alias("shards"))
    partners = F.expr("explode(transform(sequence(0, blocks - 1), b -> struct(least(b, block) as left, greatest(b, block) as right)))")
    block = F.expr("cast(pmod(xxhash64(source), blocks) as int)").alias("block")
    known = groups.join(sizes, "lang").select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("unseen").alias("p"), "kept", block,
                                              "blocks", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    cells = shares.join(sizes, "lang").select("lang", "source", "term", "p", "kept", block, "blocks",
                                              F.expr("cast(pmod(xxhash64(term), shards) as int)").alias("shard"))
    dealt = known.unionByName(cells).select("lang", "shard", "source", "term", "p", "kept", "block", partners.alias("to")).select(
        "lang", "shard", "to.left", "to.right", "source", "term", "p", "kept", "block")
    sums = dealt.groupBy("lang", "shard", "left", "right").applyInArrow(
        _shard_sums, "lang string, source string, item string, value long, seen long, base long, kept long")
    # a term that neither source of a pair uses adds the distance of their shares of such a term; blocks may not have met it
    return sums.groupBy("lang", "source", "item").agg((F.sum("value") + (F.max("kept") - F.sum("seen")) * F.max("base")).alias("value"))


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, shard_terms: int = SHARD_TERMS,
                block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) that occurs.

    ``part`` is ``pair`` (item: each other source of the language; value: the summed distance of the two
    sources' shares over the language's kept terms) or ``term`` (item: a kept term that the source uses more
    than its language does; value: by how much; the ``top_terms`` largest). Shares are whole numbers in
    units of 10^-9, so all values are exact.

    NULL text, lang and source count as ''. A source without terms is there with its smoothed shares; a
    language without kept terms has pairs of value 0; a language with one source has no pairs. Repeated rows
    count each; doc_id and further columns are not read; an empty table gives no rows.
    """
    partial = docs.select("lang", "source", "text").mapInArrow(_partial_counts, PARTIAL)
    counts = stage(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    terms = counts.where("term != ''")
    kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(
        F.col("docs") >= min_docs).drop("docs")
    cells = stage(terms.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "divergence-cells")

    langs = cells.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n")).groupBy("lang").agg(
        F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    used = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term = ''").select("lang", "source").join(used, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(
        0, ["total", "kept", "lang_total"])
    unseen = F.when(F.col("kept") > 0, _share("0", "total", "greatest(kept, 1)")).otherwise(F.lit(0).cast("long"))
    groups = stage(groups.withColumn("unseen", unseen), "divergence-groups")

    shares = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "kept", _share("n", "total", "kept").alias("p"), _share("lang_n", "lang_total", "kept").alias("q"))
    pairs = _pairs(shares.drop("q"), groups, shard_terms, block_sources)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    most = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    most = most.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(most.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
