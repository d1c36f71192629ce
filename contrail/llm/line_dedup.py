"""Near-duplicate lines by an exact set-similarity join, in DataFrame functions only.

A line is the set of its words. Words are ordered by rarity over the whole corpus (their counts in
BUCKETS hash buckets, so the order is small enough to be part of the plan; any total order gives the
same result, a good one makes prefixes rare). Two sets with a Jaccard similarity of at least t must share a
word among the first n - ceil(t n) + 1 of each; equal prefix words are an equi-join, on which
the length filter and the positional filter (what is left after the shared positions must suffice for
the overlap) act, and what remains is verified on the full sets.

Lines with equal sets are one class from the start, so frequent lines cost one row in the join.
Two different sets of which the smaller has n words have a similarity of at most n / (n + 1), so at a
threshold of 90 per cent classes of fewer than 9 words take no part in the join.
A group of near copies does not become all pairs either: a line is first checked against the earliest
line of each of its prefix words. Only lines earlier than the match found there can still change the
result, so the join proper is left with those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import discard, id_text, stage

THRESHOLD = 90  # per cent
#: least distinct words of a line that takes part in the similarity join; for fewer only equal sets are similar
#: enough (2 of 3 words shared is less than any threshold above 66 per cent)
MIN_WORDS = 3
#: least distinct words of a line that goes if it repeats an earlier line's set: a line without words stays
MIN_EQUAL = 1
BUCKETS = 1 << 14


def _split(text: Column, breaks: str = "\t\x0B\f\r") -> Column:
    """Words and empty strings between blanks and ``breaks`` (a single-character split needs no regular expression)."""
    for c in breaks:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.split(text, " ")


def _ranks(docs: DataFrame) -> Column:
    """Constant array: rank by corpus frequency of each hash bucket of words."""
    words = id_text(docs).select(F.explode(_split(F.lower("text"), "\t\n\x0B\f\r")).alias("w")).where("w <> ''")
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("bucket")).agg(F.count("*").alias("n"))
    found = {r["bucket"]: r["n"] for r in counts.collect()}  # BUCKETS rows at most
    order = sorted(range(BUCKETS), key=lambda b: (found.get(b, 0), b))
    ranks = [0] * BUCKETS
    for rank, bucket in enumerate(order):
        ranks[bucket] = rank
    return F.from_json(F.lit("[" + ",".join(map(str, ranks)) + "]"), "array<long>")


def _lines(docs: DataFrame) -> DataFrame:
    return id_text(docs).where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _words(line: Column, ranks: Column) -> Column:
    """Sorted distinct 63-bit word keys, rarest first: rank of the hash bucket, then the rest of the hash."""
    def key(h: Column) -> Column:
        rank = F.get(ranks, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
        return F.shiftleft(rank, 49).bitwiseOR(F.shiftrightunsigned(h, 15))

    hashes = F.transform(F.array_remove(_split(F.lower(line)), ""), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.transform(hashes, key)))


def _parity(words: Column) -> Column:
    """64 parity bits of a set: two sets' bits differ in no more places than the sets have words apart."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda bits, w: bits.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))))


def _least(n: Column, m: Column, threshold: int) -> Column:
    """Overlap that two sets of n and m words need."""
    return F.ceil((n + m) * threshold / (100 + threshold))


def _possible(a: str, b: str, threshold: int) -> Column:
    """Length, positional and parity filter of two postings of one word."""
    a_n, b_n = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = _least(a_n, b_n, threshold)
    return ((F.least(a_n, b_n) * 100 >= F.greatest(a_n, b_n) * threshold)
            & (F.least(a_n - F.col(f"{a}.i"), b_n - F.col(f"{b}.i")) >= need)
            & (F.bit_count(F.col(f"{a}.bits").bitwiseXOR(F.col(f"{b}.bits"))) <= a_n + b_n - need * 2))


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, ranks: Column, name: str, held: list[str]) -> DataFrame:
    """id, at, words of those of ``classes`` that are in ``pairs``; the words come from the texts."""
    wanted = classes.join(pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "id", "left_semi")
    wanted = wanted.groupBy(F.col("f.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("f.line_no", "id", "s1", "s2")).alias("wanted"))  # one document's lines
    whole = id_text(docs).join(wanted, "doc_id").select("doc_id", F.split("text", "\n").alias("lines"), "wanted")
    full = whole.select("doc_id", F.explode(F.transform("wanted", lambda w: F.struct(
        w["id"].alias("id"), w["line_no"].alias("line_no"), w["s1"].alias("s1"), w["s2"].alias("s2"),
        F.get("lines", w["line_no"]).alias("line")))).alias("w"))
    full = stage(full.select(
        F.col("w.id").alias("id"), F.struct("doc_id", F.col("w.line_no").alias("line_no")).alias("at"),
        F.col("w.s1").alias("s1"), F.col("w.s2").alias("s2"), _words(F.col("w.line"), ranks).alias("words")), name, held)
    # of rows that repeat a doc_id only the one with the class's own words counts
    return full.where((F.xxhash64("words") == F.col("s1")) & (F.xxhash64(F.lit(1), "words") == F.col("s2"))).drop("s1", "s2")


def _earliest(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """id, earlier: for each x of ``pairs`` the earliest of its y whose words are similar enough."""
    both = F.size(F.array_intersect("p", "q"))
    return (pairs.join(sets.select(F.col("id").alias("x"), F.col("words").alias("p")), "x")
            .join(sets.select(F.col("id").alias("y"), "at", F.col("words").alias("q")), "y")
            .where(both * 100 >= F.lit(threshold) * (F.size("p") + F.size("q") - both))
            .groupBy(F.col("x").alias("id")).agg(F.min("at").alias("earlier")))


def least_words(threshold: int) -> float:
    """Distinct words that the smaller of two different, similar sets has at least."""
    return threshold / (100 - threshold) if threshold < 100 else float("inf")


def removed_lines(docs: DataFrame, threshold: int = THRESHOLD, min_words: int = MIN_WORDS,
                  min_equal: int | None = None) -> DataFrame:
    """doc_id, line_no, first_doc_id, first_line_no of every line that an earlier line repeats.

    Lines are split at \\n and compared as sets of lower-cased words; a line goes if
    100 * |A & B| >= threshold * |A | B| for an earlier line, in order of (doc_id, line_no), whether
    or not that one goes too. The smallest such line is reported (of equal sets the first one).

    Lines with fewer than ``min_words`` distinct words are not compared for similarity. Those with
    ``min_equal`` or more (None: ``min_words``; the registered query and the pipeline take MIN_EQUAL)
    still go if an earlier line has an equal set, lines of a script without blanks (one word each)
    among them; the others stay and remove nothing. Lines without words always stay. NULL and empty texts
    have no other lines; rows with a NULL doc_id neither lose lines nor remove any. Rows that
    repeat a doc_id have lines of the same rank, which do not remove each other. Empty tables
    give an empty result; extra columns are not read.
    """
    held: list[str] = []
    ranks = _ranks(docs)
    t = F.lit(threshold)
    n = F.size("words")
    lines = _lines(docs).select("doc_id", "line_no", _words(F.col("line"), ranks).alias("words")).select(
        "doc_id", "line_no", F.xxhash64("words").alias("s1"), F.xxhash64(F.lit(1), "words").alias("s2"), n.alias("n"),
        _parity(F.col("words")).alias("bits"), F.slice("words", F.lit(1), n - F.ceil(n * t / 100).cast("int") + 1).alias("prefix"))
    # filtered after it is written: a filter before would work out the words twice
    lines = stage(lines, "lines", held).where(F.col("n") >= max(min_words if min_equal is None else min_equal, 1))
    every = stage(lines.groupBy("s1", "s2").agg(
        F.min(F.struct("doc_id", "line_no", "n", "bits", "prefix")).alias("f"), F.count("*").alias("copies"))
        .withColumn("id", F.monotonically_increasing_id()), "line_classes", held)
    classes = every.where((F.col("f.n") >= min_words) & (F.col("f.n") >= F.lit(least_words(threshold))))

    def postings(of: DataFrame, *more: str) -> DataFrame:
        return of.select("id", F.struct("f.doc_id", "f.line_no").alias("at"), F.col("f.n").alias("n"), F.col("f.bits").alias("bits"),
                         *more, F.posexplode("f.prefix").alias("i", "word"))

    row = F.struct("at", "id", "n", "bits", "i")
    # the earliest line of every prefix word that has others
    leads = stage(postings(classes).groupBy("word").agg(F.min(row).alias("lead"), F.count("*").alias("m")).where("m > 1").drop("m"),
                  "line_leads", held)
    first = stage(postings(classes).select("word", row.alias("x")).join(leads, "word").where(
        (F.col("lead.at") < F.col("x.at")) & _possible("x", "lead", threshold)).select(
        F.col("x.id").alias("x"), F.col("lead.id").alias("y")).distinct(), "line_pairs_lead", held)
    sets = _sets(docs, classes, first, ranks, "line_sets", held)
    known = stage(_earliest(first, sets, threshold), "line_matches_lead", held)

    # the join proper: lines earlier than the earliest match so far, under words whose earliest line is earlier than that
    until = classes.join(known, "id", "left").withColumn("until", F.coalesce("earlier", F.struct("f.doc_id", "f.line_no")))
    x = postings(until, "until").join(leads, "word").where("lead.at < until").select(
        "word", F.struct("id", "until", "n", "bits", "i").alias("x"))
    rest = x.join(postings(classes).select("word", row.alias("y")), "word").where(
        (F.col("y.at") < F.col("x.until")) & _possible("x", "y", threshold))
    rest = stage(rest.select(F.col("x.id").alias("x"), F.col("y.id").alias("y")).distinct(), "line_pairs", held)
    more = _sets(docs, classes.join(sets.select("id"), "id", "left_anti"), rest, ranks, "line_sets_more", held)
    close = known.unionByName(_earliest(rest, sets.unionByName(more), threshold)).groupBy("id").agg(F.min("earlier").alias("earlier"))

    hit = every.join(close, "id", "left").where("copies > 1 or earlier is not null").select(
        "s1", "s2", F.struct("f.doc_id", "f.line_no").alias("own"), "earlier")
    at = F.struct("doc_id", "line_no")
    out = lines.join(hit, ["s1", "s2"]).select(
        "doc_id", "line_no", F.when(at > F.col("own"), F.least("own", "earlier")).otherwise(F.col("earlier")).alias("first")
    ).where("first is not null").select(
        "doc_id", "line_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"))
    out = stage(out, "removed_lines")
    discard(docs.sparkSession, held)
    return out


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD, min_words: int = MIN_WORDS,
                min_equal: int | None = None) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` (n_chars, if there, follows); no row is dropped.

    A document that loses all its lines keeps its row, with an empty text. A NULL text stays NULL.
    """
    names = docs.columns
    taken = {c.lower() for c in names}
    free = lambda c: c if c not in taken else free(f"_{c}")
    doc, lost = free("removed_doc_id"), free("removed_lines")
    gone = removed_lines(docs, threshold, min_words, min_equal=min_equal).groupBy(F.col("doc_id").alias(doc)).agg(
        F.collect_set("line_no").alias(lost))  # one document's lines
    lines = F.split("text", "\n")
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n"))
    out = docs.join(gone, F.col("doc_id") == F.col(doc), "left").withColumn("text", text).drop(doc, lost)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
