"""Personal data by patterns learned from seeds, in DataFrame functions only.

Seeds are the strict matches of four kinds (e-mail, IP address, payment card, phone). The words
around them are lexical patterns. A looser search gives candidates that the strict forms miss; their
values and the seeds' values are the instances of a graph whose edges are "stands in this pattern".
Scores travel over the graph a few times: a pattern is as sure as its instances are on average, and
an instance as sure as its patterns together. Patterns that rest on enough distinct seeds and are sure
enough let their candidates in as further spans. Strict matches always stay.

The graph holds distinct (pattern, instance) pairs only, so a frequent word is a sum over pairs that
is aggregated before the shuffle.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: least share of sure instances, and least number of distinct seeds, of a pattern that admits candidates
SURE = 0.8
SEEDS = 3
CONTEXT = 40  # characters on either side that are looked at
CHUNK = 256  # characters of a piece of text that contexts are cut from; more than CONTEXT
BLOCK = 256  # numbers that are added up at a time

# The contract's forms. A run is entered at its start only, or where the last match ended (\G): the
# same matches as from every position, without trying each suffix of a long run.
STRICT = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[ -]?[0-9])++",
    "phone": "\\+[0-9][ ().0-9-]+[0-9]",
}
#: looser forms: e-mail with "(at)" or "[dot]", IP address with bracketed or spaced dots, IPv6, grouped numbers
LOOSE = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|\\(at\\)|\\[at\\]) ?[A-Za-z0-9-]++(?: ?(?:\\.|\\(dot\\)|\\[dot\\]) ?[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9.])[0-9]{1,3}+(?: ?(?:\\.|\\[\\.\\]|\\(\\.\\)|\\(dot\\)|\\[dot\\]) ?[0-9]{1,3}+){3}(?![0-9.])",
    "ip6": "(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "number": "(?:\\G|(?<![0-9]))[0-9]++(?:[ ().\\-/]{1,2}[0-9]++)*+",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check digit of a string of digits is right."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _small(part: Column) -> Column:
    """A run of digits that is at most 255."""
    short = F.regexp_replace(part, "^0+(?=.)", "")
    return (F.length(short) <= 3) & (F.lpad(short, 3, "0") <= "255")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, "\\."), _small)
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once, also if ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column) -> Column:
    """Running totals of a non-empty array. Arrays can only grow by a copy, so they grow inside blocks."""
    def grown(first: Column, more: Column) -> Column:
        return F.aggregate(more, F.array(first), lambda held, x: F.concat(held, F.array(F.element_at(held, -1) + x)))

    def blocks(n: Column) -> Column:
        last = F.floor((F.size(n) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(n, k * BLOCK + 1, F.lit(BLOCK)))

    def totals(parts: Column) -> Column:
        sums = F.transform(parts, lambda b: F.aggregate(b, F.lit(0), lambda t, x: t + x))
        return F.flatten(F.zip_with(parts, _let(sums, lambda t: F.slice(grown(F.lit(0), t), F.lit(1), F.size(t))),
                                    lambda b, first: F.slice(grown(first, b), F.lit(2), F.size(b))))

    return _let(numbers, lambda n: _let(blocks(n), totals))


def _found(text: Column, pattern: str, kind: str, maybe: Column) -> Column:
    """array<struct<start, rank, end, kind, value>> of a pattern's matches; offsets in code points."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")

    def spans(values: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values))
        ends = _running(F.zip_with(gaps, values, lambda g, v: F.length(g) + F.length(v)))
        return F.when(F.size(values) == 0, none).otherwise(F.zip_with(values, ends, lambda v, end: F.struct(
            (end - F.length(v)).alias("start"), F.lit(KINDS.index(kind) if kind in KINDS else 9).alias("rank"),
            end.alias("end"), F.lit(kind).alias("kind"), v.alias("value"))))

    return F.when(maybe, _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).otherwise(none)


def _strict(text: Column, kind: str) -> Column:
    maybe = F.contains(text, F.lit("@" if kind == "email" else "+")) if kind in ("email", "phone") else F.rlike(text, F.lit("[0-9]"))
    return F.filter(_found(text, STRICT[kind], kind, maybe), lambda s: _valid(kind, s["value"]))


def _touched(spans: Column, span: Column) -> Column:
    """Does any of ``spans`` (in order, none overlapping another) overlap ``span``? By binary search."""
    bits = F.sequence(F.length(F.bin(F.size(spans))) - 1, F.lit(0), F.lit(-1))

    def step(before: Column, bit: Column) -> Column:
        further = before + F.pow(F.lit(2), bit).cast("int")
        starts = F.coalesce(F.get(spans, further - 1)["start"] < span["end"], F.lit(False))
        return F.when(starts, further).otherwise(before)

    # of those that start before the span ends, the last one ends last
    return F.coalesce(F.get(spans, F.aggregate(bits, F.lit(0), step) - 1)["end"] > span["start"], F.lit(False))


def _loose(text: Column) -> Column:
    """Candidates that no strict match (columns KINDS) overlaps, with the kind that they could be."""
    mails = _found(text, LOOSE["email"], "email", F.rlike(text, F.lit("@|\\((?:at)\\)|\\[(?:at)\\]")))
    numbers = F.transform(_found(text, LOOSE["number"], "number", F.rlike(text, F.lit("[0-9]"))), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
        F.when(F.length(_digits(s["value"])).between(12, 19) & luhn(_digits(s["value"])), "card")
        .when(F.length(_digits(s["value"])).between(9, 15), "phone").alias("kind"), s["value"].alias("value")))
    # eight groups at most; "::" stands for one or more of them
    six = F.filter(_found(text, LOOSE["ip6"], "ip", F.contains(text, F.lit(":"))), lambda s: F.size(F.split(s["value"], ":")) <= 8)
    dotted = F.filter(_found(text, LOOSE["ip"], "ip", F.rlike(text, F.lit("[0-9]"))),
                      lambda s: F.forall(F.split(s["value"], "[^0-9]+"), _small))
    free = lambda s: ~functools.reduce(operator.or_, (_touched(F.col(k), s) for k in KINDS))
    return F.filter(F.concat(mails, dotted, six, numbers), lambda s: s["kind"].isNotNull() & free(s))


def _contexts(chunks: Column, span: Column) -> Column:
    """Lexical patterns of a span: its two left words, and its left and right word.

    ``chunks`` is the text in pieces of CHUNK characters: a cut out of the whole text would be counted from its start.
    """
    shape = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")

    def two(first: Column) -> Column:
        return F.concat(*(F.coalesce(F.get(chunks, i), F.lit("")) for i in (first, first + 1)))

    left = F.greatest(F.floor(span["start"] / CHUNK).cast("int") - 1, F.lit(0))
    right = F.floor(span["end"] / CHUNK).cast("int")
    at = span["start"] - left * CHUNK
    before = F.split(F.trim(shape(F.substring(two(left), F.greatest(at - CONTEXT, F.lit(0)) + 1,
                                              F.least(at, F.lit(CONTEXT))))), "\\s+")
    after = F.split(F.trim(shape(F.substring(two(right), span["end"] - right * CHUNK + 1, F.lit(CONTEXT)))), "\\s+")
    last = lambda k: F.coalesce(F.get(F.reverse(before), F.lit(k)), F.lit(""))
    return F.array(F.concat_ws(" ", F.lit("<"), last(1), last(0)), F.concat_ws(" ", F.lit("<>"), last(0), F.get(after, F.lit(0))))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _instance(value: Column, kind: Column) -> Column:
    return F.when(kind == "email", F.regexp_replace(F.lower(value), "\\s", "")).when(
        (kind == "ip") & ~value.contains(":"), F.regexp_replace(value, "[^0-9]+", ".")).when(
        kind == "ip", F.lower(value)).otherwise(_digits(value))


def bootstrap(occurrences: DataFrame, rounds: int = ROUNDS, sure: float = SURE, seeds: int = SEEDS) -> DataFrame:
    """(kind, pattern, confidence) of the patterns that admit candidates.

    ``occurrences``: kind, pattern, instance, seed (boolean). A pattern's confidence is the mean score of
    its distinct instances; an instance that is no seed scores 1 - prod(1 - confidence) over its patterns with
    at least ``seeds`` distinct seeds, or 0 in the first round.
    """
    edges = stage(occurrences.groupBy("kind", "pattern", "instance").agg(F.max(F.col("seed").cast("int")).alias("seed")), "edges")
    known = edges.groupBy("kind", "instance").agg(F.max("seed").cast("double").alias("score"))
    patterns = None
    for _ in range(rounds):
        patterns = stage(
            edges.join(known, ["kind", "instance"]).groupBy("kind", "pattern")
            .agg(F.avg("score").alias("confidence"), F.sum("seed").alias("seeds")).where(F.col("seeds") >= seeds), "patterns")
        miss = F.sum(F.log(F.greatest(F.lit(1.0) - F.coalesce("confidence", F.lit(0.0)), F.lit(1e-9))))
        known = edges.join(patterns.select("kind", "pattern", "confidence"), ["kind", "pattern"], "left").groupBy(
            "kind", "instance").agg(F.max("seed").alias("seed"), (F.lit(1.0) - F.exp(miss)).alias("score")).select(
            "kind", "instance", F.when(F.col("seed") == 1, 1.0).otherwise(F.col("score")).alias("score"))
    return patterns.where(F.col("confidence") >= sure).select("kind", "pattern", "confidence")


def personal_data(docs: DataFrame, rounds: int = ROUNDS, sure: float = SURE, seeds: int = SEEDS) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The n_ columns and base_sha256 describe the strict matches; ``spans`` lists those and the n_added
    further ones, as kind:start:end (code points, end exclusive) by start, then kind. Of overlapping
    further spans all are listed. NULL and empty texts have none (empty ``spans``). A row with a NULL
    doc_id is searched like any other, repeated rows too. Empty tables give an empty result; extra
    columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    for kind in KINDS:
        rows = rows.withColumn(kind, _strict(F.col("text"), kind))
    rows = rows.withColumn("base", F.concat(*KINDS)).withColumn("loose", _loose(F.col("text")))
    rows = rows.withColumn("chunks", F.when(F.size("base") + F.size("loose") > 0, F.regexp_extract_all(
        "text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).otherwise(F.array().cast("array<string>")))

    def noted(spans: Column, seed: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
            _instance(s["value"], s["kind"]).alias("instance"), F.lit(seed).alias("seed"), _contexts(F.col("chunks"), s).alias("patterns")))

    rows = stage(rows.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        F.concat(noted(F.col("base"), True), noted(F.col("loose"), False)).alias("found"))
        .withColumn("row", F.monotonically_increasing_id()), "spans")

    each = rows.select("row", F.explode("found").alias("s"))
    occurrences = each.select("s.kind", F.explode("s.patterns").alias("pattern"), "s.instance", "s.seed")
    good = bootstrap(occurrences, rounds, sure, seeds)
    rank = F.when(F.col("s.kind") == "email", 0).when(F.col("s.kind") == "ip", 1).when(F.col("s.kind") == "card", 2).otherwise(3)
    added = (each.where("not s.seed").select("row", "s", F.explode("s.patterns").alias("pattern"), F.col("s.kind").alias("kind"))
             .join(good, ["kind", "pattern"], "left_semi")
             .select("row", F.struct(F.col("s.start").alias("start"), rank.alias("rank"), F.col("s.end").alias("end"),
                                     F.col("s.kind").alias("kind")).alias("span"))
             .groupBy("row").agg(F.collect_set("span").alias("added")))  # one text's spans
    base = F.transform(F.filter("found", lambda s: s["seed"]), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    every = F.concat(base, F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")))
    return rows.join(added, "row", "left").select(
        "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", _joined(every).alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"))
