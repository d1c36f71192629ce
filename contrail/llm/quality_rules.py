"""Quality rules whose cutoffs are certified on labelled documents.

Some measures of a text (symbols, capitals, word lengths, repeats) reject it beyond a cutoff. Which cutoffs hold is
decided per stratum (language) by labels. The labelled documents are split by a hash of their id: the fitting
part orders configurations of cutoffs, each a little stricter than the one before; the holdout then tests them in
that order with an exact binomial test of "more than ``risk`` of the clean documents are rejected". The last
configuration before the first failure is used. A fixed order of tests needs no correction within a stratum;
over the strata the error is divided (Bonferroni), so with probability 1 - ``error`` no stratum loses more
than ``risk`` of its clean documents. A stratum without enough labels keeps all that passes the base rules.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import Batches, longs, stage, text_bytes, window_hashes, word_hashes

#: false rejections of clean documents that a stratum may have, and the probability that any stratum has more
RISK, ERROR = 0.05, 0.05
#: of 100 labelled documents, those that order the configurations; the others test them
FITTING = 30
#: words of a repeated window; base rules: least number of words, repeated words in 100
WINDOW, LEAST_WORDS, MOST_REPEATS = 8, 20, 30

#: fixed values: measure in thousandths (numerator, denominator), whether it rejects above or below, cutoffs from lenient to strict
RULES = (
    ("symbols", "n_symbols", "n_words", "above", (2000, 1000, 500, 300, 200, 100, 50, 20)),
    ("capitals", "n_capitals", "word_chars", "above", (800, 600, 500, 400, 300, 200, 150, 100)),
    ("marks", "n_marks", "n_words", "above", (2000, 1000, 500, 400, 300, 250, 200, 150)),
    ("long_words", "word_chars", "n_words", "above", (14000, 12000, 10000, 9000, 8500, 8000, 7500, 7000)),
    ("short_words", "word_chars", "n_words", "below", (2000, 2500, 3000, 3500, 4000, 4500, 4750, 5000)),
    ("same_lines", "n_dup_lines", "n_lines", "above", (800, 600, 500, 400, 300, 200, 100, 50)),
    ("repeats", "n_repeat_words", "n_words", "above", (250, 200, 150, 100, 70, 50, 30, 10)),
    ("digits", "n_digits", "word_chars", "above", (500, 300, 200, 100, 80, 60, 40, 20)),
)
#: a rule that rejects nothing
OFF = -1

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = (*BASE, "n_capitals", "n_marks", "n_lines", "n_digits")
_SYMBOLS, _MARKS, _DIGITS = re.compile(rb"[#*$%&|<>]"), re.compile(rb"[!?]"), re.compile(rb"[0-9]")
_CAPITALS = re.compile(rb"[A-Z]")
_INSIDE = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no character


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more in the text."""
    if len(words) <= window:
        return 0
    hashes = window_hashes(word_hashes(words), window)
    order = np.argsort(hashes, kind="stable")
    same = np.empty(len(hashes), bool)
    equal = hashes[order][1:] == hashes[order][:-1]
    same[order] = np.append(False, equal) | np.append(equal, False)
    if not same.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(same), 1)
    np.add.at(edge, np.flatnonzero(same) + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: bytes) -> tuple:
    """The values of MEASURED for one UTF-8 text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    joined = b"".join(words)
    chars = len(joined.translate(None, _INSIDE))
    return (len(words), chars, len(_SYMBOLS.findall(joined)), len(lines) - len(set(lines)), repeated_words(words),
            len(_CAPITALS.findall(joined)), len(_MARKS.findall(joined)), len(lines), len(_DIGITS.findall(joined)))


def _measures(batches: Batches) -> Batches:
    for batch in batches:
        values = np.array([measure(t) for t in text_bytes(batch)], np.int64).reshape(-1, len(MEASURED))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["stratum"], *(longs(values[:, i]) for i in range(len(MEASURED)))],
                                         ["doc_id", "stratum", *MEASURED])


def measures(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum (NULL as ''), MEASURED, base_failed per row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    out = texts.mapInArrow(_measures, f"doc_id long, stratum string, {', '.join(f'{c} long' for c in MEASURED)}")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _steps() -> list[Column]:
    """Per rule: how many of its cutoffs the text is beyond, which are then the strictest ones."""
    out = []
    for _, above, below, side, cutoffs in RULES:
        value = F.expr(f"(1000 * {above}) div greatest({below}, 1)")
        beyond = [value > c if side == "above" else value < c for c in cutoffs]
        # cutoffs are nested: a text beyond a lenient one is beyond all stricter ones
        out.append(sum((b.cast("int") for b in beyond), F.lit(0)).alias(f"_{len(out)}"))
    return out


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed down from its largest term."""
    if k >= n:
        return 1.0
    k = min(k, n)
    at, total = min(k, int((n + 1) * p)), 0.0
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    for way in (-1, 1):
        i = at if way < 0 else at + 1
        term = math.exp(log(i)) if 0 <= i <= k else 0.0
        while 0 <= i <= k and term > total * 1e-17:
            total += term
            term *= i / (n - i + 1) * (1 - p) / p if way < 0 else (n - i) / (i + 1) * p / (1 - p)
            i += way
    return min(total, 1.0)


def path(steps: np.ndarray, clean: np.ndarray, weight: np.ndarray, risk: float) -> list[tuple]:
    """Configurations from lenient to strict, by the fitting part's labels: each time the tightening with the most
    rejected low-quality documents per rejected clean one, as long as it rejects more of the former and at most ``risk``
    of the clean ones are rejected in all.

    A configuration has per rule the number of cutoffs used, counted from the lenient end. ``steps`` has the number
    of a rule's cutoffs that a text is beyond; cutoff j (from 0, lenient first) rejects texts with steps >= rules' cutoffs - j.
    """
    most = [len(r[4]) for r in RULES]
    used, out = [0] * len(RULES), []
    gone = np.zeros(len(steps), bool)
    clean_total = weight[clean].sum()
    while True:
        best = None
        lost = weight[gone & clean].sum()
        for r in range(len(RULES)):
            for j in range(used[r] + 1, most[r] + 1):
                new = (steps[:, r] > most[r] - j) & ~gone
                bad, good = weight[new & ~clean].sum(), weight[new & clean].sum()
                if bad <= good or lost + good > risk * clean_total:
                    continue
                rank = (bad / (good + 1.0), -j, -r)
                if best is None or rank > best[0]:
                    best = rank, r, j, new
        if best is None:
            return out
        _, r, j, new = best
        used[r], gone = j, gone | new
        out.append(tuple(used))


def certified(steps: np.ndarray, clean: np.ndarray, fitting: np.ndarray, weight: np.ndarray, risk: float, level: float) -> tuple[tuple, int, int, float]:
    """(configuration, clean holdout documents, those it rejects, p-value) of one stratum; all rules off if none is certified."""
    most = np.array([len(r[4]) for r in RULES])
    chosen = (tuple([0] * len(RULES)), int(weight[~fitting & clean].sum()), 0, 1.0)
    for used in path(steps[fitting], clean[fitting], weight[fitting], risk):
        gone = (steps > most - np.array(used)).any(axis=1)
        n, k = int(weight[~fitting & clean].sum()), int(weight[~fitting & clean & gone].sum())
        p = binomial_tail(k, n, risk) if n else 1.0
        if p > level:
            break
        chosen = used, n, k, p
    return chosen


def _select(risk: float, level: float):
    names = [f"_{i}" for i in range(len(RULES))]

    def run(table: pa.Table) -> pa.Table:
        steps = np.stack([np.asarray(table[c], dtype=np.int64) for c in names], axis=1)
        flag = {c: np.asarray(table[c], dtype=bool) for c in ("clean", "fitting")}
        used, n, k, p = certified(steps, flag["clean"], flag["fitting"], np.asarray(table["documents"], dtype=np.int64), risk, level)
        cutoffs = [RULES[r][4][u - 1] if u else OFF for r, u in enumerate(used)]
        return pa.table({"stratum": [table["stratum"][0].as_py()], "cutoffs": pa.array([cutoffs], pa.list_(pa.int64())),
                         "holdout_clean": pa.array([n], pa.int64()), "holdout_rejected": pa.array([k], pa.int64()), "p_value": [p]})

    return run


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR, fitting: int = FITTING) -> DataFrame:
    """stratum, cutoffs (per rule, OFF if it is not used), holdout_clean, holdout_rejected, p_value.

    ``measured``: rows of :func:`measures`; ``labels``: doc_id, quality. Rows that fail the base rules, and labels with a NULL
    id or quality, take no part; of several labels of one id the lowest holds.
    A stratum is decided in one task from the counts of distinct step vectors and labels, which the ladders bound
    whatever the number of documents.
    """
    label = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna().groupBy(
        "doc_id").agg((F.min("quality") > 0).alias("clean"))
    part = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(100)) < fitting).alias("fitting")
    counts = measured.where("not base_failed").select("doc_id", "stratum", *_steps()).join(label, "doc_id").groupBy(
        "stratum", "clean", part, *(f"_{i}" for i in range(len(RULES)))).agg(F.count("*").alias("documents"))
    counts = stage(counts, "quality-counts")
    strata = counts.select("stratum").distinct().count()
    return counts.groupBy("stratum").applyInArrow(
        _select(risk, error / max(strata, 1)), "stratum string, cutoffs array<long>, holdout_clean long, holdout_rejected long, p_value double")


def quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR, fitting: int = FITTING) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by per row of ``docs``.

    ``rejected_by`` lists the certified rules that the text breaks. NULL texts count as empty, and fail the base rules; a NULL stratum
    is one of its own. Repeated rows and ids are judged each by their own text (a label holds for all rows of its id); a
    NULL doc_id has no label. Without labels all that passes the base rules is kept. An empty table gives no rows; further
    columns are not read.
    """
    measured = stage(measures(docs, stratum), "quality-measures")
    chosen = thresholds(measured, labels, risk, error, fitting).select("stratum", "cutoffs")
    broken = []
    for r, (name, above, below, side, _) in enumerate(RULES):
        value, cutoff = F.expr(f"(1000 * {above}) div greatest({below}, 1)"), F.col("cutoffs")[r]
        broken.append(F.when((cutoff != OFF) & (value > cutoff if side == "above" else value < cutoff), F.lit(name)))
    rejected = F.when(F.col("cutoffs").isNull(), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*broken)))
    out = measured.join(chosen, "stratum", "left").withColumn("rejected_by", rejected)
    return out.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"), "rejected_by")
