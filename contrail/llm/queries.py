"""Registered queries of the dealt operators over the shared tables, and their DuckDB SQL."""

from __future__ import annotations

import functools
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import (decontaminate, exact_dedup, language_id, lexical_search, license_scan, line_dedup, lm_score,
                          near_dedup, packing, pii, quality_rules, source_divergence, substring_dedup)
from contrail.llm.common import documents


def _probe():
    """A function that is sent by value: it cannot need the package that it looks for."""
    def run(batches):
        import importlib.util

        import pyarrow

        for batch in batches:
            found = [importlib.util.find_spec("contrail") is not None] * len(batch)
            yield pyarrow.RecordBatch.from_arrays([pyarrow.array(found)], ["ok"])

    run.__module__ = "__main__"
    return run


@functools.lru_cache(maxsize=1)
def _shipped(application: str) -> None:
    """Send this package to the executors, unless they can import it already."""
    spark = SparkSession.active()
    if spark.range(1).mapInArrow(_probe(), "ok boolean").first()["ok"]:
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="contrail-package-")  # on the driver: Spark serves the archive from here
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/contrail", "zip", root, "contrail"))


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _shipped(spark.sparkContext.applicationId)
        return function(spark, sf_dir)

    return run


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(documents(spark, sf_dir))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.ppm_scores(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(documents(spark, sf_dir), min_equal=line_dedup.MIN_EQUAL)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(documents(spark, sf_dir))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.strip_repeats(documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergences(documents(spark, sf_dir))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: _query(f) for f in (
    op1_near_dedup, op2_lm_score, op3_packing, op4_exact_dedup, op5_pii, op6_line_dedup, op7_license_scan,
    op8_decontaminate, op9_language_id, op10_substring_dedup, op11_lexical_search, op12_source_divergence, op13_quality_rules,
    pipeline)}

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op1_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_FOLD)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
e AS (SELECT x AS u, y AS v FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS u, doc_id AS c FROM documents UNION SELECT e.u, r.c FROM r JOIN e ON e.v = r.u WHERE r.c < e.u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.c) AS component_id, min(r.c) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.u = d.doc_id GROUP BY 1, 2""",
    "op4_exact_dedup": f"""
WITH t AS (SELECT doc_id, {_FOLD} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(t) AS text_sha256 FROM t WINDOW g AS (PARTITION BY t)""",
    "op10_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM w WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h FROM g),
o AS (SELECT h, min(doc_id) AS first FROM h GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM h JOIN o USING (h) WHERE doc_id > first),
k AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY 1)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, j: NOT coalesce(list_contains(gone, j), false)), ' ')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""",
    "op11_lexical_search": r"""
WITH w AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({fold}, '{term}') AS w FROM documents),
t AS (SELECT d, unnest(w) AS t FROM w),
f AS (SELECT d, t, count(*) AS tf FROM t GROUP BY 1, 2),
c AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM w WHERE len(w) > 0),
m AS (SELECT d, doc_id, 50 + (50 * len(w) * c.n) // c.l AS m FROM w, c WHERE len(w) > 0),
q AS (SELECT row_number() OVER () AS i, item_id, unnest(list_distinct(regexp_extract_all({fold}, '{term}'))) AS t FROM benchmark),
df AS (SELECT t, floor(1000 * ln((2 * max(c.n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, c GROUP BY 1),
s AS (SELECT i, item_id, d, doc_id, sum(df.w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN f USING (t) JOIN df USING (t) JOIN m USING (d) GROUP BY ALL HAVING score > 0)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM s
QUALIFY rank <= 50""".replace("{fold}", _FOLD).replace("{term}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"),
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all({fold}, '{term}') AS w FROM documents),
t AS (SELECT d, lang, source, unnest(w) AS t FROM d),
k AS (SELECT lang, t, count(*) AS c FROM t GROUP BY 1, 2 HAVING count(DISTINCT d) >= 30),
l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, t, count(*) AS c FROM t SEMI JOIN k USING (lang, t) GROUP BY 1, 2, 3),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.t, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(n.n, 0) + 5 * l.v) AS p,
      1 + (1000000000::HUGEINT * (k.c + 5)) // (l.n + 5 * l.v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN n USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', t, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= 50""".replace("{fold}", _FOLD).replace("{term}", r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"),
}
