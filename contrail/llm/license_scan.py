"""License texts and notices by canonical digest, in DataFrame functions only.

A text is brought to a canonical form (lower case, no copyright lines, punctuation and layout
gone, equivalent spellings unified) and hashed whole. The digests of every document as a whole, of
each of its paragraphs and of each of its lines are joined with the digests of the known texts,
which went through the same form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.license_texts import KNOWN

#: fixed values: equivalent spellings, each written as the second; the first is one word, so that no line break divides it
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sublicence", "sub license"), ("sublicense", "sub license"), ("acknowledgement", "acknowledgment"),
    ("favour", "favor"), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"), ("organisation", "organization"),
    ("noncommercial", "non commercial"), ("percent", "per cent"), ("holder", "owner"),
    ("holders", "owners"), ("whilst", "while"), ("wilful", "willful"), ("https", "http"),
)
#: what follows "copyright" in the running text of a license, where a wrapped line may begin with it
_RUNNING = ("(?:notice|holder|owner|law|license|licence|statement|interest|disclaimer|permission|doctrine|line|protection)s?"
            "|ownership|treaty|treaties|and|or|in|on|if|are|is|also|the +(?:software|library|program|work)")
_NOTICE = (f"copyright(?![\\p{{L}}\\p{{N}}]|-\\p{{L}})(?![^\\p{{L}}\\p{{N}}\\n(©<\\[{{]*+(?:(?:{_RUNNING})(?![\\p{{L}}\\p{{N}}])|$))"
           "(?![,;.\"')\\]]++[ \\t]*+(?![\\p{N}(©]))"
           "|\\(c\\)[ \\t]*+(?:copyright(?!\\p{L})|[\\p{N}<\\[{]|(?!(?:you|under) )(?:\\S++[ \\t]*+){1,4}+$)"  # "(c)" may also number a clause
           "|©|all rights reserved")
_COPYRIGHT = f"(?m)^[^\\p{{L}}\\p{{N}}\\n(©]*(?:{_NOTICE})[^\\n]*$"


def canonical(text: Column) -> Column:
    """Canonical form; line breaks stay. A line that gives notice of copyright (a year, sign or name follows) becomes empty."""
    out = F.regexp_replace(F.lower(text), _COPYRIGHT, "")
    out = F.regexp_replace(out, "[^\\p{L}\\p{N}\\n]+", "  ")  # two spaces: every word has its own on either side
    out = F.concat(F.lit(" "), F.replace(out, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.regexp_replace(out, " +", " ")


def _digest(unit: Column) -> Column:
    """Digest of a unit of canonical text, NULL if nothing is left of it."""
    words = F.trim(F.regexp_replace(unit, "[ \\n]+", " "))
    return F.when(words != "", F.sha2(words, 256))


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """(digest, license_id) of the known texts; of two with one canonical form the smaller id."""
    if known is None:
        known = spark.createDataFrame(list(KNOWN), "license_id string, text string")
    return known.select("license_id", _digest(canonical(F.col("text"))).alias("digest")).where(
        "digest is not null and license_id is not null").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, unit, number, license_id: every document, paragraph or line that is a known license text.

    ``unit`` is text, paragraph or line; ``number`` counts paragraphs (parts between empty lines) or
    lines from 0. A text of one paragraph is reported as text, a paragraph of one line as line, so
    nothing is reported twice. Rows only for documents with a find. NULL and empty texts have
    none; a row with a NULL doc_id is reported with a NULL; repeated rows as often as they occur. ``known``
    (license_id, text) replaces the built-in list; Spark broadcasts its digests if they are small.
    """
    form = docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical(F.col("text")).alias("form")).where(
        "form is not null")
    paragraphs = F.filter(F.split("form", "\\n(?: *\\n)+"), lambda p: F.trim(F.replace(p, F.lit("\n"), F.lit(" "))) != "")
    lines = F.split("form", "\n")
    several = lambda p: F.trim(F.regexp_replace(p, "^[ \\n]+|[ \\n]+$", "")).contains("\n")

    def units(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.lit(kind).alias("unit"), i.alias("number"), _digest(p).alias("digest")))

    whole = F.when(F.size(paragraphs) > 1, F.array("form")).otherwise(F.array().cast("array<string>"))
    blocks = F.transform(paragraphs, lambda p: F.when(several(p), p))
    found = form.select("doc_id", F.explode(F.concat(units("text", whole), units("paragraph", blocks), units("line", lines))).alias("u"))
    found = found.select("doc_id", "u.unit", "u.number", "u.digest").where("digest is not null")
    return found.join(known_digests(docs.sparkSession, known), "digest").select("doc_id", "unit", "number", "license_id")
