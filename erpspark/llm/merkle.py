"""Merkle fingerprints of documents, in DataFrame functions only.

The text is cut without loss: sections are runs of paragraphs, paragraphs are lines, leaves are sentences of
a paragraph (sentences over `LEAF_CHARS` code points are cut further). Hashes go upwards: leaves make the
paragraph's hash, paragraphs the section's, sections the root. A section ends after an empty paragraph or
where the paragraph's hash is divisible by `SECTION_EVERY`, so that insertions do not move later sections.

A fingerprint is `root/section;section…` with `hash>leaves,leaves…` per section and 8 hex digits per leaf.
Equal roots mean equal texts; where roots differ, sections and then leaves locate the edit.

Defined results: null text is empty; the empty text has a root and one empty leaf; rows that agree in doc_id
and text count once when neighbours are sought; documents with one doc_id are ordered by the hash of their text;
a null doc_id comes first; a single document is its own neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from erpspark.llm.quality_rules import let
from erpspark.llm.scratch import stored

LEAF_CHARS = 80
SECTION_EVERY = 4

_LEAF = r"[^.!?]{1,%d}[.!?]* *|[.!?]+ *"


def _hex8(h: Column) -> Column:
    return F.lpad(F.hex(F.pmod(h, F.lit(1 << 32))), 8, "0")


def paragraphs(text: Column, leaf_chars: int = LEAF_CHARS) -> Column:
    """(hash, leaves as hex, ends a section) per paragraph."""

    def of(p: Column) -> Column:
        leaves = F.transform(F.regexp_extract_all(p, F.lit(_LEAF % leaf_chars), F.lit(0)), lambda x: F.xxhash64(x))
        # an empty paragraph has the hash of no leaf, and counts as one leaf
        return let(leaves, lambda x: F.struct(F.xxhash64(x).alias("h"), F.when(F.size(x) == 0, F.lit("00000000")).otherwise(F.array_join(F.transform(x, lambda h: _hex8(h)), "")).alias("leaves")))

    return F.transform(F.split(text, "\n", -1), of)


def fingerprint(text: Column, leaf_chars: int = LEAF_CHARS) -> Column:
    """The fingerprint string of a text column."""

    def sections(ps: Column) -> Column:
        ends = F.transform(ps, lambda p, i: F.when((i == F.size(ps) - 1) | (p["leaves"] == "00000000") | (F.pmod(p["h"], F.lit(SECTION_EVERY)) == 0), i))
        bounds = F.filter(ends, lambda e: e.isNotNull())

        def cut(b: Column) -> Column:
            def section(e: Column, i: Column) -> Column:
                first = F.when(i > 0, F.get(b, i - 1) + 1).otherwise(F.lit(0))
                part = F.slice(ps, first + 1, e - first + 1)
                return let(part, lambda x: F.struct(F.xxhash64(F.transform(x, lambda p: p["h"])).alias("h"), F.array_join(F.transform(x, lambda p: p["leaves"]), ",").alias("leaves")))

            return F.transform(b, section)

        return let(bounds, cut)

    def render(s: Column) -> Column:
        root = F.substring(F.sha2(F.array_join(F.transform(s, lambda x: F.hex(x["h"])), ","), 256), 1, 32)
        return F.concat(root, F.lit("/"), F.array_join(F.transform(s, lambda x: F.concat(_hex8(x["h"]), F.lit(">"), x["leaves"])), ";"))

    return let(let(paragraphs(text, leaf_chars), sections), render)


def leaves(print_: Column) -> Column:
    """Leaf hashes of a fingerprint."""
    body = F.regexp_replace(F.substring_index(print_, "/", -1), "[0-9A-F]{8}>|[,;]", "")
    return F.regexp_extract_all(body, F.lit("[0-9A-F]{8}"), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the share of distinct leaves that both have (twice the common over the sum of both)."""
    shared = let(leaves(a), lambda x: let(leaves(b), lambda y: 2.0 * F.size(F.array_intersect(x, y)) / (F.size(F.array_distinct(x)) + F.size(F.array_distinct(y)))))
    return F.when(F.substring_index(a, "/", 1) == F.substring_index(b, "/", 1), F.lit(1.0)).otherwise(F.least(shared, F.lit(1.0)))


def edited_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections of `b` that `a` does not have: where an edit lies."""
    heads = lambda x: F.transform(F.split(F.substring_index(x, "/", -1), ";"), lambda s: F.substring_index(s, ">", 1))
    return let(heads(a), lambda x: F.filter(F.transform(heads(b), lambda s, i: F.when(~F.array_contains(x, s), i)), lambda i: i.isNotNull()))


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, mark, n_chars and the same of the next document in ascending order (after the last: the first), on narrow rows only.

    Rows are range partitioned; each partition finds its own neighbours, and the last row of each takes the first
    row of the next partition from a table that has one row per partition.
    """
    narrow = docs.select("doc_id", "mark", F.length("text").cast("long").alias("n_chars")).distinct()
    ranged = stored(narrow.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("mark")).withColumn("part", F.spark_partition_id()), "ranged-ids")
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), F.col("mark"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("mark")]
    inside = ranged.withColumn("next", F.lead(F.struct("doc_id", "mark")).over(Window.partitionBy("part").orderBy(*order)))
    firsts = ranged.groupBy("part").agg(F.min(key).alias("first"))
    by_part = Window.orderBy("part")  # one row per partition
    after = firsts.select("part", F.coalesce(F.lead("first").over(by_part), F.first("first").over(by_part)).alias("first"))
    return inside.join(F.broadcast(after), "part").select(
        "doc_id", "mark", "n_chars", F.coalesce("next", F.struct(F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias("mark"))).alias("next")
    )


def edit_prints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text (its last quarter replaced by the next document's beginning) and the likenesses."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    order = stored(neighbours(texts), "neighbours")
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    # what each document owes to the one before it: the beginning that goes there, and its fingerprint
    owes = order.select(F.col("next.doc_id").alias("n_id"), F.col("next.mark").alias("n_mark"), F.col("doc_id").alias("to_id"), F.col("mark").alias("to_mark"), cut.alias("cut"))
    given = (
        texts.join(owes, texts["doc_id"].eqNullSafe(owes["n_id"]) & (texts["mark"] == owes["n_mark"]))
        .select("to_id", "to_mark", F.expr("substring(text, 1, cut)").alias("head"), "cut", fingerprint(F.col("text")).alias("next_print"))
        .dropDuplicates(["to_id", "to_mark"])
    )
    joined = texts.join(given, texts["doc_id"].eqNullSafe(given["to_id"]) & (texts["mark"] == given["to_mark"]))
    edited = joined.select("doc_id", "text", "next_print", F.concat(F.expr("substring(text, 1, length(text) - cut)"), "head").alias("edited"))
    prints = edited.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        let(fingerprint(F.col("text")), lambda a: F.struct(a.alias("a"))).alias("own"), fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_print",
    )
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", F.col("own.a").alias("fingerprint"), "edited_fingerprint",
        likeness(F.col("own.a"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("own.a"), F.col("next_print")).alias("near_next"),
    )
