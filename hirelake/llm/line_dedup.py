r"""Operator 5: repeated lines, found by overlapping windows of three lines.

A text is cut at ``\n``; every three consecutive lines are a window. Windows
are compared over all documents; the first occurrence (smallest document, then
position) stays, and each line covered by any later occurrence goes. Windows
are judged on the input. Native DataFrame functions only.

Defined cases: a null or empty text has one empty line and no window; so has
any text of one or two lines, which stays whole. A null id comes after all
others. Rows that repeat id and text are one document and share their fate.
Windows inside one document count too: of ``a a a a a`` one ``a`` stays, since
every window but the first is a later one. Empty table: empty result. Extra
columns are passed through by ``line_dedup``.

Plan: a window is a row of its 128-bit hash (two xxhash64 chains with different
seeds) and place, never of its text. First places are pre-aggregated per hash
before the shuffle and those of repeated windows written as a table; occurrences
meet it in a join whose right side has one row a hash, so AQE splits a window that
half the corpus holds. Covered lines are
merged per document, and the texts are shuffled once, to meet them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import read, stored

SPAN = 3


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  span: int = SPAN) -> DataFrame:
    """``_id, _key, _covered``: the covered positions (from 0) of each document
    that loses lines; ``_key`` is the hash that tells texts under one id apart."""
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"),
                       _lines(F.col(text_col)).alias("_l"))

    def window(i):
        lines = [F.get("_l", i + j) for j in range(span)]
        return F.struct(F.xxhash64(*lines).alias("a"),
                        F.xxhash64(F.lit(span), *reversed(lines)).alias("b"))

    places = F.when(F.size("_l") >= span, F.sequence(F.lit(0), F.size("_l") - span))
    windows = rows.select("_id", "_key", F.posexplode(F.transform(places, window))).select(
        "_id", "_key", F.col("pos").alias("_pos"), F.col("col.a").alias("_a"),
        F.col("col.b").alias("_b"))
    place = F.struct(F.isnull("_id").alias("no_id"), F.col("_id").alias("id"),
                     F.col("_key").alias("key"), F.col("_pos").alias("pos"))
    firsts = stored(windows.groupBy("_a", "_b").agg(
        F.min(place).alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"),
        "op5-firsts")
    later = windows.join(firsts, ["_a", "_b"]).filter(
        ~place.eqNullSafe(F.col("_first")))
    per_doc = later.groupBy("_id", "_key").agg(F.collect_set("_pos").alias("_starts"))
    covered = F.array_distinct(F.flatten(F.transform(
        "_starts", lambda p: F.sequence(p, p + (span - 1)))))
    return per_doc.select("_id", "_key", covered.alias("_covered"))


def _kept(docs: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    """``docs`` as struct ``d`` with ``lines``, ``covered`` and the ``kept`` text."""
    cut = removed_lines(docs, id_col, text_col, span)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("d"))
    rows = rows.withColumn("_k", F.xxhash64(F.col("d")[text_col]))
    joined = rows.join(cut, F.col("d")[id_col].eqNullSafe(F.col("_id"))
                       & (F.col("_k") == F.col("_key")), "left")
    lines = _lines(F.col("d")[text_col])
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_covered"))
    kept = F.when(F.col("_covered").isNull(), F.col("d")[text_col]).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return joined.select("d", F.size(lines).cast("long").alias("lines"),
                         F.coalesce(F.size("_covered"), F.lit(0)).cast("long").alias("covered"),
                         kept.alias("kept"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               span: int = SPAN) -> DataFrame:
    """``docs`` with repeated lines cut out of its text; every row stays."""
    rows = _kept(docs, id_col, text_col, span)
    return rows.select(*[F.col("kept" if c == text_col else f"d.`{c}`").alias(c)
                         for c in docs.columns])


def run(spark, sf_dir) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` of every document."""
    return _kept(read(spark, sf_dir, "documents"), "doc_id", "text", SPAN).select(
        F.col("d.doc_id"), F.col("lines").alias("n_lines"), F.col("covered").alias("n_removed"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT doc_id, p, l[p] || chr(10) || l[p + 1] || chr(10) || l[p + 2] AS w
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM d)),
o AS (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS rn FROM w),
c AS (SELECT DISTINCT doc_id, p + k AS i FROM o, (VALUES (0), (1), (2)) AS v(k) WHERE rn > 1),
k AS (SELECT doc_id, list(i) AS cut FROM c GROUP BY doc_id)
SELECT d.doc_id, len(l)::BIGINT AS n_lines, coalesce(len(cut), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN cut IS NULL THEN array_to_string(l, chr(10)) ELSE coalesce(
           (SELECT string_agg(u.x, chr(10) ORDER BY u.i)
            FROM (SELECT unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i) AS u
            WHERE NOT list_contains(cut, u.i)), '') END) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
