"""Operator 2: exact duplicates by a 128-bit hash, confirmed byte by byte.

``exact_groups`` gives every document the id of the copy that stays;
``exact_dedup`` keeps only those rows.

Texts are equal when identical after each run of white space
(``[\\x20\\x09-\\x0D]+``) is replaced by one space; a null text counts as empty.
Of equal texts the smallest id stays; a null id stays only if the group has no
other. Repeated rows (same id, same text) are one document, of one result row, and
``group_size`` counts every row; with ``every_row``, as in the query, each gives a
result row, and of those that stay the first is ``kept``. Empty table: empty result. Extra columns are
ignored by ``exact_groups`` and kept by ``exact_dedup``, whatever their names.

Plan: (id, md5) rows are pre-aggregated before they are shuffled; texts move
only to be compared, and only those of groups with more than one document. In
a group each text is compared with the one of the smallest id; the join on the
hash has one row a group on its right side, a written table, so AQE can split a hot
hash. Texts
that differ in spite of the same hash go through the same step again among
themselves, until none is left, so a collision never drops a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import WS, numbered, read, stored


STEP = 10_000             # rows that one step gives of a row that repeats


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS, " ")


def _md5(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _as_often(rows: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, one of them ``_first``; in steps, so that no array is
    longer than ``STEP``."""
    steps = rows.withColumn("_from", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {STEP})")))
    return steps.withColumn("_i", F.explode(F.expr(
        f"sequence(1L, least({STEP}L, {times} - {STEP} * _from))"))).withColumn(
        "_first", F.expr("_from = 0 AND _i = 1")).drop("_from", "_i")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hash_of=_md5, every_row: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each document, or for
    each row.

    ``hash_of`` maps the normalised text to its grouping hash (md5 by default;
    tests pass a weak one to see collisions told apart).
    """
    norm = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("_t"))
    keyed = norm.select("doc_id", hash_of(F.col("_t")).alias("_h"),
                        F.sha2(F.col("_t"), 256).alias("text_sha256"))
    rows = stored(keyed.groupBy("_h", "text_sha256", "doc_id").agg(F.count("*").alias("_n")),
                  "op2-rows")
    groups = stored(_groups(rows), "op2-groups")
    shared = groups.filter("_docs > 1").select("_h", "_keep")
    single = rows.join(groups.filter("_docs = 1").select("_h", "_keep", "_rows"), "_h").select(
        "doc_id", F.col("_keep").alias("keep_id"), F.col("_rows").alias("group_size"),
        "text_sha256", "_n")
    # the texts of shared hashes, each document once
    left = stored(norm.withColumn("_h", hash_of(F.col("_t")))
                  .join(shared.select("_h"), "_h", "left_semi")
                  .groupBy("_h", "doc_id", "_t").agg(F.count("*").alias("_n")), "op2-texts")
    found = [single]
    while True:
        first = left.groupBy("_h").agg(F.min("doc_id").alias("_keep"))
        texts = first.alias("f").join(
            left.alias("l"), F.expr("f._h = l._h AND f._keep <=> l.doc_id")).select(
            F.col("f._h"), F.col("_keep"), F.col("l._t").alias("_kt"))
        # two texts under one id and hash: the smaller text leads
        texts = stored(texts.groupBy("_h", "_keep").agg(F.min("_kt").alias("_kt")), "op2-firsts")
        told = stored(left.join(texts, "_h").withColumn("_same", F.col("_t") == F.col("_kt")),
                      "op2-told")
        same = told.filter("_same")
        sizes = stored(same.groupBy("_h").agg(F.sum("_n").alias("group_size")), "op2-sizes")
        found.append(same.join(sizes, "_h").select(
            "doc_id", F.col("_keep").alias("keep_id"), "group_size",
            F.sha2(F.col("_t"), 256).alias("text_sha256"), "_n"))
        left = told.filter("NOT _same").select("_h", "doc_id", "_t", "_n")
        if left.isEmpty():
            break
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    kept = F.expr("doc_id <=> keep_id")
    if every_row:                    # of rows that repeat, one stays
        out, kept = _as_often(out, "_n"), kept & F.col("_first")
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_h").agg(F.count("*").alias("_docs"), F.sum("_n").alias("_rows"),
                                  F.min("doc_id").alias("_keep"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Repeated rows of a document that stays are one row (which of them, if their
    other columns differ, is the smallest by those columns).
    """
    kept = exact_groups(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_s")).distinct()
    rows = numbered(docs)
    columns = rows.columns
    own = F.col(columns[docs.columns.index(id_col)])
    rows = rows.withColumn("_own", F.sha2(normalised(F.col(columns[docs.columns.index(text_col)])), 256))
    stay = rows.join(kept, own.eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_s")))
    return stay.groupBy("_id", "_own").agg(F.min(F.struct(*columns)).alias("_r")).select(
        "_r.*").toDF(*docs.columns)


def run(spark, sf_dir) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents"), every_row=True)


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w
         AND row_number() OVER (PARTITION BY n, doc_id) = 1 AS kept, sha256(n) AS text_sha256
FROM t WINDOW w AS (PARTITION BY n)
"""
