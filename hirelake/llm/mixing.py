r"""Operator 9: mix sources to target weights by a low-discrepancy schedule.

A document's size is its number of words (``[^\x20\x09-\x0D]+``; null text: 0).
Sources in code-point order, null last, weigh 1, 2, 3, 1, ...; each gets its
weight's share of all words, but at most ``max_epochs`` (3) times its own size;
what that leaves over goes to the others by weight, until none is above.

Schedule. The words of all sources are dealt in about ``slots`` slots of equal
size. Slot j is the golden-ratio point frac((j + 1/2) * 0.618...), mapped
through the sources' cumulative shares, so each source appears evenly all along
the mix. A source's documents, shuffled by a hash of their id, are laid end to
end and cut into blocks of the slot size; the r-th slot of a source takes its
r-th block, from the first again after the last. A source ends when its target
(rounded to whole words) is reached: its last block is cut there, and if its
slots end a little before, closing slots follow the others. So taken words
equal the rounded target, and no document is taken more than 3 times.

Defined cases: null ids shuffle as an empty text would; repeated rows are
documents of their own; a document without words, and a source without words,
take no part (taken 0); an empty table gives an empty result; extra columns are
ignored, ``mixed_documents`` passes them through. Native functions only.

Plan: texts are read once for their sizes; only (id, source, size) rows are
shuffled. Ranks of slots and positions of documents are running sums of a hot
source too, so both are summed in two levels: totals per (source, chunk), then
inside each chunk. The tables with one row a source are as small as the list of
sources; slots meet sources over a grid of equal intervals, an equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import WS, read, stored, word_count

SLOTS = 1 << 20       # about so many slots in a mix
MAX_EPOCHS = 3
CHUNK = 4096          # slots ranked together; also hash buckets of a source
GRID = 4096           # intervals over which points meet sources
GOLDEN = 0.6180339887498949


def sized(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
                       word_count(F.col(text_col)).alias("_size"),
                       F.xxhash64(text_col).alias("_key"))


def source_targets(rows: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row a source: ``_no`` (from 0), ``_total``, ``_target``, ``_goal`` words."""
    per = rows.groupBy("_source").agg(F.sum("_size").alias("_total"))
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    per = per.withColumn("_no", F.row_number().over(order) - 1)
    per = per.withColumn("_w", F.col("_no") % 3 + 1)
    # fill sources in the order in which they meet their limit; the level is that
    # of the first one whose share is not above it
    limit = F.lit(max_epochs) * F.col("_total")
    by = Window.orderBy(limit / F.col("_w"), "_no")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("_all", F.sum("_total").over(everything))
    per = per.withColumn("_level", (F.col("_all") - F.coalesce(F.sum(limit).over(before),
                                                               F.lit(0))).cast("double")
                         / F.sum("_w").over(after).cast("double"))
    per = per.withColumn("_k", F.row_number().over(by))
    fits = F.when(F.col("_level") <= limit / F.col("_w"), F.struct("_k", "_level"))
    per = per.withColumn("_level", F.min(fits).over(everything)["_level"])
    target = F.least(limit.cast("double"), F.col("_level") * F.col("_w"))
    return per.select("_source", "_no", "_total", "_all", target.alias("_target"),
                      F.floor(target + 0.5).cast("long").alias("_goal"))


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Every document's first word ``_at`` in its source's shuffled stream."""
    known = rows.join(sources.select(F.col("_source").alias("_s"), "_no", "_total", "_target",
                                     "_goal"), F.col("_source").eqNullSafe(F.col("_s")))
    known = known.withColumn("_h", F.md5(F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    known = known.withColumn("_bucket", F.substring("_h", 1, 3))
    sums = known.groupBy("_no", "_bucket").agg(F.sum("_size").alias("_sum"))
    across = Window.partitionBy("_no").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = sums.select("_no", "_bucket",
                        F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_no", "_bucket").orderBy("_h", "_id", "_size", "_key").rowsBetween(
        Window.unboundedPreceding, -1)
    return known.join(bases, ["_no", "_bucket"]).withColumn(
        "_at", F.col("_base") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))


def schedule(sources: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The mix in order: ``slot, _no, epoch, block, words`` and the block size."""
    spark = sources.sparkSession
    total, n_sources = sources.agg(F.max("_all"), F.count("*")).first()
    total = total or 0
    size = max(1, -(-total // slots))
    n = -(-total // size)
    share = F.col("_target") / F.greatest(F.col("_all"), F.lit(1)).cast("double")
    to = Window.orderBy("_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = sources.withColumn("_to", F.sum(share).over(to))
    last = F.lead("_no").over(Window.orderBy("_no")).isNull()
    spans = spans.select("_no", "_total", "_goal",
                         F.coalesce(F.lag("_to").over(Window.orderBy("_no")), F.lit(0.0)).alias("_from"),
                         F.when(last, F.lit(2.0)).otherwise(F.col("_to")).alias("_to"))
    cells = spans.filter("_goal > 0").withColumn("_cell", F.explode(F.sequence(
        F.least(F.floor(F.col("_from") * GRID), F.lit(GRID - 1)),
        F.least(F.floor(F.col("_to") * GRID), F.lit(GRID - 1)))))
    points = spark.range(n).withColumnRenamed("id", "slot").withColumn(
        "_u", (F.col("slot") + 0.5) * GOLDEN % 1.0)
    dealt = points.withColumn("_cell", F.floor(F.col("_u") * GRID)).join(cells, "_cell").filter(
        "_u >= _from AND _u < _to").select("slot", "_no", F.floor(F.col("slot") / CHUNK).alias("_c"))
    counts = dealt.groupBy("_no", "_c").agg(F.count("*").alias("_n"))
    across = Window.partitionBy("_no").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("_base", F.coalesce(F.sum("_n").over(across), F.lit(0)))
    inside = Window.partitionBy("_no", "_c").orderBy("slot")
    ranked = dealt.join(bases, ["_no", "_c"]).select(
        "slot", "_no", (F.col("_base") + F.row_number().over(inside) - 1).alias("rank"))
    # the rank that holds a source's last word, and how many ranks its slots gave
    blocks = F.ceil(F.col("_total") / F.lit(size))
    end = F.col("_goal") - 1
    last_rank = F.expr(f"(_goal - 1) div _total * ceil(_total / {size}) "
                       f"+ (_goal - 1) % _total div {size}")
    needs = sources.filter("_goal > 0").join(
        counts.groupBy("_no").agg(F.sum("_n").alias("_had")), "_no", "left").select(
        "_no", "_total", "_goal", last_rank.cast("long").alias("_last"),
        F.coalesce("_had", F.lit(0)).alias("_had"))
    closing = needs.filter("_had <= _last").select(
        F.explode(F.sequence("_had", "_last")).alias("rank"), "_no", "_had").select(
        (F.lit(n) + (F.col("rank") - F.col("_had")) * n_sources + F.col("_no")).alias("slot"),
        "_no", "rank")
    taken = ranked.unionByName(closing).join(needs, "_no").filter("rank <= _last")
    per_epoch = blocks.cast("long")
    taken = taken.withColumn("epoch", F.floor(F.col("rank") / per_epoch)).withColumn(
        "block", F.col("rank") % per_epoch)
    before = F.col("epoch") * F.col("_total") + F.col("block") * size
    length = F.least(F.lit(size), F.col("_total") - F.col("block") * size)
    return taken.select("slot", "_no", "epoch", "block",
                        F.least(length, end + 1 - before).alias("words"),
                        F.lit(size).alias("_block_size"))


def _mixed(docs, id_col, text_col, source_col, slots, max_epochs):
    """Placed documents with ``_taken``, and the pieces in the order of the mix."""
    rows = stored(sized(docs, id_col, text_col, source_col), "op9-sizes")
    sources = stored(source_targets(rows, max_epochs), "op9-sources")
    placed = stored(_placed(rows, sources), "op9-placed")
    plan = stored(schedule(sources, slots), "op9-schedule")
    size = (plan.select("_block_size").first() or (1,))[0]
    cut = placed.filter("_size > 0").withColumn("block", F.explode(F.expr(
        f"sequence(_at div {size}, (_at + _size - 1) div {size})")))
    cut = cut.select("_no", "_at", "_id", "block",
                     F.greatest(F.lit(0), F.col("_at") - F.col("block") * size).alias("_in"),
                     F.least(F.lit(size), F.col("_at") + F.col("_size")
                             - F.col("block") * size).alias("_out"))
    pieces = plan.join(cut, ["_no", "block"]).filter("_in < words").select(
        "slot", "_no", "_at", "_id", "epoch",
        (F.col("block") * size + F.col("_in") - F.col("_at")).alias("first_word"),
        (F.least("_out", "words") - F.col("_in")).alias("words"))
    taken = pieces.groupBy("_no", "_at").agg(F.sum("words").alias("_taken"))
    p, t = placed.alias("p"), taken.alias("t")
    done = p.join(t, F.expr("p._no = t._no AND p._at = t._at AND p._size > 0"), "left").select(
        "p.*", F.coalesce("t._taken", F.lit(0)).alias("_taken"))
    return done, pieces


def mix_sources(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
                slots: int = SLOTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """What the mix takes of each document, in words."""
    done, _ = _mixed(docs, id_col, text_col, source_col, slots, max_epochs)
    return done.select(F.col("_id").alias(id_col), F.col("_size").alias("size"),
                       F.col("_total").alias("source_size"), F.col("_target").alias("target"),
                       F.col("_taken").alias("taken"))


def mix_pieces(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
               slots: int = SLOTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: ``slot`` gives its order, each row some words of a document."""
    _, pieces = _mixed(docs, id_col, text_col, source_col, slots, max_epochs)
    return pieces.select("slot", F.col("_id").alias(id_col), "epoch", "first_word", "words")


def mixed_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
                    slots: int = SLOTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` as the mix holds them: a row for each time a document is taken.

    The one document of a source at which its target ends is cut to the words
    taken of it (joined by single spaces); all others are whole.
    """
    done, _ = _mixed(docs, id_col, text_col, source_col, slots, max_epochs)
    same = Window.partitionBy("_id", "_source", "_key")
    share = stored(done.select(
        F.col("_id").alias("_i"), F.col("_source").alias("_s"), F.col("_key").alias("_k"),
        F.row_number().over(same.orderBy("_at")).alias("_copy"),
        F.count("*").over(same).alias("_copies"), "_size", "_taken").filter("_taken > 0"),
        "op9-shares")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("d"))
    d = F.col("d")
    rows = rows.withColumn("_k0", F.xxhash64(d[text_col]))
    on = (d[id_col].eqNullSafe(F.col("_i")) & d[source_col].eqNullSafe(F.col("_s"))
          & (F.col("_k0") == F.col("_k")))
    joined = rows.join(share.filter("_copies = 1"), on).select("d", "_size", "_taken")
    repeated = share.filter("_copies > 1")
    if not repeated.isEmpty():   # rows that repeat id, source and text: by number
        some = rows.join(repeated.select("_i", "_s", "_k").distinct(), on, "left_semi")
        number = F.row_number().over(Window.partitionBy(
            d[id_col], d[source_col], "_k0").orderBy("_k0"))
        joined = joined.unionByName(some.withColumn("_c", number).join(
            repeated, on & (F.col("_c") == F.col("_copy"))).select("d", "_size", "_taken"))
    words = F.split(F.regexp_replace(d[text_col], rf"^{WS}|{WS}$", ""), WS)
    each = F.expr("transform(sequence(0, cast((_taken - 1) div _size as int)), "
                  "e -> cast(least(_size, _taken - e * _size) as int))")
    out = joined.withColumn("_take", F.explode(each))
    text = F.when(F.col("_take") == F.col("_size"), d[text_col]).otherwise(
        F.array_join(F.slice(words, F.lit(1), F.col("_take")), " "))
    return out.select(*[(text if c == text_col else d[c]).alias(c) for c in docs.columns])


def run(spark, sf_dir) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source ASC NULLS LAST) AS no
      FROM d GROUP BY source),
w AS (SELECT *, (no - 1) % 3 + 1 AS w, sum(total) OVER ()::BIGINT AS everything FROM s),
l AS (SELECT *, (everything - coalesce(sum(3 * total) OVER (ORDER BY 3 * total / w, no
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER (ORDER BY 3 * total / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lev,
         row_number() OVER (ORDER BY 3 * total / w, no) AS k FROM w),
g AS (SELECT min_by(lev, k) AS lev FROM l WHERE lev <= 3 * total / w),
t AS (SELECT w.source, total, least((3 * total)::DOUBLE, g.lev * w) AS target FROM w, g),
p AS (SELECT d.*, total, target, floor(target + 0.5)::BIGINT AS goal,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, total AS source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE goal // total * size
            + greatest(0, least(size, goal % total - pos)) END::BIGINT AS taken
FROM p
"""
