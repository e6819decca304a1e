r"""Operator 13: shards of near equal bytes by a k-d tree over the metadata.

A document weighs its text's UTF-8 bytes (null: none) plus 16. The root holds all
documents and ``shards`` leaves to be; a node of k leaves is split at the weighted
quantile floor(k / 2) / k of its widest dimension, until a node is one leaf. With
``target_bytes`` the root gets as many leaves as bring each to about that size.
Law: ``bytes``. A cut goes between two documents, where the bytes on its left come
closest to their share, so a shard misses its part by about one document.

Dimensions are metadata columns (``dims``, those that are there) and the size. Text
counts as the number of its first six UTF-8 bytes, numbers, dates and flags as
numbers; each is scaled to 31 bits between the table's least and largest value, null
and non-finite values to 0. A dimension's width in a node is its largest less its
least value; of equal widths the first dimension is split. Documents of equal value
go by an md5 of id and text, so the tree depends on the rows alone, not on their
order or partitions, and a source with a third of all bytes is split like any other.
Equal texts have neither a shard of their own nor a common one: such a group may be
larger than a shard, and ``bytes`` comes first.

Medians are found without moving a row: a pass counts the bytes of ``BINS`` equal
intervals of every open node's keys, the interval in which the share is met is the
next pass's whole, until ``FINISH`` rows are left, which are sorted. What reaches the
driver is a row a node. Native functions only.

Slots number a shard's documents from 0 in md5 order. They are ranked in buckets of
an md5 prefix (longer the more rows there are, the order is the same); an md5 that
more than ``FINISH`` rows share is ranked in pieces by the rows' place in the input.

Defined cases: null texts weigh 16 bytes; null ids and empty texts are ordinary rows;
rows that repeat id and text are documents of their own and may part; fewer documents
than shards leave shards empty; an empty table gives an empty result; extra columns
are passed through by ``sharded_documents``, whatever their names, and otherwise not read.

Plan: texts are read once; rows of about 80 bytes are written, and each level adds a
join with a table of the level's splits, a row a node (Spark broadcasts it by its
size). Only the slots shuffle rows, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampType

from hirelake.llm.common import CRC_TABLE, crc_sql, read, stored

SHARDS = 40
DIMS = ("source", "lang")
OVERHEAD = 16             # bytes that a document weighs besides its text
BINS = 4096               # intervals of a node counted in one pass
FINISH = 4096             # rows of a node sorted at the end
STEPS = (1 << 31) - 1     # a coordinate's largest value
TIE = 1 << 32             # below a coordinate stand 32 bits of the md5
_NO_MOST = (1 << 63) - 1


def _number(column: Column, kind) -> Column:
    """A metadata value as a double, in the order of the values."""
    if isinstance(kind, BooleanType):
        return column.cast("int").cast("double")
    if isinstance(kind, NumericType):
        return column.cast("double")
    if isinstance(kind, (DateType, TimestampType)):
        return F.unix_seconds(column.cast("timestamp")).cast("double")
    head = F.hex(F.substring(F.encode(column.cast("string"), "UTF-8"), 1, 6))
    return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("long").cast("double")


def _points(docs: DataFrame, no: Column, id_col: str, text_col: str, dims) -> DataFrame:
    """``no, node, id, size, crc, md5, tie, k0, k1, ...`` of every document, written."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + F.lit(OVERHEAD)).cast("long")
    dims = [d for d in dims if d in docs.columns]
    values = [_number(docs[d], docs.schema[d].dataType) for d in dims] + [size.cast("double")]
    rows = docs.select(
        no.alias("no"), F.lit(0).cast("long").alias("node"), F.col(id_col).alias("id"),
        size.alias("size"), F.crc32(text).alias("crc"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                       text)).alias("md5"),
        *[v.alias(f"x{i}") for i, v in enumerate(values)])
    rows = rows.withColumn("tie", F.conv(F.substring("md5", 1, 8), 16, 10).cast("long"))
    for i in range(len(values)):
        x = F.col(f"x{i}")
        rows = rows.withColumn(f"x{i}", F.when(F.abs(x) < float("inf"), x))
    rows = stored(rows, "op13-points")
    ends = rows.agg(*[f(f"x{i}").alias(f"{f.__name__}{i}")
                      for i in range(len(values)) for f in (F.min, F.max)]).first()
    for i in range(len(values)):
        low, high = ends[f"min{i}"], ends[f"max{i}"]
        scaled = F.lit(0).cast("long")
        if low is not None and high > low:
            share = (F.col(f"x{i}") - F.lit(low)) / F.lit(high - low)
            scaled = F.coalesce(F.floor(share * F.lit(float(STEPS))).cast("long"), scaled)
        rows = rows.withColumn(f"k{i}", scaled).drop(f"x{i}")
    return rows


def _table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of whole numbers, a row a node."""
    values = ", ".join("(" + ", ".join(f"{v}L" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def _keyed(rows: DataFrame, n_dims: int) -> DataFrame:
    """``key``: the coordinate in the node's dimension, then 32 bits of the md5."""
    pick = F.coalesce(*[F.when(F.col("dim") == i, F.col(f"k{i}")) for i in range(n_dims)])
    return rows.withColumn("key", pick * F.lit(TIE) + F.col("tie"))


def _splits(placed: DataFrame, opened: dict[int, int], n_dims: int) -> list[tuple]:
    """``node, dim, key, no, right`` of every open node: rows up to (key, no) go left."""
    spark = placed.sparkSession
    stats = placed.groupBy("node").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"),
        *[f(f"k{i}").alias(f"{f.__name__}{i}") for i in range(n_dims) for f in (F.min, F.max)])
    state: dict[int, dict] = {}
    for r in stats.collect():
        k = opened.get(r["node"], 1)
        if k > 1:
            widths = [r[f"max{i}"] - r[f"min{i}"] for i in range(n_dims)]
            dim = widths.index(max(widths))
            state[r["node"]] = {
                "dim": dim, "lo": r[f"min{dim}"] * TIE, "hi": (r[f"max{dim}"] + 1) * TIE - 1,
                "no_lo": 0, "no_hi": _NO_MOST, "before": 0, "n": r["n"],
                "twice": 2 * r["bytes"] * (k // 2) // k}

    def inside(nodes: list[int]) -> DataFrame:
        names = ["dim", "lo", "hi", "no_lo", "no_hi", "before", "twice"]
        table = _table(spark, [(m, *(state[m][c] for c in names)) for m in nodes],
                       ["node", *names])
        return _keyed(placed.join(table, "node"), n_dims).filter(
            "key BETWEEN lo AND hi AND no BETWEEN no_lo AND no_hi")

    while wide := [m for m, s in state.items()
                   if s["n"] > FINISH and (s["lo"] < s["hi"] or s["no_lo"] < s["no_hi"])]:
        by_no = F.col("lo") == F.col("hi")
        place = F.when(by_no, F.expr(f"(no - no_lo) div ((no_hi - no_lo) div {BINS} + 1)")).otherwise(
            F.expr(f"(key - lo) div ((hi - lo) div {BINS} + 1)"))
        bins = inside(wide).groupBy("node", "before", "twice", place.alias("bin")).agg(
            F.sum("size").alias("s"), F.count("*").alias("n"), F.min("key").alias("lo"),
            F.max("key").alias("hi"), F.min("no").alias("no_lo"), F.max("no").alias("no_hi"))
        upto = Window.partitionBy("node").orderBy("bin").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        met = bins.withColumn("end", F.col("before") + F.sum("s").over(upto)).filter(
            "2 * end > twice").groupBy("node").agg(F.min(F.struct(
                "bin", (F.col("end") - F.col("s")).alias("before"), "n", "lo", "hi", "no_lo",
                "no_hi")).alias("b"))
        for r in met.collect():
            state[r["node"]] |= {c: v for c, v in r["b"].asDict().items() if c != "bin"}
    if not state:
        return []
    upto = Window.partitionBy("node").orderBy("key", "no").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    left = inside(list(state)).withColumn("end", F.col("before") + F.sum("size").over(upto)).filter(
        "2 * end - size <= twice").groupBy("node").agg(F.max(F.struct("key", "no")).alias("at"))
    cuts = {r["node"]: (r["at"]["key"], r["at"]["no"]) for r in left.collect()}
    return [(m, s["dim"], *cuts.get(m, (s["lo"], -1)), m + opened[m] // 2)
            for m, s in state.items()]


def _placed(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with their leaf: a node is named by its first shard."""
    spark = rows.sparkSession
    n_dims = sum(c[0] == "k" for c in rows.columns)
    placed, opened = rows, {0: shards}
    while any(k > 1 for k in opened.values()):
        cuts = _splits(placed, opened, n_dims)
        if cuts:
            table = _table(spark, cuts, ["node", "dim", "cut", "cut_no", "to"])
            goes = F.expr("key > cut OR (key = cut AND no > cut_no)")
            placed = _keyed(placed.join(table, "node", "left"), n_dims).withColumn(
                "node", F.when(goes, F.col("to")).otherwise(F.col("node"))).drop(
                "dim", "cut", "cut_no", "to", "key")
        opened = {first: n for m, k in opened.items()
                  for first, n in ((m, max(1, k // 2)), (m + k // 2, k - k // 2)) if n}
    return placed


def _slotted(placed: DataFrame, shards: int) -> DataFrame:
    """``placed`` with ``slot``, the rank in its shard by md5."""
    rows, digits = placed.count(), 0
    while rows > shards * FINISH * 16 ** digits // 2 and digits < 8:
        digits += 1
    often = stored(placed.groupBy("md5").count().filter(F.col("count") > FINISH).select(
        F.col("md5").alias("often")), "op13-often")
    piece = F.lit(0).cast("long")
    if not often.isEmpty():
        placed = placed.join(often, F.col("md5") == F.col("often"), "left")
        piece = F.when(F.col("often").isNotNull(), F.shiftright("no", 33) + 1).otherwise(piece)
    placed = placed.withColumn("bucket", F.substring("md5", 1, digits)).withColumn("piece", piece)
    group = ["node", "bucket", "piece"]
    before = Window.partitionBy("node").orderBy("bucket", "piece").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = placed.groupBy(*group).agg(F.count("*").alias("n")).select(
        *group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy(*group).orderBy("md5", "no")
    return placed.withColumn("rank", F.row_number().over(within)).join(bases, group).withColumn(
        "slot", (F.col("base") + F.col("rank") - 1).cast("long"))


def _sharded(points: DataFrame, shards: int | None, target_bytes: int | None) -> DataFrame:
    if target_bytes:
        total = points.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    placed = stored(_placed(points, shards or SHARDS).select("no", "id", "size", "crc", "md5", "node"),
                    "op13-placed")
    return _slotted(placed, shards or SHARDS)


def shard_rows(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
               id_col: str = "doc_id", text_col: str = "text", dims=DIMS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every document, no text."""
    points = _points(docs, F.monotonically_increasing_id(), id_col, text_col, dims)
    return _sharded(points, shards, target_bytes).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.col("node").cast("int").alias("shard"), "slot")


def sharded_documents(docs: DataFrame, shards: int | None = None,
                      target_bytes: int | None = None, id_col: str = "doc_id",
                      text_col: str = "text", dims=DIMS, shard_col: str = "shard",
                      slot_col: str = "slot") -> DataFrame:
    """``docs`` with its shard and slot (columns of these names are replaced).

    The documents are written once with a number of their own, by which they meet
    their shards, so repeated rows need no care.
    """
    kept = [c for c in docs.columns if c not in (shard_col, slot_col)]
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("no"),
                                  F.struct(*[docs[c] for c in kept]).alias("d")), "op13-documents")
    dims = [c for c in dims if c in kept]
    read_ = [F.col("d")[c].alias(f"d_{i}") for i, c in enumerate([id_col, text_col, *dims])]
    points = _points(numbered.select("no", *read_), F.col("no"), "d_0", "d_1",
                     [f"d_{i + 2}" for i in range(len(dims))])
    homes = _sharded(points, shards, target_bytes).select("no", "node", "slot")
    return numbered.join(homes, "no").select(
        *[F.col("d")[c].alias(c) for c in kept], F.col("node").cast("int").alias(shard_col),
        F.col("slot").alias(slot_col))


def write_shards(docs: DataFrame, path: str, rows_a_file: int = 1_000_000, **options) -> None:
    """Write ``sharded_documents`` as Parquet, a folder a shard, files in slot order."""
    rows = sharded_documents(docs, **options)
    shard, slot = options.get("shard_col", "shard"), options.get("slot_col", "slot")
    rows.withColumn("__file", F.floor(F.col(slot) / rows_a_file)).repartition(
        shard, "__file").sortWithinPartitions(shard, slot).drop("__file").write.partitionBy(
        shard).parquet(path)


def run(spark, sf_dir) -> DataFrame:
    rows = shard_rows(read(spark, sf_dir, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def _sql(shards: int = SHARDS, dims=DIMS) -> str:
    """The same tree with sorted windows, a level a step."""
    n = len(dims) + 1
    number = [f"('0x' || rpad(left(hex(encode({d})), 12), 12, '0'))::BIGINT::DOUBLE" for d in dims]
    scaled = [f"coalesce(CASE WHEN max(x{i}) OVER () > min(x{i}) OVER () THEN floor((x{i} - min(x{i}) "
              f"OVER ()) / (max(x{i}) OVER () - min(x{i}) OVER ()) * {float(STEPS)})::BIGINT END, 0) AS k{i}"
              for i in range(n)]
    steps = [f"""p AS (SELECT doc_id, lang, source, octet_length(encode(coalesce(text, '')))::BIGINT + {OVERHEAD} AS size,
       md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h, coalesce(text, '') AS t FROM documents),
x AS (SELECT *, {', '.join(f'{e} AS x{i}' for i, e in enumerate([*number, 'size::DOUBLE']))} FROM p),
l0 AS (SELECT doc_id, size, h, t, {', '.join(scaled)}, 0::BIGINT AS node, {shards}::BIGINT AS k FROM x)"""]
    level, k = 0, shards
    while k > 1:
        widths = [f"max(k{i}) OVER w - min(k{i}) OVER w" for i in range(n)]
        best = "greatest(" + ", ".join(f"w{i}" for i in range(n)) + ")"
        dim = "CASE " + " ".join(f"WHEN w{i} = {best} THEN k{i}" for i in range(n)) + " END"
        steps.append(f"""a{level} AS (SELECT *, sum(size) OVER w AS total, {', '.join(f'{e} AS w{i}' for i, e in enumerate(widths))}
       FROM l{level} WINDOW w AS (PARTITION BY node)),
b{level} AS (SELECT *, 2 * sum(size) OVER (PARTITION BY node ORDER BY {dim}, h
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size <= 2 * total * (k // 2) // k AS goes_left FROM a{level}),
l{level + 1} AS (SELECT doc_id, size, h, t, {', '.join(f'k{i}' for i in range(n))},
       CASE WHEN k = 1 OR goes_left THEN node ELSE node + k // 2 END AS node,
       CASE WHEN k = 1 THEN 1 WHEN goes_left THEN k // 2 ELSE k - k // 2 END AS k FROM b{level})""")
        level, k = level + 1, k - k // 2
    return "WITH " + CRC_TABLE + ",\n".join(steps) + f"""
SELECT doc_id, size, {crc_sql('t')} AS text_crc32, 'bytes' AS law, node::INTEGER AS shard,
       row_number() OVER (PARTITION BY node ORDER BY h) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM l{level}, crc"""


SQL = _sql()
