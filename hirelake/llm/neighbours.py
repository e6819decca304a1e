"""Operator 3: approximate nearest neighbours in a hash-prefix forest.

Queries are the vectors whose id is divisible by ``QUERY_EVERY`` (20), candidates
are all others; nearness is the inner product in double precision on the
original vectors. Each vector has in each tree a long hash string: 64 signs of
projections on random directions. A tree is the sorted array of these strings.
A query descends in every tree to its longest-prefix match; then all trees
ascend together, one prefix length for all, until the ranges that share a prefix
of that length with the query hold ``SHARE * n + TREES * (k + 1)`` vectors between
them, for n in the block. All vectors in these ranges are scored exactly. The rows of a table are
dealt by a hash of their id to blocks of about ``BLOCK`` vectors; every query visits
every block. Strings hash directions, and nearness is an inner product: a block has a
forest for each band of norms (a factor of ``sqrt(2)``, ``BANDS`` at most, the shortest
vectors together), so that in a forest the two agree, n being its vectors; the few
longest vectors, which are near to most queries, are nearly all scored.

``SHARE`` is chosen for the worst case, vectors spread evenly over the sphere in
64 dimensions, where near neighbours hardly stand out and recall 0.9 needs about
two thirds of a block scored; embeddings with structure need far less. The second
term is room for all neighbours in all trees: the fewer the vectors, the farther the
k-th lies, and of k vectors all are scored.

Defined cases: vectors that are null, zero, or hold null or non-finite parts, and
rows with a null id, take no part; rows equal in id and vector are one; different
vectors of one id are rows of their own, each a candidate (for the id's other
vectors too) and, if the id asks, each a query with ranks of its own; vectors of different length are never compared; equal vectors are one
class, hashed and scored once, so any number of copies is exact (a class names
its k + 1 smallest ids, more cannot be among k). Ties go to the smaller id. An
empty table gives an empty result; extra columns are ignored. No cap: ranges are
taken whole.

Plan: a cell is one block of vectors and one chunk of ``CHUNK`` queries; both sides
are dealt to cells by a shuffle and searched in numpy, bounded by the two sizes.
A cell returns k + 1 classes a query; ranks are limited map-side before the
shuffles that merge blocks.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import read, small_batches, stored

QUERY_EVERY = 20
NEAREST = 20
TREES = 32
BITS = 64
SHARE = 0.65              # of a block's vectors, summed over the trees' ranges
BANDS = 12                # forests of a block, by norms
BLOCK = 8192
CHUNK = 32768
SEED = 20


def _codes(vectors: np.ndarray, tree: int) -> np.ndarray:
    """The hash string of each vector in one tree, first sign highest."""
    directions = np.random.default_rng((SEED, tree)).standard_normal((vectors.shape[1], BITS))
    bits = np.packbits(vectors @ directions > 0, axis=1)
    return bits.view(">u8").ravel().astype(np.uint64)


def _ranges(array: np.ndarray, codes: np.ndarray, length: np.ndarray):
    """Where ``array`` shares the first ``length`` bits with each code."""
    free = np.uint64(BITS) - length.astype(np.uint64)
    low = np.where(free >= BITS, ~np.uint64(0), (np.uint64(1) << (free % np.uint64(BITS)))
                   - np.uint64(1))
    return (np.searchsorted(array, codes & ~low, side="left"),
            np.searchsorted(array, codes | low, side="right"))


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int = TREES):
        self.vectors = vectors
        codes = [_codes(vectors, t) for t in range(trees)]
        self.order = [np.argsort(c, kind="stable") for c in codes]
        self.sorted = [c[o] for c, o in zip(codes, self.order)]

    def candidates(self, queries: np.ndarray, wanted: int):
        """For each query the positions that the ascent has gathered."""
        codes = [_codes(queries, t) for t in range(len(self.sorted))]
        # the longest common prefix length at which the ranges hold enough
        low = np.zeros(len(queries), dtype=np.int64)
        high = np.full(len(queries), BITS, dtype=np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            held = np.zeros(len(queries), dtype=np.int64)
            for array, code in zip(self.sorted, codes):
                a, b = _ranges(array, code, middle)
                held += b - a
            enough = held >= wanted
            low, high = np.where(enough, middle, low), np.where(enough, high, middle - 1)
        spans = [_ranges(array, code, low) for array, code in zip(self.sorted, codes)]
        for i in range(len(queries)):
            seen = np.zeros(len(self.vectors), dtype=bool)
            for order, (a, b) in zip(self.order, spans):
                seen[order[a[i]:b[i]]] = True
            yield np.flatnonzero(seen)


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _wanted(k: int, trees: int, share: float, n: int) -> int:
    return ceil(share * n) + trees * (k + 1)


def _bands(vectors: np.ndarray) -> list[np.ndarray]:
    """Positions of the vectors of each band of norms."""
    scaled = vectors / np.abs(vectors).max()             # no square overflows
    with np.errstate(divide="ignore"):
        logs = np.log2(np.linalg.norm(scaled, axis=1))
    band = np.minimum(np.floor(2 * (logs.max() - logs)), BANDS - 1)
    return [np.flatnonzero(band == b) for b in np.unique(band)]


def _gathered(vectors: np.ndarray, k: int, trees: int, share: float):
    """A function of queries that gives each one's candidates, ascending."""
    forests = [(at, Forest(vectors[at], trees), _wanted(k, trees, share, len(at)))
               for at in _bands(vectors)]

    def of(queries: np.ndarray):
        parts = [forest.candidates(queries, wanted) for _, forest, wanted in forests]
        for near in zip(*parts):
            yield np.sort(np.concatenate([at[n] for (at, _, _), n in zip(forests, near)]))
    return of


def _search(k: int, trees: int, share: float):
    schema = pa.schema([("q", pa.int64()), ("qh", pa.int64()), ("cid", pa.int64()),
                        ("h", pa.int64()), ("score", pa.float64())])

    def cell(items: pa.Table, queries: pa.Table) -> pa.Table:
        if not items.num_rows or not queries.num_rows:
            return schema.empty_table()
        ids, hashes = items.column("cid").to_numpy(), items.column("h").to_numpy()
        by_id = np.lexsort((hashes, ids))     # ties then go to the smaller id
        ids, hashes = ids[by_id], hashes[by_id]
        items = _matrix(items.column("v"))[by_id]
        candidates = _gathered(items, k, trees, share)
        asked, vectors = queries.column("cid").to_numpy(), _matrix(queries.column("v"))
        asked_hash = queries.column("h").to_numpy()
        out = []
        for i in range(0, len(asked), 2048):
            part = vectors[i:i + 2048]
            for q, qh, v, near in zip(asked[i:i + 2048], asked_hash[i:i + 2048], part,
                                      candidates(part)):
                scores = items[near] @ v
                if len(near) > k + 1:         # keep ties of the last score
                    last = np.partition(scores, -k - 1)[-k - 1]
                    near, scores = near[scores >= last], scores[scores >= last]
                best = np.argsort(-scores, kind="stable")[:k + 1]
                out.append((np.full(len(best), q), np.full(len(best), qh), ids[near[best]],
                            hashes[near[best]], scores[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                    schema=schema)
    return cell


def nearest(vectors: DataFrame, k: int = NEAREST, every: int = QUERY_EVERY,
            trees: int = TREES, share: float = SHARE, block: int = BLOCK,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest found.

    A class of equal vectors is named by its smallest id and its hash, ``cid, h``.
    """
    small_batches(vectors.sparkSession)
    v = F.col("v")
    sound = v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    rows = stored(rows.filter(sound & F.col("vec_id").isNotNull()).distinct(), "op3-vectors")
    asks = F.col("vec_id") % every == 0
    classes = stored(rows.groupBy("v").agg(F.min("vec_id").alias("cid"),
                                           F.max(asks).alias("asks")).withColumn(
        "h", F.xxhash64("v")), "op3-classes")
    members = stored(rows.join(classes, "v").select("cid", "h", "vec_id"), "op3-members")
    n, n_asked = classes.agg(F.count("*"), F.count_if("asks")).first()
    blocks, chunks = max(1, ceil(n / block)), max(1, ceil(n_asked / CHUNK))
    dim = F.size("v").alias("dim")
    items = classes.select(dim, F.pmod(F.xxhash64("cid", "h"), F.lit(blocks)).alias("block"), F.explode(
        F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "cid", "h", "v")
    asked = classes.filter("asks").select(dim, F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("cid", "h", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk"),
        "cid", "h", "v")
    cell = ["dim", "block", "chunk"]
    found = items.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(
        _search(k, trees, share), "q long, qh long, cid long, h long, score double")

    def first(df, by, order, most):
        return df.withColumn("_r", F.row_number().over(
            Window.partitionBy(*by).orderBy(*order))).filter(F.col("_r") <= most)

    asker, kind = ["q", "qh"], ["cid", "h"]
    top = first(found, asker, [F.desc("score"), *kind], k + 1).select(*asker, *kind, "score")
    named = first(members, kind, ["vec_id"], k + 1).select(*kind, "vec_id")
    near = stored(first(top.join(named, kind), asker, [F.desc("score"), "vec_id", "h"], k + 1)
                  .select(*asker, "h", "vec_id", "score", F.expr("cid = q AND h = qh").alias("own")),
                  "op3-near")
    queries = members.filter(asks).select(F.col("cid").alias("q"), F.col("h").alias("qh"),
                                          F.col("vec_id").alias("query_id"))
    pairs = near.join(queries, asker).filter("NOT (own AND vec_id = query_id)")
    return first(pairs, ["query_id", *asker], [F.desc("score"), "vec_id", "h"], k).select(
        "query_id", F.col("_r").alias("rank"), "vec_id", "score")


def run(spark, sf_dir) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


SQL = None
