r"""Operator 8: long repeated word sequences, by a compacted de Bruijn graph.

Words are ``[^\x20\x09-\x0D]+``, unchanged. A window is ``window`` (35) consecutive
words of one document; each word covered by a window whose word sequence also
starts anywhere else, in the same document too, is removed. Windows are judged
on the input.

Graph. k-mers of ``K`` words are the edges. Of each window only the edge with the
smallest hash is kept (leftmost if equal): the same words keep the same edge, so
windows that repeat do so on a shared edge. The windows in a row that keep one
edge are a path without a branch; its words, all windows' together, are one hash.

1. Edges that occur once carry no repeat. The others are set in a bitmap.
2. Paths on such edges, with their source coordinates (document, first window),
   compact to one row per edge and hash, with their number. A path that occurs
   more than once repeats with all its windows, however many copies there are.
3. An edge with several different paths branches: there, one occurrence of each
   path gives its windows' hashes, and a window of a single path repeats if
   another path of the same edge holds it.
4. The verdicts go back to all occurrences by a join on edge and hash, and by the
   source coordinates to the texts.

Hashes of an edge and of a path or window have 64 bits each and are always
compared together, 128 bits.

Defined cases: null, empty and shorter texts have no window and keep their words;
rows that repeat are documents like others, so their windows repeat; a null id is
a document too (documents are told apart by a 128-bit hash of id and text); an empty table
gives an empty result; extra columns pass through ``substring_dedup``.

Plan: three scans of the texts make rows of hashes; texts are shuffled once, at
the end. Counts are pre-aggregated before each shuffle, and a path that a third
of the corpus holds is one row on the right of a join that AQE can split.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import (Bits, Words, mix, numbered, read, small_batches, stored,
                                 window_hash, window_minimum)

WINDOW = 35
K = 16                    # words of an edge: enough that chance repeats are rare
MOST = 62                 # windows on one edge: their verdicts are bits of a long


def _edge_words(window: int) -> int:
    return max(min(K, (window + 1) // 2), window - MOST + 1)


def _paths(column, window: int):
    """Paths of a batch: words, document, first window, windows, edge, hash."""
    words = Words(column)
    k, n = _edge_words(window), len(words.hash)
    if n < window:
        none = np.zeros(0, dtype=np.int64)
        return words, none, none, none, none.view(np.uint64), none.view(np.uint64)
    heads = np.arange(n - k + 1)
    edges = window_hash(words.hash, heads, heads + k)
    first = np.arange(n - window + 1)
    kept = window_minimum(edges, window - k + 1)
    whole = words.doc[first] == words.doc[first + window - 1]
    first, kept = first[whole], kept[whole]
    if not len(first):
        return _paths(column.slice(0, 0), window)
    new = np.ones(len(first), dtype=bool)
    new[1:] = (kept[1:] != kept[:-1]) | (first[1:] != first[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(first)))
    start, edge = first[at], kept[at]
    path = window_hash(words.hash, start, start + count + window - 1) ^ mix(
        (edge - start + 1).astype(np.uint64))
    return words, words.doc[start], start, count, edges[edge], path


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _place(key: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash of a source coordinate."""
    return mix(key[doc].view(np.uint64) ^ mix(first.astype(np.uint64) + np.uint64(1)))


def _edge_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *_, edge, _ = _paths(batch.column(1), window)
            yield pa.RecordBatch.from_arrays([_signed(edge)], names=["edge"])
    return run


def _path_rows(window: int, repeated: Bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, doc, start, count, edge, path = _paths(batch.column(1), window)
            on = repeated.has(edge)
            doc, start, count = doc[on], start[on], count[on]
            first = start - words.bounds[doc]
            key, key2 = batch.column(0).to_numpy(), batch.column("key2").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [_signed(edge[on]), _signed(path[on]), pa.array(key[doc]), pa.array(key2[doc]),
                 pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)),
                 _signed(_place(key, doc, first))],
                names=["edge", "path", "key", "key2", "first", "n", "place"])
    return run


def _window_rows(window: int, chosen: Bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, doc, start, count, edge, path = _paths(batch.column(1), window)
            key = batch.column(0).to_numpy()
            on = chosen.has(_place(key, doc, start - words.bounds[doc]))
            start, count = start[on], count[on]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(start, count) + step
            yield pa.RecordBatch.from_arrays(
                [_signed(np.repeat(edge[on], count)), _signed(np.repeat(path[on], count)),
                 pa.array(step.astype(np.int32)),
                 _signed(window_hash(words.hash, at, at + window))],
                names=["edge", "path", "step", "window"])
    return run


def _verdicts(paths: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``edge, path, mask``: bit i tells that the path's window i repeats."""
    distinct = stored(paths.groupBy("edge", "path").agg(
        F.count("*").alias("times"), F.first("n").alias("n"), F.min("place").alias("place")),
        "op8-distinct")
    repeated = distinct.filter("times > 1").select(
        "edge", "path", F.expr("shiftleft(1L, n) - 1").alias("mask"))
    ways = stored(distinct.groupBy("edge").count().filter("count > 1").select("edge"), "op8-ways")
    branching = distinct.join(ways, "edge", "left_semi")
    chosen = Bits(branching, "place", size=26)
    windows = texts.mapInArrow(_window_rows(window, chosen),
                               "edge long, path long, step int, window long")
    # a place may share its bit with others: count each path's window once
    shared = stored(windows.groupBy("edge", "window").agg(
        F.min("path").alias("low"), F.max("path").alias("high")).filter("low <> high").select(
        "edge", "window"), "op8-shared")
    single = windows.join(shared, ["edge", "window"]).groupBy(
        "edge", "path").agg(F.expr("bit_or(shiftleft(1L, step))").alias("mask"))
    return repeated.unionByName(single.join(
        distinct.filter("times = 1").select("edge", "path"), ["edge", "path"], "left_semi"))


def _covered(spans, n: int, window: int) -> np.ndarray:
    """Which of a document's ``n`` words a repeated window covers."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for s in spans:
        steps = np.array([i for i in range(MOST + 1) if s["mask"] >> i & 1]) + s["first"]
        np.add.at(edges, steps, 1)
        np.add.at(edges, steps + window, -1)
    return np.cumsum(edges[:-1]) > 0


def _cut(text_at: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, gone = [], [], []
            for text, spans in zip(batch.column(text_at), batch.column("_spans")):
                words = (text.as_py() or "").encode().split()
                total.append(len(words))
                gone.append(0)
                if spans.is_valid:
                    cover = _covered(spans.as_py(), len(words), window)
                    words = list(compress(words, (~cover).tolist()))
                    gone[-1] = int(cover.sum())
                kept.append(b" ".join(words).decode())
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != "_spans"]
            columns += [pa.array(kept, pa.string()), pa.array(total, pa.int64()),
                        pa.array(gone, pa.int64())]
            names = [n for n in batch.schema.names if n != "_spans"]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_kept", "_words", "_gone"])
    return run


def _keys(id_col: str, text_col: str, name: str):
    """128 bits that stand for a document, so that equal ids or null ones do not mix."""
    return (F.xxhash64(F.col(id_col), F.col(text_col)).alias(name),
            F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col)).alias(f"{name}2"))


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``docs``, columns numbered, with ``_kept`` text, ``_words`` and ``_gone`` counts."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(*_keys(id_col, text_col, "key"), F.col(text_col).alias("text"))
    texts = texts.select("key", "text", "key2")
    edges = texts.mapInArrow(_edge_rows(window), "edge long")
    repeated = Bits(edges.groupBy("edge").count().filter("count > 1"), "edge", size=25)
    paths = stored(texts.mapInArrow(
        _path_rows(window, repeated),
        "edge long, path long, key long, key2 long, first int, n int, place long"), "op8-paths")
    verdicts = stored(_verdicts(paths, texts, window), "op8-verdicts")
    spans = paths.join(verdicts, ["edge", "path"]).groupBy(
        F.col("key").alias("_key"), F.col("key2").alias("_key2")).agg(
        F.collect_list(F.struct("first", "mask")).alias("_spans"))
    rows = numbered(docs)
    at = docs.columns.index(text_col)
    keys = _keys(f"c{docs.columns.index(id_col)}", f"c{at}", "_key")
    joined = rows.select(*rows.columns, *keys).join(spans, ["_key", "_key2"], "left").drop(
        "_key", "_key2")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered(docs).schema)
    return joined.mapInArrow(_cut(at, window),
                             schema + ", _kept string, _words long, _gone long")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW) -> DataFrame:
    """``docs``, its text cut to the words that stay, joined by one space."""
    rows = _deduplicated(docs, id_col, text_col, window)
    at = docs.columns.index(text_col)
    return rows.select(*[F.col("_kept" if i == at else f"c{i}").alias(c)
                         for i, c in enumerate(docs.columns)])


def run(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return _deduplicated(docs, "doc_id", "text", WINDOW).select(
        F.col("c0").alias("doc_id"), F.col("_words").alias("n_words"),
        F.col("_gone").alias("n_removed"), F.sha2("_kept", 256).alias("kept_sha256"))


SQL = None
