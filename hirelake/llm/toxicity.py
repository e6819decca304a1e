"""Operator 10: toxicity by a linear classifier over character n-grams whose
features are scaled by naive Bayes log-count ratios.

``fit`` learns from labelled documents, ``score`` gives every document its
probability, ``drop_toxic`` keeps the rows below a threshold. Features are the
distinct character 4- and 5-grams of the lower-cased whole text, hashed to
``BUCKETS`` buckets. Bucket j has the value r_j = log of the ratio between its
smoothed document frequencies under label 1 and label 0 where it is present; a
logistic regression on the ``FEATURES`` buckets with the largest chi-square
weighs them.

The fit uses a bounded sample: at most ``SAMPLE`` labelled documents of each
label, those with the smallest id hash, so the same tables give the same model;
the intercept is then set back to the share of label 1 among all labelled rows.
Everything else covers all rows: every document is scored on its whole text.

Defined cases: null and empty texts have no feature and get the intercept's
score. Rows of ``labels`` with a null id, or a label other than 0 and 1, teach
nothing; a document labelled both ways counts as 1. A null id is held out. With
labels of one kind or none, the score is the smoothed share of label 1. Repeated
rows get equal scores and teach once. Extra columns are ignored by ``score`` and
passed through by ``drop_toxic``; an empty table gives an empty result.

Plan: the sample's ids (at most 2 * ``SAMPLE``) are broadcast to one scan of the
texts; n-gram counts are added up per task before they are shuffled by bucket;
the driver sees at most ``BUCKETS`` sums and the sample's selected features.
Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import mix, read, small_batches, stored, tidy

GRAMS = (4, 5)
BUCKETS = 1 << 18
FEATURES = 4096
SAMPLE = 6000             # labelled documents of each label, at most
MIN_DOCS = 5              # documents of the sample that must hold a bucket
RIDGE = 0.02
STEPS = 300


class Model(NamedTuple):
    features: np.ndarray  # buckets, ascending
    weights: np.ndarray   # their weights, scaled by the log-count ratios
    bias: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def _grams(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's n-grams, ascending."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"),
                           dtype=np.uint32).astype(np.uint64)
    found = []
    for n in GRAMS:
        if len(points) < n:
            continue
        code = np.full(len(points) - n + 1, n, dtype=np.uint64)
        for k in range(n):   # a code point has 21 bits; five do not fit, so fold
            code = code * np.uint64(0x100000001B3) + points[k:len(points) - n + 1 + k]
        found.append((mix(code) & np.uint64(BUCKETS - 1)).astype(np.int32))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            sums[label, _grams(text.as_py())] += 1
    seen = np.flatnonzero(sums.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(sums[0, seen]), pa.array(sums[1, seen])],
        names=["bucket", "n0", "n1"])


def _selected(features: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.flatnonzero(np.isin(features, _grams(t.as_py()), assume_unique=True))
                    for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.array([r.tolist() for r in rows], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "held"])
    return run


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, toxic`` of the labelled documents that teach."""
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rank = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("toxic = 0").orderBy(*rank).limit(sample).unionByName(
        known.filter("toxic = 1").orderBy(*rank).limit(sample))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # 2 * sample rows of two numbers at most
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    small_batches(docs.sparkSession)
    rows = stored(training_sample(docs, labels, sample, id_col, text_col), "op10-sample")
    sizes = dict(rows.groupBy("toxic").count().collect())
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    base = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy(
        "toxic").count().collect()
    base = {r[0]: r[1] for r in base}
    prior = np.log((base.get(1, 0) + 1) / (base.get(0, 0) + 2))
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), float(prior))
    if not n0 or not n1:
        return nothing
    sums = rows.mapInArrow(tidy(_count), "bucket long, n0 long, n1 long").groupBy("bucket").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).filter(
        F.col("n0") + F.col("n1") >= MIN_DOCS).orderBy("bucket").toArrow()
    bucket, c0, c1 = (sums.column(i).to_numpy().astype(float) for i in range(3))
    if not len(bucket):
        return nothing
    both = c0 + c1
    gap = c1 * n0 - c0 * n1
    chi = gap * gap * (n0 + n1) / (both * (n0 + n1 - both + 1e-9) * n0 * n1)
    best = np.sort(np.argsort(-chi, kind="stable")[:FEATURES])
    features = bucket[best].astype(np.int64)
    ratio = np.log((c1[best] + 1) / (n1 + 2)) - np.log((c0[best] + 1) / (n0 + 2))
    held = rows.mapInArrow(tidy(_selected(features)), "doc_id long, toxic int, held array<int>") \
        .orderBy("doc_id").toArrow()
    lists = held.column("held").combine_chunks()
    weights, bias = _logistic(lists.offsets.to_numpy(), lists.values.to_numpy(),
                              held.column("toxic").to_numpy().astype(float), ratio)
    return Model(features, weights * ratio, float(bias - np.log(n1 / n0) + prior))


def _logistic(offsets, index, y, ratio) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps."""
    row = np.repeat(np.arange(len(y)), np.diff(offsets))
    value = ratio[index]
    w, b = np.zeros(len(ratio)), 0.0
    v, vb, w0, b0 = w.copy(), b, w, b
    # step from a bound on the curvature: a quarter of the mean squared row norm's peak
    norm = np.bincount(row, value * value, minlength=len(y)) + 1
    step = 4.0 / (np.percentile(norm, 99) + RIDGE)
    for t in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * v[index], minlength=len(y)) + vb,
                                     -40, 40)))
        err = (p - y) / len(y)
        w = v - step * (np.bincount(index, err[row] * value, minlength=len(ratio)) + RIDGE * v / 10)
        b = vb - step * err.sum()
        pace = (t - 1) / (t + 2)
        v, vb = w + pace * (w - w0), b + pace * (b - b0)
        w0, b0 = w, b
    return w, b


def _probabilities(model: Model, texts) -> np.ndarray:
    table = np.zeros(BUCKETS)
    table[model.features] = model.weights
    z = np.array([table[_grams(t.as_py())].sum() for t in texts]) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _probabilities(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                 pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5,
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = _probabilities(model, batch.column(place)) < threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(tidy(run), docs.schema)


def run(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))


SQL = None
