"""Operator 10's fit and scores, and the digests of operator 6's query, against plain Python."""

import hashlib
import math
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import brute
from hirelake.llm import pieces, toxicity

ALL = (1 << 64) - 1


def _bucket(gram):
    """One n-gram's bucket, a character at a time."""
    code = len(gram)
    for c in gram:
        code = (code * 0x100000001B3 + ord(c)) & ALL
    code ^= code >> 30
    code = code * 0xBF58476D1CE4E5B9 & ALL
    code ^= code >> 27
    code = code * 0x94D049BB133111EB & ALL
    return (code ^ code >> 31) % toxicity.BUCKETS


def _features(text):
    text = (text or "").lower()
    return {_bucket(text[i:i + n]) for n in (4, 5) for i in range(len(text) - n + 1)}


def _id_hash(i):
    h = xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)
    return h - (1 << 64) if h >> 63 else h


def _teaches(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 != 0


def _fit(docs, labels, sample):
    """Weights by bucket and the bias, with dense matrices."""
    known = {}
    for i, t in labels:
        if _teaches(i) and t in (0, 1):
            known[i] = max(t, known.get(i, 0))
    share = Counter(t for i, t in labels if _teaches(i) and t in (0, 1))
    prior = math.log((share[1] + 1) / (share[0] + 2))
    chosen = {}
    for t in (0, 1):
        chosen |= dict.fromkeys(sorted((i for i in known if known[i] == t),
                                       key=lambda i: (_id_hash(i), i))[:sample], t)
    texts = {}
    for i, text in docs:
        if i in chosen:
            texts[i] = min(text or "", texts.get(i, text or ""))
    ids = sorted(texts)
    y = np.array([chosen[i] for i in ids], dtype=float)
    held = [_features(texts[i]) for i in ids]
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    c0, c1 = Counter(), Counter()
    for t, found in zip(y, held):
        (c1 if t else c0).update(found)
    chi = {}
    for b in sorted(set(c0) | set(c1)):
        both = c0[b] + c1[b]
        if both >= toxicity.MIN_DOCS:
            gap = float(c1[b]) * n0 - float(c0[b]) * n1
            chi[b] = gap * gap * (n0 + n1) / (both * (n0 + n1 - both + 1e-9) * n0 * n1)
    best = sorted(sorted(chi, key=lambda b: (-chi[b], b))[:toxicity.FEATURES])
    ratio = np.array([math.log((c1[b] + 1) / (n1 + 2)) - math.log((c0[b] + 1) / (n0 + 2))
                      for b in best])
    x = np.array([[b in found for b in best] for found in held]) * ratio
    step = 4.0 / (np.percentile((x * x).sum(axis=1) + 1, 99) + toxicity.RIDGE)
    at, ahead = np.zeros(len(best) + 1), np.zeros(len(best) + 1)
    for t in range(1, toxicity.STEPS + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ ahead[:-1] + ahead[-1], -40, 40))) - y) / len(y)
        slope = np.append(x.T @ error + toxicity.RIDGE * ahead[:-1] / 10, error.sum())
        new = ahead - step * slope
        at, ahead = new, new + (t - 1) / (t + 2) * (new - at)
    bias = at[-1] - math.log(n1 / n0) + prior
    return dict(zip(best, at[:-1] * ratio)), bias


@pytest.mark.parametrize("sample", [toxicity.SAMPLE, 30])
def test_toxicity_fit_and_scores_by_hand(spark, sample):
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{brute.SMALL}/labels.parquet").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    # an id of two texts, an id labelled both ways, a null id, a label that is none
    some = [r[0] for r in labels.collect() if _teaches(r[0])][:3]
    docs = docs.unionByName(spark.createDataFrame(
        [(some[0], "a second text of the same id"), (None, "without an id"), (some[1], None)],
        docs.schema))
    labels = labels.unionByName(spark.createDataFrame(
        [(some[2], 0), (some[2], 1), (None, 1), (some[0], 7)], labels.schema))
    model = toxicity.fit(docs, labels, sample)
    weights, bias = _fit([tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()],
                         sample)
    assert model.features.tolist() == sorted(weights)
    assert np.allclose(model.weights, [weights[b] for b in sorted(weights)], atol=1e-9)
    assert abs(model.bias - bias) < 1e-9
    got = toxicity.score(docs, model).collect()
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert len(got) == sum(texts.values())
    want = sorted((1 / (1 + math.exp(-(sum(weights.get(b, 0.0) for b in sorted(_features(t))) + bias))),
                   not _teaches(i)) for i, t in texts.elements())
    assert np.allclose(sorted(r.score for r in got), [w for w, _ in want], atol=1e-9)
    assert sum(r.held_out for r in got) == sum(out for _, out in want)


def test_sentencepiece_digests_are_those_of_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for r in spark.read.parquet(f"{brute.SMALL}/documents.parquet").collect():
        ids = model.encode(r.text or "")
        back = model.decode(ids)
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(back.encode()).hexdigest(), back == (r.text or ""))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.round_trip)
           for r in pieces.run(spark, brute.SMALL).collect()}
    assert got == want
