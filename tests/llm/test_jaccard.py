"""Operator 7 and its components against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from hirelake.llm import jaccard
from hirelake.llm.common import Bits
from hirelake.llm.components import components


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("name", ["odd", "small", "empty"])
def test_near_duplicates(spark, name, k, percent):
    docs = (brute.odd_documents(spark) if name == "odd"
            else spark.read.parquet(f"{brute.SMALL}/documents.parquet"))
    docs = docs.limit(0) if name == "empty" else docs
    rows = _pairs(docs)
    got = jaccard.near_duplicates(docs, k, percent).collect()
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted([tuple(r) for r in got], key=order) == sorted(
        [(i, n, c) for (i, _), (n, c) in zip(rows, brute.near(rows, k, percent))], key=order)


def test_long_lists_of_near_copies(spark, monkeypatch):
    """Long lists go through cells, in several blocks, and lose no link."""
    monkeypatch.setattr(jaccard, "CELL", 16)
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(40)}"
        rows.append((1000 - i, " ".join(w[:rnd.choice([120, 120, 100, 90])])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard.near_duplicates(docs, 3, 90).collect()}
    assert got == {i: x for (i, _), x in zip(rows, brute.near(rows, 3, 90))}
    assert len({c for _, c in got.values()}) > 1


def _link_counts(rows, k, percent):
    """{(doc_id, text): number of other documents linked}"""
    sets = {r: brute.shingles(r[1], k) for r in set(rows)}
    return {r: sum(1 for other, t in sets.items() if other != r and s and t
                   and 100 * len(s & t) >= percent * len(s | t)) for r, s in sets.items()}


@pytest.mark.parametrize("name,cell,short", [
    ("odd", 1024, 8), ("near", 4, 8), ("near", 16, 2), ("near", 16, 100), ("small", 1024, 8),
    ("full", 16, 8)])
def test_every_link_is_counted_once(spark, monkeypatch, name, cell, short):
    """Circles too; sets that meet in cells of several leaders, or on short lists too."""
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "SHORT", short)
    if name == "full":                # bitmaps that let all rows through
        monkeypatch.setattr(jaccard, "Bits", lambda df, column, size=6: Bits(df, column, 6))
    rnd = random.Random(5)
    near = []
    for i in range(60):
        w = [f"b{i}" for i in range(90)]
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(30)}"
        near.append((i // 2, " ".join(w[:rnd.choice([90, 90, 84, 78])])))
    docs = {"odd": lambda: brute.odd_documents(spark),
            "near": lambda: spark.createDataFrame(near + near[:5], "doc_id long, text string"),
            "full": lambda: spark.createDataFrame(near + [(i + 100, t) for i, t in near],
                                                  "doc_id long, text string"),
            "small": lambda: spark.read.parquet(f"{brute.SMALL}/documents.parquet")}[name]()
    rows = _pairs(docs)
    want = _link_counts(rows, 3, 90)
    got = [(r.doc_id, r.n_links) for r in jaccard.near_duplicates(docs, counted=True).collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=order) == sorted([(r[0], want[r]) for r in rows], key=order)
    assert sum(want.values()) > 0


def test_a_cell_derives_overlaps_from_a_similar_set(monkeypatch):
    """Two interleaved families of near copies: each family is counted anew once or so."""
    rng, work, tally = np.random.default_rng(4), [], jaccard._Overlaps._tally
    families = [np.unique(rng.integers(0, 1 << 63, 300)) for _ in range(2)]
    sets = [np.delete(families[i % 2], 200 + i) for i in range(40)]
    monkeypatch.setattr(jaccard._Overlaps, "_tally",
                        lambda self, items: (work.append(len(items)), tally(self, items))[1])
    n = len(sets)
    rows = pa.table({"leader": pa.array([1] * n, pa.int64()), "band": pa.array([3] * n, pa.int64()),
                     "key": pa.array(range(n), pa.int64()), "left": [True] * n, "right": [True] * n,
                     "items": pa.array([s.tolist() for s in sets], pa.list_(pa.int64())),
                     "copies": pa.array([None] * n, pa.int64())})
    links = jaccard._cell_links(90, False)(rows)
    assert links.num_rows == n - 2
    assert sum(work) < 3 * 300 + 4 * n


def test_query_gives_the_number_of_links(spark):
    assert jaccard.run(spark, brute.SMALL).columns == [
        "doc_id", "n_shingles", "component_id", "n_links"]


def test_drop_near_duplicates(spark):
    docs = brute.odd_documents(spark)
    kept = jaccard.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = _pairs(docs)
    labels = brute.near(rows, 5, 80)
    # a group's smallest id stays, rows without words all stay
    want = {(i, t) for (i, t), (n, c) in zip(rows, labels) if n and (i == c)}
    got = _pairs(kept)
    assert sorted(r for r in got if brute.words(r[1])) == sorted(want)
    assert sum(not brute.words(t) for _, t in got) == sum(n == 0 for n, _ in labels)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [
        (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == ({i: 0 for i in range(1, 51)} | {100 + i: 100 for i in range(1, 40)}
                   | {201: 200})
