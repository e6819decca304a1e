"""Operator 9 against plain Python."""

from collections import defaultdict

import pytest

import brute
from hirelake.llm import mixing


def _sizes(rows):
    out = defaultdict(int)
    for r in rows:
        out[r["source"]] += len(brute.words(r["text"]))
    return dict(out)


@pytest.mark.parametrize("slots", [mixing.SLOTS, 64])
@pytest.mark.parametrize("name", ["odd", "small", "empty"])
def test_mix(spark, name, slots):
    docs = (brute.odd_documents(spark) if name == "odd"
            else spark.read.parquet(f"{brute.SMALL}/documents.parquet"))
    docs = docs.limit(0) if name == "empty" else docs
    rows = docs.collect()
    sizes = _sizes(rows)
    want = brute.targets(sizes)
    got = mixing.mix_sources(docs, slots=slots).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (r.doc_id is None, r.doc_id or 0, len(brute.words(r.text))) for r in rows)
    taken = defaultdict(int)
    by_size = {(r.source_size, round(r.target, 6)): 0 for r in got}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_size[r.source_size, round(r.target, 6)] += r.taken
        taken[r.doc_id] += r.taken
    assert {k[0]: k[1] for k in by_size} == {sizes[s]: pytest.approx(want[s], abs=1e-5) for s in sizes}
    for (_, target), words in by_size.items():
        assert abs(words - target) <= 0.5 + 1e-6
    again = mixing.mix_sources(docs, slots=slots).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_pieces_alternate_and_add_up(spark):
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    pieces = mixing.mix_pieces(docs, slots=4096).collect()
    taken = defaultdict(int)
    for p in pieces:
        taken[p.doc_id] += p.words
    want = {r.doc_id: r.taken for r in mixing.mix_sources(docs, slots=4096).collect() if r.taken}
    assert dict(taken) == want
    # every source appears evenly along the mix: about its share in each tenth
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    top, total = max(p.slot for p in pieces) + 1, sum(taken.values())
    tenth, whole = defaultdict(int), defaultdict(int)
    for p in pieces:
        whole[source[p.doc_id]] += p.words
        tenth[p.slot * 10 // top, source[p.doc_id]] += p.words
    for (_, s), n in tenth.items():
        assert abs(n - whole[s] / 10) < 0.02 * total / 10 + 200


def test_mixed_documents(spark):
    docs = brute.odd_documents(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.doc_id, r.source] += len(brute.words(r.text))
    want = defaultdict(int)
    source = {}
    for r in docs.collect():
        source.setdefault((r.doc_id, len(brute.words(r.text))), []).append(r.source)
    got_total = sum(words.values())
    for r in mixing.mix_sources(docs).collect():
        want[r.doc_id] += r.taken
    by_id = defaultdict(int)
    for (i, _), n in words.items():
        by_id[i] += n
    assert dict(by_id) == {i: n for i, n in want.items() if n}
    assert got_total == sum(want.values())
