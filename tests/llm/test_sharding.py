"""Operator 13 against a k-d tree in plain Python, and its shards as files."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from hirelake.llm import sharding


def _tree(rows, shards):
    """{row number: shard} for rows (id, text, metadata numbers or None)."""
    weigh = lambda t: len((t or "").encode()) + 16
    columns = [[None if v is None else float(v) for v in c]
               for c in (list(zip(*[r[2] for r in rows])) if rows else [])]
    columns.append([float(weigh(r[1])) for r in rows])
    scaled = []
    for c in columns:
        known = [v for v in c if v is not None]
        low, high = (min(known), max(known)) if known else (0, 0)
        scaled.append([0 if v is None or high == low else int((v - low) / (high - low) * (2 ** 31 - 1))
                       for v in c])
    md5 = [hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest() for r in rows]
    home = {}

    def split(some, first, k):
        if k == 1 or not some:
            home.update({i: first for i in some})
            return
        widths = [max(c[i] for i in some) - min(c[i] for i in some) for c in scaled]
        dim = scaled[widths.index(max(widths))]
        some = sorted(some, key=lambda i: (dim[i], int(md5[i][:8], 16), i))
        share, total, at, left = k // 2, sum(weigh(rows[i][1]) for i in some), 0, []
        for i in some:
            at += weigh(rows[i][1])
            if 2 * at - weigh(rows[i][1]) <= 2 * total * share // k:
                left.append(i)
        split(left, first, share)
        split(some[len(left):], first + share, k - share)
    split(list(range(len(rows))), 0, shards)
    return home, md5


def _text_number(s):
    return None if s is None else int(s.encode()[:6].hex().ljust(12, "0"), 16)


@pytest.mark.parametrize("name", ["odd", "small", "empty"])
@pytest.mark.parametrize("bins, finish, shards", [(4096, 4096, 40), (3, 2, 7)])
def test_shards_are_the_tree_s(spark, monkeypatch, name, bins, finish, shards):
    monkeypatch.setattr(sharding, "BINS", bins)
    monkeypatch.setattr(sharding, "FINISH", finish)
    docs = brute.odd_documents(spark) if name == "odd" else spark.read.parquet(
        f"{brute.SMALL}/documents.parquet")
    docs = docs.limit(0) if name == "empty" else docs
    dims = [c for c in ("source", "lang") if c in docs.columns]
    rows = [(r["doc_id"], r["text"], [_text_number(r[c]) for c in dims]) for r in docs.collect()]
    home, _ = _tree(rows, shards)
    want = Counter((rows[i][0], len((rows[i][1] or "").encode()) + 16,
                    zlib.crc32((rows[i][1] or "").encode()), s) for i, s in home.items())
    got = sharding.shard_rows(docs, shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_repeated_rows_part_and_sizes_are_even(spark, monkeypatch):
    """A third of the rows one document: shards still differ by a document or two."""
    monkeypatch.setattr(sharding, "BINS", 4)
    monkeypatch.setattr(sharding, "FINISH", 20)
    rows = [(7 if i % 3 == 0 else i, "same text" if i % 3 == 0 else f"text {i}" * (i % 5 + 1), "a", i % 4)
            for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, month int")
    got = sharding.shard_rows(docs.repartition(5), 9, dims=("source", "month")).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert len(got) == 900 and len(sizes) == 9
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got)
    slots = Counter((r.shard, r.slot) for r in got)
    assert max(slots.values()) == 1


def test_target_bytes_set_the_number_of_shards(spark):
    docs = spark.createDataFrame([(i, "x" * 84) for i in range(64)], "doc_id long, text string")
    assert sharding.shard_rows(docs, target_bytes=800).agg(F.countDistinct("shard")).first()[0] == 8


def test_sharded_documents_and_files(spark, tmp_dir):
    docs = brute.odd_documents(spark).withColumn("no", F.lit(5)).withColumn("shard", F.lit("x"))
    got = sharding.sharded_documents(docs, 4)
    assert got.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    want = sharding.shard_rows(docs, 4).select("doc_id", "shard").collect()
    assert Counter((r.doc_id, r.shard) for r in got.collect()) == Counter(map(tuple, want))
    sharding.write_shards(docs, f"{tmp_dir}/shards", shards=4)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.count() == docs.count()
    assert Counter(r.shard for r in back.collect()) == Counter(r.shard for r in want)
