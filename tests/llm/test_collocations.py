"""Operator 11 against counts of all phrases in plain Python."""

import random
import re
from collections import Counter

import duckdb
import pytest

import brute
from hirelake.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _plain(rows, least, top):
    count = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    count["und" if lang is None else lang, tuple(w[i:i + n])] += 1
    total = Counter()
    for (lang, p), c in count.items():
        total[lang] += c if len(p) == 1 else 0
    long = {k: c for k, c in count.items() if len(k[1]) > 1 and c >= least}
    most = Counter()
    for (lang, p), c in long.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                most[lang, p[i:i + n]] = max(most[lang, p[i:i + n]], c)
    out = {}
    for (lang, p), a in long.items():
        if 100 * most[lang, p] >= 80 * a:
            continue
        cuts = [(2000000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), count[lang, p[:k]],
                                         count[lang, p[k:]]))
    return {(lang, rank + 1, phrase.decode(), -a, l, r, total[lang], -score)
            for lang, found in out.items()
            for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top])}


def _random(n, seed):
    dice = random.Random(seed)
    words = ["a", "B", "the", "The", "é", "ß", "of", "x\x00y", "-", "日本", "🎉"]
    ends = [" ", " ", " ", "\t", "  ", ". ", "\n", " ", "? ", ",", "\x0b"]
    return [(dice.choice(["en", "de", None, "und", ""]),
             dice.choice([None, "", " "]) if dice.random() < 0.1 else
             "".join(dice.choice(words) + dice.choice(ends) for _ in range(dice.randrange(60))))
            for _ in range(n)]


@pytest.mark.parametrize("budget", [1 << 18, 40, 1])
def test_random_texts(spark, budget):
    """A small budget extends most prefixes, up to whole phrases."""
    rows = _random(150, budget)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "lang string, text string, h1 long, word string").repartition(3)
    got = collocations.collocations(docs, least=3, top=40, budget=budget).collect()
    assert {tuple(r) for r in got} == _plain(rows, 3, 40)
    assert len(got) == len({(r.lang, r.rank) for r in got})


def test_a_repeated_phrase_and_odd_documents(spark):
    rows = [(None, t) for _, t in brute.TEXTS] + [("en", "the same four words here. ") ] * 300
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, least=20, budget=50).collect()
    assert {tuple(r) for r in got} == _plain(rows, 20, 2000)


def test_empty_and_without_candidates(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).collect() == []
    docs = spark.createDataFrame([("en", "one two three"), (None, None)], "lang string, text string")
    assert collocations.collocations(docs).collect() == []


def test_given_documents_equal_the_sql_with_fewer_occurrences(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{brute.SMALL}/documents.parquet')")
    want = con.sql(collocations.SQL.replace("f >= 30", "f >= 5")).fetchall()
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    got = collocations.collocations(docs, least=5, budget=500)
    assert {tuple(r) for r in got.collect()} == set(want) and len(want) > 100
