"""Plain Python versions of the operators, and a small table of odd documents."""

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql.types import LongType, StringType, StructField, StructType

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = re.compile(r"[\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"

# clashing names on purpose: helper columns of the operators
SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()),
    StructField("source", StringType()), StructField("key", StringType()),
    StructField("_key", LongType()), StructField("c0", StringType()),
    StructField("d", StringType()), StructField("kept", StringType()),
    StructField("_taken", LongType()), StructField("token", StringType())])

PASSAGE = " ".join(f"word{i}" for i in range(60))
LONG = "\n".join(f"line {i} of a very long text, number {i * i}" for i in range(4000))
TEXTS = [
    (1, "Hello  world\tand all"), (2, "Hello world and all"), (3, "hello world and all"),
    (4, None), (5, ""), (6, "   "), (7, None), (8, "one"), (9, "one"), (None, "one"),
    (None, None), (10, "a b"), (11, "A b"), (12, PASSAGE), (13, "x " + PASSAGE + " y"),
    (14, PASSAGE), (15, "w " * 100), (16, LONG), (17, LONG + "\nand one more line"),
    (18, "l1\nl2\nl3\nl4"), (19, "zero\nl1\nl2\nl3\nend"), (20, "same\n" * 9),
    (21, "naïve café déjà vu, größer als 日本語 🎉 ok"), (22, "x" * 30_000),
    (23, "mail a.b@c-d.example.com or @ or x@y. ip 1.2.3.4.5.6.7.8 999.1.1.1 +1 (988) 555-2485 "
         "4041894974608795 4041 8949-7460 8795 <|endoftext|> <s> \x0b\x1c tail "),
    (24, PASSAGE + " " + PASSAGE), (15, "w " * 100), (30, "two spaces here"),
    (31, " ".join(f"t{i}" for i in range(200))), (32, " ".join(f"t{i}" for i in range(201))),
    (33, " ".join(f"t{i}" if i != 90 else "tx" for i in range(200))), (34, "퟿� \x00 z"),
]


def odd_documents(spark):
    rows = [(i, t, ["b", "a", None, "c"][k % 4], f"k{k}", k, None if k % 3 else "c", "d", "e",
             k, "t") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """{(doc_id, sha): (keep_id, group_size)}"""
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACES.sub(" ", t or "")].append(i)
    out = {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            out[i, sha(text)] = (min(known) if known else None, len(ids))
    return out


def line_cut(rows, span=3):
    """The text that stays of each row, in the rows' order."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    seen, cut = set(), defaultdict(set)
    for row in order:
        lines = (row[1] or "").split("\n")
        for p in range(len(lines) - span + 1):
            window = tuple(lines[p:p + span])
            if window in seen:
                cut[row].update(range(p, p + span))
            seen.add(window)
    return [t if not cut[i, t] else "\n".join(
        x for p, x in enumerate(t.split("\n")) if p not in cut[i, t]) for i, t in rows]


def shingles(text, k):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def near(rows, k, percent):
    """(n_shingles, component id) of each row, in the rows' order."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in held[g])
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
        for g in s:
            held[g].append(i)
    names = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[find(i)] = min(names.get(find(i), doc), doc)
    return [(len(s), names.get(find(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def substring(rows, window=35):
    """(words, removed, kept text) of each row."""
    texts = [words(t) for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def targets(sizes, limit=3):
    """{source: target} of {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, free, out = sum(sizes.values()), set(order), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > limit * sizes[s] + 1e-9}
        if not over:
            return out | {s: share * weight[s] for s in free}
        for s in over:
            out[s] = float(limit * sizes[s])
            left -= out[s]
        free -= over
    return out
