r"""Operator 11: phrase collocations from depth-truncated suffix subtrees.

Texts (null: empty) have A-Z lower-cased, are cut at ``[.,;:!?\x0A-\x0D]`` into pieces
and these into words ``[^\x20\x09]+``. Everything is per ``lang`` (null: ``und``). A
phrase is 2 to 4 words of one piece; f counts all its occurrences. Phrases with f of
``LEAST`` (30) or more are candidates; cut after k words into parts with l and r
occurrences a candidate scores floor(2000000 f / (l + r)), the least over its cuts
(ties: smallest k). A candidate that lies inside a longer one with at least 80 % of its
occurrences is dropped. Each language returns its ``TOP`` (2000) by score, occurrences
and phrase; that limit is the report's. Counts are exact.

Method, as ERA builds suffix trees on disk. The first two levels of the tree, words and
pairs, are counted by scans. Every word starts a suffix, truncated after four words, the
piece's end, or before a pair of words that occurs less than ``LEAST`` times (no
candidate crosses it); suffixes of three words or more are kept. Vertical partitioning:
the suffixes of a first word are counted; a word with more than half a ``BUDGET`` of them
is extended by its second word, then its third and fourth. Prefixes are dealt to as many
groups as fill half the budget on average (no prefix is larger than that), and each
group's subtree is built in one task on its own: its suffixes sorted, a node's count the
total of the leaves below it. Nodes above a long prefix are the sums over its groups.

Words are 64-bit hashes of language and word (two words of one hash would be counted as
one; 10^8 different words have such a pair with a chance of 0.03 %).

Defined cases: null and empty texts have no word; null ids, repeated rows and ties need
no care (all rows count; the phrase itself is the last order); an empty table, and a
table without a candidate, give an empty result; extra columns are not read.

Plan: three scans of the texts (words; pairs of frequent words; suffixes), each counted
in the task before anything is shuffled. The bitmaps of frequent words and pairs have a
fixed size and only save rows. Suffixes meet the few extended prefixes and are shuffled
once, to their groups. Joins meet tables of one row a key, so a word that is in a third
of all phrases is split; groups are bounded by the budget; the top of a language
is taken in salted buckets first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import Bits, Words, mix, parts, read, ship, stored, tidy

LEAST = 30                # occurrences of a candidate
TOP = 2000
DEPTH = 4
INSIDE = 80               # percent of occurrences inside a longer phrase that drop one
BUDGET = 1 << 18          # suffix rows of a group
HELD = 1 << 18            # words counted together in a task
BITS = 25                 # size of the bitmaps, a power of two
BUCKETS = 64              # salted buckets of a language's first top
_KEY = [f"h{i + 1}" for i in range(DEPTH)]
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_GAPS = np.zeros(256, dtype=bool)
_GAPS[list(b" \t" + _BREAKS)] = True
_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[list(_BREAKS)] = True


# --- scans: batches of (text, lang) ----------------------------------------------

class _Tokens:
    """Words of a run of texts: hash with the language, and whether a word follows
    the one before it in the same piece."""

    def __init__(self, text: pa.Array, lang: pa.Array):
        w = Words(text, lower=True, gaps=_GAPS)
        coded = lang.dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        salt = Words(pa.array([name.replace(" ", "_") + "_" for name in self.langs], pa.string())
                     ).hash if self.langs else np.zeros(0, np.uint64)
        self.lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[w.doc]
        self.hash = mix(w.hash + salt[self.lang])
        self.hash[self.hash == 0] = 1                     # 0: no word
        broken = np.searchsorted(np.flatnonzero(_IS_BREAK[w.data]), w.starts)
        self.follows = np.zeros(len(w.starts), dtype=bool)
        self.follows[1:] = (broken[1:] == broken[:-1]) & (w.doc[1:] == w.doc[:-1])
        self.words = w

    def spelled(self, i: int) -> str:
        w = self.words
        return w.data[w.starts[i]:w.ends[i]].tobytes().lower().decode()


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[_Tokens]:
    for batch in batches:
        text = batch.column("text")
        for a, b in parts(text, 1 << 20):
            yield _Tokens(text.slice(a, b - a), batch.column("lang").slice(a, b - a))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``h, lang, word, c``: words with their occurrences so far."""
    counts: dict[int, list] = {}

    def rows() -> pa.RecordBatch:
        langs, words, c = zip(*counts.values())
        return pa.RecordBatch.from_arrays(
            [_long(np.array(list(counts), dtype=np.uint64)), pa.array(langs), pa.array(words),
             pa.array(c, pa.int64())], names=["h", "lang", "word", "c"])

    for t in _tokens(batches):
        distinct, first, n = np.unique(t.hash, return_index=True, return_counts=True)
        for h, i, c in zip(distinct.tolist(), first.tolist(), n.tolist()):
            if h in counts:
                counts[h][2] += c
            else:
                counts[h] = [t.langs[t.lang[i]], t.spelled(i), c]
        if len(counts) > HELD // 4:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


def _folded(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Equal rows as one, with the sum of the last column."""
    *keys, c = columns
    if not len(c):
        return columns
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(c), dtype=bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return [*(k[at] for k in keys), np.add.reduceat(c[order], at)]


def _counted(names: list[str], rows_of):
    """A scan whose rows (keys, then a count) are folded in the task."""
    def batch_of(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_long(c) for c in held[0]], names=[*names, "c"])

    def fold(held):
        return [_folded([np.concatenate(x) for x in zip(*held)])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for t in _tokens(batches):
            rows = rows_of(t)
            held.append([*rows, np.ones(len(rows[0]), dtype=np.int64)])
            n += len(rows[0])
            if n >= HELD:
                held = fold(held)
                n = len(held[0][0])
                if n >= HELD // 2:
                    yield batch_of(held)
                    held, n = [], 0
        if held:
            yield batch_of(fold(held))
    return run


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a ^ mix(b))


def _linked(t: _Tokens, words: Bits) -> np.ndarray:
    """Is a word the second of a pair of frequent words?"""
    often = words.has(t.hash)
    on = t.follows.copy()
    on[1:] &= often[1:] & often[:-1]
    return on


def _pair_rows(words: Bits):
    def rows(t: _Tokens) -> list[np.ndarray]:
        at = np.flatnonzero(_linked(t, words))
        return [t.hash[at - 1], t.hash[at]]
    return rows


def _pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        yield pa.RecordBatch.from_arrays([_long(_pair(a, b))], names=["key"])


def _suffix_rows(words: Bits, pairs: Bits):
    def rows(t: _Tokens) -> list[np.ndarray]:
        on = _linked(t, words)
        at = np.flatnonzero(on)
        on[at] = pairs.has(_pair(t.hash[at - 1], t.hash[at]))
        goes = np.zeros(len(on) + DEPTH, dtype=bool)
        goes[:len(on)] = on
        starts = np.flatnonzero(goes[1:len(on)])          # the next word is linked
        out, live = [t.hash[starts]], np.ones(len(starts), dtype=bool)
        for d in range(1, DEPTH):
            live &= goes[starts + d]
            out.append(np.where(live, t.hash[np.minimum(starts + d, max(len(on) - 1, 0))],
                                np.uint64(0)) if len(starts) else out[0])
        return [c[out[2] != 0] for c in out]
    return rows


# --- vertical partitioning and subtrees --------------------------------------------

def _grouped(suffixes: DataFrame, budget: int) -> DataFrame:
    """Suffixes with the ``length`` of their prefix and their ``part``, the group."""
    rows = suffixes.withColumn("length", F.lit(1))
    opened, most = suffixes, max(1, budget // 2)
    parts_ = max(1, -(-suffixes.count() // most))
    for length in range(1, DEPTH):
        key = _KEY[:length]
        wide = stored(opened.groupBy(*key).agg(F.count("*").alias("w")).filter(
            F.col("w") > most).select(*key), "op11-wide")
        if wide.isEmpty():
            break
        opened = opened.join(wide, key, "left_semi")
        flagged = wide.withColumn("wide", F.lit(1))
        rows = rows.join(flagged, key, "left").withColumn(
            "length", F.col("length") + F.coalesce("wide", F.lit(0))).drop("wide")
    prefix = [F.when(F.col("length") > i, F.col(c)) for i, c in enumerate(_KEY)]
    return rows.withColumn("part", F.pmod(F.xxhash64(*prefix), F.lit(parts_)))


def _subtree(least: int):
    schema = pa.schema([(c, pa.int64()) for c in [*_KEY, "f"]])

    def run(rows: pa.Table) -> pa.Table:
        """The nodes of one group's subtree with 3 words or more: complete ones with
        ``least`` occurrences, and its share of those above its prefixes."""
        held = [rows.column(c).to_numpy() for c in [*_KEY, "c"]]
        length = rows.column("length").to_numpy()
        order = np.lexsort(held[DEPTH - 1::-1])
        keys, c, length = [h[order] for h in held[:-1]], held[-1][order], length[order]
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * (DEPTH + 1)]
        new = np.ones(len(c), dtype=bool)
        new[1:] = keys[0][1:] != keys[0][:-1]
        for d in range(1, DEPTH):
            new[1:] |= keys[d][1:] != keys[d][:-1]
            if d < 2:
                continue
            at = np.flatnonzero(new)
            total = np.add.reduceat(c, at)
            node = (keys[d][at] != 0) & ((total >= least) | (length[at] > d + 1))
            zero = np.zeros(node.sum(), np.int64)
            out.append([*(k[at][node] for k in keys[:d + 1]), *[zero] * (DEPTH - 1 - d), total[node]])
        return pa.table([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], schema=schema)
    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """All words (``h, lang, word, f``) and the phrases of 2 to 4 words that occur
    ``least`` times (``h1`` to ``h4``, 0 behind the last word, and ``f``), both written."""
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    words = stored(texts.mapInArrow(tidy(_word_rows), "h long, lang string, word string, c long").groupBy(
        "h", "lang", "word").agg(F.sum("c").alias("f")), "op11-words")
    often = Bits(words.filter(F.col("f") >= least), "h", size=BITS)
    pairs = stored(texts.mapInArrow(
        tidy(_counted(["h1", "h2"], _pair_rows(often))), "h1 long, h2 long, c long").groupBy(
        "h1", "h2").agg(F.sum("c").alias("f")).filter(F.col("f") >= least), "op11-pairs")
    linked = Bits(pairs.mapInArrow(tidy(_pair_keys), "key long"), "key", size=BITS)
    suffixes = stored(texts.mapInArrow(
        tidy(_counted(_KEY, _suffix_rows(often, linked))),
        ", ".join(f"{c} long" for c in [*_KEY, "c"])), "op11-suffixes")
    nodes = _grouped(suffixes, budget).groupBy("part").applyInArrow(
        _subtree(least), ", ".join(f"{c} long" for c in [*_KEY, "f"]))
    phrases = nodes.groupBy(*_KEY).agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    none = F.lit(0).cast("long")
    return words, stored(phrases.unionByName(pairs.select(
        "h1", "h2", none.alias("h3"), none.alias("h4"), "f")), "op11-phrases")


# --- scores ------------------------------------------------------------------------

def _size() -> Column:
    return reduce(lambda a, b: a + b, [F.when(F.col(c) != 0, 1).otherwise(0) for c in _KEY])


def _sub(start: int, length: int) -> list[Column]:
    """Key columns of the words ``start`` to ``start + length`` of a phrase."""
    held = [F.col(c) for c in _KEY[start:start + length]]
    return held + [F.lit(0).cast("long")] * (DEPTH - length)


def _keyed(start: int, length: int) -> Column:
    return F.struct(*[c.alias(f"q{i + 1}") for i, c in enumerate(_sub(start, length))])


def _scored(phrases: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``phrases`` with ``score, l, r`` of the cut that scores least."""
    known = phrases.unionByName(words.filter(F.col("f") >= least).select(
        F.col("h").alias("h1"), *[F.lit(0).cast("long").alias(c) for c in _KEY[1:]], "f"))
    known = stored(known.select(*[F.col(c).alias(f"q{i + 1}") for i, c in enumerate(_KEY)],
                                F.col("f").alias("g")), "op11-known")
    sized = phrases.withColumn("size", _size())
    asked = []
    for size in range(2, DEPTH + 1):
        cuts = [F.struct(F.lit(k).alias("k"), F.lit(side).alias("first"), _keyed(a, n).alias("q"))
                for k in range(1, size) for side, a, n in ((True, 0, k), (False, k, size - k))]
        asked.append(F.when(F.col("size") == size, F.array(*cuts)))
    cut = sized.withColumn("cut", F.explode(F.coalesce(*asked))).select(
        *_KEY, "f", "cut.k", "cut.first", "cut.q.*")
    counted = cut.join(known, [f"q{i + 1}" for i in range(DEPTH)]).groupBy(*_KEY, "f", "k").agg(
        F.max(F.when(F.col("first"), F.col("g"))).alias("l"),
        F.max(F.when(~F.col("first"), F.col("g"))).alias("r"))
    score = F.expr("cast((cast(f AS decimal(24, 0)) * 2000000) div (l + r) AS long)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b")
    return counted.groupBy(*_KEY, "f").agg(best).select(*_KEY, "f", "b.score", "b.l", "b.r")


def _outstanding(scored: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates that no longer phrase holds to ``INSIDE`` percent."""
    sized = phrases.withColumn("size", _size())
    inner = []
    for size in range(3, DEPTH + 1):
        subs = [_keyed(a, n) for n in range(2, size) for a in range(size - n + 1)]
        inner.append(F.when(F.col("size") == size, F.array(*subs)))
    inside = sized.filter("size > 2").withColumn("q", F.explode(F.coalesce(*inner))).groupBy(
        *[F.col(f"q.q{i + 1}").alias(c) for i, c in enumerate(_KEY)]).agg(F.max("f").alias("most"))
    return scored.join(stored(inside, "op11-inside"), _KEY, "left").filter(
        f"most IS NULL OR 100 * most < {INSIDE} * f").drop("most")


def _spelled(scored: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``scored`` with its ``lang`` and ``phrase``."""
    each = scored.select("*", F.posexplode(F.array(*_KEY)).alias("at", "h")).filter("h <> 0")
    names = words.filter(F.col("f") >= least).select("h", "lang", "word")
    found = each.join(names, "h").groupBy(*_KEY, "f", "score", "l", "r", "lang").agg(
        F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    return found.withColumn("phrase", F.array_join("words.word", " "))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 least: int = LEAST, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top``."""
    words, phrases = phrase_counts(docs, text_col, lang_col, least, budget)
    scored = _spelled(_outstanding(_scored(phrases, words, least), phrases), words, least)
    order = [F.desc("score"), F.desc("f"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    some = Window.partitionBy("lang", "bucket").orderBy(*order)
    first = scored.withColumn("bucket", bucket).withColumn("rank", F.row_number().over(some)).filter(
        F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    totals = words.groupBy(F.col("lang").alias("of")).agg(F.sum("f").alias("n"))
    return first.withColumn("rank", rank).filter(F.col("rank") <= top).join(
        totals, F.col("lang") == F.col("of")).select(
        "lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def run(spark, sf_dir) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(
       coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')),
       '[^\x20\x09]+') AS w FROM documents),
g AS (SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM p, range(1, 5) t(s) WHERE len(w) >= s)
      GROUP BY ALL),
c AS (SELECT lang, s, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE s > 1 AND f >= 30),
cut AS (SELECT *, unnest(range(1, s)) AS k FROM c),
sc AS (SELECT cut.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score FROM cut
       JOIN g x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:k], ' ')
       JOIN g y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
           FROM (SELECT *, unnest(range(1, s - m + 2)) AS i FROM c, range(2, 4) t(m) WHERE m < s) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE s = 1 GROUP BY lang)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
       b.phrase, a, l, r, n, score::BIGINT AS score
FROM best b JOIN n ON n.lang = b.lang LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE most IS NULL OR 100 * most < 80 * a
QUALIFY rank <= 2000
"""
