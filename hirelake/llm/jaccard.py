r"""Operator 7: n-gram Jaccard join with set-relation skipping.

A document's set is its distinct word shingles (``words`` consecutive words of
``[^\x20\x09-\x0D]+``, A-Z lower-cased; with fewer words the whole sequence is one;
without words it is empty). Two documents link when their sets' intersection is at
least ``percent`` % of their union; empty sets link with nothing. Shingles are
64-bit hashes, equal sets are told by 128-bit digests, classes named by 64 bits.

Join. Equal sets are one class, joined once. Shingles have one order for all sets:
those that very many sets share last, others by hash. Sets that link share a
shingle among the first ``n - ceil(percent * n / 100) + 1``, their prefix. Prefix
shingles of one set only are skipped (a bitmap); the rest are an inverted index.

* A list of at most ``SHORT`` sets gives its pairs, less those that their sizes,
  the shingle's positions or a parity sketch (about one bit a shingle) rule out
  (popcount of the XOR never exceeds the symmetric difference). These are bounds, not guesses. The
  rest are compared in one cell for each first set of a pair.
* A longer list goes by its leader, its smallest set: all sets on lists of one
  leader are joined among themselves in cells. Cells hold one band of set sizes
  and the next, so blocks whose sizes cannot link are skipped, and about ``CELL``
  sets or ``CELL_SHINGLES`` shingles a side. A cell's sets are ordered by their smallest hashes (a min-wise
  sketch), so similar sets follow each other. A set's overlaps with all others are
  derived from those of the set before it, by the shingles in which the two differ,
  if that is less work than counting anew. A cell returns the links that join its sets into
  trees: for a group of thousands of near copies, as many links as sets.

Links that are left out of the trees only close circles, so components are complete.

Link counts. ``n_links`` is the number of other documents that a document links
with, copies too; half its sum is the number of links. All links are verified in
cells, and each is counted in one: the cell of the smallest leader that its two
sets share, or their pair's cell if they share none. A cell returns one number a
set, so a group of thousands of near copies costs its sets, not its pairs.

Defined cases: null and empty texts have no set and stay alone; rows that repeat
id and text are one document; a null id never names a component unless it has no
other; ties go to the smaller id; an empty table gives an empty result; extra
columns pass through ``drop_near_duplicates``.

Plan: four scans of the texts (sets' digests; shingles for the common ones; prefix
counts; postings) and one that fetches the few sets to compare; texts are not
shuffled. What is shuffled are hashes, counted map-side first. Bitmaps sent to
tasks have a fixed size. No task holds more than a cell or a list of ``SHORT``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import (Bits, Words, mix, numbered, read, small_batches, stored, tidy,
                                 window_hash)
from hirelake.llm.components import components

WORDS, PERCENT = 3, 90    # the query's; the pipeline's stage uses 5 and 80
SHORT = 8
CELL = 1024               # sets of a cell's side
CELL_SHINGLES = 1 << 19   # and their shingles, about
LIKE = 4                  # smallest hashes by which a cell's sets are ordered
SKETCH = 512              # bits of the smallest parity sketch; larger sets have more


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _needed(a: str, b: str, percent: int) -> str:
    """SQL: the least overlap of sets of sizes ``a`` and ``b`` that link."""
    return f"ceil({percent} * ({a} + {b}) / {100 + percent}.0D)"


def _apart(x: str, y: str) -> str:
    """SQL: popcount of the XOR of two sketches, the larger one folded to the other's
    length (parities of halves add up); sets that may link differ by one fold."""
    def fit(a: str, b: str) -> str:
        half = f"cast(size({a}) / 2 as int)"
        return (f"if(size({a}) > size({b}), zip_with(slice({a}, 1, {half}), "
                f"slice({a}, {half} + 1, {half}), (p, q) -> p ^ q), {a})")
    return (f"aggregate(zip_with({fit(x, y)}, {fit(y, x)}, "
            "(p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)")


def _array(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _array(flat.astype(np.uint64)))


# --- scans: batches of (key, text) ----------------------------------------------

def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, sketches = [], [], [], []
            for s in Words(batch.column("text"), lower=True).shingles(words):
                whole = np.array([0]), np.array([len(s)])
                sizes.append(len(s))
                one.append(window_hash(s, *whole)[0])
                two.append(window_hash(mix(s ^ np.uint64(words)), *whole)[0])
                bits = max(SKETCH, 1 << max(len(s) - 1, 0).bit_length())
                odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64),
                                  minlength=bits) & 1
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.uint64))
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(sizes, pa.int64()),
                 _array(np.array(one, dtype=np.uint64)), _array(np.array(two, dtype=np.uint64)),
                 _lists(sketches)], names=[*rest, "n", "d1", "d2", "sketch"])
    return run


def _chosen_sets(batch: pa.RecordBatch, words: int, chosen: Bits):
    """``key, shingles`` of the batch's documents whose key is set in the bitmap."""
    keys = batch.column("key").to_numpy()
    on = chosen.has(keys.view(np.uint64))
    part = batch.column("text").filter(pa.array(on))
    return zip(keys[on], Words(part, lower=True).shingles(words))


def _head_rows(words: int, percent: int, chosen: Bits):
    """The first shingles by hash, some more than a prefix has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [s[:5 * _prefix(len(s), percent) // 4 + 8]
                    for _, s in _chosen_sets(batch, words, chosen) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [_array(np.concatenate([np.zeros(0, np.uint64), *rows]))], names=["shingle"])
    return run


def _in_order(s: np.ndarray, percent: int, common: Bits) -> np.ndarray:
    """The prefix of a set in the order of all shingles."""
    late = common.has(s)
    length = _prefix(len(s), percent)
    early = s[~late][:length]
    return np.concatenate([early, s[late][:length - len(early)]]) if len(early) < length else early


def _prefix_rows(words: int, percent: int, chosen: Bits, common: Bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_in_order(s, percent, common)
                    for _, s in _chosen_sets(batch, words, chosen) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [_array(np.concatenate([np.zeros(0, np.uint64), *rows]))], names=["shingle"])
    return run


def _posting_rows(words: int, percent: int, chosen: Bits, common: Bits, shared: Bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles, at, keys, sizes = [np.zeros(0, np.uint64)], [], [], []
            for key, s in _chosen_sets(batch, words, chosen):
                if not len(s):
                    continue
                prefix = _in_order(s, percent, common)
                on = np.flatnonzero(shared.has(prefix))
                shingles.append(prefix[on])
                at.extend(on.tolist())
                keys.extend([key] * len(on))
                sizes.extend([len(s)] * len(on))
            yield pa.RecordBatch.from_arrays(
                [_array(np.concatenate(shingles)), pa.array(keys, pa.int64()),
                 pa.array(sizes, pa.int32()), pa.array(at, pa.int32())],
                names=["shingle", "key", "n", "at"])
    return run


def _fetch_rows(words: int, chosen: Bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_chosen_sets(batch, words, chosen))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int64()), _lists([s for _, s in rows])],
                names=["key", "shingles"])
    return run


# --- cells of long lists ----------------------------------------------------------

class _Overlaps:
    """Overlaps of one set with each of ``sets``, by an inverted index; those of the
    set asked before are corrected where the two differ, if that is less work."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        member = np.repeat(np.arange(self.n), [len(s) for s in sets])
        held = np.concatenate([np.zeros(0, np.int64), *sets])
        order = np.argsort(held, kind="stable")
        self.held, self.member = held[order], member[order]
        self.last, self.answer = np.zeros(0, np.int64), np.zeros(self.n, np.int64)

    def _tally(self, items: np.ndarray) -> np.ndarray:
        lo = np.searchsorted(self.held, items, side="left")
        n = np.searchsorted(self.held, items, side="right") - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.member[at], minlength=self.n)

    def of(self, own: np.ndarray) -> np.ndarray:
        new = np.setdiff1d(own, self.last, assume_unique=True)
        old = np.setdiff1d(self.last, own, assume_unique=True)
        if len(new) + len(old) < len(own):
            self.answer = self.answer + self._tally(new) - self._tally(old)
        else:
            self.answer = self._tally(own)
        self.last = own
        return self.answer


def _rows_of(lists: pa.ChunkedArray) -> list[np.ndarray]:
    whole = lists.combine_chunks()
    offsets, flat = whole.offsets.to_numpy(), whole.values.to_numpy()
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _cell_links(percent: int, counted: bool):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def earlier(rows: pa.Table, keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Each set's leaders whose cells come before this one, and its documents."""
        at = {k: i for i, k in enumerate(rows.column("key").to_pylist())}
        leaders, copies = _rows_of(rows.column("items")), rows.column("copies").to_numpy()
        if rows.column("band")[0].as_py() >= 0:          # cells of pairs come last
            leaders = [x[x < rows.column("leader")[0].as_py()] for x in leaders]
        place = [at[k] for k in keys.tolist()]
        return [leaders[p] for p in place], copies[place]

    def cell(rows: pa.Table) -> pa.Table:
        """Links between left and right sets, as trees (``a, b``), and (``a, a, n``)
        the number of documents at the other end of the links counted here."""
        is_set = pc.is_null(rows.column("copies"))
        facts, rows = rows.filter(pc.invert(is_set)), rows.filter(is_set)
        is_left = rows.column("left").to_numpy()
        left, right = np.flatnonzero(is_left), np.flatnonzero(rows.column("right").to_numpy())
        sets, keys = _rows_of(rows.column("items")), rows.column("key").to_numpy()
        left = np.array(sorted(left.tolist(), key=lambda i: sets[i][:LIKE].tolist()), np.int64)
        sizes = np.array([len(sets[r]) for r in right], dtype=np.int64)
        overlaps = _Overlaps([sets[r] for r in right])
        if counted:
            before, copies = earlier(facts, keys)
            shared = _Overlaps([before[r] for r in right])
            links = np.zeros(len(keys), np.int64)
        names, group = np.unique(keys, return_inverse=True)
        root = np.arange(len(names))
        found: list[tuple[int, int]] = []
        for i in left:
            own = sets[i]
            near = (100 + percent) * overlaps.of(own) >= percent * (sizes + len(own))
            linked = right[near]
            home = root[group[i]]
            for other in np.unique(root[group[linked]]):
                if other != home:
                    j = linked[root[group[linked]] == other][0]
                    found.append((keys[i], keys[j]))
                    root[root == other] = home
            if counted:                # two sets on both sides meet twice: once counts
                ends = right[near & (shared.of(before[i]) == 0) & ~(is_left[right] & (right <= i))]
                links[i] += copies[ends].sum()
                links[ends] += copies[i]
        a, b, n = [a for a, _ in found], [b for _, b in found], [0] * len(found)
        if counted:
            some = np.flatnonzero(links)
            a, b, n = a + keys[some].tolist(), b + keys[some].tolist(), n + links[some].tolist()
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], schema=schema)
    return cell


def _cells(members: DataFrame, percent: int) -> DataFrame:
    """Rows ``leader, band, i, j, key, left, right`` of the cells of long lists.

    Two sets of a leader meet in one cell: within a band in that of the lower block
    ``i`` and the higher ``j``, else in that of the lower band's block ``i``.
    """
    width = -log(percent / 100) * 1.001      # sizes that link differ by one band at most
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(width))
    counts = stored(members.groupBy("leader").agg(
        F.greatest(F.ceil(F.count("*") / F.lit(CELL)),
                   F.ceil(F.sum("n") / F.lit(CELL_SHINGLES))).cast("int").alias("blocks")),
        "op7-leaders")
    sized = members.join(counts, "leader").withColumn("band", band).withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    lefts = sized.withColumn("j", others).select(
        "leader", "band", F.col("block").alias("i"), "j", "key", F.lit(True).alias("left"),
        (F.col("block") == F.col("j")).alias("right"))
    rights = sized.withColumn("i", others).withColumn(
        "home", F.explode(F.array(F.col("band"), F.col("band") - 1))).filter(
        "home <> band OR i < block").select(
        "leader", F.col("home").alias("band"), "i", F.col("block").alias("j"), "key",
        F.lit(False).alias("left"), F.lit(True).alias("right"))
    rows = stored(lefts.unionByName(rights), "op7-cells")
    cell = ["leader", "band", "i", "j"]
    useful = stored(rows.groupBy(*cell).agg(
        F.count_if("left").alias("l"), F.count_if("right").alias("r"), F.count("*").alias("n"))
        .filter("l > 0 AND r > 0 AND n > 1").select(*cell), "op7-useful")
    return rows.join(useful, cell, "left_semi")


# --- the join --------------------------------------------------------------------

def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
                       F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col)).alias("key2"),
                       F.col(text_col).alias("text"))


def _links(texts: DataFrame, sets: DataFrame, words: int, percent: int,
           repeats: bool, counted: bool) -> DataFrame:
    """Links ``a, b`` between class keys that make the components, ``n`` 0; if
    ``counted``, also rows ``a, a, n`` whose sum is the number of documents in the
    classes that ``a`` links with."""
    n = max(sets.count(), 1)
    chosen = Bits(sets, "key", size=min(27, max(16, (8 * n).bit_length())))
    heads = texts.mapInArrow(tidy(_head_rows(words, percent, chosen)), "shingle long")
    common = Bits(heads.groupBy("shingle").count().filter(F.col("count") >= SHORT), "shingle")
    firsts = texts.mapInArrow(tidy(_prefix_rows(words, percent, chosen, common)), "shingle long")
    shared = Bits(firsts.groupBy("shingle").count().filter("count > 1"), "shingle", size=25)
    postings = stored(texts.mapInArrow(
        tidy(_posting_rows(words, percent, chosen, common, shared)),
        "shingle long, key long, n int, at int"), "op7-postings")
    counts = stored(postings.groupBy("shingle").agg(
        F.count("*").alias("m"), F.min("key").alias("leader")).filter("m > 1"), "op7-counts")
    # one row a shingle on the right: a shingle that very many sets share can be split
    lists = stored(postings.join(counts, "shingle").withColumn(
        "leader", F.when(F.col("m") > SHORT, F.col("leader"))).drop("m"), "op7-lists")
    short = lists.filter("leader IS NULL").drop("leader")
    a, b = short.alias("a"), short.alias("b")
    pairs = a.join(b, F.expr("a.shingle = b.shingle AND a.key < b.key")).filter(F.expr(
        f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) AND "
        "1 + least(a.n - a.at - 1, b.n - b.at - 1) + least(a.at, b.at) >= "
        + _needed("a.n", "b.n", percent))).select(
        F.col("a.key").alias("a"), F.col("b.key").alias("b")).distinct()
    known = sets.select("key", "n", "sketch")
    sketched = pairs.join(known.select(*[F.col(c).alias(f"a_{c}") for c in known.columns]),
                          F.col("a") == F.col("a_key")).join(
        known.select(*[F.col(c).alias(f"b_{c}") for c in known.columns]),
        F.col("b") == F.col("b_key"))
    apart = _apart("a_sketch", "b_sketch")
    close = stored(sketched.filter(
        f"{apart} <= a_n + b_n - 2 * {_needed('a_n', 'b_n', percent)}").select("a", "b"),
        "op7-pairs")
    # copies of a class whose keys pass the bitmap by chance do not stand beside it
    members = stored(lists.filter("leader IS NOT NULL").select("leader", "key", "n").distinct()
                     .join(sets.select("key"), "key", "left_semi").select("leader", "key", "n"),
                     "op7-members")
    whole = F.lit(0)
    stars = [close.select(F.col("a").alias("leader"), F.lit(-1).cast("long").alias("band"),
                          whole.alias("i"), whole.alias("j"), F.col(c).alias("key"),
                          F.lit(c == "a").alias("left"), F.lit(c == "b").alias("right"))
             for c in ("a", "b")]
    cells = stored(_cells(members, percent).unionByName(stars[0].distinct()).unionByName(stars[1]),
                   "op7-compared")
    fetched = texts.mapInArrow(tidy(_fetch_rows(words, Bits(cells, "key"))),
                               "key long, shingles array<long>")
    if repeats:                       # rows that repeat id and text: one set
        fetched = fetched.dropDuplicates(["key"])
    items = fetched.select("key", F.col("shingles").alias("items"),
                           F.lit(None).cast("long").alias("copies"))
    if counted:                       # what a cell must know of its sets to count, as rows
        led = members.groupBy("key").agg(F.sort_array(F.collect_set("leader")).alias("items"))
        items = items.unionByName(sets.select("key", "copies").join(led, "key", "left").select(
            "key", F.coalesce("items", F.array().cast("array<long>")).alias("items"), "copies"))
    return cells.join(items, "key").groupBy("leader", "band", "i", "j").applyInArrow(
        _cell_links(percent, counted), "a long, b long, n long")


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int,
              counted: bool = False) -> DataFrame:
    """One row a row of ``docs``: ``doc_id, key, key2, n``, its component's smallest
    ``component_id``, whether it ``leads`` it, and if ``counted`` its ``n_links``."""
    small_batches(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    each = stored(rows.mapInArrow(
        tidy(_set_rows(words)), f"doc_id {kind}, key long, key2 long, n long, d1 long, d2 long, "
                          "sketch array<long>"), "op7-documents")
    repeats = not each.groupBy("key").count().filter("count > 1").isEmpty()
    classes = each.filter("n > 0").groupBy("d1", "d2").agg(
        F.min("key").alias("key"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.count("*").alias("copies"))
    if counted and repeats:           # rows that repeat id and text are one document
        classes = classes.drop("copies").join(
            each.filter("n > 0").select("d1", "d2", "key").distinct().groupBy("d1", "d2").agg(
                F.count("*").alias("copies")), ["d1", "d2"])
    classes = stored(classes, "op7-classes")
    links = _links(rows.select("key", "text"), classes, words, percent, repeats, counted)
    if counted:
        links = stored(links, "op7-links")
    roots = components(links.select("a", "b"))
    of_class = classes.join(roots, classes["key"] == roots["node"], "left").select(
        "d1", "d2", "key", "copies", F.coalesce("root", "key").alias("root"))
    if counted:
        ends = links.filter("a = b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("ends"))
        of_class = of_class.join(ends, "key", "left").withColumn(
            "n_links", F.coalesce("ends", F.lit(0).cast("long")) + F.col("copies") - 1)
    else:
        of_class = of_class.withColumn("n_links", F.lit(None).cast("long"))
    of_class = stored(of_class.select("d1", "d2", "root", "n_links"), "op7-class-roots")
    named = stored(each.join(of_class, ["d1", "d2"], "left").select(
        "doc_id", "key", "key2", "n", F.when(F.col("n") > 0, F.col("root")).alias("root"),
        F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).alias("n_links")),
        "op7-roots")
    order = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "key", "key2")
    firsts = stored(named.filter("n > 0").groupBy("root").agg(F.min(order).alias("first")),
                    "op7-firsts")
    joined = named.join(firsts, "root", "left")
    return joined.select(
        "doc_id", "key", "key2", "n", "n_links",
        F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, (F.col("first.key") == F.col("key"))
               & (F.col("first.key2") == F.col("key2"))).otherwise(True).alias("leads"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    id_col: str = "doc_id", text_col: str = "text",
                    counted: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row, and ``n_links`` if ``counted``."""
    return _labelled(docs, id_col, text_col, words, percent, counted).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        *(["n_links"] if counted else []))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id."""
    labelled = stored(_labelled(docs, id_col, text_col, words, percent), "op7-labelled")
    kept = labelled.filter("leads").groupBy("key", "key2").agg(
        F.count("*").alias("rows"), F.max("n").alias("n"))
    rows = numbered(docs)
    i, t = docs.columns.index(id_col), docs.columns.index(text_col)
    rows = rows.withColumn("key", F.xxhash64(f"c{i}", f"c{t}")).withColumn(
        "key2", F.xxhash64(F.lit(1), f"c{i}", f"c{t}"))
    stay = rows.join(kept.select("key", "key2"), ["key", "key2"], "left_semi")
    if not kept.filter("rows > 1 AND n > 0").isEmpty():     # rows that repeat: one of them
        twice = kept.filter("rows > 1 AND n > 0").select("key", "key2")
        stay = stay.join(twice, ["key", "key2"], "left_anti").unionByName(
            stay.join(twice, ["key", "key2"], "left_semi").dropDuplicates(["key", "key2"]))
    return stay.drop("key", "key2").toDF(*docs.columns)


def run(spark, sf_dir) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), counted=True)


SQL = None
