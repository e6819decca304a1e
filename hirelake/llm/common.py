"""Small helpers shared by the operators: tables, word scans, hashes.

Word scans work on the UTF-8 buffers of an Arrow string column. White space is
``[\\x20\\x09-\\x0D]`` throughout; these bytes never occur inside a multi-byte
character, so scanning bytes is the same as scanning characters.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import hirelake
from hirelake.session import scratch_path

WS = r"[\x20\x09-\x0D]+"
ARROW_ROWS = 400          # rows of one Arrow batch of whole texts
SCAN_BYTES = 1 << 20      # bytes hashed at a time; cut between words

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INV = pow(_BASE, -1, 1 << 64)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package along to Python tasks, once a session, as --py-files would."""
    sc = spark.sparkContext
    if getattr(sc, "_hirelake_sent", None) is None:
        root = Path(hirelake.__file__).parent
        out = Path(tempfile.mkdtemp(prefix="hirelake-")) / "hirelake.zip"
        with zipfile.ZipFile(out, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(out))
        sc._hirelake_sent = str(out)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Before Python tasks over whole texts: bound the texts that one holds at a
    time, and send this package along."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    ship(spark)


def give_back() -> None:
    """Return freed memory to the system; numpy and Arrow keep it for later otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim is not None:
        trim(0)


def tidy(task: Callable) -> Callable:
    """A function for ``mapInArrow`` that begins and ends without freed memory held: a
    Python worker lives on after a task, idle or with another operator's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        try:
            yield from task(batches)
        finally:
            give_back()
    return run


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ..., so that no helper column clashes."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks that read the table, not
    the steps that made it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{WS}|{WS}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, WS))).cast("long")


# DuckDB has no CRC-32: its table of 256 values from the rule, and the sum of a text
CRC_TABLE = """crc AS (SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1
       THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS steps FROM range(256) r(i)),
"""


def crc_sql(text: str) -> str:
    """SQL of the unsigned CRC-32 of a text's UTF-8 bytes, where ``CRC_TABLE`` is joined."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::BIGINT)"
    step = "xor(c // 256, steps[xor(c % 256, b) + 1])"
    return f"xor(list_reduce({data}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


# --- numpy -----------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, ``n`` at least."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SCAN_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INV)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _powers[name] = np.cumprod(row, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def window_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order-sensitive 64-bit hash of ``values[start:end]`` for each pair."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix(((sums[ends] - sums[starts]) * down[starts])
               ^ (ends - starts).astype(np.uint64) * _ODD)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_IS_WS = np.zeros(256, dtype=bool)
_IS_WS[[0x20, *range(0x09, 0x0E)]] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null as empty) and its n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if len(off) else raw[:0], off - off[0]


def parts(column: pa.Array, size: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """``start, stop`` of runs of a string column's texts of about ``size`` bytes."""
    ends = utf8(column)[1]
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
        yield at, stop
        at = stop


class Words:
    """The words of a batch of texts: document, byte span and (if asked) 64-bit hash."""

    def __init__(self, column: pa.Array, lower: bool = False, hashed: bool = True,
                 gaps: np.ndarray = _IS_WS):
        self.data, self.offsets = utf8(column)
        data, n = self.data, len(self.data)
        solid = ~gaps[data]
        first = np.zeros(n + 1, dtype=bool)
        first[self.offsets] = True           # a text begins (or the last one ends)
        gap = np.ones(n + 1, dtype=bool)
        gap[1:] = ~solid
        begins = solid & (gap[:n] | first[:n])
        ends = np.zeros(n, dtype=bool)
        if n:
            ends[:-1] = solid[:-1] & (~solid[1:] | first[1:n])
            ends[-1] = solid[-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(self.offsets[1:], self.starts, side="right")
        self.bounds = np.searchsorted(self.doc, np.arange(len(self.offsets)))
        if hashed:
            self._hash(lower)

    def _hash(self, lower: bool) -> None:
        data = self.data
        self.hash = np.empty(len(self.starts), dtype=np.uint64)
        table = _LOWER if lower else _BYTE
        i = 0
        while i < len(self.starts):          # whole words, about SCAN_BYTES at a time
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + SCAN_BYTES)))
            base = self.starts[i]
            self.hash[i:j] = window_hash(table[data[base:self.ends[j - 1]]],
                                         self.starts[i:j] - base, self.ends[i:j] - base)
            i = j

    def shingles(self, k: int) -> Iterator[np.ndarray]:
        """For each document its distinct k-word shingles' hashes, ascending.

        With fewer words the whole sequence is one shingle; no word, none.
        """
        n = len(self.hash)
        heads = np.arange(max(0, n - k + 1))
        whole = window_hash(self.hash, heads, heads + k) if len(heads) else heads
        lo, hi = self.bounds[:-1], self.bounds[1:]
        for a, b in zip(lo, hi):
            if b - a >= k:
                yield np.unique(whole[a:b - k + 1])
            elif b > a:
                yield window_hash(self.hash[a:b], np.array([0]), np.array([b - a]))
            else:
                yield np.zeros(0, dtype=np.uint64)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost minimum of each ``width`` consecutive values."""
    best, low, span = np.arange(len(values)), values, 1
    while span < width:                  # minima of 2, 4, ... and at last width values
        shift = min(span, width - span)
        right = low[shift:] < low[:-shift]
        best = np.where(right, best[shift:], best[:-shift])
        low = np.where(right, low[shift:], low[:-shift])
        span += shift
    return best


class Bits:
    """A bitmap of hashes with a fixed size, built by Spark, sent to tasks.

    Collecting it costs 2**size / 64 rows at most, whatever it is built from; when
    many hashes are set it only lets more rows through.
    """

    def __init__(self, hashes: DataFrame, column: str, size: int = 23):
        self.size = size
        at = F.col(column).bitwiseAND(F.lit((1 << size) - 1))
        words = hashes.select(F.shiftright(at, 6).alias("word"), F.call_function(
            "shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
        rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.words = np.zeros(1 << (size - 6), dtype=np.uint64)
        self.words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64((1 << self.size) - 1)
        word = self.words[(at >> np.uint64(6)).astype(np.int64)]
        return (word >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
