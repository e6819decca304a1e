"""Keyword search that skips files (D13): a signature of character 3-grams per file.

``index_search`` gives each file of a stored ``jobs_detail`` day a bitmap of ``BITS``
bits, one for each 3-gram of its search texts (by CRC-32), written beside the files.
``search_detail`` takes from the keyword the 3-grams that every match must hold, opens
only files whose bitmaps have them all, and there applies the same regular expression as
``serve.keyword_search``: the rows are the same for any keyword. Where no 3-gram can be
told (short words, groups, escapes, letters beyond ASCII), or a day has no signatures,
all files are read. Files sorted by the facet columns differ in their words, so rare
words leave most of them closed.

A file's bitmap is ``BITS`` / 64 rows at most, built with map-side ``bit_or``; the search
reads only the rows of the words that the keyword's bits lie in.
"""

from __future__ import annotations

import json
import zlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirelake.operators.serve import keyword_search
from hirelake.session import file_system
from hirelake.sources import versions
from hirelake.sources.lake import gold_path

BITS = 1 << 15
FOLDER = "_grams"         # Spark's readers of the day pass over names with an underscore
_STOPS = "()\\"           # with these a pattern's literal parts are not told apart


def _bit(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BITS


def required_grams(keyword: str, literal: bool = False) -> list[set[str]] | None:
    """For each alternative of a pattern the 3-grams that each match holds; None if
    some alternative has none or the pattern is not plain enough to tell."""
    keyword = keyword.lower()
    runs: list[list[str]] = [[""]]
    if literal:
        runs = [[keyword]]
    else:
        if any(c in keyword for c in _STOPS):
            return None
        i = 0
        while i < len(keyword):
            c, now = keyword[i], runs[-1]
            if c == "|":
                runs.append([""])
            elif c in "*?{":                        # what stands before may be absent
                now[-1] = now[-1][:-1]
                now.append("")
                i = keyword.find("}", i) if c == "{" else i
            elif c == "[":
                now.append("")
                i = keyword.find("]", i + (3 if keyword[i + 1:i + 2] == "^" else 2))
            elif c in "+.^$":
                now.append("")
            else:
                now[-1] += c
            if i < 0:
                return None
            i += 1
    out = [{r[k:k + 3] for r in some for k in range(len(r) - 2) if r[k:k + 3].isascii()}
           for some in runs]
    return out if all(out) else None


def _grams(text: Column) -> Column:
    """The bits of a search text's 3-grams. The text is in lower case; letters that
    ignoring case equals to s and i are these."""
    text = F.translate(text, "ſı", "si")
    places = F.when(F.length(text) >= 3, F.sequence(F.lit(1), F.length(text) - 2))
    return F.array_distinct(F.transform(
        places, lambda i: (F.crc32(F.substring(text, i, F.lit(3))) % BITS).cast("int")))


def index_search(spark: SparkSession, gold_root: str, dt: str) -> None:
    """Write the signatures of a stored day's ``jobs_detail`` files."""
    root = gold_path(gold_root, "jobs_detail")
    entry = versions.current(spark, root, dt)
    for path in dict.fromkeys(entry.paths.values()) if entry else []:
        rows = spark.read.schema("job_search_text string").parquet(f"{root}/{path}").select(
            F.col("_metadata.file_name").alias("file"),
            F.explode(_grams(F.col("job_search_text"))).alias("bit"))
        rows.select("file", F.expr("bit div 64").cast("int").alias("word"), F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.col("bit") % 64).alias("one")).groupBy(
            "file", "word").agg(F.bit_or("one").alias("bits")).sortWithinPartitions("word").write.mode(
            "overwrite").parquet(f"{root}/{path}/{FOLDER}")


def _files(spark: SparkSession, path: str) -> list[str]:
    return [n for n in versions._names(spark, path) if n.endswith(".parquet")]


def _candidates(spark: SparkSession, path: str, wanted: list[set[str]]) -> set[str]:
    """Files under ``path`` whose signatures hold all bits of some alternative."""
    masks = [reduce(lambda m, b: m | {b // 64: m.get(b // 64, 0) | 1 << b % 64},
                    map(_bit, sorted(grams)), {}) for grams in wanted]
    words = sorted({w for m in masks for w in m})
    index = spark.read.schema("file string, word int, bits long").parquet(f"{path}/{FOLDER}").where(
        F.col("word").isin(words))

    def held(mask: dict[int, int]) -> Column:
        fits = [F.when((F.col("word") == w) & (F.col("bits").bitwiseAND(F.lit(_signed(m)))
                                               == F.lit(_signed(m))), 1).otherwise(0)
                for w, m in mask.items()]
        return F.sum(reduce(Column.__add__, fits)) == len(mask)

    some = index.groupBy("file").agg(*[held(m).alias(f"a{i}") for i, m in enumerate(masks)])
    return {r["file"] for r in some.where(" OR ".join(f"a{i}" for i in range(len(masks)))).collect()}


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def search_detail(spark: SparkSession, gold_root: str, dt: str, keyword: str,
                  literal: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """D13 over a stored day: its matching jobs, and how many of its ``files`` are
    ``read`` for them."""
    root = gold_path(gold_root, "jobs_detail")
    entry = versions.current(spark, root, dt)
    if entry is None:
        raise FileNotFoundError(f"no stored day {dt} under {root}")
    schema = StructType.fromJson(json.loads(entry.schema))
    wanted = required_grams(keyword, literal) if keyword else None
    files, opened = 0, []
    for path in dict.fromkeys(entry.paths.values()):
        names = _files(spark, f"{root}/{path}")
        files += len(names)
        fs, where = file_system(spark, f"{root}/{path}/{FOLDER}/_SUCCESS")
        if wanted is not None and fs.exists(where):
            found = _candidates(spark, f"{root}/{path}", wanted)
            names = [n for n in names if n in found]
        opened += [f"{root}/{path}/{n}" for n in names]
    rows = spark.read.schema(schema).parquet(*opened) if opened else spark.createDataFrame([], schema)
    return keyword_search(rows, keyword, literal), {"files": files, "read": len(opened)}
