"""Operator 1: token counts with a digest cache.

``token_counts`` counts the tokens of whole texts as the tokenizer's own library
gives them (``tokenizers`` for .json, ``sentencepiece`` for .model; no begin, end
or added special tokens; special strings inside texts as is the library's
default; no truncation, no padding). Counts are kept in a cache table, keyed by
the SHA-256 of the normalised content and the version digest of the tokenizer
(SHA-256 of its file and its library's version). A run joins its texts' digests to
the cache, encodes the distinct texts that are not there, and appends them.

Normalisation may not change a count, so it is only this: null is the empty
text. Empty texts count 0 tokens. Repeated rows give repeated results; a null id
is passed through; an empty table gives an empty result; extra columns are
ignored. A cache to which two runs appended the same digest is read once a digest.

Plan: the run's distinct digests meet the cache, of which files without their prefixes
are skipped, and what is found is written, a row a digest. Texts move once, to become distinct; copies of one
text are folded before that shuffle. The work on the cache is a scan of two narrow columns,
never a rewrite. The result joins ids to counts by digest,
with a written table of one row a digest on the right, so AQE can split the digest
of a text that very many rows share. A failed run appends nothing (Spark's commit protocol).
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import reduce

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hirelake.llm.common import read, small_batches, stored
from hirelake.session import file_system, scratch_path

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
MEMO_WORDS = 400_000      # words a task remembers; then it starts anew
ENCODE_CHARS = 1 << 20    # characters given to the library at a time
PREFIX = 2                # leading hex digits of a run's digests by which cache files are skipped

CACHE = StructType([StructField("content_digest", StringType()),
                    StructField("n_tokens", LongType())])
_ODD = -1 << 50


class Counter:
    """Counts tokens of whole texts.

    A byte-level BPE that cuts text by its standard pattern treats a word led by
    one space independently of what stands before it, so counts of such words are
    remembered and added up. All other texts (a space beside other white space,
    an added token inside, any other tokenizer) go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.memo: dict[str, int] = {}
        self.heads: dict[str, int] = {}
        self.by_word, self.added = False, []
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self.encode = lambda texts: [
            len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not pre.get("add_prefix_space") and not spec.get("normalizer")
                        and not spec["model"].get("dropout"))

    def _sized(self, texts: list[str]) -> list[int]:
        counts, part, chars = [], [], 0
        for t in texts:
            part.append(t)
            chars += len(t)
            if chars >= ENCODE_CHARS or len(part) >= 20_000:
                counts += self.encode(part)
                part, chars = [], 0
        return counts + (self.encode(part) if part else [])

    def _learn(self, words: set[str], memo: dict[str, int], lead: str) -> None:
        new = [w for w in words if w not in memo]
        odd = [w for w in new if not w or w[0].isspace() or w[-1].isspace()]
        memo.update(dict.fromkeys(odd, _ODD))
        new = [w for w in new if w not in memo]
        memo.update(zip(new, self._sized([lead + w for w in new])))

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return self._sized(texts)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        if len(self.heads) > MEMO_WORDS:
            self.heads.clear()
        cut = [t.split(" ") if t and not any(a in t for a in self.added) else None
               for t in texts]
        self._learn({w[0] for w in cut if w}, self.heads, "")
        self._learn(set().union(*(w[1:] for w in cut if w)), self.memo, " ")
        get, counts, whole = self.memo.__getitem__, [], []
        for i, w in enumerate(cut):
            n = self.heads[w[0]] + sum(map(get, w[1:])) if w else _ODD
            counts.append(n)
            if n < 0:
                whole.append(i)
        for i, n in zip(whole, self._sized([texts[i] for i in whole])):
            counts[i] = n
        return counts


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer: its file and the version of its library."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + library.__version__.encode()).hexdigest()


def _count_batches(path: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            texts = batch.column(text_col)
            # a few texts at a time, by length: bounds the words held at once
            counts, i = [], 0
            while i < len(texts):
                part, chars = [], 0
                while i < len(texts) and (not part or chars < 4 * ENCODE_CHARS):
                    part.append(texts[i].as_py() or "")
                    chars += len(part[-1])
                    i += 1
                counts += count(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("content_digest"), pa.array(counts, pa.int64())],
                names=["content_digest", "n_tokens"])
    return run


def _digest(text):
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def update_cache(docs: DataFrame, cache: str, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Append the counts of texts that the cache lacks; return those of this run's texts,
    one row a digest.

    The cache's files are ranges of sorted digests, so those without one of this run's
    prefixes are skipped; only the rows of its digests are kept, and nothing of the cache
    is grouped or written again.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = f"{cache}/tokenizer={tokenizer_version(tokenizer)}"
    texts = docs.select(_digest(F.col(text_col)).alias("content_digest"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hits = _hits(texts.select("content_digest"), path)
    if hits is not None:
        texts = texts.join(hits, "content_digest", "left_anti")
    distinct = texts.groupBy("content_digest").agg(F.first("text").alias("text"))
    new = stored(distinct.mapInArrow(_count_batches(tokenizer, "text"), CACHE), "op1-counts")
    new.repartitionByRange("content_digest").sortWithinPartitions("content_digest").write.mode(
        "append").parquet(path)
    return new if hits is None else new.unionByName(hits)


def _hits(digests: DataFrame, path: str) -> DataFrame | None:
    """What the cache at ``path`` holds of these digests, one row each; None without a cache."""
    spark = digests.sparkSession
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return None
    wanted = stored(digests.distinct(), "op1-digests")
    prefixes = [r[0] for r in wanted.select(F.substring("content_digest", 1, PREFIX))
                .distinct().collect()]                          # 16 ** PREFIX at most
    held = spark.read.schema(CACHE).parquet(path)
    if len(prefixes) < 16 ** PREFIX:
        held = held.where(reduce(Column.__or__, [F.col("content_digest").startswith(x)
                                                 for x in prefixes], F.lit(False)))
    return stored(held.join(wanted, "content_digest", "left_semi").groupBy("content_digest").agg(
        F.max("n_tokens").alias("n_tokens")), "op1-hits")


def token_counts(docs: DataFrame, cache: str, tokenizer: str | None = None,
                 limit: int = TOKEN_LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``; ``cache`` is a folder that all
    executors share and that later runs may reuse."""
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    counts = update_cache(docs, cache, tokenizer, text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"),
                        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
                        .alias("n_bytes"), _digest(F.col(text_col)).alias("content_digest"))
    return keyed.join(counts, "content_digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def run(spark, sf_dir) -> DataFrame:
    """The query starts from an empty cache, so that each run does the whole work."""
    return token_counts(read(spark, sf_dir, "documents"), scratch_path(spark, "op1-cache"))


SQL = None
