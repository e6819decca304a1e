"""Operators 1, 4, 6 and 10: against their libraries, rules and held-out labels."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from hirelake.llm import pieces, pii, token_counts, toxicity

JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _docs(spark, name):
    if name == "odd":
        return brute.odd_documents(spark)
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    return docs.limit(0) if name == "empty" else docs


CASES = pytest.mark.parametrize("name", ["odd", "small", "empty"])


# --- 1: token counts --------------------------------------------------------------

@CASES
def test_token_counts(spark, tmp_dir, name):
    docs = _docs(spark, name)
    library = Tokenizer.from_file(JSON)
    got = token_counts.token_counts(docs, tmp_dir).collect()
    want = [(r.doc_id, len((r.text or "").encode()),
             len(library.encode(r.text or "", add_special_tokens=False))) for r in docs.collect()]
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == sorted(
        (i or -1, b, n) for i, b, n in want)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_words_with_odd_spaces_count_as_the_library_does():
    r = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "a", "don't", "'s", "12", "é", "\xa0", " ", "\x1c", "日本",
             "...", "<|endoftext|>", "word", "\x85"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    library = Tokenizer.from_file(JSON)
    assert token_counts.Counter(JSON).count(texts) == [
        len(library.encode(t, add_special_tokens=False)) for t in texts]


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(file):
    path = public_tokenizers.path(file)
    texts = ["Hello <s> World", "", "a  b", "größer <|endoftext|>"]
    if file.endswith(".json"):
        library = Tokenizer.from_file(path)
        want = [len(library.encode(t, add_special_tokens=False)) for t in texts]
    else:
        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    assert token_counts.Counter(path).count(texts) == want


def test_cache_is_joined_and_only_misses_are_appended(spark, tmp_dir):
    docs = _docs(spark, "odd")
    first = docs.filter("doc_id < 20")
    token_counts.update_cache(first, tmp_dir, JSON)
    files = f"{tmp_dir}/tokenizer={token_counts.tokenizer_version(JSON)}"
    n = spark.read.parquet(files).count()
    assert n == len({r.text or "" for r in first.collect()})
    # what is cached is used, not counted again
    marked = spark.createDataFrame(
        [(hashlib.sha256(b"one").hexdigest(), 777)], token_counts.CACHE)
    marked.write.mode("append").parquet(files)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, tmp_dir).collect()}
    assert got[8] == 777
    assert spark.read.parquet(files).count() == len({r.text or "" for r in docs.collect()}) + 1


def test_run_with_few_prefixes_reads_them_alone_and_an_empty_run_nothing(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id long, text string")
    token_counts.update_cache(docs, tmp_dir, JSON)
    few = docs.where("doc_id IN (3, 5)")
    counts = token_counts.update_cache(few, tmp_dir, JSON)
    assert {r.content_digest for r in counts.collect()} == {
        hashlib.sha256(f"text {i}".encode()).hexdigest() for i in (3, 5)}
    assert token_counts.token_counts(few, tmp_dir).count() == 2
    assert token_counts.update_cache(docs.limit(0), tmp_dir, JSON).count() == 0
    files = f"{tmp_dir}/tokenizer={token_counts.tokenizer_version(JSON)}"
    assert spark.read.parquet(files).count() == 400


# --- 4: personal data -------------------------------------------------------------

RULES = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))


def _base(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in rule.finditer(text):
            digits = re.sub(r"[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
            if (k == 1 and any(int(p) > 255 for p in m.group().split("."))
                    or k == 2 and not (12 <= len(digits) <= 19 and luhn % 10 == 0)
                    or k == 3 and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_rules_equal_the_patterns():
    r = random.Random(5)
    parts = ["a", "b.c", "@", "@@", ".", "..", "-", "+", " ", "  ", "(", ")", "1", "12", "255", "300",
             "1.2.3.4", "4041894974608795", "+1 (988) 555-2485", "x@y.z", "é", "_%", "٣"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(text) == _base(text), text


def test_base_rules_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000,
                 "a@" * 100_000, "1 " * 150_000):
        pii.base_spans(text)


@CASES
def test_pii(spark, name):
    docs = _docs(spark, name)
    field = pii.train(pii.labelled_table(spark))
    got = pii.pii_spans(docs, field).collect()
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    assert len(got) == docs.count()
    want = sorted((i or -1, ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in _base(t or "")))
                  for i, t in {(r.doc_id, r.text) for r in docs.collect()})
    assert sorted({(r.doc_id or -1, r.base) for r in got}) == sorted(set(want))
    assert texts or not got
    for r in got:
        spans = set(filter(None, r.spans.split(",")))
        assert set(filter(None, r.base.split(","))) <= spans


def test_field_finds_what_the_rules_miss():
    class Table:   # stands for the labelled DataFrame
        def select(self, *_):
            return self

        def limit(self, _):
            return self

        def collect(self):
            return [{"text": t, "spans": s} for t, s in pii.labelled_examples()]

    field = pii.train(Table())
    fresh = pii.labelled_examples(seed=99, rounds=4)
    found = [pii._joined(s) for _, s in pii.find_spans(field, pa.array([t for t, _ in fresh]))]
    assert np.mean([a == b for a, (_, b) in zip(found, fresh)]) > 0.8
    plain = [t for t, s in fresh if not s]
    assert np.mean([not s for _, s in pii.find_spans(field, pa.array(plain))]) > 0.95
    ((base, spans),) = pii.find_spans(field, pa.array(["call me on (782) 555-0489 tonight."]))
    assert base == [] and spans == [(11, 3, 25)]


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    field = pii.Field(r.normal(size=(pii.N_FEATURES, 7)), r.normal(size=(7, 7)), r.normal(size=7))
    shapes = r.integers(0, pii.N_FEATURES, size=(9, 5))
    labels = pii.viterbi(field, shapes, np.array([0, 4, 5]))
    emit = field.weights[shapes].sum(axis=1)
    for a, b in ((0, 4), (4, 5), (5, 9)):
        best, _ = max((field.begin[p[0]] + emit[a, p[0]] + sum(
            field.moves[p[t - 1], p[t]] + emit[a + t, p[t]] for t in range(1, b - a)), p)
            for p in np.ndindex(*[7] * (b - a)))
        p = labels[a:b]
        assert best == pytest.approx(field.begin[p[0]] + emit[a, p[0]] + sum(
            field.moves[p[t - 1], p[t]] + emit[a + t, p[t]] for t in range(1, b - a)))


# --- 6: SentencePiece ---------------------------------------------------------------

def _random_texts(n):
    r = random.Random(6)
    parts = ["the", "ing", " ", "  ", "er", "日", "é", "a", "b", "\n", "tion", "-", "0", "12", "ß", "🎉",
             "▁", "Q", "un", "believ", "able", "    ", "\x00", "<s>"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_ids_and_texts_equal_the_library():
    model, library = pieces.Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = _random_texts(3000) + [" " * 37 + "x" + " " * 16, "x" * 400, "hello" * 80, "", " "]
    for text, ids in zip(texts, model.encode(texts)):
        want = library.encode(text)
        assert ids.tolist() == want, text
        assert model.decode(ids) == library.decode(want)


def test_unigram_segmentation_has_the_best_score():
    model = pieces.Pieces(MODEL, "unigram")
    names = dict(model.ids)
    for chunk in ("▁unbelievable", "▁the", "▁123é"):
        got = model._segment([chunk])[0]

        def best(text):
            if not text:
                return 0.0
            return max(best(text[l:]) + (model.score[names[text[:l]]] if text[:l] in names
                                         else model.score.min() - 10)
                       for l in range(1, len(text) + 1) if l == 1 or text[:l] in names)
        assert sum(model.score[i] if i >= 0 else model.score.min() - 10 for i in got) == (
            pytest.approx(best(chunk)))


@CASES
def test_encode_and_decode(spark, name):
    docs = _docs(spark, name)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coded = pieces.encode(docs)
    assert coded.columns == [*docs.columns, "token_ids"]
    back = pieces.decode(coded).collect()
    assert len(back) == docs.count()
    for r in back:
        assert r.token_ids == library.encode(r.text or "")
        assert r.decoded == (r.text or "")


def test_decode_of_any_ids(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = [[], [0xE9 + 3], [3 + 0xE6, 3 + 0x97, 3 + 0xA5], [264, 13, 259], [1, 2, 264]]
    rows = spark.createDataFrame([(x,) for x in [*ids, None]], "token_ids array<int>")
    got = [r.decoded for r in pieces.decode(rows).collect()]
    assert got[:-1] == [library.decode(x) for x in ids] and got[-1] == ""


# --- 10: toxicity ---------------------------------------------------------------------

def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.run(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == 1000
    right = [r.predicted == r.toxic for r in rows if r.held_out]
    assert len(right) > 30 and np.mean(right) > 0.93
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(clean) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_toxicity_learns_nothing_from_held_out_rows(spark):
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{brute.SMALL}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(
        toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_toxicity_odd_rows(spark):
    docs = brute.odd_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (None, 1), (3, None), (5, 7)], "doc_id long, toxic int")
    for table in (labels, labels.limit(0), labels.filter("doc_id = 2")):
        model = toxicity.fit(docs, table)
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        kept = toxicity.drop_toxic(docs, model)
        assert kept.columns == docs.columns
        assert kept.count() == sum(r.score < 0.5 for r in rows)
    assert toxicity.score(docs.limit(0), model).count() == 0
