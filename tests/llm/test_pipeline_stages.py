"""The corpus pipeline against a brute-force version of its stages."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece

import brute
import corpus_pipeline
from hirelake.llm import toxicity


def _brute(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < 0.5}
    rows = [r for r in docs.orderBy("doc_id").collect() if r.doc_id in clean]
    texts = brute.line_cut([(r.doc_id, r.text) for r in rows])
    rows = [(r.doc_id, t, r.source) for r, t in zip(rows, texts)]
    labels = brute.near([(i, t) for i, t, _ in rows], 5, 80)
    rows = [r for r, (n, c) in zip(rows, labels) if n == 0 or c == r[0]]
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    out = Counter()
    for s, target in brute.targets(dict(sizes)).items():
        own = sorted((r for r in rows if r[2] == s and brute.words(r[1])),
                     key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0]))
        left = int(target + 0.5)
        while left:
            for i, t, _ in own:
                w = brute.words(t)
                if left:
                    out[i, t if left >= len(w) else " ".join(w[:left])] += 1
                    left -= min(left, len(w))
    return out


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, brute.SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in got) == _brute(spark, brute.SMALL)
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in got:
        assert r.round_trip and r.n_chars == len(r.text)
        assert r.token_ids == library.encode(r.text) and r.n_tokens == len(r.token_ids)


def test_stages_handle_odd_and_empty_tables(spark):
    odd = brute.odd_documents(spark).selectExpr(
        "doc_id", "text", "cast(null as string) lang", "source", "cast(null as long) n_chars",
        "key", "_key", "c0", "d")
    for docs in (odd, odd.limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, brute.SMALL)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns, name
        docs.collect()
