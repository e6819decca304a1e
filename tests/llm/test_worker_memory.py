"""What Python workers hold, during a task and after it."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from hirelake.llm import collocations, common, pieces


def test_a_task_gives_its_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    task = common.tidy(lambda batches: (b for b in batches))
    assert list(task(iter([1, 2]))) == [1, 2] and len(calls) == 2


def test_decoding_holds_no_pairs():
    model = pieces.Pieces(public_tokenizers.path(pieces.MODEL))
    ids = np.array([model.ids["▁the"], model.ids["▁a"]])
    assert model.decode(ids) == "the a" and model.pair_codes is None
    assert [x.tolist() for x in model.encode(["the a", ""])] == [ids.tolist(), []]


def test_encoding_holds_the_chunks_of_one_text():
    model = pieces.Pieces(public_tokenizers.path(pieces.MODEL))
    texts = [" ".join(f"word{i % 50}" for i in range(2000))] * 200
    model.encode(texts[:1])
    tracemalloc.start()
    got = model.encode(texts)
    ids = sum(x.nbytes for x in got)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < ids + 4e6             # the chunks of all texts are 30 MB more


def test_new_chunks_advance_in_small_groups():
    model = pieces.Pieces(public_tokenizers.path(pieces.MODEL))
    rng = np.random.default_rng(7)
    letters = rng.integers(97, 123, (40_000, 12), dtype=np.uint8)
    chunks = {pieces.SPACE + bytes(x).decode() for x in letters}
    model.encode(["warm up"])
    tracemalloc.start()
    model._learn(chunks)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(model.memo) > 39_000 and peak < held + 10e6
    assert pieces.MEMO_CHUNKS <= 200_000


def test_the_pipeline_tokenises_in_one_worker_a_task(spark):
    rows = [(1, "the cat  sat", "en"), (1, "the cat  sat", "en"), (2, None, None), (None, "", "de"),
            (3, "é 中 \u2581x", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.tokenise(spark, docs, "")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    both = pieces.encode_decode(docs.withColumn("decoded", docs.lang))
    apart = pieces.decode(pieces.encode(docs))
    assert both.schema == apart.schema
    assert sorted(both.collect(), key=repr) == sorted(apart.collect(), key=repr)
    assert sorted((r.doc_id is None, r.n_tokens, r.round_trip) for r in got.collect()) == sorted(
        (r.doc_id is None, len(r.token_ids), r.decoded == (r.text or "")) for r in apart.collect())


def test_counting_pairs_holds_few_rows():
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 50_000, 1000))) for _ in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * len(texts))], names=["text", "lang"])
    everything = common.Bits.__new__(common.Bits)
    everything.has = lambda hashes: np.ones(len(hashes), dtype=bool)
    count = collocations._counted(["h1", "h2"], collocations._pair_rows(everything))
    common.powers(1)
    tracemalloc.start()
    total = sum(sum(b.column("c").to_pylist()) for b in count(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 1200 * 999
    assert peak < 80e6
