import json
import os

import pytest
from pyspark.sql import functions as F

from hirelake.operators import bronze
from hirelake.schemas import NESTED_RECORD, envelope
from hirelake.sources import lake

ENV = envelope(NESTED_RECORD)


def _env_rows(spark, rows):
    return spark.createDataFrame(rows, ENV)


def test_gates_pass_and_counts(spark):
    df = _env_rows(spark, [("b1", "adzuna", "2026-05-20T00:00:00", 1, [{"id": "1", "title": "x"}])])
    row = bronze.check_bronze(df)
    assert row["rows"] == 1 and row["null_records"] == 0


def test_empty_gate(spark):
    with pytest.raises(bronze.BronzeCheckError, match="Bronze data ingestion failed"):
        bronze.check_bronze(_env_rows(spark, []))


def test_missing_column_gate(spark):
    df = spark.createDataFrame([("adzuna",)], "source string").withColumn(
        "records", F.array(F.lit("x")))
    with pytest.raises(bronze.BronzeCheckError, match="Bronze schema validation failed"):
        bronze.check_bronze(df)


def test_null_records_gate(spark):
    df = _env_rows(spark, [("b1", "adzuna", "t", 0, None)])
    with pytest.raises(bronze.BronzeCheckError, match="Bronze records corrupted"):
        bronze.check_bronze(df)


def test_missing_key_in_raw_json(spark, tmp_dir):
    path = os.path.join(tmp_dir, "source=adzuna", "dt=2026-05-20")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        json.dump({"records": [{"id": "1"}], "source": "adzuna", "ingested_at": "t"}, f)
    df = lake.read_bronze(spark, tmp_dir, "adzuna", "2026-05-20")
    with pytest.raises(bronze.BronzeCheckError, match="schema validation"):
        bronze.check_bronze(df, raw_path=path)
    # present but NULL everywhere is not missing
    with open(os.path.join(path, "a.json"), "w") as f:
        json.dump({"records": [{"id": "1"}], "source": "adzuna", "ingested_at": "t",
                   "batch_id": None}, f)
    df = lake.read_bronze(spark, tmp_dir, "adzuna", "2026-05-20")
    assert bronze.check_bronze(df, raw_path=path)["rows"] == 1


def test_multiline_reads_one_document_per_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "source=adzuna", "dt=2026-05-20")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        f.write(json.dumps({"batch_id": "1", "records": []}) + "\n")
        f.write(json.dumps({"batch_id": "2", "records": []}) + "\n")
    assert lake.read_bronze(spark, tmp_dir, "adzuna", "2026-05-20", multi_line=True).count() == 1
    assert lake.read_bronze(spark, tmp_dir, "adzuna", "2026-05-20", multi_line=False).count() == 2


def test_missing_path_raises(spark, tmp_dir):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        lake.read_bronze(spark, tmp_dir, "adzuna", "2026-05-20").count()


def test_explode_keeps_envelope_and_drops_null_and_empty(spark):
    df = _env_rows(spark, [
        ("b1", "adzuna", "t1", 2, [{"id": "1"}, {"id": "2"}]),
        ("b2", "adzuna", "t2", 0, []),
        ("b3", "adzuna", "t3", 0, None)])
    out = bronze.explode_records(df)
    assert out.columns == ["source", "batch_id", "ingested_at", "job"]
    assert sorted(r["job"]["id"] for r in out.collect()) == ["1", "2"]


def test_unknown_source(spark, tmp_dir):
    with pytest.raises(ValueError, match="Unknown source"):
        lake.read_bronze(spark, tmp_dir, "nope", "2026-05-20")


def test_missing_key_in_json_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "source=jooble", "dt=2026-05-20")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        for i in range(3):
            f.write(json.dumps({"records": [{"id": str(i)}], "source": "jooble",
                                "batch_id": str(i)}) + "\n")
    df = lake.read_bronze(spark, tmp_dir, "jooble", "2026-05-20", multi_line=False)
    with pytest.raises(bronze.BronzeCheckError, match="schema validation"):
        bronze.check_bronze(df, raw_path=path, multi_line=False)


def test_corrupt_document_fails_records_gate(spark, tmp_dir):
    path = os.path.join(tmp_dir, "source=adzuna", "dt=2026-05-20")
    os.makedirs(path)
    with open(os.path.join(path, "good.json"), "w") as f:
        json.dump({"records": [{"id": "1"}], "source": "adzuna", "batch_id": "1",
                   "ingested_at": "t"}, f)
    with open(os.path.join(path, "bad.json"), "w") as f:
        f.write('{"records": [{"id": "2"}, "source": ')
    df = lake.read_bronze(spark, tmp_dir, "adzuna", "2026-05-20")
    with pytest.raises(bronze.BronzeCheckError, match="Bronze records corrupted"):
        bronze.check_bronze(df, raw_path=path)


def test_source_file_lineage(spark, tmp_dir):
    path = os.path.join(tmp_dir, "source=adzuna", "dt=2026-05-20")
    os.makedirs(path)
    with open(os.path.join(path, "batch_7.json"), "w") as f:
        json.dump({"records": [{"id": "1"}], "source": "adzuna", "batch_id": "7",
                   "ingested_at": "t"}, f)
    df = lake.read_bronze(spark, tmp_dir, "adzuna", "2026-05-20", with_file=True)
    assert df.first()["source_file"].endswith("batch_7.json")
