"""Bronze values that do not fit (S1): nothing vanishes uncounted.

Bronze is read with a fixed schema. A value of another type becomes NULL and a document
that is no JSON becomes a row of NULLs; in both cases the reader keeps the document's
text in ``CORRUPT`` and the values that do fit stay. ``quarantined`` opens these
documents, and only these, as variants and gives a row for each value that is lost: its
file, batch, record, path, reason and text. Record and column types come from the
source's schema, so a new field is checked without code.

Defined cases: JSON null and absent values fit; text takes any value (as JSON text); a
number given as text does not fit a number; a document without ``records`` fits (the
gates look at that); a value inside an object that does not fit is part of that object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from hirelake.session import stored

CORRUPT = "_corrupt_document"
BROKEN = "not a JSON document"
COLUMNS = ["source", "source_file", "batch_id", "record", "path", "reason", "value"]


def _checks(schema: StructType, prefix: str = "$") -> list[tuple[str, DataType]]:
    """Paths below ``prefix`` whose values may not fit, with the type they should have."""
    out: list[tuple[str, DataType]] = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}"
        if isinstance(f.dataType, StringType):
            continue
        out.append((path, f.dataType))
        if isinstance(f.dataType, StructType):
            out += _checks(f.dataType, path)
    return out


def _wrong(document: str, path: str, kind: DataType) -> Column:
    """A struct (path, reason, value) where the value at ``path`` does not fit, else NULL."""
    value = f"try_variant_get({document}, '{path}', 'variant')"
    found = F.split(F.expr(f"schema_of_variant({value})"), r"[(<]")[0]
    wanted, fits = ("OBJECT", ["OBJECT"]) if isinstance(kind, StructType) else (
        ("ARRAY", ["ARRAY"]) if isinstance(kind, ArrayType) else
        (kind.simpleString().upper(), ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"]))
    bad = F.expr(f"{value} IS NOT NULL") & ~found.isin(*fits, "VOID")
    return F.when(bad, F.struct(
        F.lit(path.removeprefix("$.")).alias("path"),
        F.concat(F.lit(f"expected {wanted}, found "), found).alias("reason"),
        F.expr(f"CAST({value} AS STRING)").alias("value")))


def corrupt_documents(bronze: DataFrame) -> DataFrame:
    """The documents of a frame read ``with_corrupt`` that lost something, written: all
    columns take part, as the reader notices only what it is asked to parse."""
    return stored(bronze.where(F.col(CORRUPT).isNotNull()), "corrupt-documents")


def quarantined(corrupt: DataFrame, source: str, record: StructType) -> DataFrame:
    """A row (``COLUMNS``) for each value lost in ``corrupt_documents``."""
    docs = corrupt.select(
        F.lit(source).alias("source"), "source_file", "batch_id", F.col(CORRUPT).alias("text"),
        F.try_parse_json(F.col(CORRUPT)).alias("document"))
    broken = docs.where("document IS NULL").select(
        "source", "source_file", "batch_id", F.lit(None).cast("int").alias("record"),
        F.lit(None).cast("string").alias("path"), F.lit(BROKEN).alias("reason"),
        F.col("text").alias("value"))
    known = docs.where("document IS NOT NULL").select(
        "source", "source_file", F.coalesce("batch_id", F.expr(
            "try_variant_get(document, '$.batch_id', 'string')")).alias("batch_id"), "document")
    outer = [(f"$.{f.name}", f.dataType) for f in corrupt.schema.fields
             if not isinstance(f.dataType, StringType) and f.name in ("record_count", "records")]
    rows = known.select("source", "source_file", "batch_id", F.lit(None).cast("int").alias("record"),
                        F.explode(F.array(*[_wrong("document", p, t) for p, t in outer])).alias("w"))
    each = known.select("source", "source_file", "batch_id", F.posexplode(F.expr(
        "try_variant_get(document, '$.records', 'array<variant>')")).alias("record", "one"))
    odd = F.when(~F.expr("schema_of_variant(one)").startswith("OBJECT")
                 & (F.expr("schema_of_variant(one)") != "VOID"), F.struct(
        F.lit("").alias("path"), F.concat(F.lit("expected OBJECT, found "), F.split(
            F.expr("schema_of_variant(one)"), r"[(<]")[0]).alias("reason"),
        F.expr("CAST(one AS STRING)").alias("value")))
    inner = each.select("source", "source_file", "batch_id", "record", F.explode(F.array(
        odd, *[_wrong("one", p, t) for p, t in _checks(record)])).alias("w"))
    lost = rows.unionByName(inner).where("w IS NOT NULL").select(
        "source", "source_file", "batch_id", "record", "w.*")
    return broken.unionByName(lost).select(*COLUMNS)


def merged_schema(corrupt: DataFrame) -> DataFrame:
    """One row, ``schema``: what the documents that do not fit look like, merged."""
    return corrupt.agg(F.expr(
        f"schema_of_variant_agg(try_parse_json({CORRUPT}))").alias("schema"))
