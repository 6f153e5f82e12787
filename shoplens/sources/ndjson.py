"""Strict NDJSON scans (S1) and the four-collection load.

A line is wrong only if it is not a JSON object; a field whose value has
another type than declared is not a syntax error. Lines are kept whole: a
collection row is its id and the document as canonical JSON text, so fields
nobody declared survive. ``typed`` gives a collection's documents with the
declared fields and, from the documents themselves, all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StringType, StructField, StructType

from shoplens.schemas import COLLECTION_FILES, COLLECTION_KEYS, DOCUMENT_SCHEMAS, schema

DOCUMENT = "document"


def as_schema(ddl_or_schema) -> StructType:
    return schema(ddl_or_schema) if isinstance(ddl_or_schema, str) else ddl_or_schema


def read_ndjson(spark: SparkSession, path: str, ddl_or_schema) -> DataFrame:
    """Typed rows of a file of JSON objects; fails on a malformed line. A
    declared field with a value of another type is NULL."""
    lines = spark.read.option("encoding", "UTF-8").text(path).where(F.length(F.trim("value")) > 0)
    checked = F.when(F.col("_ok"), F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("Invalid JSON: "), F.substring("value", 1, 200))))
    return (lines.withColumn("_ok", is_object(F.col("value")))
            .select(F.from_json(checked, as_schema(ddl_or_schema)).alias("_d")).select("_d.*"))


def is_object(text):
    """Whether a text is one JSON object."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, line (from 1) of every line, without a driver loop: the
    text source keeps blank lines, each input split is a contiguous run of one
    partition's row ids, so line = lines in earlier splits of the file (a
    running sum over one row per split) + position inside the split."""
    lines = (spark.read.option("encoding", "UTF-8").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("rid")))
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("first_rid"))
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", "block", "first_rid",
                            F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    return (lines.join(offsets, ["file", "block"])
            .select("value", "file", (F.col("before") + F.col("rid") - F.col("first_rid") + 1).alias("line")))


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines that are not a JSON object: file, line, text."""
    return (numbered_lines(spark, path).where((F.length(F.trim("value")) > 0) & ~is_object(F.col("value")))
            .select("file", "line", F.col("value").alias("text")))


def validate_ndjson(spark: SparkSession, path: str, sample: int = 3) -> None:
    """Fail before any write, naming the first malformed lines (file, line)."""
    bad = bad_lines(spark, path).orderBy("file", "line").limit(sample).collect()
    if bad:
        where = ", ".join(f"{r.file}:{r.line}" for r in bad)
        raise ValueError(f"Invalid JSON at {where}")


def read_documents(spark: SparkSession, path: str, key: str) -> DataFrame:
    """file, line, the id field (as text) and the whole document as canonical
    JSON text (fields sorted), of every line that is a JSON object."""
    rows = numbered_lines(spark, path).where(is_object(F.col("value")))
    doc = F.parse_json("value")
    return rows.select("file", "line", F.try_variant_get(doc, f"$.{key}", "string").alias(key),
                       F.to_json(doc).alias(DOCUMENT))


def read_collections(spark: SparkSession, input_dir: str, files: dict[str, str] = COLLECTION_FILES) -> dict[str, DataFrame]:
    """Name -> documents for the fixed collection/file map. A missing
    file is an error up front, on any file system Spark can read."""
    out = {}
    for name, fname in files.items():
        path = f"{input_dir.rstrip('/')}/{fname}"
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            raise FileNotFoundError(f"File not found: {path}")
        out[name] = read_documents(spark, path, COLLECTION_KEYS[name])
    return out


# ------------------------------------------------------------------- typing
def merged(declared: DataType, found: DataType) -> DataType:
    """``declared`` plus the fields that only ``found`` has, at any depth."""
    if isinstance(declared, StructType) and isinstance(found, StructType):
        have = {f.name: f for f in declared.fields}
        others = {f.name: f.dataType for f in found.fields}
        fields = [StructField(n, merged(f.dataType, others.get(n, f.dataType)), True) for n, f in have.items()]
        return StructType(fields + [StructField(n, _plain(t), True) for n, t in others.items() if n not in have])
    if isinstance(declared, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(merged(declared.elementType, found.elementType), True)
    return declared


def _plain(t: DataType) -> DataType:
    """A found type that JSON text can be read as: fields of several types
    and of none are kept as text."""
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _plain(f.dataType), True) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_plain(t.elementType), True)
    return StringType() if isinstance(t, NullType) or t.typeName() == "variant" else t


def typed(documents: DataFrame, declared, extra_fields: bool = True) -> DataFrame:
    """Documents as columns: the declared fields (a value of another type is
    NULL there) and, found by one aggregate over the documents, the others."""
    want = as_schema(declared)
    if extra_fields:
        text = documents.agg(F.schema_of_variant_agg(F.parse_json(DOCUMENT)).alias("s")).first().s
        if text and text.startswith("OBJECT"):
            want = merged(want, StructType.fromDDL("d " + text.replace("OBJECT<", "STRUCT<"))["d"].dataType)
    return documents.select(F.from_json(DOCUMENT, want).alias("_d")).select("_d.*")


def typed_collection(documents: DataFrame, name: str, extra_fields: bool = True) -> DataFrame:
    return typed(documents, DOCUMENT_SCHEMAS[name], extra_fields)
