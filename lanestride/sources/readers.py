"""Readers.  Every reader returns a DataFrame with an explicit schema."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lanestride.functions.columns import to_int
from lanestride.operators.decompose import decode_payload
from lanestride.sources.wave import read_wave_files  # noqa: F401  one place to look for readers

CORRUPT = "_corrupt_record"


def _parse(text: DataFrame, schema: StructType, keep_rejects: bool) -> DataFrame:
    """JSON objects in ``value``; anything else is a reject with its text under ``_corrupt_record``."""
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    bad = ~F.startswith(F.ltrim(F.col("value")), F.lit("{")) | F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    rows = text.where(F.trim("value") != "").withColumn("_r", parsed)
    if not keep_rejects:
        return rows.where(~bad).select(*[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields])
    return rows.select(*[F.when(~bad, F.col(f"_r.{f.name}")).alias(f.name) for f in schema.fields],
                       F.when(bad, F.col("value")).alias(CORRUPT))


def read_records(spark: SparkSession, path: str, schema: StructType, keep_rejects: bool = False) -> DataFrame:
    """JSON lines.  Blank lines are skipped; lines that are not objects of the schema are dropped,
    or kept as rows of NULLs with their text under ``_corrupt_record``."""
    return _parse(spark.read.text(path), schema, keep_rejects)


def parse_records(rows: DataFrame, column: str, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same rule for JSON text already in a column."""
    fields = StructType.fromDDL(schema)
    wide = StructType([*fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    good = F.startswith(F.ltrim(F.col(column)), F.lit("{")) & F.col("_r").isNotNull() & F.col(f"_r.{CORRUPT}").isNull()
    return (rows.withColumn("_r", parsed).where(good)
                .select(*keep, *[F.col(f"_r.{f.name}").alias(f.name) for f in fields]))


def read_ids_text(spark: SparkSession, path: str, name: str = "level_id") -> DataFrame:
    return spark.read.text(path).select(to_int("value", None).alias(name)).dropna().distinct()


def read_ids_json(spark: SparkSession, path: str, key: str) -> DataFrame:
    schema = StructType([StructField(key, StringType())])
    return read_records(spark, path, schema).select(to_int(key, None).alias(key)).dropna().distinct()


def tail_records(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """Streaming JSON lines.  The checkpoint is the offset; writers land whole files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def read_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A whole-file JSON document; a damaged one yields no row, so callers ``coalesce`` a default."""
    return _parse(spark.read.text(path, wholetext=True), schema, False)


def read_level_files(spark: SparkSession, path: str, pattern: str = "*.gmd") -> DataFrame:
    """``(source, raw)`` object strings of XML level files, or of the text itself without a ``k4`` value."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
             .select(F.element_at(F.split("path", "/"), -1).alias("source"),
                     F.col("content").cast("string").alias("_text")))
    body = F.regexp_extract("_text", r"<k>k4</k>\s*<s>([^<]*)</s>", 1)
    decoded = decode_payload(files.withColumn("_k4", F.regexp_replace(body, r"[\s=]+", "")), "_k4")
    level = F.when((F.col("_k4") != "") & F.col("decode_reason").isNull(), F.col("decoded")).otherwise(F.col("_text"))
    return decoded.withColumn("_level", level).select("source", F.posexplode(F.split("_level", ";")).alias("seq", "raw"))
