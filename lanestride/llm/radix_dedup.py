"""Exact deduplication by distributed most-significant-digit radix partitioning."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.session import stage

FIRST_DIGIT = 64  # bytes compared in the first round
GROWTH = 16  # each later round compares so many times the bytes of the one before


def normalised(text):
    """Text with each run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def radix_groups(rows: DataFrame, key: str, content: str, first_digit: int = FIRST_DIGIT, growth: int = GROWTH, first: str | None = None) -> DataFrame:
    """Classes of two or more rows with equal content: ``key``, ``keep_id`` (smallest key of the class), ``group_size``.

    With ``first``, a column that orders the rows, ``keep_id`` is its smallest value in the class.

    A round splits each open group by its members' next digit, a slice of
    bytes.  A group of one leaves, a group whose digit is short has ended and
    is a class; only rows in open groups carry their remaining bytes on.  No
    digest decides equality.  Digits widen from round to round, so the number
    of rounds is logarithmic in the longest shared prefix, and each round is a
    partial aggregation and one join on (group, digit), which the engine
    splits where one group holds many rows.

    Null content counts as empty; empty contents form one class.  Rows with a
    null key are equal to any other row of their content and count in the
    class, whose ``keep_id`` is the smallest key that is not null.
    """
    width = first_digit
    light = rows.select(F.lit(0).cast("long").alias("_group"), F.col(key).cast("long").alias("_key"), (F.col(first) if first else F.col(key).cast("long")).alias("_first"),
                        F.coalesce(F.col(content).cast("binary"), F.lit(b"")).alias("_rest"))
    classes = None
    while True:
        digit = F.substring("_rest", 1, width)
        split = (light.groupBy(F.col("_group").alias("_g"), digit.alias("_d"))
                 .agg(F.min("_key").alias("_next"), F.min("_first").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"))
        joined = (light.withColumn("_digit", digit)
                  .join(split, (F.col("_group") == F.col("_g")) & (F.col("_digit") == F.col("_d")))
                  .select("_key", F.col("_next").alias("_group"), "_first", "keep_id", "group_size", (F.length("_digit") < width).alias("_ended"),
                          F.expr(f"substring(_rest, {width + 1})").alias("_rest")))
        staged = stage(joined)
        ended = staged.where("_ended").select(F.col("_key").alias(key), "keep_id", "group_size")
        classes = ended if classes is None else classes.unionByName(ended)
        light = staged.where("not _ended").select("_group", "_key", "_first", "_rest")
        if light.isEmpty():
            return classes
        width *= growth


def numbered(docs: DataFrame) -> DataFrame:
    """The rows, each with a number of its own (``__row``) that no later reading changes: staged."""
    return stage(docs.withColumn("__row", F.monotonically_increasing_id()))


def row_classes(rows: DataFrame) -> DataFrame:
    """(__row, keep_id, keep_row, group_size) of numbered rows with an equal: the class's first row by doc_id, null last, then by number."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), F.col("__row").alias("row"))
    found = radix_groups(rows.select("__row", order.alias("place"), "content"), "__row", "content", first="place")
    return found.select("__row", F.col("keep_id.id").alias("keep_id"), F.col("keep_id.row").alias("keep_row"), "group_size")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Every document with its class: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after white-space runs become one
    space.  Null and empty texts are equal to each other.  A document without
    an equal is a class of one.  Rows that repeat a doc_id with an equal text
    count each in ``group_size`` and give a result row each.  A row with a null
    doc_id belongs to the class of its text and is kept only if no row of the class has a doc_id.
    """
    content = normalised(F.col("text"))
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(content, 256).alias("text_sha256"), content.alias("content")))
    classes = row_classes(rows)
    kept = F.when(F.col("keep_row").isNull(), True).when(F.col("keep_id").isNull(), F.col("keep_row") == F.col("__row")).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return (rows.select("__row", "doc_id", "text_sha256").join(classes, "__row", "left")
            .select("doc_id", F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), "text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """Documents with one row left of each class; the columns of the input, whatever further ones it has."""
    rows = numbered(docs)
    dropped = row_classes(rows.select("__row", "doc_id", normalised(F.col("text")).alias("content"))).where("__row <> keep_row").select("__row")
    return rows.join(dropped, "__row", "left_anti").select(*docs.columns)


EXACT_SQL = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""
