"""Vocabularies with stable ids, and set operations on ids and tokens."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lanestride.dims import DEFAULT, Lexicon
from lanestride.functions.columns import unnest
from lanestride.operators.spread import attach, ordered_index
from lanestride.session import stage

FIRST_BLOCK = 64


def observed_tokens(sequences: DataFrame, order: str) -> DataFrame:
    """Count and first sight ``(order, pos)`` per token, combined map-side."""
    return (unnest(sequences, order, token=F.col("tokens"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("count"),
                                  F.min(F.struct(F.col(order).alias("_o"), "pos")).alias("first_seen")))


def number_new_tokens(fresh: DataFrame, start: Column, block: int = FIRST_BLOCK) -> DataFrame:
    """Ids by first sight, from ``start``: ranked inside blocks of records, offset by block totals."""
    placed = ordered_index(fresh, [], F.floor(F.col("first_seen._o") / block), ["first_seen"], "_i")
    return placed.select((F.col("_i") + start).cast("bigint").alias("token_id"), "token", "count")


def build_vocabulary(sequences: DataFrame, order: str, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """``(token_id, token, count)``: base tokens in their order, then others by first sight.

    The tokens seen are staged, as several branches read them.
    """
    spark = sequences.sparkSession
    seen = stage(observed_tokens(sequences, order))
    base = lexicon.vocabulary(spark)
    known = base.join(F.broadcast(seen.join(F.broadcast(base.select("token")), "token", "left_semi")
                                      .select("token", "count")), "token", "left").select(
        "token_id", "token", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
    fresh = seen.join(F.broadcast(base.select("token")), "token", "left_anti")
    return known.unionByName(number_new_tokens(fresh, F.lit(len(lexicon.base_vocabulary))))


def merge_vocabulary(existing: DataFrame, sequences: DataFrame, order: str, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Append-only merge: old ids stay, missing base tokens then new tokens are appended, counts add up.

    ``max(token_id)`` is a one-row aggregate joined in, not fetched to the driver.
    """
    spark = existing.sparkSession
    seen = stage(observed_tokens(sequences, order))
    top = existing.agg((F.coalesce(F.max("token_id"), F.lit(-1)) + 1).alias("_next"))
    gap = (lexicon.vocabulary(spark).withColumnRenamed("token_id", "_b")
           .join(existing.select("token"), "token", "left_anti"))
    gap = gap.select("token", (F.row_number().over(W.orderBy("_b")) - 1).alias("_i")).crossJoin(F.broadcast(top))
    base_added = gap.select((F.col("_next") + F.col("_i")).cast("bigint").alias("token_id"), "token",
                            F.lit(0).cast("bigint").alias("count"))
    fixed = existing.select("token_id", "token", "count").unionByName(base_added)
    grown = fixed.join(seen.select("token", F.col("count").alias("_add")), "token", "left").select(
        "token_id", "token", (F.col("count") + F.coalesce("_add", F.lit(0))).cast("bigint").alias("count"))
    fresh = seen.join(fixed.select("token"), "token", "left_anti")
    size = fixed.agg((F.coalesce(F.max("token_id"), F.lit(-1)) + 1).alias("_next"))
    appended = number_new_tokens(fresh, F.lit(0)).crossJoin(F.broadcast(size)).select(
        (F.col("token_id") + F.col("_next")).cast("bigint").alias("token_id"), "token", "count")
    return grown.unionByName(appended)


def merge_meta(meta: DataFrame, existing: DataFrame, sequences: DataFrame, unknown_added: DataFrame | None = None,
               lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Versions of the merged vocabulary: version moves only if a batch token was new."""
    spark = existing.sparkSession
    known = existing.select("token").unionByName(lexicon.vocabulary(spark).select("token"))
    fresh = (sequences.select(F.explode("tokens").alias("token")).distinct().join(known, "token", "left_anti")
             .agg((F.count(F.lit(1)) > 0).cast("bigint").alias("_new")))
    out = meta.crossJoin(F.broadcast(fresh))
    if unknown_added is not None:
        out = out.crossJoin(F.broadcast(unknown_added.agg(F.coalesce(F.sum("unknown_object_count"), F.lit(0)).alias("_u"))))
    else:
        out = out.withColumn("_u", F.lit(0).cast("bigint"))
    return out.select((F.col("vocab_version") + F.col("_new")).alias("vocab_version"),
                      (F.col("frequency_revision") + 1).alias("frequency_revision"),
                      (F.col("unknown_object_count") + F.col("_u")).alias("unknown_object_count"))


def token_ids(rows: DataFrame, vocabulary: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Vocabulary id per token row, the unknown id where there is none; hot tokens as in :func:`spread.attach`."""
    fallback = lexicon.base_vocabulary.index(lexicon.unknown)
    return attach(rows, vocabulary.select("token", "token_id"), "token", keep_unmatched=True).withColumn(
        "token_id", F.coalesce("token_id", F.lit(fallback)).cast("bigint"))


def encode(tokens: str, lexicon: Lexicon = DEFAULT) -> Column:
    """Token array to base-vocabulary ids inside the row; unknown tokens get the unknown id."""
    fallback = lexicon.base_vocabulary.index(lexicon.unknown) + 1
    return F.expr(f"transform({tokens}, t -> coalesce(nullif(array_position({lexicon.vocabulary_array_sql()}, t), 0L), {fallback}L) - 1)")


def id_union(*ids: DataFrame) -> DataFrame:
    out = ids[0]
    for other in ids[1:]:
        out = out.union(other)
    return out.distinct()


def unknown_token_report(counts: DataFrame, known: DataFrame) -> DataFrame:
    """Tokens outside the known set with their counts."""
    return counts.join(known.select("token"), "token", "left_anti")
