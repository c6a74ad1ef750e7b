"""Corpus statistics over token records (``tokens`` arrays) and stats rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lanestride.dims import DEFAULT, Lexicon
from lanestride.functions.columns import sql_text, unnest
from lanestride.operators.grammar import with_errors


def token_counts(sequences: DataFrame) -> DataFrame:
    return unnest(sequences, token=F.col("tokens")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def top_tokens(counts: DataFrame, k: int = 25, value: str = "token") -> DataFrame:
    """Largest counts first; ties by value."""
    return counts.orderBy(F.desc("count"), F.asc(value)).limit(k)


def rarest_tokens(counts: DataFrame, k: int = 25) -> DataFrame:
    return counts.orderBy(F.asc("count"), F.asc("token")).limit(k)


def entropy(counts: DataFrame, out: str = "entropy") -> DataFrame:
    """Bits per token from counts in one mergeable pass: log2(N) - sum(c log2 c) / N."""
    positive = counts.where(F.col("count") > 0)
    total = F.sum("count")
    value = F.log2(total) - F.sum(F.col("count") * F.log2(F.col("count"))) / total
    return positive.agg(F.coalesce(F.round(F.abs(value), 6), F.lit(0.0)).alias(out))


def class_frequency(counts: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    classes = F.broadcast(lexicon.classes(counts.sparkSession))
    return counts.join(classes, "token").select("token_class", "token", "count")


def step_share(tokens: str, lexicon: Lexicon = DEFAULT) -> Column:
    return F.expr(f"size(filter({tokens}, t -> t = {sql_text(lexicon.step)}))") / F.size(tokens)


def length_stats(sequences: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Count, average and maximum length, and the mean over records of the step share."""
    filled = sequences.where(F.size("tokens") > 0)
    return filled.agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.round(F.avg(F.size("tokens")), 6), F.lit(0.0)).alias("avg_token_length"),
        F.coalesce(F.max(F.size("tokens")), F.lit(0)).cast("bigint").alias("max_token_length"),
        F.coalesce(F.round(F.avg(step_share("tokens", lexicon)), 6), F.lit(0.0)).alias("avg_step_density"))


def difficulty_counts(records: DataFrame) -> DataFrame:
    return records.groupBy(F.coalesce("difficulty", F.lit("NA")).alias("difficulty")).agg(F.count(F.lit(1)).alias("count"))


def rejection_counts(stats: DataFrame) -> DataFrame:
    reason = F.coalesce(F.nullif(F.col("reason"), F.lit("")), F.lit("unknown"))
    return stats.where(~F.coalesce("accepted", F.lit(False))).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("count"))


def unknown_rate(stats: DataFrame) -> DataFrame:
    raw, unknown = F.coalesce(F.sum("object_count_raw"), F.lit(0)), F.coalesce(F.sum("unknown_object_count"), F.lit(0))
    return stats.agg(raw.alias("total_raw_objects"), unknown.alias("total_unknown_objects"),
                     F.round(unknown / F.greatest(raw, F.lit(1)), 6).alias("unknown_object_rate"))


def unknown_ids_merged(stats: DataFrame, k: int = 25) -> DataFrame:
    """Sum of the per-level top lists: a lower bound of the exact counts."""
    merged = (stats.select(F.explode("top_unknown_object_ids").alias("u"))
                   .groupBy("u.object_id").agg(F.sum("u.count").alias("count")))
    return top_tokens(merged, k, "object_id")


def unknown_ids_exact(classified: DataFrame, k: int = 25) -> DataFrame:
    counts = (classified.where("object_class = 'unknown'").groupBy("object_id").agg(F.count(F.lit(1)).alias("count")))
    return top_tokens(counts, k, "object_id")


def source_diversity(records: DataFrame, approximate: bool = False) -> DataFrame:
    filled = F.nullif(F.col("source"), F.lit(""))
    n = F.approx_count_distinct(filled) if approximate else F.count_distinct(filled)
    return records.agg(n.alias("source_diversity"))


def grammar_validity(sequences: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    good = (F.size("errors") == 0).cast("double")
    return with_errors(sequences.where(F.size("tokens") > 0).select("tokens"), lexicon).agg(
        F.coalesce(F.round(F.avg(good), 6), F.lit(0.0)).alias("grammar_validity"))


def vocab_total(vocabulary: DataFrame) -> DataFrame:
    """Sum of the counts of a vocabulary; ids are not needed, so :func:`token_counts` serves as well."""
    return vocabulary.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("token_total"))


def dataset_report(sequences: DataFrame, stats: DataFrame, lexicon: Lexicon = DEFAULT, k: int = 25) -> DataFrame:
    """One row that joins all corpus statistics; every part is already a single row."""
    counts = token_counts(sequences)
    pack = lambda df, key, out: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "count")))).alias(out))
    ranked = lambda df, key, out: df.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("c"), key))),
                                                     lambda e: F.struct(e[key].alias(key), (-e["c"]).alias("count"))).alias(out))
    rising = lambda df, out: df.agg(F.array_sort(F.collect_list(F.struct("count", "token"))).alias(out))
    classes = class_frequency(counts, lexicon)
    parts = [
        length_stats(sequences, lexicon),
        stats.agg(F.count(F.lit(1)).alias("levels_processed"),
                  F.count_if(~F.col("accepted")).alias("levels_rejected")),
        unknown_rate(stats), entropy(counts, "token_entropy"),
        counts.agg(F.count(F.lit(1)).alias("vocab_observed"),
                   F.coalesce(F.max(F.when(F.col("token") == lexicon.unknown, F.col("count"))), F.lit(0)).alias("unknown_token_count")),
        pack(difficulty_counts(sequences.where(F.size("tokens") > 0)), "difficulty", "difficulty_counts"),
        pack(rejection_counts(stats), "reason", "rejection_reasons"),
        ranked(top_tokens(counts, k), "token", "top_tokens"), rising(rarest_tokens(counts, k), "rarest_tokens"),
        ranked(unknown_ids_merged(stats, k), "object_id", "top_unknown_object_ids"),
        *[ranked(top_tokens(classes.where(F.col("token_class") == name), k), "token", out)
          for name, out in (("mechanic", "object_frequency"), ("portal", "portal_frequency"), ("orb", "orb_frequency"))],
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.crossJoin(F.broadcast(part))
    return report
