"""Next-token statistics: context windows, n-gram probabilities, loss."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import NumericType

from lanestride.dims import DEFAULT, STYLE_BONUS, Lexicon, relation, style_values
from lanestride.session import stage
from lanestride.functions.columns import sql_text, unnest
from lanestride.operators.spread import order_statistic

KEY = "level_id"


def context_windows(sequences: DataFrame, n: int, ids: str = "ids", pad: int | str = 0, key: str = KEY,
                    order: str | None = None, max_examples: int = 0) -> DataFrame:
    """``(key, pos, context, target)``: the n items before each position, left-padded.

    Windows are the row's own padded array beside itself, shifted by one place
    each, so that no expression is evaluated item by item.  ``max_examples`` keeps
    the first examples in (order, pos), 0 keeps all.
    """
    filler = f"array_repeat({sql_text(pad) if isinstance(pad, str) else pad}, {n})"
    shifted = [f"slice(concat({filler}, {ids}), {i}, size({ids}))" for i in range(1, n + 1)]
    made = f"arrays_zip({', '.join([*shifted, f'slice({ids}, 1, size({ids}))'])})"
    cols = [key] + ([order] if order and order != key else [])
    context = F.array(*[F.col(f"w.`{i}`") for i in range(n)]) if n else F.slice(F.array(F.col("w.`0`")), 1, 0)
    rows = unnest(sequences, *cols, w=F.expr(made)).select(*cols, "pos", context.alias("context"), F.col(f"w.`{n}`").alias("target"))
    if max_examples > 0:
        rows = rows.orderBy(order or key, "pos").limit(max_examples)
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def recent_records(records: DataFrame, n: int, arrival: str, tie: str = KEY) -> DataFrame:
    """The last n records by arrival."""
    return records.orderBy(F.desc(arrival), F.desc(tie)).limit(max(n, 1))


def train_eval_split(records: DataFrame, fraction: float = 0.8, seed: int = 7, key: str = KEY,
                     score: Column | None = None) -> DataFrame:
    """Add ``split``: whole records in hash order, the first ``int(fraction * n)`` (at least one) train.

    The cut is the exact k-th hash, found from counts; nothing is sorted.  Records
    of the cut's own hash are taken in the order of their keys, so that train has
    exactly as many records however many share a hash; only records that share
    hash and key with the last one taken are numbered in a window.  A
    single record is both sides in the source; here it stays ``train`` and
    callers evaluate on train when no eval row exists.
    """
    ranked = records.withColumn("_h", score if score is not None else F.xxhash64(F.lit(seed), F.col(key)))
    ranked = ranked.withColumn("_k", F.col(key) if isinstance(records.schema[key].dataType, NumericType) else F.xxhash64(key))
    rank = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(fraction)).cast("bigint")) - 1
    cut = order_statistic(ranked, [], "_h", rank, "_cut", place="_place").select("_cut", "_place")
    tied = ranked.select("_h", "_k").crossJoin(F.broadcast(cut)).where("_h = _cut")
    last = order_statistic(tied, ["_cut", "_place"], "_k", F.col("_place"), "_last", place="_again").select("_cut", "_last", "_again")
    rows = ranked.crossJoin(F.broadcast(last))
    same = F.coalesce((F.col("_h") == F.col("_cut")) & (F.col("_k") == F.col("_last")), F.lit(False))
    side = lambda train: F.when(train, "train").otherwise("eval")
    before = (F.col("_h") < F.col("_cut")) | ((F.col("_h") == F.col("_cut")) & (F.col("_k") < F.col("_last")))
    nth = F.row_number().over(W.orderBy(key)) - 1
    out = rows.where(~same).withColumn("split", side(before)).unionByName(
        rows.where(same).withColumn("split", side(nth <= F.col("_again"))))
    return out.drop("_h", "_k", "_cut", "_last", "_again")


def _suffixes(n: int) -> str:
    """SQL: one struct per context length, longest first."""
    return "array(" + ", ".join(
        f"struct({k} AS order, slice(context, {n - k + 1}, {k}) AS context)" if k else
        "struct(0 AS order, slice(context, 1, 0) AS context)" for k in range(n, -1, -1)) + ")"


def ngram_counts(windows: DataFrame, n: int) -> DataFrame:
    """``(order, context, target, count, context_total)`` for every context length 0..n.

    Full-length examples are counted first, so shorter contexts expand the
    combined counts and not the corpus.  After counting, a context holds at most
    one row per vocabulary item, which bounds every later group.
    """
    full = windows.groupBy("context", "target").agg(F.count(F.lit(1)).alias("count"))
    counts = (full.select(F.explode(F.expr(_suffixes(n))).alias("c"), "target", "count")
                  .groupBy("c.order", "c.context", "target").agg(F.sum("count").alias("count")))
    totals = counts.groupBy("order", "context").agg(F.sum("count").alias("context_total"))
    return counts.join(totals, ["order", "context"]).select("order", "context", "target", "count", "context_total")


def ngram_probabilities(counts: DataFrame, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """Add-alpha conditional probability of each seen (context, target)."""
    return counts.withColumn("probability", (F.col("count") + alpha) / (F.col("context_total") + alpha * vocab_size))


def sequence_loss(counts: DataFrame, windows: DataFrame, n: int, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """Mean -ln(max(p, 1e-12)) and perplexity of evaluation windows.

    A context that was never seen backs off to its longest seen suffix, one
    token at a time: only the cases that an order does not know go on to the
    next, merged by what is left of their context.  Equal examples are merged
    first.  The empty context is one row, its counts are met by target.  The
    counts and the cases of each order are staged, as they are read more than once.
    """
    counts = stage(counts.select("order", "context", "target", "count", "context_total"))
    left = windows.groupBy("context", "target").agg(F.count(F.lit(1)).alias("_w"))
    told = []
    for k in range(n, 0, -1):
        own = counts.where(F.col("order") == k)
        totals = own.groupBy("context").agg(F.max("context_total").alias("_total"))
        met = stage(left.join(totals, "context", "left"))
        told.append(met.where("_total IS NOT NULL").join(own.select("context", "target", "count"), ["context", "target"], "left")
                    .select("_w", "count", "_total"))
        left = (met.where("_total IS NULL").groupBy(F.expr(f"slice(context, 2, {k - 1})").alias("context"), "target")
                .agg(F.sum("_w").alias("_w")))
    bare = counts.where("order = 0")
    total = bare.agg(F.max("context_total").alias("_total"))
    told.append(left.join(bare.select("target", "count"), "target", "left").crossJoin(F.broadcast(total)).where("_total IS NOT NULL")
                .select("_w", "count", "_total"))
    p = (F.coalesce("count", F.lit(0)) + alpha) / (F.col("_total") + alpha * vocab_size)
    every = told[0]
    for more in told[1:]:
        every = every.unionByName(more)
    loss = F.sum(F.col("_w") * -F.log(F.greatest(p, F.lit(1e-12)))) / F.greatest(F.sum("_w"), F.lit(1))
    return every.agg(F.coalesce(F.sum("_w"), F.lit(0)).alias("examples"),
                     F.coalesce(loss, F.lit(0.0)).alias("loss")).withColumn("perplexity", F.exp("loss"))


def reweight(probabilities: DataFrame, temperature: float = 1.0, top_k: int = 0, group: tuple[str, ...] = ("order", "context"),
             multiplier: DataFrame | None = None) -> DataFrame:
    """p^(1/T), optional per-target multiplier, k largest per context, renormalised to ``weight``."""
    weight = F.pow(F.greatest(F.col("probability"), F.lit(1e-12)), F.lit(1.0 / max(temperature, 1e-6)))
    rows = probabilities.withColumn("_w", weight)
    if multiplier is not None:
        rows = rows.join(multiplier, "target", "left").withColumn(
            "_w", F.greatest(F.col("_w") * F.coalesce("multiplier", F.lit(1.0)), F.lit(1e-12))).drop("multiplier")
    if top_k > 0:
        best = W.partitionBy(*group).orderBy(F.desc("_w"), F.asc("target"))
        rows = rows.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= top_k).drop("_r")
        return rows.withColumn("weight", F.col("_w") / F.sum("_w").over(W.partitionBy(*group))).drop("_w")
    totals = rows.groupBy(*group).agg(F.sum("_w").alias("_t"))
    return rows.join(totals, list(group)).withColumn("weight", F.col("_w") / F.col("_t")).drop("_w", "_t")


def style_weights(counts: DataFrame, styles: list[str], lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Per mechanic: 1 + min(5, floor(sqrt(count))) + the bonuses of the given styles."""
    spark = counts.sparkSession
    bonus = (relation(spark, style_values(STYLE_BONUS, "BIGINT"), "style, token, bonus")
             .where(F.col("style").isin([s.lower() for s in styles] or [""]))
             .groupBy("token").agg(F.sum("bonus").alias("bonus")))
    small = counts.join(F.broadcast(lexicon.mechanics_table(spark).select("token")), "token", "left_semi")
    return (lexicon.mechanics_table(spark).join(F.broadcast(small), "token", "left").join(F.broadcast(bonus), "token", "left")
            .select("token", (F.lit(1) + F.least(F.lit(5), F.floor(F.sqrt(F.coalesce("count", F.lit(0)))))
                              + F.coalesce("bonus", F.lit(0))).cast("bigint").alias("weight")))


def training_log(loss: DataFrame, step: int, records: int, mode: str, train_loss: Column | None = None) -> DataFrame:
    """One log row per run, ready to append."""
    return loss.select(F.lit(mode).alias("mode"), F.lit(step).cast("bigint").alias("step"),
                       F.lit(records).cast("bigint").alias("records"), "examples",
                       (train_loss if train_loss is not None else F.lit(None).cast("double")).alias("train_loss"),
                       F.round("loss", 6).alias("eval_loss"))
