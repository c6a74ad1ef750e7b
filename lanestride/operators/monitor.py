"""Ingestion bookkeeping and pipeline monitoring."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window as W, functions as F

from lanestride.dims import DEFAULT, Lexicon
from lanestride.operators.analytics import step_share, token_counts, entropy, grammar_validity
from lanestride.operators.greedy import min_gap
from lanestride.operators.spread import ordered_index


def latest_by_key(rows: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The last row per key.  A mergeable max_by: hot keys combine map-side."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def first_by_key(rows: DataFrame, key: str | list[str], order: Column) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def unseen(candidates: DataFrame, downloaded: DataFrame, rejected: DataFrame | None, key: str = "level_id") -> DataFrame:
    """Drop ids already downloaded or rejected; pass ``rejected=None`` to retry rejected ones."""
    known = downloaded.select(key)
    if rejected is not None:
        known = known.union(rejected.select(key))
    return candidates.join(known.distinct(), key, "left_anti")


def pending_records(raw: DataFrame, processed_ids: DataFrame, stats: DataFrame, key: str = "level_id") -> DataFrame:
    """Raw records whose positive id is in neither the id list nor the stats table."""
    done = processed_ids.select(key).union(stats.select(key)).distinct()
    return raw.where(F.col(key) > 0).join(done, key, "left_anti")


def discover(candidates: DataFrame, downloaded: DataFrame, rejected: DataFrame | None, terms: Column | None = None,
             start: int = 0, block: int = 1024) -> DataFrame:
    """Usable first-seen candidates with a running ``sequence`` from ``start``.

    ``candidates`` carries ``source_order, page, pos``.  Automatic levels and
    names outside the filter are dropped, known ids anti-joined, the first
    sighting per id kept, and survivors numbered by bucketed positions.
    """
    order = F.struct("source_order", "page", "pos")
    usable = candidates.where(~F.col("is_auto"))
    if terms is not None:
        usable = usable.where(terms)
    first = first_by_key(unseen(usable, downloaded, rejected), "level_id", order)
    bucket = F.struct("source_order", F.floor(F.col("page") / block).alias("block"))
    group = F.struct("_bucket.source_order", F.floor(F.col("_bucket.block") / 4096).alias("far"))
    return ordered_index(first, [], bucket, ["page", "pos"], "_i", group).withColumn(
        "sequence", (F.col("_i") + start).cast("bigint")).drop("_i")


def rejects(candidates: DataFrame, failures: DataFrame, key: str = "level_id", stage: str = "validation") -> DataFrame:
    """Reject rows (key, reason, detail) with the stage and the candidate's origin."""
    side = candidates.select(key, F.col("sequence").alias("candidate_sequence"), "source", F.col("page").alias("source_page"))
    return failures.select(key, "reason", "detail").join(side, key, "left").withColumn("stage", F.lit(stage))


def source_progress(pages: DataFrame) -> DataFrame:
    """Next page and whether an empty page ended the source; pages after the first empty one do not count."""
    stop = F.min(F.when(F.col("n_levels") == 0, F.col("page")))
    return pages.groupBy("source").agg(
        F.coalesce(stop, F.max("page") + 1).cast("bigint").alias("next_page"), stop.isNotNull().alias("done"))


def first_seen_songs(songs: DataFrame, order: Column) -> DataFrame:
    return first_by_key(songs, "song_id", order)


def target_cap(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First n saved rows in order; 0 keeps all."""
    return rows.orderBy(*order).limit(n) if n > 0 else rows


def limit_input(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    return target_cap(rows, n, order)


def queue_sizes(scraped: DataFrame, processed: DataFrame, tokenized: DataFrame, trained: DataFrame) -> DataFrame:
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    row = count(scraped, "a").crossJoin(count(processed, "b")).crossJoin(count(tokenized, "c")).crossJoin(count(trained, "d"))
    diff = lambda x, y: F.greatest(F.col(x) - F.col(y), F.lit(0).cast("bigint"))
    return row.select(diff("a", "b").alias("raw_queue"), diff("c", "d").alias("token_queue"))


# The counters of a run.
COUNTERS = ("already_downloaded", "queued_from_checkpoint", "discovered", "saved", "rejected", "failed", "skipped",
            "duplicates_skipped", "auto_skipped", "songs_saved", "comments_saved")


def run_stats(log: DataFrame, outcomes: dict[str, str] | None = None) -> DataFrame:
    """One row on a run: a count for each of ``COUNTERS``, requests, mean response time and rates per minute.

    ``log`` has ``outcome``, ``seconds`` (null where no request was made) and
    ``ts``; ``outcomes`` says which counter an outcome adds to, and without it
    outcomes are named as the counters.  Outcomes outside all counters add to
    ``other``.  An empty log gives zeros.
    """
    named = outcomes or {c: c for c in COUNTERS}
    per = log.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count("seconds").alias("r"), F.sum("seconds").alias("s"),
                                     F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    zero = F.lit(0).cast("bigint")
    total = lambda names: F.coalesce(F.sum(F.when(F.col("outcome").isin(names), F.col("n"))), zero) if names else zero
    counts = {c: total([o for o, name in named.items() if name == c]) for c in COUNTERS}
    other = F.coalesce(F.sum(F.when(F.col("outcome").isNull() | ~F.col("outcome").isin(list(named)), F.col("n"))), zero)
    minutes = F.greatest(F.coalesce(F.max("hi") - F.min("lo"), F.lit(0.0)), F.lit(1e-9)) / 60.0
    requests = F.coalesce(F.sum("r"), zero)
    return per.agg(requests.alias("requests"), *[n.alias(c) for c, n in counts.items()], other.alias("other"),
                   F.round(F.coalesce(F.sum("s"), F.lit(0.0)) / F.greatest(requests, F.lit(1)), 6).alias("avg_response_time"),
                   F.round(requests / minutes, 6).alias("requests_per_minute"), F.round(counts["saved"] / minutes, 6).alias("levels_per_minute"))


def failures(**stages: DataFrame) -> DataFrame:
    """One table of what failed, by stage: level_id, source, reason, error, endpoint, status, response_text.

    A stage's frame has a ``level_id`` and those of the other columns that it knows.
    """
    columns = {"level_id": "bigint", "source": "string", "reason": "string", "error": "string", "endpoint": "string", "status": "int", "response_text": "string"}
    out = None
    for name, rows in stages.items():
        given = rows.select(F.lit(name).alias("stage"), *[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
        out = given if out is None else out.unionByName(given)
    return out


def recent_metrics(recent: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Entropy, grammar validity, step density and distinct sources of a window of token records."""
    counts = token_counts(recent)
    dens = recent.where(F.size("tokens") > 0).agg(F.coalesce(F.round(F.avg(step_share("tokens", lexicon)), 6), F.lit(0.0)).alias("avg_step_density"))
    return (entropy(counts, "token_entropy").crossJoin(grammar_validity(recent, lexicon)).crossJoin(dens))


TOTALS = ("levels_processed", "levels_tokenized", "tokens_tokenized", "object_count_raw", "unknown_object_count")


def observed_totals(stats: DataFrame, name: str = "totals") -> tuple[DataFrame, Observation]:
    """Stats rows that are counted while they are written: ``TOTALS`` are known after the write, without another pass."""
    seen, zero = Observation(name), F.lit(0).cast("bigint")
    total = lambda column: F.coalesce(F.sum(F.col(column).cast("bigint")), zero)
    return stats.observe(seen, F.count(F.lit(1)).alias("levels_processed"), F.count_if("accepted").alias("levels_tokenized"),
                         F.coalesce(F.sum(F.when(F.col("accepted"), F.col("token_count"))), zero).alias("tokens_tokenized"),
                         total("object_count_raw").alias("object_count_raw"), total("unknown_object_count").alias("unknown_object_count")), seen


def totals_row(spark: SparkSession, seen: Observation) -> DataFrame:
    """What was counted during the write, as a row; waits for the write."""
    found = seen.get
    return spark.range(1).select(*[F.lit(int(found[name])).cast("bigint").alias(name) for name in TOTALS])


def level_mix(levels: DataFrame) -> DataFrame:
    """One row: how many levels have each difficulty, and the number of named sources.  Two small aggregates over one grouping."""
    label = F.coalesce(F.col("difficulty").cast("string"), F.lit("NA"))
    pairs = levels.groupBy(label.alias("difficulty"), "source").agg(F.count(F.lit(1)).alias("n"))
    by = pairs.groupBy("difficulty").agg(F.sum("n").alias("n"))
    mix = by.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("difficulty", "n")))).alias("difficulty_distribution"))
    return mix.crossJoin(pairs.agg(F.count_distinct(F.nullif(F.col("source"), F.lit(""))).alias("source_diversity")))


def pipeline_metrics(queues: DataFrame, recent: DataFrame, recent_unknown: DataFrame, vocabulary: DataFrame, levels: DataFrame, totals: DataFrame,
                     runs: DataFrame, training: DataFrame, evaluation: DataFrame, seconds: Column, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """One monitoring row.  Each part is a one-row aggregate, so the cross joins move one row each.

    ``totals`` are those of ``observed_totals``, ``runs`` a row of ``run_stats``,
    ``training`` the log (step, train_loss, eval_loss, examples) and
    ``evaluation`` (step, diversity, collapsed, grammar_valid), of which the last rows
    count; ``seconds`` is the time that the totals took.  What a log lacks is
    null, but the queue is then 0, the steps 0, the quality 0 and the collapse false.
    """
    c, zero = F.col, F.lit(0).cast("bigint")
    last = lambda log, name: log.agg(F.max_by(F.struct(*log.columns), F.struct("step", F.to_json(F.struct(*log.columns)))).alias(name))
    row = (queues.crossJoin(recent_metrics(recent, lexicon)).crossJoin(recent_unknown.select("unknown_object_rate"))
           .crossJoin(vocabulary.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("tokens_generated")))
           .crossJoin(level_mix(levels)).crossJoin(totals).crossJoin(runs.select("levels_per_minute", c("failed").alias("request_failures"), "duplicates_skipped"))
           .crossJoin(last(training, "_t")).crossJoin(last(evaluation, "_e")))
    speed = F.round(c("tokens_tokenized") / F.greatest(seconds, F.lit(1e-9)), 6)
    return row.select(
        *queues.columns, "token_entropy", "grammar_validity", "avg_step_density", "unknown_object_rate", "tokens_generated", "levels_processed", "levels_tokenized",
        c("levels_tokenized").alias("dataset_size"), speed.alias("tokens_per_second"), "source_diversity", "difficulty_distribution",
        "levels_per_minute", "request_failures", "duplicates_skipped",
        c("_t.train_loss").alias("training_loss"), c("_t.eval_loss").alias("eval_loss"), F.coalesce(F.round(F.lit(1.0) / (F.lit(1.0) + c("_t.eval_loss")), 6), F.lit(0.0)).alias("validation_quality"),
        F.coalesce(c("_t.examples").cast("bigint"), zero).alias("training_queue"), F.coalesce(c("_t.step").cast("bigint"), zero).alias("steps"),
        c("_e.diversity").alias("generation_diversity"), F.coalesce("_e.collapsed", F.lit(False)).alias("collapse_indicator"), c("_e.grammar_valid").alias("grammar_legal"))


# The alert rules, their thresholds, what they report and what they advise.
RAW_BACKLOG, TOKEN_STARVATION, UNKNOWN_RATE, MIN_ENTROPY, MIN_RECORDS = 100, 3, 0.05, 2.0, 5
RULES = [
    ("TOKENIZER_BACKLOG", [("raw_queue", ">=", RAW_BACKLOG)], ["raw_queue"], "increase tokenizer allocation"),
    ("DATASET_STARVATION", [("raw_queue", ">", 0), ("token_queue", "<=", TOKEN_STARVATION)], ["raw_queue", "token_queue"],
     "increase tokenizer allocation and scraper throughput"),
    ("UNKNOWN_OBJECTS_INCREASE", [("unknown_object_rate", ">=", UNKNOWN_RATE)], ["unknown_object_rate"], "trigger mapping review warning"),
    ("DATASET_DIVERSITY_LOW", [("levels_tokenized", ">=", MIN_RECORDS), ("token_entropy", "<", MIN_ENTROPY)], ["token_entropy"],
     "increase scrape diversity and emphasize underrepresented difficulties"),
    ("TOKEN_COLLAPSE_WARNING", [("collapse_indicator", ">", 0)], [], "pause aggressive training and increase dataset diversity"),
]
RULE_SCHEMA = "code string, conditions array<struct<metric:string,op:string,bound:double>>, details array<string>, recommendation string"


def rule_table(spark: SparkSession) -> DataFrame:
    """The standard rules as rows; a table of the same columns with other rows replaces them."""
    condition = lambda m, op, v: F.struct(F.lit(m).alias("metric"), F.lit(op).alias("op"), F.lit(float(v)).alias("bound"))
    rows = F.array(*[F.struct(F.lit(code).alias("code"), F.array(*[condition(*x) for x in conditions]).alias("conditions"),
                              F.array(*map(F.lit, details)).cast("array<string>").alias("details"), F.lit(advice).alias("recommendation")) for code, conditions, details, advice in RULES])
    return spark.range(1).select(F.inline(rows))


def policy_alerts(metrics: DataFrame, rules: DataFrame | None = None, mode: str = "assisted") -> DataFrame:
    """One row per fired rule of each metric row, with the metric row's columns.

    A rule fires when all of its conditions hold; a condition on a missing or
    null metric does not.  Adds ``code``, ``recommendation``, ``details`` (the rule's
    metrics and their values), ``mode`` and ``action_applied`` (true unless ``assisted``).
    The rules are joined as data on the metric of their first condition.
    """
    numeric = [n for n, t in metrics.dtypes if t in ("int", "bigint", "double", "float", "boolean", "smallint", "tinyint") or t.startswith("decimal")]
    values = F.create_map(*[x for n in numeric for x in (F.lit(n), F.col(n).cast("double"))])
    rules = rule_table(metrics.sparkSession) if rules is None else rules.select("code", "conditions", "details", "recommendation")
    led = rules.where(F.size("conditions") > 0).withColumn("_lead", F.expr("conditions[0].metric"))
    rows = metrics.withColumn("_values", values).withColumn("_lead", F.explode(F.array(*map(F.lit, numeric))))
    holds = ("forall(conditions, x -> coalesce(CASE x.op WHEN '>=' THEN _values[x.metric] >= x.bound WHEN '>' THEN _values[x.metric] > x.bound"
             " WHEN '<=' THEN _values[x.metric] <= x.bound WHEN '<' THEN _values[x.metric] < x.bound WHEN '=' THEN _values[x.metric] = x.bound END, false))")
    fired = rows.join(led, "_lead").where(F.expr(holds))
    told = F.expr("map_from_entries(transform(filter(array_distinct(details), d -> _values[d] IS NOT NULL), d -> struct(d, _values[d])))")
    return fired.select(*metrics.columns, "code", "recommendation", told.alias("details"), F.lit(mode).alias("mode"), F.lit(mode != "assisted").alias("action_applied"))


def alert_cooldown(alerts: DataFrame, seconds: float = 300.0, code: str = "code", ts: str = "ts") -> DataFrame:
    """Alerts at least ``seconds`` after the last emitted alert of their code."""
    return min_gap(alerts, [code], ts, seconds)


def plateau(log: DataFrame, key: str, order: str, train_eps: float = 1e-6, eval_eps: float = 1e-4, patience: int = 3,
            block: int = 4096) -> DataFrame:
    """Run length of steps where training improves while evaluation stagnates; ``alert`` at ``patience``.

    ``order`` is a dense index per key.  Neighbours are read in chunks; the
    run length is the distance to the last reset, carried over chunk totals.
    """
    from lanestride.operators.spread import halo
    w = W.partitionBy(key, "_chunk").orderBy(order)
    lagged = (halo(log, order, 1, 0, block)
              .withColumn("_t", F.lag("train_loss").over(w)).withColumn("_e", F.lag("eval_loss").over(w))
              .where("_own")
              .withColumn("_hit", F.coalesce((F.col("train_loss") < F.col("_t") - train_eps) & (F.col("eval_loss") >= F.col("_e") - eval_eps), F.lit(False)))
              .withColumn("_reset", F.when(~F.col("_hit"), F.col(order))))
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    chunks = lagged.groupBy(key, "_chunk").agg(F.max("_reset").alias("_last"), F.min(order).alias("_lo"))
    before = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = chunks.select(key, "_chunk", F.max("_last").over(before).alias("_carry"))
    run = F.col(order) - F.coalesce(F.max("_reset").over(upto), F.col("_carry"))
    return (lagged.join(carried, [key, "_chunk"])
            .select(key, order, "train_loss", "eval_loss", run.cast("bigint").alias("plateau_count"))
            .withColumn("alert", F.col("plateau_count") >= patience))


def is_recent(ts: Column, now: Column, seconds: int) -> Column:
    """Age of an epoch-seconds value is within the limit; a bad value is not recent."""
    return F.coalesce(now - ts.try_cast("double") <= seconds, F.lit(False))


def last_n(log: DataFrame, n: int, order: str) -> DataFrame:
    """The newest rows; of equally new ones those with the greater remaining columns (as JSON text)."""
    return log.orderBy(F.desc(order), F.desc(F.to_json(F.struct(*log.columns)))).limit(max(n, 1))


def latest_record(log: DataFrame, order: str) -> DataFrame:
    """The newest row, by one mergeable aggregate; ties as in ``last_n``."""
    return log.agg(F.max_by(F.struct(*log.columns), F.struct(F.col(order), F.to_json(F.struct(*log.columns)))).alias("_r")).where("_r IS NOT NULL").select("_r.*")


TELEMETRY_METRICS = {
    "tokens_per_second": 0.0, "training_queue": 0, "levels_scraped": 0, "tokens_generated": 0, "token_entropy": 0.0, "grammar_validity": 0.0,
}


def telemetry(metrics: DataFrame, training: DataFrame, evaluation: DataFrame, events: DataFrame | None = None, sample: DataFrame | None = None,
              now: Column | None = None, stale_seconds: int = 180, steps_per_epoch: int = 10_000, dataset_rows: int = 0, vocab_size: int = 0) -> DataFrame:
    """Latest metrics, training, evaluation, event and sample in one row, always, with the fallbacks for what is missing or zero.

    A metrics column that the log does not carry counts as missing.  ``active``
    tells whether the last heartbeat is at most ``stale_seconds`` before ``now``.
    """
    c = F.col

    def newest(log: DataFrame | None, order: str, name: str) -> DataFrame:
        if log is None:
            log = metrics.sparkSession.createDataFrame([], f"{order} bigint")
        return log.agg(F.max_by(F.struct(*log.columns), F.struct(c(order), F.to_json(F.struct(*log.columns)))).alias(name))

    row = newest(metrics, "ts", "m")
    for log, order, name in ((training, "step", "tr"), (evaluation, "step", "ev"), (events, "ts", "e"), (sample, "ts", "s")):
        row = row.crossJoin(newest(log, order, name))
    given = {"m": metrics, "tr": training, "ev": evaluation, "e": events, "s": sample}

    def first(*places: str, default: float | int | str) -> Column:
        """The first of the fields that is there and not zero."""
        found = [F.nullif(c(p), F.lit(0)) for p in places if given[p.split(".")[0]] is not None and p.split(".")[1] in given[p.split(".")[0]].columns]
        return F.coalesce(*found, F.lit(default))

    steps, size = first("tr.step", "m.steps", default=0), first("m.dataset_size", default=dataset_rows)
    train = first("tr.train_loss", "m.training_loss", default=0.0)
    validation = first("tr.eval_loss", "m.validation_loss", default=0.0)
    raw, token = first("m.raw_queue", default=0), first("m.token_queue", default=0)
    total = F.greatest(size + raw + token, F.lit(1))
    event = F.lit("orchestrator_idle") if events is None else F.coalesce("e.event", F.lit("orchestrator_idle"))
    preview = F.lit("") if sample is None else F.coalesce(F.array_join(F.slice("s.tokens", 1, 24), " "), F.lit(""))
    return row.select(
        c("m.ts").alias("heartbeat"), steps.cast("bigint").alias("step"),
        F.greatest(F.lit(1), F.floor(steps / steps_per_epoch) + 1).cast("bigint").alias("epoch"),
        F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), size / total * 100.0)), 6).alias("progress_pct"),
        F.round(train, 6).alias("loss"), F.round(F.coalesce(F.nullif(validation, F.lit(0.0)), train), 6).alias("val_loss"),
        F.round(first("ev.diversity", "m.generation_diversity", default=0.0), 6).alias("generation_diversity"),
        raw.cast("bigint").alias("raw_queue"), token.cast("bigint").alias("token_queue"), size.cast("bigint").alias("dataset_size"),
        *[first(f"m.{k}", default=v).alias(k) for k, v in TELEMETRY_METRICS.items()],
        event.alias("event"), preview.alias("sample_preview"), F.lit(vocab_size).cast("bigint").alias("vocab_size"),
        (F.lit(False) if now is None else is_recent(c("m.ts"), now, stale_seconds)).alias("active"))
