"""Continuous ingestion with Structured Streaming.

Files land in a directory or grow there, each micro-batch is decoded, tokenised
and appended to the stage tables, and the vocabulary is merged in order of
arrival.  The ids seen so far are keyed state of the stream, on each executor's
disk and in the checkpoint, so a batch looks up its own ids and never reads the
history.
"""
from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from lanestride.dims import DEFAULT, Lexicon
from lanestride.operators import decompose as R, emit as E, monitor as M, objects as O, vocabulary as V
from lanestride.sources.readers import tail_records
from lanestride.sources.tail import tail_appended

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

VOCABULARY = "token_id BIGINT, token STRING, count BIGINT, batch_id BIGINT"
LEVEL_SCHEMA = "level_id BIGINT, difficulty STRING, song_id BIGINT, song_type STRING, source STRING, level_data STRING, ingest_order BIGINT"
TOTALS = ", ".join(f"{name} BIGINT" for name in M.TOTALS) + ", seconds DOUBLE, batch_id BIGINT"
STATS = ("level_id BIGINT, difficulty STRING, source STRING, accepted BOOLEAN, reason STRING, object_count_raw BIGINT, object_count_gameplay BIGINT, "
         "gameplay_source_object_count BIGINT, ignored_object_count BIGINT, unknown_object_count BIGINT, unknown_object_ratio DOUBLE, "
         "top_unknown_object_ids ARRAY<STRUCT<object_id: BIGINT, count: BIGINT>>, token_count BIGINT, unique_x_steps BIGINT, tokens ARRAY<STRING>, batch_id BIGINT")


@dataclass(frozen=True)
class Stage:
    """Stage tables under one root, partitioned by micro-batch."""
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str, schema: str, before: int | None = None) -> DataFrame:
        """The table so far; ``before`` hides a batch and everything after it."""
        jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        exists = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)
        rows = spark.read.schema(schema).parquet(self.path(name)) if exists else spark.createDataFrame([], schema)
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def append(self, rows: DataFrame, name: str, batch_id: int) -> None:
        """Write one batch's partition; a replayed batch replaces its own partition only."""
        (rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.path(name)))


    def keep_from(self, spark: SparkSession, name: str, batch_id: int) -> None:
        """Drop the partitions of batches before ``batch_id``."""
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for part in files.listStatus(root):
            number = part.getPath().getName().removeprefix("batch_id=")
            if number.isdigit() and int(number) < batch_id:
                files.delete(part.getPath(), True)


def new_levels(batch: DataFrame, processed: DataFrame) -> DataFrame:
    """Positive, unprocessed ids; the first record of an id within the batch wins.

    The history is read as one column of ids and cut to the batch's ids where it is
    read; it is never moved, sorted or made distinct as a whole.
    """
    positive = batch.where("level_id > 0")
    known = processed.select("level_id").join(F.broadcast(positive.select("level_id").distinct()), "level_id", "left_semi").distinct()
    fresh = positive.join(known, "level_id", "left_anti")
    return M.first_by_key(fresh, "level_id", F.struct("ingest_order", F.xxhash64("level_data")))


def first_of_each(levels: DataFrame) -> DataFrame:
    """A stream's rows with the first one of each positive id ever seen left; equal ids of one micro-batch by ``ingest_order``, then by content.

    A task reduces its share of the micro-batch to the first rows, which the
    stream's state of ids lets pass or not.  The state lives in RocksDB: a batch
    costs one lookup for each of its ids, and the checkpoint gets the new ones.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = list(batches)
        if not given:
            return
        rows = pa.Table.from_batches(given)
        order = rows.select(["level_id", "ingest_order", "_tie"]).append_column("_row", pa.array(range(rows.num_rows), pa.int64())).sort_by(
            [("level_id", "ascending"), ("ingest_order", "ascending"), ("_tie", "ascending")])
        ids = order.column("level_id").to_numpy()
        new = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
        yield from rows.take(order.column("_row").take(pa.array(new))).to_batches()

    rows = levels.where("level_id > 0").withColumn("_tie", F.xxhash64("level_data"))
    return rows.repartition("level_id").mapInArrow(first, rows.schema).drop("_tie").dropDuplicates(["level_id"])


def decoded_levels(levels: DataFrame) -> DataFrame:
    """One row per level: its decoded text or the reason why there is none."""
    return R.decode_payload(levels, "level_data").select("level_id", "difficulty", "source", "ingest_order", "decoded", "decode_reason")


def with_batch(rows: DataFrame) -> StructType:
    return StructType([*rows.schema.fields, StructField("batch_id", LongType())])


def process_batch(batch: DataFrame, batch_id: int, stage: Stage, lexicon: Lexicon = DEFAULT, limits: E.Limits = E.Limits(), fresh: bool = False) -> None:
    """One micro-batch, safe to replay: ids of this batch are hidden from the processed set.

    ``fresh`` tells that the batch holds new ids only, once each; otherwise they
    are looked up among those of the stats table.

    Each step is written once and read by the next ones: decoded levels
    (``parsed``), their gameplay objects, the stats with tokens.  What the stats
    write counts on its way makes the batch's row of ``totals``.  Of the vocabulary the
    versions of this batch and the one before are kept.
    """
    spark, begun = batch.sparkSession, time.monotonic()
    own = lambda name, schema: stage.read(spark, name, schema).where(F.col("batch_id") == batch_id).drop("batch_id")
    levels = decoded_levels(batch if fresh else new_levels(batch, stage.read(spark, "stats", STATS, before=batch_id)))
    stage.append(levels, "parsed", batch_id)
    parsed = own("parsed", with_batch(levels))
    good = parsed.where("decode_reason IS NULL")
    objects = R.explode_objects(good)
    gameplay = O.gameplay_objects(objects, lexicon)
    stage.append(gameplay, "gameplay", batch_id)
    play = own("gameplay", with_batch(gameplay))
    emitted = E.emit_tokens(play, good.select("level_id", "difficulty", "source"), lexicon, limits)
    failures = parsed.where("decode_reason IS NOT NULL").select("level_id", "difficulty", "source", F.col("decode_reason").alias("reason"))
    counted, seen = M.observed_totals(E.stats_records(objects, play, emitted, lexicon, limits, failures))
    stage.append(counted, "stats", batch_id)
    stage.append(M.totals_row(spark, seen).withColumn("seconds", F.lit(time.monotonic() - begun)), "totals", batch_id)
    accepted = own("stats", STATS).where("accepted").select("level_id", "difficulty", "source", "tokens")
    stage.append(accepted, "tokens", batch_id)
    arrived = accepted.join(parsed.select("level_id", "ingest_order"), "level_id")
    existing = stage.read(spark, "vocabulary", VOCABULARY, before=batch_id)
    last = existing.join(F.broadcast(existing.agg(F.max("batch_id").alias("batch_id"))), "batch_id").drop("batch_id")
    stage.append(V.merge_vocabulary(last, arrived, "ingest_order", lexicon), "vocabulary", batch_id)
    stage.keep_from(spark, "vocabulary", batch_id - 1)


def start_ingest(spark: SparkSession, source: str, stage: Stage, checkpoint: str, lexicon: Lexicon = DEFAULT,
                 limits: E.Limits = E.Limits(), files_per_trigger: int = 100, once: bool = True, appended: bool = False) -> StreamingQuery:
    """Run the ingestion; ``once`` drains what is there and stops.

    ``source`` is a folder in which whole files land, or with ``appended`` a file
    or folder of growing files.  The checkpoint is the record of what is
    processed; it belongs to the stage tables, and neither is of use without the other.
    """
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    schema = StructType(spark.createDataFrame([], LEVEL_SCHEMA).schema.fields)
    rows = tail_appended(spark, source, schema) if appended else tail_records(spark, source, schema, files_per_trigger)
    writer = (first_of_each(rows).writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, stage, lexicon, limits, fresh=True)))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()
