"""Token counts kept up to date by signed deltas, with idempotent batch commits."""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanestride.llm.packing import encoder_of, text_groups, tokenizer_file
from lanestride.llm.radix_dedup import normalised
from lanestride.session import stage, stage_path

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["docs", "tokens"]
VERSION = "byte_bpe_50k"
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"


def token_counts(rows: DataFrame, counted: dict[str, str], tokenizer: str | None = None) -> DataFrame:
    """``rows`` with each text column of ``counted`` replaced by its token count under the name given; null stays null."""
    path = tokenizer or tokenizer_file()
    others = [c for c in rows.columns if c not in counted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            counts = []
            for i in range(len(counted)):
                column = batch.column(len(others) + i)
                sizes = np.concatenate([np.zeros(0, np.int64), *[[len(b) // 4 for b in encoder.encode(texts)] for _, texts in text_groups(column)]]).astype(np.int64)
                counts.append(pa.array(sizes, pa.int64(), mask=column.is_null().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(others))], *counts], [*others, *counted.values()])

    fields = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*others).schema.fields], *[f"`{n}` long" for n in counted.values()]])
    return rows.select(*others, *counted).mapInArrow(run, fields)


def signed(events: DataFrame) -> DataFrame:
    """Signed delta rows of change events.

    An event has ``op`` (insert, delete, revise), the new image (source, lang,
    tokenizer, tokens) for inserts and revisions, and the old image (old_source, old_lang,
    old_tokenizer, old_tokens) for deletes and revisions.  A revision takes the
    old image back and adds the new one, so a document may change its source, its
    language or the tokenizer version.  Null tokens count as 0; any other ``op`` is an error.
    """
    sides = F.array(
        F.when(F.col("op").isin("insert", "revise"), F.struct(*[F.col(k).alias(k) for k in KEYS], F.lit(1).cast("long").alias("docs"),
                                                              F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))),
        F.when(F.col("op").isin("delete", "revise"), F.struct(*[F.col(f"old_{k}").alias(k) for k in KEYS], F.lit(-1).cast("long").alias("docs"),
                                                              (-F.coalesce("old_tokens", F.lit(0))).cast("long").alias("tokens"))))
    known = F.when(F.col("op").isin("insert", "delete", "revise"), sides).otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))))
    return events.select(F.explode(F.filter(known, lambda s: s.isNotNull())).alias("s")).select("s.*")


class TokenRollup:
    """Additive totals of documents and tokens by source, language and tokenizer version.

    ``path`` lies on storage that all executors share.  A batch's deltas are
    summed by key and written to a folder of their own, which counts once its
    ``_SUCCESS`` file is there.  To commit a batch again does nothing; what a failed
    attempt left is overwritten.  ``compact`` folds all committed batches into one folder and
    remembers their names, so that reading does not slow down with their number.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, name: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _has(self, name: str) -> bool:
        fs, at = self._folder(name)
        return fs.exists(at)

    def _names(self) -> list[str]:
        fs, at = self._folder("")
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def base(self) -> str | None:
        """The newest whole compaction."""
        return max((n for n in self._names() if n.startswith("base-") and self._has(f"{n}/_SUCCESS")), default=None)

    def folded(self) -> set[str]:
        base = self.base()
        return {r["batch"] for r in self.spark.read.parquet(f"{self.path}/names-{base}").collect()} if base else set()

    def batches(self) -> list[str]:
        """Committed batches that no compaction holds."""
        folded = self.folded()
        return [n[6:] for n in self._names() if n.startswith("batch-") and n[6:] not in folded and self._has(f"{n}/_SUCCESS")]

    def commit(self, batch: str, events: DataFrame) -> bool:
        """Add a batch of events; False if it was committed before."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch name has letters, digits, _ . - only: {batch!r}")
        if self._has(f"batch-{batch}/_SUCCESS") or batch in self.folded():
            return False
        delta = signed(events).groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        delta.write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens of all committed batches; keys whose documents are all gone are left out."""
        parts = [f"batch-{b}" for b in self.batches()] + ([self.base()] if self.base() else [])
        schema = DELTA
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in parts]) if parts else self.spark.createDataFrame([], schema)
        return rows.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES]).where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        names = sorted({*self.folded(), *self.batches()})
        if not self.batches():
            return
        last = self.base()
        new = f"base-{int(last[5:]) + 1 if last else 1:09d}"
        totals = self.totals()
        self.spark.createDataFrame([(n,) for n in names], "batch string").write.mode("overwrite").parquet(f"{self.path}/names-{new}")
        totals.write.mode("overwrite").parquet(f"{self.path}/{new}")


def corpus_history(docs: DataFrame, version: str = VERSION, tokenizer: str | None = None) -> dict[str, DataFrame]:
    """Three batches of events that a corpus goes through: load, revision, deduplication.

    ``load`` inserts every document.  ``respace`` revises those whose white
    space changes when each run of it becomes one space.  ``dedup`` deletes every document
    whose revised text equals that of a smaller doc_id.
    """
    tidy = normalised(F.col("text"))
    rows = docs.select("doc_id", "source", "lang", "text", F.when(F.coalesce("text", F.lit("")) != tidy, tidy).alias("tidy"), F.sha2(tidy, 256).alias("digest"))
    counts = token_counts(rows, {"text": "tokens", "tidy": "tidy_tokens"}, tokenizer)
    loaded = stage(counts.withColumn("tokenizer", F.lit(version)))
    old = [F.col(k).alias(f"old_{k}") for k in KEYS]
    none = [F.lit(None).cast("string").alias(f"old_{k}") for k in KEYS] + [F.lit(None).cast("long").alias("old_tokens")]
    first = loaded.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1").select("digest", "keep_id")
    return {
        "load": loaded.select(F.lit("insert").alias("op"), *KEYS, "tokens", *none),
        "respace": loaded.where("tidy_tokens is not null").select(F.lit("revise").alias("op"), *KEYS, F.col("tidy_tokens").alias("tokens"), *old, F.col("tokens").alias("old_tokens")),
        "dedup": loaded.join(first, "digest").where("doc_id > keep_id").select(F.lit("delete").alias("op"), *[F.lit(None).cast("string").alias(k) for k in KEYS], F.lit(None).cast("long").alias("tokens"),
                                                    *old, F.coalesce("tidy_tokens", "tokens").alias("old_tokens")),
    }


def corpus_totals(docs: DataFrame) -> DataFrame:
    """source, lang, tokenizer, docs, tokens after the corpus history, one batch of which is delivered twice."""
    rollup = TokenRollup(docs.sparkSession, stage_path(docs.sparkSession))
    history = corpus_history(docs)
    for batch in ("load", "respace", "respace", "dedup"):
        rollup.commit(batch, history[batch])
    return rollup.totals()
