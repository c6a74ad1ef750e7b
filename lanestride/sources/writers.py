"""Sinks."""
from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lanestride.session import stage
from lanestride.sources.stores import store_of


def write_records(rows: DataFrame, path: str, mode: str = "append", fmt: str = "json") -> None:
    """Append or replace a directory of records; Parquet suits stage tables."""
    rows.write.mode(mode).format(fmt).save(path)


def write_document(row: DataFrame, path: str, indent: int | None = None) -> None:
    """A one-row document as one JSON file with sorted keys, replaced in one step.

    The text goes to a file of its own beside the target, which then takes the
    target's name by an atomic rename of the file system; a reader sees the old
    document or the new one, and a failed write leaves the old one.  More than one row
    is an error, and so is none.
    """
    rows = row.select(F.to_json(F.struct(*row.columns), {"ignoreNullFields": "false"}).alias("text")).take(2)
    if len(rows) != 1:
        raise ValueError("a document is exactly one row")
    text = json.dumps(json.loads(rows[0].text), sort_keys=True, indent=indent, ensure_ascii=False)
    replace_file(row.sparkSession, path, text.encode())


def replace_file(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file whole and give it its name only then."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = target.getFileSystem(conf)
    part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    try:
        out = files.create(part, False)
        try:
            out.write(bytearray(content))
        finally:
            out.close()
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(part, target, overwrite)
    finally:
        files.delete(part, False)


def write_files(files: DataFrame, path: str) -> DataFrame:
    """A file for each row of (name, content), all in one folder; returns (name, bytes) and writes when it is computed.

    Rows are dealt to as many tasks as there are cores, whatever their size, as
    it is the number of files that takes the time.  A file is written beside its name
    and then moved there, so a repeated task replaces it.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = store_of(path)
        store.create_dir(folder, recursive=True)
        for batch in batches:
            contents = [(c.as_py() or "").encode() for c in batch.column(1)]
            for name, content in zip(batch.column(0).to_pylist(), contents, strict=True):
                part = f"{folder}/.{name}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(content)
                store.move(part, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(c) for c in contents], pa.int64())], ["name", "bytes"])

    rows = files.select(F.col("name").cast("string").alias("name"), F.col("content").cast("string").alias("content"))
    return rows.repartition(files.sparkSession.sparkContext.defaultParallelism, "name").mapInArrow(write, "name string, bytes bigint")


def write_routed(rows: DataFrame, routes: dict[str, tuple[Column, list[str]]], root: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Fan one frame out to a table per route (rows that meet its condition, its columns).

    The frame is staged once in the shared folder; every route reads that, so
    nothing upstream runs twice, whatever is lost on the way.
    """
    kept = stage(rows)
    for name, (condition, columns) in routes.items():
        write_records(kept.where(condition).select(*columns), f"{root}/{name}", mode, fmt)
