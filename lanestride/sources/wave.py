"""PCM WAV files as samples, each file cut into byte ranges that are read by themselves."""
from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lanestride.sources.stores import store_of

SPLIT_BYTES = 32 << 20  # sample bytes that one task reads at a time, about
BLOCK_FRAMES = 65_536
RANGES = "path string, channels int, rate bigint, width int, start bigint, low bigint, high bigint"
SAMPLES = "track string, rate bigint, idx bigint, sample double"


@dataclass(frozen=True)
class WaveLayout:
    """Where a file's samples are: ``start`` is the byte of the first frame, ``frames`` their number."""
    channels: int
    rate: int
    width: int
    start: int
    frames: int


def wave_layout(handle: pa.NativeFile, length: int) -> WaveLayout | None:
    """Layout from the chunk headers alone, whatever lies between them; None when the file is unusable.

    64-bit sizes (RF64) are understood; a size beyond the end of the file is held to it.
    """
    head = handle.read(12)
    if len(head) < 12 or head[:4] not in (b"RIFF", b"RF64") or head[8:] != b"WAVE":
        return None
    at, form, wide = 12, None, None
    while at + 8 <= length:
        handle.seek(at)
        name, size = struct.unpack("<4sI", handle.read(8))
        if name == b"ds64":
            wide = struct.unpack("<Q", handle.read(16)[8:])[0]
        elif name == b"fmt " and size >= 16:
            _, channels, rate, _, _, bits = struct.unpack("<HHIIHH", handle.read(16))
            form = (channels, rate, bits // 8)
        elif name == b"data" and form is not None:
            channels, rate, width = form
            if wide is not None and size == 0xFFFFFFFF:
                size = wide
            if not (channels > 0 and rate > 0 and width in (1, 2, 4)):
                return None
            return WaveLayout(channels, rate, width, at + 8, min(size, length - at - 8) // (channels * width))
        at += 8 + size + (size & 1)
    return None


def frame_ranges(layout: WaveLayout, split: int = SPLIT_BYTES) -> list[tuple[int, int]]:
    """Frames [low, high) of about ``split`` bytes each, in order, none left out."""
    step = max(1, split // (layout.channels * layout.width))
    return [(low, min(layout.frames, low + step)) for low in range(0, layout.frames, step)]


def samples_of(data: bytes, channels: int, width: int) -> np.ndarray:
    """Mono samples in [-1, 1]: the mean over the channels of each frame."""
    raw = np.frombuffer(data, {1: "u1", 2: "<i2", 4: "<i4"}[width])
    values = (raw.astype("f8") - 128.0) / 128.0 if width == 1 else raw / float(1 << (8 * width - 1))
    return np.clip(values, -1.0, 1.0).reshape(-1, channels).mean(axis=1)


def _plan(split: int):
    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for path in batch.column(0).to_pylist():
                store, place = store_of(path)
                with store.open_input_file(place) as handle:
                    found = wave_layout(handle, handle.size())
                if found is not None:
                    rows += [(path, found.channels, found.rate, found.width, found.start, low, high) for low, high in frame_ranges(found, split)]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["path", "channels", "rate", "width", "start", "low", "high"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)
    return plan


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            store, place = store_of(r["path"])
            frame = r["channels"] * r["width"]
            with store.open_input_file(place) as handle:
                for low in range(r["low"], r["high"], BLOCK_FRAMES):
                    n = min(BLOCK_FRAMES, r["high"] - low)
                    handle.seek(r["start"] + low * frame)
                    values = samples_of(handle.read(n * frame), r["channels"], r["width"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["path"].rsplit("/", 1)[-1]] * n), pa.array(np.full(n, r["rate"], np.int64)), pa.array(np.arange(low, low + n)), pa.array(values)],
                        ["track", "rate", "idx", "sample"])


def read_wave_files(spark: SparkSession, path: str, pattern: str = "*.wav", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(track, rate, idx, sample)`` with samples in [-1, 1], mean over channels; files that are no PCM WAV give no rows.

    Files are listed without their content.  One job step reads each file's
    chunk headers and cuts its frames into ranges, the next one reads the
    ranges, dealt evenly, in bounded blocks: a file of any size is many tasks.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")
    ranges = files.mapInArrow(_plan(split_bytes), RANGES)
    return ranges.repartition("path", "low").mapInArrow(_read, SAMPLES)


def write_wave_files(samples: DataFrame, path: str, rate: int = 8000) -> DataFrame:
    """Mono 16-bit files ``<track>.wav`` in a folder, from (track, idx, sample); returns (track, frames).

    A track is one task's rows, so tracks must be of bounded length.  A file is
    written beside its name and then moved there, so a repeated task replaces it.
    """
    def write(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        data = np.clip(np.rint(table.column("sample").to_numpy() * 32768.0), -32768, 32767).astype("<i2").tobytes()
        head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(data), b"WAVE", b"fmt ", 16, 1, 1, rate, rate * 2, 2, 16, b"data", len(data))
        store, folder = store_of(path)
        store.create_dir(folder, recursive=True)
        part = f"{folder}/.{key[0].as_py()}.{table.num_rows}.part"
        with store.open_output_stream(part) as out:
            out.write(head + data)
        store.move(part, f"{folder}/{key[0].as_py()}.wav")
        return pa.table({"track": pa.array([key[0].as_py()], pa.string()), "frames": pa.array([table.num_rows], pa.int64())})

    rows = samples.select(F.col("track").cast("string").alias("track"), F.col("idx").cast("bigint").alias("idx"), F.col("sample").cast("double").alias("sample"))
    return rows.groupBy("track").applyInArrow(write, "track string, frames bigint")
