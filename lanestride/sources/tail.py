"""Growing files of lines as a stream: a Python data source whose offsets are byte positions."""
from __future__ import annotations

import fnmatch
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from lanestride.sources.readers import _parse
from lanestride.sources.stores import store_of

SPLIT_BYTES = 64 << 20  # one task reads about so much of a file
LOOK_BACK = 1 << 16
LINES = "file string, position bigint, value string"
_SCHEMA = pa.schema([("file", pa.string()), ("position", pa.int64()), ("value", pa.string())])


@dataclass
class LineRange(InputPartition):
    """Lines that begin in [low, high) of a file; ``start`` is where the batch begins there."""
    file: str
    start: int
    low: int
    high: int


def lines_end(store: pafs.FileSystem, file: str, size: int, look_back: int = LOOK_BACK) -> int:
    """The position after the last whole line of the first ``size`` bytes; 0 if there is none."""
    with store.open_input_file(file) as handle:
        high = size
        while high > 0:
            low = max(0, high - look_back)
            handle.seek(low)
            found = handle.read(high - low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            high = low
    return 0


def line_ranges(start: dict[str, int], end: dict[str, int], split: int = SPLIT_BYTES) -> list[LineRange]:
    """What lies between two offsets, cut into ranges of about ``split`` bytes.

    A file that ends before its old position was truncated and is read from its beginning.
    """
    out = []
    for file, high in sorted(end.items()):
        first = start.get(file, 0)
        first = 0 if first > high else first
        out += [LineRange(file, first, low, min(high, low + split)) for low in range(first, high, split)]
    return out


class TailReader(DataSourceStreamReader):
    """Offsets are the ends of the whole lines of each file; nothing is remembered outside the checkpoint."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.pattern = options.get("pattern", "*")
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, root = store_of(self.path)
        found = store.get_file_info(root)
        if found.type == pafs.FileType.NotFound:
            return {}
        files = [found] if found.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(root))
        whole = [f for f in files if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")) and (f is found or fnmatch.fnmatch(f.base_name, self.pattern))]
        return {f.path: lines_end(store, f.path, f.size) for f in whole}

    def partitions(self, start: dict, end: dict) -> Sequence[LineRange]:
        return line_ranges(start, end, self.split)

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.path)
        with store.open_input_file(partition.file) as handle:
            yield from read_lines(handle, partition)


def read_lines(handle: pa.NativeFile, part: LineRange, block: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The lines that begin in a range; the last one may go beyond it."""
    at = part.low
    skip = part.low > part.start  # the line that is under way belongs to the range before, unless it begins just here
    if skip:
        at -= 1
    handle.seek(at)
    rest, begin = b"", at
    while begin < part.high or skip:
        data = handle.read(block)
        if not data:
            break
        lines = (rest + data).split(b"\n")
        rest = lines.pop()
        if skip and lines:
            begin += len(lines.pop(0)) + 1
            skip = False
        rows = []
        for line in lines:
            if begin < part.high:
                rows.append((begin, line))
            begin += len(line) + 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([part.file] * len(rows)), pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1].decode("utf-8", "replace") for r in rows], pa.string())], schema=_SCHEMA)


class TailedLines(DataSource):
    """``spark.readStream.format("tailed_lines").load(path)``: file, position (byte offset of the line), value."""

    @classmethod
    def name(cls) -> str:
        return "tailed_lines"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader(self.options)


def tail_lines(spark: SparkSession, path: str, pattern: str = "*", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A stream of the whole lines of a growing file, or of the growing files of a folder whose names match.

    The checkpoint holds a byte position for each file.  A last line without its
    line break is left for a later batch.  A file that has become shorter than
    its position is read from its beginning again; one that was replaced by a longer one cannot be told
    from one that grew.  Offsets name every file, so this suits a bounded number of logs; for
    ever more files that land whole, ``readers.tail_records`` lists new ones only.
    """
    spark.dataSource.register(TailedLines)
    return spark.readStream.format("tailed_lines").option("pattern", pattern).option("splitBytes", str(split_bytes)).load(path)


def tail_appended(spark: SparkSession, path: str, schema: StructType, pattern: str = "*", keep_rejects: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A stream of the JSON records appended to the files; blank lines are skipped, and what is no object of the schema is dropped or kept as a reject."""
    return _parse(tail_lines(spark, path, pattern, split_bytes), schema, keep_rejects)
