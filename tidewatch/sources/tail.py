"""Replayable tail of growing line files (S-1): a stream source with byte offsets.

Spark's own directory source reads a file once and never sees what is appended later.
This source's offset is the size of every file up to which lines have been handed out; a
batch reads the bytes between two offsets, cut into ranges of at most ``max_bytes``
that any executor can read.  A line belongs to the range that holds its line feed, and a
range that begins within a line looks back for the line's beginning, so every line comes
once, however the file grew and however often a batch is run again.  A line without its
line feed waits for it.

Register with ``register(spark)``; then ``spark.readStream.format("line_tail")
.option("path", folder).load()`` gives ``file STRING, position BIGINT, value STRING``.
Options: ``path`` (a folder or a URI of one), ``suffix`` (of the file names taken),
``max_bytes`` (of a range).  Files are opened by ``pyarrow.fs``; a file must only grow.
"""

from __future__ import annotations

import sys as _sys
from collections.abc import Iterator

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

PIECE = 1 << 16


class Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


def ranges(start: dict[str, int], end: dict[str, int], max_bytes: int) -> list[Range]:
    """What lies between two offsets, in parts of at most ``max_bytes``."""
    out = []
    for file in sorted(end):
        at = start.get(file, 0)
        if end[file] < at:
            raise ValueError(f"{file} shrank from {at} to {end[file]} bytes: a tailed file must only grow")
        while at < end[file]:
            upto = min(at + max_bytes, end[file])
            out.append(Range(file, at, upto))
            at = upto
    return out


def lines_of(f, start: int, end: int) -> Iterator[tuple[int, str]]:
    """(position, line) of the lines whose line feed lies in [start, end) of the file ``f``."""
    begin = start
    while begin > 0:                                       # back to the end of the line before
        low = max(0, begin - PIECE)
        f.seek(low)
        at = f.read(begin - low).rfind(b"\n")
        if at >= 0:
            begin = low + at + 1
            break
        begin = low
    f.seek(begin)
    rest, at, read = b"", begin, begin
    while read < end:
        data = f.read(min(1 << 20, end - read))
        if not data:
            raise ValueError(f"file ends at {read}, {end} bytes were there")
        read += len(data)
        *whole, rest = (rest + data).split(b"\n")
        for line in whole:
            yield at, line.removesuffix(b"\r").decode("utf-8", "replace")
            at += len(line) + 1


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.suffix = options.get("suffix", "")
        self.max_bytes = int(options.get("max_bytes", 64 << 20))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        place, base = fs.FileSystem.from_uri(self.path)
        found = place.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        return {f.path: f.size for f in found if f.type == fs.FileType.File and f.size and f.path.endswith(self.suffix)
                and not f.base_name.startswith((".", "_"))}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return ranges(start, end, self.max_bytes)

    def read(self, partition: Range) -> Iterator[tuple]:
        from pyarrow import fs

        place, _ = fs.FileSystem.from_uri(self.path)
        with place.open_input_file(partition.file) as f:
            for at, line in lines_of(f, partition.start, partition.end):
                yield partition.file, at, line

    def commit(self, end: dict) -> None:
        pass


class LineTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_tail"

    def schema(self) -> str:
        return "file STRING, position BIGINT, value STRING"

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LineTail)


def tail_lines(spark: SparkSession, path: str, **options) -> "DataFrame":  # noqa: F821
    """A stream of the lines of the growing files under ``path``."""
    register(spark)
    return spark.readStream.format("line_tail").option("path", path).options(**options).load()
