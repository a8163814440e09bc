"""A stream source of its own: lines appended to files of a shared folder.

Offsets are byte positions per file, so a restart continues exactly after the
last committed line.  The driver only lists files; lines are read by the tasks.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SPLIT_BYTES = 64 * 1024 * 1024
TAIL_BYTES = 1024 * 1024
LINES_PER_BATCH = 10_000


class Span(InputPartition):
    """Lines that begin in [start, stop) of the file; ``first`` is where the batch began."""

    def __init__(self, name: str, first: int, start: int, stop: int):
        self.name, self.first, self.start, self.stop = name, first, start, stop


def complete_bytes(fs: pafs.FileSystem, path: str) -> int:
    """Size of the file up to its last line end."""
    with fs.open_input_file(path) as f:
        end = f.size()
        while end > 0:
            begin = max(0, end - TAIL_BYTES)
            f.seek(begin)
            found = f.read(end - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
    return 0


class TailReader(DataSourceStreamReader):
    """Reads any folder that Arrow's file systems reach."""

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        fs, base = pafs.FileSystem.from_uri(self.folder)
        found = fs.get_file_info(pafs.FileSelector(base))
        names = sorted(f.base_name for f in found if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_")))
        return {n: complete_bytes(fs, f"{base}/{n}") for n in names}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        spans = []
        for name, stop in end.items():
            first = start.get(name, 0)
            for at in range(first, stop, SPLIT_BYTES):
                spans.append(Span(name, first, at, min(at + SPLIT_BYTES, stop)))
        return spans

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(self.folder)
        with io.BufferedReader(fs.open_input_file(f"{base}/{span.name}")) as f:
            at = span.start
            if at > span.first:  # a line that began before belongs to the span before
                f.seek(at - 1)
                at += len(f.readline()) - 1
            else:
                f.seek(at)
            while at < span.stop:
                places, lines = [], []
                while at < span.stop and len(lines) < LINES_PER_BATCH:
                    line = f.readline()
                    places.append(at)
                    lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                    at += len(line)
                yield pa.RecordBatch.from_arrays([pa.array([span.name] * len(lines)), pa.array(places, pa.int64()), pa.array(lines, pa.string())], ["file", "position", "value"])

    def commit(self, end: dict) -> None:
        pass


class TailedLines(DataSource):
    """``spark.readStream.format("tailed_lines").option("path", folder)``"""

    @classmethod
    def name(cls) -> str:
        return "tailed_lines"

    def schema(self) -> str:
        return "file string, position bigint, value string"

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader(self.options["path"])
