"""Receivers outside Spark that keep what they are sent as files of a folder all nodes reach.

Names follow from what is sent, so that a repeated delivery replaces itself.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow.fs as pafs
from pyspark.sql.types import Row


def put(path: str, text: str) -> None:
    """Write a small file on any file system that Arrow knows, whole or not at all."""
    fs, place = pafs.FileSystem.from_uri(path)
    folder, _, name = place.rpartition("/")
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/.{name}", compression=None) as out:
        out.write(text.encode())
    fs.move(f"{folder}/.{name}", place)


class FolderReceiver:
    """Takes chunks of rows, or the newest row of a key, as JSON lines."""

    def __init__(self, folder: str, columns: Sequence[str], ident: str):
        self.folder, self.columns, self.ident = folder.rstrip("/"), list(columns), ident

    def line(self, row: Row) -> str:
        return json.dumps({c: row[c] for c in self.columns}, default=str) + "\n"

    def send(self, rows: list[Row]) -> None:
        put(f"{self.folder}/from-{rows[0][self.ident]}.json", "".join(map(self.line, rows)))

    def upsert(self, row: Row) -> None:
        put(f"{self.folder}/key-{row[self.ident]}.json", self.line(row))


class FolderWriter:
    """Row writer for ``writeStream.foreach``: one file per partition and epoch, put in place when both are done."""

    def __init__(self, folder: str, columns: Sequence[str]):
        self.folder, self.columns = folder.rstrip("/"), list(columns)

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.name, self.lines = f"{epoch_id}-{partition_id}.json", []
        return True

    def process(self, row: Row) -> None:
        self.lines.append(json.dumps({c: row[c] for c in self.columns}, default=str) + "\n")

    def close(self, error: Exception | None) -> None:
        if error is None and self.lines:
            put(f"{self.folder}/{self.name}", "".join(self.lines))
