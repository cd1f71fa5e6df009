"""A user-written source: a folder of delimited files, read by ranges of bytes as Arrow batches.

A file is dealt out in splits of `splitBytes` (64 MB unless told otherwise). A split owns the lines that begin
in it, so it looks for the end of a line from its own beginning on and reads the last one to its end. Files
are found and read through the file system that the path names; a path without a scheme is one that the
driver and all executors see. With `columns` (the names of a line's fields in order) the schema may name some
of them in any order, and only those are converted. Fields hold no separators or line breaks; empty fields
are null and blank lines are passed over.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pc
import pyarrow.fs as pf
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

SPLIT_BYTES = 64 << 20
_TYPES = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "date": pa.date32(), "timestamp": pa.timestamp("us"), "timestamp_ntz": pa.timestamp("us"),
}


@dataclass
class Split(InputPartition):
    """The lines of a file that begin from `low` on and before `high`."""

    path: str
    low: int
    high: int


def _opened(path: str) -> tuple[pf.FileSystem, str]:
    return pf.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pf.LocalFileSystem(), path)


def _files(folder: str) -> list[tuple[str, int]]:
    """Names and sizes of the data files of a folder, in name order."""
    system, place = _opened(folder)
    scheme = folder[:len(folder) - len(place)] if folder.endswith(place) else ""
    found = [f for f in system.get_file_info(pf.FileSelector(place)) if f.type == pf.FileType.File]
    return sorted((scheme + f.path, f.size) for f in found if not f.base_name.startswith((".", "_")))


def _splits(files: list[tuple[str, int]], size: int) -> list[InputPartition]:
    return [Split(path, low, min(low + size, total)) for path, total in files for low in range(0, total, size)]


def _lines(split: Split, piece: int = 1 << 16) -> bytes:
    """The bytes of the split's own lines."""
    system, place = _opened(split.path)
    with system.open_input_file(place) as file:
        total = file.size()
        start = split.low
        if start:
            # A line begins at `low` if the byte before ends one.
            start = _line_end(file, split.low - 1, total, piece)
        end = _line_end(file, split.high - 1, total, piece)
        if start >= split.high or start >= end:
            return b""
        file.seek(start)
        return file.read(end - start)


def _line_end(file: pa.NativeFile, at: int, total: int, piece: int) -> int:
    """Just behind the first line end from `at` on."""
    while at < total:
        file.seek(at)
        read = file.read(piece)
        found = read.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(read)
    return total


def _batches(split: Split, schema: T.StructType, options: dict) -> Iterator[pa.RecordBatch]:
    data = _lines(split)
    if not data.strip():
        return
    wanted = [f.name for f in schema.fields]
    columns = [c.strip() for c in options["columns"].split(",")] if "columns" in options else wanted
    kinds = {f.name: _TYPES[f.dataType.simpleString()] for f in schema.fields}
    table = pc.read_csv(
        io.BytesIO(data),
        read_options=pc.ReadOptions(column_names=columns, use_threads=False),
        parse_options=pc.ParseOptions(delimiter=options.get("sep", ","), quote_char=False, ignore_empty_lines=True),
        convert_options=pc.ConvertOptions(
            column_types=kinds, include_columns=wanted, strings_can_be_null=True, null_values=[""],
            quoted_strings_can_be_null=True))
    zoned = [pa.timestamp("us", "UTC") if f.dataType.simpleString() == "timestamp" else kinds[f.name]
             for f in schema.fields]
    yield from table.cast(pa.schema(list(zip(wanted, zoned, strict=True)))).to_batches(max_chunksize=10_000)


class _Batch(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.schema = options, schema

    def partitions(self) -> list[InputPartition]:
        size = int(self.options.get("splitbytes", SPLIT_BYTES))
        return _splits(_files(self.options["path"]), size) or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from _batches(partition, self.schema, self.options)


class _Stream(DataSourceStreamReader):
    """Offsets count the files in name order; new files must sort after the old ones."""

    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.schema = options, schema

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        return {"files": len(_files(self.options["path"]))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        chosen = _files(self.options["path"])[start["files"]:end["files"]]
        return _splits(chosen, int(self.options.get("splitbytes", SPLIT_BYTES)))

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _batches(partition, self.schema, self.options)

    def commit(self, end: dict) -> None:
        pass


class FolderSource(DataSource):
    """`spark.read.format("record_folder").schema(...).load(path)`, or readStream."""

    @classmethod
    def name(cls) -> str:
        return "record_folder"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Batch({k.lower(): v for k, v in self.options.items()}, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Stream({k.lower(): v for k, v in self.options.items()}, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FolderSource)
