"""Records between a begin and an end tag, by byte ranges: a data source for batches and streams.

A file is cut into splits of bytes. What lies between two end tags is a chunk, and belongs to
the split its first byte falls into, so that every split finds its own chunks without
knowing the others: it passes over the rest of the one that began before. A record is
its chunk from the first begin tag on. The last chunk of a file may lack its end tag;
a batch gives such a record as cut, a stream waits for the rest.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "tagged_records"
SPLIT_BYTES = 64 << 20
BLOCK = 1 << 20  # bytes read at once
BATCH = 2048  # records of an Arrow batch
BATCH_BYTES = 8 << 20
SCHEMA = "value string, file_path string, offset long, cut boolean"


def check_tags(begin: bytes, end: bytes) -> None:
    """An end tag must not overlap itself, so that splits agree on where tags are."""
    if not begin or not end:
        raise ValueError("begin and end tags must not be empty")
    if any(end[:k] == end[-k:] for k in range(1, len(end))):
        raise ValueError(f"end tag {end!r} may overlap itself")


class _Bytes:
    """A file's bytes from some place on, read block by block and dropped behind."""

    def __init__(self, file: pa.NativeFile, at: int, stop: int) -> None:
        self.file, self.base, self.stop, self.held = file, at, stop, bytearray()
        file.seek(at)

    def more(self) -> bool:
        part = self.file.read(min(BLOCK, self.stop - self.base - len(self.held)))
        self.held += part
        return bool(part)

    def find(self, tag: bytes, at: int) -> int:
        """Place of the next tag from ``at`` on, -1 if there is none."""
        k = at - self.base
        while (found := self.held.find(tag, k)) < 0:
            k = max(k, len(self.held) - len(tag) + 1)
            if not self.more():
                return -1
        return self.base + found

    def take(self, end: int) -> bytes:
        """Bytes up to ``end``, which are dropped."""
        out = bytes(self.held[: end - self.base])
        del self.held[: end - self.base]
        self.base = end
        return out


@dataclass(frozen=True)
class Split(InputPartition):
    """Chunks that begin within ``(start, stop]`` of the region ``[first, last)`` of a file, or at its first byte."""

    path: str
    first: int
    last: int
    start: int
    stop: int


def splits_of(path: str, first: int, last: int, size: int) -> list[Split]:
    return [Split(path, first, last, k, min(k + size, last)) for k in range(first, last, size)]


def records_of(file: pa.NativeFile, split: Split, begin: bytes, end: bytes) -> Iterator[tuple[int, bytes, bool]]:
    """``(offset, record, cut)`` of the chunks of a split, in order."""
    at = split.first
    if split.start > split.first:
        # The end tag behind which the first own chunk begins may itself begin before the split.
        source = _Bytes(file, max(split.first, split.start - len(end) + 1), split.last)
        found = source.find(end, source.base)
        if found < 0:
            return
        at = found + len(end)
        source.take(at)
    else:
        source = _Bytes(file, at, split.last)
    while at < split.last and (at <= split.stop or at == split.first):
        found = source.find(end, at)
        stop = split.last if found < 0 else found + len(end)
        if found < 0:
            while source.more():
                pass
        chunk = source.take(stop)
        if (k := chunk.find(begin)) >= 0:
            yield at + k, chunk[k:], found < 0
        at = stop


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Files:
    """What both readers share: the files and the tags."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.begin, self.end = options["begin"].encode(), options["end"].encode()
        self.size = int(options.get("splitBytes", SPLIT_BYTES))
        check_tags(self.begin, self.end)

    def listed(self) -> list[tuple[str, int]]:
        """Path and length of the files, without hidden ones."""
        system, path = open_fs(self.path)
        info = system.get_file_info(path)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        shown = (f for f in found if f.is_file and f.size and f.base_name[0] not in "._" and fnmatch.fnmatch(f.base_name, self.glob))
        return sorted((f.path, f.size) for f in shown)

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        system, _ = open_fs(self.path)
        held: list[tuple[int, bytes, bool]] = []
        n = 0

        def batch() -> pa.RecordBatch:
            texts = [r.decode("utf-8", "replace") for _, r, _ in held]
            paths = [partition.path] * len(held)
            return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(paths, pa.string()), pa.array([o for o, _, _ in held], pa.int64()), pa.array([c for _, _, c in held], pa.bool_())], ["value", "file_path", "offset", "cut"])

        with system.open_input_file(partition.path) as file:
            for record in records_of(file, partition, self.begin, self.end):
                held.append(record)
                n += len(record[1])
                if len(held) == BATCH or n > BATCH_BYTES:
                    yield batch()
                    held, n = [], 0
        if held:
            yield batch()


class RecordReader(_Files, DataSourceReader):
    def partitions(self) -> list[Split]:
        return [s for path, size in self.listed() for s in splits_of(path, 0, size, self.size)]


class RecordStreamReader(_Files, DataSourceStreamReader):
    """Offsets are bytes by file, always behind an end tag: a record is given once it is whole."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, _ = open_fs(self.path)
        out = {}
        for path, size in self.listed():
            with system.open_input_file(path) as file:
                if end := self._last_end(file, size):
                    out[path] = end
        return out

    def _last_end(self, file: pa.NativeFile, size: int) -> int:
        """The place behind the last end tag, found from the file's end."""
        stop = size
        while stop > 0:
            start = max(0, stop - BLOCK)
            file.seek(start)
            at = file.read(min(size, stop + len(self.end) - 1) - start).rfind(self.end)
            if at >= 0:
                return start + at + len(self.end)
            stop = start
        return 0

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return [s for path, stop in sorted(end.items()) if stop > start.get(path, 0) for s in splits_of(path, start.get(path, 0), stop, self.size)]

    def commit(self, end: dict) -> None:
        pass


class TaggedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RecordReader:  # noqa: ANN001
        return RecordReader(self.options)

    def streamReader(self, schema) -> RecordStreamReader:  # noqa: ANN001
        return RecordStreamReader(self.options)


def _source(reader, path: str, begin: str, end: str, split_bytes: int, glob: str) -> DataFrame:  # noqa: ANN001
    return reader.format(FORMAT).options(path=path, begin=begin, end=end, splitBytes=str(split_bytes), glob=glob).load()


def read_records(spark: SparkSession, path: str, begin: str, end: str, split_bytes: int = SPLIT_BYTES, glob: str = "*") -> DataFrame:
    """``(value, file_path, offset, cut)`` of the records below a folder; ``offset`` is the record's first byte.

    A last record without end tag has ``cut`` set and ends where the file does. Bytes that
    are no UTF-8 become replacement characters. ``path`` is local or a URI pyarrow opens.
    """
    check_tags(begin.encode(), end.encode())
    spark.dataSource.register(TaggedRecords)
    return _source(spark.read, path, begin, end, split_bytes, glob)


def stream_records(spark: SparkSession, path: str, begin: str, end: str, split_bytes: int = SPLIT_BYTES, glob: str = "*") -> DataFrame:
    """The same as a stream: new files, and what is appended to known ones, once a record is whole."""
    check_tags(begin.encode(), end.encode())
    spark.dataSource.register(TaggedRecords)
    return _source(spark.readStream, path, begin, end, split_bytes, glob)
