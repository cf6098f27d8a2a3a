"""FASTQ and FASTA files as a Spark data source whose splits end at records, so that no line is shuffled.

    register(spark); spark.read.format("fastq_records").load(folder)

Options: `names` (a glob pattern of file names), `splitBytes` (128 MB). A path is a file, a folder (with its subfolders;
names that start with a dot or an underscore are skipped), a pattern (* ? [] within a name) or several of them between
commas, local or of a scheme that pyarrow knows. A split owns the records that begin in it and reads the last one to its end; what is in memory is one record
and one Arrow batch. Gzip is told by a file's first two bytes, whatever its name is: such a file is its first split's.
Lines end in \\n or \\r\\n.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import os
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES = 128 << 20
BATCH_BYTES = 4 << 20


def opened(path: str) -> tuple[afs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:") :]
    return afs.FileSystem.from_uri(path) if "://" in path else (afs.LocalFileSystem(), os.path.abspath(path))


def listed(path: str, names: str | None = None) -> list[tuple[str, int]]:
    """(path, size) of the files under the paths, in order; a path that is not there is an error."""
    out = {}
    for one in path.split(","):
        at, where = opened(one.strip())
        scheme = one.strip().partition("://")[0] + "://" if "://" in one else ""
        steps = where.split("/")
        fixed = next((i for i, s in enumerate(steps) if set(s) & set("*?[")), None)
        if fixed is not None:
            for f in at.get_file_info(afs.FileSelector("/".join(steps[:fixed]) or "/", recursive=fixed < len(steps) - 1)):
                own = f.path.split("/")
                if f.is_file and len(own) == len(steps) and f.base_name[:1] not in "._" and all(map(fnmatch.fnmatchcase, own, steps)) and fnmatch.fnmatch(f.base_name, names or "*"):
                    out[scheme + f.path] = f.size
            continue
        info = at.get_file_info(where)
        if info.type == afs.FileType.NotFound:
            raise FileNotFoundError(one)
        found = [info] if info.is_file else at.get_file_info(afs.FileSelector(where, recursive=True))
        below = len(where.rstrip("/")) + 1
        for f in found:
            parts = [f.base_name] if info.is_file else f.path[below:].split("/")
            if f.is_file and not any(p[:1] in "._" for p in parts) and fnmatch.fnmatch(f.base_name, names or "*"):
                out[scheme + f.path] = f.size
    return sorted(out.items())


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int


def _lines(split: Split) -> Iterator[tuple[int, bytes]]:
    """(offset, line) from the first line that begins in the split on, to the file's end."""
    at, where = opened(split.path)
    with at.open_input_file(where) as raw:
        packed = raw.read(2) == b"\x1f\x8b"
        if packed and split.start:
            return
        place = 0 if packed else max(split.start - 1, 0)
        raw.seek(place)
        with io.BufferedReader(raw, 1 << 20) as buffer:
            stream = io.BufferedReader(gzip.GzipFile(fileobj=buffer), 1 << 20) if packed else buffer
            if split.start:
                place += len(stream.readline())
            while line := stream.readline():
                # All of a packed file belongs to its first split.
                yield (0 if packed else place), line.rstrip(b"\r\n")
                place += len(line)


def fastq_records(split: Split) -> Iterator[tuple[bytes, ...]]:
    """(read_id, sequence, quality). A record is a line that begins with @, of which the next but one begins with +, with
    the lines to the fourth; other lines are passed over, so every split finds the same records. (A quality line may begin
    with @; the next but one is then a sequence.) Records whose sequence and quality differ in length are left out."""
    lines, ahead = _lines(split), deque()
    while True:
        while len(ahead) < 4 and (line := next(lines, None)):
            ahead.append(line)
        if not ahead or ahead[0][0] >= split.end:
            return
        if len(ahead) >= 3 and ahead[0][1].startswith(b"@") and ahead[2][1].startswith(b"+"):
            (_, head), (_, sequence), _, *rest = (ahead.popleft() for _ in range(min(4, len(ahead))))
            quality = rest[0][1] if rest else b""
            if len(sequence) == len(quality):
                yield (head[1:].split() or [b""])[0] if head[1:2].strip() else b"", sequence, quality
        else:
            ahead.popleft()


def fasta_records(split: Split) -> Iterator[tuple[bytes, ...]]:
    """(name, sequence) of records that begin with a line that begins with >; the name ends at the first blank, blanks in
    sequences go. Lines before the first record are passed over."""
    name, parts = None, []
    for place, line in _lines(split):
        if line.startswith(b">"):
            if name is not None:
                yield name, b"".join(parts)
            if place >= split.end:
                return
            name, parts = (line[1:].split() or [b""])[0], []
        elif name is not None:
            parts.append(b"".join(line.split()))
    if name is not None:
        yield name, b"".join(parts)


class RecordReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str], records):
        self.path, self.names = options["path"], options.get("names")
        self.bytes, self.columns, self.records = int(options.get("splitbytes", SPLIT_BYTES)), columns, records

    def partitions(self) -> list[Split]:
        return [Split(p, a, min(a + self.bytes, size)) for p, size in listed(self.path, self.names) for a in range(0, size, self.bytes)] or [Split("", 0, 0)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if not split.path:
            return
        rows, size = [], 0
        for row in self.records(split):
            rows.append(row)
            size += sum(map(len, row))
            if size >= BATCH_BYTES:
                yield self._batch(split.path, rows)
                rows, size = [], 0
        if rows:
            yield self._batch(split.path, rows)

    def _batch(self, path: str, rows: list[tuple[bytes, ...]]) -> pa.RecordBatch:
        texts = [pa.array([v.decode("utf-8", "replace") for v in column], pa.string()) for column in zip(*rows)]
        return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *texts], names=self.columns)


class FastqSource(DataSource):
    columns, records = ["path", "read_id", "sequence", "quality"], staticmethod(fastq_records)

    @classmethod
    def name(cls) -> str:
        return "fastq_records"

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in self.columns)

    def reader(self, schema) -> RecordReader:
        return RecordReader(dict(self.options), self.columns, self.records)


class FastaSource(FastqSource):
    columns, records = ["path", "name", "sequence"], staticmethod(fasta_records)

    @classmethod
    def name(cls) -> str:
        return "fasta_records"


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqSource)
    spark.dataSource.register(FastaSource)


def read(spark: SparkSession, kind: str, path: str, names: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of "fastq" or "fasta" files: (path, read_id, sequence, quality) or (path, name, sequence)."""
    register(spark)
    reader = spark.read.format(f"{kind}_records").option("splitBytes", split_bytes)
    return (reader.option("names", names) if names else reader).load(path)
