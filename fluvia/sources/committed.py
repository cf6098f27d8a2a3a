"""A sink of text files, one for each name, that appear whole or not at all.

    register(spark); write(lines, folder)        # lines: (file, row_no, value)

Tasks write to a folder of the job; only when all have ended does the driver move the files to their names, each by one
rename. A job that fails leaves nothing, an attempt that was lost or ran twice leaves files that go with the job's folder.
Files of a name that is there are replaced, others stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .records import opened

#: Files that are moved side by side; a rename is one call to the file system.
MOVERS = 16


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


def _safe(name: str | None) -> str:
    """A file's name below the folder; one that leads out of it, or is null or empty, is an error."""
    parts = (name or "").split("/")
    if any(p in ("", ".", "..") for p in parts) or parts[0].startswith("_"):
        raise ValueError(f"no name of a file: {name!r}")
    return "/".join(parts)


class TextWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path, f"_job-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        at, root = opened(self.path)
        attempt, files, name, out = uuid.uuid4().hex, [], None, None
        at.create_dir(f"{root}/{self.job}", recursive=True)
        try:
            for batch in iterator:
                for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                    if out is None or file != name:
                        if out is not None:
                            out.close()
                        name = file
                        files.append((f"{root}/{self.job}/{attempt}-{len(files)}", _safe(file)))
                        out = at.open_output_stream(files[-1][0], compression=None, buffer_size=1 << 20)
                    if value is not None:
                        out.write(value.encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written]) -> None:
        at, root = opened(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        names = [n for _, n in files]
        if len(set(names)) < len(names):
            at.delete_dir(f"{root}/{self.job}")
            raise ValueError("a file's lines are in several tasks, or not together")
        for folder in {n.rpartition("/")[0] for n in names} - {""}:
            at.create_dir(f"{root}/{folder}", recursive=True)
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda f: at.move(f[0], f"{root}/{f[1]}"), files))
        self.abort(messages)

    def abort(self, messages: list[Written]) -> None:
        at, root = opened(self.path)
        if at.get_file_info(f"{root}/{self.job}").type == afs.FileType.Directory:
            at.delete_dir(f"{root}/{self.job}")


class CommittedTexts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_texts"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema, overwrite: bool) -> TextWriter:
        return TextWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CommittedTexts)


def write(lines: DataFrame, path: str) -> None:
    """Write (file, row_no, value): a file for each name, its lines by row_no; null values are no lines, a name whose values
    are all null is an empty file. A file is one task's, a line at a time; Spark sorts, and spills, what a task gets."""
    register(lines.sparkSession)
    rows = lines.repartition("file").sortWithinPartitions("file", "row_no").select("file", "value")
    rows.write.format("committed_texts").mode("append").save(path)
