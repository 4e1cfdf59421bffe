"""A data source for run directories: one directory per run, files with names of their own.

Spark's file formats choose the names of the files they write and skip empty files when they
read; here both matter.  The reader is planned from one listing of the root, in groups of run
directories, and every task lists and reads its own: the driver never sees a file name.  Large
files can be read in byte slices, so one run with most of the lines does not keep one task busy.

The writer gives every file its name.  A task writes a file beside it and renames it when it is
whole, so a reader sees a file complete or not at all, and a repeated task writes the same
file again.

Paths are those of ``pyarrow.fs``: local or mounted folders, ``hdfs://``, ``s3://``.
"""

from __future__ import annotations

import csv
import io
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from fleetstream.functions import loglines

LINES = "run_id string, file_name string, line_no bigint, value string"
SAMPLES = "run_id string, name string, cpu string, memory string"
BLOCK = 8 << 20
ROWS = 10_000
RUNS_PER_TASK = 64
# Files of at most this size are read whole by the first slice.
SLICED_BYTES = 64 << 20
# A cell may be longer than the parser expects.
csv.field_size_limit(1 << 30)
# Files being written; readers leave them out.
PENDING = "._pending-"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"/{path}")


@dataclass
class Runs(InputPartition):
    """Run directories of one task, and which of the slices of their large files it reads."""

    names: list[str]
    number: int = 0
    slices: int = 1


def lines_between(source, start: int, end: int) -> Iterator[tuple[list[int], list[str]]]:
    """The lines that start in a byte range of a file, as offsets and texts, in blocks."""
    # From the byte before, so that a line which starts at ``start`` is told from one around it.
    at = max(start - 1, 0)
    source.seek(at)
    skipping, rest = start > 0, b""
    while at < end:
        block = source.read(BLOCK)
        pieces = (rest + block).split(b"\n")
        # Without a next block the last piece is a line only if it has text.
        rest = pieces.pop() if block or not pieces[-1] else b""
        offsets, texts = [], []
        for piece in pieces:
            if not skipping and at < end:
                offsets.append(at)
                texts.append(piece.removesuffix(b"\r").decode("utf-8", "replace"))
            skipping = False
            at += len(piece) + 1
        yield offsets, texts
        if not block:
            return


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.files = options.get("files", "*").split(",")
        self.per_task = int(options.get("runspertask", RUNS_PER_TASK))
        self.slices = int(options.get("slices", 1))

    def partitions(self) -> list[Runs]:
        place, root = opened(self.root)
        found = place.get_file_info(fs.FileSelector(root))
        names = sorted(f.base_name for f in found if f.type == fs.FileType.Directory and re.search(loglines.RUN_ID, f.base_name))
        groups = [names[i : i + self.per_task] for i in range(0, len(names), self.per_task)]
        return [Runs(g, i, self.slices) for g in groups or [[]] for i in range(self.slices)]

    def listed(self, place: fs.FileSystem, root: str, run: str) -> list[fs.FileInfo]:
        """Files of a run that the pattern asks for."""
        found = place.get_file_info(fs.FileSelector(posixpath.join(root, run)))
        wanted = [
            f
            for f in found
            if f.type == fs.FileType.File and PENDING not in f.base_name and any(fnmatch(f.base_name, p) for p in self.files)
        ]
        return sorted(wanted, key=lambda f: f.base_name)


class LinesReader(_Reader):
    """A row per line with its byte offset, and one row without text per file."""

    def read(self, partition: Runs) -> Iterator[pa.RecordBatch]:
        place, root = opened(self.root)
        types = (pa.string(), pa.string(), pa.int64(), pa.string())
        rows: list[list] = [[], [], [], []]

        def flushed() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(rows, types, strict=True)]
            for column in rows:
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, ["run_id", "file_name", "line_no", "value"])

        for run in partition.names:
            for found in self.listed(place, root, run):
                n = partition.slices if found.size > SLICED_BYTES else 1
                if partition.number >= n:
                    continue
                start, end = (found.size * i // n for i in (partition.number, partition.number + 1))
                if partition.number == 0:
                    for column, value in zip(rows, (run, found.base_name, None, None), strict=True):
                        column.append(value)
                with place.open_input_file(found.path) as source:
                    for offsets, texts in lines_between(source, start, end):
                        rows[0] += [run] * len(texts)
                        rows[1] += [found.base_name] * len(texts)
                        rows[2] += offsets
                        rows[3] += texts
                        if len(rows[0]) >= ROWS:
                            yield flushed()
        yield flushed()


class SamplesReader(_Reader):
    """A row per container sample; columns are found by the file's header."""

    def read(self, partition: Runs) -> Iterator[tuple]:
        place, root = opened(self.root)
        for run in partition.names if partition.number == 0 else ():
            for found in self.listed(place, root, run):
                with place.open_input_stream(found.path) as source:
                    text = io.TextIOWrapper(source, encoding="utf-8", errors="replace", newline="")
                    for row in csv.DictReader(text):
                        name = row.get("Name") or row.get("Container") or ""
                        yield run, name, row.get("CPUPerc") or None, row.get("MemUsage") or None


@dataclass
class Written(WriterCommitMessage):
    files: int


class LinesWriter(DataSourceArrowWriter):
    """Writes rows of ``LINES``, those of a file adjacent and in order, to named files.

    A row without ``value`` makes sure that its file exists and adds no line.
    """

    def __init__(self, options: dict):
        self.root = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        place, root = opened(self.root)
        attempt = uuid.uuid4().hex
        made, last, out, pending = 0, None, None, ""

        def finished() -> None:
            out.close()
            target = posixpath.join(root, *last)
            try:
                place.move(pending, target)
            except OSError:
                # Some stores do not rename onto a file that an earlier attempt wrote.
                place.delete_file(target)
                place.move(pending, target)

        try:
            for batch in iterator:
                columns = (batch.column(c).to_pylist() for c in ("run_id", "file_name", "value"))
                for run, name, value in zip(*columns, strict=True):
                    if (run, name) != last:
                        if out is not None:
                            finished()
                            out = None
                        if last is not None and (run, name) < last:
                            raise ValueError("the rows of a file must be adjacent, the files in order")
                        last, made = (run, name), made + 1
                        folder = posixpath.join(root, run)
                        place.create_dir(folder, recursive=True)
                        pending = posixpath.join(folder, f"{PENDING}{attempt}")
                        out = place.open_output_stream(pending)
                    if value is not None:
                        out.write(value.encode() + b"\n")
            if out is not None:
                finished()
                out = None
        finally:
            if out is not None:
                out.close()
                place.delete_file(pending)
        return Written(made)

    def commit(self, messages: list[Written | None]) -> None:
        place, root = opened(self.root)
        place.create_dir(root, recursive=True)
        with place.open_output_stream(posixpath.join(root, "_SUCCESS")):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        """Files that are whole stay; the missing marker says that some are not."""


class RunDirectories(DataSource):
    """Lines of the files below ``path``.

    Options: ``files`` (patterns, comma-separated), ``runsPerTask``, ``slices``.
    """

    @classmethod
    def name(cls) -> str:
        return "run_directories"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> LinesReader:
        return LinesReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        if overwrite:
            raise ValueError("files replace files of their name; nothing else is overwritten")
        return LinesWriter(dict(self.options))


class RunSamples(DataSource):
    """Container samples of the files below ``path``; options as for ``run_directories``."""

    @classmethod
    def name(cls) -> str:
        return "run_samples"

    def schema(self) -> str:
        return SAMPLES

    def reader(self, schema) -> SamplesReader:
        return SamplesReader(dict(self.options))
