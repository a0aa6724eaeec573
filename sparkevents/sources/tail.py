"""A stream of the lines appended to audit logs.

The offset of a stream is a number of bytes per file, and a file is known by its device, its inode and a checksum of its
first bytes, not by its name: a rotated log goes on where it was, under its new name, and a new or rewritten log begins
at its start. Only the ends of logs are looked at on the driver; the lines are read by tasks, a bounded range of bytes
each, from the folder that all executors mount.
"""

from __future__ import annotations

import os
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .audit import label_of

#: Bytes that tell a file from a later one with its inode, bytes of a range, and of a read.
HEAD, RANGE, BLOCK = 1024, 32 << 20, 1 << 20
#: Seconds without a change after which the last line of a rotated log counts as whole without a line end.
SETTLED = 5.0


@dataclass
class Range:
    """Lines that begin in ``[begin, end)`` of a file; ``first`` is where the batch begins and ``last`` where it ends."""

    path: str
    file: str
    first: int
    begin: int
    end: int
    last: int


@dataclass
class Ranges(InputPartition):
    """What one task reads, in order."""

    ranges: list[Range]


def identity(status: os.stat_result) -> str:
    return f"{status.st_dev}:{status.st_ino}"


def checksum(path: str, size: int) -> int:
    with open(path, "rb") as f:
        return zlib.crc32(f.read(size))


def whole_lines(path: str, size: int) -> int:
    """Bytes up to the last line end within the first ``size``."""
    with open(path, "rb") as f:
        while size > 0:
            begin = max(0, size - BLOCK)
            f.seek(begin)
            at = f.read(size - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            size = begin
    return 0


def logs(folder: str) -> list[str]:
    """Files below a folder: logs, parts of logs and rotated ones, but nothing hidden or compressed."""
    found = []
    for base, folders, names in os.walk(folder):
        folders[:] = [d for d in folders if d[0] not in "._"]
        found += [os.path.join(base, n) for n in names if n[0] not in "._" and not n.endswith((".gz", ".zip", ".bz2", ".xz"))]
    return sorted(found)


def unrotated(path: str) -> str:
    """The name of a log without the number of its rotation."""
    stem, _, number = path.rpartition(".")
    return stem if stem and number.isdigit() else path


class TailReader(DataSourceStreamReader):
    def __init__(self, folder: str, start: str, size: int):
        if start not in ("end", "beginning"):
            raise ValueError("start is 'end' or 'beginning'")
        self.folder, self.start, self.size = folder, start, size

    def ends(self) -> dict:
        """What each file holds in whole lines."""
        found: dict[str, dict] = {}
        paths = logs(self.folder)
        for path in paths:
            try:
                status = os.stat(path)
                size = whole_lines(path, status.st_size)
                if path != unrotated(path) and unrotated(path) in paths and time.time() - status.st_mtime > SETTLED:
                    size = status.st_size  # nobody ends its last line any more
                head = min(size, HEAD)
                found[identity(status)] = {"path": path, "bytes": size, "head": [head, checksum(path, head)]}
            except FileNotFoundError:  # rotated in between: it is found under its new name next time
                continue
        return found

    def initialOffset(self) -> dict:
        return self.ends() if self.start == "end" else {}

    def latestOffset(self) -> dict:
        return self.ends()

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        """Ranges of bytes, those of rotated files first; small ones share a task."""
        ranges: list[Range] = []
        for file, to in sorted(end.items(), key=lambda x: (x[1]["path"] == unrotated(x[1]["path"]), x[1]["path"])):
            known = start.get(file, {"bytes": 0, "head": [0, 0]})
            first, last = known["bytes"], to["bytes"]
            if first > last or (first < last and checksum(current(self.folder, to["path"], file), known["head"][0]) != known["head"][1]):
                first = 0  # another file took the inode, or the log was cut and written anew
            ranges += [Range(to["path"], file, first, b, min(b + self.size, last), last) for b in range(first, last, self.size)]
        tasks, held = [Ranges([])], 0
        for r in ranges:
            if tasks[-1].ranges and held + r.end - r.begin > self.size:
                tasks.append(Ranges([]))
                held = 0
            tasks[-1].ranges.append(r)
            held += r.end - r.begin
        return tasks

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges:
            path, name = current(self.folder, part.path, part.file), unrotated(part.path)
            for lines in lines_of(path, part):
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([name] * len(lines))], ["message", "path"])

    def commit(self, end: dict) -> None:
        pass


def current(folder: str, path: str, file: str) -> str:
    """Where a file is now; it may have been rotated since it was seen."""
    for candidate in (path, *logs(folder)):
        try:
            if identity(os.stat(candidate)) == file:
                return candidate
        except FileNotFoundError:
            continue
    raise FileNotFoundError(f"{path} is gone before all of its lines were read")


def lines_of(path: str, part: Range) -> Iterator[list[str]]:
    """The lines that begin in the range, in lists of about a block; the last one may end behind the range."""
    with open(path, "rb") as f:
        at = part.begin
        if at > part.first:  # the line around the border belongs to the range before
            f.seek(at - 1)
            at += len(f.readline(part.last - at + 1)) - 1
        f.seek(at)
        found, size = [], 0
        while at < part.end:
            line = f.readline(part.last - at)
            if not line:
                raise OSError(f"{path} is shorter than it was")
            at += len(line)
            size += len(line)
            found.append(line.removesuffix(b"\n").decode(errors="replace"))
            if size >= BLOCK:
                yield found
                found, size = [], 0
        if found:
            yield found


class TailSource(DataSource):
    """Options: ``path`` (the folder), ``start`` (``end`` or ``beginning``) and ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "message string, path string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options["path"], self.options.get("start", "end"), int(self.options.get("rangeBytes", RANGE)))


def stream_tail_audit(
    spark: SparkSession, folder: str, start: str = "end", labels: dict[str, str] | None = None, range_bytes: int = RANGE
) -> DataFrame:
    """Stream of ``(message, type)``: the lines appended to the audit logs below a folder.

    A log is a file ``<log>.log`` or a folder ``<log>`` of files ``part-*``; rotated files end in a number. ``start`` says
    whether lines that are there before the stream's first batch count. Lines without an end wait for it. Files without a
    label are left out. A file that goes away before it was read fails the stream.
    """
    spark.dataSource.register(TailSource)
    lines = spark.readStream.format("log_tail").option("path", folder).option("start", start).option("rangeBytes", range_bytes).load()
    found = lines.select("message", label_of(lines["path"], labels).alias("type"))
    return found.filter(found["type"].isNotNull())
