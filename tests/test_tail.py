"""Following logs: appended, half-written, rotated, rewritten and deleted ones, over restarts."""

import os

import pytest

from sparkevents.sources import tail


class Follower:
    """A stream that is started anew for every look at the logs."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        self.logs = folder / "logs"
        self.logs.mkdir()
        self.seen = 0

    def append(self, name, text):
        with open(self.logs / name, "ab") as f:
            f.write(text.encode())

    def look(self):
        stream = tail.stream_tail_audit(self.spark, str(self.logs), **self.options)
        query = (
            stream.writeStream.format("parquet").option("checkpointLocation", str(self.folder / "checkpoint"))
            .trigger(availableNow=True).start(str(self.folder / "out"))
        )
        query.awaitTermination()
        rows = [(r["type"].split(".")[-1], r["message"]) for r in self.spark.read.schema("message string, type string").parquet(str(self.folder / "out")).collect()]
        new = sorted(rows)
        for r in getattr(self, "old", []):
            new.remove(r)
        self.old = rows
        return new


def test_appended_and_half_written_lines(spark, tmp_path):
    f = Follower(spark, tmp_path)
    f.append("banning.log", "old\n")
    f.append("other.log", "x\n")
    assert f.look() == []  # from the end
    f.append("banning.log", "a\nb")
    f.append("isolation.log", "é\n\nlast\n")
    assert f.look() == [("banning", "a"), ("isolation", ""), ("isolation", "last"), ("isolation", "é")]
    assert f.look() == []
    f.append("banning.log", "c\n")
    f.append("other.log", "y\n")
    assert f.look() == [("banning", "bc")]


def test_rotated_logs_are_finished(spark, tmp_path):
    f = Follower(spark, tmp_path, start="beginning")
    f.append("banning.log", "1\n2\n")
    assert f.look() == [("banning", "1"), ("banning", "2")]
    f.append("banning.log", "3\nno end")
    os.rename(f.logs / "banning.log", f.logs / "banning.log.1")
    f.append("banning.log", "4\n")
    assert f.look() == [("banning", "3"), ("banning", "4")]
    os.utime(f.logs / "banning.log.1", (1, 1))
    os.rename(f.logs / "banning.log.1", f.logs / "banning.log.2")
    os.rename(f.logs / "banning.log", f.logs / "banning.log.1")
    f.append("banning.log", "5\n")
    assert f.look() == [("banning", "5"), ("banning", "no end")]
    os.remove(f.logs / "banning.log.2")
    f.append("banning.log", "6\n")
    assert f.look() == [("banning", "6")]


def test_rewritten_logs_begin_anew(spark, tmp_path):
    f = Follower(spark, tmp_path, start="beginning")
    f.append("banning.log", "one\ntwo\n")
    f.look()
    (f.logs / "banning.log").write_text("x\n")  # shorter
    assert f.look() == [("banning", "x")]
    (f.logs / "banning.log").write_text("other\nlines\n")  # longer, with another beginning
    assert f.look() == [("banning", "lines"), ("banning", "other")]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_ranges_share_the_lines(tmp_path, size):
    lines = ["", "a", "bb" * 9, "", "é" * 5, "z"]
    path = tmp_path / "banning.log"
    path.write_text("skipped\n" + "\n".join(lines) + "\nhalf")
    reader = tail.TailReader(str(tmp_path), "beginning", size)
    end = reader.latestOffset()
    (file,) = end
    start = {file: {"bytes": 8, "head": [8, tail.checksum(str(path), 8)]}}
    parts = reader.partitions(start, end)
    got = [m for p in parts for b in reader.read(p) for m in b.column("message").to_pylist()]
    assert got == lines
    path.rename(tmp_path / "banning.log.1")  # rotated between planning and reading
    assert [m for p in parts for b in reader.read(p) for m in b.column("message").to_pylist()] == lines
    (tmp_path / "banning.log.1").unlink()
    with pytest.raises(FileNotFoundError):
        list(reader.read(parts[0]))


def test_parts_and_rotated_ones_first(tmp_path):
    for name in ("live-response/part-0", "live-response/part-0.1", "live-response/part-0.gz", "_tmp/part-0", "live-response/.x"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name + "\n")
    reader = tail.TailReader(str(tmp_path), "beginning", 1 << 20)
    parts = reader.partitions({}, reader.latestOffset())
    assert [os.path.basename(r.path) for p in parts for r in p.ranges] == ["part-0.1", "part-0"] and len(parts) == 1
    with pytest.raises(ValueError):
        tail.TailReader(str(tmp_path), "middle", 1)
