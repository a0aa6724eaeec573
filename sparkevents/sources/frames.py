"""Binary bundles: runs of ``<u32 little-endian length><bytes>``, plain or inside a zip archive, and their decoding."""

from __future__ import annotations

import gzip
import io
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import is_gzip
from ..functions.structs import arrow_schema
from .sensor_schema import message_class, spark_type

TOO_SHORT = "body is shorter than 4 bytes"
NOT_FILLED = "messages did not fill entire bundle"
BAD_MEMBER = "unreadable archive member"
UNDECODABLE = "undecodable frame"
BATCH_ROWS = 1_000
BATCH_BYTES = 16 << 20
#: Begins the record at the end of every zip archive.
ARCHIVE_END = b"PK\x05\x06"

FRAME = "member string, idx bigint, frame binary, error string"


def split_run(body: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """``(index, frame, error)`` of one run.

    Up to four trailing bytes are ignored. A length past the end is an error, but the frames before it count.
    """
    if len(body) < 4:
        yield 0, None, TOO_SHORT
        return
    at, index = 0, 0
    while at + 4 < len(body):
        (length,) = struct.unpack_from("<I", body, at)
        at += 4
        if at + length > len(body):
            yield index, None, NOT_FILLED
            return
        yield index, body[at : at + length], None
        at, index = at + length, index + 1


def split_body(body: bytes, archive: bool = True) -> Iterator[tuple[str, int, bytes | None, str | None]]:
    """``(member, index, frame, error)`` of a body that is a zip archive or, failing that, one run."""
    try:
        members = zipfile.ZipFile(io.BytesIO(body)) if archive and ARCHIVE_END in body else None
    except (zipfile.BadZipFile, ValueError, OSError):
        members = None
    if members is None:
        for index, frame, error in split_run(body):
            yield "", index, frame, error
        return
    for info in members.infolist():
        try:
            content = members.read(info)
        except Exception:  # a damaged member must not stop the others
            yield info.filename, 0, None, BAD_MEMBER
            continue
        for index, frame, error in split_run(content):
            yield info.filename, index, frame, error


def split_frames(df: DataFrame, body: str = "body", archive: bool = True) -> DataFrame:
    """One row per frame of every body: the input columns but the body, and ``member, idx, frame, error``."""
    kept = [c for c in df.columns if c != body]
    schema = T.StructType([df.schema[c] for c in kept] + list(T.StructType.fromDDL(FRAME)))
    target = arrow_schema(schema)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(batch.schema.get_field_index(body))
            others = batch.select(kept)
            source, rows, size = [], [], 0
            for i in range(batch.num_rows):
                content = bodies[i].as_py()
                for row in split_body(content or b"", archive):
                    source.append(i)
                    rows.append(row)
                    size += len(row[2] or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield _frame_batch(others, source, rows, target)
                        source, rows, size = [], [], 0
            if rows:
                yield _frame_batch(others, source, rows, target)

    return df.select(*kept, body).mapInArrow(split, schema)


def _frame_batch(others: pa.RecordBatch, source: list[int], rows: list[tuple], target: pa.Schema) -> pa.RecordBatch:
    arrays = list(others.take(pa.array(source)).columns)
    arrays += [pa.array([r[k] for r in rows]) for k in range(4)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target)], schema=target)


def read_bundles(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Frames of bundle files: ``path, member, idx, frame, error``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return split_frames(reader.load(path).select("path", F.col("content").alias("body")))


def read_event_logs(spark: SparkSession, path: str) -> DataFrame:
    """Frames of saved event logs, ``*.log`` or gzipped ``*.log.gz``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.filter(F.col("path").rlike(r"\.log(\.gz)?$")).select("path", F.col("content").alias("body"))
    schema, files = files.schema, files.withColumn("zipped", is_gzip(F.col("body")))

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [gzip.decompress(b) if z else b for b, z in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], names=["path", "body"])

    return split_frames(files.mapInArrow(unzip, schema), archive=False)


def _structs(messages: list, kind: pa.StructType) -> pa.StructArray:
    """Decoded messages as structs, built field by field; absent fields are NULL."""
    return pa.StructArray.from_arrays([_column(messages, f.name, f.type) for f in kind], fields=list(kind))


def _column(messages: list, name: str, kind: pa.DataType) -> pa.Array:
    if pa.types.is_list(kind):
        lists = [getattr(m, name) for m in messages]
        size = np.array([len(x) for x in lists], np.int32)
        ends = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
        items = _structs([x for items in lists for x in items], kind.value_type)
        return pa.ListArray.from_arrays(ends, items, type=kind, mask=pa.array(size == 0))
    if pa.types.is_struct(kind):
        there = np.array([m.HasField(name) for m in messages], bool)
        return _placed([getattr(messages[i], name) for i in np.flatnonzero(there)], there, kind)
    values = [getattr(m, name) if m.HasField(name) else None for m in messages]
    return pa.array(values, pa.uint64()).cast(kind) if pa.types.is_decimal(kind) else pa.array(values, kind)


def _placed(messages: list, there: np.ndarray, kind: pa.StructType) -> pa.Array:
    """Structs of the messages in the places that are ``there``, NULL in the others."""
    if not messages:
        return pa.nulls(len(there), kind)
    found = _structs(messages, kind)
    return found if there.all() else found.take(pa.array(np.cumsum(there) - 1, mask=~there))


def decode_frames(df: DataFrame, frame: str = "frame") -> DataFrame:
    """Frames to sensor messages: the other input columns, one column per message part, and ``error``.

    A frame that cannot be decoded or lacks a required field becomes an error row; the job goes on.
    """
    kept = [c for c in df.columns if c not in (frame, "error")]
    parts = spark_type()
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("error", T.StringType())] + list(parts))
    target, part_types = arrow_schema(schema), arrow_schema(parts)
    rows = df if "error" in df.columns else df.withColumn("error", F.lit(None).cast("string"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from google.protobuf.message import DecodeError

        event, whole = message_class(), pa.struct(list(part_types))
        for batch in batches:
            messages, errors, there = [], batch.column(len(kept) + 1).to_pylist(), np.zeros(batch.num_rows, bool)
            for row, raw in enumerate(batch.column(len(kept)).to_pylist()):
                if errors[row] is None:
                    try:
                        message = event.FromString(raw)
                        if message.IsInitialized():
                            messages.append(message)
                            there[row] = True
                        else:
                            errors[row] = UNDECODABLE
                    except (DecodeError, TypeError):
                        errors[row] = UNDECODABLE
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(errors, pa.string())]
            arrays += _placed(messages, there, whole).flatten()
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target)], schema=target)

    return rows.select(*kept, frame, "error").mapInArrow(decode, schema)


def _fill(messages: list, values: pa.StructArray) -> None:
    """Set the fields of messages, column by column; NULLs are left out."""
    for field, column in zip(values.type, values.flatten()):
        name, some = field.name, messages
        if column.null_count:
            some = [messages[i] for i in np.flatnonzero(column.is_valid())]
            column = column.drop_null()
        if not some:
            continue
        if pa.types.is_struct(field.type):
            inner = [getattr(m, name) for m in some]
            for m in inner:
                m.SetInParent()
            _fill(inner, column)
        elif pa.types.is_list(field.type):
            items = column.flatten()
            if items.null_count:
                raise ValueError(f"{name}: a message has no NULL entries")
            _fill([getattr(m, name).add() for m, n in zip(some, column.value_lengths().to_pylist()) for _ in range(n)], items)
        else:
            column = column.cast(pa.uint64()) if pa.types.is_decimal(field.type) else column
            for m, value in zip(some, column.to_numpy(zero_copy_only=False).tolist()):
                setattr(m, name, value)


def encode_frames(df: DataFrame, out: str = "frame") -> DataFrame:
    """Sensor messages back to frames, for replay: the other input columns and the frame's bytes."""
    parts = spark_type()
    kept = [c for c in df.columns if c not in parts.names]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.BinaryType())])
    target = arrow_schema(schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        event = message_class()
        for batch in batches:
            messages = [event() for _ in range(batch.num_rows)]
            _fill(messages, batch.select(parts.names).to_struct_array())
            frames = [m.SerializePartialToString() for m in messages]
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(frames, pa.binary())]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target)], schema=target)

    return df.select(*kept, *parts.names).mapInArrow(encode, schema)


def pack_run(df: DataFrame, keys: list[str], order: str, frame: str = "frame", out: str = "body") -> DataFrame:
    """Frames of each key, in order, as one run. The key must be small enough for one message, as on the bus."""
    n = F.octet_length(frame)
    length = F.unhex(F.concat(*[F.lpad(F.hex(F.shiftright(n, s).bitwiseAND(255)), 2, "0") for s in (0, 8, 16, 24)]))
    piece = F.struct(order, F.hex(F.concat(length, F.col(frame))).alias("hex"))
    pieces = F.array_sort(F.collect_list(piece))
    return df.groupBy(*keys).agg(F.unhex(F.array_join(F.transform(pieces, lambda p: p["hex"]), "")).alias(out))
