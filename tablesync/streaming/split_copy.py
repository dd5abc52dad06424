"""Copies of files in parts, with proof of content (F2).

A file is cut into byte ranges of at most ``PART_BYTES``, so one large file is
copied by many tasks and many small files by few.  Each task reads its range,
writes it, reads it back from the target and compares; it returns the range's
CRC-32.  The whole file's CRC-32 follows from those of its ranges, in order:
appending ``n`` bytes to a message acts on its CRC as a matrix over GF(2), so
``crc(a + b)`` is that matrix for ``len(b)`` times ``crc(a)``, plus ``crc(b)``.

On mounted file systems ranges are written into one hidden file, each at its
place; elsewhere they are files of their own that one task strings together on
the target's side, comparing the CRC again.  Either way a file appears under its name only
when all its ranges are there and agree, by one move.  A task that is run again
writes the same bytes to the same place.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from functools import lru_cache
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.sources import storage

#: Bytes that one task copies, and that it holds at once.
PART_BYTES, CHUNK = 128 << 20, 4 << 20
#: Tasks of one batch of files at most; beyond it a task gets several ranges.
MOST_TASKS = 10_000

#: Schemes of Hadoop's file systems whose name differs in Arrow.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}

PART_SCHEMA = "path string, length long, modificationTime timestamp, part long, size long, crc long, error string"
COPY_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("source_path", T.StringType()),
        T.StructField("target_path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("file_modification_time", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("crc32", T.LongType()),
    ]
)


# ------------------------------------------------------------------ checksums
#: Fixed value: the polynomial of CRC-32, bits reversed.
POLYNOMIAL = 0xEDB88320


def _times(matrix: tuple[int, ...], vector: int) -> int:
    out, at = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[at]
        vector >>= 1
        at += 1
    return out


def _product(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(_times(a, column) for column in b)


@lru_cache(maxsize=256)
def appended(size: int) -> tuple[int, ...]:
    """The matrix by which ``size`` zero bytes act on a CRC (columns as integers)."""
    # one zero bit: shift, and the polynomial for the bit that falls out
    power = (POLYNOMIAL, *[1 << i for i in range(31)])
    out = tuple(1 << i for i in range(32))
    bits = 8 * size
    while bits:
        if bits & 1:
            out = _product(power, out)
        power = _product(power, power)
        bits >>= 1
    return out


def combined(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of a whole from (size, CRC-32) of its parts in order."""
    crc = 0
    for size, one in parts:
        crc = _times(appended(size), crc) ^ one
    return crc


# ------------------------------------------------------------------ files
def strip_scheme(p: str) -> str:
    p = p[5:] if p.startswith("file:") and not p.startswith("file://") else p
    return p[len("file://") :] if p.startswith("file://") else p


def arrow_fs(uri: str):
    """The file system of a URI, and the path in it."""
    import pyarrow.fs as pafs

    u = strip_scheme(uri)
    if u.startswith("/"):
        return pafs.LocalFileSystem(), u
    scheme, rest = u.split("://", 1)
    return pafs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}://{rest}")


def target_of(path: str, src_root: str, dst_root: str) -> str:
    """Where a file goes: its path relative to the source root, below the target root."""
    own, root = strip_scheme(path), strip_scheme(src_root).rstrip("/") + "/"
    return dst_root.rstrip("/") + "/" + (own[len(root) :] if own.startswith(root) else own.rsplit("/", 1)[-1])


def _hidden(target: str, token: str) -> str:
    folder = target.rsplit("/", 1)[0]
    return f"{folder}/.tablesync-{token}-{hashlib.sha256(target.encode()).hexdigest()[:32]}.tmp"


def _mounted(target: str) -> bool:
    return strip_scheme(target).startswith("/")


def _ranges(reader, size: int) -> Iterator[bytes]:
    while size:
        chunk = reader.read(min(size, CHUNK))
        if not chunk:
            raise OSError("the file ends before its listed length")
        size -= len(chunk)
        yield bytes(chunk)


def _copy_part(path: str, target: str, token: str, part: int, offset: int, size: int) -> int:
    """Copy one byte range; its CRC-32, read and written alike."""
    sfs, sp = arrow_fs(path)
    tfs, aside = arrow_fs(_hidden(target, token))
    crc = back = 0
    tfs.create_dir(aside.rsplit("/", 1)[0], recursive=True)
    with sfs.open_input_file(sp) as reader:
        reader.seek(offset)
        if _mounted(target):
            handle = os.open(aside, os.O_RDWR | os.O_CREAT, 0o644)
            try:
                at = offset
                for chunk in _ranges(reader, size):
                    crc = zlib.crc32(chunk, crc)
                    view = memoryview(chunk)
                    while view:
                        done = os.pwrite(handle, view, at)
                        view, at = view[done:], at + done
                os.fsync(handle)
            finally:
                os.close(handle)
        else:
            aside = f"{aside}.{part:08d}"
            with tfs.open_output_stream(aside) as out:
                for chunk in _ranges(reader, size):
                    crc = zlib.crc32(chunk, crc)
                    out.write(chunk)
    with tfs.open_input_file(aside) as reader:
        reader.seek(offset if _mounted(target) else 0)
        for chunk in _ranges(reader, size):
            back = zlib.crc32(chunk, back)
    if back != crc:
        raise OSError("what arrived differs from what was read")
    return crc


def _assemble(target: str, token: str, length: int, parts: list[tuple[int, int]]) -> int:
    """Move a file whose ranges are all there into place; its CRC-32."""
    if sum(size for size, _ in parts) != length:
        raise OSError("parts are missing")
    crc = combined(parts)
    tfs, aside = arrow_fs(_hidden(target, token))
    _, final = arrow_fs(target)
    if not _mounted(target):
        whole = 0
        with tfs.open_output_stream(aside) as out:
            for part, (size, _) in enumerate(parts):
                with tfs.open_input_file(f"{aside}.{part:08d}") as reader:
                    for chunk in _ranges(reader, size):
                        whole = zlib.crc32(chunk, whole)
                        out.write(chunk)
        if whole != crc:
            raise OSError("the parts together differ from what was read")
        for part in range(len(parts)):
            tfs.delete_file(f"{aside}.{part:08d}")
    tfs.move(aside, final)
    return crc


def _ship_by_value() -> None:
    """Send this module's functions to the Python workers by value, so the
    executors need no installed copy of the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ------------------------------------------------------------------ as DataFrames
def file_parts(files: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``path, length, modificationTime`` with ``part, offset, size`` of each byte range; an empty file is one empty range."""
    last = F.greatest(F.ceil(F.col("length") / part_bytes) - 1, F.lit(0)).cast("long")
    parts = files.select("path", "length", "modificationTime", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    offset = F.col("part") * part_bytes
    return parts.withColumn("offset", offset).withColumn("size", F.least(F.lit(part_bytes).cast("long"), F.col("length") - offset))


def copy_files(files: DataFrame, src_root: str, dst_root: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Copy the files of a (batch) DataFrame in parts; one row a file with its
    CRC-32, or with the reason why it isn't at its target.  The copies are made by this call."""
    _ship_by_value()
    token = uuid.uuid4().hex
    n = files.agg(F.sum(F.greatest(F.ceil(F.col("length") / part_bytes), F.lit(1))).alias("n")).first()["n"]
    tasks = int(min(n or 1, MOST_TASKS))

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                crc, error = None, None
                try:
                    crc = _copy_part(r.path, target_of(r.path, src_root, dst_root), token, int(r.part), int(r.offset), int(r.size))
                except Exception as e:  # noqa: BLE001 - one bad file must not fail the batch
                    error = f"{type(e).__name__}: {e}"
                out.append((r.path, r.length, r.modificationTime, r.part, r.size, crc, error))
            made = pd.DataFrame(out, columns=["path", "length", "modificationTime", "part", "size", "crc", "error"])
            yield made.astype({"crc": "Int64"})

    # ranges are of one size, so an even deal of them is an even deal of bytes; a
    # partition number of its own for each range keeps hashing from piling them up
    dealt = file_parts(files, part_bytes).repartition(tasks)
    parts = storage.held(dealt.mapInPandas(copy, PART_SCHEMA), "copied-parts")

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                target, crc, error = target_of(r.path, src_root, dst_root), None, r.error
                if error is None:
                    try:
                        crc = _assemble(target, token, int(r.length), [(int(p["size"]), int(p["crc"])) for p in r.parts])
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                out.append((r.path, target, r.length, r.modificationTime, "success" if error is None else "error", error, crc))
            yield pd.DataFrame(out, columns=[f.name for f in COPY_RESULT_SCHEMA.fields]).astype({"crc32": "Int64"})

    # a list a file: 80 bytes for each PART_BYTES of it
    whole = parts.groupBy("path", "length", "modificationTime").agg(F.sort_array(F.collect_list(F.struct("part", "size", "crc"))).alias("parts"), F.min("error").alias("error"))
    return storage.held(whole.mapInPandas(assemble, COPY_RESULT_SCHEMA), "copied-files")
