"""Incremental file copy as a checkpointed Structured Streaming query.

* F1 ``file_stream``: a ``binaryFile`` stream that keeps path, length and
  modification time; the ``content`` column is pruned, so no file bytes
  flow through Spark rows.
* F2 ``copy_batch``: the executors copy each new file in byte ranges
  (:mod:`tablesync.streaming.split_copy`) with ``pyarrow.fs`` (local, HDFS, S3,
  GCS...), keeping its path relative to the source root; one ok / error row per
  file, with the file's CRC-32.  Nothing is collected to the driver.
* F3 the per-file log is appended once per micro-batch; a replayed batch is
  idempotent because readers de-duplicate on ``(run_id, batch_id,
  source_path)``.
* F4 ``drain``: ``availableNow`` trigger with a timeout; the checkpoint
  remembers which files were seen, so a re-run copies only new files.
* F5 reload modes and sub-folder scope, F6 copy statistics, F7 file options.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablesync.sources import storage
from tablesync.streaming.split_copy import PART_BYTES, copy_files

BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)

LOG_COLUMNS = ["run_id", "volume", "source_path", "target_path", "ingestion_time", "length", "file_modification_time", "status", "error_msg", "batch_id", "crc32"]


# ------------------------------------------------------------------ F1 / F7
def file_stream(spark: SparkSession, path: str, options: Optional[dict] = None, modified_after: Optional[str] = None) -> DataFrame:
    """New files under ``path`` as a stream of (path, modificationTime, length)."""
    opts = {"recursiveFileLookup": "true"}
    opts.update({k: str(v) for k, v in (options or {}).items()})
    df = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).options(**opts).load(path)
    df = df.select("path", "modificationTime", "length")
    if modified_after:
        df = df.where(F.col("modificationTime") >= F.lit(modified_after).cast("timestamp"))
    return df


# ------------------------------------------------------------------ F2
def copy_batch(files: DataFrame, src_root: str, dst_root: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Copy the files of a (batch) DataFrame on the executors, large ones in parts."""
    return copy_files(files.select("path", "modificationTime", "length"), src_root, dst_root, part_bytes)


# ------------------------------------------------------------------ F3
LOG_SCHEMA = T.StructType(
    [
        T.StructField(c, {"ingestion_time": T.TimestampType(), "file_modification_time": T.TimestampType(), "length": T.LongType(), "crc32": T.LongType()}.get(c, T.StringType()))
        for c in LOG_COLUMNS
    ]
)


def log_rows(results: DataFrame, run_id: str, batch_id: int, volume: str) -> DataFrame:
    return results.select(
        F.lit(run_id).alias("run_id"), F.lit(volume).alias("volume"), "source_path", "target_path", F.current_timestamp().alias("ingestion_time"),
        "length", "file_modification_time", "status", "error_msg", F.lit(str(batch_id)).alias("batch_id"), "crc32",
    )


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The file log (``LOG_SCHEMA``), with replayed batches counted once."""
    if not storage.exists(spark, log_path):
        return spark.createDataFrame([], LOG_SCHEMA)
    log = spark.read.schema(LOG_SCHEMA).parquet(log_path)
    keys = ["run_id", "volume", "batch_id", "source_path"]
    rest = [c for c in LOG_COLUMNS if c not in keys]
    # a batch that ran again: the last outcome counts
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("ingestion_time")).alias("_last"))
    return last.select(*keys, "_last.*").select(*LOG_COLUMNS)


# ------------------------------------------------------------------ F4 / F5
@dataclass
class VolumeCopy:
    source_root: str
    target_root: str
    log_path: str
    checkpoint_root: str
    folder: Optional[str] = None
    mode: str = "incremental"  # incremental | rescan | reload
    options: Optional[dict] = None
    modified_after: Optional[str] = None
    timeout_seconds: float = 43200.0
    volume: Optional[str] = None  # name in the log; by default the last part of the source root
    part_bytes: int = PART_BYTES  # larger files are copied by several tasks

    @property
    def volume_name(self) -> str:
        return self.volume or self.source_root.rstrip("/").rsplit("/", 1)[-1]


def _checkpoint_for(cfg: VolumeCopy) -> str:
    scope = hashlib.sha256((cfg.folder or "").encode()).hexdigest()
    return f"{cfg.checkpoint_root.rstrip('/')}/{scope}"


def prepare(spark: SparkSession, cfg: VolumeCopy) -> str:
    """Apply the reload mode and return the checkpoint folder to use.

    rescan: forget which files were seen (fresh checkpoint).  reload: also
    delete the copied files of the scope.
    """
    ckpt = _checkpoint_for(cfg)
    if cfg.mode in ("rescan", "reload"):
        storage.delete(spark, ckpt)
    if cfg.mode == "reload":
        storage.delete(spark, _join(cfg.target_root, cfg.folder))
    return ckpt


def _join(root: str, folder: Optional[str]) -> str:
    return root.rstrip("/") + ("/" + folder.strip("/") if folder else "")


def start_copy(spark: SparkSession, cfg: VolumeCopy, run_id: str) -> StreamingQuery:
    ckpt = prepare(spark, cfg)
    src = _join(cfg.source_root, cfg.folder)
    dst = _join(cfg.target_root, cfg.folder)
    stream = file_stream(spark, src, cfg.options, cfg.modified_after)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        log_rows(copy_batch(batch, src, dst, cfg.part_bytes), run_id, batch_id, cfg.volume_name).write.mode("append").parquet(cfg.log_path)

    return stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start()


class DrainTimeout(TimeoutError):
    pass


def drain(query: StreamingQuery, timeout_seconds: float) -> None:
    """Wait for an ``availableNow`` query; past the timeout, stop it and fail."""
    finished = query.awaitTermination(timeout_seconds)
    if not finished:
        query.stop()
        raise DrainTimeout(f"stream did not finish within {timeout_seconds}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def copy_volume(spark: SparkSession, cfg: VolumeCopy, run_id: Optional[str] = None) -> str:
    """Copy every file not copied before; returns the run id."""
    rid = run_id or uuid.uuid4().hex
    drain(start_copy(spark, cfg, rid), cfg.timeout_seconds)
    return rid


# ------------------------------------------------------------------ F6
def copy_stats(log: DataFrame, keys: tuple[str, ...] = ("run_id", "volume")) -> DataFrame:
    """Files, errors and success rate per run and volume; an empty group
    has rate 0; status ``partial`` when some files failed."""
    g = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("status") != "success").alias("error_files"),
    )
    rate = F.coalesce(F.try_divide((F.col("total_files") - F.col("error_files")) * 100.0, F.col("total_files")), F.lit(0.0))
    return g.select(
        "*",
        F.round(rate, 6).alias("success_rate"),
        F.when(F.col("error_files") == 0, F.lit("success")).when(F.col("error_files") < F.col("total_files"), F.lit("partial")).otherwise(F.lit("failed")).alias("status"),
    )
