"""Incremental sync as a stream of versioned changes.

A change is a row of the table with its version, a delete flag and the time it
was made.  Changes come in any order, repeated and late; for each key a stateful
operator remembers the newest one it let through, and passes on only what is
newer.  Before the shuffle each Arrow batch keeps its newest change of a key, so a
key with a third of all changes sends one row a batch.  The state of a live key is its version alone, never the row; a deleted
key's is dropped by a timer once the watermark has passed its delete, because
changes older than the watermark are dropped before they get there.

What passes is appended to a folder (exactly once, by the file sink's log), and
:func:`latest_rows` reads the table out of it: any order of arrival within the
delay gives what ``max_by`` over all changes gives.

Defined cases: changes of one version are ordered by their delete flag and then
by a digest of their values, so ties are settled alike in any order; null keys are
a key; a change without a version or time is refused before the state (it can't be
ordered); map values are compared as sorted entries.
"""

from __future__ import annotations

from typing import Any, Iterator, Mapping, Optional, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tablesync.functions.columns import comparable

VERSION, DELETED, CHANGED_AT, DIGEST = "_version", "_deleted", "_changed_at", "_digest"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestChange(StatefulProcessor):
    """Lets a key's change through if it is newer than all before it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "version long, deleted boolean, digest long, expires long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        order = lambda r: (r[VERSION], r[DELETED], r[DIGEST])
        best = max(rows, key=order, default=None)
        held = self.newest.get() if self.newest.exists() else None
        if best is None or (held is not None and order(best) <= tuple(held[:3])):
            return
        if held is not None and held[3] is not None:
            self.handle.deleteTimer(held[3])
        expires = None
        if best[DELETED]:
            expires = best["_changed_ms"] + 1
            self.handle.registerTimer(expires)
        self.newest.update((*order(best), expires))
        yield best

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def _digest(df: DataFrame, keys: Sequence[str]) -> Column:
    values = [comparable(df, c) for c in df.columns if c not in (*keys, VERSION, DELETED, CHANGED_AT)]
    # the hash passes over nulls, so where they are is hashed too
    return F.xxhash64(*values, F.array(*[v.isNull() for v in values])) if values else F.lit(0).cast("long")


def _newest_of_batches(keys: Sequence[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            order = pc.sort_indices(b, [(VERSION, "ascending"), (DELETED, "ascending"), (DIGEST, "ascending")])
            by_key = pa.table([b.column(k).take(order) for k in keys] + [pa.array(range(len(order)), pa.int64())], names=[*map(str, range(len(keys))), "place"])
            last = by_key.group_by([*map(str, range(len(keys)))]).aggregate([("place", "max")]).column("place_max").combine_chunks()
            yield b.take(order.take(last))

    return work


def newest_changes(changes: DataFrame, keys: Sequence[str], delay: str) -> DataFrame:
    """The stream of ``changes`` without those older than one already seen."""
    ms = F.unix_millis(F.col(CHANGED_AT).cast("timestamp"))
    rows = changes.where(f"{VERSION} is not null and {CHANGED_AT} is not null").withColumns({
        VERSION: F.col(VERSION).cast("long"), DELETED: F.coalesce(F.col(DELETED), F.lit(False)),
        CHANGED_AT: F.col(CHANGED_AT).cast("timestamp"), DIGEST: _digest(changes, keys), "_changed_ms": ms,
    })
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    rows = rows.mapInArrow(_newest_of_batches(keys), schema).withWatermark(CHANGED_AT, delay)
    return rows.groupBy(*keys).transformWithState(NewestChange(), schema, "append", "EventTime").drop("_changed_ms")


def latest_rows(accepted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table that accepted changes (or any others) add up to."""
    values = [c for c in accepted.columns if c not in (*keys, VERSION, DELETED, CHANGED_AT, DIGEST)]
    newest = accepted.groupBy(*keys).agg(F.max_by(F.struct(F.col(DELETED).alias("gone"), F.struct(*values).alias("row")), F.struct(VERSION, DELETED, DIGEST)).alias("newest"))
    return newest.where("not newest.gone").select(*keys, *[F.col("newest.row")[c].alias(c) for c in values])


def with_digest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A batch of changes in the form that :func:`latest_rows` reads."""
    return changes.where(f"{VERSION} is not null and {CHANGED_AT} is not null").withColumns({
        VERSION: F.col(VERSION).cast("long"), DELETED: F.coalesce(F.col(DELETED), F.lit(False)), DIGEST: _digest(changes, keys)})


def sync_change_stream(
    spark: SparkSession, source_dir: str, schema: T.StructType, keys: Sequence[str], target_dir: str, checkpoint: str,
    delay: str = "1 day", options: Optional[Mapping[str, str]] = None, timeout_seconds: Optional[float] = None,
) -> DataFrame:
    """Take in the Parquet changes that arrived in ``source_dir`` since the last
    call, and return the table as of now.  The settings of the state store are
    those of a session of its own; the caller's stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    stream = own.readStream.schema(schema).options(**(options or {})).parquet(source_dir)
    query = (
        newest_changes(stream, keys, delay).writeStream.format("parquet").option("path", target_dir)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"change stream of {source_dir} still ran after {timeout_seconds} s")
    return latest_rows(spark.read.parquet(target_dir), keys)
