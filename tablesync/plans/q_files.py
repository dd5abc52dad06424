"""Registered file-stream queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.plans.registry import query
from tablesync.session import apply_defaults, work_dir
from tablesync.sources.tables import load
from tablesync.streaming import file_copy as FC


#: Tables whose copies are read back, with a key to sum.
_COPIED = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
    "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "pages": "page_id", "documents": "doc_id",
    "embeddings": "vec_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}


def _copied(spark: SparkSession, sf: str) -> FC.VolumeCopy:
    """Copy every data file of the folder with the checkpointed stream, and run
    it a second time (nothing new)."""
    root = work_dir(spark, "file_copy")
    cfg = FC.VolumeCopy(source_root=sf, target_root=root + "/target", log_path=root + "/log", checkpoint_root=root + "/checkpoints",
                        options={"pathGlobFilter": "*.parquet", "maxFilesPerTrigger": 4}, timeout_seconds=600, volume="tables", part_bytes=1 << 20)
    FC.copy_volume(spark, cfg, run_id="r1")
    FC.copy_volume(spark, cfg, run_id="r2")
    return cfg


@query("file_copy_stream", oracle=" union all ".join(f"select '{t}' as table_name, count(*) as n, cast(sum({k}) as bigint) as key_sum from {t}" for t, k in _COPIED.items()))
def file_copy_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and key sums of the copied tables, read back from the target."""
    apply_defaults(spark)
    cfg = _copied(spark, sf)
    out = None
    for table, key in _COPIED.items():
        one = spark.read.parquet(f"{cfg.target_root}/{table}.parquet").agg(F.count(F.lit(1)).alias("n"), F.sum(key).cast("long").alias("key_sum"))
        one = one.select(F.lit(table).alias("table_name"), "n", "key_sum")
        out = one if out is None else out.unionByName(one)
    return out


@query("file_copy_log", oracle=" union all ".join(f"select 'r1' as run_id, 'tables' as volume, '{t}.parquet' as file_name, 'success' as status, true as has_checksum" for t in _COPIED))
def file_copy_log(spark: SparkSession, sf: str) -> DataFrame:
    """The per-file log of the stream; the second run found nothing new."""
    apply_defaults(spark)
    log = FC.read_log(spark, _copied(spark, sf).log_path)
    return log.select("run_id", "volume", F.regexp_extract("source_path", r"([^/]+)$", 1).alias("file_name"), "status", F.col("crc32").isNotNull().alias("has_checksum"))


@query(
    "copy_stats_stream",
    oracle=f"select 'r1' as run_id, 'tables' as volume, cast({len(_COPIED)} as bigint) as total_files, cast(0 as bigint) as error_files, cast(100.0 as double) as success_rate, 'success' as status",
)
def copy_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Copy statistics of the log that the stream wrote."""
    apply_defaults(spark)
    return FC.copy_stats(FC.read_log(spark, _copied(spark, sf).log_path))


_LOG_SQL = """
select 'run_' || cast(event_id % 3 as varchar) as run_id, 'vol_' || cast(user_id % 5 as varchar) as volume,
       case when event_type = 'error' then 'error' else 'success' end as status
from events
"""


@query(
    "copy_stats",
    oracle=f"""
select run_id, volume, count(*) as total_files, count(*) filter (where status <> 'success') as error_files,
       round(coalesce((count(*) - count(*) filter (where status <> 'success')) * 100.0 / count(*), 0.0), 6) as success_rate,
       case when count(*) filter (where status <> 'success') = 0 then 'success'
            when count(*) filter (where status <> 'success') < count(*) then 'partial' else 'failed' end as status
from ({_LOG_SQL}) group by run_id, volume
""",
)
def copy_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Copy statistics over a file log whose rows come from ``events``
    (one event = one file; ``error`` events failed to copy)."""
    apply_defaults(spark)
    e = load(spark, sf, "events")
    log = e.select(
        F.concat(F.lit("run_"), (F.col("event_id") % 3).cast("string")).alias("run_id"),
        F.concat(F.lit("vol_"), (F.col("user_id") % 5).cast("string")).alias("volume"),
        F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("success")).alias("status"),
    )
    return FC.copy_stats(log)


@query("event_stream_append", oracle="select * from events")
def event_stream_append(spark: SparkSession, sf: str) -> DataFrame:
    """Stream the events table into a target folder with a checkpointed
    ``availableNow`` query, run it twice, read the target back."""
    apply_defaults(spark)
    root = work_dir(spark, "event_stream")
    schema = load(spark, sf, "events").schema
    for _ in range(2):
        stream = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", "events.parquet").load(sf)
        q = (
            stream.writeStream.format("parquet").option("path", root + "/target").option("checkpointLocation", root + "/checkpoint")
            .trigger(availableNow=True).start()
        )
        FC.drain(q, 600)
    return spark.read.parquet(root + "/target")
