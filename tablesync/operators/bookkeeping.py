"""Run bookkeeping (A1-A3): audit rows, run summaries, status roll-ups."""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("logging_time", T.TimestampType()),
        T.StructField("operation_type", T.StringType()),
        T.StructField("catalog_name", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("object_name", T.StringType()),
        T.StructField("object_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("attempt_number", T.IntegerType()),
        T.StructField("max_attempts", T.IntegerType()),
        T.StructField("config_details", T.StringType()),
        T.StructField("execution_user", T.StringType()),
    ]
)


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))).cast("double") / 1e6


def audit_rows(results: DataFrame, config_details: Optional[Column] = None, user: Optional[str] = None) -> DataFrame:
    """Run results -> the 17 audit columns.

    ``duration_seconds`` is recomputed from the two timestamps; ``details``
    is kept as given when it is text, else serialised to JSON.
    """
    details = F.col("details") if dict(results.dtypes).get("details") == "string" else F.to_json("details")
    return results.select(
        F.col("run_id").cast("string"),
        F.current_timestamp().alias("logging_time"),
        "operation_type", "catalog_name", "schema_name", "object_name", "object_type", "status",
        F.col("start_time").cast("timestamp").alias("start_time"),
        F.col("end_time").cast("timestamp").alias("end_time"),
        seconds_between(F.col("start_time"), F.col("end_time")).alias("duration_seconds"),
        F.col("error_message").cast("string"),
        details.alias("details"),
        F.col("attempt_number").cast("int"),
        F.col("max_attempts").cast("int"),
        (config_details if config_details is not None else F.lit(None).cast("string")).alias("config_details"),
        (F.lit(user) if user else F.current_user()).alias("execution_user"),
    )


def append_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def run_summary(audit: DataFrame) -> DataFrame:
    """One row per run: counts by status, distinct catalogs / schemas /
    objects, success rate (skipped rows count in the denominator, as in the
    reference; ``rate_excluding_skipped`` does not) and the final status."""
    cat = F.col("catalog_name")
    sch = F.when(F.col("schema_name").isNotNull(), F.concat_ws(".", cat, F.col("schema_name")))
    obj = F.when(F.col("object_name").isNotNull(), F.concat_ws(".", cat, F.col("schema_name"), F.col("object_name")))
    g = audit.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_operations"),
        F.count_if(F.col("status") == "success").alias("successful_operations"),
        F.count_if(F.col("status") == "failed").alias("failed_operations"),
        F.count_if(F.col("status") == "skipped").alias("skipped_operations"),
        F.countDistinct(cat).alias("total_catalogs"),
        F.countDistinct(sch).alias("total_schemas"),
        F.countDistinct(obj).alias("total_tables"),
    )
    rate = F.when(F.col("total_operations") > 0, F.col("successful_operations") * 100.0 / F.col("total_operations")).otherwise(F.lit(0.0))
    ran = F.col("total_operations") - F.col("skipped_operations")
    rate_x = F.when(ran > 0, F.col("successful_operations") * 100.0 / ran).otherwise(F.lit(0.0))
    return g.select(
        "*",
        F.round(rate, 6).alias("success_rate"),
        F.round(rate_x, 6).alias("rate_excluding_skipped"),
        F.when(F.col("failed_operations") == 0, F.lit("completed")).otherwise(F.lit("completed_with_failures")).alias("status"),
    )


def run_periods(audit: DataFrame) -> DataFrame:
    """One row per run: first start, last end, seconds between, and the summary text."""
    g = audit.groupBy("run_id").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("status") == "success").alias("_ok"), F.count_if(F.col("status") == "failed").alias("_failed"), F.count_if(F.col("status") == "skipped").alias("_skipped"),
    )
    text = F.format_string("%d operations: %d succeeded, %d failed, %d skipped", "_n", "_ok", "_failed", "_skipped")
    return g.select("run_id", "start_time", "end_time", seconds_between(F.col("start_time"), F.col("end_time")).alias("duration_seconds"), text.alias("summary"))


def rollup_status(audit: DataFrame, keys: Sequence[str], rollup: bool = False) -> DataFrame:
    """Success / failed / skipped counts per key level (with subtotals when
    ``rollup``)."""
    g = audit.rollup(*keys) if rollup else audit.groupBy(*keys)
    return g.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
    )
