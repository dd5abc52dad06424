"""Summaries over many runs from stored sketches (A2, A3).

Each run leaves a few rows, one for each operation type: counts by status,
HyperLogLog sketches of its catalogs, schemas and objects, and the durations
counted in buckets.  Summaries over any runs add these up and never read audit
rows again, so their cost follows the number of runs, not of operations; and
a run whose sketches are added twice by mistake changes no distinct count.

Distinct counts are exact while few (below about a hundred values) and have a
relative deviation of 0.8 % beyond; quantiles of durations are right within 1 %.
All merges are sums or unions, so their order doesn't matter.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Logarithm of a distinct sketch's registers; ratio of a duration bucket's ends.
LOG_REGISTERS, GROWTH = 14, 1.02
STATUSES = {"success": "successful", "failed": "failed", "skipped": "skipped"}
_NONE = -(1 << 31)


def sketch_counts(audit: DataFrame, by: Sequence[str] = ("run_id", "operation_type")) -> DataFrame:
    """Counts by status and distinct sketches of audit rows, one row a run and operation type."""
    c, s, o = F.col("catalog_name"), F.col("schema_name"), F.col("object_name")
    names = {"catalogs": c, "schemas": F.when(s.isNotNull(), F.concat_ws(".", c, s)), "objects": F.when(o.isNotNull(), F.concat_ws(".", c, s, o))}
    return audit.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == k).alias(v) for k, v in STATUSES.items()],
        *[F.hll_sketch_agg(name, F.lit(LOG_REGISTERS)).alias(k) for k, name in names.items()],
    )


def sketch_durations(audit: DataFrame, by: Sequence[str] = ("run_id", "operation_type")) -> DataFrame:
    """How many operations took how long: ``n`` a bucket (null durations take no part)."""
    d = F.col("duration_seconds")
    bucket = F.when(d > 0, F.ceil(F.log(d) / F.log(F.lit(GROWTH))).cast("int")).otherwise(_NONE)
    return audit.where(d.isNotNull()).groupBy(*by, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge_counts(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches added up over all but ``by``."""
    return sketches.groupBy(*by).agg(
        *[F.sum(c).cast("long").alias(c) for c in ("total", *STATUSES.values())], *[F.hll_union_agg(c).alias(c) for c in ("catalogs", "schemas", "objects")]
    )


def summarize(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts, distinct counts and success rate of all runs in ``sketches``."""
    m = merge_counts(sketches, by)
    rate = F.round(F.coalesce(F.try_divide(F.col("successful") * 100.0, F.col("total")), F.lit(0.0)), 6)
    return m.select(*by, "total", *STATUSES.values(), *[F.hll_sketch_estimate(c).alias(c) for c in ("catalogs", "schemas", "objects")], rate.alias("success_rate"))


def duration_quantiles(durations: DataFrame, by: Sequence[str], at: dict[str, float]) -> DataFrame:
    """Quantiles of the durations of all runs in ``durations``."""
    merged = durations.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    whole = W.partitionBy(*by)  # a few thousand buckets at most
    upto = F.sum("n").over(whole.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    ranked = merged.withColumns({"upto": upto, "rows": F.sum("n").over(whole)})
    middle = F.when(F.col("bucket") > _NONE, 2 * F.pow(F.lit(GROWTH), F.col("bucket")) / (GROWTH + 1)).otherwise(0.0)
    return ranked.groupBy(*by).agg(*[F.min(F.when(F.col("upto") >= F.ceil(q * F.col("rows")), F.struct("bucket", middle.alias("v"))))["v"].alias(name) for name, q in at.items()])
