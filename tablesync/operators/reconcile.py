"""Reconciliation of a source and a target table.

Three checks, each a Spark plan over whole tables:

* :func:`schema_diff`      - column lists joined by name, labelled.
* :func:`row_count_check`  - counts of many table pairs in one job.
* :func:`missing_rows`     - rows present on one side only, exact and
  null-safe, duplicates reported one by one.

Missing rows are found with ONE shuffle: both sides are tagged, unioned and
grouped by all compared columns.  The partial (map-side) aggregation folds
duplicate rows before the exchange, so a value that holds a third of the
table costs one row per map task, not a third of the shuffle.  Equality is on
values (no 32-bit hash as key), so hash collisions cannot hide rows.  Rows
that must be reported many times are re-expanded in bounded chunks that are
spread over tasks, never inside one task.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from typing import Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import comparable, evidence_map, original

MISSING_IN_TARGET = "missing_in_target"
MISSING_IN_SOURCE = "missing_in_source"
# rows re-expanded per task for a value reported many times
EXPAND_CHUNK = 1 << 16


# --------------------------------------------------------------------------- R5 / R6
def apply_filter(df: DataFrame, expr: Optional[str]) -> DataFrame:
    """Restrict a table by a SQL predicate (pushed into the scan by Catalyst)."""
    return df.where(expr) if expr else df


def common_columns(source: DataFrame, target: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns present on both sides, in source order, minus exclusions.

    Names compare case-insensitively, as catalogs store them lower-cased.
    """
    tnames = {c.lower() for c in target.columns}
    excl = {e.lower() for e in exclude}
    return [c for c in source.columns if c.lower() in tnames and c.lower() not in excl]


class NoCommonColumns(ValueError):
    pass


# --------------------------------------------------------------------------- R3 core
def presence(
    source: DataFrame,
    target: DataFrame,
    exclude: Iterable[str] = (),
    source_filter: Optional[str] = None,
    target_filter: Optional[str] = None,
) -> tuple[DataFrame, list[str]]:
    """Distinct compared rows with their multiplicity on each side.

    Returns ``(df, cols)``; ``df`` has the compared columns plus
    ``source_count`` and ``target_count`` (bigint).  One shuffle on all
    compared columns, with map-side combine.
    """
    cols = common_columns(source, target, exclude)
    if not cols:
        raise NoCommonColumns("no common columns between source and target after exclusions")
    s = apply_filter(source, source_filter)
    t = apply_filter(target, target_filter)
    tgt_names = {c.lower(): c for c in t.columns}
    s_side = s.select(*[comparable(s, c) for c in cols], F.lit(1).alias("_s"), F.lit(0).alias("_t"))
    t_side = t.select(
        *[comparable(t, tgt_names[c.lower()]).alias(c) for c in cols], F.lit(0).alias("_s"), F.lit(1).alias("_t")
    )
    grouped = (
        s_side.unionByName(t_side)
        .groupBy(*[F.col(f"`{c}`") for c in cols])
        .agg(F.sum("_s").cast("bigint").alias("source_count"), F.sum("_t").cast("bigint").alias("target_count"))
    )
    return grouped, cols


def presence_by_digest(
    source: DataFrame,
    target: DataFrame,
    exclude: Iterable[str] = (),
    source_filter: Optional[str] = None,
    target_filter: Optional[str] = None,
) -> DataFrame:
    """:func:`presence` for counts alone: rows are grouped by a digest of 128
    bits over every value and its null flag, so only 16 bytes a row cross the
    shuffle.  Two different rows fall together with a probability of about
    n^2 / 2^129 over n distinct rows."""
    cols = common_columns(source, target, exclude)
    if not cols:
        raise NoCommonColumns("no common columns between source and target after exclusions")
    names = {c.lower(): c for c in target.columns}

    def side(df: DataFrame, own: list[str], s: int, t: int) -> DataFrame:
        values = [comparable(df, c) for c in own] + [F.col(f"`{c}`").isNull() for c in own]
        return df.select(F.xxhash64(F.lit(1), *values).alias("_a"), F.xxhash64(F.lit(2), *values).alias("_b"), F.lit(s).alias("_s"), F.lit(t).alias("_t"))

    both = side(apply_filter(source, source_filter), cols, 1, 0).unionByName(side(apply_filter(target, target_filter), [names[c.lower()] for c in cols], 0, 1))
    return both.groupBy("_a", "_b").agg(F.sum("_s").cast("bigint").alias("source_count"), F.sum("_t").cast("bigint").alias("target_count"))


def _counts_of(method: str, *args) -> DataFrame:
    if method not in ("exact", "digest"):
        raise ValueError(f"method is exact or digest, not {method!r}")
    return presence(*args)[0] if method == "exact" else presence_by_digest(*args)


def expand_counts(df: DataFrame, count_col: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Repeat each row ``count_col`` times, keeping every task bounded.

    A row becomes one piece for each ``chunk`` copies (nearly always one
    piece), the pieces are spread over the tasks by AQE's rebalance, and each
    piece is repeated where it lands, so a value repeated a billion times is
    produced by many tasks.
    """
    n = F.col(count_col)
    pieces = (
        df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), ((n - 1) / chunk).cast("bigint"))))
        .withColumn("_k", F.least(F.lit(chunk).cast("bigint"), n - F.col("_chunk") * chunk).cast("int"))
        .hint("rebalance")
    )
    return pieces.withColumn("_rep", F.explode(F.array_repeat(F.lit(True), F.col("_k")))).drop("_rep", "_chunk", "_k")


def missing_rows(
    source: DataFrame,
    target: DataFrame,
    exclude: Iterable[str] = (),
    source_filter: Optional[str] = None,
    target_filter: Optional[str] = None,
    with_evidence: bool = False,
) -> DataFrame:
    """Rows of one side whose values do not occur on the other side.

    Set semantics, like the reference: a value present on both sides is
    never reported, whatever its multiplicity; a value present on one side
    only is reported once per copy.  Output: ``issue_type`` and the compared
    columns (plus ``data`` map<string,string> when ``with_evidence``).
    """
    grouped, cols = presence(source, target, exclude, source_filter, target_filter)
    one_sided = grouped.where((F.col("source_count") == 0) | (F.col("target_count") == 0)).select(
        F.when(F.col("target_count") == 0, F.lit(MISSING_IN_TARGET)).otherwise(F.lit(MISSING_IN_SOURCE)).alias("issue_type"),
        *[F.col(f"`{c}`") for c in cols],
        F.greatest("source_count", "target_count").alias("_n"),
    )
    out = expand_counts(one_sided, "_n").drop("_n")
    types = {c: source.schema[c].dataType for c in cols}
    out = out.select("issue_type", *[original(F.col(f"`{c}`"), types[c]).alias(c) for c in cols])
    if with_evidence:
        out = out.withColumn("data", evidence_map(cols))
    return out


def missing_rows_hash32(
    source: DataFrame,
    target: DataFrame,
    exclude: Iterable[str] = (),
    source_filter: Optional[str] = None,
    target_filter: Optional[str] = None,
) -> DataFrame:
    """The reference's matching rule, kept for comparison: rows match when
    their 32-bit ``hash`` of the common columns matches.  Collisions hide
    missing rows and nulls are skipped by the hash, so this is NOT exact;
    :func:`missing_rows` is.

    Plan: one shuffle of 4-byte hashes to find the hashes seen on one side
    only, then a semi join back to each side (AQE broadcasts the hash set
    when it is small).
    """
    cols = common_columns(source, target, exclude)
    if not cols:
        raise NoCommonColumns("no common columns between source and target after exclusions")
    s = apply_filter(source, source_filter).select(*[F.col(f"`{c}`") for c in cols])
    tnames = {c.lower(): c for c in target.columns}
    t = apply_filter(target, target_filter).select(*[F.col(f"`{tnames[c.lower()]}`").alias(c) for c in cols])
    h = F.hash(*[F.col(f"`{c}`") for c in cols])
    s, t = s.withColumn("_h", h), t.withColumn("_h", h)
    seen = (
        s.select("_h", F.lit(1).alias("_s"), F.lit(0).alias("_t"))
        .unionByName(t.select("_h", F.lit(0).alias("_s"), F.lit(1).alias("_t")))
        .groupBy("_h")
        .agg(F.max("_s").alias("_s"), F.max("_t").alias("_t"))
    )
    in_t = s.join(seen.where("_t = 0").select("_h"), "_h", "left_semi").select(F.lit(MISSING_IN_TARGET).alias("issue_type"), *cols)
    in_s = t.join(seen.where("_s = 0").select("_h"), "_h", "left_semi").select(F.lit(MISSING_IN_SOURCE).alias("issue_type"), *cols)
    return in_t.unionByName(in_s)


def multiset_diff(
    source: DataFrame,
    target: DataFrame,
    exclude: Iterable[str] = (),
    source_filter: Optional[str] = None,
    target_filter: Optional[str] = None,
) -> DataFrame:
    """Distinct rows whose copy counts differ, with signed difference.

    ``count_diff = source_count - target_count``; sees duplicates that set
    semantics hide.  Same single shuffle as :func:`missing_rows`.
    """
    grouped, cols = presence(source, target, exclude, source_filter, target_filter)
    return grouped.where(F.col("source_count") != F.col("target_count")).withColumn(
        "count_diff", F.col("source_count") - F.col("target_count")
    )


# --------------------------------------------------------------------------- R4
def missing_summary(
    source: DataFrame,
    target: DataFrame,
    exclude: Iterable[str] = (),
    source_filter: Optional[str] = None,
    target_filter: Optional[str] = None,
    method: str = "exact",
) -> DataFrame:
    """Missing-row counts per ``issue_type`` without materialising the rows;
    ``method="digest"`` shuffles digests instead of rows."""
    grouped = _counts_of(method, source, target, exclude, source_filter, target_filter)
    return (
        grouped.where((F.col("source_count") == 0) | (F.col("target_count") == 0))
        .select(
            F.when(F.col("target_count") == 0, F.lit(MISSING_IN_TARGET)).otherwise(F.lit(MISSING_IN_SOURCE)).alias("issue_type"),
            F.greatest("source_count", "target_count").alias("n"),
        )
        .groupBy("issue_type")
        .agg(F.sum("n").cast("bigint").alias("row_count"))
    )


def match_counts(
    source: DataFrame,
    target: DataFrame,
    exclude: Iterable[str] = (),
    source_filter: Optional[str] = None,
    target_filter: Optional[str] = None,
    method: str = "exact",
) -> DataFrame:
    """One row: ``source_count``, ``target_count`` and the missing counts in
    each direction, all from the single presence aggregate (one scan of each
    side, one shuffle)."""
    grouped = _counts_of(method, source, target, exclude, source_filter, target_filter)
    sc, tc = F.col("source_count"), F.col("target_count")
    return grouped.agg(
        F.coalesce(F.sum(sc), F.lit(0)).cast("bigint").alias("source_count"),
        F.coalesce(F.sum(tc), F.lit(0)).cast("bigint").alias("target_count"),
        F.coalesce(F.sum(F.when(tc == 0, sc)), F.lit(0)).cast("bigint").alias("missing_count"),
        F.coalesce(F.sum(F.when(sc == 0, tc)), F.lit(0)).cast("bigint").alias("missing_in_source_count"),
    )


def summarize_missing(missing: DataFrame, run_id: Optional[str] = None, target_name: Optional[str] = None) -> DataFrame:
    """Counts per ``issue_type`` of a stored mismatch table, optionally of one
    run and one target table."""
    if run_id is not None and "run_id" in missing.columns:
        missing = missing.where(F.col("run_id") == run_id)
    if target_name is not None:
        for column, part in zip(("target_catalog", "target_schema", "target_table"), split_name(target_name)):
            missing = missing.where(F.col(column) == part)
    return missing.groupBy("issue_type").agg(F.count(F.lit(1)).alias("row_count"))


# --------------------------------------------------------------------------- R2
@dataclass(frozen=True)
class TablePair:
    """Two tables to compare; ``None`` for one that doesn't exist."""

    name: str
    source: Optional[DataFrame]
    target: Optional[DataFrame]
    source_filter: Optional[str] = None
    target_filter: Optional[str] = None
    source_name: Optional[str] = None  # catalog.schema.table, for evidence
    target_name: Optional[str] = None


def row_count_check(pairs: Sequence[TablePair]) -> DataFrame:
    """One row per pair: both counts, ``target - source``, match flag.

    Each side is reduced to a one-row count before anything is combined, so
    no table data crosses a shuffle; all pairs finish in one job.
    """
    parts = []
    for p in pairs:
        for side, df, flt in (("s", p.source, p.source_filter), ("t", p.target, p.target_filter)):
            parts.append(
                apply_filter(df, flt).agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(p.name).alias("pair"), F.lit(side).alias("side"), "n"
                )
            )
    while len(parts) > 1:  # by twos, so that planning grows with the number of pairs and not with its square
        parts = [a.union(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    counts = parts[0]
    # a count answered from footers is null where no file holds a row group
    total = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0)).cast("bigint")
    agg = counts.groupBy("pair").agg(total("s").alias("source_row_count"), total("t").alias("target_row_count"))
    return agg.select(
        "pair",
        "source_row_count",
        "target_row_count",
        (F.col("target_row_count") - F.col("source_row_count")).alias("row_count_diff"),
        F.when(F.col("source_row_count") == F.col("target_row_count"), F.lit("match"))
        .otherwise(F.lit("mismatch"))
        .alias("comparison_result"),
    )


def footer_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet reader answers counts from file footers.

    Its settings are its own (the Parquet source by its newer reader, with
    aggregates pushed down); the caller's session stays as it is.
    """
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    old = own.conf.get("spark.sql.sources.useV1SourceList")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(f for f in old.split(",") if f != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


@dataclass(frozen=True)
class StoredPair:
    """Folders or files of two Parquet tables to count."""

    name: str
    source: str
    target: str
    source_filter: Optional[str] = None
    target_filter: Optional[str] = None


def stored_row_counts(spark: SparkSession, pairs: Sequence[StoredPair]) -> DataFrame:
    """:func:`row_count_check` of stored tables: an unfiltered side reads the
    footers of its files and no data page, a filtered one scans the columns of
    its filter, which still reaches the reader."""
    own = footer_session(spark)
    return row_count_check([TablePair(p.name, own.read.parquet(p.source), own.read.parquet(p.target), p.source_filter, p.target_filter) for p in pairs])


# --------------------------------------------------------------------------- R1
def schema_diff(source_facts: DataFrame, target_facts: DataFrame, exclude: Iterable[str] = (), key: str = "pair") -> DataFrame:
    """Compare column lists of many table pairs at once.

    Inputs are column facts (``key, column_name, data_type, is_nullable``,
    e.g. from :func:`tablesync.sources.column_facts` with ``table_name``
    renamed to the pair key).  Labels in priority order:
    ``missing_in_source``, ``missing_in_target``, ``type_mismatch``,
    ``nullable_mismatch``; matching columns are dropped.  Like the reference,
    column order and defaults are not compared.
    """
    excl = [e.lower() for e in exclude]
    s = source_facts.where(~F.lower("column_name").isin(excl)) if excl else source_facts
    t = target_facts.where(~F.lower("column_name").isin(excl)) if excl else target_facts
    s = s.select(key, "column_name", F.col("data_type").alias("source_data_type"), F.col("is_nullable").alias("source_nullable"), F.lit(True).alias("_in_s"))
    t = t.select(key, "column_name", F.col("data_type").alias("target_data_type"), F.col("is_nullable").alias("target_nullable"), F.lit(True).alias("_in_t"))
    j = s.join(t, on=[key, "column_name"], how="full_outer")
    label = (
        F.when(F.col("_in_s").isNull(), F.lit("missing_in_source"))
        .when(F.col("_in_t").isNull(), F.lit("missing_in_target"))
        .when(F.col("source_data_type") != F.col("target_data_type"), F.lit("type_mismatch"))
        .when(F.col("source_nullable") != F.col("target_nullable"), F.lit("nullable_mismatch"))
        .otherwise(F.lit("match"))
    )
    return (
        j.select(key, "column_name", "source_data_type", "target_data_type", "source_nullable", "target_nullable", label.alias("comparison_result"))
        .where(F.col("comparison_result") != "match")
        .orderBy(key, "column_name")
    )


def schema_diff_tables(spark: SparkSession, pairs: Sequence[TablePair], exclude: Iterable[str] = ()) -> DataFrame:
    """:func:`schema_diff` for table pairs given as DataFrames."""
    from tablesync.sources.tables import column_facts

    sf = column_facts(spark, {p.name: p.source for p in pairs}).withColumnRenamed("table_name", "pair")
    tf = column_facts(spark, {p.name: p.target for p in pairs}).withColumnRenamed("table_name", "pair")
    return schema_diff(sf, tf, exclude)


# --------------------------------------------------------------------------- R9
def split_name(full_name: str) -> tuple[str, str, str]:
    parts = full_name.split(".")
    if len(parts) != 3:
        raise ValueError(f"expected catalog.schema.table, got {full_name!r}")
    return parts[0], parts[1], parts[2]


def stamp_result(df: DataFrame, run_id: str, source_name: str, target_name: str) -> DataFrame:
    """Prefix result rows with run id and both three-part names, and stamp
    them with ``check_timestamp`` - the layout of the reference's result
    tables."""
    sc, ss, st = split_name(source_name)
    tc, ts, tt = split_name(target_name)
    head = [
        F.lit(run_id).alias("run_id"),
        F.lit(tc).alias("target_catalog"),
        F.lit(ts).alias("target_schema"),
        F.lit(tt).alias("target_table"),
        F.lit(sc).alias("source_catalog"),
        F.lit(ss).alias("source_schema"),
        F.lit(st).alias("source_table"),
    ]
    return df.select(*head, *[F.col(f"`{c}`") for c in df.columns], F.current_timestamp().alias("check_timestamp"))


def missing_data_rows(missing_with_evidence: DataFrame, run_id: str, source_name: str, target_name: str) -> DataFrame:
    """Rows in the reference's missing-data layout (issue_type, data map)."""
    return stamp_result(missing_with_evidence.select("issue_type", "data"), run_id, source_name, target_name)


def write_mismatches(df: DataFrame, path: str, run_id: Optional[str] = None) -> int:
    """Append mismatch rows (already stamped with run and names; with ``run_id``
    only rows of that run) and return how many rows this call wrote.  The number is observed while they are written:
    nothing is read again, however large the result table has grown."""
    if run_id is not None:
        df = df.where(F.col("run_id") == run_id)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return int(seen.get["n"])


def write_evidence(df: DataFrame, path: str, run_id: str, pair: str) -> dict[str, int]:
    """Store the stamped rows of one run and pair in a folder of their own, in
    place of what an earlier try of that run and pair left there, and return
    how many there are of each ``issue_type``, observed while they are written."""
    seen = Observation()
    of = lambda kind: F.count_if(F.col("issue_type") == kind).alias(kind)
    counts = [of(MISSING_IN_SOURCE), of(MISSING_IN_TARGET)] if "issue_type" in df.columns else []
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"), *counts)
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{hashlib.sha256(json.dumps([run_id, pair]).encode()).hexdigest()[:32]}")
    return {k: int(v) for k, v in seen.get.items()}


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """All rows that :func:`write_evidence` stored below ``path``."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)


# --------------------------------------------------------------------------- R10
def sample_objects(listing: DataFrame, n: int, seed: str | int, name_cols: Sequence[str]) -> DataFrame:
    """A deterministic pseudo-random sample of ``n`` objects.

    Rank by ``md5(seed || name)``: the same seed gives the same sample on
    every run and engine.  ``orderBy + limit`` is a per-partition top-n, so
    only ``n`` rows per task move.
    """
    name = F.concat_ws(".", *[F.col(c) for c in name_cols])
    return (
        listing.withColumn("_rank_key", F.md5(F.concat(F.lit(str(seed)), name)))
        .orderBy("_rank_key", *name_cols)
        .limit(n)
        .drop("_rank_key")
    )


# --------------------------------------------------------------------------- R11
def match_rate(source_count: Column, missing_count: Column) -> Column:
    """Percent of source rows found in the target (100 for an empty source)."""
    return F.when(source_count == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) * (F.lit(1.0) - missing_count.cast("double") / source_count.cast("double"))
    )


def threshold_check(counts: DataFrame, threshold: float = 100.0) -> DataFrame:
    """Add ``match_pct`` and ``passed`` to rows with ``source_count`` and
    ``missing_count``.  The reference declares this threshold but never reads
    it; here ``passed = match_pct >= threshold``."""
    pct = match_rate(F.col("source_count"), F.col("missing_count"))
    return counts.withColumn("match_pct", pct).withColumn("passed", pct >= F.lit(float(threshold)))

