"""Object selection (S1-S9): which schemas, tables and volumes a run
touches.  Listings are DataFrames; every rule is a Column predicate or a
semi / anti join, evaluated for all objects at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name prefixes of internal objects hidden from listings.
INTERNAL_PREFIXES = ("__materialization_mat", "event_log_")


# ------------------------------------------------------------------ S1
def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Non-temporary tables of a database as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN `{database}`").where(~F.col("isTemporary")).select(
        F.col("namespace").alias("schema_name"), F.col("tableName").alias("table_name")
    )


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS").where(F.col("namespace") != "information_schema").select(F.col("namespace").alias("schema_name"))


# ------------------------------------------------------------------ S2 / S3
def hide_internal(listing: DataFrame, name_col: str = "table_name") -> DataFrame:
    """Drop internal names.  Prefixes are tested literally (``startswith``),
    where a ``LIKE`` would treat ``_`` as a wildcard."""
    cond = reduce(lambda a, b: a | b, [F.col(name_col).startswith(p) for p in INTERNAL_PREFIXES])
    return listing.where(~cond)


def filter_objects(listing: DataFrame, expr: Optional[str], renames: Optional[dict[str, str]] = None, hide: bool = True) -> DataFrame:
    """Free-form SQL filter over the listing, with columns renamed first
    (e.g. ``schema_name -> table_schema``) so filters read like catalog
    views.  Empty filter = nothing selected, as in the reference."""
    df = listing
    for a, b in (renames or {}).items():
        df = df.withColumnRenamed(a, b)
    if not expr:
        return df.limit(0)
    df = df.where(expr)
    return hide_internal(df) if hide else df


# ------------------------------------------------------------------ S4
@dataclass
class SchemaSelection:
    schema_name: str
    tables: Sequence[str] = ()
    exclude_tables: Sequence[str] = ()
    table_filter_expression: Optional[str] = None
    table_types: Sequence[str] = ()


@dataclass
class Selection:
    target_schemas: Sequence[SchemaSelection] = ()
    exclude_schemas: Sequence[str] = ()
    schema_table_filter_expression: Optional[str] = None
    table_types: Sequence[str] = ()
    operation: str = "replication"


def adjust_types(types: Sequence[str], operation: str) -> list[str]:
    """External tables show up as managed in shared catalogs, so for data
    work ``EXTERNAL`` also selects ``MANAGED``."""
    t = [x.upper() for x in types]
    if t and operation in ("replication", "reconciliation") and "EXTERNAL" in t and "MANAGED" not in t:
        t.append("MANAGED")
    return t


def _type_pred(types: Sequence[str], operation: str) -> Optional[Column]:
    t = adjust_types(types, operation)
    return F.upper(F.col("table_type")).isin(t) if t else None


def selection_predicate(sel: Selection) -> Optional[Column]:
    """Column predicate over ``table_schema, table_name, table_type``.

    Per listed schema: include list, else exclude list, else filter
    expression, else the whole schema - AND its table types (schema level,
    else catalog level); schemas are OR-ed.  Without listed schemas:
    excluded schemas, else the catalog filter expression AND types.
    """
    if sel.target_schemas:
        preds = []
        for s in sel.target_schemas:
            p = F.col("table_schema") == s.schema_name
            if s.tables:
                p = p & F.col("table_name").isin(list(s.tables))
            elif s.exclude_tables:
                p = p & ~F.col("table_name").isin(list(s.exclude_tables))
            elif s.table_filter_expression:
                p = p & F.expr(s.table_filter_expression.replace("{{schema_name}}", s.schema_name))
            tp = _type_pred(s.table_types or sel.table_types, sel.operation)
            preds.append(p & tp if tp is not None else p)
        return reduce(lambda a, b: a | b, preds)
    if sel.exclude_schemas:
        return ~F.col("table_schema").isin(list(sel.exclude_schemas))
    if sel.schema_table_filter_expression:
        p = F.expr(sel.schema_table_filter_expression)
        tp = _type_pred(sel.table_types, sel.operation)
        return p & tp if tp is not None else p
    return None


def select_objects(listing: DataFrame, sel: Selection) -> DataFrame:
    df = listing.withColumnRenamed("schema_name", "table_schema")
    pred = selection_predicate(sel)
    df = df.where(pred) if pred is not None else df
    return hide_internal(df).withColumnRenamed("table_schema", "schema_name")


# ------------------------------------------------------------------ S5
def classify_type(listing: DataFrame) -> DataFrame:
    """Effective table type: non-managed as listed; managed with a pipeline
    id is a streaming table; managed under ``/tables/`` stays managed; any
    other managed table is external (shared external tables look managed)."""
    t = F.upper(F.col("table_type"))
    eff = (
        F.when(t != "MANAGED", t)
        .when(F.col("pipeline_id").isNotNull() & (F.col("pipeline_id") != ""), F.lit("STREAMING_TABLE"))
        .when(F.coalesce(F.col("storage_location"), F.lit("")).contains("/tables/"), F.lit("MANAGED"))
        .otherwise(F.lit("EXTERNAL"))
    )
    return listing.withColumn("effective_type", eff)


# ------------------------------------------------------------------ S6
def filter_types(listing: DataFrame, types: Sequence[str], kind: str = "table", type_col: str = "effective_type") -> DataFrame:
    """Keep objects of the given types (case-insensitive).  No types means
    all tables but no volumes."""
    if not types:
        return listing if kind == "table" else listing.limit(0)
    return listing.where(F.lower(F.col(type_col)).isin([t.lower() for t in types]))


# ------------------------------------------------------------------ S7
def pending(listing: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Objects not yet finished: anti join with the finished ones.  For
    resume, ``done`` is the audit rows of this run and operation with
    status ``success`` (failed objects are retried)."""
    return listing.join(done.select(*keys).distinct(), on=list(keys), how="left_anti")


def succeeded(audit: DataFrame, run_id: str, operation: str) -> DataFrame:
    return audit.where((F.col("run_id") == run_id) & (F.col("operation_type") == operation) & (F.col("status") == "success"))


# ------------------------------------------------------------------ S8
def full_name(*cols: str) -> Column:
    return F.concat_ws(".", *[F.col(c) for c in cols])


def shared(listing: DataFrame, share: DataFrame, name: Column) -> DataFrame:
    """Objects already in a share (``share.full_name``)."""
    return listing.withColumn("full_name", name).join(share.select("full_name"), "full_name", "left_semi")


def not_shared(listing: DataFrame, share: DataFrame, name: Column) -> DataFrame:
    return listing.withColumn("full_name", name).join(share.select("full_name"), "full_name", "left_anti")


# ------------------------------------------------------------------ S9
def with_exists(requested: DataFrame, listing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested objects with an ``exists`` flag from the listing."""
    present = listing.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return requested.join(present, on=list(keys), how="left").withColumn("exists", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")
