"""Table copy.

Copies are plain distributed writes: every task writes its own part files,
nothing is shuffled.  Targets are versioned folders (see
:mod:`tablesync.sources.storage`), so a copy is all-or-nothing and a table
can be rebuilt from itself.  Change detection between snapshots is one
aggregation on the key, which folds a hot key map-side instead of pairing
its rows in a join.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablesync.functions.columns import comparable
from tablesync.functions.urls import remapped
from tablesync.sources import storage

INSERT, UPDATE, DELETE, SAME, DUPLICATE = "insert", "update", "delete", "same", "duplicate_key"


# ------------------------------------------------------------------ T1
def copy_table(source: DataFrame, target_dir: str, partition_by: Optional[list[str]] = None) -> str:
    """Snapshot copy: write the whole source as a new target version."""
    return storage.write_version(source, target_dir, partition_by)


# ------------------------------------------------------------------ T4
def copy_via(source: DataFrame, staging_dir: str, target_dir: str) -> str:
    """Two-hop copy: source -> staging, then staging -> target.

    The second hop reads the committed staging copy, not the source again,
    so both hops copy the same snapshot.
    """
    copy_table(source, staging_dir)
    staged = storage.read_table(source.sparkSession, staging_dir)
    return copy_table(staged, target_dir)


# ------------------------------------------------------------------ T5
def copy_external(
    spark: SparkSession,
    source: DataFrame,
    source_location: str,
    url_map: Sequence[tuple[str, str]],
    table_name: str,
    copy_files: bool = True,
) -> str:
    """Location-remapped copy of an external table.

    The target location is the source location under the mapping; with
    ``copy_files`` the data is written there, then the target table is
    dropped and registered again at that location.  Returns the location.
    """
    mapped = remapped(source_location, url_map)
    if mapped is None:
        raise ValueError(f"no location mapping for {source_location}")
    if copy_files:
        source.write.mode("overwrite").parquet(mapped)
    quoted = mapped.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {table_name}")
    spark.sql(f"CREATE TABLE {table_name} USING parquet LOCATION '{quoted}'")
    return mapped


# ------------------------------------------------------------------ T3
def schema_gate(source_facts: DataFrame, target_facts: DataFrame, enforce: bool = True, key: str = "pair", types: bool = False) -> DataFrame:
    """Ordered column-name lists must be equal (optionally types too).

    One row per pair: both lists, ``passed`` and the ``action``
    (``ok``; ``fail`` when enforced, else ``warn``).
    """

    def ordered(facts: DataFrame, alias: str) -> DataFrame:
        item = F.struct("column_name", "data_type") if types else F.struct("column_name")
        return facts.groupBy(key).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("ordinal_position", item.alias("n")))), lambda x: x["n"]).alias(alias)
        )

    def text(c: str) -> Column:
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[f] for f in (("column_name", "data_type") if types else ("column_name",))])), ",").alias(c)

    j = ordered(source_facts, "source_columns").join(ordered(target_facts, "target_columns"), key, "full_outer")
    passed = F.coalesce(F.col("source_columns") == F.col("target_columns"), F.lit(False))
    return j.select(
        key, text("source_columns"), text("target_columns"), passed.alias("passed"),
        F.when(passed, F.lit("ok")).otherwise(F.lit("fail" if enforce else "warn")).alias("action"),
    )


# ------------------------------------------------------------------ T2
def snapshot_changes(source: DataFrame, target: DataFrame, keys: Sequence[str], include_same: bool = False) -> DataFrame:
    """Changes that turn ``target`` into ``source``, by key.

    Output: keys, ``change_type`` (insert / update / delete / duplicate_key,
    plus same when asked) and the source values of the other columns.
    Both sides are tagged, unioned and grouped by key in one shuffle; rows of
    one key are never paired with each other, so duplicate keys are reported
    instead of multiplied.
    """
    vals = [c for c in source.columns if c not in keys]
    s = source.select(*keys, F.struct(*vals).alias("_row"), F.lit(1).alias("_s"), F.lit(0).alias("_t"))
    t = target.select(*keys, F.struct(*vals).alias("_row"), F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    # first(ignorenulls) needs no ordering, so MAP columns are fine; with a
    # unique key each side contributes at most one row
    g = s.unionByName(t).groupBy(*keys).agg(
        F.sum("_s").alias("_ns"),
        F.sum("_t").alias("_nt"),
        F.first(F.when(F.col("_s") == 1, F.col("_row")), ignorenulls=True).alias("_srow"),
        F.first(F.when(F.col("_t") == 1, F.col("_row")), ignorenulls=True).alias("_trow"),
    )
    types = dict((f.name, f.dataType) for f in source.schema.fields)

    def cmp(side: str, name: str) -> Column:
        c = F.col(side)[name]
        return F.array_sort(F.map_entries(c)) if isinstance(types[name], T.MapType) else c

    same_vals = F.lit(True)
    for v in vals:
        same_vals = same_vals & cmp("_srow", v).eqNullSafe(cmp("_trow", v))
    change = (
        F.when((F.col("_ns") > 1) | (F.col("_nt") > 1), F.lit(DUPLICATE))
        .when(F.col("_nt") == 0, F.lit(INSERT))
        .when(F.col("_ns") == 0, F.lit(DELETE))
        .when(same_vals, F.lit(SAME))
        .otherwise(F.lit(UPDATE))
    )
    out = g.select(*keys, change.alias("change_type"), *[F.col("_srow")[v].alias(v) for v in vals])
    return out if include_same else out.where(F.col("change_type") != SAME)


def _on_keys(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    """Null-safe equality of the key columns."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], source: Optional[DataFrame] = None) -> DataFrame:
    """Target with a change set applied (deleted and updated keys replaced).

    Keys match null-safe.  A key that occurs more than once on either side
    (``duplicate_key``) gets all rows that ``source`` has for it; without a
    ``source`` such keys stay as they are.
    """
    handled = [UPDATE, DELETE, INSERT] + ([DUPLICATE] if source is not None else [])
    touched = changes.where(F.col("change_type").isin(handled)).select(*keys)
    kept = target.join(touched, _on_keys(keys, target, touched), "left_anti")
    out = kept.unionByName(changes.where(F.col("change_type").isin(INSERT, UPDATE)).select(*target.columns))
    if source is not None:
        twice = changes.where(F.col("change_type") == DUPLICATE).select(*keys)
        out = out.unionByName(source.join(twice, _on_keys(keys, source, twice), "left_semi").select(*target.columns))
    return out


def sync_incremental(spark: SparkSession, source: DataFrame, target_dir: str, keys: Sequence[str]) -> tuple[str, DataFrame]:
    """Bring a versioned target in step with ``source``: compute changes
    against the current version, write the applied result as the next
    version.  Returns the new version path and the change set.  Where a new
    version of the whole table is too much, see
    :func:`tablesync.operators.digest_tree.sync_tree`."""
    current = storage.read_table(spark, target_dir)
    changes = snapshot_changes(source, current, keys)
    return storage.write_version(apply_changes(current, changes, keys, source), target_dir), changes


# ------------------------------------------------------------------ T6
def sync_strategy(listing: DataFrame, replicate_as_managed: bool = False, staging_catalog: Optional[str] = None) -> DataFrame:
    """Copy strategy per object: external tables not forced to managed are
    remapped; otherwise two-hop when a staging catalog is set, else a
    snapshot.  Views are not copied."""
    ttype = F.lower(F.col("table_type"))
    strat = (
        F.when(ttype == "view", F.lit("skip"))
        .when((ttype == "external") & F.lit(not replicate_as_managed), F.lit("remapped"))
        .when(F.lit(staging_catalog is not None), F.lit("two_hop"))
        .otherwise(F.lit("snapshot"))
    )
    return listing.withColumn("strategy", strat)


def sync_table(
    spark: SparkSession,
    source: DataFrame,
    table_type: str,
    target_dir: str,
    table_name: Optional[str] = None,
    source_location: Optional[str] = None,
    url_map: Sequence[tuple[str, str]] = (),
    staging_dir: Optional[str] = None,
    replicate_as_managed: bool = False,
) -> tuple[str, Optional[str]]:
    """Choose the copy of one table by :func:`sync_strategy` and run it.
    Returns the strategy and where the data is now (views: nowhere)."""
    listing = spark.createDataFrame([(table_type,)], "table_type string")
    strategy = sync_strategy(listing, replicate_as_managed, staging_dir).first()["strategy"]
    if strategy == "skip":
        return strategy, None
    if strategy == "remapped":
        if not (table_name and source_location):
            raise ValueError("an external table needs its name and location")
        return strategy, copy_external(spark, source, source_location, url_map, table_name)
    if strategy == "two_hop":
        return strategy, copy_via(source, staging_dir, target_dir)
    return strategy, copy_table(source, target_dir)


# ------------------------------------------------------------------ T7 / T8
def pick_source(candidates: DataFrame, existing: DataFrame, object_cols: Sequence[str], name_col: str = "candidate") -> DataFrame:
    """First existing candidate per object, by ``priority``.

    ``existing`` lists available names in column ``full_name``; objects
    whose candidates all miss get ``chosen = null``.  The window works on
    the few candidates of one object, never on table data.
    """
    ex = existing.select(F.col("full_name").alias(name_col)).distinct()
    hit = candidates.join(ex, on=name_col, how="left_semi")
    w = Window.partitionBy(*object_cols).orderBy("priority")
    first = hit.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    objs = candidates.select(*object_cols).distinct()
    return objs.join(first, on=list(object_cols), how="left").withColumnRenamed(name_col, "chosen")


# Naming rules of pipeline backing tables (pipeline id with
# "-" turned into "_").  The internal catalog name is a setting.
#   in-schema table:  <catalog>.<schema>.__materialization_mat_<pid>_<table>_1
#   internal schema:  __dlt_materialization_schema_<pid>
#   internal tables:  <table>, __materialization_mat_<pid>_<table>_1, __materialization_mat_<table>_1
MAT_PREFIX = "__materialization_mat_"
MAT_SUFFIX = "_1"
SCHEMA_PREFIX = "__dlt_materialization_schema_"


def backing_candidates(tables: DataFrame, internal_catalog: str) -> DataFrame:
    """Four candidate backing tables per pipeline-owned table.

    Input columns: catalog_name, schema_name, table_name, pipeline_id.
    Output adds priority, candidate (``catalog.schema.table``) and label
    (``dpm`` for the in-schema form, ``legacy`` for the internal catalog).
    """
    pid = F.regexp_replace("pipeline_id", "-", "_")
    ischema = F.concat(F.lit(SCHEMA_PREFIX), pid)
    new_name = F.concat(F.lit(MAT_PREFIX), pid, F.lit("_"), F.col("table_name"), F.lit(MAT_SUFFIX))
    old_name = F.concat(F.lit(MAT_PREFIX), F.col("table_name"), F.lit(MAT_SUFFIX))
    ic = F.lit(internal_catalog)
    cands = F.array(
        F.struct(F.lit(1).alias("priority"), F.concat_ws(".", "catalog_name", "schema_name", new_name).alias("candidate"), F.lit("dpm").alias("label")),
        F.struct(F.lit(2).alias("priority"), F.concat_ws(".", ic, ischema, "table_name").alias("candidate"), F.lit("legacy").alias("label")),
        F.struct(F.lit(3).alias("priority"), F.concat_ws(".", ic, ischema, new_name).alias("candidate"), F.lit("legacy").alias("label")),
        F.struct(F.lit(4).alias("priority"), F.concat_ws(".", ic, ischema, old_name).alias("candidate"), F.lit("legacy").alias("label")),
    )
    return tables.select("catalog_name", "schema_name", "table_name", F.inline(cands))


# ------------------------------------------------------------------ T9
def backup_plan(resolved: DataFrame, backup_catalog: Optional[str], prefix: str = "", backup_legacy: bool = True) -> DataFrame:
    """What the backup stage does per streaming table.

    ``resolved`` comes from :func:`pick_source` over
    :func:`backing_candidates` (columns ``chosen``, ``label``).  Legacy
    backing tables are copied to ``backup_catalog.<prefix><schema>.<table>``;
    in-schema (dpm) ones are published as they are; unresolved ones fail.
    """
    action = (
        F.when(F.col("chosen").isNull(), F.lit("error"))
        .when((F.col("label") == "legacy") & F.lit(backup_catalog is not None and backup_legacy), F.lit("backup"))
        .when(F.col("label") == "legacy", F.lit("skip"))
        .otherwise(F.lit("share"))
    )
    target = F.when(
        action == "backup",
        F.concat_ws(".", F.lit(backup_catalog or ""), F.concat(F.lit(prefix), F.col("schema_name")), F.col("table_name")),
    )
    return resolved.select("catalog_name", "schema_name", "table_name", "chosen", "label", action.alias("action"), target.alias("backup_table"))


def backup_table(spark: SparkSession, source: DataFrame, backup_dir: str, table_name: str, drop_property: str = "pipelines.parentTableId") -> str:
    """Copy a backing table to its backup location, register it, and unset
    the property that ties it to its pipeline."""
    path = copy_table(source, backup_dir)
    spark.sql(f"DROP TABLE IF EXISTS {table_name}")
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table_name} USING parquet LOCATION '{quoted}'")
    spark.sql(f"ALTER TABLE {table_name} UNSET TBLPROPERTIES IF EXISTS ('{drop_property}')")
    return path
