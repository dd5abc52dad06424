"""Registered table-copy queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import oracle as O
from tablesync.operators import copy as C
from tablesync.operators import digest_tree as D
from tablesync.plans.registry import query
from tablesync.session import apply_defaults, work_dir
from tablesync.sources import fixtures as X
from tablesync.sources import storage
from tablesync.sources.tables import column_facts, load
from tablesync.streaming import change_stream as CS


@query("copy_snapshot", oracle="select * from orders")
def copy_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    target = work_dir(spark, "copy_snapshot") + "/orders"
    C.copy_table(load(spark, sf, "orders"), target)
    return storage.read_table(spark, target)


@query("copy_two_hop", oracle="select * from customer")
def copy_two_hop(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    root = work_dir(spark, "copy_two_hop")
    C.copy_via(load(spark, sf, "customer"), root + "/staging/customer", root + "/target/customer")
    return storage.read_table(spark, root + "/target/customer")


@query("copy_remapped", oracle="select * from part")
def copy_remapped(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    src_root = sf.rstrip("/") + "/"
    if ":" not in src_root.split("/")[0]:
        src_root = "file:" + src_root
    mapping = [(src_root, work_dir(spark, "copy_remapped") + "/")]
    source_location = src_root + "part.parquet"
    name = f"tablesync_part_{uuid.uuid4().hex[:12]}"
    C.copy_external(spark, load(spark, sf, "part"), source_location, mapping, name, copy_files=True)
    return spark.table(name)


# ----------------------------------------------------------------- T3 gate
def _names_sql(table: str, order: str = "ordinal_position") -> str:
    return f"(select string_agg(column_name, ',' order by {order}) from information_schema.columns where table_name = '{table}')"


_RESHAPED_NAMES = "'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_comment'"


@query(
    "schema_gate",
    oracle=f"""
with v(pair, source_columns, target_columns) as (values
  ('lineitem', {_names_sql('lineitem')}, {_names_sql('lineitem')}),
  ('orders', {_names_sql('orders')}, {_RESHAPED_NAMES}),
  ('customer', {_names_sql('customer')}, {_names_sql('customer', 'ordinal_position desc')}),
  ('events', {_names_sql('events')}, {_names_sql('events')})
)
select pair, source_columns, target_columns, source_columns = target_columns as passed,
       case when source_columns = target_columns then 'ok' else 'fail' end as action
from v
union all select 'commas', 'n,name', 'n,name', false, 'fail'
""",
)
def schema_gate(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    cust = load(spark, sf, "customer")
    pairs = {
        "lineitem": (load(spark, sf, "lineitem"), X.lineitem_target(spark, sf)),
        "orders": (load(spark, sf, "orders"), X.orders_reshaped(spark, sf)),
        "customer": (cust, cust.select(*reversed(cust.columns))),
        "events": (X.events_source(spark, sf), X.events_target(spark, sf)),
        "commas": (load(spark, sf, "nation").select(F.col("n_name").alias("n,name")), load(spark, sf, "nation").select(F.col("n_nationkey").alias("n"), F.col("n_name").alias("name"))),
    }
    sf_ = column_facts(spark, {k: v[0] for k, v in pairs.items()}).withColumnRenamed("table_name", "pair")
    tf_ = column_facts(spark, {k: v[1] for k, v in pairs.items()}).withColumnRenamed("table_name", "pair")
    return C.schema_gate(sf_, tf_, enforce=True)


# ----------------------------------------------------------------- T2
_OV = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_CHANGES_SQL = f"""
select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
       case when t.o_orderkey is null then 'insert' when s.o_orderkey is null then 'delete' else 'update' end as change_type,
       {', '.join('s.' + c for c in _OV)}
from orders s full outer join ({O.ORDERS_TARGET}) t on s.o_orderkey = t.o_orderkey
where s.o_orderkey is null or t.o_orderkey is null
   or not ({' and '.join(f's.{c} is not distinct from t.{c}' for c in _OV)})
"""


@query("snapshot_changes", oracle=_CHANGES_SQL)
def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return C.snapshot_changes(load(spark, sf, "orders"), X.orders_target(spark, sf), ["o_orderkey"])


@query("apply_changes", oracle="select * from orders")
def apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Write the P3 target under a digest tree, sync it incrementally from the
    source, read it back."""
    apply_defaults(spark)
    target = work_dir(spark, "apply_changes") + "/orders"
    D.sync_tree(spark, X.orders_target(spark, sf), target, ["o_orderkey"], leaf_rows=8192)
    D.sync_tree(spark, load(spark, sf, "orders"), target, ["o_orderkey"], leaf_rows=8192)
    return D.read_table(spark, target)


_NULLS_DUPS = """
select case when o_orderkey % 50 = 0 then null else o_custkey end as k, o_orderkey, o_totalprice, o_orderpriority
from orders
"""


@query("apply_changes_nulls_dups", oracle=_NULLS_DUPS)
def apply_changes_nulls_dups(spark: SparkSession, sf: str) -> DataFrame:
    """The change set itself applied: customer as key, so keys repeat, and some are null."""
    apply_defaults(spark)
    k = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("k")
    pick = lambda df: df.select(k, "o_orderkey", "o_totalprice", "o_orderpriority")
    source, target = pick(load(spark, sf, "orders")), pick(X.orders_target(spark, sf))
    return C.apply_changes(target, C.snapshot_changes(source, target, ["k"]), ["k"], source)


# ----------------------------------------------------------------- T6
@query(
    "sync_change_stream",
    oracle="""
select c_custkey, c_name, c_nationkey,
       case when c_custkey % 10 = 0 then c_acctbal - 1 when c_custkey % 3 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal, c_mktsegment
from customer where c_custkey % 5 <> 0 or c_custkey % 10 = 0
""",
)
def sync_change_stream(spark: SparkSession, sf: str) -> DataFrame:
    """customer from its changes, taken in two files at a time in no order of
    version, by a stream that is started, ended and started again."""
    apply_defaults(spark)
    root = work_dir(spark, "sync_change_stream")
    changes = X.customer_changes(spark, sf)
    part = F.pmod(F.xxhash64("c_custkey", "_version"), F.lit(6))
    for half in (part < 3, part >= 3):
        changes.where(half).repartition(3, part).write.mode("append").parquet(root + "/changes")
        out = CS.sync_change_stream(spark, root + "/changes", changes.schema, ["c_custkey"], root + "/accepted", root + "/checkpoint", options={"maxFilesPerTrigger": "2"}, timeout_seconds=900)
    return out


@query(
    "sync_strategy",
    oracle=f"""
select schema_name, table_name, table_type,
       case when lower(table_type) = 'view' then 'skip'
            when lower(table_type) = 'external' then 'remapped'
            else 'snapshot' end as strategy
from ({O.DOCUMENT_LISTING})
""",
)
def sync_strategy(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    listing = X.document_listing(spark, sf).select("schema_name", "table_name", "table_type")
    return C.sync_strategy(listing, replicate_as_managed=False, staging_catalog=None)


@query(
    "sync_table",
    oracle="""
select 'supplier' as table_name, 'snapshot' as strategy, count(*) as n, cast(sum(s_suppkey) as bigint) as key_sum from supplier
union all select 'orders', 'two_hop', count(*), cast(sum(o_orderkey) as bigint) from orders
union all select 'part', 'remapped', count(*), cast(sum(p_partkey) as bigint) from part
""",
)
def sync_table(spark: SparkSession, sf: str) -> DataFrame:
    """Three tables copied by the strategy that their type and the settings choose, read back."""
    apply_defaults(spark)
    root = work_dir(spark, "sync_table")
    src_root = sf.rstrip("/") + "/"
    if ":" not in src_root.split("/")[0]:
        src_root = "file:" + src_root
    name = f"tablesync_sync_{uuid.uuid4().hex}"
    out = None
    for table, key, kind, extra in (
        ("supplier", "s_suppkey", "managed", {}),
        ("orders", "o_orderkey", "managed", {"staging_dir": root + "/staging"}),
        ("part", "p_partkey", "external", {"table_name": name, "source_location": src_root + "part.parquet", "url_map": [(src_root, root + "/mapped/")]}),
    ):
        strategy, path = C.sync_table(spark, load(spark, sf, table), kind, f"{root}/{table}", **extra)
        one = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum(key).cast("long").alias("key_sum"))
        one = one.select(F.lit(table).alias("table_name"), F.lit(strategy).alias("strategy"), "n", "key_sum")
        out = one if out is None else out.unionByName(one)
    return out


# ----------------------------------------------------------------- T7 / T8
def _picked(spark: SparkSession, sf: str) -> DataFrame:
    cands = C.backing_candidates(X.pipeline_tables(spark, sf), X.INTERNAL_CATALOG)
    return C.pick_source(cands, X.existing_backing_tables(spark, sf), ["catalog_name", "schema_name", "table_name"])


@query("pick_source", oracle=O.PICKED_SOURCE)
def pick_source(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return _picked(spark, sf).select("catalog_name", "schema_name", "table_name", "priority", "chosen", "label")


# ----------------------------------------------------------------- T9
@query(
    "backup_select",
    oracle=f"""
select catalog_name, schema_name, table_name, chosen, label,
       case when chosen is null then 'error' when label = 'legacy' then 'backup' else 'share' end as action,
       case when chosen is not null and label = 'legacy' then 'backup.bk_' || schema_name || '.' || table_name end as backup_table
from ({O.PICKED_SOURCE})
""",
)
def backup_select(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return C.backup_plan(_picked(spark, sf), backup_catalog="backup", prefix="bk_")


@query("backup_table", oracle="select * from customer")
def backup_table(spark: SparkSession, sf: str) -> DataFrame:
    """A backing table copied to its backup location and registered, read by its name."""
    apply_defaults(spark)
    name = f"tablesync_backup_{uuid.uuid4().hex}"
    C.backup_table(spark, load(spark, sf, "customer"), work_dir(spark, "backup_table") + "/customer", name)
    return spark.table(name)
