"""Registered queries that locate differences without moving both tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import oracle as O
from tablesync.operators import cell_changes, digest_tree, keys, sequential, sketch_diff
from tablesync.plans.registry import query
from tablesync.session import apply_defaults, work_dir
from tablesync.sources import fixtures as X
from tablesync.sources.tables import load


# ----------------------------------------------------------------- R3 by sketches
@query("recon_missing_by_sketch", oracle=O.missing_sql("select * from lineitem", O.LINEITEM_TARGET, O.LINEITEM_COLS))
def recon_missing_by_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that differ, found through cells in number of the difference."""
    apply_defaults(spark)
    return sketch_diff.missing_rows_by_sketch(load(spark, sf, "lineitem"), X.lineitem_target(spark, sf))


# ----------------------------------------------------------------- T2 / R3 by a digest tree
#: Rows of a leaf in these queries: the test tables get trees of one to two levels (tests use deeper ones).
_LEAF_ROWS = 4096


@query("sync_first_run", oracle="select * from orders")
def sync_first_run(spark: SparkSession, sf: str) -> DataFrame:
    """A target that isn't there is created and read back."""
    apply_defaults(spark)
    target = work_dir(spark, "sync_first_run") + "/orders"
    digest_tree.sync_tree(spark, load(spark, sf, "orders"), target, ["o_orderkey"], _LEAF_ROWS)
    return digest_tree.read_table(spark, target)


@query("recon_missing_by_tree", oracle=O.missing_sql("select * from orders", O.ORDERS_TARGET, O.ORDERS_COLS))
def recon_missing_by_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Two stored tables compared from the roots of their trees, differing leaves read."""
    apply_defaults(spark)
    root = work_dir(spark, "recon_missing_by_tree")
    digest_tree.sync_tree(spark, load(spark, sf, "orders"), root + "/source", ["o_orderkey"], _LEAF_ROWS)
    digest_tree.sync_tree(spark, X.orders_target(spark, sf), root + "/target", ["o_orderkey"], 2 * _LEAF_ROWS)
    return digest_tree.missing_rows_by_tree(spark, root + "/source", root + "/target")


# ----------------------------------------------------------------- R11 decided early
_THRESHOLDS = (90.0, 98.0, 99.5)


@query(
    "recon_threshold_sequential",
    oracle=f"""
with n as (select count(*) as source_count from orders),
m as (select count(*) as missing from ({O.missing_sql('select * from orders', O.ORDERS_TARGET, O.ORDERS_COLS)}) where issue_type = 'missing_in_target')
select threshold, source_count, 100.0 * (source_count - missing) >= threshold * source_count as passed
from n, m, (select unnest([{', '.join(f'cast({t} as double)' for t in _THRESHOLDS)}]) as threshold)
""",
)
def recon_threshold_sequential(spark: SparkSession, sf: str) -> DataFrame:
    """P3 under three thresholds: far below, near and above its rate of matches."""
    apply_defaults(spark)
    root = work_dir(spark, "recon_threshold_sequential")
    digest_tree.sync_tree(spark, load(spark, sf, "orders"), root + "/source", ["o_orderkey"], _LEAF_ROWS // 2)
    digest_tree.sync_tree(spark, X.orders_target(spark, sf), root + "/target", ["o_orderkey"], _LEAF_ROWS // 2)
    out = None
    for threshold in _THRESHOLDS:
        one = sequential.sequential_threshold(spark, root + "/source", root + "/target", threshold, error=1e-6).select(F.lit(threshold).alias("threshold"), "source_count", "passed")
        out = one if out is None else out.unionByName(one)
    return out


# ----------------------------------------------------------------- T2 key discovery
def _keys_sql(tables: dict[str, tuple[list[str], int]]) -> str:
    """Every set of columns counted, those kept that are keys and hold no smaller one."""
    sets = []
    for table, (columns, most) in tables.items():
        for size in range(1, most + 1):
            for some in combinations(columns, size):
                listed = ", ".join(some)
                quoted = ", ".join(f"'{c}'" for c in some)
                sets.append(f"select '{table}' as table_name, [{quoted}] as cols, (select count(*) from (select distinct {listed} from {table})) = (select count(*) from {table}) as is_key")
    return f"""
with u as materialized ({' union all '.join(sets)})
select table_name, array_to_string(cols, ',') as key_columns, cast(len(cols) as integer) as key_size
from u a where is_key and not exists (
  select 1 from u b where b.table_name = a.table_name and b.is_key and len(b.cols) < len(a.cols) and list_has_all(a.cols, b.cols))
"""


@query("table_keys", oracle=_keys_sql({"orders": (O.ORDERS_COLS, 6), "events": (O.EVENTS_COLS, 6), "lineitem": (O.LINEITEM_COLS, 2)}))
def table_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Minimal keys of three tables (of lineitem up to two columns)."""
    apply_defaults(spark)
    return keys.keys_table({t: load(spark, sf, t) for t in ("orders", "events")}).unionByName(keys.keys_table({"lineitem": load(spark, sf, "lineitem")}, most=2))


# ----------------------------------------------------------------- R7 changed cells
def _equal_but(column: str) -> str:
    return " and ".join(f"s.{c} is not distinct from t.{c}" for c in O.LINEITEM_COLS if c != column)


@query(
    "recon_changed_cells",
    oracle=f"""
with m as ({O.missing_sql("select * from lineitem", O.LINEITEM_TARGET, O.LINEITEM_COLS)}),
s as (select * from m where issue_type = 'missing_in_target'),
t as (select * from m where issue_type = 'missing_in_source'),
-- the same line with another quantity, by all that else is known of it
q as (select s.*, t.l_quantity as new from s join t on {_equal_but('l_quantity')}),
-- a line that is gone, and its copy under another order
k as (
  select s.*, t.l_orderkey as new from s join t on {_equal_but('l_orderkey')}
  where not exists (select 1 from q where {' and '.join(f'q.{c} is not distinct from s.{c}' for c in O.LINEITEM_COLS)})
)
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, 'l_quantity' as column_name, cast(l_quantity as varchar) as source_value, cast(new as varchar) as target_value from q
union all
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, 'l_orderkey', cast(l_orderkey as varchar), cast(new as varchar) from k
""",
)
def recon_changed_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that changed in one cell, paired without a key."""
    apply_defaults(spark)
    cells = cell_changes.changed_cells(load(spark, sf, "lineitem"), X.lineitem_target(spark, sf), most_changed=1)
    own = [F.col("source")[c].alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")]
    return cells.select(*own, "column_name", "source_value", "target_value")
