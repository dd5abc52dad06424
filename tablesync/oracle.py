"""DuckDB SQL that computes, independently of Spark, what each registered
query must return.  Tables are the pre-registered views of the test data.

The derived pairs repeat the recipes of :mod:`tablesync.sources.fixtures`
in plain SQL.  Computed columns carry the same aliases as the Spark side.
"""

from __future__ import annotations

LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

LINEITEM_TARGET = """
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
       case when l_partkey % 101 = 0 then l_quantity + 1 else l_quantity end as l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
from lineitem where l_orderkey % 97 <> 0
union all
select -l_orderkey - 1 as l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
from lineitem where l_orderkey % 89 = 0
"""

LINEITEM_WITH_COPIES = "select * from lineitem union all select * from lineitem where l_orderkey % 7 = 0"

EVENTS_SOURCE = """
select event_id, ts, user_id, event_type,
       case when event_id % 50 = 0 then null else value end as value, props
from events
"""
EVENTS_TARGET = f"""
select event_id, ts, user_id, case when event_id % 70 = 0 then null else event_type end as event_type, value, props
from ({EVENTS_SOURCE})
"""

ORDERS_TARGET = """
select o_orderkey, o_custkey, o_orderstatus,
       case when o_orderkey % 101 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
       o_orderdate, o_orderpriority
from orders where o_orderkey % 97 <> 0
union all
select -o_orderkey - 1 as o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderkey % 89 = 0
"""


def not_exists(outer: str, inner: str, cols: list[str]) -> str:
    cond = " and ".join(f"{inner}.{c} is not distinct from {outer}.{c}" for c in cols)
    return f"not exists (select 1 from {inner} where {cond})"


def missing_sql(source: str, target: str, cols: list[str], s_where: str = "true", t_where: str = "true") -> str:
    sel = ", ".join(cols)
    return f"""
with s as (select {sel} from ({source}) where {s_where}),
     t as (select {sel} from ({target}) where {t_where})
select 'missing_in_target' as issue_type, {', '.join('s.' + c for c in cols)} from s where {not_exists('s', 't', cols)}
union all
select 'missing_in_source' as issue_type, {', '.join('t.' + c for c in cols)} from t where {not_exists('t', 's', cols)}
"""


def evidence_text(cols: list[str], alias: str) -> str:
    """``k=v;...`` sorted by key, as ``map_as_text(evidence_map(cols))``."""
    parts = [f"'{c}=' || coalesce(cast({alias}.{c} as varchar), 'NULL')" for c in sorted(cols)]
    return "concat_ws(';', " + ", ".join(parts) + ")"

DOC_NAME = """case when doc_id % 10 = 0 then '__materialization_mat_' || lang || '_doc_' || cast(doc_id as varchar)
     when doc_id % 15 = 0 then 'event_log_' || lang || '_doc_' || cast(doc_id as varchar)
     else lang || '_doc_' || cast(doc_id as varchar) end"""

DOC_TYPE = "case when doc_id % 6 = 0 then 'VIEW' when doc_id % 4 = 0 then 'EXTERNAL' else 'MANAGED' end"

DOCUMENT_LISTING = f"""
select source as schema_name, {DOC_NAME} as table_name, {DOC_TYPE} as table_type,
       case when doc_id % 5 = 0 then 'pl-' || source end as pipeline_id,
       case when doc_id % 6 = 0 then null
            when doc_id % 3 = 0 then 's3://lake/' || source || '/tables/' || cast(doc_id as varchar)
            else 's3://lake/' || source || '/ext/' || cast(doc_id as varchar) end as storage_location,
       doc_id
from documents
"""

PIPELINE_TABLES = f"""
select 'main' as catalog_name, schema_name, table_name, pipeline_id, doc_id
from ({DOCUMENT_LISTING}) where pipeline_id is not null
"""

_PID = "replace('pl-' || source, '-', '_')"
EXISTING_BACKING = f"""
select case when doc_id % 3 = 0 then 'main.' || source || '.__materialization_mat_' || {_PID} || '_' || {DOC_NAME} || '_1'
            when doc_id % 3 = 1 then '__internal.__dlt_materialization_schema_' || {_PID} || '.__materialization_mat_' || {_PID} || '_' || {DOC_NAME} || '_1'
            when doc_id % 4 = 0 then '__internal.__dlt_materialization_schema_' || {_PID} || '.__materialization_mat_' || {DOC_NAME} || '_1'
       end as full_name
from documents where doc_id % 5 = 0 and (doc_id % 3 <> 2 or doc_id % 4 = 0)
"""

BACKING_CANDIDATES = """
select catalog_name, schema_name, table_name, 1 as priority,
       catalog_name || '.' || schema_name || '.__materialization_mat_' || replace(pipeline_id, '-', '_') || '_' || table_name || '_1' as candidate, 'dpm' as label
from pt
union all
select catalog_name, schema_name, table_name, 2,
       '__internal.__dlt_materialization_schema_' || replace(pipeline_id, '-', '_') || '.' || table_name, 'legacy'
from pt
union all
select catalog_name, schema_name, table_name, 3,
       '__internal.__dlt_materialization_schema_' || replace(pipeline_id, '-', '_') || '.__materialization_mat_' || replace(pipeline_id, '-', '_') || '_' || table_name || '_1', 'legacy'
from pt
union all
select catalog_name, schema_name, table_name, 4,
       '__internal.__dlt_materialization_schema_' || replace(pipeline_id, '-', '_') || '.__materialization_mat_' || table_name || '_1', 'legacy'
from pt
"""

PICKED_SOURCE = f"""
with pt as ({PIPELINE_TABLES}),
     c as ({BACKING_CANDIDATES}),
     hit as (select * from c where candidate in (select full_name from ({EXISTING_BACKING}))),
     first as (select * from (select *, row_number() over (partition by catalog_name, schema_name, table_name order by priority) rn from hit) where rn = 1),
     objs as (select distinct catalog_name, schema_name, table_name from c)
select o.catalog_name, o.schema_name, o.table_name, f.priority, f.candidate as chosen, f.label
from objs o left join first f using (catalog_name, schema_name, table_name)
"""
