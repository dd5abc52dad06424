"""Registered selection queries (S1-S9) over the document listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import oracle as O
from tablesync.operators import selection as S
from tablesync.plans.registry import query
from tablesync.session import apply_defaults
from tablesync.sources import fixtures as X
from tablesync.sources.tables import load

_HIDE = "not starts_with(table_name, '__materialization_mat') and not starts_with(table_name, 'event_log_')"
_LISTING_COLS = "schema_name, table_name, table_type, pipeline_id, storage_location"

# ----------------------------------------------------------------- S1-S3
_FILTER = "table_schema IN ('src1', 'src2', 'src5') AND table_type <> 'VIEW'"


@query(
    "list_filter",
    oracle=f"""
select schema_name as table_schema, table_name, table_type, pipeline_id, storage_location
from ({O.DOCUMENT_LISTING})
where schema_name in ('src1', 'src2', 'src5') and table_type <> 'VIEW' and {_HIDE}
""",
)
def list_filter(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return S.filter_objects(X.document_listing(spark, sf), _FILTER, renames={"schema_name": "table_schema"})


# ----------------------------------------------------------------- S4
_SELECTION = S.Selection(
    target_schemas=[
        S.SchemaSelection("src1", tables=["en_doc_1", "fr_doc_7", "en_doc_13", "de_doc_19", "en_doc_101"]),
        S.SchemaSelection("src2", exclude_tables=["en_doc_2", "en_doc_3"]),
        S.SchemaSelection("src3", table_filter_expression="table_name LIKE 'en%'"),
        S.SchemaSelection("src4", table_types=["EXTERNAL"]),
        S.SchemaSelection("src6"),
    ],
    table_types=["VIEW"],
    operation="replication",
)


@query(
    "selection",
    oracle=f"""
select {_LISTING_COLS} from ({O.DOCUMENT_LISTING})
where (
   (schema_name = 'src1' and table_name in ('en_doc_1', 'fr_doc_7', 'en_doc_13', 'de_doc_19', 'en_doc_101') and upper(table_type) = 'VIEW')
or (schema_name = 'src2' and table_name not in ('en_doc_2', 'en_doc_3') and upper(table_type) = 'VIEW')
or (schema_name = 'src3' and table_name like 'en%' and upper(table_type) = 'VIEW')
or (schema_name = 'src4' and upper(table_type) in ('EXTERNAL', 'MANAGED'))
or (schema_name = 'src6' and upper(table_type) = 'VIEW')
) and {_HIDE}
""",
)
def selection(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return S.select_objects(X.document_listing(spark, sf), _SELECTION)


# ----------------------------------------------------------------- S5
_CLASSIFY = """case when upper(table_type) <> 'MANAGED' then upper(table_type)
  when pipeline_id is not null and pipeline_id <> '' then 'STREAMING_TABLE'
  when coalesce(storage_location, '') like '%/tables/%' then 'MANAGED'
  else 'EXTERNAL' end"""


@query("classify_type", oracle=f"select {_LISTING_COLS}, {_CLASSIFY} as effective_type from ({O.DOCUMENT_LISTING})")
def classify_type(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return S.classify_type(X.document_listing(spark, sf))


# ----------------------------------------------------------------- S6
@query(
    "filter_types",
    oracle=f"""
select * from (select {_LISTING_COLS}, {_CLASSIFY} as effective_type from ({O.DOCUMENT_LISTING}))
where lower(effective_type) in ('streaming_table', 'external')
""",
)
def filter_types(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return S.filter_types(S.classify_type(X.document_listing(spark, sf)), ["STREAMING_TABLE", "external"])


# ----------------------------------------------------------------- S7 resume
_RUN = "run_1"
_OP = "purchase"


@query(
    "pending_objects",
    oracle=f"""
with objs as (select distinct 'cat_' || cast(user_id % 4 as varchar) as catalog_name, 'sch_' || cast(user_id % 9 as varchar) as schema_name,
                     'obj_' || cast(user_id as varchar) as object_name from events),
done as (select 'cat_' || cast(user_id % 4 as varchar) as catalog_name, 'sch_' || cast(user_id % 9 as varchar) as schema_name,
                'obj_' || cast(user_id as varchar) as object_name
         from events where 'run_' || cast(event_id % 3 as varchar) = '{_RUN}' and event_type = '{_OP}')
select * from objs o where not exists (
  select 1 from done d where d.catalog_name = o.catalog_name and d.schema_name = o.schema_name and d.object_name = o.object_name)
""",
)
def pending_objects(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    audit = X.event_results(spark, sf)
    keys = ["catalog_name", "schema_name", "object_name"]
    objects = audit.select(*keys).distinct()
    return S.pending(objects, S.succeeded(audit, _RUN, _OP), keys)


_TRIED = """
select 'obj_' || cast(user_id % 500 as varchar) as object_name, 'run_' || cast(event_id % 3 as varchar) as run_id,
       event_type as operation_type, case when event_id % 4 = 0 then 'failed' else 'success' end as status
from events
"""


@query(
    "pending_after_failures",
    oracle=f"""
select distinct object_name from ({_TRIED})
except select object_name from ({_TRIED}) where run_id = '{_RUN}' and operation_type = '{_OP}' and status = 'success'
""",
)
def pending_after_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Objects to try again: a quarter of all attempts failed."""
    apply_defaults(spark)
    e = load(spark, sf, "events")
    tried = e.select(
        F.concat(F.lit("obj_"), (F.col("user_id") % 500).cast("string")).alias("object_name"),
        F.concat(F.lit("run_"), (F.col("event_id") % 3).cast("string")).alias("run_id"),
        F.col("event_type").alias("operation_type"),
        F.when(F.col("event_id") % 4 == 0, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
    )
    return S.pending(tried.select("object_name").distinct(), S.succeeded(tried, _RUN, _OP), ["object_name"])


# ----------------------------------------------------------------- S8 shares
_SHARE_SQL = f"""select 'main.' || source || '.' || {O.DOC_NAME} as full_name from documents where doc_id % 7 = 0"""


@query(
    "shared_objects",
    oracle=f"""
select schema_name, table_name, table_type, 'main.' || schema_name || '.' || table_name as full_name
from ({O.DOCUMENT_LISTING}) l
where 'main.' || schema_name || '.' || table_name not in ({_SHARE_SQL}) and {_HIDE}
""",
)
def shared_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Objects still to add to a share: listing minus current members."""
    apply_defaults(spark)
    docs = load(spark, sf, "documents")
    i = F.col("doc_id")
    base = F.concat(F.col("lang"), F.lit("_doc_"), i.cast("string"))
    name = F.when(i % 10 == 0, F.concat(F.lit("__materialization_mat_"), base)).when(i % 15 == 0, F.concat(F.lit("event_log_"), base)).otherwise(base)
    share = docs.where(i % 7 == 0).select(F.concat_ws(".", F.lit("main"), F.col("source"), name).alias("full_name"))
    listing = S.hide_internal(X.document_listing(spark, sf)).select("schema_name", "table_name", "table_type")
    return S.not_shared(listing, share, F.concat_ws(".", F.lit("main"), F.col("schema_name"), F.col("table_name")))


@query(
    "shared_members",
    oracle=f"""
select schema_name, table_name, 'main.' || schema_name || '.' || table_name as full_name
from ({O.DOCUMENT_LISTING}) l where 'main.' || schema_name || '.' || table_name in ({_SHARE_SQL}) and {_HIDE}
""",
)
def shared_members(spark: SparkSession, sf: str) -> DataFrame:
    """Listed objects that are in a share already: every seventh document."""
    apply_defaults(spark)
    docs = load(spark, sf, "documents")
    i = F.col("doc_id")
    base = F.concat(F.col("lang"), F.lit("_doc_"), i.cast("string"))
    name = F.when(i % 10 == 0, F.concat(F.lit("__materialization_mat_"), base)).when(i % 15 == 0, F.concat(F.lit("event_log_"), base)).otherwise(base)
    share = docs.where(i % 7 == 0).select(F.concat_ws(".", F.lit("main"), F.col("source"), name).alias("full_name"))
    listing = S.hide_internal(X.document_listing(spark, sf)).select("schema_name", "table_name")
    return S.shared(listing, share, F.concat_ws(".", F.lit("main"), F.col("schema_name"), F.col("table_name"))).select("schema_name", "table_name", "full_name")


# ----------------------------------------------------------------- S9
@query(
    "with_exists",
    oracle=f"""
with req as (
  select source as schema_name, lang || '_doc_' || case when doc_id % 9 = 0 then 'gone_' else '' end || cast(doc_id as varchar) as table_name
  from documents
),
lst as (select distinct schema_name, table_name from ({O.DOCUMENT_LISTING}))
select r.schema_name, r.table_name, exists (select 1 from lst l where l.schema_name = r.schema_name and l.table_name = r.table_name) as "exists"
from req r
""",
)
def with_exists(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    d = load(spark, sf, "documents")
    i = F.col("doc_id")
    req = d.select(
        F.col("source").alias("schema_name"),
        F.concat(F.col("lang"), F.lit("_doc_"), F.when(i % 9 == 0, F.lit("gone_")).otherwise(F.lit("")), i.cast("string")).alias("table_name"),
    )
    return S.with_exists(req, X.document_listing(spark, sf), ["schema_name", "table_name"])
