"""Registered bookkeeping and settings queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import oracle as O
from tablesync.operators import bookkeeping as A
from tablesync.operators import nested_settings as N
from tablesync.operators import run_sketches as S
from tablesync.operators import settings as C
from tablesync.plans.registry import query
from tablesync.session import apply_defaults, work_dir
from tablesync.sources import fixtures as X
from tablesync.sources import storage
from tablesync.sources.tables import load

_RESULTS_SQL = """
select 'run_' || cast(event_id % 3 as varchar) as run_id, event_type as operation_type,
       'cat_' || cast(user_id % 4 as varchar) as catalog_name, 'sch_' || cast(user_id % 9 as varchar) as schema_name,
       'obj_' || cast(user_id as varchar) as object_name, 'table' as object_type,
       case when event_type = 'error' then 'failed' when event_type = 'view' then 'skipped' else 'success' end as status,
       ts as start_time,
       ts + to_microseconds(cast(round(abs(coalesce(value, 0.0)) * 1000000) as bigint)) as end_time,
       case when event_type = 'error' then props end as error_message,
       props as details,
       cast(event_id % 3 + 1 as integer) as attempt_number, 3 as max_attempts
from events
"""


# ----------------------------------------------------------------- A1
@query(
    "audit_rows",
    oracle=f"""
select run_id, operation_type, catalog_name, schema_name, object_name, object_type, status, start_time, end_time,
       (epoch_us(end_time) - epoch_us(start_time)) / 1000000.0 as duration_seconds,
       error_message, details, attempt_number, max_attempts,
       '{{"operation":"' || operation_type || '","catalog":"' || catalog_name || '"}}' as config_details
from ({_RESULTS_SQL})
""",
)
def audit_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Audit layout minus the two columns that depend on when and by whom
    the job runs (``logging_time``, ``execution_user``)."""
    apply_defaults(spark)
    res = X.event_results(spark, sf)
    cfg = F.to_json(F.struct(F.col("operation_type").alias("operation"), F.col("catalog_name").alias("catalog")))
    return A.audit_rows(res, config_details=cfg, user="tablesync").drop("logging_time", "execution_user")


@query("audit_append", oracle=f"select run_id, status, count(*) as n from ({_RESULTS_SQL}) group by all")
def audit_append(spark: SparkSession, sf: str) -> DataFrame:
    """Audit rows appended run by run, read back."""
    apply_defaults(spark)
    path = work_dir(spark, "audit") + "/rows"
    rows = A.audit_rows(X.event_results(spark, sf), user="tablesync")
    for run in ("run_0", "run_1", "run_2"):
        A.append_audit(rows.where(F.col("run_id") == run), path)
    return spark.read.parquet(path).groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "run_periods",
    oracle=f"""
select run_id, min(start_time) as start_time, max(end_time) as end_time,
       (epoch_us(max(end_time)) - epoch_us(min(start_time))) / 1000000.0 as duration_seconds,
       count(*) || ' operations: ' || count(*) filter (where status = 'success') || ' succeeded, '
         || count(*) filter (where status = 'failed') || ' failed, ' || count(*) filter (where status = 'skipped') || ' skipped' as summary
from ({_RESULTS_SQL}) group by run_id
""",
)
def run_periods(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return A.run_periods(A.audit_rows(X.event_results(spark, sf), user="tablesync"))


# ----------------------------------------------------------------- A2
@query(
    "run_summary",
    oracle=f"""
with a as ({_RESULTS_SQL})
select run_id, count(*) as total_operations,
       count(*) filter (where status = 'success') as successful_operations,
       count(*) filter (where status = 'failed') as failed_operations,
       count(*) filter (where status = 'skipped') as skipped_operations,
       count(distinct catalog_name) as total_catalogs,
       count(distinct catalog_name || '.' || schema_name) as total_schemas,
       count(distinct catalog_name || '.' || schema_name || '.' || object_name) as total_tables,
       round(count(*) filter (where status = 'success') * 100.0 / count(*), 6) as success_rate,
       round(count(*) filter (where status = 'success') * 100.0 / (count(*) - count(*) filter (where status = 'skipped')), 6) as rate_excluding_skipped,
       case when count(*) filter (where status = 'failed') = 0 then 'completed' else 'completed_with_failures' end as status
from a group by run_id
""",
)
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    audit = A.audit_rows(X.event_results(spark, sf), user="tablesync")
    return A.run_summary(audit)


# ----------------------------------------------------------------- A3
@query(
    "status_rollup",
    oracle=f"""
select catalog_name, operation_type, count(*) as total,
       count(*) filter (where status = 'success') as success,
       count(*) filter (where status = 'failed') as failed,
       count(*) filter (where status = 'skipped') as skipped
from ({_RESULTS_SQL}) group by rollup (catalog_name, operation_type)
""",
)
def status_rollup(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return A.rollup_status(X.event_results(spark, sf), ["catalog_name", "operation_type"], rollup=True)


# ----------------------------------------------------------------- A2 / A3 from sketches
@query(
    "runs_from_sketches",
    oracle=f"""
select operation_type, count(*) as total, count(*) filter (where status = 'success') as successful,
       count(*) filter (where status = 'failed') as failed, count(*) filter (where status = 'skipped') as skipped,
       count(distinct catalog_name) as catalogs, count(distinct catalog_name || '.' || schema_name) as schemas,
       round(count(*) filter (where status = 'success') * 100.0 / count(*), 6) as success_rate, true as objects_close, true as median_close
from ({_RESULTS_SQL}) group by operation_type
""",
)
def runs_from_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """All runs summed up by operation type from what each run stored, beside
    whether the estimates are as close to the exact figures as they promise."""
    apply_defaults(spark)
    audit, by = A.audit_rows(X.event_results(spark, sf)), ["operation_type"]
    counts, durations = storage.held(S.sketch_counts(audit), "run-counts"), storage.held(S.sketch_durations(audit), "run-durations")
    found = S.summarize(counts, by).join(S.duration_quantiles(durations, by, {"median": 0.5}), by)
    name = F.concat_ws(".", "catalog_name", "schema_name", "object_name")
    exact = audit.groupBy(*by).agg(F.countDistinct(name).alias("exact_objects"), F.percentile("duration_seconds", 0.5).alias("exact_median"))
    close = lambda a, b, share: F.abs(F.col(a) - F.col(b)) <= share * F.col(b)
    out = found.join(exact, by).withColumns({"objects_close": close("objects", "exact_objects", 0.03), "median_close": close("median", "exact_median", 0.02)})
    return out.drop("objects", "median", "exact_objects", "exact_median")


# ----------------------------------------------------------------- C1
_SETTINGS_SQL = """
select 'group' as level, '*' as object, 'max_attempts' as key, '3' as value
union all select 'group', '*', 'enforce_schema', 'true'
union all select 'group', '*', 'overwrite_tags', 'false'
union all select 'catalog', r_name, 'max_attempts', cast(r_regionkey + 2 as varchar) from region where r_regionkey % 2 = 0
union all select 'schema', r_name || '.' || n_name, 'enforce_schema', 'false'
          from nation join region on n_regionkey = r_regionkey where n_nationkey % 3 = 0
union all select 'table', r_name || '.' || n_name || '.customer_' || cast(c_custkey as varchar), 'overwrite_tags', 'true'
          from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where c_custkey % 5 = 0
union all select 'table', r_name || '.' || n_name || '.customer_' || cast(c_custkey as varchar), 'max_attempts', '9'
          from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where c_custkey % 7 = 0
union all select 'table', r_name || '.' || n_name || '.customer_' || cast(c_custkey as varchar), 'enforce_schema', null
          from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where c_custkey % 11 = 0
union all select 'schema', r_name || '.' || n_name, 'only_null', null from nation join region on n_regionkey = r_regionkey
"""
_OBJECTS_SQL = """
select r_name as catalog_name, n_name as schema_name, 'customer_' || cast(c_custkey as varchar) as table_name
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""


def _settings_spark(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r, n, c = load(spark, sf, "region"), load(spark, sf, "nation"), load(spark, sf, "customer")
    rn = n.join(r, n.n_regionkey == r.r_regionkey)
    crn = c.join(rn, c.c_nationkey == rn.n_nationkey)
    cname = F.concat(F.lit("customer_"), F.col("c_custkey").cast("string"))
    tname = F.concat_ws(".", "r_name", "n_name", cname)
    group = spark.range(1).select(
        F.inline(F.array(*[F.struct(F.lit("group").alias("level"), F.lit("*").alias("object"), F.lit(k).alias("key"), F.lit(v).alias("value"))
                           for k, v in (("max_attempts", "3"), ("enforce_schema", "true"), ("overwrite_tags", "false"))]))
    )
    settings = (
        group.unionByName(r.where(F.col("r_regionkey") % 2 == 0).select(F.lit("catalog").alias("level"), F.col("r_name").alias("object"), F.lit("max_attempts").alias("key"), (F.col("r_regionkey") + 2).cast("string").alias("value")))
        .unionByName(rn.where(F.col("n_nationkey") % 3 == 0).select(F.lit("schema").alias("level"), F.concat_ws(".", "r_name", "n_name").alias("object"), F.lit("enforce_schema").alias("key"), F.lit("false").alias("value")))
        .unionByName(crn.where(F.col("c_custkey") % 5 == 0).select(F.lit("table").alias("level"), tname.alias("object"), F.lit("overwrite_tags").alias("key"), F.lit("true").alias("value")))
        .unionByName(crn.where(F.col("c_custkey") % 7 == 0).select(F.lit("table").alias("level"), tname.alias("object"), F.lit("max_attempts").alias("key"), F.lit("9").alias("value")))
        .unionByName(crn.where(F.col("c_custkey") % 11 == 0).select(F.lit("table").alias("level"), tname.alias("object"), F.lit("enforce_schema").alias("key"), F.lit(None).cast("string").alias("value")))
        .unionByName(rn.select(F.lit("schema").alias("level"), F.concat_ws(".", "r_name", "n_name").alias("object"), F.lit("only_null").alias("key"), F.lit(None).cast("string").alias("value")))
    )
    objects = crn.select(F.col("r_name").alias("catalog_name"), F.col("n_name").alias("schema_name"), cname.alias("table_name"))
    return settings, objects


@query(
    "effective_settings",
    oracle=f"""
with s as ({_SETTINGS_SQL}), o as ({_OBJECTS_SQL}),
anc as (
  select catalog_name, schema_name, table_name, 0 as rank, 'group' as level, '*' as object from o
  union all select catalog_name, schema_name, table_name, 1, 'catalog', catalog_name from o
  union all select catalog_name, schema_name, table_name, 2, 'schema', catalog_name || '.' || schema_name from o
  union all select catalog_name, schema_name, table_name, 3, 'table', catalog_name || '.' || schema_name || '.' || table_name from o
)
select catalog_name, schema_name, table_name, key, arg_max(value, rank) as value, arg_max(anc.level, rank) as level
from anc join s on anc.level = s.level and anc.object = s.object
where value is not null
group by catalog_name, schema_name, table_name, key
""",
)
def effective_settings(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    settings, objects = _settings_spark(spark, sf)
    return C.effective_settings(settings, objects)


# ----------------------------------------------------------------- C1 nested
_NESTED_SQL = """
select 'group' as level, 0 as rank, '*' as object, unnest(['copy.mode', 'copy.options.parallel', 'copy.options.include', 'retry.max', 'retry.delay']) as path,
       unnest(['"full"', '4', '["a","b"]', '3', '5']) as value
union all select 'catalog', 1, r_name, 'copy.options.parallel', cast(r_regionkey + 8 as varchar) from region where r_regionkey % 2 = 0
union all select 'schema', 2, r_name || '.' || n_name, unnest(['copy.options.include', 'retry']), unnest(['["c"]', '7'])
          from nation join region on n_regionkey = r_regionkey where n_nationkey % 3 = 0
union all select 'table', 3, r_name || '.' || n_name || '.customer_' || cast(c_custkey as varchar), 'copy.options', '"none"'
          from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where c_custkey % 5 = 0
union all select 'table', 3, r_name || '.' || n_name || '.customer_' || cast(c_custkey as varchar), 'retry.delay', '9'
          from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where c_custkey % 7 = 0
"""


@query(
    "nested_settings",
    oracle=f"""
with f as ({_NESTED_SQL}), o as ({_OBJECTS_SQL}),
met as (
  select catalog_name, schema_name, table_name, f.level, f.rank, path, value
  from o join f on f.object in ('*', catalog_name, catalog_name || '.' || schema_name, catalog_name || '.' || schema_name || '.' || table_name)
)
select catalog_name, schema_name, table_name, path, value, level from met a
where not exists (
  select 1 from met b
  where a.catalog_name = b.catalog_name and a.schema_name = b.schema_name and a.table_name = b.table_name and b.rank > a.rank
    and (a.path = b.path or starts_with(a.path, b.path || '.') or starts_with(b.path, a.path || '.'))
)
""",
)
def nested_settings(spark: SparkSession, sf: str) -> DataFrame:
    """JSON settings of four levels merged by path for every customer."""
    apply_defaults(spark)
    r, n, c = load(spark, sf, "region"), load(spark, sf, "nation"), load(spark, sf, "customer")
    rn = n.join(r, n.n_regionkey == r.r_regionkey)
    crn = c.join(rn, c.c_nationkey == rn.n_nationkey)
    cname = F.concat(F.lit("customer_"), F.col("c_custkey").cast("string"))
    schema, table = F.concat_ws(".", "r_name", "n_name"), F.concat_ws(".", "r_name", "n_name", cname)

    def at(df: DataFrame, level: str, name, value) -> DataFrame:
        return df.select(F.lit(level).alias("level"), name.alias("object"), value.alias("value"))

    settings = (
        at(spark.range(1), "group", F.lit("*"), F.lit('{"copy": {"mode": "full", "options": {"parallel": 4, "include": ["a", "b"]}}, "retry": {"max": 3, "delay": 5}, "off": {}}'))
        .unionByName(at(r.where("r_regionkey % 2 = 0"), "catalog", F.col("r_name"), F.concat(F.lit('{"copy": {"options": {"parallel": '), (F.col("r_regionkey") + 8).cast("string"), F.lit('}}, "retry": {"max": null}}'))))
        .unionByName(at(rn.where("n_nationkey % 3 = 0"), "schema", schema, F.lit('{"copy": {"options": {"include": ["c"]}}, "retry": 7}')))
        .unionByName(at(crn.where("c_custkey % 5 = 0"), "table", table, F.lit('{"copy": {"options": "none"}}')))
        .unionByName(at(crn.where("c_custkey % 7 = 0"), "table", table, F.lit('{"retry": {"delay": 9}}')))
    )
    objects = crn.select(F.col("r_name").alias("catalog_name"), F.col("n_name").alias("schema_name"), cname.alias("table_name"))
    return N.effective_nested(settings, objects).withColumn("path", F.array_join("path", "."))


# ----------------------------------------------------------------- C2
_TEMPLATE = "{{catalog_name}}_copy.{{schema_name}}.{{table_name}} <- {{source_name}}"


@query(
    "substitute_names",
    oracle=f"""
select schema_name, table_name,
       replace(replace(replace(replace('{_TEMPLATE}', '{{{{catalog_name}}}}', 'main'), '{{{{schema_name}}}}', schema_name),
               '{{{{table_name}}}}', table_name), '{{{{source_name}}}}', 'main.' || schema_name || '.' || table_name) as resolved
from ({O.DOCUMENT_LISTING})
""",
)
def substitute_names(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    lst = X.document_listing(spark, sf).select("schema_name", "table_name").withColumn("template", F.lit(_TEMPLATE))
    vals = {
        "catalog_name": F.lit("main"),
        "schema_name": F.col("schema_name"),
        "table_name": F.col("table_name"),
        "source_name": F.concat_ws(".", F.lit("main"), F.col("schema_name"), F.col("table_name")),
    }
    return C.substitute_names(lst, "template", vals).select("schema_name", "table_name", "resolved")
