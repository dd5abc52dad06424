"""Registered metadata queries (M1-M14) over facts derived from the test
tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import oracle as O
from tablesync.functions.columns import map_as_text
from tablesync.functions.urls import replace_url as replace_url_col
from tablesync.operators import merge
from tablesync.operators import metadata as M
from tablesync.plans.registry import query
from tablesync.session import apply_defaults
from tablesync.sources import fixtures as X
from tablesync.sources.tables import load

# ----------------------------------------------------------------- SQL fixtures
PART_TAGS = """
select p_partkey as object, 'brand' as tag_name, p_brand as tag_value from part
union all select p_partkey, 'type', p_type from part
union all select p_partkey, 'size', cast(p_size as varchar) from part
"""
PART_TAGS_TARGET = f"""
select object, tag_name, case when tag_name = 'brand' and object % 11 = 0 then 'old' else tag_value end as tag_value
from ({PART_TAGS}) where not (tag_name = 'type' and object % 7 = 0)
union all select p_partkey, 'legacy', 'y' from part where p_partkey % 13 = 0
"""


def _tag_plan_sql(src: str, tgt: str, keys: list[str], overwrite: bool) -> str:
    k = keys + ["tag_name"]
    on = " and ".join(f"s.{c} = t.{c}" for c in k)
    sel = ", ".join(f"coalesce(s.{c}, t.{c}) as {c}" for c in k)
    if overwrite:
        action = "case when s.v is not null and t.v is not null and s.v = t.v then 'keep' when s.v is not null then 'set' else 'unset' end"
        value = "s.v"
    else:
        action = "case when t.v is not null then 'keep' else 'set' end"
        value = "coalesce(t.v, s.v)"
    return f"""
select {sel}, {action} as action, {value} as tag_value
from (select {', '.join(k)}, max(trim(tag_value)) as v from ({src}) where tag_value is not null group by all) s
full outer join (select {', '.join(k)}, max(trim(tag_value)) as v from ({tgt}) where tag_value is not null group by all) t on {on}
"""


def _col_tags_sql(target: bool) -> str:
    rows = """
select 'supplier_' || cast(s_suppkey as varchar) as table_name, s_suppkey as k, 's_name' as column_name, 'pii' as tag_name, 'name' as tag_value from supplier
union all select 'supplier_' || cast(s_suppkey as varchar), s_suppkey, 's_nationkey', 'geo', cast(s_nationkey as varchar) from supplier
union all select 'supplier_' || cast(s_suppkey as varchar), s_suppkey, 's_acctbal', 'fin', 'balance' from supplier
"""
    if not target:
        return f"select table_name, column_name, tag_name, tag_value from ({rows})"
    return f"""
select table_name, column_name, tag_name,
       case when column_name = 's_nationkey' and k % 6 = 0 then 'moved' else tag_value end as tag_value
from ({rows}) where k % 4 <> 0
"""


# ----------------------------------------------------------------- M1
@query(
    "tag_rollup",
    oracle=f"""
select object, string_agg(tag_name, ',' order by tag_name) as tag_names, count(*) as n_tags
from (select distinct object, tag_name, trim(tag_value) as tag_value from ({PART_TAGS_TARGET}))
where object in (select p_partkey from part)
group by object
""",
)
def tag_rollup(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    objects = load(spark, sf, "part").select(F.col("p_partkey").alias("object"))
    r = M.tag_rollup(objects, X.part_tags_target(spark, sf), ["object"])
    return r.select("object", F.array_join("tag_names", ",").alias("tag_names"), F.size("tag_maps").cast("bigint").alias("n_tags"))


@query(
    "tag_rollup_values",
    oracle=f"select distinct object, tag_name, trim(tag_value) as tag_value from ({PART_TAGS_TARGET}) where object in (select p_partkey from part)",
)
def tag_rollup_values(spark: SparkSession, sf: str) -> DataFrame:
    """The maps of the roll-up, spread out again."""
    apply_defaults(spark)
    objects = load(spark, sf, "part").select(F.col("p_partkey").alias("object"))
    r = M.tag_rollup(objects, X.part_tags_target(spark, sf), ["object"])
    return r.select("object", F.explode("tag_maps").alias("m")).select("object", F.explode("m").alias("tag_name", "tag_value"))


# ----------------------------------------------------------------- M2
@query("tag_plan_overwrite", oracle=_tag_plan_sql(PART_TAGS, PART_TAGS_TARGET, ["object"], True))
def tag_plan_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return M.tag_plan(X.part_tags(spark, sf), X.part_tags_target(spark, sf), ["object"], overwrite=True)


@query("tag_plan_keep", oracle=_tag_plan_sql(PART_TAGS, PART_TAGS_TARGET, ["object"], False))
def tag_plan_keep(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return M.tag_plan(X.part_tags(spark, sf), X.part_tags_target(spark, sf), ["object"], overwrite=False)


# ----------------------------------------------------------------- M3
@query("column_tag_plan", oracle=_tag_plan_sql(_col_tags_sql(False), _col_tags_sql(True), ["table_name", "column_name"], True))
def column_tag_plan(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return M.tag_plan(X.column_tags(spark, sf, False), X.column_tags(spark, sf, True), ["table_name", "column_name"], overwrite=True)


@query("column_tag_plan_keep", oracle=_tag_plan_sql(_col_tags_sql(False), _col_tags_sql(True), ["table_name", "column_name"], False))
def column_tag_plan_keep(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return M.tag_plan(X.column_tags(spark, sf, False), X.column_tags(spark, sf, True), ["table_name", "column_name"], overwrite=False)


# ----------------------------------------------------------------- M6 column comments
_DOC_COMMENTS_SRC = "select cast(doc_id as varchar) as table_name, 'lang' as column_name, source as comment from documents"
_DOC_COMMENTS_TGT = """select cast(doc_id as varchar) as table_name, 'lang' as column_name,
  case when doc_id % 5 = 0 then '' when doc_id % 7 = 0 then 'changed' else source end as comment from documents"""


@query(
    "comment_plan",
    oracle=f"""
select coalesce(s.table_name, t.table_name) as table_name, coalesce(s.column_name, t.column_name) as column_name,
       case when s.c = '' then 'clear' else 'set' end as action, s.c as comment
from (select table_name, column_name, trim(coalesce(comment, '')) as c from ({_DOC_COMMENTS_SRC})) s
full outer join (select table_name, column_name, trim(coalesce(comment, '')) as c from ({_DOC_COMMENTS_TGT})) t
  on s.table_name = t.table_name and s.column_name = t.column_name
where s.c is distinct from t.c and s.c is not null
""",
)
def comment_plan(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return M.column_comment_plan(X.document_comments(spark, sf, False), X.document_comments(spark, sf, True), ["table_name"], overwrite=True)


_CUT_TGT = f"select * from ({_DOC_COMMENTS_TGT}) where cast(table_name as bigint) % 4 <> 0"
_CLEARED_SRC = f"select table_name, column_name, case when cast(table_name as bigint) % 6 = 0 then ' ' else comment end as comment from ({_DOC_COMMENTS_SRC})"


def _cleared(spark: SparkSession, sf: str) -> DataFrame:
    """Source comments, blank for every sixth table."""
    d = X.document_comments(spark, sf, False)
    return d.withColumn("comment", F.when(F.col("table_name").cast("bigint") % 6 == 0, F.lit(" ")).otherwise(F.col("comment")))


@query(
    "comment_plan_keep",
    oracle=f"""
select table_name, column_name, if(trim(comment) = '', 'clear', 'set') as action, trim(comment) as comment
from ({_CLEARED_SRC}) where table_name not in (select table_name from ({_CUT_TGT}))
""",
)
def comment_plan_keep(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    there = X.document_comments(spark, sf, True).where(F.col("table_name").cast("bigint") % 4 != 0)
    return M.column_comment_plan(_cleared(spark, sf), there, ["table_name"], overwrite=False)


@query(
    "comment_statements",
    oracle=f"""
with t as (select table_name, cast(table_name as bigint) % 5 as k, trim(comment) as c from ({_CLEARED_SRC}) s
           where trim(comment) is distinct from (select trim(x.comment) from ({_DOC_COMMENTS_TGT}) x where x.table_name = s.table_name))
select distinct table_name, case k when 0 then 'skipped' when 1 then 'column' when 2 then 'column' else 'table' end as kind,
       case k when 0 then null when 1 then 'COMMENT ON COLUMN tgt.' || table_name || '.`lang` IS ' || chr(39) || c || chr(39)
              when 2 then 'ALTER STREAMING TABLE tgt.' || table_name || ' ALTER COLUMN `lang` COMMENT ' || chr(39) || c || chr(39)
              else 'ALTER TABLE tgt.' || table_name || ' ALTER COLUMN `lang` COMMENT ' || chr(39) || c || chr(39) end as statement
from t
""",
)
def comment_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Statements of an overwrite plan with comments to clear, for tables of five types."""
    apply_defaults(spark)
    source = _cleared(spark, sf)
    plan = M.column_comment_plan(source, X.document_comments(spark, sf, True), ["table_name"], overwrite=True)
    kinds = F.array(*[F.lit(t) for t in ("volume", "view", "streaming_table", "managed", "external")])
    types = source.select("table_name", F.element_at(kinds, (F.col("table_name").cast("bigint") % 5 + 1).cast("int")).alias("table_type"))
    return M.comment_statements(plan, types, "tgt.")


@query("column_comments", oracle=f"select table_name, 'lang' as column_name, trim(coalesce(comment, '')) as comment from ({_CLEARED_SRC})")
def column_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Collected comment maps, spread out again."""
    apply_defaults(spark)
    collected = M.column_comments(_cleared(spark, sf), ["table_name"])
    return collected.select("table_name", F.explode("comment_maps").alias("m")).select("table_name", F.explode("m").alias("column_name", "comment"))


# ----------------------------------------------------------------- M4 table comments
_TTYPE = "case when doc_id % 11 = 0 then 'volume' when doc_id % 9 = 0 then 'view' else 'managed' end"
_TC_SRC = f"select 'doc_' || cast(doc_id as varchar) as table_name, {_TTYPE} as table_type, source || ' ' || lang as comment from documents"
_TC_TGT = """select 'doc_' || cast(doc_id as varchar) as table_name,
  case when doc_id % 5 = 0 then '' when doc_id % 8 = 0 then null when doc_id % 7 = 0 then 'changed' else source || ' ' || lang end as comment
from documents"""


@query(
    "table_comment_plan",
    oracle=f"""
select s.table_name, s.table_type,
       case when lower(s.table_type) not in ('managed', 'external', 'view') then 'skip'
            when coalesce(s.comment, '') = '' then 'clear' else 'set' end as action,
       coalesce(s.comment, '') as comment
from ({_TC_SRC}) s join ({_TC_TGT}) t on s.table_name = t.table_name
where not ((coalesce(s.comment, '') = '' and coalesce(t.comment, '') = '') or s.comment is not distinct from t.comment)
""",
)
def table_comment_plan(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return M.table_comment_plan(X.table_comments(spark, sf, False), X.table_comments(spark, sf, True), overwrite=True)


# ----------------------------------------------------------------- M7 grants
def _grants_sql(target: bool, securable: str = "'orders'") -> str:
    if not target:
        return f"select distinct {securable} as securable, cast(o_custkey as varchar) as principal, o_orderpriority as privilege from orders"
    return f"""
select distinct {securable} as securable, cast(if(o_orderkey % 11 = 0, -o_custkey, o_custkey) as varchar) as principal,
       if(o_orderkey % 7 = 0, '1-URGENT', o_orderpriority) as privilege
from orders where o_orderkey % 3 <> 0"""


def _grant_plan_sql(hard: bool, securable: str = "'orders'") -> str:
    keep = "true" if hard else "in_source = 1"
    return f"""
with u as (
  select securable, principal, privilege, 1 as s, 0 as t from ({_grants_sql(False, securable)})
  union all
  select securable, principal, privilege, 0, 1 from ({_grants_sql(True, securable)})
), tr as (select securable, principal, privilege, max(s) as s, max(t) as t from u group by all),
pp as (
  select securable, principal, max(s) as in_source,
         coalesce(string_agg(case when s = 1 and t = 0 then privilege end, ',' order by privilege), '') as add,
         coalesce(string_agg(case when t = 1 and s = 0 then privilege end, ',' order by privilege), '') as remove
  from tr group by all
)
select securable, principal, add, remove from pp where {keep} and (add <> '' or remove <> '')
"""


def _grant_plan_spark(spark: SparkSession, sf: str, hard: bool) -> DataFrame:
    p = M.grant_plan(X.order_grants(spark, sf, False), X.order_grants(spark, sf, True), hard_sync=hard)
    return p.select("securable", "principal", F.array_join("add", ",").alias("add"), F.array_join("remove", ",").alias("remove"))


@query("grant_plan", oracle=_grant_plan_sql(False))
def grant_plan(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return _grant_plan_spark(spark, sf, False)


@query("grant_plan_hard", oracle=_grant_plan_sql(True))
def grant_plan_hard(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return _grant_plan_spark(spark, sf, True)


# ----------------------------------------------------------------- M8 principals
def _uuid_sql(k: str) -> str:
    h = f"md5(cast({k} as varchar))"
    return f"(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || substr({h},17,4) || '-' || substr({h},21,12))"


_PRINCIPAL = f"""case when c_custkey % 4 = 0 then {_uuid_sql('c_custkey')}
  when c_custkey % 4 = 1 then 'user' || cast(c_custkey as varchar) || '@src.example'
  else 'group' || cast(c_custkey as varchar) end"""

_MAP_PRINCIPALS_SQL = f"""
with used as (select {_PRINCIPAL} as principal from customer),
mapping as (
  select 'user' || cast(c_custkey as varchar) || '@src.example' as src, 'user' || cast(c_custkey as varchar) || '@tgt.example' as dst from customer where c_custkey % 8 = 1
  union all select {_uuid_sql('c_custkey')}, 'sp-mapped-' || cast(c_custkey as varchar) from customer where c_custkey % 12 = 0
  union all select 'sp-' || cast(c_custkey as varchar), 'sp-renamed-' || cast(c_custkey as varchar) from customer where c_custkey % 16 = 4
),
sdir as (select {_uuid_sql('c_custkey')} as app_id, 'sp-' || cast(c_custkey as varchar) as display_name from customer where c_custkey % 4 = 0 and c_custkey % 3 <> 0),
tdir as (
  select 'sp-' || cast(c_custkey as varchar) as display_name, {_uuid_sql('-c_custkey - 1')} as app_id from customer where c_custkey % 4 = 0 and c_custkey % 5 <> 0
  union all select 'sp-mapped-' || cast(c_custkey as varchar), {_uuid_sql('-c_custkey - 1')} from customer where c_custkey % 4 = 0 and c_custkey % 12 = 0
  union all select 'sp-renamed-' || cast(c_custkey as varchar), {_uuid_sql('-c_custkey - 1')} from customer where c_custkey % 4 = 0 and c_custkey % 16 = 4
),
r as (
  select p.principal,
         m1.dst as m1, sd.display_name as sname, m2.dst as m2,
         case when m1.dst is null or regexp_full_match(m1.dst, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}') then m1.dst else coalesce(t1.app_id, m1.dst) end as r1,
         case when m2.dst is null or regexp_full_match(m2.dst, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}') then m2.dst else coalesce(t2.app_id, m2.dst) end as r2,
         t3.app_id as same,
         length(p.principal) = 36 and position('@' in p.principal) = 0
           and regexp_full_match(p.principal, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}') as is_sp
  from (select distinct principal from used) p
  left join mapping m1 on m1.src = p.principal
  left join sdir sd on sd.app_id = p.principal
  left join mapping m2 on m2.src = sd.display_name
  left join tdir t1 on t1.display_name = m1.dst
  left join tdir t2 on t2.display_name = m2.dst
  left join tdir t3 on t3.display_name = sd.display_name
),
f as (
  select principal, sname, m1, is_sp,
         case when m1 is not null then r1
              when is_sp and sname is not null and m2 is not null then r2
              when is_sp and same is not null then same
              else principal end as target_principal
  from r
)
select u.principal, f.target_principal,
       f.is_sp and f.target_principal = f.principal and f.m1 is null as skipped,
       case when f.is_sp and f.target_principal = f.principal and f.m1 is null then
         'no target principal for application ' || f.principal || case when f.sname is not null then ', named ' || f.sname else ', whose name is unknown' end end as skip_reason
from used u join f on u.principal = f.principal
"""


@query("map_principals", oracle=_MAP_PRINCIPALS_SQL)
def map_principals(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    t = X.principal_tables(spark, sf)
    return M.map_principals(t["principals"], t["mapping"], t["source_dir"], t["target_dir"])


_ORDER_PRINCIPAL = _PRINCIPAL.replace("c_custkey", "o_custkey")


@query(
    "grant_sync",
    oracle=f"""
with map as (select distinct principal, target_principal, skipped from ({_MAP_PRINCIPALS_SQL})),
src as (select distinct o_orderstatus as securable, {_ORDER_PRINCIPAL} as principal, o_orderpriority as privilege from orders),
tgt as (
  select distinct o_orderstatus as securable, target_principal as principal, o_orderpriority as privilege
  from orders join map on map.principal = {_ORDER_PRINCIPAL} where o_orderkey % 3 <> 0
),
want as (select distinct securable, target_principal as principal, privilege from src join map using (principal) where not skipped),
ch as (
  select securable, 'applied' as st from (select * from want except select * from tgt)
  union all
  select t.securable, 'applied' from (select * from tgt except select * from want) t
  where exists (select 1 from want w where w.securable = t.securable and w.principal = t.principal)
  union all
  select securable, 'skipped' from src join map using (principal) where skipped
)
select securable, count(*) filter (where st = 'applied') as applied, cast(0 as bigint) as failed,
       count(*) filter (where st = 'skipped') as skipped,
       case when count(*) filter (where st = 'skipped') > 0 then 'failed' else 'success' end as status
from ch group by securable
""",
)
def grant_sync(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as source grants of customers' principals; the target has
    two thirds of them under target names.  Mapped, diffed, and the outcome per securable."""
    apply_defaults(spark)
    o = load(spark, sf, "orders")
    grants = o.select("o_orderkey", F.col("o_orderstatus").alias("securable"), X.customer_principal(F.col("o_custkey")).alias("principal"), F.col("o_orderpriority").alias("privilege"))
    t = X.principal_tables(spark, sf)
    source = grants.drop("o_orderkey").distinct()
    there = M.map_principals(source.select("principal").distinct(), t["mapping"], t["source_dir"], t["target_dir"])
    target = grants.where(F.col("o_orderkey") % 3 != 0).join(there, "principal").select("securable", F.col("target_principal").alias("principal"), "privilege").distinct()
    changes = M.grant_changes(source, target, t["mapping"], t["source_dir"], t["target_dir"])
    status = F.when(F.col("skip_reason").isNotNull(), F.lit("skipped")).otherwise(F.lit("applied"))
    return M.apply_outcome(changes.withColumn("status", status), ["securable"])


# ----------------------------------------------------------------- M9 outcome
_OUTCOME_STATUS = """case when cast(principal as bigint) % 11 = 0 then 'skipped'
  when op = 'remove' and privilege = '1-URGENT' and cast(principal as bigint) % 7 = 0 then 'failed'
  else 'applied' end"""


@query(
    "apply_outcome",
    oracle=f"""
with p as ({_grant_plan_sql(False, 'o_orderstatus')}),
ch as (
  select securable, principal, 'add' as op, unnest(string_split(add, ',')) as privilege from p where add <> ''
  union all
  select securable, principal, 'remove', unnest(string_split(remove, ',')) from p where remove <> ''
)
select securable,
       count(*) filter (where st = 'applied') as applied,
       count(*) filter (where st = 'failed') as failed,
       count(*) filter (where st = 'skipped') as skipped,
       case when count(*) filter (where st <> 'applied') > 0 then 'failed' else 'success' end as status
from (select *, {_OUTCOME_STATUS} as st from ch) group by securable
""",
)
def apply_outcome(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    securable = F.col("o_orderstatus")
    plan = M.grant_plan(X.order_grants(spark, sf, False, securable), X.order_grants(spark, sf, True, securable))
    changes = plan.select("securable", "principal", F.lit("add").alias("op"), F.explode("add").alias("privilege")).unionByName(
        plan.select("securable", "principal", F.lit("remove").alias("op"), F.explode("remove").alias("privilege"))
    )
    k = F.col("principal").cast("bigint")
    status = F.when(k % 11 == 0, F.lit("skipped")).when((F.col("op") == "remove") & (F.col("privilege") == "1-URGENT") & (k % 7 == 0), F.lit("failed")).otherwise(F.lit("applied"))
    return M.apply_outcome(changes.withColumn("status", status), ["securable"])


# ----------------------------------------------------------------- M10 URL remap (mapping table)
_MIRROR = "https://mirror.example/"


@query(
    "remap_url",
    oracle=f"""
with m as (
  select distinct regexp_extract(url, '^[a-z]+://[^/]+/', 0) as src from pages
  where regexp_extract(url, '^[a-z]+://[^/]+/', 0) like '%.org/'
)
select p.site, p.url,
       case when m.src is null then null
            when substr(p.url, length(m.src) + 1) = '' then '{_MIRROR}'
            else rtrim('{_MIRROR}', '/') || '/' || ltrim(substr(p.url, length(m.src) + 1), '/') end as mapped_url
from (select case when page_id % 10 <> 0 then page_id % 20 end as site, case when page_id % 25 <> 0 then url end as url from pages) p
left join m on starts_with(lower(p.url), lower(m.src))
""",
)
def remap_url(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    """Rows whose key repeats or is null, and rows without a URL, each by their own URL."""
    pages = load(spark, sf, "pages")
    host = F.regexp_extract("url", r"^[a-z]+://[^/]+/", 0)
    mapping = pages.select(host.alias("src")).where(F.col("src").endswith(".org/")).distinct().select("src", F.lit(_MIRROR).alias("dst"))
    k = F.col("page_id")
    rows = pages.select(F.when(k % 10 != 0, k % 20).alias("site"), F.when(k % 25 != 0, F.col("url")).alias("url"))
    return M.remap_url_table(rows, "url", mapping)


# ----------------------------------------------------------------- M11 URL replace in text
_REPLACE_MAP = [("https://thther.example.org/", "https://mirror.example/"), (".example.org", ".mirror.example")]


@query(
    "replace_url",
    oracle=f"""
select page_id,
       md5(case when contains(lower(html), 'https://thther.example.org') then regexp_replace(html, '(?i)\\Qhttps://thther.example.org\\E', 'https://mirror.example', 'g')
                when contains(lower(html), '.example.org') then regexp_replace(html, '(?i)\\Q.example.org\\E', '.mirror.example', 'g')
                else html end) as text_md5
from pages
""",
)
def replace_url(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    pages = load(spark, sf, "pages")
    return pages.select("page_id", F.md5(replace_url_col(F.col("html"), _REPLACE_MAP, first_only=True)).alias("text_md5"))


# ----------------------------------------------------------------- M12 properties
_PROP_WHITELIST = ["name", "nation", "location"]


@query(
    "property_plan",
    oracle="""
with s as (select 'supplier_' || cast(s_suppkey as varchar) as object,
                  'location=s3://dst-bucket/suppliers/' || cast(s_suppkey as varchar) || ';name=' || s_name || ';nation=' || cast(s_nationkey as varchar) as p
           from supplier),
     t as (select 'supplier_' || cast(s_suppkey as varchar) as object,
                  'location=s3://dst-bucket/suppliers/' || cast(s_suppkey as varchar) || ';name=' || case when s_suppkey % 7 = 0 then s_name || '-old' else s_name end
                  || ';nation=' || cast(s_nationkey as varchar) as p
           from supplier where s_suppkey % 10 <> 0)
select s.object, case when t.object is null then 'create' when s.p = t.p then 'noop' else 'update' end as action, s.p as properties
from s left join t on s.object = t.object
""",
)
def property_plan(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    plan = M.property_plan(
        X.supplier_properties(spark, sf, False), X.supplier_properties(spark, sf, True), _PROP_WHITELIST,
        location_map=[("s3://src-bucket/", "s3://dst-bucket/")],
    )
    return plan.select("object", "action", map_as_text(F.col("properties")).alias("properties"))


# ----------------------------------------------------------------- M13 DDL rewrite
_DDL_SQL = f"""
with l as ({O.DOCUMENT_LISTING}),
p as (
  select *, length(table_name) as n,
         case when schema_name in ('src2', 'src5') then '`main`.`' || schema_name || '`.`' || table_name || '`'
              else 'main.' || schema_name || '.' || table_name end as name,
         'tgt.' || schema_name || '.' || table_name as target_name, schema_name in ('src1', 'src3') as as_managed
  from l
),
b as (
  select *, case when table_type = 'VIEW' then 'VIEW' else 'TABLE' end as word,
         case when n % 5 = 0 then '-- once: CREATE TABLE main.x' || chr(10) else '' end as lead,
         case when table_type = 'VIEW' then
                case when n % 2 = 0 then ' (doc_id, lang)' else '' end
                || case when n % 3 = 0 then chr(10) || 'COMMENT ''rows of main.docs as text (short)''' else '' end
                || case when n % 3 = 1 then chr(10) || 'AS ' else ' AS ' end || 'SELECT doc_id, count(*) AS n FROM '
              else case when n % 3 = 0 then ''
                        else ' (' || chr(10) || '  doc_id BIGINT,' || chr(10) || '  lang STRING COMMENT ''see LOCATION ''''x'''' of main.t'')' end
                || chr(10) || 'USING parquet' end as rest,
         case when table_type = 'VIEW' then '.' || schema_name || '.docs WHERE length(text) > 10 GROUP BY ALL' else '' end as query_end,
         case when table_type = 'VIEW' then 'main' else '' end as from_catalog, case when table_type = 'VIEW' then 'tgt' else '' end as to_catalog
  from p
)
select schema_name, table_name, table_type,
       lead || 'CREATE ' || word || ' ' || name || rest || from_catalog || query_end
         || case when table_type = 'EXTERNAL' then chr(10) || 'LOCATION ''' || storage_location || '''' else '' end as ddl,
       lead || 'CREATE OR REPLACE ' || word || ' ' || target_name || rest || to_catalog || query_end
         || case when table_type <> 'EXTERNAL' then '' when as_managed then chr(10)
                 else chr(10) || 'LOCATION ''' || replace(storage_location, 's3://lake', 's3://mirror-lake') || '''' end as target_ddl
from b
"""


@query("rewrite_ddl", oracle=_DDL_SQL)
def rewrite_ddl(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    d = X.listing_ddl(spark, sf).withColumn("target_name", F.concat_ws(".", F.lit("tgt"), "schema_name", "table_name"))
    out = M.rewrite_ddl(
        d, "ddl", "table_type", "target_name", replace=True,
        as_managed=F.col("schema_name").isin("src1", "src3"), url_map=[("s3://lake/", "s3://mirror-lake/")],
        catalog=("main", "tgt"),
    )
    return out.select("schema_name", "table_name", "table_type", "ddl", "target_ddl")


# ----------------------------------------------------------------- M2 three-way merge
_TAG_EDITS = f"""
select object, tag_name, case when tag_name = 'brand' and object % 5 = 0 then 'src' else tag_value end as tag_value
from ({PART_TAGS}) where not (tag_name = 'size' and object % 6 = 0)
"""
_SOURCE_TAGS = f"{_TAG_EDITS} union all select p_partkey, 'legacy', case when p_partkey % 2 = 0 then 'y' else 'n' end from part where p_partkey % 26 < 2"


def _source_edits(spark: SparkSession, sf: str) -> DataFrame:
    """part's tags after edits at the source: brands, sizes taken away, a tag that the target added too."""
    tags, o = X.part_tags(spark, sf), F.col("object")
    edited = tags.where(~((F.col("tag_name") == "size") & (o % 6 == 0))).withColumn("tag_value", F.when((F.col("tag_name") == "brand") & (o % 5 == 0), F.lit("src")).otherwise(F.col("tag_value")))
    k = F.col("p_partkey")
    added = load(spark, sf, "part").where(k % 26 < 2).select(k.alias("object"), F.lit("legacy").alias("tag_name"), F.when(k % 2 == 0, F.lit("y")).otherwise(F.lit("n")).alias("tag_value"))
    return edited.unionByName(added)


@query(
    "tag_merge_three_way",
    oracle=f"""
with b as (select object, tag_name, tag_value as v, true as h from ({PART_TAGS})),
s as (select object, tag_name, tag_value as v, true as h from ({_SOURCE_TAGS})),
t as (select object, tag_name, tag_value as v, true as h from ({PART_TAGS_TARGET})),
j as (
  select object, tag_name, b.v as bv, s.v as sv, t.v as tv, coalesce(b.h, false) as bh, coalesce(s.h, false) as sh, coalesce(t.h, false) as th
  from b full join s using (object, tag_name) full join t using (object, tag_name)
),
e as (select *, bh <> sh or bv is distinct from sv as es, bh <> th or bv is distinct from tv as et, sh = th and sv is not distinct from tv as st from j),
w as (select *, case when es and et then case when st then 'both' else 'conflict' end when es then 'source' when et then 'target' else 'unchanged' end as origin from e)
select object, tag_name, origin, case when origin <> 'source' then 'keep' when sh then 'set' else 'unset' end as action,
       case when origin = 'source' then sv else tv end as tag_value, case when origin = 'source' then sh else th end as remains
from w
""",
)
def tag_merge_three_way(spark: SparkSession, sf: str) -> DataFrame:
    """Tags of part, edited on both sides since the last sync, conflicts settled for the target."""
    apply_defaults(spark)
    plan = merge.three_way_plan(_source_edits(spark, sf), X.part_tags_target(spark, sf), X.part_tags(spark, sf), ["object", "tag_name"], "tag_value")
    return plan.select("object", "tag_name", "origin", "action", "tag_value", "remains")


# ----------------------------------------------------------------- M14 apply
@query("apply_facts", oracle=f"select object, tag_name, trim(tag_value) as tag_value from ({PART_TAGS})")
def apply_facts(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    src, tgt = X.part_tags(spark, sf), X.part_tags_target(spark, sf)
    plan = M.tag_plan(src, tgt, ["object"], overwrite=True)
    return M.apply_facts(tgt, plan, ["object", "tag_name"], "tag_value")
