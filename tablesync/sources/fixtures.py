"""Source / target pairs and fact tables derived from the test tables.

Each derived target differs from its source in a known, deterministic way
(dropped, changed, added, nulled rows or columns), so every operator works on
whole tables whose size grows with the data.  The same recipes are written
as DuckDB SQL in :mod:`tablesync.oracle` for the correctness gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.sources.tables import load

def _added_key(key: str):
    """A key that no table holds: the negative of an own one."""
    return -F.col(key) - 1


# --------------------------------------------------------------------- P1 lineitem
def lineitem_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem without orders divisible by 97, quantity +1 for parts
    divisible by 101, plus copies of orders divisible by 89 under new keys."""
    li = load(spark, sf_dir, "lineitem")
    kept = li.where(F.col("l_orderkey") % 97 != 0).withColumn(
        "l_quantity", F.when(F.col("l_partkey") % 101 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    added = li.where(F.col("l_orderkey") % 89 == 0).withColumn("l_orderkey", _added_key("l_orderkey"))
    return kept.unionByName(added)


# --------------------------------------------------------------------- P2 events with nulls
def events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.withColumn("value", F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("double")).otherwise(F.col("value")))


def events_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_source(spark, sf_dir).withColumn(
        "event_type", F.when(F.col("event_id") % 70 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    )


# --------------------------------------------------------------------- P3 orders keyed
def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    kept = o.where(F.col("o_orderkey") % 97 != 0).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 101 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    added = o.where(F.col("o_orderkey") % 89 == 0).withColumn("o_orderkey", _added_key("o_orderkey"))
    return kept.unionByName(added)


# --------------------------------------------------------------------- versioned changes
def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as changes: version 1 of all, balance +1 for keys divisible by 3,
    deletes of those divisible by 5, of which those divisible by 10 come back with
    balance -1; changes of keys divisible by 7 come twice."""
    c = load(spark, sf_dir, "customer")
    k, none = F.col("c_custkey"), F.lit(None).cast("double")
    steps = [
        (1, F.lit(True), F.col("c_acctbal"), False), (2, k % 3 == 0, F.col("c_acctbal") + 1, False),
        (3, k % 5 == 0, none, True), (4, k % 10 == 0, F.col("c_acctbal") - 1, False),
    ]
    out = None
    for version, which, balance, deleted in steps:
        at = F.timestamp_seconds(F.lit(1_700_000_000 + 60 * version) + k % 3600)
        one = c.where(which).withColumns({"c_acctbal": balance, "_version": F.lit(version).cast("long"), "_deleted": F.lit(deleted), "_changed_at": at})
        out = one if out is None else out.unionByName(one)
    return out.unionByName(out.where(k % 7 == 0))


# --------------------------------------------------------------------- P5 duplicates
def lineitem_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem plus a second copy of every line of orders divisible by 7."""
    li = load(spark, sf_dir, "lineitem")
    return li.unionByName(li.where(F.col("l_orderkey") % 7 == 0))


def nation_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    return n.unionByName(n)


# --------------------------------------------------------------------- P6 schema
def orders_reshaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders without o_orderpriority, with o_comment, and o_custkey as int."""
    o = load(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("o_custkey"),
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        F.lit(None).cast("string").alias("o_comment"),
    )


# --------------------------------------------------------------------- tags
def part_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag facts ``(object, tag_name, tag_value)``: part unpivoted."""
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("object"),
        F.inline(
            F.array(
                F.struct(F.lit("brand").alias("tag_name"), F.col("p_brand").alias("tag_value")),
                F.struct(F.lit("type").alias("tag_name"), F.col("p_type").alias("tag_value")),
                F.struct(F.lit("size").alias("tag_name"), F.col("p_size").cast("string").alias("tag_value")),
            )
        ),
    )


def part_tags_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = part_tags(spark, sf_dir)
    o = F.col("object")
    kept = src.where(~((F.col("tag_name") == "type") & (o % 7 == 0))).withColumn(
        "tag_value", F.when((F.col("tag_name") == "brand") & (o % 11 == 0), F.lit("old")).otherwise(F.col("tag_value"))
    )
    legacy = load(spark, sf_dir, "part").where(F.col("p_partkey") % 13 == 0).select(
        F.col("p_partkey").alias("object"), F.lit("legacy").alias("tag_name"), F.lit("y").alias("tag_value")
    )
    return kept.unionByName(legacy)


def column_tags(spark: SparkSession, sf_dir: str, target: bool) -> DataFrame:
    """Column-level tag facts ``(table_name, column_name, tag_name, tag_value)``.

    Tables are suppliers, columns their three attributes; the target drops
    the tags of suppliers divisible by 4 and changes the ``nation`` column's
    tag for suppliers divisible by 6.
    """
    s = load(spark, sf_dir, "supplier")
    facts = s.select(
        F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")).alias("table_name"),
        F.col("s_suppkey").alias("_k"),
        F.inline(
            F.array(
                F.struct(F.lit("s_name").alias("column_name"), F.lit("pii").alias("tag_name"), F.lit("name").alias("tag_value")),
                F.struct(F.lit("s_nationkey").alias("column_name"), F.lit("geo").alias("tag_name"), F.col("s_nationkey").cast("string").alias("tag_value")),
                F.struct(F.lit("s_acctbal").alias("column_name"), F.lit("fin").alias("tag_name"), F.lit("balance").alias("tag_value")),
            )
        ),
    )
    if target:
        facts = facts.where(F.col("_k") % 4 != 0).withColumn(
            "tag_value",
            F.when((F.col("column_name") == "s_nationkey") & (F.col("_k") % 6 == 0), F.lit("moved")).otherwise(F.col("tag_value")),
        )
    return facts.drop("_k")


# --------------------------------------------------------------------- grants
def order_grants(spark: SparkSession, sf_dir: str, target: bool, securable=None) -> DataFrame:
    """Grant facts ``(securable, principal, privilege)``: all orders on the
    source; on the target two thirds, some under another privilege and some
    under principals that the source doesn't know."""
    o = load(spark, sf_dir, "orders")
    k, who, what = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    if target:
        o = o.where(k % 3 != 0)
        who = F.when(k % 11 == 0, -who).otherwise(who)
        what = F.when(k % 7 == 0, F.lit("1-URGENT")).otherwise(what)
    name = F.lit("orders") if securable is None else securable
    return o.select(name.alias("securable"), who.cast("string").alias("principal"), what.alias("privilege")).distinct()


# --------------------------------------------------------------------- comments
def document_comments(spark: SparkSession, sf_dir: str, target: bool) -> DataFrame:
    """Column comment facts ``(table_name, column_name, comment)``."""
    d = load(spark, sf_dir, "documents")
    comment = F.col("source")
    if target:
        comment = F.when(F.col("doc_id") % 5 == 0, F.lit("")).when(F.col("doc_id") % 7 == 0, F.lit("changed")).otherwise(comment)
    return d.select(F.col("doc_id").cast("string").alias("table_name"), F.lit("lang").alias("column_name"), comment.alias("comment"))


def table_comments(spark: SparkSession, sf_dir: str, target: bool) -> DataFrame:
    """Table comment facts ``(table_name, table_type, comment)`` from documents.

    Every 9th document is a view, every 11th a volume (not commentable);
    target comments are blank for ``doc_id % 5 = 0``, null for ``% 8 = 0``
    and changed for ``% 7 = 0``.
    """
    d = load(spark, sf_dir, "documents")
    ttype = F.when(F.col("doc_id") % 11 == 0, F.lit("volume")).when(F.col("doc_id") % 9 == 0, F.lit("view")).otherwise(F.lit("managed"))
    comment = F.concat(F.col("source"), F.lit(" "), F.col("lang"))
    if target:
        comment = (
            F.when(F.col("doc_id") % 5 == 0, F.lit(""))
            .when(F.col("doc_id") % 8 == 0, F.lit(None).cast("string"))
            .when(F.col("doc_id") % 7 == 0, F.lit("changed"))
            .otherwise(comment)
        )
    return d.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("table_name"), ttype.alias("table_type"), comment.alias("comment"))


# --------------------------------------------------------------------- properties
def supplier_properties(spark: SparkSession, sf_dir: str, target: bool) -> DataFrame:
    """Property facts ``(object, properties map)`` of suppliers."""
    s = load(spark, sf_dir, "supplier")
    if target:
        s = s.where(F.col("s_suppkey") % 10 != 0)
    name = F.col("s_name")
    if target:
        name = F.when(F.col("s_suppkey") % 7 == 0, F.concat(name, F.lit("-old"))).otherwise(name)
    props = F.create_map(
        F.lit("name"), name,
        F.lit("nation"), F.col("s_nationkey").cast("string"),
        F.lit("balance"), F.format_number(F.col("s_acctbal"), 2),
        F.lit("location"), F.concat(F.lit("s3://dst-bucket/suppliers/" if target else "s3://src-bucket/suppliers/"), F.col("s_suppkey").cast("string")),
    )
    return s.select(F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")).alias("object"), props.alias("properties"))


# --------------------------------------------------------------------- listing
def document_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object listing ``(schema_name, table_name, table_type, pipeline_id,
    storage_location)`` built from documents.

    Every 10th name carries the ``__materialization_mat`` prefix, every 15th
    the ``event_log_`` prefix; every 4th is external, every 6th a view, every
    5th has a pipeline id, every 3rd a managed ``/tables/`` location.
    """
    d = load(spark, sf_dir, "documents")
    i = F.col("doc_id")
    base = F.concat(F.col("lang"), F.lit("_doc_"), i.cast("string"))
    name = (
        F.when(i % 10 == 0, F.concat(F.lit("__materialization_mat_"), base))
        .when(i % 15 == 0, F.concat(F.lit("event_log_"), base))
        .otherwise(base)
    )
    ttype = F.when(i % 6 == 0, F.lit("VIEW")).when(i % 4 == 0, F.lit("EXTERNAL")).otherwise(F.lit("MANAGED"))
    pipeline = F.when(i % 5 == 0, F.concat(F.lit("pl-"), F.col("source"))).otherwise(F.lit(None).cast("string"))
    location = (
        F.when(ttype == "VIEW", F.lit(None).cast("string"))
        .when(i % 3 == 0, F.concat(F.lit("s3://lake/"), F.col("source"), F.lit("/tables/"), i.cast("string")))
        .otherwise(F.concat(F.lit("s3://lake/"), F.col("source"), F.lit("/ext/"), i.cast("string")))
    )
    return d.select(
        F.col("source").alias("schema_name"),
        name.alias("table_name"),
        ttype.alias("table_type"),
        pipeline.alias("pipeline_id"),
        location.alias("storage_location"),
    )


# --------------------------------------------------------------------- run results
def event_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run results from events: object = user, operation = event type."""
    e = load(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", F.lit("failed")).when(F.col("event_type") == "view", F.lit("skipped")).otherwise(F.lit("success"))
    return e.select(
        F.concat(F.lit("run_"), (F.col("event_id") % 3).cast("string")).alias("run_id"),
        F.col("event_type").alias("operation_type"),
        F.concat(F.lit("cat_"), (F.col("user_id") % 4).cast("string")).alias("catalog_name"),
        F.concat(F.lit("sch_"), (F.col("user_id") % 9).cast("string")).alias("schema_name"),
        F.concat(F.lit("obj_"), F.col("user_id").cast("string")).alias("object_name"),
        F.lit("table").alias("object_type"),
        status.alias("status"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(secs=F.abs(F.coalesce(F.col("value"), F.lit(0.0))).cast("decimal(18,6)"))).alias("end_time"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.col("props").alias("details"),
        (F.col("event_id") % 3 + 1).cast("int").alias("attempt_number"),
        F.lit(3).alias("max_attempts"),
    )


# --------------------------------------------------------------------- pipeline tables
INTERNAL_CATALOG = "__internal"


def pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline-owned tables of the listing (catalog ``main``)."""
    return (
        document_listing(spark, sf_dir)
        .where(F.col("pipeline_id").isNotNull())
        .select(F.lit("main").alias("catalog_name"), "schema_name", "table_name", "pipeline_id")
    )


def existing_backing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names (``full_name``) of backing tables that exist: the in-schema form
    for ``doc_id % 3 = 0``, the third internal form for ``% 3 = 1``, the
    fourth for ``% 3 = 2`` and ``% 4 = 0``; none otherwise."""
    d = load(spark, sf_dir, "documents").where(F.col("doc_id") % 5 == 0)
    i = F.col("doc_id")
    base = F.concat(F.col("lang"), F.lit("_doc_"), i.cast("string"))
    name = (
        F.when(i % 10 == 0, F.concat(F.lit("__materialization_mat_"), base))
        .when(i % 15 == 0, F.concat(F.lit("event_log_"), base))
        .otherwise(base)
    )
    pid = F.regexp_replace(F.concat(F.lit("pl-"), F.col("source")), "-", "_")
    ischema = F.concat(F.lit("__dlt_materialization_schema_"), pid)
    full = (
        F.when(i % 3 == 0, F.concat_ws(".", F.lit("main"), F.col("source"), F.concat(F.lit("__materialization_mat_"), pid, F.lit("_"), name, F.lit("_1"))))
        .when(i % 3 == 1, F.concat_ws(".", F.lit(INTERNAL_CATALOG), ischema, F.concat(F.lit("__materialization_mat_"), pid, F.lit("_"), name, F.lit("_1"))))
        .when(i % 4 == 0, F.concat_ws(".", F.lit(INTERNAL_CATALOG), ischema, F.concat(F.lit("__materialization_mat_"), name, F.lit("_1"))))
    )
    return d.select(full.alias("full_name")).where(F.col("full_name").isNotNull())


# --------------------------------------------------------------------- principals
def _uuid_of(k):
    h = F.md5(k.cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def customer_principal(k):
    """Principal text of a customer key: service-principal id for k % 4 = 0,
    e-mail for k % 4 = 1, group name otherwise."""
    return (
        F.when(k % 4 == 0, _uuid_of(k))
        .when(k % 4 == 1, F.concat(F.lit("user"), k.cast("string"), F.lit("@src.example")))
        .otherwise(F.concat(F.lit("group"), k.cast("string")))
    )


def principal_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Principals in use, explicit mapping, and the two directories.

    mapping: e-mails with k % 8 = 1 -> new domain; ids with k % 12 = 0 ->
    ``sp-mapped-k``; names ``sp-k`` with k % 16 = 4 -> ``sp-renamed-k``.
    source directory: ids with k % 3 <> 0 have name ``sp-k``.
    target directory: ``sp-k`` with k % 5 <> 0, ``sp-mapped-k``,
    ``sp-renamed-k`` have ids (the id of -k - 1).
    """
    c = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    used = c.select(customer_principal(k).alias("principal"))
    email_map = c.where(k % 8 == 1).select(
        customer_principal(k).alias("src"), F.concat(F.lit("user"), k.cast("string"), F.lit("@tgt.example")).alias("dst")
    )
    id_map = c.where(k % 12 == 0).select(_uuid_of(k).alias("src"), F.concat(F.lit("sp-mapped-"), k.cast("string")).alias("dst"))
    name_map = c.where(k % 16 == 4).select(F.concat(F.lit("sp-"), k.cast("string")).alias("src"), F.concat(F.lit("sp-renamed-"), k.cast("string")).alias("dst"))
    src_dir = c.where((k % 4 == 0) & (k % 3 != 0)).select(_uuid_of(k).alias("app_id"), F.concat(F.lit("sp-"), k.cast("string")).alias("display_name"))
    sps = c.where(k % 4 == 0)
    tgt_dir = (
        sps.where(k % 5 != 0).select(F.concat(F.lit("sp-"), k.cast("string")).alias("display_name"), _uuid_of(-k - 1).alias("app_id"))
        .unionByName(sps.where(k % 12 == 0).select(F.concat(F.lit("sp-mapped-"), k.cast("string")).alias("display_name"), _uuid_of(-k - 1).alias("app_id")))
        .unionByName(sps.where(k % 16 == 4).select(F.concat(F.lit("sp-renamed-"), k.cast("string")).alias("display_name"), _uuid_of(-k - 1).alias("app_id")))
    )
    return {
        "principals": used,
        "mapping": email_map.unionByName(id_map).unionByName(name_map),
        "source_dir": src_dir,
        "target_dir": tgt_dir,
    }


# --------------------------------------------------------------------- DDL
def listing_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SHOW CREATE TABLE``-like text for every listed object: views with and
    without columns, over several lines, with `` as `` and a source name in a
    comment; tables with and without a column list and with a clause's word in a
    column's comment; quoted names; a comment before the statement."""
    lst = document_listing(spark, sf_dir)
    length = F.length(F.col("table_name"))
    plain = F.concat_ws(".", F.lit("main"), F.col("schema_name"), F.col("table_name"))
    quoted = F.concat(F.lit("`main`.`"), F.col("schema_name"), F.lit("`.`"), F.col("table_name"), F.lit("`"))
    name = F.when(F.col("schema_name").isin("src2", "src5"), quoted).otherwise(plain)
    view = F.concat(
        F.when(length % 2 == 0, F.lit(" (doc_id, lang)")).otherwise(F.lit("")),
        F.when(length % 3 == 0, F.lit("\nCOMMENT 'rows of main.docs as text (short)'")).otherwise(F.lit("")),
        F.when(length % 3 == 1, F.lit("\nAS ")).otherwise(F.lit(" AS ")),
        F.lit("SELECT doc_id, count(*) AS n FROM main."), F.col("schema_name"), F.lit(".docs WHERE length(text) > 10 GROUP BY ALL"),
    )
    columns = F.when(length % 3 == 0, F.lit("")).otherwise(F.lit(" (\n  doc_id BIGINT,\n  lang STRING COMMENT 'see LOCATION ''x'' of main.t')"))
    table = F.concat(columns, F.lit("\nUSING parquet"))
    ext = F.concat(table, F.lit("\nLOCATION '"), F.col("storage_location"), F.lit("'"))
    kind = F.col("table_type")
    body = F.when(kind == "VIEW", view).when(kind == "EXTERNAL", ext).otherwise(table)
    head = F.when(kind == "VIEW", F.lit("CREATE VIEW ")).otherwise(F.lit("CREATE TABLE "))
    lead = F.when(length % 5 == 0, F.lit("-- once: CREATE TABLE main.x\n")).otherwise(F.lit(""))
    return lst.select("schema_name", "table_name", "table_type", F.concat(lead, head, name, body).alias("ddl"))
