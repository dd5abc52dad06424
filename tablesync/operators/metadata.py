"""Metadata as data.

Tags, comments, grants and properties are fact tables; a sync is a keyed
set difference between the source facts and the target facts, computed for
all objects in one plan (the reference loops object by object).  Every plan
is idempotent: applying it and planning again yields no change.

Grouping never collects table data: the lists built per object are bounded
by the tag / privilege / column vocabulary of one object, and each list is
de-duplicated by a map-side aggregate before it is collected.
"""

from __future__ import annotations

import re
from typing import Callable, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


KEEP, SET, UNSET, CLEAR = "keep", "set", "unset", "clear"


# ------------------------------------------------------------------ M1
def tag_rollup(objects: DataFrame, tags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per object: its tag names and ``name -> trim(value)`` maps.

    ``objects`` lists the objects (by ``keys``), ``tags`` holds
    ``keys + (tag_name, tag_value)``.  Duplicate facts are folded first, so
    each collected list has at most one entry per distinct tag.
    """
    facts = (
        tags.select(*keys, "tag_name", F.trim("tag_value").alias("tag_value"))
        .groupBy(*keys, "tag_name", "tag_value")
        .agg(F.lit(1).alias("_one"))
    )
    joined = objects.select(*keys).distinct().join(facts, on=list(keys), how="inner")
    return joined.groupBy(*keys).agg(
        F.array_sort(F.collect_list("tag_name")).alias("tag_names"),
        F.collect_list(F.create_map(F.col("tag_name"), F.col("tag_value"))).alias("tag_maps"),
    )


# ------------------------------------------------------------------ M2 / M3
def tag_plan(source: DataFrame, target: DataFrame, keys: Sequence[str], overwrite: bool) -> DataFrame:
    """Minimal tag changes per ``keys + tag_name``.

    overwrite: final tags = source tags (set differing / new, unset
    target-only, keep equal).  keep mode: source adds only names the target
    lacks; the target value wins on a shared name, nothing is unset.
    Values are compared trimmed.  A source tag without value counts as absent;
    a target tag without value is there, and is unset like others.
    Output: keys, tag_name, action, tag_value (the value after the change).
    """
    k = list(keys) + ["tag_name"]
    s = source.where(F.col("tag_value").isNotNull()).select(*k, F.trim("tag_value").alias("_sv")).groupBy(*k).agg(F.max("_sv").alias("_sv"))
    t = target.select(*k, F.trim("tag_value").alias("_tv")).groupBy(*k).agg(F.max("_tv").alias("_tv"), F.lit(True).alias("_there"))
    j = s.join(t, on=k, how="full_outer")
    in_s, in_t = F.col("_sv").isNotNull(), F.col("_there").isNotNull()
    if overwrite:
        action = F.when(in_s & F.coalesce(F.col("_sv") == F.col("_tv"), F.lit(False)), F.lit(KEEP)).when(in_s, F.lit(SET)).otherwise(F.lit(UNSET))
        value = F.when(in_s, F.col("_sv"))
    else:
        action = F.when(in_t, F.lit(KEEP)).otherwise(F.lit(SET))
        value = F.when(in_t, F.col("_tv")).otherwise(F.col("_sv"))
    return j.select(*k, action.alias("action"), value.alias("tag_value"))


def plan_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def objects_to_touch(plan: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Objects with at least one non-keep action (others are skipped)."""
    return plan.groupBy(*keys).agg(F.max((F.col("action") != KEEP).cast("int")).alias("_c")).where("_c = 1").drop("_c")


def tag_statements(plan: DataFrame, keys: Sequence[str], object_kind: str = "TABLE") -> DataFrame:
    """``SET TAGS`` / ``UNSET TAGS`` text per object (for engines that
    accept them); values escaped."""
    name = F.concat_ws(".", *[F.concat(F.lit("`"), F.col(c).cast("string"), F.lit("`")) for c in keys])
    esc = lambda c: F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "'", r"\\'")
    pair = F.concat(F.lit("'"), esc(F.col("tag_name")), F.lit("' = '"), esc(F.col("tag_value")), F.lit("'"))
    g = plan.where(F.col("action") != KEEP).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("action") == SET, pair))).alias("_set"),
        F.array_sort(F.collect_list(F.when(F.col("action") == UNSET, F.concat(F.lit("'"), esc(F.col("tag_name")), F.lit("'"))))).alias("_unset"),
    )
    return g.select(
        *keys,
        F.when(F.size("_unset") > 0, F.concat(F.lit(f"ALTER {object_kind} "), name, F.lit(" UNSET TAGS ("), F.array_join("_unset", ", "), F.lit(")"))).alias("unset_sql"),
        F.when(F.size("_set") > 0, F.concat(F.lit(f"ALTER {object_kind} "), name, F.lit(" SET TAGS ("), F.array_join("_set", ", "), F.lit(")"))).alias("set_sql"),
    )


# ------------------------------------------------------------------ M4
def table_comment_plan(source: DataFrame, target: DataFrame, overwrite: bool = True) -> DataFrame:
    """Table comments: no change when both are empty or equal; otherwise
    the source comment replaces the target's (only with ``overwrite``), for
    tables and views; other object types are skipped.

    Inputs: ``table_name, table_type, comment``.  Output: table_name,
    table_type, action (set / clear / skip), comment.
    """
    # one row per table on each side (max folds stray duplicates map-side,
    # so a repeated key can never pair up rows in the join)
    s = source.groupBy("table_name").agg(F.max("table_type").alias("table_type"), F.max("comment").alias("_sc"))
    t = target.groupBy("table_name").agg(F.max("comment").alias("_tc"))
    j = s.join(t, "table_name", "inner")
    se, te = F.coalesce(F.col("_sc"), F.lit("")), F.coalesce(F.col("_tc"), F.lit(""))
    changed = ~(((se == "") & (te == "")) | F.col("_sc").eqNullSafe(F.col("_tc")))
    ok_type = F.lower("table_type").isin("managed", "external", "view")
    action = F.when(~ok_type, F.lit("skip")).when(se == "", F.lit(CLEAR)).otherwise(F.lit(SET))
    return j.where(changed & F.lit(overwrite)).select("table_name", "table_type", action.alias("action"), se.alias("comment"))


# ------------------------------------------------------------------ M5
def column_comments(columns: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per table: ``collect_list(map(column, trim(coalesce(comment, ''))))``."""
    return columns.groupBy(*keys).agg(
        F.collect_list(F.create_map(F.col("column_name"), F.trim(F.coalesce(F.col("comment"), F.lit(""))))).alias("comment_maps")
    )


# ------------------------------------------------------------------ M6
def column_comment_plan(source: DataFrame, target: DataFrame, keys: Sequence[str], overwrite: bool) -> DataFrame:
    """Column comments to change, per ``keys + column_name``.

    Comments compare as ``trim(coalesce(comment, ''))``; equal pairs are
    dropped.  overwrite: the source comment wins (an empty one clears);
    otherwise the target keeps its comment and only columns without a
    target entry take the source's.  Output: keys, column_name, action,
    comment.
    """
    k = list(keys) + ["column_name"]
    norm = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    s = source.groupBy(*k).agg(F.max(norm("comment")).alias("_sc"))
    t = target.groupBy(*k).agg(F.max(norm("comment")).alias("_tc"))
    j = s.join(t, on=k, how="full_outer").where(~F.col("_sc").eqNullSafe(F.col("_tc")))
    if overwrite:
        j = j.where(F.col("_sc").isNotNull())
        value = F.col("_sc")
    else:
        j = j.where(F.col("_tc").isNull())
        value = F.col("_sc")
    return j.select(*k, F.when(value == "", F.lit(CLEAR)).otherwise(F.lit(SET)).alias("action"), value.alias("comment"))


def _sql_str(c: Column) -> Column:
    """SQL string literal body: backslash and quote escaped."""
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "'", r"\\'")


def comment_statements(plan: DataFrame, table_types: DataFrame, target_prefix: str = "") -> DataFrame:
    """Statements for a column-comment plan: one combined ``ALTER TABLE`` per
    managed / external table, one statement per column for views and
    streaming tables, ``skipped`` for other types.

    ``table_types``: table_name, table_type.  Output: table_name, kind,
    statement.
    """
    p = plan.join(table_types, "table_name", "inner")
    tname = F.concat(F.lit(target_prefix), F.col("table_name"))
    ttype = F.lower("table_type")
    piece = F.concat(F.lit("`"), F.col("column_name"), F.lit("` COMMENT '"), _sql_str(F.col("comment")), F.lit("'"))
    per_col = p.where(ttype.isin("view", "streaming_table")).select(
        "table_name",
        F.lit("column").alias("kind"),
        F.when(ttype == "view", F.concat(F.lit("COMMENT ON COLUMN "), tname, F.lit(".`"), F.col("column_name"), F.lit("` IS '"), _sql_str(F.col("comment")), F.lit("'")))
        .otherwise(F.concat(F.lit("ALTER STREAMING TABLE "), tname, F.lit(" ALTER COLUMN "), piece))
        .alias("statement"),
    )
    combined = (
        p.where(ttype.isin("managed", "external"))
        .groupBy("table_name")
        .agg(F.array_sort(F.collect_list(F.struct("column_name", piece.alias("p")))).alias("_ps"))
        .select(
            "table_name",
            F.lit("table").alias("kind"),
            F.concat(F.lit("ALTER TABLE "), F.concat(F.lit(target_prefix), F.col("table_name")), F.lit(" ALTER COLUMN "), F.array_join(F.transform("_ps", lambda x: x["p"]), ", ")).alias("statement"),
        )
    )
    skipped = p.where(~ttype.isin("view", "streaming_table", "managed", "external")).select(
        "table_name", F.lit("skipped").alias("kind"), F.lit(None).cast("string").alias("statement")
    ).distinct()
    return per_col.unionByName(combined).unionByName(skipped)


# ------------------------------------------------------------------ M7
def grant_plan(source: DataFrame, target: DataFrame, hard_sync: bool = False) -> DataFrame:
    """Privileges to add and remove per ``(securable, principal)``.

    Source principals get exactly the source privileges; target-only
    principals are left alone, or lose everything with ``hard_sync``.
    Principals without change are dropped.  Inputs: securable, principal,
    privilege.  Output: securable, principal, add, remove (sorted arrays).
    """
    k = ["securable", "principal", "privilege"]
    u = source.select(*k, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(target.select(*k, F.lit(0).alias("_s"), F.lit(1).alias("_t")))
    triples = u.where(F.col("principal").isNotNull()).groupBy(*k).agg(F.max("_s").alias("_s"), F.max("_t").alias("_t"))
    per_principal = triples.groupBy("securable", "principal").agg(
        F.max("_s").alias("_in_source"),
        F.array_sort(F.collect_list(F.when((F.col("_s") == 1) & (F.col("_t") == 0), F.col("privilege")))).alias("add"),
        F.array_sort(F.collect_list(F.when((F.col("_t") == 1) & (F.col("_s") == 0), F.col("privilege")))).alias("remove"),
    )
    keep = F.lit(True) if hard_sync else (F.col("_in_source") == 1)
    return per_principal.where(keep & ((F.size("add") > 0) | (F.size("remove") > 0))).select("securable", "principal", "add", "remove")


# ------------------------------------------------------------------ M8
UUID_RE = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def is_application_id(c: Column) -> Column:
    """Whether a principal is a service principal's id: a lower-case UUID."""
    return F.coalesce(c.rlike(UUID_RE), F.lit(False))


def _left_by(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Left join on a key that most rows lack.  A null key is replaced by the
    row's own principal under a mark no name starts with, so that rows
    without key are spread over all tasks instead of meeting in one."""
    spread = F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col("_p")))
    joined = rows.withColumn("_at", spread).join(names.withColumnRenamed(key, "_at"), "_at", "left")
    return joined.drop("_at")


def map_principals(principals: DataFrame, mapping: DataFrame, source_dir: DataFrame, target_dir: DataFrame, col: str = "principal") -> DataFrame:
    """Resolve source principals to target principals.

    Order: explicit mapping; else for a service-principal id its source
    display name -> (mapping of that name, or the same name) -> target id;
    else verbatim.  Mapped names are resolved to target ids when the target
    directory knows them.  An id that cannot be resolved is marked
    ``skipped`` with a reason.

    ``mapping``: src, dst.  ``source_dir``: app_id, display_name.
    ``target_dir``: display_name, app_id.  The distinct principals are
    resolved once and joined back; the small directory tables are
    broadcast by AQE from their measured size.
    """
    p = principals.select(F.col(col).alias("_p")).where(F.col("_p").isNotNull()).distinct()
    # one target per source name and one id per directory name
    mapping = mapping.groupBy("src").agg(F.min("dst").alias("dst"))
    source_dir = source_dir.groupBy("app_id").agg(F.min("display_name").alias("display_name"))
    target_dir = target_dir.groupBy("display_name").agg(F.min("app_id").alias("app_id"))
    m1 = mapping.select(F.col("src").alias("_p"), F.col("dst").alias("_m1"))
    sd = source_dir.select(F.col("app_id").alias("_p"), F.col("display_name").alias("_sname"))
    m2 = mapping.select(F.col("src").alias("_sname"), F.col("dst").alias("_m2"))
    r = _left_by(p.join(m1, "_p", "left").join(sd, "_p", "left"), m2, "_sname")
    td = target_dir.select(F.col("display_name").alias("_n"), F.col("app_id").alias("_id"))

    def resolve(r: DataFrame, value: str, out: str) -> DataFrame:
        r = _left_by(r, td.withColumnRenamed("_n", value).withColumnRenamed("_id", out + "_id"), value)
        return r.withColumn(out, F.when(F.col(value).isNull() | is_application_id(F.col(value)), F.col(value)).otherwise(F.coalesce(F.col(out + "_id"), F.col(value))))

    r = resolve(r, "_m1", "_r1")
    r = resolve(r, "_m2", "_r2")
    r = _left_by(r, td.withColumnRenamed("_n", "_sname").withColumnRenamed("_id", "_same"), "_sname")
    is_sp = is_application_id(F.col("_p"))
    mapped = (
        F.when(F.col("_m1").isNotNull(), F.col("_r1"))
        .when(is_sp & F.col("_sname").isNotNull() & F.col("_m2").isNotNull(), F.col("_r2"))
        .when(is_sp & F.col("_same").isNotNull(), F.col("_same"))
        .otherwise(F.col("_p"))
    )
    skipped = is_sp & (mapped == F.col("_p")) & F.col("_m1").isNull()
    reason = F.when(
        skipped,
        F.concat(
            F.lit("no target principal for application "), F.col("_p"),
            F.when(F.col("_sname").isNotNull(), F.concat(F.lit(", named "), F.col("_sname"))).otherwise(F.lit(", whose name is unknown")),
        ),
    )
    resolved = r.select(F.col("_p").alias(col), mapped.alias("target_principal"), skipped.alias("skipped"), reason.alias("skip_reason"))
    return principals.join(resolved, col, "left")


def grant_changes(source: DataFrame, target: DataFrame, mapping: DataFrame, source_dir: DataFrame, target_dir: DataFrame, hard_sync: bool = False) -> DataFrame:
    """Grants from end to end: source principals are mapped first, grants of
    those that can't be are skipped with the reason, the rest is diffed.

    Output: securable, principal (of the target; of the source where skipped),
    op (add / remove / none), privilege, skip_reason.
    """
    mapped = map_principals(source.select("principal").distinct(), mapping, source_dir, target_dir)
    known = source.join(mapped, "principal")
    plan = grant_plan(known.where(~F.col("skipped")).select("securable", F.col("target_principal").alias("principal"), "privilege"), target, hard_sync)
    none = F.lit(None).cast("string")
    changes = [plan.select("securable", "principal", F.lit(op).alias("op"), F.explode(op).alias("privilege"), none.alias("skip_reason")) for op in ("add", "remove")]
    skipped = known.where("skipped").select("securable", "principal", F.lit("none").alias("op"), "privilege", "skip_reason").distinct()
    return changes[0].unionByName(changes[1]).unionByName(skipped)


# ------------------------------------------------------------------ M9
def apply_outcome(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Outcome per object from per-change results (``status`` in applied /
    failed / skipped): counts, and ``failed`` as soon as one change failed
    or was skipped."""
    agg = changes.groupBy(*keys).agg(
        F.count_if(F.col("status") == "applied").alias("applied"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
    )
    return agg.withColumn("status", F.when((F.col("failed") + F.col("skipped")) > 0, F.lit("failed")).otherwise(F.lit("success")))


# ------------------------------------------------------------------ M10 table form
def remap_url_table(df: DataFrame, url_col: str, mapping: DataFrame, out_col: str = "mapped_url") -> DataFrame:
    """Longest-prefix URL remap against a mapping *table* (``src, dst``).

    Each distinct URL yields its prefixes at ``/`` boundaries (a handful per
    URL); they are equi-joined with the normalised mapping keys, and the longest
    hit per URL wins.  Rows get what their own URL maps to, whatever keys they
    have.  Matching ignores case.  Rows without a hit, or without a URL, get null.
    """
    m = mapping.select(
        F.lower(F.when(F.col("src").endswith("/"), F.col("src")).otherwise(F.concat(F.col("src"), F.lit("/")))).alias("_pre"),
        F.col("dst").alias("_dst"),
    ).groupBy("_pre").agg(F.min("_dst").alias("_dst"))
    urls = df.select(F.col(url_col).alias("_u")).where("_u is not null").distinct()
    parts = F.split("_u", "/")
    # from the host on: every URL shares its scheme with most others
    host = F.when(F.element_at(parts, 1).endswith(":") & (F.size(parts) > 2), 3).otherwise(1)
    prefixes = F.transform(F.sequence(host, F.size(parts)), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    cand = urls.select("_u", F.explode(prefixes).alias("_cp")).withColumn("_pre", F.lower("_cp"))
    hits = cand.join(m, "_pre", "inner")
    tail = F.substr(F.col("_u"), F.length("_pre") + 1)
    mapped = F.when(tail == "", F.col("_dst")).otherwise(F.concat(F.regexp_replace("_dst", "/+$", ""), F.lit("/"), F.regexp_replace(tail, "^/+", "")))
    best = hits.groupBy("_u").agg(F.max_by(mapped, F.length("_pre")).alias(out_col))
    return df.join(best, F.col(url_col) == F.col("_u"), "left").drop("_u")


# ------------------------------------------------------------------ M12
def property_plan(source: DataFrame, target: DataFrame, whitelist: Sequence[str], location_map: Optional[Sequence[tuple[str, str]]] = None, key: str = "object") -> DataFrame:
    """Create / update / noop per object from whitelisted properties.

    ``source``/``target``: key, properties (map<string,string>).  The source
    is projected to the whitelist and its ``location`` remapped; then an
    object missing on target is created, a differing one updated.
    Output: key, action, properties (the desired map).
    """
    from tablesync.functions.urls import remap_url

    wl = F.array(*[F.lit(w) for w in whitelist])
    s = source.select(key, F.map_filter("properties", lambda k, v: F.array_contains(wl, k)).alias("_sp"))
    if location_map:
        s = s.withColumn(
            "_sp",
            F.when(F.col("_sp")["location"].isNotNull(), F.map_concat(F.map_filter("_sp", lambda k, v: k != "location"), F.create_map(F.lit("location"), F.coalesce(remap_url(F.col("_sp")["location"], location_map), F.col("_sp")["location"])))).otherwise(F.col("_sp")),
        )
    t = target.select(key, F.map_filter("properties", lambda k, v: F.array_contains(wl, k)).alias("_tp"), F.lit(True).alias("_there"))
    j = s.join(t, key, "left")
    canon = lambda c: F.array_sort(F.map_entries(F.col(c)))
    action = F.when(F.col("_there").isNull(), F.lit("create")).when(canon("_sp").eqNullSafe(canon("_tp")), F.lit("noop")).otherwise(F.lit("update"))
    return j.select(key, action.alias("action"), F.col("_sp").alias("properties"))


# ------------------------------------------------------------------ M13
# parts of a statement: text in quotes (doubled or escaped ones inside), names in
# back-ticks, comments to the end of the line or in slashes, and code between them
_TEXT = r"""'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'|"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+\""""
_COMMENT = r"--[^\n]*+|/\*.*?\*/"
DDL_PART = rf"(?s){_TEXT}|`[^`]*+(?:``[^`]*+)*+`|{_COMMENT}|[^'\"`/\-]++|."


# one part of a name, quoted or not, and the header up to the end of the name
_NAME_PART = r"(?:`(?:[^`]|``)+`|[^\s.(`]+)"
# white space and comments before it
DDL_LEAD = rf"(?s)^(?:\s|{_COMMENT})*+"
DDL_HEADER = rf"(?is)^CREATE\s+(?:OR\s+(?:REPLACE|REFRESH)\s+)?(?:EXTERNAL\s+|MATERIALIZED\s+|STREAMING\s+|(?:GLOBAL\s+)?TEMP(?:ORARY)?\s+)?(?:TABLE|VIEW)\s+(?:IF\s+NOT\s+EXISTS\s+)?{_NAME_PART}(?:\.{_NAME_PART})*"


def ddl_parts(ddl: Column) -> Column:
    """The parts of a statement, in order; together they are the statement."""
    return F.regexp_extract_all(ddl, F.lit(DDL_PART), F.lit(0))


def _is_code(part: Column) -> Column:
    first = F.substr(part, F.lit(1), F.lit(1))
    return part.isNotNull() & ~first.isin("'", '"', "`") & ~part.startswith("--") & ~part.startswith("/*")


def rewrite_locations(ddl: Column, new: Optional[Callable[[Column], Column]]) -> Column:
    """The literal of each ``LOCATION`` clause replaced by what ``new`` makes of it,
    or, without ``new``, the clause taken out.  The word inside text, names or comments is no clause."""
    parts = ddl_parts(ddl)

    def rewritten(held: Column) -> Column:
        word = r"(?is)\bLOCATION\s*$"
        literal = lambda i: (F.substr(F.get(held, i), F.lit(1), F.lit(1)).isin("'", '"')) & _is_code(F.get(held, i - 1)) & F.get(held, i - 1).rlike(word)
        here, follows = (lambda i: F.coalesce(literal(i), F.lit(False))), (lambda i: F.coalesce(literal(i + 1), F.lit(False)))
        if new is None:
            return F.array_join(F.transform(held, lambda p, i: F.when(here(i), F.lit("")).when(follows(i), F.regexp_replace(p, word, "")).otherwise(p)), "")
        return F.array_join(F.transform(held, lambda p, i: F.when(here(i), new(p)).otherwise(p)), "")

    # bound to a variable, so that the statement is cut up once
    return F.get(F.transform(F.array(parts), rewritten), 0)


def rename_catalog(ddl: Column, source: str, target: str) -> Column:
    """Names ``source.x`` and `` `source`.x`` in the code of a statement under ``target``; text and comments stay."""
    name = rf"(?i)(?<![\w.`]){re.escape(source)}(?=\s*\.)"

    def renamed(held: Column) -> Column:
        after, before = (lambda i: F.coalesce(F.get(held, i + 1), F.lit(""))), (lambda i: F.coalesce(F.get(held, i - 1), F.lit("")))
        quoted = lambda p, i: (F.lower(p) == f"`{source.lower()}`") & after(i).rlike(r"^\s*\.") & ~before(i).rlike(r"\.\s*$")
        plain = lambda p, i: _is_code(p) & ~before(i).rlike(r"`$")
        return F.array_join(F.transform(held, lambda p, i: F.when(quoted(p, i), F.lit(f"`{target}`")).when(plain(p, i), F.regexp_replace(p, name, target.replace("\\", "\\\\").replace("$", "\\$"))).otherwise(p)), "")

    return F.get(F.transform(F.array(ddl_parts(ddl)), renamed), 0)


def rewrite_ddl(df: DataFrame, ddl_col: str, kind_col: str, target_col: str, replace: bool = True,
                as_managed: Optional[Column] = None, url_map: Optional[Sequence[tuple[str, str]]] = None,
                catalog: Optional[tuple[str, str]] = None) -> DataFrame:
    """Re-point ``SHOW CREATE TABLE`` text at a target name.

    The header (``CREATE``, kind and name, over any white space and behind any
    comments) becomes ``CREATE [OR REPLACE] <KIND> <target>`` or ``CREATE <KIND>
    IF NOT EXISTS <target>``; all that follows the name stays as it is, whatever it says.
    Text that doesn't start so is left alone.  External tables lose their ``LOCATION`` clause when
    copied as managed, else its URL is remapped.  With ``catalog`` (source,
    target) names of the source catalog in the bodies of views follow.  Only
    code is rewritten, never text in quotes or comments.  Output column ``target_ddl``.
    """
    from tablesync.functions.urls import replace_url

    ddl, kind = F.col(ddl_col), F.upper(F.col(kind_col))
    is_view = kind == "VIEW"
    lead = F.coalesce(F.regexp_substr(ddl, F.lit(DDL_LEAD)), F.lit(""))
    statement = F.substr(ddl, F.length(lead) + 1)
    old = F.regexp_substr(statement, F.lit(DDL_HEADER))
    word = F.when(is_view, F.lit("VIEW")).when(kind == "MATERIALIZED_VIEW", F.lit("MATERIALIZED VIEW")).when(kind == "STREAMING_TABLE", F.lit("STREAMING TABLE")).otherwise(F.lit("TABLE"))
    header = (
        F.concat(F.lit("CREATE OR REPLACE "), word, F.lit(" "), F.col(target_col))
        if replace
        else F.concat(F.lit("CREATE "), word, F.lit(" IF NOT EXISTS "), F.col(target_col))
    )
    rest = F.substr(statement, F.length(old) + 1)
    ext = kind == "EXTERNAL"
    body = rest
    if as_managed is not None:
        body = F.when(ext & as_managed, rewrite_locations(rest, None)).otherwise(body)
    if url_map:
        keep = ext if as_managed is None else ext & ~as_managed
        body = F.when(keep, rewrite_locations(rest, lambda p: replace_url(p, url_map, first_only=True))).otherwise(body)
    if catalog:
        body = F.when(kind.isin("VIEW", "MATERIALIZED_VIEW"), rename_catalog(rest, *catalog)).otherwise(body)
    return df.withColumn("target_ddl", F.when(old.isNotNull(), F.concat(lead, header, body)).otherwise(ddl))


# ------------------------------------------------------------------ M14
def apply_facts(target: DataFrame, plan: DataFrame, keys: Sequence[str], value_col: str) -> DataFrame:
    """New target facts after a plan: keep and set rows carry the final
    value, unset rows disappear, untouched target facts stay."""
    k = list(keys)
    touched = plan.select(*k).distinct()
    same = F.lit(True)
    for c in k:
        same = same & target[c].eqNullSafe(touched[c])
    untouched = target.join(touched, same, "left_anti").select(*k, value_col)
    final = plan.where(F.col("action").isin(KEEP, SET, CLEAR)).select(*k, F.col(value_col))
    return untouched.unionByName(final)
