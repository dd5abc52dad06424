"""Registered reconciliation queries (R1-R11) over whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import oracle as O
from tablesync.functions.columns import map_as_text
from tablesync.operators import reconcile as R
from tablesync.plans.cascade import ReconcileConfig, reconcile_pairs
from tablesync.plans.registry import query
from tablesync.session import apply_defaults, work_dir
from tablesync.sources import fixtures as X
from tablesync.sources.tables import load


def _li_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    apply_defaults(spark)
    return load(spark, sf, "lineitem"), X.lineitem_target(spark, sf)


# ----------------------------------------------------------------- R3 / R6
@query("recon_missing_rows", oracle=O.missing_sql("select * from lineitem", O.LINEITEM_TARGET, O.LINEITEM_COLS))
def recon_missing_rows(spark: SparkSession, sf: str) -> DataFrame:
    s, t = _li_pair(spark, sf)
    return R.missing_rows(s, t)


# ----------------------------------------------------------------- R5
_S_FILTER = "l_linestatus = 'O'"
_T_FILTER = "l_linestatus = 'O' AND l_orderkey >= 0"


@query(
    "recon_missing_filtered",
    oracle=O.missing_sql("select * from lineitem", O.LINEITEM_TARGET, O.LINEITEM_COLS, _S_FILTER, _T_FILTER),
)
def recon_missing_filtered(spark: SparkSession, sf: str) -> DataFrame:
    s, t = _li_pair(spark, sf)
    return R.missing_rows(s, t, source_filter=_S_FILTER, target_filter=_T_FILTER)


# ----------------------------------------------------------------- R4
_SUMMARY_SQL = f"""
select issue_type, count(*) as row_count
from ({O.missing_sql('select * from lineitem', O.LINEITEM_TARGET, O.LINEITEM_COLS)})
group by issue_type
"""


@query("recon_missing_summary", oracle=_SUMMARY_SQL)
def recon_missing_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts alone: digests cross the shuffle, not rows."""
    s, t = _li_pair(spark, sf)
    return R.missing_summary(s, t, method="digest")


@query("recon_missing_summary_exact", oracle=_SUMMARY_SQL)
def recon_missing_summary_exact(spark: SparkSession, sf: str) -> DataFrame:
    s, t = _li_pair(spark, sf)
    return R.missing_summary(s, t)


# ----------------------------------------------------------------- multiset
_MS_COLS = ", ".join(O.LINEITEM_COLS)


@query(
    "recon_missing_multiset",
    oracle=f"""
with u as (
  select {_MS_COLS}, 1 as s, 0 as t from ({O.LINEITEM_WITH_COPIES})
  union all
  select {_MS_COLS}, 0 as s, 1 as t from ({O.LINEITEM_TARGET})
)
select {_MS_COLS}, cast(sum(s) as bigint) as source_count, cast(sum(t) as bigint) as target_count,
       cast(sum(s) - sum(t) as bigint) as count_diff
from u group by all having sum(s) <> sum(t)
""",
)
def recon_missing_multiset(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return R.multiset_diff(X.lineitem_with_copies(spark, sf), X.lineitem_target(spark, sf))


# ----------------------------------------------------------------- R7 evidence
_EV_EXCLUDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_EV_COLS = [c for c in O.LINEITEM_COLS if c not in _EV_EXCLUDE]


@query(
    "recon_evidence",
    oracle=f"""
select issue_type, {O.evidence_text(_EV_COLS, 'm')} as evidence
from ({O.missing_sql('select * from lineitem', O.LINEITEM_TARGET, _EV_COLS)}) m
""",
)
def recon_evidence(spark: SparkSession, sf: str) -> DataFrame:
    s, t = _li_pair(spark, sf)
    m = R.missing_rows(s, t, exclude=_EV_EXCLUDE, with_evidence=True)
    return m.select("issue_type", map_as_text(F.col("data")).alias("evidence"))


# ----------------------------------------------------------------- R2 row counts
def _count_pairs(spark: SparkSession, sf: str) -> list[R.TablePair]:
    return [
        R.TablePair("lineitem", load(spark, sf, "lineitem"), X.lineitem_target(spark, sf)),
        R.TablePair("events", X.events_source(spark, sf), X.events_target(spark, sf)),
        R.TablePair("orders", load(spark, sf, "orders"), X.orders_target(spark, sf)),
        R.TablePair("customer", load(spark, sf, "customer"), load(spark, sf, "customer")),
        R.TablePair("lineitem_copies", X.lineitem_with_copies(spark, sf), load(spark, sf, "lineitem")),
        R.TablePair("lineitem_open", load(spark, sf, "lineitem"), X.lineitem_target(spark, sf), _S_FILTER, _T_FILTER),
    ]


def _count_sql(pair: str, source: str, target: str, s_where: str = "true", t_where: str = "true") -> str:
    return f"""
select '{pair}' as pair, s.n as source_row_count, t.n as target_row_count, t.n - s.n as row_count_diff,
       case when s.n = t.n then 'match' else 'mismatch' end as comparison_result
from (select count(*) as n from ({source}) where {s_where}) s,
     (select count(*) as n from ({target}) where {t_where}) t
"""


@query(
    "recon_row_counts",
    oracle=" union all ".join(
        [
            _count_sql("lineitem", "select * from lineitem", O.LINEITEM_TARGET),
            _count_sql("events", O.EVENTS_SOURCE, O.EVENTS_TARGET),
            _count_sql("orders", "select * from orders", O.ORDERS_TARGET),
            _count_sql("customer", "select * from customer", "select * from customer"),
            _count_sql("lineitem_copies", O.LINEITEM_WITH_COPIES, "select * from lineitem"),
            _count_sql("lineitem_open", "select * from lineitem", O.LINEITEM_TARGET, _S_FILTER, _T_FILTER),
        ]
    ),
)
def recon_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    return R.row_count_check(_count_pairs(spark, sf))


@query(
    "recon_stored_counts",
    oracle=" union all ".join(
        [_count_sql(t, f"select * from {t}", f"select * from {t}") for t in ("documents", "events", "lineitem")]
        + [
            _count_sql("orders", "select * from orders", O.ORDERS_TARGET),
            _count_sql("orders_open", "select * from orders", O.ORDERS_TARGET, "o_orderstatus = 'O'", "o_orderstatus = 'O'"),
        ]
    ),
)
def recon_stored_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Stored tables counted from their footers; the filtered pair is scanned."""
    apply_defaults(spark)
    file_of = lambda t: f"{sf.rstrip('/')}/{t}.parquet"
    target = work_dir(spark, "recon_stored_counts") + "/orders"
    X.orders_target(spark, sf).write.parquet(target)
    same = [R.StoredPair(t, file_of(t), file_of(t)) for t in ("documents", "events", "lineitem")]
    is_open = "o_orderstatus = 'O'"
    return R.stored_row_counts(spark, [*same, R.StoredPair("orders", file_of("orders"), target), R.StoredPair("orders_open", file_of("orders"), target, is_open, is_open)])


# ----------------------------------------------------------------- R1 schema diff
# DuckDB type names spelled the way Spark's simpleString spells them
_DUCK_TYPE = """case lower(data_type)
  when 'varchar' then 'string' when 'integer' then 'int' when 'timestamp' then 'timestamp_ntz'
  else lower(data_type) end"""


def _facts_sql(table: str) -> str:
    return f"""select column_name, {_DUCK_TYPE} as data_type, is_nullable
from information_schema.columns where table_name = '{table}'"""


_ORDERS_RESHAPED_FACTS = f"""
select column_name, case when column_name = 'o_custkey' then 'int' else data_type end as data_type, is_nullable
from ({_facts_sql('orders')}) where column_name <> 'o_orderpriority'
union all select 'o_comment', 'string', 'YES'
"""


def _schema_pair_sql(pair: str, s_facts: str, t_facts: str) -> str:
    """The three kinds of difference, one by one."""
    one_side = """
select '{pair}' as pair, column_name, {cols}, '{label}' as comparison_result
from ({own}) where column_name not in (select column_name from ({other}))
"""
    only_s = one_side.format(pair=pair, own=s_facts, other=t_facts, label="missing_in_target", cols="data_type as source_data_type, null as target_data_type, is_nullable as source_nullable, null as target_nullable")
    only_t = one_side.format(pair=pair, own=t_facts, other=s_facts, label="missing_in_source", cols="null as source_data_type, data_type as target_data_type, null as source_nullable, is_nullable as target_nullable")
    return f"""
{only_s} union all {only_t} union all
select '{pair}', a.column_name, a.data_type, b.data_type, a.is_nullable, b.is_nullable,
       if(a.data_type = b.data_type, if(a.is_nullable = b.is_nullable, 'match', 'nullable_mismatch'), 'type_mismatch')
from ({s_facts}) a, ({t_facts}) b where a.column_name = b.column_name
"""


@query(
    "recon_schema_diff",
    oracle=f"""
select * from (
  {_schema_pair_sql('orders', _facts_sql('orders'), _ORDERS_RESHAPED_FACTS)}
  union all
  {_schema_pair_sql('lineitem', _facts_sql('lineitem'), _facts_sql('lineitem'))}
  union all
  {_schema_pair_sql('customer', _facts_sql('customer'), _facts_sql('supplier'))}
) where comparison_result <> 'match'
""",
)
def recon_schema_diff(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    pairs = [
        R.TablePair("orders", load(spark, sf, "orders"), X.orders_reshaped(spark, sf)),
        R.TablePair("lineitem", load(spark, sf, "lineitem"), X.lineitem_target(spark, sf)),
        R.TablePair("customer", load(spark, sf, "customer"), load(spark, sf, "supplier")),
    ]
    return R.schema_diff_tables(spark, pairs)


# ----------------------------------------------------------------- R10 sampling
_SAMPLE_N = 10
_SAMPLE_SEED = "42"


@query(
    "recon_sample",
    oracle=f"""
with l as (
  select source as schema_name,
         case when doc_id % 10 = 0 then '__materialization_mat_' || lang || '_doc_' || cast(doc_id as varchar)
              when doc_id % 15 = 0 then 'event_log_' || lang || '_doc_' || cast(doc_id as varchar)
              else lang || '_doc_' || cast(doc_id as varchar) end as table_name
  from documents
)
select schema_name, table_name from l
order by md5('{_SAMPLE_SEED}' || schema_name || '.' || table_name), schema_name, table_name
limit {_SAMPLE_N}
""",
)
def recon_sample(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    listing = X.document_listing(spark, sf).select("schema_name", "table_name")
    return R.sample_objects(listing, _SAMPLE_N, _SAMPLE_SEED, ["schema_name", "table_name"])


# ----------------------------------------------------------------- R11 threshold
_THRESHOLD = 99.0


def _threshold_sql(pair: str, source: str, target: str, cols: list[str]) -> str:
    return f"""
select '{pair}' as pair, (select count(*) from ({source})) as source_count,
       (select count(*) from ({O.missing_sql(source, target, cols)}) where issue_type = 'missing_in_target') as missing_count
"""


@query(
    "recon_threshold",
    oracle=f"""
with c as (
  {_threshold_sql('lineitem', 'select * from lineitem', O.LINEITEM_TARGET, O.LINEITEM_COLS)}
  union all
  {_threshold_sql('events', O.EVENTS_SOURCE, O.EVENTS_TARGET, O.EVENTS_COLS)}
  union all
  {_threshold_sql('orders', 'select * from orders', O.ORDERS_TARGET, O.ORDERS_COLS)}
)
select pair, source_count, missing_count,
       round(case when source_count = 0 then 100.0
                  else 100.0 * (1.0 - cast(missing_count as double) / cast(source_count as double)) end, 6) as match_pct,
       case when source_count = 0 then 100.0
            else 100.0 * (1.0 - cast(missing_count as double) / cast(source_count as double)) end >= {_THRESHOLD} as passed
from c
""",
)
def recon_threshold(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    pairs = [
        ("lineitem", load(spark, sf, "lineitem"), X.lineitem_target(spark, sf)),
        ("events", X.events_source(spark, sf), X.events_target(spark, sf)),
        ("orders", load(spark, sf, "orders"), X.orders_target(spark, sf)),
    ]
    parts = [R.match_counts(s, t, method="digest").select(F.lit(name).alias("pair"), "source_count", "missing_count") for name, s, t in pairs]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    out = R.threshold_check(counts, _THRESHOLD)
    return out.select("pair", "source_count", "missing_count", F.round("match_pct", 6).alias("match_pct"), "passed")


# ----------------------------------------------------------------- R8 cascade
_CASCADE_PAIRS_DOC = """identical customer; lineitem with extra copies (count fails);
orders reshaped (schema fails); events with nulls (missing rows fail)."""


def _cascade_sql() -> str:
    """Differences of every pair first, then which check they let through."""
    schema = lambda s, t: f"(select count(*) from ({_schema_pair_sql('x', s, t)}) where comparison_result <> 'match')"
    counts = lambda s, t: f"(select row_count_diff from ({_count_sql('x', s, t)}))"
    missing = lambda s, t, c: f"(select count(*) from ({O.missing_sql(s, t, c)}))"
    customer, lineitem, orders = "select * from customer", "select * from lineitem", "select * from orders"
    facts = {
        "customer": (schema(_facts_sql("customer"), _facts_sql("customer")), counts(customer, customer),
                     missing(customer, customer, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])),
        "lineitem_copies": (schema(_facts_sql("lineitem"), _facts_sql("lineitem")), counts(O.LINEITEM_WITH_COPIES, lineitem),
                            missing(O.LINEITEM_WITH_COPIES, lineitem, O.LINEITEM_COLS)),
        "orders_reshaped": (schema(_facts_sql("orders"), _ORDERS_RESHAPED_FACTS), counts(orders, orders), "0"),
        "events": (schema(_facts_sql("events"), _facts_sql("events")), counts(O.EVENTS_SOURCE, O.EVENTS_TARGET),
                   missing(O.EVENTS_SOURCE, O.EVENTS_TARGET, O.EVENTS_COLS)),
    }
    rows = " union all ".join(f"select '{p}' as pair, {s} as s, {d} as d, {m} as m" for p, (s, d, m) in facts.items())
    return f"""
with f as ({rows})
select pair, 'schema_check' as check_name, if(s = 0, 'passed', 'failed') as status, cast(s as bigint) as mismatch_count from f
union all
select pair, 'row_count_check', if(s > 0, 'skipped', if(d = 0, 'passed', 'failed')), if(s > 0, null, cast(abs(d) as bigint)) from f
union all
select pair, 'missing_data_check', if(s > 0 or d <> 0, 'skipped', if(m = 0, 'passed', 'failed')), if(s > 0 or d <> 0, null, cast(m as bigint)) from f
"""


@query("recon_cascade", oracle=_cascade_sql())
def recon_cascade(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    pairs = [
        R.TablePair("customer", load(spark, sf, "customer"), load(spark, sf, "customer")),
        R.TablePair("lineitem_copies", X.lineitem_with_copies(spark, sf), load(spark, sf, "lineitem")),
        R.TablePair("orders_reshaped", load(spark, sf, "orders"), X.orders_reshaped(spark, sf)),
        R.TablePair("events", X.events_source(spark, sf), X.events_target(spark, sf)),
    ]
    return reconcile_pairs(spark, pairs).select("pair", "check_name", "status", "mismatch_count")


# ----------------------------------------------------------------- R8 -> R9 -> R4: what a cascade leaves behind
def _evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Missing rows that a cascade over three pairs stores, one of them done again;
    the first pair has none."""
    path = work_dir(spark, "evidence")
    pairs = [
        R.TablePair("customer", load(spark, sf, "customer"), load(spark, sf, "customer")),
        R.TablePair("events", X.events_source(spark, sf), X.events_target(spark, sf)),
        R.TablePair("events_back", X.events_target(spark, sf), X.events_source(spark, sf)),
    ]
    config = ReconcileConfig(evidence_path=path, run_id="r1")
    reconcile_pairs(spark, pairs, config)
    reconcile_pairs(spark, pairs[1:2], config)
    return R.read_evidence(spark, path + "/missing_data")


_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_STORED_SQL = f"""
select 'r1' as run_id, 'events' as target_table, * from ({O.missing_sql(O.EVENTS_SOURCE, O.EVENTS_TARGET, _EVENT_COLS)})
union all
select 'r1', 'events_back', * from ({O.missing_sql(O.EVENTS_TARGET, O.EVENTS_SOURCE, _EVENT_COLS)})
"""


@query("recon_mismatch_rows", oracle=f"select run_id, target_table, issue_type, cast(event_id as varchar) as event_id, event_type, cast(user_id as varchar) as user_id from ({_STORED_SQL})")
def recon_mismatch_rows(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    d = F.col("data")
    return _evidence(spark, sf).select("run_id", "target_table", "issue_type", d["event_id"].alias("event_id"), d["event_type"].alias("event_type"), d["user_id"].alias("user_id"))


@query("recon_stored_summary", oracle=f"select issue_type, count(*) as row_count from ({_STORED_SQL}) where target_table = 'events' group by all")
def recon_stored_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of one run and pair from the stored rows."""
    apply_defaults(spark)
    return R.summarize_missing(_evidence(spark, sf), "r1", "target.default.events")
