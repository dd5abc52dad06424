import uuid

from pyspark.sql import functions as F

from conftest import SF001, rows
from tablesync.operators import copy as C
from tablesync.operators import reconcile as R
from tablesync.session import work_dir
from tablesync.sources import fixtures as X
from tablesync.sources import storage
from tablesync.sources.tables import column_facts, load


def test_snapshot_copy_then_reconcile_passes(spark):
    src = load(spark, SF001, "orders")
    target = work_dir(spark, "t") + "/orders"
    p1 = C.copy_table(src, target)
    p2 = C.copy_table(src.where("o_orderkey < 10"), target)
    assert storage.committed_versions(spark, target) == [1, 2]
    assert storage.current_path(spark, target) == p2 and p1 != p2
    C.copy_table(src, target)
    assert R.missing_rows(src, storage.read_table(spark, target)).count() == 0


def test_two_hop_reads_the_staging_copy(spark):
    root = work_dir(spark, "t")
    C.copy_via(load(spark, SF001, "customer"), root + "/stage", root + "/tgt")
    assert storage.read_table(spark, root + "/stage").count() == storage.read_table(spark, root + "/tgt").count() == 150


def test_changes_then_apply_gives_source(spark):
    s, t = load(spark, SF001, "orders"), X.orders_target(spark, SF001)
    ch = C.snapshot_changes(s, t, ["o_orderkey"])
    kinds = {r["change_type"] for r in ch.collect()}
    assert kinds <= {"insert", "update", "delete"}
    applied = C.apply_changes(t, ch, ["o_orderkey"])
    assert R.missing_rows(s, applied).count() == 0 and applied.count() == s.count()
    # planning again against the result: nothing to do
    assert C.snapshot_changes(s, applied, ["o_orderkey"]).count() == 0


def test_duplicate_keys_are_reported_not_multiplied(spark):
    s = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (2, "d")], "k int, v string")
    got = rows(C.snapshot_changes(s, t, ["k"]), "k", "change_type")
    assert got == [(1, "duplicate_key"), (2, "update")]


def test_incremental_sync_new_version(spark):
    target = work_dir(spark, "t") + "/o"
    C.copy_table(X.orders_target(spark, SF001), target)
    path, changes = C.sync_incremental(spark, load(spark, SF001, "orders"), target, ["o_orderkey"])
    assert path.endswith("_v000002")
    assert R.missing_rows(load(spark, SF001, "orders"), storage.read_table(spark, target)).count() == 0


def test_schema_gate_ordered_names(spark):
    a = spark.createDataFrame([], "x int, y string")
    b = spark.createDataFrame([], "y string, x int")
    c = spark.createDataFrame([], "x bigint, y string")
    sf_ = column_facts(spark, {"ab": a, "ac": a}).withColumnRenamed("table_name", "pair")
    tf_ = column_facts(spark, {"ab": b, "ac": c}).withColumnRenamed("table_name", "pair")
    got = {r["pair"]: (r["passed"], r["action"]) for r in C.schema_gate(sf_, tf_, enforce=False).collect()}
    assert got == {"ab": (False, "warn"), "ac": (True, "ok")}
    typed = {r["pair"]: r["passed"] for r in C.schema_gate(sf_, tf_, types=True).collect()}
    assert typed == {"ab": False, "ac": False}


def test_remapped_external_copy(spark):
    root = work_dir(spark, "t")
    name = f"t_{uuid.uuid4().hex[:8]}"
    loc = C.copy_external(spark, load(spark, SF001, "region"), "S3://Lake/raw/region", [("s3://lake/", root + "/mirror/")], name)
    assert loc == root + "/mirror/raw/region"
    assert spark.table(name).count() == 5


def test_strategy_and_backing_tables(spark):
    lst = spark.createDataFrame([("a", "VIEW"), ("b", "EXTERNAL"), ("c", "MANAGED")], "table_name string, table_type string")
    s1 = {r["table_name"]: r["strategy"] for r in C.sync_strategy(lst).collect()}
    assert s1 == {"a": "skip", "b": "remapped", "c": "snapshot"}
    s2 = {r["table_name"]: r["strategy"] for r in C.sync_strategy(lst, replicate_as_managed=True, staging_catalog="stg").collect()}
    assert s2 == {"a": "skip", "b": "two_hop", "c": "two_hop"}
    tables = spark.createDataFrame([("c", "s", "t1", "p-1"), ("c", "s", "t2", "p-2"), ("c", "s", "t3", "p-3")], "catalog_name string, schema_name string, table_name string, pipeline_id string")
    existing = spark.createDataFrame(
        [("c.s.__materialization_mat_p_1_t1_1",), ("int.__dlt_materialization_schema_p_1.t1",), ("int.__dlt_materialization_schema_p_2.__materialization_mat_t2_1",)], "full_name string"
    )
    picked = C.pick_source(C.backing_candidates(tables, "int"), existing, ["catalog_name", "schema_name", "table_name"])
    got = {r["table_name"]: (r["chosen"], r["label"]) for r in picked.collect()}
    assert got == {
        "t1": ("c.s.__materialization_mat_p_1_t1_1", "dpm"),
        "t2": ("int.__dlt_materialization_schema_p_2.__materialization_mat_t2_1", "legacy"),
        "t3": (None, None),
    }
    plan = {r["table_name"]: (r["action"], r["backup_table"]) for r in C.backup_plan(picked, "bk", "x_").collect()}
    assert plan == {"t1": ("share", None), "t2": ("backup", "bk.x_s.t2"), "t3": ("error", None)}


def test_changes_with_map_columns(spark):
    s = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"x": "1"})], "k int, m map<string,string>")
    t = spark.createDataFrame([(1, {"b": "2", "a": "1"}), (2, {"x": "2"})], "k int, m map<string,string>")
    assert rows(C.snapshot_changes(s, t, ["k"]), "k", "change_type") == [(2, "update")]
