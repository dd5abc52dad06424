"""Null keys, duplicate keys, nested maps, failures of single pairs, and the file log."""

import datetime as dt
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from tablesync import session
from tablesync.functions.urls import remap_url, remapped
from tablesync.operators import copy as C
from tablesync.operators import digest_tree as D
from tablesync.operators import metadata as M
from tablesync.operators import reconcile as R
from tablesync.plans.cascade import CHECK_RESULT_SCHEMA, ReconcileConfig, reconcile_pairs, verdict
from tablesync.session import work_dir
from tablesync.sources import storage
from tablesync.streaming import file_copy as FC


def test_changes_with_null_and_repeated_keys(spark):
    s = spark.createDataFrame([(None, "new"), (1, "a"), (1, "b"), (2, "x")], "k int, v string")
    t = spark.createDataFrame([(None, "old"), (1, "old"), (3, "y")], "k int, v string")
    out = C.apply_changes(t, C.snapshot_changes(s, t, ["k"]), ["k"], s)
    assert sorted(map(str, out.collect())) == sorted(map(str, s.collect()))


def test_tree_sync_rewrites_only_what_differs(spark):
    target = work_dir(spark, "t") + "/b"
    t = spark.createDataFrame([(i, "v", {"a": i}) for i in range(200)] + [(None, "old", None)], "k int, v string, m map<string,int>")
    assert D.sync_tree(spark, t, target, ["k"], 13).bits == 4
    assert D.sync_tree(spark, t, target, ["k"], 13).leaves == []
    s = t.where("k is not null and k <> 7").unionByName(spark.createDataFrame([(None, "new", None), (None, "new", None), (5, "twice", {"b": 1})], t.schema))
    assert 1 <= len(D.sync_tree(spark, s, target, ["k"], 13).leaves) <= 3
    got = D.read_table(spark, target)
    assert sorted(map(str, got.collect())) == sorted(map(str, s.collect()))
    assert len(D.sync_tree(spark, s.limit(0), target, ["k"], 13).leaves) == 16
    assert D.sync_tree(spark, s, target, ["k"], 13).leaves and D.read_table(spark, target).count() == s.count()


def test_leaf_digests_shuffle_no_rows(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = D.leaf_digests(df, ["o_orderkey"], 4)._jdf.queryExecution().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan


def test_nested_maps_are_compared_by_value(spark):
    kind = "k int, m map<string,int>, a array<map<string,int>>, s struct<m: map<string,array<int>>>"
    s = spark.createDataFrame([(1, {"x": 1, "y": 2}, [{"p": 1, "q": 2}], ({"z": [1]},)), (2, None, None, None)], kind)
    t = spark.createDataFrame([(1, {"y": 2, "x": 1}, [{"q": 2, "p": 1}], ({"z": [1]},)), (2, None, None, None)], kind)
    assert R.missing_rows(s, t).count() == 0
    other = R.missing_rows(s, t.where("k = 2"))
    assert other.first()["m"] == {"x": 1, "y": 2} and other.first()["a"] == [{"p": 1, "q": 2}]
    assert dict(other.dtypes)["m"] == "map<string,int>"


def test_versions_beyond_six_digits(spark):
    target = work_dir(spark, "t") + "/v"
    df = spark.range(3)
    df.write.parquet(target + "/_v999999")
    assert storage.write_version(df, target).endswith("_v1000000")
    assert storage.committed_versions(spark, target) == [999_999, 1_000_000] and storage.current_path(spark, target).endswith("_v1000000")


def test_no_machine_local_work_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: None)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_tags_without_value_and_properties_that_are_null(spark):
    s = spark.createDataFrame([("o", "a", "1")], "object string, tag_name string, tag_value string")
    t = spark.createDataFrame([("o", "a", None), ("o", "b", None)], s.schema)
    assert rows(M.tag_plan(s, t, ["object"], True), "tag_name", "action") == [("a", "set"), ("b", "unset")]
    p = spark.createDataFrame([("x", {"name": "n"}), ("y", None)], "object string, properties map<string,string>")
    q = spark.createDataFrame([("x", None), ("y", None)], p.schema)
    assert rows(M.property_plan(p, q, ["name"]), "object", "action") == [("x", "update"), ("y", "noop")]
    facts = spark.createDataFrame([(None, "1"), ("k", "2")], "object string, v string")
    plan = spark.createDataFrame([(None, "set", "3")], "object string, action string, v string")
    assert sorted(map(str, M.apply_facts(facts, plan, ["object"], "v").collect())) == sorted(["Row(object=None, v='3')", "Row(object='k', v='2')"])


def test_ddl_headers_by_pattern(spark):
    cases = [
        ("CREATE VIEW v\nAS SELECT count(*) FROM t", "VIEW", "CREATE OR REPLACE VIEW tgt\nAS SELECT count(*) FROM t"),
        ("CREATE VIEW a.b.v COMMENT 'this as that' AS SELECT 1", "VIEW", "CREATE OR REPLACE VIEW tgt COMMENT 'this as that' AS SELECT 1"),
        ("create  materialized view `a`.`b c`.`v``x` as select (1)", "MATERIALIZED_VIEW", "CREATE OR REPLACE MATERIALIZED VIEW tgt as select (1)"),
        ("CREATE TABLE IF NOT EXISTS a.t USING parquet", "MANAGED", "CREATE OR REPLACE TABLE tgt USING parquet"),
        ("CREATE TABLE t(a INT)", "MANAGED", "CREATE OR REPLACE TABLE tgt(a INT)"),
        ("SELECT 1", "VIEW", "SELECT 1"),
    ]
    df = spark.createDataFrame([(d, k) for d, k, _ in cases], "ddl string, kind string").withColumn("tgt", F.lit("tgt"))
    assert [r["target_ddl"] for r in M.rewrite_ddl(df, "ddl", "kind", "tgt").collect()] == [x for _, _, x in cases]


def test_remapped_equals_the_column_form(spark):
    mapping = [("s3://a/", "gs://b/"), ("s3://a/c", "gs://d"), ("S3://E", "gs://f/")]
    urls = ["s3://a/x", "S3://A/c/y", "s3://a", "s3://ab/x", "s3://e/q", "s3://a/c"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(remap_url(F.col("u"), mapping)).collect()] == [remapped(u, mapping) for u in urls]


def test_prefixes_start_at_the_host(spark):
    df = spark.createDataFrame([(1, "https://h/a/b"), (2, "https://h"), (3, "x/y")], "id int, u string")
    m = spark.createDataFrame([("https://h/a", "t://1"), ("https://h", "t://2"), ("x", "z")], "src string, dst string")
    got = {r["id"]: r["mapped_url"] for r in M.remap_url_table(df, "u", m).collect()}
    assert got == {1: "t://1/b", 2: "t://2", 3: "z/y"}


def test_a_failing_pair_leaves_the_others(spark):
    a, b = spark.range(5), spark.range(1, 6)
    broken = a.select(F.raise_error(F.lit("broken table")).cast("long").alias("id"))
    path = work_dir(spark, "evidence")
    pairs = [R.TablePair("ok", a, a), R.TablePair("bad", a.select(F.when(F.col("id") >= 0, F.col("id")).alias("id")), broken.where("id > 1")), R.TablePair("gone", a, None), R.TablePair("differ", a, b), R.TablePair("schema", a, a.withColumnRenamed("id", "other"))]
    got = {(r["pair"], r["check_name"]): (r["status"], r["mismatch_count"], r["details"]) for r in reconcile_pairs(spark, pairs, ReconcileConfig(evidence_path=path, run_id="r1")).collect()}
    assert got["ok", "missing_data_check"][:2] == ("passed", 0)
    assert got["bad", "row_count_check"][0] == "failed" and "broken table" in got["bad", "row_count_check"][2]
    assert got["gone", "schema_check"] == ("failed", None, "target table not found") and got["gone", "missing_data_check"][0] == "skipped"
    assert got["differ", "missing_data_check"][:2] == ("failed", 2)
    assert got["schema", "schema_check"][:2] == ("failed", 2)
    reconcile_pairs(spark, [pairs[3]], ReconcileConfig(evidence_path=path, run_id="r1"))  # again: nothing doubles
    stored = R.read_evidence(spark, path + "/missing_data")
    assert rows(R.summarize_missing(stored, "r1", "target.default.differ"), "issue_type", "row_count") == [("missing_in_source", 1), ("missing_in_target", 1)]
    assert R.summarize_missing(stored, "r1", "target.default.ok").count() == 0
    assert R.read_evidence(spark, path + "/schema").where("target_table = 'schema'").count() == 2


def test_mismatch_counts_are_of_one_call(spark):
    path = work_dir(spark, "sink") + "/m"
    one = spark.createDataFrame([("r", 1), ("r", 2)], "run_id string, x int")
    assert R.write_mismatches(one, path) == 2 and R.write_mismatches(one.limit(1), path) == 1


def test_file_log_volume_folder_reload_and_age(spark):
    src = tempfile.mkdtemp(prefix="tablesync-src-")
    os.makedirs(src + "/one")
    os.makedirs(src + "/two")
    shutil.copy(f"{SF001}/region.parquet", src + "/one/a.parquet")
    shutil.copy(f"{SF001}/nation.parquet", src + "/two/b.parquet")
    os.utime(src + "/two/b.parquet", (1e9, 1e9))
    root = work_dir(spark, "log")
    local = root.removeprefix("file:")
    make = lambda **kw: FC.VolumeCopy(src, root + "/dst", root + "/log", root + "/ckpt", volume="vol", timeout_seconds=300, **kw)
    assert FC.read_log(spark, root + "/log").schema == FC.LOG_SCHEMA
    FC.copy_volume(spark, make(folder="one"), "a")
    assert os.listdir(local + "/dst") == ["one"]
    stats = FC.copy_stats(FC.read_log(spark, root + "/log"))
    assert rows(stats, "run_id", "volume", "total_files", "status") == [("a", "vol", 1, "success")]
    os.remove(local + "/dst/one/a.parquet")
    FC.copy_volume(spark, make(folder="one"), "b")  # seen before
    assert not os.path.exists(local + "/dst/one/a.parquet")
    FC.copy_volume(spark, make(folder="one", mode="reload"), "c")
    assert os.path.exists(local + "/dst/one/a.parquet")
    FC.copy_volume(spark, make(mode="rescan", modified_after=str(dt.datetime(2010, 1, 1))), "d")
    assert rows(FC.read_log(spark, root + "/log").where("run_id = 'd'"), "source_path")[0][0].endswith("/one/a.parquet")
    assert FC.read_log(spark, root + "/log").schema == FC.LOG_SCHEMA


def test_a_replayed_batch_counts_with_its_last_outcome(spark):
    path = work_dir(spark, "log") + "/l"
    when = dt.datetime(2024, 1, 1)
    for status, at in (("error", when), ("success", when + dt.timedelta(seconds=1))):
        row = dict(run_id="r", volume="v", source_path="p", target_path="q", ingestion_time=at, length=1, file_modification_time=when, status=status, error_msg=None, batch_id="0", crc32=None if status == "error" else 7)
        spark.createDataFrame([tuple(row[c] for c in FC.LOG_COLUMNS)], FC.LOG_SCHEMA).write.mode("append").parquet(path)
    assert rows(FC.read_log(spark, path), "status", "crc32") == [("success", 7)]


def test_verdict_per_pair(spark):
    results = spark.createDataFrame([("a", "schema_check", "passed", True, 0, None), ("a", "row_count_check", "failed", False, 2, None), ("a", "missing_data_check", "skipped", None, None, None), ("b", "schema_check", "passed", True, 0, None)], CHECK_RESULT_SCHEMA)
    assert rows(verdict(results), "pair", "passed", "failed_checks", "skipped_checks") == [("a", False, 1, 1), ("b", True, 0, 0)]


def test_tag_plan_counts_and_objects_to_touch(spark):
    s = spark.createDataFrame([("o", "a", "1"), ("o", "b", "2"), ("p", "a", "1")], "object string, tag_name string, tag_value string")
    t = spark.createDataFrame([("o", "a", "1"), ("p", "a", "1")], s.schema)
    plan = M.tag_plan(s, t, ["object"], True)
    assert rows(M.plan_counts(plan), "action", "n") == [("keep", 2), ("set", 1)]
    assert rows(M.objects_to_touch(plan, ["object"]), "object") == [("o",)]


def test_counts_by_digest_equal_exact_counts(spark):
    s = spark.createDataFrame([(1, None, {"x": 1}), (None, 1, None), (2, 2, {"y": 2, "z": 3}), (2, 2, {"y": 2, "z": 3})], "a int, b int, m map<string,int>")
    t = spark.createDataFrame([(1, None, {"x": 1}), (2, 2, {"z": 3, "y": 2}), (None, None, {})], s.schema)
    exact, digest = (rows(R.missing_summary(s, t, method=m), "issue_type", "row_count") for m in ("exact", "digest"))
    assert exact == digest == [("missing_in_source", 1), ("missing_in_target", 1)]
    plan = R.missing_summary(s, t, method="digest")._jdf.queryExecution().toString()
    exchange = [line for line in plan.split("\n") if "Exchange hashpartitioning(_a" in line]
    assert len(exchange) == 1


def test_many_pairs_are_planned_fast(spark):
    import time

    df = spark.range(3)
    began = time.time()
    out = R.row_count_check([R.TablePair(f"p{i}", df, df) for i in range(150)])
    assert time.time() - began < 60 and len(out.columns) == 5
