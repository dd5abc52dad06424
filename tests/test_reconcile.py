import math

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from tablesync.operators import reconcile as R
from tablesync.plans.cascade import ReconcileConfig, reconcile_pairs
from tablesync.sources import fixtures as X
from tablesync.sources.tables import load


def test_missing_rows_of_identical_tables_is_empty(spark):
    li = load(spark, SF001, "lineitem")
    assert R.missing_rows(li, li).count() == 0


def test_missing_rows_both_directions_and_swap(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "k int, v string")
    got = rows(R.missing_rows(s, t), "issue_type", "k", "v")
    assert got == [
        ("missing_in_source", 2, "x"), ("missing_in_source", 4, "d"),
        ("missing_in_target", 2, "b"), ("missing_in_target", 3, "c"),
    ]
    swapped = rows(R.missing_rows(t, s), "issue_type", "k", "v")
    flip = {"missing_in_source": "missing_in_target", "missing_in_target": "missing_in_source"}
    assert sorted((flip[a], b, c) for a, b, c in got) == swapped


def test_null_shift_is_not_a_match(spark):
    # Spark hashes skip nulls, so (1, null) and (null, 1) hash alike; values do not
    s = spark.createDataFrame([(1, None)], "a int, b int")
    t = spark.createDataFrame([(None, 1)], "a int, b int")
    assert R.missing_rows(s, t).count() == 2


def test_set_semantics_and_each_missing_copy_reported(spark):
    s = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,)], "k int")
    t = spark.createDataFrame([(1,)], "k int")
    got = rows(R.missing_rows(s, t), "issue_type", "k")
    assert got == [("missing_in_target", 2), ("missing_in_target", 2)]
    ms = {r["k"]: r["count_diff"] for r in R.multiset_diff(s, t).collect()}
    assert ms == {1: 2, 2: 2}


def test_hot_value_is_expanded_in_bounded_chunks(spark):
    s = spark.createDataFrame([(7,)] * 10 + [(8,)], "k int")
    t = spark.createDataFrame([(9,)], "k int")
    grouped, cols = R.presence(s, t)
    one = grouped.where("target_count = 0").select("k", F.col("source_count").alias("_n"))
    out = R.expand_counts(one, "_n", chunk=3)
    assert sorted(r["k"] for r in out.collect()) == [7] * 10 + [8]


def test_float_zero_nan_and_map_columns(spark):
    s = spark.createDataFrame([(0.0, float("nan"), {"a": "1", "b": "2"})], "x double, y double, m map<string,string>")
    t = spark.createDataFrame([(-0.0, float("nan"), {"b": "2", "a": "1"})], "x double, y double, m map<string,string>")
    assert R.missing_rows(s, t).count() == 0
    t2 = spark.createDataFrame([(0.0, float("nan"), {"a": "1"})], "x double, y double, m map<string,string>")
    assert R.missing_rows(s, t2).count() == 2


def test_arrays_structs_decimals(spark):
    schema = "a array<float>, s struct<p:int,q:string>, d decimal(38,10)"
    from decimal import Decimal

    s = spark.createDataFrame([([1.0, 2.0], (1, "x"), Decimal("1.5")), ([3.0], (2, "y"), Decimal("2.5"))], schema)
    t = spark.createDataFrame([([1.0, 2.0], (1, "x"), Decimal("1.5")), ([3.0], (2, "z"), Decimal("2.5"))], schema)
    assert R.missing_rows(s, t).count() == 2


def test_exclusions_filters_and_common_columns(spark):
    s = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, ts int")
    t = spark.createDataFrame([(1, "a", 11), (2, "b", 21), (3, "c", 30)], "K int, v string, extra int")
    assert R.common_columns(s, t) == ["k", "v"]
    assert R.common_columns(s, t, exclude=["V"]) == ["k"]
    assert rows(R.missing_rows(s, t, exclude=["ts"]), "issue_type", "k") == [("missing_in_source", 3)]
    assert R.missing_rows(s, t, target_filter="K < 3").count() == 0
    with pytest.raises(R.NoCommonColumns):
        R.missing_rows(s, t, exclude=["k", "v"])


def test_evidence_map(spark):
    s = spark.createDataFrame([(1, "a", None)], "k int, v string, n string")
    t = spark.createDataFrame([(2, "a", None)], "k int, v string, n string")
    m = R.missing_rows(s, t, with_evidence=True).where("issue_type = 'missing_in_target'").first()["data"]
    assert m == {"k": "1", "v": "a", "n": None}


def test_flagship_counts_match_fixture_notes(spark):
    s, t = load(spark, "/root/testdata/sf0.01", "lineitem"), X.lineitem_target(spark, "/root/testdata/sf0.01")
    summary = {r["issue_type"]: r["row_count"] for r in R.missing_summary(s, t).collect()}
    assert summary == {"missing_in_target": 1217, "missing_in_source": 1264}


def test_events_with_nulls(spark):
    sf = "/root/testdata/sf0.01"
    summary = {r["issue_type"]: r["row_count"] for r in R.missing_summary(X.events_source(spark, sf), X.events_target(spark, sf)).collect()}
    assert summary == {"missing_in_target": 143, "missing_in_source": 143}


def test_schema_diff_labels_in_priority(spark):
    s = spark.createDataFrame([], "a int, b string, c int, d int")
    t = spark.createDataFrame([], "a int, b int, e int").withColumn("c", F.lit(1))  # c not nullable
    d = {r["column_name"]: r["comparison_result"] for r in R.schema_diff_tables(spark, [R.TablePair("p", s, t)]).collect()}
    assert d == {"b": "type_mismatch", "c": "nullable_mismatch", "d": "missing_in_target", "e": "missing_in_source"}
    d2 = R.schema_diff_tables(spark, [R.TablePair("p", s, t)], exclude=["b", "c", "d", "e"]).count()
    assert d2 == 0


def test_row_counts_many_pairs(spark):
    a = spark.range(10)
    b = spark.range(7)
    got = {r["pair"]: (r["row_count_diff"], r["comparison_result"]) for r in R.row_count_check([R.TablePair("x", a, b), R.TablePair("y", a, a, "id < 5", "id < 5")]).collect()}
    assert got == {"x": (-3, "mismatch"), "y": (0, "match")}


def test_cascade_skips_after_failure(spark):
    sf = SF001
    n = load(spark, sf, "nation")
    pairs = [
        R.TablePair("same", n, n),
        R.TablePair("dups", X.nation_twice(spark, sf), n),
        R.TablePair("schema", load(spark, sf, "orders"), X.orders_reshaped(spark, sf)),
        R.TablePair("nulls", X.events_source(spark, sf), X.events_target(spark, sf)),
    ]
    res = {(r["pair"], r["check_name"]): r["status"] for r in reconcile_pairs(spark, pairs).collect()}
    assert res[("same", "missing_data_check")] == "passed"
    assert res[("dups", "row_count_check")] == "failed" and res[("dups", "missing_data_check")] == "skipped"
    assert res[("schema", "schema_check")] == "failed"
    assert res[("schema", "row_count_check")] == "skipped" and res[("schema", "missing_data_check")] == "skipped"
    assert res[("nulls", "missing_data_check")] == "failed"
    only_missing = reconcile_pairs(spark, pairs[:1], ReconcileConfig(schema_check=False, row_count_check=False))
    assert [r["check_name"] for r in only_missing.collect()] == ["missing_data_check"]


def test_sampling_is_deterministic(spark):
    lst = X.document_listing(spark, SF001)
    a = [tuple(r) for r in R.sample_objects(lst, 5, 7, ["schema_name", "table_name"]).collect()]
    b = [tuple(r) for r in R.sample_objects(lst, 5, 7, ["schema_name", "table_name"]).collect()]
    c = [tuple(r) for r in R.sample_objects(lst, 5, 8, ["schema_name", "table_name"]).collect()]
    assert a == b and len(a) == 5 and a != c


def test_threshold(spark):
    df = spark.createDataFrame([("a", 100, 1), ("b", 0, 0), ("c", 10, 5)], "pair string, source_count long, missing_count long")
    got = {r["pair"]: (round(r["match_pct"], 3), r["passed"]) for r in R.threshold_check(df, 90.0).collect()}
    assert got == {"a": (99.0, True), "b": (100.0, True), "c": (50.0, False)}
    assert not math.isnan(got["b"][0])


def test_stamped_result_layout(spark):
    s = spark.createDataFrame([(1,)], "k int")
    t = spark.createDataFrame([(2,)], "k int")
    out = R.missing_data_rows(R.missing_rows(s, t, with_evidence=True), "run1", "c1.s1.t1", "c2.s2.t2")
    assert out.columns == ["run_id", "target_catalog", "target_schema", "target_table", "source_catalog", "source_schema", "source_table", "issue_type", "data", "check_timestamp"]
    assert out.count() == 2


def test_hash_collision_regression_sf01(spark):
    # SURVEY 2.10 row 1: the 32-bit hash hides one of the 6,218 missing rows
    sf = "/root/testdata/sf0.1"
    s = load(spark, sf, "lineitem")
    t = s.where("l_orderkey % 97 <> 0")
    assert R.missing_rows(s, t).count() == 6218
    assert R.missing_rows_hash32(s, t).count() == 6217


def test_hash32_sees_nulls_alike(spark):
    s = spark.createDataFrame([(1, None)], "a int, b int")
    t = spark.createDataFrame([(None, 1)], "a int, b int")
    assert R.missing_rows_hash32(s, t).count() == 0  # the reference's blind spot
    assert R.missing_rows(s, t).count() == 2


def test_write_mismatches_counts_this_run(spark):
    from tablesync.session import work_dir

    path = work_dir(spark, "mismatch") + "/missing"
    s = spark.createDataFrame([(1,), (2,)], "k int")
    t = spark.createDataFrame([(2,), (3,)], "k int")
    rows_ = R.missing_data_rows(R.missing_rows(s, t, with_evidence=True), "run-a", "c.s.t", "c2.s.t")
    assert R.write_mismatches(rows_, path, "run-a") == 2
    rows_b = R.missing_data_rows(R.missing_rows(s, s, with_evidence=True), "run-b", "c.s.t", "c2.s.t")
    assert R.write_mismatches(rows_b, path, "run-b") == 0
    assert R.summarize_missing(spark.read.parquet(path), "run-a").count() == 2
