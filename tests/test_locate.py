"""Differences located by sketches and digest trees; keys and changed cells found."""

import random
from itertools import combinations

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from tablesync.operators import cell_changes as Z
from tablesync.operators import digest_tree as D
from tablesync.operators import keys as K
from tablesync.operators import sketch_diff as S
from tablesync.operators.reconcile import missing_rows
from tablesync.session import work_dir
from tablesync.sources import fixtures as X
from tablesync.sources import storage
from tablesync.sources.tables import load


def pair(spark):
    return load(spark, SF001, "lineitem"), X.lineitem_target(spark, SF001)


# ------------------------------------------------------------------ sketches
def test_sketch_reports_what_missing_rows_does(spark):
    s, t = pair(spark)
    expected = rows(missing_rows(s, t))
    assert expected and rows(S.missing_rows_by_sketch(s, t)) == expected
    # ten times too small: it grows
    assert rows(S.missing_rows_by_sketch(s, t, cells=len(expected) // 5)) == expected
    small = S.peel(S.signed_digests(s, t, s.columns), len(expected) // 5)
    assert small.too_small >= 1 and small.cells > len(expected) and small.keys.count() == len(expected)
    assert S.peel(S.signed_digests(s, t, s.columns), 4 * len(expected)).too_small == 0
    kept = rows(S.missing_rows_by_sketch(s, t, ["l_quantity"], "l_linenumber < 3", "l_linenumber < 3"))
    assert kept == rows(missing_rows(s, t, ["l_quantity"], "l_linenumber < 3", "l_linenumber < 3"))


def test_sketch_of_copies_nulls_and_maps(spark):
    schema = "k long, v string, m map<string,int>"
    s = spark.createDataFrame([(1, "a", {"x": 1, "y": 2})] * 500 + [(None, "b", None)] * 3 + [(2, None, None), (3, "c", {})] + [(i, "same", None) for i in range(10, 400)], schema)
    t = spark.createDataFrame([(1, "a", {"y": 2, "x": 1})] * 20 + [(None, "b", None), (None, None, None)] + [(2, "b", None), (4, "d", None), (4, "d", None)] + [(i, "same", None) for i in range(10, 400)], schema)
    text = lambda df: sorted(map(repr, df.withColumn("m", F.to_json("m")).collect()))
    assert text(S.missing_rows_by_sketch(s, t, cells=192)) == text(missing_rows(s, t))
    # copies that differ on both sides are found by the sketch, and told apart by value
    peeled = {r["n"] for r in S.peel(S.signed_digests(s, t, s.columns), 192).keys.collect()}
    assert {480, 2, -2} <= peeled
    assert S.missing_rows_by_sketch(s, s, cells=192).count() == 0
    assert S.missing_rows_by_sketch(s.limit(0), s.limit(0)).count() == 0
    assert text(S.missing_rows_by_sketch(s, t.limit(0))) == text(missing_rows(s, t.limit(0)))


def test_sketch_traffic_follows_the_difference(spark):
    s, t = pair(spark)
    size, n = S.difference_size(S.signed_digests(s, t, s.columns))
    exact = missing_rows(s, t).count()
    assert n == s.count() + t.count() and 0.7 * exact < size < 1.3 * exact
    assert S.difference_size(S.signed_digests(s, s, s.columns))[0] == 0
    assert S.cells_of(S.signed_digests(s, t, s.columns), 300).count() <= 300


def test_sketch_moves_digests_once_where_cells_would_be_more(spark):
    base = spark.range(0, 40000, 1, 16)
    s, t = base.select("id", (F.col("id") % 7).alias("v")), base.select("id", F.when(F.col("id") % 25 == 0, -1).otherwise(F.col("id") % 7).alias("v"))
    digests = S.signed_digests(s, t, ["id", "v"])
    size, n = S.difference_size(digests)
    got = S.cancelled(digests, 2 * size, n)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 3200 and plan.count("Exchange") == 1 and "Aggregate" not in plan[plan.index("Exchange") :]
    assert S.cancelled(digests, 192, n) is digests  # few cells: tasks send these
    expected = rows(missing_rows(s, t))
    assert len(expected) == 3200 and rows(S.missing_rows_by_sketch(s, t)) == expected
    # many copies of one row are folded by the tasks that hold them
    copies = s.unionByName(s.filter("id = 7").crossJoin(spark.range(3000).select()))
    digests = S.signed_digests(copies, t, ["id", "v"])
    assert {r["n"] for r in S.cancelled(digests, 2 * size, digests.count()).collect()} == {1, -1, 3000}
    # rows are fetched behind a filter that lets few others pass
    keys = S.signed_digests(s, t, ["id", "v"]).groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n <> 0").select("a", "b")
    a, b = S.row_digest(s, ["id", "v"])
    held = s.withColumns({"_da": a, "_db": b})
    some = S._maybe(held, keys, S.BITS * 3200 + 1)
    assert some.filter("id % 25 = 0").count() == 1600 and some.count() < 1600 + 2 * 40000 / S.BITS


# ------------------------------------------------------------------ digest trees
def test_tree_sync_rewrites_differing_leaves_only(spark):
    d = work_dir(spark, "t") + "/orders"
    source = load(spark, SF001, "orders")
    first = D.sync_tree(spark, source, d, ["o_orderkey"], leaf_rows=20)
    assert first.created and first.bits == 7 and rows(D.read_table(spark, d)) == rows(source)
    files = set(D.read_table(spark, d).inputFiles())
    assert D.sync_tree(spark, source, d, ["o_orderkey"], leaf_rows=20) == D.Synced(False, [], 7)
    # two changed keys, one deleted, one new: at most four leaves
    edited = source.where("o_orderkey <> 5").withColumn("o_totalprice", F.when(F.col("o_orderkey").isin(1, 2), 0.0).otherwise(F.col("o_totalprice")))
    edited = edited.unionByName(source.where("o_orderkey = 3").withColumn("o_orderkey", F.lit(-3).cast("long")))
    done = D.sync_tree(spark, edited, d, ["o_orderkey"], leaf_rows=20)
    assert not done.created and 1 <= len(done.leaves) <= 4
    assert rows(D.read_table(spark, d)) == rows(edited)
    now = set(D.read_table(spark, d).inputFiles())
    touched = {f.split("_leaf=")[1].split("/")[0] for f in now - files}
    assert touched <= {str(i) for i in done.leaves} and len(files & now) >= len(files) - 4
    # reading some leaves opens no other folder
    some = D.read_table(spark, d, done.leaves[:1])
    assert {f.split("_leaf=")[1].split("/")[0] for f in some.inputFiles()} <= {str(done.leaves[0])}


def test_tree_comparison_reads_differing_leaves_only(spark, monkeypatch):
    root = work_dir(spark, "t")
    source, target = load(spark, SF001, "orders"), X.orders_target(spark, SF001)
    D.sync_tree(spark, source, root + "/s", ["o_orderkey"], leaf_rows=10)
    D.sync_tree(spark, source.where("o_orderkey <> 7"), root + "/t", ["o_orderkey"], leaf_rows=40)
    read = []
    whole = D.read_table
    monkeypatch.setattr(D, "read_table", lambda *a: read.append(whole(*a)) or read[-1])
    got = D.missing_rows_by_tree(spark, root + "/s", root + "/t")
    assert [tuple(r)[:2] for r in got.collect()] == [("missing_in_target", 7)]
    assert all(len({f.split("_leaf=")[1].split("/")[0] for f in df.inputFiles()}) <= 8 for df in read)
    D.sync_tree(spark, target, root + "/t", ["o_orderkey"], leaf_rows=40)
    assert rows(D.missing_rows_by_tree(spark, root + "/s", root + "/t")) == rows(missing_rows(source, target))
    assert D.missing_rows_by_tree(spark, root + "/s", root + "/s").count() == 0


def test_tree_of_null_and_repeated_keys_and_growth(spark):
    d = work_dir(spark, "t") + "/x"
    schema = "k long, v string, m map<string,int>"
    text = lambda df: sorted(map(repr, df.withColumn("m", F.to_json("m")).collect()))
    one = spark.createDataFrame([(None, "a", None), (None, "b", {"x": 1}), (1, None, {}), (1, None, {})] + [(2, f"hot {i % 3}", None) for i in range(300)], schema)
    D.sync_tree(spark, one, d, ["k"], leaf_rows=50)
    assert text(D.read_table(spark, d)) == text(one)
    two = spark.createDataFrame([(None, "a", None), (1, None, {}), (3, "c", None)] + [(2, f"hot {i % 3}", None) for i in range(299)], schema)
    D.sync_tree(spark, two, d, ["k"], leaf_rows=50)
    assert text(D.read_table(spark, d)) == text(two)
    empty = two.limit(0)
    D.sync_tree(spark, empty, d, ["k"], leaf_rows=50)
    assert D.read_table(spark, d).count() == 0
    many = spark.range(6000).select(F.col("id").alias("k"), F.lit("v").alias("v"), F.lit(None).cast("map<string,int>").alias("m"))
    grown = D.sync_tree(spark, many, d, ["k"], leaf_rows=50)
    assert grown.bits == 7 and not grown.created and D.read_table(spark, d).count() == 6000
    # other columns: written anew
    D.sync_tree(spark, many.drop("m"), d, ["k"], leaf_rows=50)
    assert D.read_table(spark, d).columns == ["k", "v"]
    assert len(D.vacuum(spark, d)) >= 3 and D.vacuum(spark, d) == [] and D.read_table(spark, d).count() == 6000
    e = work_dir(spark, "t") + "/e"
    assert D.sync_tree(spark, empty, e, ["k"]).created and D.read_table(spark, e).columns == ["k", "v", "m"]


def test_a_dead_sync_leaves_the_old_state(spark, monkeypatch):
    d = work_dir(spark, "t") + "/orders"
    source = load(spark, SF001, "orders")
    D.sync_tree(spark, source, d, ["o_orderkey"], leaf_rows=50)

    def dies(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(storage, "write_version", dies)
    with pytest.raises(RuntimeError):
        D.sync_tree(spark, X.orders_target(spark, SF001), d, ["o_orderkey"], leaf_rows=50)
    monkeypatch.undo()
    assert rows(D.read_table(spark, d)) == rows(source)
    D.sync_tree(spark, X.orders_target(spark, SF001), d, ["o_orderkey"], leaf_rows=50)
    assert rows(D.read_table(spark, d)) == rows(X.orders_target(spark, SF001))


def test_a_leaf_is_written_by_as_many_tasks_as_it_needs(spark):
    df = spark.range(1000).withColumn(D.LEAF, F.lit(0)).hint("rebalance", F.col(D.LEAF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


# ------------------------------------------------------------------ keys
def all_keys(names, data, most=None):
    """Minimal keys by trying every set of columns."""
    found = []
    for size in range(1, (most or len(names)) + 1):
        for some in combinations(range(len(names)), size):
            if not any(set(k) <= set(some) for k in found) and len({tuple(r[i] for i in some) for r in data}) == len(data):
                found.append(some)
    return [tuple(names[i] for i in k) for k in found]


@pytest.mark.parametrize("table,most", [("orders", None), ("events", None), ("lineitem", 3)])
def test_minimal_keys_are_those_of_brute_force(spark, table, most):
    df = load(spark, SF001, table)
    assert K.minimal_keys(df, most=most) == all_keys(df.columns, [tuple(r) for r in df.collect()], most)


def test_keys_with_nulls_maps_and_repeated_rows(spark):
    schema = "a int, b int, m map<string,int>"
    data = [(1, None, {"x": 1}), (None, 1, {"x": 1}), (1, 1, {"x": 2}), (None, None, None), (1, 2, {"y": 1, "z": 2}), (2, 2, {"z": 2, "y": 1})]
    df = spark.createDataFrame(data, schema)
    assert K.minimal_keys(df) == [("a", "b"), ("a", "m")]
    assert K.minimal_keys(df, most=1) == []
    assert K.minimal_keys(df, columns=["a", "m"]) == [("a", "m")]
    assert K.minimal_keys(df.unionByName(df.limit(1))) == []
    assert K.minimal_keys(df.limit(1)) == [()] == K.minimal_keys(df.limit(0))


def test_keys_are_confirmed_without_folding_all_rows_first(spark):
    df = spark.range(60000).select("id", (F.col("id") % 40000).alias("most"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("some"), F.greatest("id", F.lit(1)).alias("near"))
    sets = [["id"], ["most"], ["some"], ["near"], ["most", "some"]]
    assert K.confirmed(df, sets) == [True, False, False, False, True]
    # a first look at few digests settles the plain cases, one of them only by its copies
    look = K._first_look(K._digests(df, sets))
    assert look.count() < 5 * 60000 * 3 / K.SLICES and {1, 2} <= K._twice(look)
    # what is left moves once, and is grouped behind the shuffle
    plan = K._brought_together(K._digests(df, sets), 300000).groupBy("i", "a", "b").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan[plan.index("Exchange") :]
    assert K.confirmed(df.limit(0), [["id"]]) == [True] and K.confirmed(df, []) == []


# ------------------------------------------------------------------ changed cells
def cells(df, key):
    return sorted((r["source"][key], r["column_name"], r["source_value"], r["target_value"]) for r in df.collect())


def test_changed_cells_name_the_changed_column(spark):
    # without the copies under other orders only quantities change
    s, t = pair(spark)
    got = Z.changed_cells(s, t.where("l_orderkey >= 0")).collect()
    by_key = [(a, b) for a in s.collect() for b in ([] if a["l_partkey"] % 101 or a["l_orderkey"] % 97 == 0 else [a["l_quantity"] + 1])]
    assert {r["column_name"] for r in got} == {"l_quantity"} and len(got) == len(by_key)
    assert sorted((r["source"]["l_orderkey"], r["source"]["l_linenumber"], float(r["target_value"])) for r in got) == sorted((a["l_orderkey"], a["l_linenumber"], b) for a, b in by_key)


@pytest.mark.parametrize("most_pairs", [10_000, 20, 1])
def test_rows_of_few_values_are_paired(spark, monkeypatch, most_pairs):
    monkeypatch.setattr(Z, "MOST_PAIRS", most_pairs)
    monkeypatch.setattr(Z, "ORDERED", 7)
    r = random.Random(9)
    schema = "id int, a string, b string, c int, m map<string,int>"
    data = [(i, f"a{r.randrange(3)}", f"b{r.randrange(4)}", r.randrange(5), {"x": i % 2} if i % 3 else None) for i in range(120)]
    after, expected = [], []
    for i, row in enumerate(data):
        row = list(row)
        if i % 2 == 0:
            col = 1 + i // 2 % 4
            row[col] = {1: "new", 2: None, 3: 99, 4: {"y": 7}}[col]
            expected.append((i, schema.split(", ")[col].split(" ")[0]))
        after.append(tuple(row))
    s, t = spark.createDataFrame(data, schema), spark.createDataFrame(after, schema)
    got = Z.changed_cells(s, t, most_changed=1)
    assert sorted((r["source"]["id"], r["column_name"]) for r in got.collect()) == sorted(expected)
    # the id is nothing special: without it rows of equal values are interchangeable, and each is paired once
    alike = Z.paired_rows(missing_rows(s, t, ["id"]), ["a", "b", "c", "m"], 1).collect()
    assert all(len(p["changed"]) == 1 for p in alike)


def test_a_hot_token_makes_no_pairs_of_all_its_rows(spark, monkeypatch):
    monkeypatch.setattr(Z, "MOST_PAIRS", 100)
    s = spark.range(400).select(F.lit("s").alias("side"), F.col("id").alias("rid"), F.array(F.lit(1), F.lit(2), F.lit(3), F.col("id") + 1000).cast("array<bigint>").alias("tokens"))
    t = s.select(F.lit("t").alias("side"), (F.col("rid") + 10**6).alias("rid"), F.array(F.lit(1), F.lit(2), F.lit(3), F.col("rid") + 5000).cast("array<bigint>").alias("tokens"))
    got = Z.candidates(s.unionByName(t), 4, 1)
    # all rows share three of four cells: each is paired once, not with each other
    assert 0 < got.count() <= 2 * 400 and got.groupBy("s").count().agg(F.max("count")).first()[0] <= 3


def test_changed_cells_of_nothing_and_unpaired_rows(spark):
    s = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    assert Z.changed_cells(s, s).count() == 0 and Z.changed_cells(s.limit(0), s.limit(0)).count() == 0
    t = spark.createDataFrame([(1, "a", "z"), (3, "c", "q")], s.schema)
    assert cells(Z.changed_cells(s, t, most_changed=1), "k") == [(1, "w", "x", "z")]
