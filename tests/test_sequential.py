"""Thresholds decided over blocks in hash order."""

import random

from conftest import SF001
from pyspark.sql import functions as F

from tablesync.operators import digest_tree as D
from tablesync.operators import reconcile as R
from tablesync.operators import sequential as Q
from tablesync.session import work_dir
from tablesync.sources import fixtures as X
from tablesync.sources.tables import load


def test_sequential_agrees_with_the_exact_threshold(spark):
    root = work_dir(spark, "t")
    source, target = load(spark, SF001, "orders"), X.orders_target(spark, SF001)
    D.sync_tree(spark, source, root + "/s", ["o_orderkey"], leaf_rows=12)
    D.sync_tree(spark, target, root + "/t", ["o_orderkey"], leaf_rows=24)
    counts = R.match_counts(source, target)
    for threshold in (0.0, 90.0, 97.5, 98.5, 100.0):
        want = R.threshold_check(counts, threshold).first()["passed"]
        exact = Q.sequential_threshold(spark, root + "/s", root + "/t", threshold, exact=True).first()
        early = Q.sequential_threshold(spark, root + "/s", root + "/t", threshold, error=1e-6).first()
        assert exact["passed"] == want == early["passed"] and exact["verdict"] == "certain", threshold
        assert early["leaves_read"] <= exact["leaves_read"] <= exact["differing_leaves"] and exact["source_count"] == source.count()
    # one missing row fails 100 %, and 0 % needs no leaf at all
    assert Q.sequential_threshold(spark, root + "/s", root + "/t", 100.0).first()["leaves_read"] < exact["differing_leaves"]
    assert Q.sequential_threshold(spark, root + "/s", root + "/t", 0.0).first()["leaves_read"] == 0
    same = Q.sequential_threshold(spark, root + "/s", root + "/s").first()
    assert (same["passed"], same["verdict"], same["differing_leaves"], same["leaves_read"]) == (True, "certain", 0, 0)


def test_the_test_stops_early_and_errs_rarely(spark):
    rng = random.Random(3)
    wrong = stopped = 0
    for trial in range(300):
        rate = 0.1 * (0.5 if trial % 2 else 1.5)
        leaves = []
        for _ in range(400):
            n = rng.randint(80, 120)
            missing = 4 * sum(rng.random() < rate for _ in range(n // 4))  # rows come by keys of four
            leaves.append((n // 4 * 4, missing))
            if len(leaves) >= Q.LEAST_LEAVES and abs(ratio := Q.log_ratio(leaves, 0.1, 0.25)) >= 6.9:
                stopped += 1
                wrong += (ratio > 0) != (rate > 0.1)
                break
    assert stopped == 300 and wrong <= 3


def test_empty_tables_pass(spark):
    root = work_dir(spark, "t")
    empty = load(spark, SF001, "orders").where(F.lit(False))
    D.sync_tree(spark, empty, root + "/e", ["o_orderkey"])
    D.sync_tree(spark, load(spark, SF001, "orders"), root + "/o", ["o_orderkey"])
    assert Q.sequential_threshold(spark, root + "/e", root + "/o").first()["passed"]
    got = Q.sequential_threshold(spark, root + "/o", root + "/e", 50.0).first()
    assert not got["passed"] and got["verdict"] == "certain"
