"""Versioned changes as a stream; counts from footers."""

import contextlib
import io
import random

from conftest import SF001, rows
from pyspark.sql import functions as F

from tablesync.operators import reconcile as R
from tablesync.session import work_dir
from tablesync.sources import fixtures as X
from tablesync.sources.tables import load
from tablesync.streaming import change_stream as CS

SCHEMA = "k long, s string, v int, m map<string,int>, _version long, _deleted boolean, _changed_at timestamp"


def at(seconds):
    import datetime

    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def take_in(spark, root, changes, **more):
    changes.coalesce(1).write.mode("append").parquet(root + "/changes")
    return CS.sync_change_stream(spark, root + "/changes", changes.schema, ["k", "s"], root + "/accepted", root + "/checkpoint", **more)


def as_text(df):
    return sorted(map(repr, df.withColumn("m", F.to_json("m")).collect()))


def test_any_order_gives_what_one_batch_gives(spark):
    rng = random.Random(5)
    changes = []
    for k in (1, 2, 3, None):
        for s in ("a", None):
            for version in range(1, 6):
                changes.append((k, s, None if version == 2 else version, {"x": version, "y": 1}, version, version in (3, 5) and k == 2, at(version)))
    changes += [(1, "a", 70, None, 5, False, at(9)), (1, "a", None, {}, 5, False, at(9))]  # ties of one version
    changes += [(3, "a", 0, None, 4, True, at(9)), (7, "a", 1, None, None, False, at(1)), (8, "a", 1, None, 1, None, at(1)), (9, "a", 1, None, 1, False, None)]
    changes += changes[::3]
    batch = CS.latest_rows(CS.with_digest(spark.createDataFrame(changes, SCHEMA), ["k", "s"]), ["k", "s"])
    expected = as_text(batch)
    assert len(expected) == 7  # both rows of k = 2 are deleted; 7 and 9 can't be ordered
    for _ in range(2):
        rng.shuffle(changes)
        root = work_dir(spark, "t")
        for lo in (0, 20):
            out = take_in(spark, root, spark.createDataFrame(changes[lo : lo + 20] if lo == 0 else changes[lo:], SCHEMA))
        assert as_text(out) == expected
    accepted = spark.read.parquet(root + "/accepted").count()
    assert accepted < len(changes) and take_in(spark, root, spark.createDataFrame(changes, SCHEMA)).count() == 7
    assert spark.read.parquet(root + "/accepted").count() == accepted  # nothing is newer


def test_deletes_are_forgotten_behind_the_watermark(spark):
    root = work_dir(spark, "t")
    of = lambda *c: spark.createDataFrame([(k, "a", v, None, n, d, at(t)) for k, v, n, d, t in c], SCHEMA)
    take_in(spark, root, of((1, 1, 5, False, 0), (1, None, 6, True, 10), (2, 1, 1, False, 10)), delay="1 minute")
    # within the delay the delete is still known: an older version stays out
    assert rows(take_in(spark, root, of((1, 9, 4, False, 11)), delay="1 minute"), "k") == [(2,)]
    take_in(spark, root, of((3, 1, 1, False, 7200)), delay="1 minute")
    # the watermark passed: what is older than it is dropped as late, what is newer than the delete counts
    assert rows(take_in(spark, root, of((1, 9, 4, False, 12)), delay="1 minute"), "k") == [(2,), (3,)]
    out = take_in(spark, root, of((1, 9, 7, False, 7300)), delay="1 minute")
    assert rows(out, "k", "v") == [(1, 9), (2, 1), (3, 1)]


def test_a_hot_key_sends_one_row_a_batch(spark):
    hot = spark.range(5000).select(F.lit(1).cast("long").alias("k"), F.lit("a").alias("s"), F.col("id").alias(CS.VERSION), F.lit(False).alias(CS.DELETED), F.lit(0).cast("long").alias(CS.DIGEST)).coalesce(1)
    kept = hot.mapInArrow(CS._newest_of_batches(["k", "s"]), hot.schema).collect()
    assert len(kept) == 1 and kept[0][CS.VERSION] == 4999
    assert hot.limit(0).mapInArrow(CS._newest_of_batches(["k", "s"]), hot.schema).count() == 0


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_stored_counts_come_from_footers(spark):
    d = work_dir(spark, "t") + "/orders"
    X.orders_target(spark, SF001).repartition(5).write.parquet(d)
    source = f"{SF001}/orders.parquet"
    out = R.stored_row_counts(spark, [R.StoredPair("p", source, d)])
    plan = _plan(out)
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "ReadSchema: struct<o_" not in plan
    n, m = load(spark, SF001, "orders").count(), X.orders_target(spark, SF001).count()
    assert rows(out) == [("p", n, m, m - n, "match" if n == m else "mismatch")]
    kept = R.stored_row_counts(spark, [R.StoredPair("p", source, source, "o_custkey < 50", None)])
    plan = _plan(kept)
    assert plan.count("PushedAggregation: [COUNT(*)]") == 1 and "LessThan(o_custkey,50)" in plan
    assert kept.collect()[0]["source_row_count"] == load(spark, SF001, "orders").where("o_custkey < 50").count()
    # the caller's session keeps its settings, an empty table has no rows
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false" and "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.read.parquet(source).limit(0).write.parquet(d + "-empty")
    assert rows(R.stored_row_counts(spark, [R.StoredPair("e", d + "-empty", d + "-empty")])) == [("e", 0, 0, 0, "match")]
