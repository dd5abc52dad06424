import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from tablesync.functions.text import substitute
from tablesync.operators import bookkeeping as A
from tablesync.operators import settings as C
from tablesync.sources import fixtures as X


def _results(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [
        ("r1", "replication", "c1", "s1", "t1", "table", "success", t0, t0 + dt.timedelta(seconds=2), None, '{"a":1}', 1, 3),
        ("r1", "replication", "c1", "s1", "t2", "table", "failed", t0, t0 + dt.timedelta(seconds=1.5), "boom", None, 3, 3),
        ("r1", "replication", "c1", "s2", "t3", "table", "skipped", t0, t0, None, None, 1, 3),
        ("r2", "backup", "c2", "s1", "t1", "table", "success", t0, t0 + dt.timedelta(seconds=4), None, None, 1, 3),
    ]
    schema = ("run_id string, operation_type string, catalog_name string, schema_name string, object_name string, object_type string, "
              "status string, start_time timestamp, end_time timestamp, error_message string, details string, attempt_number int, max_attempts int")
    return spark.createDataFrame(data, schema)


def test_audit_rows_layout_and_duration(spark):
    a = A.audit_rows(_results(spark), user="me")
    assert [f.name for f in a.schema.fields] == [f.name for f in A.AUDIT_SCHEMA.fields]
    d = {r["object_name"] + r["run_id"]: r["duration_seconds"] for r in a.collect()}
    assert d == {"t1r1": 2.0, "t2r1": 1.5, "t3r1": 0.0, "t1r2": 4.0}


def test_run_summary(spark):
    s = {r["run_id"]: r for r in A.run_summary(A.audit_rows(_results(spark), user="me")).collect()}
    r1 = s["r1"]
    assert (r1["total_operations"], r1["successful_operations"], r1["failed_operations"], r1["skipped_operations"]) == (3, 1, 1, 1)
    assert (r1["total_catalogs"], r1["total_schemas"], r1["total_tables"]) == (1, 2, 3)
    assert round(r1["success_rate"], 3) == 33.333 and r1["rate_excluding_skipped"] == 50.0
    assert r1["status"] == "completed_with_failures" and s["r2"]["status"] == "completed"


def test_rollup(spark):
    got = {r["catalog_name"]: (r["total"], r["failed"]) for r in A.rollup_status(_results(spark), ["catalog_name"], rollup=True).collect()}
    assert got == {None: (4, 1), "c1": (3, 1), "c2": (1, 0)}


def test_effective_settings_most_specific_wins(spark):
    settings = spark.createDataFrame(
        [("group", "*", "k", "g"), ("catalog", "c", "k", "c"), ("schema", "c.s", "k", "s"), ("table", "c.s.t", "k", "t"),
         ("group", "*", "only_group", "1"), ("schema", "c.s2", "k", "s2")],
        "level string, object string, key string, value string",
    )
    objs = spark.createDataFrame([("c", "s", "t"), ("c", "s", "u"), ("c", "s2", "v"), ("d", "x", "y")], "catalog_name string, schema_name string, table_name string")
    got = {(r["table_name"], r["key"]): (r["value"], r["level"]) for r in C.effective_settings(settings, objs).collect()}
    assert got[("t", "k")] == ("t", "table") and got[("u", "k")] == ("s", "schema")
    assert got[("v", "k")] == ("s2", "schema") and got[("y", "k")] == ("g", "group") and got[("y", "only_group")] == ("1", "group")


def test_substitute(spark):
    df = spark.createDataFrame([("{{catalog_name}}.{{schema_name}}_bk.{{table_name}} {{unknown}}", "c", "s", "t")], "tpl string, c string, s string, t string")
    out = df.select(substitute(F.col("tpl"), {"catalog_name": F.col("c"), "schema_name": F.col("s"), "table_name": F.col("t")}).alias("o")).first()["o"]
    assert out == "c.s_bk.t {{unknown}}"


def test_event_results_fixture(spark):
    r = X.event_results(spark, SF001)
    assert r.count() == 1000
    assert {x["status"] for x in r.select("status").distinct().collect()} == {"success", "failed", "skipped"}


def test_nested_settings_merge_by_path(spark):
    import json

    from tablesync.operators.nested_settings import effective_nested, setting_leaves

    def merge(far, near):
        out = dict(far)
        for k, v in near.items():
            if v is not None:
                out[k] = merge(out[k] if isinstance(out.get(k), dict) else {}, v) if isinstance(v, dict) and v else (out.get(k, {}) if v == {} else v)
        return out

    def flat(tree, path=()):
        return {p: v for k, x in tree.items() for p, v in (flat(x, (*path, k)) if isinstance(x, dict) else {(*path, k): x}).items()}

    docs = {
        ("group", "*"): {"a": {"b": {"c": 1, "d": [1, {"x": 2}]}, "e": "t"}, "p": {"q": {"r": 1}}, "k.l": 1.5},
        ("catalog", "c"): {"a": {"b": 5}, "p": {"q": {"s": 2}}, "z": None},
        ("schema", "c.s"): {"a": {"b": {"f": True}, "e": None}, "p": {"q": [3]}},
        ("table", "c.s.t"): {"p": {"q": {"u": 4}}, "n": "new"},
    }
    settings = spark.createDataFrame([(*k, json.dumps(v)) for k, v in docs.items()] + [("schema", "c.other", None)], "level string, object string, value string")
    objects = spark.createDataFrame([("c", "s", "t"), ("c", "s", "u"), ("c", "other", "t"), ("d", "s", "t")], "catalog_name string, schema_name string, table_name string")
    got = {}
    for r in effective_nested(settings, objects).collect():
        got.setdefault(tuple(r)[:3], {})[tuple(r["path"])] = json.loads(r["value"])
    for c, s, t in [tuple(o) for o in objects.collect()]:
        tree = {}
        for at in (("group", "*"), ("catalog", c), ("schema", f"{c}.{s}"), ("table", f"{c}.{s}.{t}")):
            tree = merge(tree, docs.get(at, {}))
        assert got[c, s, t] == flat(tree), (c, s, t)
    assert setting_leaves(settings.limit(0)).count() == 0 == effective_nested(settings.limit(0), objects).count()


def test_setting_of_all_objects_meets_them_in_all_tasks(spark):
    from tablesync.operators.nested_settings import effective_nested, met_leaves

    names = {"group": F.lit("*"), "catalog": F.col("c"), "schema": F.concat_ws(".", "c", "s"), "table": F.concat_ws(".", "c", "s", "t")}
    objects = spark.range(6000).select(F.lit("c").alias("c"), F.lit("s").alias("s"), F.col("id").cast("string").alias("t"))
    leaves = spark.createDataFrame([("group", "*", ["a"], "1", 0), ("schema", "c.s", ["b", "x"], "2", 2), ("table", "c.s.7", ["b"], "3", 3)], "level string, object string, path array<string>, value string, rank int")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = met_leaves(leaves, objects, names, 8)
        in_tasks = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert sum(in_tasks) == 12001 and max(in_tasks) < 12001 / 2
    # the same object twice is one; names that are null have no settings of their own level
    settings = spark.createDataFrame([("group", "*", '{"a": 1}'), ("schema", "c.s", '{"b": {"x": 2}}'), ("table", "c.s.7", '{"b": 3}')], "level string, object string, value string")
    some = objects.where("t < 9").unionByName(objects.where("t < 9")).unionByName(spark.sql("select 'c' as c, 's' as s, string(null) as t"))
    got = sorted((r["t"] or "-", ".".join(r["path"]), r["value"]) for r in effective_nested(settings, some, ["c", "s", "t"]).collect())
    assert got == sorted((t, *x) for t in [*map(str, range(9)), "-"] for x in [("a", "1"), ("b", "3") if t == "7" else ("b.x", "2")])


def test_summaries_from_sketches_of_runs(spark):
    import random

    from tablesync.operators import run_sketches as S

    r = random.Random(4)
    rows = [(f"run_{i % 7}", f"op{i % 2}", f"c{i % 3}", f"s{r.randrange(5)}" if i % 11 else None, f"t{r.randrange(9000)}" if i % 11 else None, r.choice(["success", "failed", "skipped"]), r.lognormvariate(1, 2) if i % 13 else None) for i in range(40000)]
    audit = spark.createDataFrame(rows, "run_id string, operation_type string, catalog_name string, schema_name string, object_name string, status string, duration_seconds double")
    counts, durations = S.sketch_counts(audit), S.sketch_durations(audit)
    assert counts.count() == 14
    total = S.summarize(counts, []).first()
    assert (total["total"], total["catalogs"], total["schemas"]) == (40000, 3, len({(x[2], x[3]) for x in rows if x[3]}))
    exact = len({x[2:5] for x in rows if x[4]})
    assert abs(total["objects"] - exact) <= 0.03 * exact
    assert total["failed"] == sum(x[5] == "failed" for x in rows)
    # the order of merges, merges of merges, and a run added twice change no distinct count
    cols = ["catalogs", "schemas", "objects"]
    halves = [counts.where(f"run_id {op} 'run_3'") for op in ("<", ">=")]
    for a, b in (halves, halves[::-1]):
        merged = S.merge_counts(a, ["operation_type"]).unionByName(S.merge_counts(b, ["operation_type"])).unionByName(S.merge_counts(b, ["operation_type"]))
        assert [S.summarize(merged, []).first()[c] for c in cols] == [total[c] for c in cols]
    values = sorted(x[6] for x in rows if x[6] is not None)
    got = S.duration_quantiles(durations, [], {"low": 0.05, "mid": 0.5, "high": 0.99}).first()
    for name, q in (("low", 0.05), ("mid", 0.5), ("high", 0.99)):
        at = values[int(q * len(values))]
        assert abs(got[name] - at) <= 0.02 * at
    assert S.summarize(counts.limit(0), ["operation_type"]).count() == 0
