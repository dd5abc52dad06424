from pyspark.sql import functions as F

from conftest import rows
from tablesync.functions.urls import remap_url, replace_url
from tablesync.operators import metadata as M


def test_tag_plan_overwrite_and_keep(spark):
    s = spark.createDataFrame([(1, "a", "x"), (1, "b", " y "), (2, "a", "z")], "object int, tag_name string, tag_value string")
    t = spark.createDataFrame([(1, "a", "x"), (1, "b", "old"), (1, "c", "q")], "object int, tag_name string, tag_value string")
    ow = rows(M.tag_plan(s, t, ["object"], True), "object", "tag_name", "action", "tag_value")
    assert ow == [(1, "a", "keep", "x"), (1, "b", "set", "y"), (1, "c", "unset", None), (2, "a", "set", "z")]
    kp = rows(M.tag_plan(s, t, ["object"], False), "object", "tag_name", "action", "tag_value")
    assert kp == [(1, "a", "keep", "x"), (1, "b", "keep", "old"), (1, "c", "keep", "q"), (2, "a", "set", "z")]
    # applying then planning again: only keeps
    new_t = M.apply_facts(t, M.tag_plan(s, t, ["object"], True), ["object", "tag_name"], "tag_value")
    again = M.tag_plan(s, new_t, ["object"], True)
    assert {r["action"] for r in again.collect()} == {"keep"}
    st = rows(M.tag_statements(M.tag_plan(s, t, ["object"], True), ["object"]), "object", "unset_sql", "set_sql")
    assert st[0] == (1, "ALTER TABLE `1` UNSET TAGS ('c')", "ALTER TABLE `1` SET TAGS ('b' = 'y')")


def test_no_source_tags_with_overwrite_unsets_all(spark):
    s = spark.createDataFrame([], "object int, tag_name string, tag_value string")
    t = spark.createDataFrame([(1, "a", "x")], "object int, tag_name string, tag_value string")
    assert rows(M.tag_plan(s, t, ["object"], True), "action") == [("unset",)]


def test_column_comment_plan_and_escaping(spark):
    s = spark.createDataFrame([("t", "a", "it's"), ("t", "b", None), ("t", "c", "back\\slash")], "table_name string, column_name string, comment string")
    t = spark.createDataFrame([("t", "a", "old"), ("t", "b", "keep me"), ("t", "c", "back\\slash")], "table_name string, column_name string, comment string")
    plan = M.column_comment_plan(s, t, ["table_name"], overwrite=True)
    assert rows(plan, "column_name", "action", "comment") == [("a", "set", "it's"), ("b", "clear", "")]
    assert M.column_comment_plan(s, t, ["table_name"], overwrite=False).count() == 0
    types = spark.createDataFrame([("t", "MANAGED")], "table_name string, table_type string")
    stmt = M.comment_statements(plan, types).first()["statement"]
    assert stmt == "ALTER TABLE t ALTER COLUMN `a` COMMENT 'it\\'s', `b` COMMENT ''"
    vtypes = spark.createDataFrame([("t", "VIEW")], "table_name string, table_type string")
    assert M.comment_statements(plan, vtypes).count() == 2


def test_table_comment_rules(spark):
    s = spark.createDataFrame([("a", "MANAGED", None), ("b", "VIEW", "x"), ("c", "VOLUME", "y"), ("d", "MANAGED", "")],
                              "table_name string, table_type string, comment string")
    t = spark.createDataFrame([("a", ""), ("b", "z"), ("c", "w"), ("d", "old")], "table_name string, comment string")
    got = rows(M.table_comment_plan(s, t), "table_name", "action", "comment")
    assert got == [("b", "set", "x"), ("c", "skip", "y"), ("d", "clear", "")]
    assert M.table_comment_plan(s, t, overwrite=False).count() == 0


def test_grant_plan_modes(spark):
    s = spark.createDataFrame([("o", "u1", "SELECT"), ("o", "u1", "MODIFY"), ("o", "u2", "SELECT")], "securable string, principal string, privilege string")
    t = spark.createDataFrame([("o", "u1", "SELECT"), ("o", "u1", "OWN"), ("o", "u3", "SELECT"), ("o", "u2", "SELECT")], "securable string, principal string, privilege string")
    soft = rows(M.grant_plan(s, t), "principal", "add", "remove")
    assert soft == [("u1", ["MODIFY"], ["OWN"])]
    hard = rows(M.grant_plan(s, t, hard_sync=True), "principal", "add", "remove")
    assert hard == [("u1", ["MODIFY"], ["OWN"]), ("u3", [], ["SELECT"])]


def test_principal_mapping_rules(spark):
    uuid_a = "0123abcd-0000-1111-2222-333344445555"  # has a directory name, target knows it
    uuid_b = "aaaabbbb-0000-1111-2222-333344445555"  # unresolved -> skipped
    uuid_t = "ffffeeee-0000-1111-2222-333344445555"
    principals = spark.createDataFrame([("alice@src",), (uuid_a,), (uuid_b,), ("data-team",)], "principal string")
    mapping = spark.createDataFrame([("alice@src", "alice@tgt")], "src string, dst string")
    sdir = spark.createDataFrame([(uuid_a, "etl-bot")], "app_id string, display_name string")
    tdir = spark.createDataFrame([("etl-bot", uuid_t)], "display_name string, app_id string")
    got = {r["principal"]: (r["target_principal"], r["skipped"]) for r in M.map_principals(principals, mapping, sdir, tdir).collect()}
    assert got == {"alice@src": ("alice@tgt", False), uuid_a: (uuid_t, False), uuid_b: (uuid_b, True), "data-team": ("data-team", False)}


def test_outcome(spark):
    ch = spark.createDataFrame([("a", "applied"), ("a", "applied"), ("b", "applied"), ("b", "skipped")], "obj string, status string")
    got = rows(M.apply_outcome(ch, ["obj"]), "obj", "applied", "failed", "skipped", "status")
    assert got == [("a", 2, 0, 0, "success"), ("b", 1, 0, 1, "failed")]


def test_url_remap_literal_cases(spark):
    df = spark.createDataFrame([("s3://bucket/a/b",), ("S3://Bucket/x",), ("s3://bucketX/y",), ("s3://bucket/deep/z",), ("s3://bucket",), (None,)], "u string")
    mapping = [("s3://bucket/", "gs://t/"), ("s3://bucket/deep/", "gs://d/")]
    got = [r["m"] for r in df.select(remap_url(F.col("u"), mapping).alias("m")).collect()]
    assert got == ["gs://t/a/b", "gs://t/x", None, "gs://d/z", "gs://t/", None]
    keyed = df.where("u is not null").withColumn("k", F.col("u"))
    mt = spark.createDataFrame(mapping, "src string, dst string")
    tab = {r["k"]: r["mapped_url"] for r in M.remap_url_table(keyed, "u", mt).collect()}
    assert tab == {"s3://bucket/a/b": "gs://t/a/b", "S3://Bucket/x": "gs://t/x", "s3://bucketX/y": None, "s3://bucket/deep/z": "gs://d/z", "s3://bucket": "gs://t/"}


def test_url_replace_in_text(spark):
    df = spark.createDataFrame([("LOCATION 'S3://Lake/x' and s3://lake/y",)], "t string")
    got = df.select(replace_url(F.col("t"), [("s3://lake/", "gs://m/"), ("and", "AND")], first_only=True).alias("r")).first()["r"]
    assert got == "LOCATION 'gs://m/x' and gs://m/y"
    allm = df.select(replace_url(F.col("t"), [("s3://lake/", "gs://m/"), ("and", "AND")], first_only=False).alias("r")).first()["r"]
    assert allm == "LOCATION 'gs://m/x' AND gs://m/y"


def test_ddl_rewrite_cases(spark):
    df = spark.createDataFrame(
        [
            ("CREATE TABLE c.s.t (a INT) USING parquet LOCATION 's3://lake/t'", "EXTERNAL", True),
            ("CREATE TABLE c.s.t (a INT) USING parquet LOCATION 's3://lake/t'", "EXTERNAL", False),
            ("CREATE VIEW c.s.v (a, b) AS SELECT 1, 2", "VIEW", False),
            ("CREATE VIEW c.s.v AS SELECT count(1) FROM x", "VIEW", False),
        ],
        "ddl string, kind string, managed boolean",
    ).withColumn("tgt", F.lit("n.s.x"))
    out = [r["target_ddl"] for r in M.rewrite_ddl(df, "ddl", "kind", "tgt", True, F.col("managed"), [("s3://lake/", "gs://m/")]).collect()]
    assert out == [
        "CREATE OR REPLACE TABLE n.s.x (a INT) USING parquet ",
        "CREATE OR REPLACE TABLE n.s.x (a INT) USING parquet LOCATION 'gs://m/t'",
        "CREATE OR REPLACE VIEW n.s.x (a, b) AS SELECT 1, 2",
        "CREATE OR REPLACE VIEW n.s.x AS SELECT count(1) FROM x",
    ]
    keep = M.rewrite_ddl(df.limit(1), "ddl", "kind", "tgt", replace=False).first()["target_ddl"]
    assert keep.startswith("CREATE TABLE IF NOT EXISTS n.s.x (a INT)")


def test_property_plan(spark):
    s = spark.createDataFrame([("a", {"name": "x", "location": "s3://b/a", "secret": "1"}), ("b", {"name": "y"})], "object string, properties map<string,string>")
    t = spark.createDataFrame([("a", {"name": "x", "location": "gs://m/a", "secret": "2"})], "object string, properties map<string,string>")
    got = {r["object"]: r["action"] for r in M.property_plan(s, t, ["name", "location"], [("s3://b/", "gs://m/")]).collect()}
    assert got == {"a": "noop", "b": "create"}
    t2 = spark.createDataFrame([("a", {"name": "z", "location": "gs://m/a"}), ("b", {"name": "y"})], "object string, properties map<string,string>")
    got2 = {r["object"]: r["action"] for r in M.property_plan(s, t2, ["name", "location"], [("s3://b/", "gs://m/")]).collect()}
    assert got2 == {"a": "update", "b": "noop"}


def test_tag_rollup(spark):
    objs = spark.createDataFrame([(1,), (2,), (3,)], "object int")
    tags = spark.createDataFrame([(1, "b", " v "), (1, "a", "w"), (1, "a", "w"), (2, "a", "u"), (9, "z", "z")], "object int, tag_name string, tag_value string")
    got = {r["object"]: (r["tag_names"], sorted(tuple(m.items())[0] for m in r["tag_maps"])) for r in M.tag_rollup(objs, tags, ["object"]).collect()}
    assert got == {1: (["a", "b"], [("a", "w"), ("b", "v")]), 2: (["a"], [("a", "u")])}


def test_ddl_text_is_never_rewritten(spark):
    text = "CREATE VIEW v AS SELECT '" + "long '' text " * 20000 + "'"
    cases = [
        ("CREATE TABLE a.t (x INT COMMENT 'see location ''z''') LOCATION 's3://b'", "EXTERNAL", True, "CREATE OR REPLACE TABLE tgt (x INT COMMENT 'see location ''z''') "),
        ("CREATE TABLE a.t (x INT) comment 'LOCATION ''x''' -- LOCATION 'q'\nLOCATION \"s3://b/c\"", "EXTERNAL", False, "CREATE OR REPLACE TABLE tgt (x INT) comment 'LOCATION ''x''' -- LOCATION 'q'\nLOCATION \"gs://n/c\""),
        ("CREATE TABLE a.t (`LOCATION` STRING COMMENT 'it\\'s s3://b' /* LOCATION 's3://b' */) location\n 's3://b/d'", "EXTERNAL", False, "CREATE OR REPLACE TABLE tgt (`LOCATION` STRING COMMENT 'it\\'s s3://b' /* LOCATION 's3://b' */) location\n 'gs://n/d'"),
        ("CREATE OR REPLACE TEMP VIEW v AS SELECT 1", "VIEW", False, "CREATE OR REPLACE VIEW tgt AS SELECT 1"),
        ("/* by\nhand */ -- CREATE VIEW x\n create global temporary view v as select 1 - 2 / 3", "VIEW", False, "/* by\nhand */ -- CREATE VIEW x\n CREATE OR REPLACE VIEW tgt as select 1 - 2 / 3"),
        ("CREATE VIEW a.s.v AS SELECT 'a.s.t', a.s.t.c, `A`.s.t, x.a.y, `x`.`a`.y, \"a.b\" FROM a.s.t -- a.s.t", "VIEW", False, "CREATE OR REPLACE VIEW tgt AS SELECT 'a.s.t', n.s.t.c, `n`.s.t, x.a.y, `x`.`a`.y, \"a.b\" FROM n.s.t -- a.s.t"),
        ("CREATE VIEW v AS SELECT 'open", "VIEW", False, "CREATE OR REPLACE VIEW tgt AS SELECT 'open"),
        (text, "VIEW", False, text.replace("CREATE VIEW v", "CREATE OR REPLACE VIEW tgt")),
        ("", "VIEW", False, ""),
        (None, "VIEW", False, None),
    ]
    df = spark.createDataFrame([(d, k, m) for d, k, m, _ in cases], "ddl string, kind string, managed boolean").withColumn("tgt", F.lit("tgt"))
    out = M.rewrite_ddl(df, "ddl", "kind", "tgt", True, F.col("managed"), [("s3://b", "gs://n")], catalog=("a", "n"))
    for got, (_, _, _, wanted) in zip(out.collect(), cases):
        assert got["target_ddl"] == wanted


def test_three_way_merge_tells_who_edited(spark):
    from tablesync.operators.merge import merged_facts, three_way_plan

    schema = "o string, k string, v string"
    none = object()
    # base, source, target -> origin, action, value (preferring the target), value preferring the source
    cases = {
        "same": ("1", "1", "1", "unchanged", "keep", "1", "1"),
        "source set": ("1", "2", "1", "source", "set", "2", "2"),
        "target set": ("1", "1", "2", "target", "keep", "2", "2"),
        "source gone": ("1", none, "1", "source", "unset", none, none),
        "target gone": ("1", "1", none, "target", "keep", none, none),
        "both alike": ("1", "2", "2", "both", "keep", "2", "2"),
        "both gone": ("1", none, none, "both", "keep", none, none),
        "apart": ("1", "2", "3", "conflict", "keep", "3", "2"),
        "set and gone": ("1", "2", none, "conflict", "keep", none, "2"),
        "gone and set": ("1", none, "3", "conflict", "keep", "3", none),
        "new at source": (none, "2", none, "source", "set", "2", "2"),
        "new at target": (none, none, "3", "target", "keep", "3", "3"),
        "new alike": (none, "2", "2", "both", "keep", "2", "2"),
        "new apart": (none, "2", "3", "conflict", "keep", "3", "2"),
        "null is a value": (None, None, "2", "target", "keep", "2", "2"),
        "null and gone": (None, none, None, "source", "unset", none, none),
        None: ("1", "2", "1", "source", "set", "2", "2"),
    }
    sides = [spark.createDataFrame([("o", k, c[i]) for k, c in cases.items() if c[i] is not none] * (1 + i), schema) for i in range(3)]
    plan = three_way_plan(sides[1], sides[2], sides[0], ["o", "k"], "v")
    got = {r["k"]: (r["origin"], r["action"], r["v"] if r["remains"] else none) for r in plan.collect()}
    assert got == {k: c[3:6] for k, c in cases.items()}
    for at, prefer in ((5, "target"), (6, "source")):
        merged = merged_facts(three_way_plan(sides[1], sides[2], sides[0], ["o", "k"], "v", prefer), ["o", "k"], "v")
        assert {r["k"]: r["v"] for r in merged.collect()} == {k: c[at] for k, c in cases.items() if c[at] is not none}
    # merged, the target is in step: nothing is left to do
    again = three_way_plan(merged, merged, merged, ["o", "k"], "v")
    assert {(r["origin"], r["action"]) for r in again.collect()} == {("unchanged", "keep")}
