from conftest import SF001, rows
from tablesync.operators import selection as S
from tablesync.sources import fixtures as X


def _listing(spark):
    return spark.createDataFrame(
        [
            ("s1", "t1", "MANAGED", None, "s3://x/tables/1"),
            ("s1", "t2", "MANAGED", "p-1", "s3://x/tables/2"),
            ("s1", "t3", "MANAGED", None, "s3://x/ext/3"),
            ("s1", "v1", "VIEW", None, None),
            ("s2", "__materialization_mat_a", "MANAGED", None, None),
            ("s2", "_xmaterialization_mat_b", "MANAGED", None, None),
            ("s2", "event_log_c", "MANAGED", None, None),
            ("s2", "e1", "EXTERNAL", None, "s3://x/e1"),
        ],
        "schema_name string, table_name string, table_type string, pipeline_id string, storage_location string",
    )


def test_hide_internal_is_literal(spark):
    names = [r["table_name"] for r in S.hide_internal(_listing(spark)).collect()]
    # underscores are not wildcards: _xmaterialization_mat_b stays
    assert "_xmaterialization_mat_b" in names and "__materialization_mat_a" not in names and "event_log_c" not in names


def test_classify_and_filter_types(spark):
    c = {r["table_name"]: r["effective_type"] for r in S.classify_type(_listing(spark)).collect()}
    assert c["t1"] == "MANAGED" and c["t2"] == "STREAMING_TABLE" and c["t3"] == "EXTERNAL" and c["v1"] == "VIEW" and c["e1"] == "EXTERNAL"
    cl = S.classify_type(_listing(spark))
    assert S.filter_types(cl, []).count() == 8
    assert S.filter_types(cl, [], kind="volume").count() == 0
    assert sorted(r["table_name"] for r in S.filter_types(cl, ["streaming_table"]).collect()) == ["t2"]


def test_selection_predicate(spark):
    sel = S.Selection(
        target_schemas=[S.SchemaSelection("s1", exclude_tables=["t1"], table_types=["EXTERNAL"]), S.SchemaSelection("s2", tables=["e1"])],
        operation="replication",
    )
    got = sorted(r["table_name"] for r in S.select_objects(_listing(spark), sel).collect())
    assert got == ["e1", "t2", "t3"]  # EXTERNAL implies MANAGED for data work; view excluded
    ex = sorted(r["table_name"] for r in S.select_objects(_listing(spark), S.Selection(exclude_schemas=["s2"])).collect())
    assert ex == ["t1", "t2", "t3", "v1"]
    expr = S.Selection(schema_table_filter_expression="table_name like 't%'", table_types=["MANAGED"])
    assert sorted(r["table_name"] for r in S.select_objects(_listing(spark), expr).collect()) == ["t1", "t2", "t3"]


def test_filter_objects_and_pending_and_exists(spark):
    lst = _listing(spark)
    f = S.filter_objects(lst, "table_schema = 's2'", renames={"schema_name": "table_schema"})
    assert sorted(r["table_name"] for r in f.collect()) == ["_xmaterialization_mat_b", "e1"]
    assert S.filter_objects(lst, None).count() == 0
    done = spark.createDataFrame([("s1", "t1")], "schema_name string, table_name string")
    assert S.pending(lst, done, ["schema_name", "table_name"]).count() == 7
    req = spark.createDataFrame([("s1", "t1"), ("s9", "zz")], "schema_name string, table_name string")
    assert rows(S.with_exists(req, lst, ["schema_name", "table_name"]), "table_name", "exists") == [("t1", True), ("zz", False)]
    share = spark.createDataFrame([("s1.t1",), ("s2.e1",)], "full_name string")
    assert S.not_shared(lst, share, S.full_name("schema_name", "table_name")).count() == 6
    assert S.shared(lst, share, S.full_name("schema_name", "table_name")).count() == 2


def test_listing_fixture_types(spark):
    lst = S.classify_type(X.document_listing(spark, SF001))
    kinds = {r["effective_type"] for r in lst.collect()}
    assert kinds == {"VIEW", "EXTERNAL", "MANAGED", "STREAMING_TABLE"}


def test_catalog_listing(spark):
    spark.range(3).createOrReplaceTempView("tablesync_tmp_view")
    tables = S.list_tables(spark, "default")
    assert tables.columns == ["schema_name", "table_name"]
    assert "tablesync_tmp_view" not in [r["table_name"] for r in tables.collect()]  # temporary views hidden
    assert "default" in [r["schema_name"] for r in S.list_schemas(spark).collect()]
