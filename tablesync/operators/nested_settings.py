"""Nested settings, merged by path.

A setting row holds a JSON object for one level (group, catalog, schema, table)
and object, as in :mod:`tablesync.operators.settings`.  Levels merge from the
least specific on, dictionaries path by path: a nearer level's value replaces
the farther ones' at its path, all that they hold below it, and a plain value
of theirs above it.  Lists replace each other whole; null sets nothing.

Documents are parsed to VARIANT once and taken apart level of nesting by level
of nesting, a row a leaf, before any object meets them: settings are few,
objects many.  Objects are dealt into parts by their full names; a part gets a
copy of the leaves of each group, catalog and schema that its objects are below,
so that a setting of all objects meets them in all tasks and not in one.  An
object meets the leaves of its four ancestors in its part by equi-joins; then a
part comes together, and what a nearer level overrides is found there from each
leaf's own path and its prefixes, in windows of one object.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablesync.operators.settings import LEVELS

#: Objects of one task (in the mean).
TASK_OBJECTS = 10_000
#: Parts of a partition, so that partitions are about even.
PARTS = 4


def setting_leaves(settings: DataFrame) -> DataFrame:
    """``level, object, path`` (array of keys) and ``value`` (JSON text) of every
    value that isn't a dictionary or null.  Text that is no JSON is an error."""
    spark = settings.sparkSession
    rows = settings.select("level", "object", F.array().cast("array<string>").alias("path"), F.parse_json("value").alias("v")).where("v is not null")
    found = None
    while True:
        rows = rows.withColumn("kind", F.schema_of_variant("v"))
        plain = rows.where("kind not like 'OBJECT%' and kind <> 'VOID' and size(path) > 0").select("level", "object", "path", F.to_json("v").alias("value"))
        found = plain if found is None else found.unionByName(plain)
        nested = rows.where("kind like 'OBJECT%'")
        if nested.isEmpty():
            return found
        rows = spark.sql("select level, object, concat(path, array(e.key)) as path, e.value as v from {nested}, lateral variant_explode(v) as e", nested=nested)


def met_leaves(leaves: DataFrame, objects: DataFrame, names: dict[str, Column], tasks: int) -> DataFrame:
    """Of each object (with its ``part``) the leaves of its ancestors, whose names are ``names``."""
    ancestors = F.inline(F.array(*[F.struct(F.lit(level).alias("level"), name.alias("object")) for level, name in names.items()]))
    part_of = lambda name: F.pmod(F.xxhash64(name), F.lit(PARTS * tasks)).alias("part")
    asked = objects.select(part_of(names["table"]), "*", ancestors)
    shared = objects.select(part_of(names["table"]), ancestors).where("level <> 'table'").distinct()
    copies = leaves.where("level <> 'table'").join(shared, ["level", "object"])
    own = leaves.where("level = 'table'").withColumn("part", part_of(F.col("object")))
    on = ["part", "level", "object"]
    return asked.repartition(tasks, *on).join(copies.unionByName(own).repartition(tasks, *on), on)


def effective_nested(settings: DataFrame, objects: DataFrame, cols: Sequence[str] = ("catalog_name", "schema_name", "table_name")) -> DataFrame:
    """Per object and path the merged value (JSON text) and the level that set it.

    Where a level sets one path twice, the largest text counts."""
    cols = list(cols)
    c, s, t = (F.col(x) for x in cols)
    names = {"group": F.lit("*"), "catalog": c, "schema": F.concat_ws(".", c, s), "table": F.concat_ws(".", c, s, t)}
    rank = F.element_at(F.create_map(*[x for i, name in enumerate(LEVELS) for x in (F.lit(name), F.lit(i))]), F.col("level"))
    leaves = setting_leaves(settings).groupBy("level", "object", "path").agg(F.max("value").alias("value")).withColumn("rank", rank)
    tasks = max(int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-objects.count() // TASK_OBJECTS))
    met = met_leaves(leaves, objects.select(*cols), names, tasks).repartition(tasks, "part")
    nearest = met.groupBy("part", *cols, "path").agg(F.max_by(F.struct("value", "level", "rank"), "rank").alias("w")).select("part", *cols, "path", "w.*")
    # each leaf at its own place and above it
    prefixes = F.transform(F.sequence(F.lit(1), F.size("path")), lambda i: F.slice("path", 1, i))
    placed = nearest.select("*", F.explode(prefixes).alias("node")).withColumn("own", F.size("node") == F.size("path"))
    here = W.partitionBy("part", *cols, "node")
    leaf, below = F.max(F.when(F.col("own"), F.col("rank"))).over(here), F.max(F.when(~F.col("own"), F.col("rank"))).over(here)
    over = F.coalesce(F.when(F.col("own"), below).otherwise(leaf) > F.col("rank"), F.lit(False))
    judged = placed.withColumn("over", over).groupBy("part", *cols, "path").agg(F.bool_or("over").alias("over"), F.first("value").alias("value"), F.first("level").alias("level"))
    return judged.where(~F.col("over")).select(*cols, "path", "value", "level")
