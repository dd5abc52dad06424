"""Settings as data.

Settings are rows ``(level, object, key, value)`` with levels group <
catalog < schema < table; objects are named ``*`` (group),
``catalog``, ``catalog.schema``, ``catalog.schema.table``.  The effective
value of a key for an object is the one at its most specific level; unset
keys, and keys set to null, inherit.  Values replace each other whole (lists are not merged).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.text import substitute

# Setting levels, least to most specific.
LEVELS = ("group", "catalog", "schema", "table")


def effective_settings(settings: DataFrame, objects: DataFrame, cols: Sequence[str] = ("catalog_name", "schema_name", "table_name")) -> DataFrame:
    """Per object and key, the value of the most specific level.

    Settings of tables are joined by their name; those of the three levels
    above, whose keys all objects of a group, catalog or schema share, are a table
    of their own that AQE broadcasts where it is small.  ``max_by`` on the level rank picks the
    winner.  No object ever meets more than 4 setting rows per key.
    """
    c, s, t = (F.col(x) for x in cols)
    anc = F.array(
        F.struct(F.lit(0).alias("rank"), F.lit("group").alias("level"), F.lit("*").alias("object")),
        F.struct(F.lit(1).alias("rank"), F.lit("catalog").alias("level"), c.alias("object")),
        F.struct(F.lit(2).alias("rank"), F.lit("schema").alias("level"), F.concat_ws(".", c, s).alias("object")),
    )
    rows = settings.select("level", "object", "key", "value").where("value is not null")
    upper = rows.where(F.col("level") != "table")  # beyond a broadcast AQE splits its hot keys
    own = objects.select(*cols, F.lit(3).alias("rank"), F.lit("table").alias("level"), F.concat_ws(".", c, s, t).alias("object"))
    joined = objects.select(*cols, F.inline(anc)).join(upper, on=["level", "object"], how="inner").unionByName(
        own.join(rows.where(F.col("level") == "table"), on=["level", "object"], how="inner")
    )
    return joined.groupBy(*cols, "key").agg(
        F.max_by("value", "rank").alias("value"),
        F.max_by("level", "rank").alias("level"),
    )


def substitute_names(df: DataFrame, template_col: str, values: Mapping[str, Column], out_col: str = "resolved") -> DataFrame:
    """Resolve ``{{catalog_name}}``-style placeholders per row."""
    return df.withColumn(out_col, substitute(F.col(template_col), values))
