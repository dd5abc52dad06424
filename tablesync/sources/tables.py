"""Reading tables and describing their columns."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

COLUMN_FACTS_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("is_nullable", T.StringType(), False),
        T.StructField("ordinal_position", T.IntegerType(), False),
    ]
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder (``<dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column_facts(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table, like ``information_schema.columns``.

    Built from the analysed schemas (driver-side metadata whose size is the
    number of columns, never the number of rows).  Names are lower-cased as
    catalogs store them.
    """
    rows = []
    for table, df in tables.items():
        for pos, f in enumerate(df.schema.fields, start=1):
            rows.append((table, f.name.lower(), f.dataType.simpleString(), "YES" if f.nullable else "NO", pos))
    return spark.createDataFrame(rows, COLUMN_FACTS_SCHEMA)
