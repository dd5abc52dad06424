"""Versioned parquet tables on any Hadoop-compatible file system.

A table is a folder holding version folders ``_v000001``, ``_v000002``...
A version is committed when Spark's job commit has written its ``_SUCCESS``
marker; readers take the newest committed version.  Writing a new version
never touches the one being read, so a table can be rebuilt from itself
(Spark refuses to overwrite a path it is reading), and a job that dies
midway leaves the previous version current.
"""

from __future__ import annotations

import re
from typing import Optional

from pyspark.sql import DataFrame, SparkSession

from tablesync.session import work_dir

_VERSION = re.compile(r"^_v(\d+)$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    fs, p, _ = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()) if fs.exists(p) else []


def committed_versions(spark: SparkSession, table_dir: str) -> list[int]:
    """Numbers of the committed versions, least first (six digits or more)."""
    fs, p, jvm = _fs(spark, table_dir)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m and st.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def current_path(spark: SparkSession, table_dir: str) -> Optional[str]:
    v = committed_versions(spark, table_dir)
    return f"{table_dir.rstrip('/')}/_v{v[-1]:06d}" if v else None


def read_table(spark: SparkSession, table_dir: str) -> DataFrame:
    path = current_path(spark, table_dir)
    if path is None:
        raise FileNotFoundError(f"no committed version under {table_dir}")
    return spark.read.parquet(path)


def write_version(df: DataFrame, table_dir: str, partition_by: Optional[list[str]] = None) -> str:
    """Write ``df`` as the next version of the table; return its path."""
    spark = df.sparkSession
    fs, p, jvm = _fs(spark, table_dir)
    taken = []
    if fs.exists(p):
        for st in fs.listStatus(p):
            m = _VERSION.match(st.getPath().getName())
            if m:
                taken.append(int(m.group(1)))
    nxt = (max(taken) + 1) if taken else 1
    path = f"{table_dir.rstrip('/')}/_v{nxt:06d}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def delete(spark: SparkSession, path: str) -> bool:
    """Recursively delete a folder (reload / rescan controls)."""
    fs, p, _ = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def held(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the cluster's shared folder and read back: an
    iteration's lineage ends here, and a lost executor costs its own tasks only."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
