"""The reconciliation cascade (R8): schema -> row count -> missing rows.

A failed check skips the later ones of the same pair (``status='skipped'``,
``passed=null``); disabled checks leave no row.  The driver only decides
which pairs go on; every check is a set-at-a-time Spark job over all pairs
that are still in the race, and only per-pair summary numbers come back.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators import reconcile as R

#: Pairs whose counts are planned as one job.
BATCH = 50

CHECK_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("pair", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("passed", T.BooleanType(), True),
        T.StructField("mismatch_count", T.LongType(), True),
        T.StructField("details", T.StringType(), True),
    ]
)


@dataclass
class ReconcileConfig:
    schema_check: bool = True
    row_count_check: bool = True
    missing_data_check: bool = True
    exclude_columns: Sequence[str] = field(default_factory=list)
    evidence_path: Optional[str] = None
    run_id: str = ""


def _say(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def _missing_check(p: R.TablePair, cfg: ReconcileConfig) -> tuple:
    excl = list(cfg.exclude_columns)
    try:
        if cfg.evidence_path:  # one pass: rows are counted while they are stored
            rows = R.missing_rows(p.source, p.target, excl, p.source_filter, p.target_filter, with_evidence=True)
            n = R.write_evidence(R.missing_data_rows(rows, cfg.run_id, *_full_names(p)), f"{cfg.evidence_path}/missing_data", cfg.run_id, p.name)
            m_t, m_s = n[R.MISSING_IN_TARGET], n[R.MISSING_IN_SOURCE]
        else:  # numbers alone: digests cross the shuffle
            c = R.match_counts(p.source, p.target, excl, p.source_filter, p.target_filter, method="digest").first()
            m_t, m_s = int(c["missing_count"]), int(c["missing_in_source_count"])
    except Exception as e:  # noqa: BLE001 - one pair's failure is its own result
        return (p.name, "missing_data_check", "failed", False, None, _say(e))
    total = m_t + m_s
    detail = ",".join(f"{k}={v}" for k, v in (("missing_in_source", m_s), ("missing_in_target", m_t)) if v) or None
    return (p.name, "missing_data_check", "passed" if total == 0 else "failed", total == 0, total, detail)


def _full_names(p: R.TablePair) -> tuple[str, str]:
    return p.source_name or f"source.default.{p.name}", p.target_name or f"target.default.{p.name}"


def _each(pairs: Sequence[R.TablePair], job) -> tuple[dict, dict[str, str]]:
    """``job`` of batches of pairs, and of single pairs where a batch fails:
    results and errors by pair name."""
    done: dict = {}
    errors: dict[str, str] = {}
    for lo in range(0, len(pairs), BATCH):
        some = list(pairs[lo : lo + BATCH])
        try:
            done.update(job(some))
        except Exception:  # noqa: BLE001
            for p in some:
                try:
                    done.update(job([p]))
                except Exception as e:  # noqa: BLE001
                    errors[p.name] = _say(e)
    return done, errors


def reconcile_pairs(
    spark: SparkSession,
    pairs: Sequence[R.TablePair],
    config: Optional[ReconcileConfig] = None,
    parallelism: int = 4,
) -> DataFrame:
    """One row per pair and check.  A pair one of whose tables is missing, or
    whose check raises, fails by itself with the reason in ``details``; the
    others go on.  With ``evidence_path`` schema differences and missing rows
    are stored below it, stamped with run and names; the same run of the same
    pair again takes the place of what it stored before."""
    cfg = config or ReconcileConfig()
    rows: list[tuple] = []
    excl = list(cfg.exclude_columns)
    checks = [c for c, on in (("schema_check", cfg.schema_check), ("row_count_check", cfg.row_count_check), ("missing_data_check", cfg.missing_data_check)) if on]

    def fail(p: R.TablePair, check: str, count: Optional[int], detail: Optional[str]) -> None:
        rows.append((p.name, check, "failed", False, count, detail))
        rows.extend((p.name, c, "skipped", None, None, "previous check failed") for c in checks[checks.index(check) + 1 :])

    alive = []
    for p in pairs:
        gone = [side for side, df in (("source", p.source), ("target", p.target)) if df is None]
        if gone and checks:
            fail(p, checks[0], None, f"{' and '.join(gone)} table not found")
        else:
            alive.append(p)

    if cfg.schema_check and alive:
        def differ(some):
            found = R.schema_diff_tables(spark, some, excl).collect()  # a row a differing column
            return {p.name: [r for r in found if r["pair"] == p.name] for p in some}

        done, errors = _each(alive, differ)
        going = []
        for p in alive:
            if p.name in errors:
                fail(p, "schema_check", None, errors[p.name])
            elif done[p.name]:
                fail(p, "schema_check", len(done[p.name]), None)
                if cfg.evidence_path:
                    diff = R.schema_diff_tables(spark, [p], excl).drop("pair")
                    R.write_evidence(R.stamp_result(diff, cfg.run_id, *_full_names(p)), f"{cfg.evidence_path}/schema", cfg.run_id, p.name)
            else:
                rows.append((p.name, "schema_check", "passed", True, 0, None))
                going.append(p)
        alive = going

    if cfg.row_count_check and alive:
        done, errors = _each(alive, lambda some: {r["pair"]: r for r in R.row_count_check(some).collect()})
        going = []
        for p in alive:
            if p.name in errors:
                fail(p, "row_count_check", None, errors[p.name])
                continue
            r = done[p.name]
            n, detail = abs(int(r["row_count_diff"])), f"source={r['source_row_count']} target={r['target_row_count']}"
            if r["comparison_result"] == "match":
                rows.append((p.name, "row_count_check", "passed", True, n, detail))
                going.append(p)
            else:
                fail(p, "row_count_check", n, detail)
        alive = going

    if cfg.missing_data_check and alive:
        # independent Spark jobs: submitted together so the cluster runs
        # them side by side (the driver only waits for one number each)
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(alive)))) as pool:
            rows.extend(pool.map(lambda p: _missing_check(p, cfg), alive))

    return spark.createDataFrame(rows, CHECK_RESULT_SCHEMA)


def verdict(results: DataFrame) -> DataFrame:
    """Per pair: ``passed`` when no check failed (skipped checks do not count)."""
    return results.groupBy("pair").agg(
        (F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)) == 0).alias("passed"),
        F.count_if(F.col("status") == "failed").alias("failed_checks"),
        F.count_if(F.col("status") == "skipped").alias("skipped_checks"),
    )
