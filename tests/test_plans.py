import contextlib
import io

import __spark_entry__ as E
from conftest import SF001


def _explain(df, mode=None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def test_flagship_runs_with_one_hash_shuffle(spark):
    df = E.queries()["recon_missing_rows"](spark, SF001)
    df.collect()
    final = _explain(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    assert final.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in final and "BroadcastNestedLoopJoin" not in final


def test_filters_reach_the_scan(spark):
    df = E.queries()["recon_missing_filtered"](spark, SF001)
    plan = _explain(df, "formatted")
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)]" in plan


def test_row_counts_never_shuffle_rows(spark):
    df = E.queries()["recon_row_counts"](spark, SF001)
    df.collect()
    final = _explain(df).split("== Initial Plan ==")[0]
    # only one-row partial counts cross an exchange: no hash exchange on data columns
    assert "Exchange hashpartitioning(l_" not in final and "Exchange hashpartitioning(o_" not in final
