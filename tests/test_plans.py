"""Plan-level checks over every registered query (sf0.001)."""

import io
from contextlib import redirect_stdout

import pytest

from quarry.plans.catalog import queries
from tools import plan_summary


def plan_text(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def ran(spark, small_dir):
    """What each registered query ran, from the event log."""
    spans = plan_summary.run(spark, small_dir)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    return plan_summary.summarize(spark.conf.get("spark.eventLog.dir").removeprefix("file://"), spans)


@pytest.mark.parametrize("name", sorted(queries()))
def test_executed_plans_have_no_cartesian_and_no_python(ran, name):
    assert ran[name]["plans"], "nothing ran"
    assert plan_summary.forbidden(ran[name]["plans"]) == []


def test_fit_counts_without_a_shuffle_by_document(ran):
    exchanges = [n["simpleString"] for p in ran["nb_model"]["plans"].values() for n in plan_summary.nodes(p) if n["nodeName"] == "Exchange"]
    assert exchanges and not any("doc_id" in e and "term" in e for e in exchanges)


def test_scan_prunes_columns(spark, small_dir):
    text = plan_text(queries()["apriori_frequent_pairs"](spark, small_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and df.columns == ["item_a", "item_b", "n"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_no_forced_join_and_no_size_switch():
    import pathlib
    import quarry
    for p in pathlib.Path(quarry.__file__).parent.rglob("*.py"):
        if "llm" not in p.parts:
            code = p.read_text()
            assert "shuffle_hash" not in code and "localCheckpoint" not in code, p
            assert "F.broadcast(" not in code or p.name == "similarity.py", p  # one row per partition there
