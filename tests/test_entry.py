"""Driver contract and plan hygiene over the registered queries."""
import pytest

import __spark_entry__ as E
from tessera import catalog as C
from conftest import SF0001



def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and "coin_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(C.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(C.QUERIES))
def test_no_python_udf_on_data_path(spark, name):
    plan = C.QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, name


def test_scan_prunes_columns(spark):
    plan = E.queries()["latest_per_key"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_view_join_reuses_window_partitioning(spark):
    from tessera.plans.adhoc import plan_text

    prev = (spark.conf.get("spark.sql.autoBroadcastJoinThreshold"),
            spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["prices_with_dim"](spark, SF0001)
        df.collect()
        tree = plan_text(df, "formatted").split("\n\n")[0].split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in tree
        exchanges = [ln for ln in tree.splitlines() if ln.strip().startswith("+- Exchange")
                     or ln.strip().startswith(":- Exchange") or "- Exchange" in ln]
        assert len(exchanges) == 2        # one per de-duplication window, none for the join
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev[0])
        if prev[1] is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", prev[1])


@pytest.mark.parametrize("name", ["trending_latest", "dominance_latest", "raw_peek"])
def test_answers_about_the_newest_day_read_only_that_day(spark, name):
    """Every scan of row data has a partition filter on the day (the scan that finds the day reads no column)."""
    from tessera.plans.adhoc import plan_text

    df = C.QUERIES[name](spark, SF0001)
    df.collect()
    text = plan_text(df, "formatted")
    scans = [s.strip() for s in text.split("\n\n") if "Scan parquet" in s.strip().split("\n")[0] and "Location" in s]
    assert scans
    for s in scans:
        schema = s.split("ReadSchema: ")[1].split("\n")[0]
        assert "PartitionFilters: [" in s and "dt#" in s.split("PartitionFilters: ")[1].split("\n")[0] or schema == "struct<>", s


def test_the_run_summary_is_counted_in_one_pass(spark):
    plan = C.QUERIES["mode_summary"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 7 and "Join" not in plan
