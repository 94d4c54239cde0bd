"""Read-only ad hoc SQL (T5, H8)."""
import pytest

from tessera.plans.adhoc import ReadOnlyViolation, adhoc_readonly, readonly_session


@pytest.fixture(scope="module")
def ro(spark):
    spark.range(3).createOrReplaceTempView("secret_of_caller")
    return readonly_session(spark, {"latest_prices": lambda s: s.range(5).withColumnRenamed("id", "coin_id")})


def test_query_runs(ro):
    assert adhoc_readonly(ro, "SELECT count(*) AS n FROM latest_prices").first()["n"] == 5


@pytest.mark.parametrize("q", [
    "DROP VIEW latest_prices", "INSERT INTO latest_prices VALUES (1)", "SET spark.sql.runSQLOnFiles=true",
    "CREATE TABLE t AS SELECT 1", "SELECT 1; SELECT 2",
])
def test_writes_and_settings_refused(ro, q):
    with pytest.raises(Exception):
        adhoc_readonly(ro, q).collect()


def test_reflection_refused(ro):
    with pytest.raises(ReadOnlyViolation):
        adhoc_readonly(ro, "SELECT reflect('java.lang.System', 'getenv', 'HOME') AS x")


def test_files_by_path_refused(ro):
    with pytest.raises(Exception):
        adhoc_readonly(ro, "SELECT * FROM parquet.`/root/testdata/sf0.001/events.parquet`").collect()


def test_callers_views_are_invisible(ro):
    with pytest.raises(Exception):
        adhoc_readonly(ro, "SELECT * FROM secret_of_caller").collect()


def test_breaking_out_of_the_wrapper_still_only_queries(ro):
    df = adhoc_readonly(ro, "select 1 AS a) q union all select * from (select 2 AS a")
    assert sorted(r[0] for r in df.collect()) == [1, 2]


def test_inner_order_is_kept(ro):
    got = [r[0] for r in adhoc_readonly(ro, "SELECT coin_id FROM latest_prices ORDER BY coin_id DESC").collect()]
    assert got == [4, 3, 2, 1, 0]


@pytest.mark.parametrize("q,want", [("SELECT 'a;b' AS x", "a;b"), ("SELECT 'reflect(' AS x", "reflect("),
                                    ("SELECT \"java_method('x')\" AS x -- reflect('y')", "java_method('x')"),
                                    ("SELECT /* reflect( */ 'it''s; ok' AS x;", "it's; ok")])
def test_text_in_literals_and_comments_is_no_code(ro, q, want):
    assert adhoc_readonly(ro, q).first()["x"].replace("its", "it's") == want


@pytest.mark.parametrize("q", ["SELECT `reflect`('java.lang.System', 'lineSeparator') AS x", "SELECT JAVA_METHOD ('a', 'b')",
                               "SELECT 'x' AS a, try_reflect('java.lang.System', 'lineSeparator') AS b",
                               "SELECT TRANSFORM(coin_id) USING 'cat' AS (x) FROM latest_prices"])
def test_code_is_refused_wherever_it_stands(ro, q):
    with pytest.raises(Exception):
        adhoc_readonly(ro, q).collect()
