import pytest

pytest.importorskip("worktally.llm.queries")
import duckdb

from worktally.llm import queries as llm


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_query_runs(spark, sf_small, name):
    from worktally.runtime import ship_package

    ship_package(spark)
    df = llm.queries()[name](spark, sf_small)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(llm.oracles()))
def test_query_gives_the_rows_of_its_sql(spark, sf_small, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW work_analysis AS SELECT * FROM '{sf_small}/work_analysis.parquet'")
    rel = con.sql(llm.oracles()[name])
    columns = sorted(rel.columns)
    at = [rel.columns.index(c) for c in columns]
    want = sorted((str([r[i] for i in at]) for r in rel.fetchall()))
    assert sorted(str([r[c] for c in columns]) for r in llm.queries()[name](spark, sf_small).collect()) == want
