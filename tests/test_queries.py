"""Every core query against its SQL on the smallest tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__
from worktally.operators import profiling
from worktally.plans import registry


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_gives_the_rows_of_its_sql(spark, sf_small, duck, name):
    df = registry.queries()[name](spark, sf_small)
    columns = sorted(df.columns)
    mine = sorted(([_plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    rel = duck.sql(registry.oracles()[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert mine == sorted(([_plain(r[i]) for i in at] for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("factor", [-1, 3, 11])
def test_isolation_percentiles_are_those_of_the_sql_whatever_the_ids(spark, sf_small, tmp_path, factor):
    """Negative ids too; halves are rounded once and as in SQL."""
    folder = tmp_path / "tables"
    folder.mkdir()
    con = duckdb.connect()
    for f in glob.glob(f"{sf_small}/*.parquet"):
        name = os.path.basename(f)[:-8]
        if name == "work_analysis":
            con.execute(f"COPY (SELECT * REPLACE (work_id * {factor} AS work_id) FROM '{f}') TO '{folder}/{name}.parquet' (FORMAT parquet)")
        else:
            os.symlink(f, folder / f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    got = registry.queries()["isolation_agg_given"](spark, str(folder)).select("state_id", "isolation_95", "n").collect()
    want = con.sql(f"SELECT state_id, isolation_95, n FROM ({registry.oracles()['isolation_agg_given']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracles())))
def test_query_without_sql_runs(spark, sf_small, name, monkeypatch):
    # One fit of two clusters: what the profiles are is tested elsewhere.
    monkeypatch.setattr(profiling, "SEEDS", range(42, 43))
    monkeypatch.setattr(profiling, "KS", range(2, 3))
    assert registry.queries()[name](spark, sf_small).count() >= 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
