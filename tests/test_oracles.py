"""Each query with an oracle gives the oracle's rows; the others run and have a stable schema."""

import duckdb
import pytest

from costquarry.plans import catalog as engine

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def rows(pdf):
    out = []
    for r in pdf[sorted(pdf.columns)].itertuples(index=False):
        out.append(tuple("~" if v is None or v != v else f"{v:.5f}" if isinstance(v, float) else str(v).removesuffix(" 00:00:00") for v in r))
    return sorted(out)


@pytest.mark.parametrize("name", sorted(engine.ORACLES))
def test_matches_oracle(spark, sf_dir, duck, name):
    got, want = engine.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(engine.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    for c in got.columns:  # an integer column with nulls is a float column in pandas
        if got[c].dtype.kind == "f" or want[c].dtype.kind == "f":
            got[c], want[c] = got[c].astype(float), want[c].astype(float)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(engine.QUERIES) - set(engine.ORACLES)))
def test_runs(spark, sf_dir, name):
    df = engine.QUERIES[name](spark, sf_dir)
    assert df.columns and df.limit(5).collect() is not None
