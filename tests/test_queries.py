import glob
import os

import duckdb
import pandas as pd
import pytest

from scriptorium.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
#: Held against their SQL by the driver and on larger tables only.
SLOW = {"rp_chain", "aud4_summary", "unk8_export"}


def rows(df):
    cells = lambda v: "" if v is None or v is pd.NA or v != v else repr(float(v)) if isinstance(v, float) else str(v)
    columns = sorted(df.columns)
    return sorted("|".join(cells(v) for v in r) for r in df[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got, wanted = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)
    assert len(got)
    if "changed" in got:
        assert got["changed"].sum() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
