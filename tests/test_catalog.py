"""Every core query that SQL can express, against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from kuatia.plans import catalog

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return "null"
        if isinstance(v, pd.Timestamp):
            return str(v.tz_convert("UTC").tz_localize(None) if v.tzinfo else v)
        if isinstance(v, float):
            return repr(round(v, 9))
        return v.isoformat()[:10] if hasattr(v, "isoformat") else str(v)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, SMALL).toArrow().to_pandas()
    want = con.sql(catalog.SQL[name]).to_arrow_table().to_pandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["q_entity_forms", "q_context_selection", "q_context_documents", "q_prompts", "q_variant_summaries"])
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_core_does_not_import_llm():
    import subprocess
    import sys

    code = "import sys; sys.modules['kuatia.llm'] = None; import __spark_entry__ as e; assert e.queries() and not any(k.startswith(('p1_', 'p7_')) for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
