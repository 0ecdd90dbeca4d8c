"""Every query of the library matches its DuckDB twin at sf0.001."""

import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, ROOT + "/scripts")
import __spark_entry__ as E  # noqa: E402
from lodestar.plans.catalog import load_all  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns[0] == "id"


@pytest.mark.parametrize("name", sorted(load_all()))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]


def test_every_query_has_a_twin():
    assert set(load_all()) <= set(E.oracle_sql()) & set(E.queries())


def test_entry_without_the_optional_part(tmp_path):
    """The entry imports and keeps the library's queries where the
    training-data package and the pipeline are gone."""
    import shutil
    import subprocess
    for name in ("__spark_entry__.py", "lodestar"):
        src = f"{ROOT}/{name}"
        if name == "lodestar":
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONDONTWRITEBYTECODE": "1"})
    assert said.stdout.split() == [str(len(load_all()))] * 2, said.stderr
