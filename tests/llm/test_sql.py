"""Queries against their SQL twins, and the entry with and without this subpackage."""

import pathlib
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from stratawell.llm.oracles import ORACLES
from stratawell.llm.queries import QUERIES
from tests.test_oracles import SQL_TYPE, _rows


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name, sf):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/{sf}/{table}.parquet'")
    got = QUERIES[name](spark, f"/root/testdata/{sf}")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert {c: SQL_TYPE[t] for c, t in got.dtypes} == {d[0]: str(d[1]) for d in want.description}
    assert _rows(got.columns, got.collect()) == _rows(names, want.fetchall())


def test_entry_has_one_query_for_each_operator():
    found = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert found == list(range(1, 14)) and "pipeline" in entry.queries()


def test_entry_works_without_this_subpackage(tmp_path):
    """As if both folders and the pipeline were deleted, an empty folder left behind included."""
    import pathlib
    import shutil

    root = pathlib.Path(entry.__file__).parent
    for path in ("__spark_entry__.py", "stratawell"):
        if (root / path).is_dir():
            shutil.copytree(root / path, tmp_path / path, ignore=shutil.ignore_patterns("llm"))
        else:
            shutil.copy(root / path, tmp_path / path)
    code = "import __spark_entry__ as e; print(sum(n.startswith('op') for n in e.queries()), len(e.queries()) > 20)"
    for leftover in (False, True):
        if leftover:
            (tmp_path / "stratawell/llm/__pycache__").mkdir(parents=True)
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
        assert done.stdout.split() == ["0", "True"], done.stderr


def test_entry_works_where_a_library_of_this_subpackage_is_missing():
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; "
        "print(sum(n.startswith('op') for n in e.queries()), len(e.queries()) > 20, len(e.oracle_sql()) > 20)"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=pathlib.Path(entry.__file__).parent, capture_output=True, text=True)
    assert done.stdout.split() == ["0", "True", "True"], done.stderr
