"""Every registered query against its DuckDB oracle (same check as the driver's,
on the smallest data so the suite stays quick; the driver runs sf0.01)."""

import pytest

import __spark_entry__ as E
from evenline.plans import ORACLE, QUERIES
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
SLOW: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE.get(name), SF, con)
    assert r["status"] in ("match", "rows-only"), r


def test_every_query_has_an_oracle_or_a_reason():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 200 and df.columns == ["doc_id", "neutral", "changed"]


def test_entry_survives_missing_packages(tmp_path):
    """Without the packages that other queries need, the library's own are still registered."""
    import os
    import subprocess
    import sys
    for name in ("xxhash", "public_tokenizers"):
        (tmp_path / f"{name}.py").write_text("raise ImportError('not here')\n")
    root = os.path.dirname(os.path.abspath(E.__file__))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'neutral_rewrite' in q)"
    env = os.environ | {"PYTHONPATH": f"{tmp_path}:{root}:{os.environ.get('PYTHONPATH', '')}"}
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=120)
    n, has = out.stdout.split()
    assert out.returncode == 0 and has == "True" and int(n) >= len(QUERIES)
