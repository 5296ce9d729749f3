"""Every registered query of the library agrees with its SQL on the smallest tables."""

import os

import pytest

from docsieve.plans.queries import QUERIES
from docsieve.plans.sql import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


def canon(rows):
    return sorted(tuple("" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = canon(df.select(*[f"`{c}`" for c in cols]).collect())
    want = duck.execute(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({ORACLE_SQL[name]})").fetchall()
    assert got == canon(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("gone", [("docsieve/llm", "corpus_pipeline.py"), ("docsieve/llm",), ("corpus_pipeline.py",)])
def test_without_optional_parts(tmp_path, gone):
    """The entry module works without the training-data subpackage, the pipeline, or both."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/docsieve", tmp_path / "docsieve", ignore=shutil.ignore_patterns("__pycache__"))
    for f in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{root}/{f}"):
            shutil.copy(f"{root}/{f}", tmp_path / f)
    for g in gone:
        p = tmp_path / g
        shutil.rmtree(p) if p.is_dir() else p.unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert callable(e.entry) and len(q) >= 38 and set(s) <= set(q); print('pipeline' in q, sum(x.startswith('op') and x[2].isdigit() for x in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[0] == "False"
