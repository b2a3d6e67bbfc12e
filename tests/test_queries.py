"""Every registered query against its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__
from vectrace.plans import catalog, files, records, streams  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    import duckdb

    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def key(row):
    """Sorts rows by everything but the last digit of their doubles."""
    return tuple(f"{v:.4f}" if isinstance(v, float) else str(v) for v in row)


def same(a, b):
    """Equal, doubles up to the rounding of a tie in the sixth place."""
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=2e-6)
    return str(a) == str(b)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, db, name):
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=key)
    result = db.execute(catalog.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expect = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=key)
    assert len(got) == len(expect)
    assert all(same(x, y) for a, b in zip(got, expect, strict=True) for x, y in zip(a, b, strict=True))


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_scans_are_pruned(spark):
    plan = __spark_entry__.queries()["vector_sampling"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "PushedFilters" in plan


def test_queries_without_the_optional_folders(tmp_path):
    """The entry imports and lists the other queries in a tree without the subpackage, with and without the pipeline's file."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    here = Path(__spark_entry__.__file__).parent
    shutil.copytree(here / "vectrace", tmp_path / "vectrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), 'pipeline' in q)"
    for pipeline in (False, True):
        if pipeline and (here / "corpus_pipeline.py").exists():
            shutil.copy(here / "corpus_pipeline.py", tmp_path)
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, check=False)
        assert done.returncode == 0, done.stderr
        count, listed = done.stdout.split()[-2:]
        assert int(count) >= 90 and listed == "False"


def test_vectors_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = __spark_entry__.queries()["frame_features"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") <= 4
