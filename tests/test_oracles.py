"""Every registered query against its SQL, on the smallest tables."""

import pathlib
import shutil
import subprocess
import sys

import pytest
from conftest import SMALL, same

from tallyloom.plans.oracles import ORACLES
from tallyloom.plans.queries import QUERIES, Tables, finished

ROWS_ONLY = {"kmeans_clusters", "cluster_diagnostics", "model_registry", "legacy_clusters", "fitted_rules", "feedback_summary"}


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


def test_all_queries_have_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, tables, duck):
    rows = duck.sql(ORACLES[name])
    same(finished(name, tables), rows)
    assert len(rows)  # equal tables without rows say nothing


def test_clusters_are_whole(tables):
    from tallyloom.plans.queries import fitted

    f = fitted(tables).cache()
    assert f.count() == f.select("customer_id").distinct().count() == tables.slim.select("customer_id").distinct().count()
    small = f.filter("n_customers < 6")
    assert small.filter("label <> 0 OR k <> 1").isEmpty()
    assert f.filter("silhouette < -1 OR silhouette > 1").isEmpty()


def test_entry(spark):
    import __spark_entry__

    assert not __spark_entry__.entry(spark).isEmpty()
    assert {"market_basket", "recommendations"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize(("broken", "fine"), [(None, True), ("import a_package_that_is_not_there", False)])
def test_entry_without_the_text_operators(tmp_path, broken, fine):
    """Absent text operators are left out; one that can't be imported for another reason is an error."""
    root = pathlib.Path(__file__).resolve().parent.parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "tallyloom", tmp_path / "tallyloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if broken:
        (tmp_path / "corpus_pipeline.py").write_text(broken)
    code = "import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('op')]"
    assert (subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True).returncode == 0) is fine
