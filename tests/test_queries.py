"""Every registered query against its SQL at the smallest scale."""

import glob
import os

import duckdb
import pytest

from check import compare
from workloads import REGISTRY

@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_query_equals_sql(spark, sf, duck, name):
    got = REGISTRY[name].run(spark, sf).toArrow()
    problem = compare(got, duck.sql(REGISTRY[name].sql).to_arrow_table())
    assert problem is None, problem


@pytest.mark.parametrize("name", ["model_decision_tree", "model_lda", "sel_nested_cv"])
def test_rows_only_query_runs(spark, sf, name):
    assert REGISTRY[name].run(spark, sf).count() > 0


def test_entry_runs(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plan_to_stack_end_to_end(spark, sf):
    """Feature plan, assembly, two layers, scoring by key."""
    from pyspark.sql import functions as F
    from tablesmith.models import closed_form, ensemble, trees
    from tablesmith.operators import encode, metrics, profile, relational
    from tablesmith.plans import features
    from workloads.base import ROLES, manifest
    rows = features.advanced(manifest(spark, sf), ROLES, one_hot=True)
    names = [c for c in rows.columns if c not in ("id", "split", "survived", "truth")]
    rows = profile.assert_no_nulls(rows, names)
    packed = encode.assemble(rows, names, "id", "survived", extra=["split"])
    train, test = packed.where("split = 'train'"), packed.where("split = 'test'").drop("label")
    layer = {"nb": closed_form.GaussianNB(), "bnb": closed_form.BernoulliNB()}
    result, accuracy = ensemble.stack([layer], trees.decision_tree(max_depth=3), train, test, k=3)
    aligned = relational.align_predictions(result, rows.where("split = 'test'").select("id", "truth"), "id")
    assert aligned.where(F.col("status") != "matched").count() == 0
    assert 0.4 < metrics.accuracy(aligned, "prediction", "truth").first().accuracy <= 1 and accuracy > 0.5
