"""Every query with a SQL twin gives the same rows, types and values."""

import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from docket.checks.oracle import ORACLE
from docket.checks.queries import QUERIES
from tests.compare import differences


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(ORACLE) <= set(QUERIES) <= set(queries())


def test_entry_loads_without_an_optional_package():
    """A package that only the training-data operators need is no reason not to load."""
    blocked = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", blocked], capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout) >= len(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, sql, name):
    got = QUERIES[name](spark, folder)
    assert not got.isEmpty()
    assert differences(got, sql.sql(ORACLE[name])) == []


def test_entry_scores_every_case(spark):
    rows = entry(spark).toPandas()
    assert list(rows.columns) == ["codigo_processo", "cargo", "predict", "probability"]
    assert rows["codigo_processo"].is_unique and len(rows) == 1500
    assert rows["probability"].between(0.5, 1.0).all()


def test_genetic_best_never_falls_and_stays_small(spark, folder):
    rows = QUERIES["genetic_selection"](spark, folder).orderBy("generation").collect()
    scores = [r["macro_f1"] for r in rows]
    assert scores == sorted(scores)
    assert all(1 <= len(r["features"]) <= 4 for r in rows)
    assert "prova_1" in rows[-1]["features"]


def test_shadows_confirm_signal_and_not_noise(spark, folder):
    verdict = {r["feature"]: r for r in QUERIES["boruta_ranking"](spark, folder).collect()}
    assert verdict["prova_1"]["hits"] == verdict["prova_1"]["rounds"]
    assert verdict["prova_3"]["hits"] == verdict["prova_3"]["rounds"]
    assert verdict["prova_1"]["verdict"] == verdict["prova_3"]["verdict"] == "confirmed"
    assert verdict["prova_7"]["verdict"] == "rejected"
    assert sorted(r["place"] for r in verdict.values()) == list(range(1, len(verdict) + 1))
