"""Registration, SQL agreement and the removable package."""
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E
from kredex.llm import queries as Q
from oracle_check import compare, duck

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_one_query_per_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in E.queries() and set(Q.ORACLE) <= set(Q.QUERIES)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_oracle(spark, sf_dir, name):
    res = compare(spark, duck(sf_dir), sf_dir, name, Q.QUERIES[name], Q.ORACLE[name])
    assert res["status"] == "OK", res


def test_the_rest_works_without_the_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), [n for n in q if n.startswith('op') or n == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert out.stdout.strip() == f"{len(E.queries()) - 14} []", out.stderr
