"""Every query of the subpackage on the smallest tables, and the library without it."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "scripts")]
FOLDER = "/root/testdata/sf0.001"

import check_sql  # noqa: E402

from shelfspark.llm import queries  # noqa: E402

TABLES = {"op6_warc_derivatives": "pages", "op10_embedding_dedup": "embeddings"}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    if name in queries.SQL:
        assert check_sql.compare(name, df, check_sql.connect(FOLDER), queries.SQL[name]) == []
    elif name not in ("op2_license_scan", "op6_warc_derivatives", "op8_best_fit_packing", "op11_prefix_trie"):
        assert df.count() == spark.read.parquet(f"{FOLDER}/{TABLES.get(name, 'documents')}.parquet").count()
    else:
        assert df.count() > 0


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_the_library_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, copy, ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 126 and not any(n[:2] == 'op' and n[2].isdigit() for n in q); e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
