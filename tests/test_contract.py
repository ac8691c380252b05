"""The driver contract: lists load without a session, entry runs, answers match the SQL."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

ROOT = Path(__file__).resolve().parents[1]


def test_lists_load_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["comorbidity_index", "n", "early_rate"] and df.count() > 0


# A few of every family at the smallest scale; tests/compare.py runs them all.
@pytest.mark.parametrize("name", [
    "src01_csv_null_tokens", "prf04_describe_encounters", "cln_imputed_and_typed",
    "out02_winsorised_lineitem", "agg06_class_stats_lineitem", "agg10_histogram_by_class",
    "fe05_chronic_diseases", "fe30_age", "encoded_model_table", "ml01_split",
    "ml08_roc_auc", "scr01_rule_score", "scr09_merged_feed", "ml03_synthetic_minority",
    "txt01_topics", "str01_scored_stream",
])
def test_answers_match_the_sql(spark, folder, name):
    con = duck(folder)
    assert compare(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name]) == []


def test_answers_do_not_depend_on_the_number_of_shuffle_partitions(spark, folder):
    con = duck(folder)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        for name in ("ml08_roc_auc", "win05_latest_per_patient", "prf10_distinct_counts"):
            df = entry.queries()[name](spark, folder)
            assert compare(df, con, entry.oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _without(tmp_path, *gone):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__", ".pytest_cache", *gone)])


def test_all_else_works_without_the_corpus_operators(tmp_path):
    _without(tmp_path, "llm", "corpus_pipeline.py")
    code = ("import __spark_entry__ as e; q = e.queries(); "
            "assert len(q) > 150 and not any(n.startswith('op') or n == 'pipeline' for n in q) and set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, timeout=120)
    tests = [sys.executable, "-m", "pytest", "-q", "-p", "no:cacheprovider", "tests/test_store.py::test_a_record_that_moves_leaves_its_old_day",
             "tests/test_contract.py::test_entry"]
    done = subprocess.run(tests, cwd=tmp_path / "repo", timeout=300, capture_output=True, text=True)
    assert "2 passed" in done.stdout, done.stdout[-2000:]


def test_a_broken_installation_does_not_hide_the_corpus_operators(tmp_path):
    _without(tmp_path)
    (tmp_path / "repo" / "zstandard.py").write_text("raise ModuleNotFoundError('no such module', name='zstandard')")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path / "repo", timeout=120, capture_output=True, text=True)
    assert done.returncode and "zstandard" in done.stderr
