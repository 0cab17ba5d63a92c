import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_registry():
    names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= names and "term_catalog" in names and len(names) >= 80


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["term", "frequency", "document_frequency", "sentence_ratio"] and df.count() > 0


def test_works_without_llm(tmp_path):
    """The rest imports, registers its queries and passes tests when the corpus operators are gone, whether
    or not the pipeline over them is left behind."""
    copy = tmp_path / "r"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], check=True, cwd=copy)
    (copy / "corpus_pipeline.py").unlink()
    subprocess.run([sys.executable, "-B", "-c", code], check=True, cwd=copy)
    some = "registry or markdown or protected or settings or paging"
    subprocess.run([sys.executable, "-B", "-m", "pytest", "tests", "-q", "-p", "no:cacheprovider", "-k", f"({some}) and not without_llm"], check=True, cwd=copy)
