import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    for name in ("loomrank", "__spark_entry__.py"):
        source = REPO / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "loomrank/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; from loomrank.plans import registry, oracle; assert e.queries() == registry.QUERIES and e.oracle_sql() == oracle.SQL"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_nothing_else_imports_the_corpus_operators():
    for file in (REPO / "loomrank").rglob("*.py"):
        if "llm" not in file.relative_to(REPO).parts:
            assert "loomrank.llm" not in file.read_text()
