"""The driver contract: names, oracles, and that the library works without its training-data subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_oracles_name_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60


def test_entry_without_the_subpackage(tmp_path):
    code = "import sys; sys.modules['quern.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; n = e.queries(); assert n and 'pipeline' not in n and set(e.oracle_sql()) <= set(n)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_it():
    own = [p for p in ROOT.glob("quern/**/*.py") if "llm" not in p.relative_to(ROOT).parts]
    assert own and not [p for p in own if "quern.llm" in p.read_text("utf-8")]
