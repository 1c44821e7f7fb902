"""The analytics part stands alone: nothing outside the optional corpus subpackage imports it."""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _sources():
    for folder, _, names in os.walk(os.path.join(ROOT, "fraudlens")):
        if os.path.basename(folder) not in ("llm", "__pycache__"):
            yield from (os.path.join(folder, n) for n in names if n.endswith(".py"))


def test_no_module_imports_the_corpus_subpackage():
    for path in _sources():
        with open(path) as f:
            assert not re.search(r"^\s*(from|import) .*\b(llm|corpus_pipeline)\b", f.read(), re.M), path


def test_the_entry_module_works_without_the_corpus_subpackage():
    code = ("import sys; sys.modules['fraudlens.llm'] = None; import __spark_entry__ as e; q = e.queries();"
            "assert 'm9_dim_merchants' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q;"
            "assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
